"""Vocabulary load plans: the loading half of the engine as whole jobs.

``load_brain_structures``: landed brain-structure JSON -> structures upserted
on their natural key (ids kept), parent edges, missing-parent report,
synonyms and a load log.

``load_concepts``: landed concept / disorder / task JSON -> defaults filled,
bad rows quarantined, inserted first-wins on the primary key; concept
details -> classes and relationships upserted.

Each step is a DataFrame; nothing is collected except single scalars (the
current maximum id, counts for the report).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagewright.functions import fields as FD
from pagewright.operators import hierarchy as H
from pagewright.operators import quality as QL
from pagewright.operators import upsert as U
from pagewright.operators.partitioning import stored
from pagewright.sources import json_sources as JS


@dataclass
class StructureLoad:
    structures: DataFrame     # id, neuronames_id, attributes
    edges: DataFrame          # child_id, parent_id, hierarchy_model_name, model_status
    missing: DataFrame        # top missing parents with n_more
    synonyms: DataFrame
    log: DataFrame            # run_id, source, metric, n
    quarantine: DataFrame     # record, key, ordinal: broken records and rows without a key


def load_brain_structures(spark: SparkSession, json_path: str, existing: DataFrame | None = None,
                          run_id: str = "run", multi_line: bool = True) -> StructureLoad:
    raw, bad = JS.split_corrupt(JS.read_json_array(spark, json_path, JS.STRUCTURE_SCHEMA, multi_line), "neuroNamesID")
    # read once: structures, parents and synonyms come from the stored rows
    raw = stored(raw)
    st, par, syn = JS.structures_flat(raw)
    incoming = st.withColumnRenamed("neuronames_id", "key").select(
        "key", "standard_name", "standard_acronym", "definition", "brain_info_url", "structure_type", "ordinal")
    if existing is None:
        existing = spark.createDataFrame([], "key string, id long, standard_name string, standard_acronym string, "
                                             "definition string, brain_info_url string, structure_type string, "
                                             f"ordinal {JS.ORDINAL_TYPE}")
    structures = stored(U.upsert_last_wins(existing, incoming, "key", ["ordinal"]))     # K1/K2
    id_map = structures.select("key", "id")
    edges, missing = H.resolve_parents(par, id_map, store=True)                   # J3/J4/O6
    summary = stored(H.missing_parent_summary(missing))                           # A3
    top = H.top_missing(summary)                                                  # T1/T2
    synonyms = stored(H.resolve_synonyms(syn, id_map))                            # J5/E8
    log = QL.import_log(QL.totals(structures=(structures, "structures"), edges=(edges, "parent_links"),
                                  summary=(summary, "missing_parents"), synonyms=(synonyms, "synonyms")), run_id, "structures")   # A8/D3
    return StructureLoad(structures.withColumnRenamed("key", "neuronames_id"), edges, top, synonyms, log, bad)


@dataclass(frozen=True)
class RecordSpec:
    """A landed record: its key, the default of every field when its key is absent, and
    which fields are numbers, epoch-millisecond stamps or ISO stamps (a default stamp,
    like a bad one, is NULL)."""

    key: str
    defaults: dict[str, str]
    numbers: tuple[str, ...] = ()
    epoch: tuple[str, ...] = ()
    iso: tuple[str, ...] = ()


CONCEPTS = RecordSpec("concept_id", {
    "id": "No ID found", "name": "No Name found", "id_concept_class": "No Class", "definition_text": "No Definition",
    "creation_time": "0", "event_stamp": "No Event Stamp"}, ("creation_time",), epoch=("event_stamp",))
DISORDERS = RecordSpec("disorder_id", {
    "id": "No ID found", "name": "No Name found", "definition": "No Definition", "event_stamp": "No Event Stamp",
    "id_protocol": "No Protocol", "flag_for_curator": "0", "creation_time": "0", "last_updated": "0"},
    ("flag_for_curator", "creation_time", "last_updated"), iso=("event_stamp",))
TASKS = RecordSpec("task_id", {
    "id": "No ID found", "name": "No Name found", "definition_text": "No Definition", "alias": "No Alias",
    "creation_time": "0", "event_stamp": "No Event Stamp", "review_status": "No Review Status", "def_id": "No Def ID",
    "def_id_user": "No Def ID User", "def_event_stamp": "No Def Event Stamp"},
    ("creation_time",), iso=("event_stamp", "def_event_stamp"))


#: Why a landed line is in quarantine.
BROKEN, INCOMPLETE = "broken", "incomplete"


def landed_lines(spark: SparkSession, json_path: str) -> DataFrame:
    """``js, ordinal, whole`` of the lines of landed JSON text: one object per line, with or
    without the brackets and commas of an array around them.  ``whole`` tells an object that
    parses; anything else (a truncated object, another JSON value, plain text) stays as it is."""
    raw = JS.with_ordinal(spark.read.text(json_path, wholetext=False)).select(F.trim("value").alias("line"), "ordinal")
    raw = raw.where(~F.col("line").isin("", "[", "]"))
    js = F.rtrim(F.regexp_replace("line", r",\z", ""))
    raw = raw.select(js.alias("js"), "ordinal")
    return raw.withColumn("whole", F.coalesce(
        F.startswith("js", F.lit("{")) & F.endswith("js", F.lit("}")) & F.json_object_keys("js").isNotNull()
        # two objects on a line are no array of one
        & (F.json_array_length(F.concat(F.lit("["), F.col("js"), F.lit("]"))) == 1), F.lit(False)))


def filled_records(spark: SparkSession, json_path: str, defaults: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(each landed object with its *absent* keys filled with their default, the
    lines that are no object as ``record, reason, ordinal``)."""
    lines = landed_lines(spark, json_path)
    rec = lines.where("whole").select(*[FD.json_field(F.col("js"), k, F.lit(v)).alias(k) for k, v in defaults.items()], "js", "ordinal")
    return rec, lines.where("NOT whole").select(F.col("js").alias("record"), F.lit(BROKEN).alias("reason"), "ordinal")


def load_records(spark: SparkSession, path: str, spec: RecordSpec, existing: DataFrame | None = None):
    """(table after first-wins insert on the key, quarantine).

    The quarantine has ``record`` (the line), ``reason``, the key if there is one and ``ordinal``
    (its place): lines that are no JSON object, and objects without a key or a name.
    """
    rec, broken = filled_records(spark, path, spec.defaults)
    rec = rec.withColumnRenamed("id", spec.key)
    rec = rec.withColumns({**{c: F.col(c).try_cast("long") for c in spec.numbers},
                           **{c: FD.epoch_millis_to_timestamp(F.col(c)) for c in spec.epoch},
                           **{c: FD.iso_to_timestamp(F.col(c)) for c in spec.iso}})
    valid, bad = FD.split_valid(rec, [spec.key, "name"])
    valid = valid.drop("js")
    if existing is None:
        existing = valid.limit(0).drop("ordinal")
    table = U.insert_first_wins(existing, valid, spec.key, ["ordinal"])
    bad = broken.withColumn(spec.key, F.lit(None).cast("string")).unionByName(
        bad.select(F.col("js").alias("record"), F.lit(INCOMPLETE).alias("reason"), "ordinal", spec.key))
    return table.drop("ordinal") if "ordinal" in table.columns else table, bad


def load_concepts(spark: SparkSession, concepts_path: str, existing: DataFrame | None = None):
    """Concepts with their stamps."""
    return load_records(spark, concepts_path, CONCEPTS, existing)


def load_disorders(spark: SparkSession, path: str, existing: DataFrame | None = None):
    """Disorders; their names feed the gazetteer (``vocabulary_entries(diseases=...)``)."""
    return load_records(spark, path, DISORDERS, existing)


def load_tasks(spark: SparkSession, path: str, existing: DataFrame | None = None):
    """Tasks with both stamps."""
    return load_records(spark, path, TASKS, existing)


@dataclass
class DetailLoad:
    classes: DataFrame         # concept_class_id, name, description, display_order
    relationships: DataFrame   # concept_id, related_concept_id, relationship, direction
    quarantine: DataFrame      # record, key, ordinal: broken records and rows without a key


def load_concept_details(spark: SparkSession, details_path: str, concepts: DataFrame, multi_line: bool = True) -> DetailLoad:
    """Landed concept details -> classes and relationships of stored concepts."""
    raw, bad = JS.split_corrupt(JS.read_json_array(spark, details_path, JS.CONCEPT_DETAIL_SCHEMA, multi_line), "id")
    classes, rels, cons = JS.concept_details_flat(raw, concepts)
    return DetailLoad(U.upsert_concept_classes(classes), U.upsert_concept_relationships(rels, cons), bad)
