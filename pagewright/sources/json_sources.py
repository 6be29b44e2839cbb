"""Landed JSON sources with explicit schemas (S4-S8) and the labelled-token file.

Ids are read as STRING so numeric and text ids meet in the same key space.
Nested arrays are exploded here, with their position, so every later step
works on flat rows and can carry an explicit ordinal ("first/last wins").
Corrupt records and rows without a key go to a quarantine frame instead of
failing the load or becoming data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()

STRUCTURE_SCHEMA = T.StructType([
    T.StructField("neuroNamesID", S), T.StructField("standardName", S),
    T.StructField("standardAcronym", S), T.StructField("cDefinition", S),
    T.StructField("brainInfoURL", S), T.StructField("brainStructureType", S),
    T.StructField("parents", T.ArrayType(T.StructType([
        T.StructField("parentNeuroNamesId", S), T.StructField("parentStandardName", S),
        T.StructField("modelName", S), T.StructField("modelStatus", S)]))),
    T.StructField("synonyms", T.ArrayType(T.StructType([
        T.StructField("synonymLanguage", S), T.StructField("organism", S),
        T.StructField("synonymName", S), T.StructField("synonymSource", S),
        T.StructField("synonymSourceTitle", S), T.StructField("pubMedHits", S)]))),
])
CONCEPT_SCHEMA = T.StructType([T.StructField(c, S) for c in
                               ("id", "name", "id_concept_class", "definition_text")] +
                              [T.StructField("creation_time", T.LongType()), T.StructField("event_stamp", S)])
DISORDER_SCHEMA = T.StructType([T.StructField(c, S) for c in
                                ("id", "name", "definition", "event_stamp", "id_protocol")] +
                               [T.StructField("flag_for_curator", T.IntegerType()),
                                T.StructField("creation_time", T.LongType()),
                                T.StructField("last_updated", T.LongType())])
TASK_SCHEMA = T.StructType([T.StructField(c, S) for c in
                            ("id", "name", "definition_text", "alias")] +
                           [T.StructField("creation_time", T.LongType())] +
                           [T.StructField(c, S) for c in
                            ("event_stamp", "review_status", "def_id", "def_id_user", "def_event_stamp")])
CONCEPT_DETAIL_SCHEMA = T.StructType([
    T.StructField("id", S),
    T.StructField("conceptclasses", T.ArrayType(T.StructType([
        T.StructField("id", S), T.StructField("name", S), T.StructField("description", S),
        T.StructField("display_order", S)]))),
    T.StructField("relationships", T.ArrayType(T.StructType([
        T.StructField("id", S), T.StructField("relationship", S), T.StructField("direction", S)]))),
    T.StructField("contrasts", T.ArrayType(T.StructType([
        T.StructField("task_id", S), T.StructField("relationship", S)]))),
])


CORRUPT = "_corrupt_record"
#: Place of a landed row: file, byte at which its split begins, row inside the split.
ORDINAL_TYPE = "struct<file:string,block:bigint,row:bigint>"


def with_ordinal(df: DataFrame) -> DataFrame:
    """``df`` (a file scan) with ``ordinal``, which orders rows by file name, then by place in
    the file.  Spark packs files and splits into partitions by size, so a row number
    over partitions alone does not follow file order; within one split it does."""
    return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"),
                                   F.col("_metadata.file_block_start").alias("block"),
                                   F.monotonically_increasing_id().alias("row")).alias("ordinal"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Landed JSON with an explicit schema; ``ordinal`` = (file, position) order.

    ``multi_line=True`` reads files that each hold one JSON array of objects (one task
    per file); ``False`` reads JSON Lines (one object per line, splittable).  The text of
    a broken record is in ``_corrupt_record``; see :func:`split_corrupt`.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, S)])
    df = (spark.read.schema(full).option("multiLine", multi_line).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return with_ordinal(df)


def split_corrupt(raw: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, quarantined rows): broken records and rows without a key
    never become data.  The quarantine keeps the record's text, key and place."""
    bad = F.col(CORRUPT).isNotNull() | F.col(key).isNull()
    text = F.coalesce(CORRUPT, F.to_json(F.struct(*[c for c in raw.columns if c not in (CORRUPT, "ordinal")])))
    return raw.where(~bad).drop(CORRUPT), raw.where(bad).select(text.alias("record"), F.col(key).alias("key"), "ordinal")


def structures_flat(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S4 + E13: (structures, parents, synonyms) as flat rows; absent arrays give no rows."""
    st = raw.select(F.col("neuroNamesID").alias("neuronames_id"), F.col("standardName").alias("standard_name"),
                    F.col("standardAcronym").alias("standard_acronym"), F.col("cDefinition").alias("definition"),
                    F.col("brainInfoURL").alias("brain_info_url"),
                    F.col("brainStructureType").alias("structure_type"), "ordinal")
    par = raw.select(F.col("neuroNamesID").alias("child_key"), "ordinal",
                     F.posexplode("parents").alias("pos", "p")).select(
        "child_key", F.col("p.parentNeuroNamesId").alias("parent_key"),
        F.col("p.parentStandardName").alias("parent_name"), F.col("p.modelName").alias("model_name"),
        F.col("p.modelStatus").alias("model_status"), "ordinal", "pos")
    syn = raw.select(F.col("neuroNamesID").alias("owner_key"), F.explode("synonyms").alias("s")).select(
        "owner_key", F.col("s.synonymLanguage").alias("synonym_language"), F.col("s.organism").alias("organism"),
        F.col("s.synonymName").alias("synonym_name"), F.col("s.synonymSource").alias("synonym_source"),
        F.col("s.synonymSourceTitle").alias("source_title"), F.col("s.pubMedHits").alias("pubmed_hits"))
    return st, par, syn


def concept_details_flat(details: DataFrame, concepts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S8 + J6: (classes, relationships, contrasts) of stored concepts only."""
    d = details.join(concepts.select(F.col("concept_id").alias("id")), "id").withColumnRenamed("id", "concept_id")
    classes = d.select("concept_id", "ordinal", F.posexplode("conceptclasses").alias("pos", "c")).select(
        F.col("c.id").alias("concept_class_id"), F.col("c.name").alias("name"),
        F.col("c.description").alias("description"), F.col("c.display_order").alias("display_order"),
        F.col("ordinal").alias("concept_ordinal"), "pos")
    rels = d.select("concept_id", F.posexplode("relationships").alias("pos", "r")).select(
        "concept_id", F.col("r.id").alias("related_concept_id"), F.col("r.relationship").alias("relationship"),
        F.col("r.direction").alias("direction"), "pos")
    cons = d.select("concept_id", F.posexplode("contrasts").alias("pos", "c")).select(
        "concept_id", F.col("c.task_id").alias("task_id"), F.col("c.relationship").alias("relationship"), "pos")
    return classes, rels, cons


def read_labelled_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The bracketed one-object-per-line label file -> (line, pos, token, ner_tag).

    The file is not valid JSON (no commas between objects), so it is read as
    text and each object line parsed on its own.
    """
    from pagewright.sources.vocab import LABELLED_TOKEN_SCHEMA
    lines = with_ordinal(spark.read.text(path)).select(F.trim("value").alias("v"), F.col("ordinal").alias("line"))
    objs = lines.where(F.col("v").startswith("{")).select("line", F.from_json("v", LABELLED_TOKEN_SCHEMA).alias("o"))
    return explode_tagged(objs.select(F.col("line").alias("item_id"), "o.tokens", "o.ner_tags"))


def explode_tagged(df: DataFrame) -> DataFrame:
    """(item_id, tokens[], ner_tags[]) -> one row per token with its tag."""
    z = df.select("item_id", F.posexplode(F.arrays_zip("tokens", "ner_tags")).alias("pos", "z"))
    return z.select("item_id", "pos", F.col("z.tokens").alias("token"), F.col("z.ner_tags").alias("ner_tag"))
