"""Test inputs derived from the driver tables.

The driver prose carries no headers, hyphen breaks, aliases or vocabulary
terms, so each fixture decorates a driver table with constant text chosen
by a key.  Every fixture is one SQL select list that both Spark
(``selectExpr``) and DuckDB accept, so the Spark query and the DuckDB oracle
read byte-identical inputs.  Work grows with the driver tables: every row of
the source table appears in the fixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagewright.operators.partitioning import spread
from pagewright.sources.tables import read_table


def sql_str(s: str) -> str:
    """A portable SQL expression for a Python string (quotes/newlines via chr)."""
    parts: list[str] = []
    buf = ""
    for ch in s:
        if ch in ("'", "\n"):
            if buf:
                parts.append(f"'{buf}'")
                buf = ""
            parts.append(f"chr({ord(ch)})")
        else:
            buf += ch
    if buf or not parts:
        parts.append(f"'{buf}'")
    return "(" + " || ".join(parts) + ")"


def case_by(key_sql: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {sql_str(v)}" for i, v in enumerate(values))
    return f"(CASE {key_sql} {whens} END)"


NL = "\n"

# Page decorations: (header, footer) around the conversation turn's text.
PAGE_DECOR = [
    ("Page 3 of 40\n", "\n17"),
    ("Journal of Clinical Neurology 2023\nVol. 12, No. 3\n",
     "\nCopyright 2023 The Authors\ndoi:10.1016/j.neuro.2023.01"),
    ("The amy-\nloid load was high in the hippo- campus.\n", "\nwww.neurojournal.org"),
    ("", ""),
    ("https://example.org/article\n\n", "\n\nReceived: 2020-01-05 Accepted: 2020-03-01"),
    ("Neurology 2021\n", "\nISSN 1234-5678"),
    ("Brain 42\nPatients (12) were re-\ncruited in 2019 (3).\n", ""),
    ("", "\nTau and p-tau were mea- sured in a-\nb-\nc.\nPage 7"),
]

# Article header blocks (title / authors / affiliation / journal / DOI / date).
ARTICLE_HEADERS = [
    "Amyloid and tau imaging in early disease\n\nJane Smith, Tom Brown and Ann Lee\n"
    "Department of Neurology, University of Oslo\n\nJournal of Neuroscience. Published: 2021-03-15\n"
    "doi:10.1523/JNEUROSCI.1234-20.2021\n\n",
    "Abstract\n\nWe review memory. Received March 7, 2021\n\n",
    "Synuclein pathology in the brainstem.\n\nMaria Garcia 1, Li Wei 2\n\n"
    "Brain Research, vol. 12\nhttps://doi.org/10.1016/j.brainres.2019.05.003\nAccepted: Feb 2019\n\n",
    "Short\n\nby Alan Turing and friends. Neurology Letters, 45(3)\n(c) 2018 Elsevier Ltd\n\n",
    "",
    "Cognitive decline in Parkinson's disease: a review;\n\n"
    "Published in Movement Disorders. Date: June 5, 2020\n\n",
    "ABSTRACT: we studied memory\n\nSecond paragraph of the front matter\n\n",
    "Tau PET in the temporal lobe,\n\nCopyright 2017, 2019 Society for Neuroscience\n\n",
]

# Sentences carrying vocabulary terms and parenthesised aliases.
ARTICLE_SENTENCES = [
    "In most cohorts Alzheimer's disease (AD) begins years before any complaint. Levels of tau "
    "and p-tau rise first, and each is a biomarker measured near the hippocampus and temporal lobe.",
    "A clinical picture (what the ward sees) and its cause (what the tissue shows) can differ. "
    "Neuropathologic findings settle the matter after death; before it, AD is often read from "
    "biomarkers alone.",
    "Patients with Parkinson's disease (PD) showed tremor and bradykinesia; alpha-synuclein "
    "was found in the substantia nigra.",
    "Mild Cognitive Impairment (MCI) often precedes Alzheimer disease, with episodic memory "
    "loss and working memory deficits in the prefrontal cortex.",
    "Cerebrospinal Fluid (CSF) levels of Amyloid beta and TDP-43 were measured by positron "
    "emission tomography (PET) and MRI.",
    "Frontotemporal Dementia (FTD) presents with apathy, disinhibition and executive "
    "dysfunction linked to the frontal lobe.",
    "Neurofilament light chain (NfL) and APOE4 are biomarkers of cognitive decline in the "
    "entorhinal cortex and the amygdala.",
    "Huntington's disease (HD) causes chorea, depression and anxiety through damage to the "
    "basal ganglia and thalamus.",
]

# Frequent function words of the driver prose, added to the fixture vocabulary
# so that matching does real work on every document.
FREQUENT_WORDS = [("TERM", "the"), ("TERM", "and"), ("TERM", "des"), ("TERM", "der")]


def fx_pages_select() -> list[str]:
    k = "((conv_id + turn) % 8)"
    header = case_by(k, [h for h, _ in PAGE_DECOR])
    footer = case_by(k, [f for _, f in PAGE_DECOR])
    return ["conv_id AS doc_id", "turn AS page_num",
            f"{header} || text || {footer} AS page_text"]


def fx_articles_select() -> list[str]:
    k = "(doc_id % 8)"
    return ["doc_id",
            f"{case_by(k, ARTICLE_HEADERS)} || text || chr(10) || chr(10) || "
            f"{case_by(k, ARTICLE_SENTENCES)} AS text"]


def fx_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "conversations").selectExpr(*fx_pages_select()), "doc_id")


def fx_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents").selectExpr(*fx_articles_select()), "doc_id")


# DuckDB CTE text for the same fixtures.
def cte(name: str, select: list[str], table: str) -> str:
    return f"{name} AS (SELECT {', '.join(select)} FROM {table})"


def fx_pages_cte() -> str:
    return cte("fx_pages", fx_pages_select(), "conversations")


def fx_articles_cte() -> str:
    return cte("fx_articles", fx_articles_select(), "documents")


def fx_vocab_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extra terms (X3): frequent prose words plus every part name of the driver table."""
    from pyspark.sql import functions as F
    words = spark.createDataFrame(FREQUENT_WORDS, "label string, name string")
    parts = read_table(spark, sf_dir, "part").select(F.lit("PART").alias("label"), F.col("p_name").alias("name"))
    return words.unionByName(parts)


def fx_vocab_extra_sql() -> str:
    vals = ", ".join(f"('{a}', '{b}')" for a, b in FREQUENT_WORDS)
    return f"SELECT * FROM (VALUES {vals}) t(label, name) UNION ALL SELECT 'PART', p_name FROM part"


# ---------------------------------------------------------------- P3 fixtures
def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


STRUCTURE_SELECTS = {
    "customer": [f"'C' || {_s('c_custkey')} AS neuronames_id", "c_name AS standard_name",
                 "c_mktsegment AS standard_acronym", "'Structure ' || c_name AS definition",
                 f"'http://brain.example/c' || {_s('c_custkey')} AS brain_info_url",
                 "c_mktsegment AS structure_type", "CAST(c_custkey AS BIGINT) + 1000 AS ordinal"],
    "nation": [f"'N' || {_s('n_nationkey')}", "n_name", "substr(n_name, 1, 3)", "'Nation ' || n_name",
               f"'http://brain.example/n' || {_s('n_nationkey')}", "'nation'",
               "CAST(n_nationkey AS BIGINT) + 100"],
    "region": [f"'R' || {_s('r_regionkey')}", "r_name", "substr(r_name, 1, 3)", "'Region ' || r_name",
               f"'http://brain.example/r' || {_s('r_regionkey')}", "'region'", "CAST(r_regionkey AS BIGINT)"],
}
# Parent links (one row per element of a structure's parents list).
PARENT_SELECTS = [
    ("customer", [f"'C' || {_s('c_custkey')} AS child_key", f"'N' || {_s('c_nationkey')} AS parent_key",
                  "'nation ' || " + _s("c_nationkey") + " AS parent_name", "'geo' AS model_name",
                  "'current' AS model_status", "CAST(c_custkey AS BIGINT) + 1000 AS ordinal", "0 AS pos"]),
    ("customer", [f"'C' || {_s('c_custkey')}",
                  f"CASE WHEN c_custkey % 5 = 4 THEN 'X' || {_s('c_custkey % 7')} "
                  f"ELSE 'C' || {_s('CAST(FLOOR(c_custkey / 2) AS BIGINT)')} END",
                  f"CASE WHEN c_custkey % 5 = 4 THEN 'Lost ' || {_s('c_custkey % 7')} ELSE 'parent' END",
                  "'tree'", "'current'", "CAST(c_custkey AS BIGINT) + 1000", "1"]),
    ("nation", [f"'N' || {_s('n_nationkey')}",
                f"CASE WHEN n_nationkey % 5 = 4 THEN 'Z' || {_s('n_nationkey')} ELSE 'R' || {_s('n_regionkey')} END",
                "'region'", "'geo'", "'current'", "CAST(n_nationkey AS BIGINT) + 100", "0"]),
]
SYNONYM_SELECT = [f"'C' || {_s('p_partkey')} AS owner_key", "'en' AS synonym_language",
                  "CASE p_partkey % 3 WHEN 0 THEN 'human' WHEN 1 THEN 'mouse' ELSE 'rat' END AS organism",
                  "p_name AS synonym_name", "p_brand AS synonym_source", "p_type AS source_title",
                  f"CASE WHEN p_partkey % 7 = 0 THEN 'n/a' ELSE {_s('p_size')} END AS pubmed_hits"]
UPDATE_SELECT = ["o_custkey AS key", "o_orderkey AS ordinal", "o_orderstatus || '-' || o_orderpriority AS value",
                 "o_orderdate < TIMESTAMP '1995-01-01 00:00:00' AS is_old"]
CLASS_SELECT = ["p_type AS concept_class_id", "p_brand AS name", "p_name AS description",
                "p_size AS display_order", "p_partkey AS concept_ordinal", "0 AS pos"]
REL_SELECT = [f"'P' || {_s('l_partkey')} AS concept_id", f"'S' || {_s('l_suppkey')} AS related_concept_id",
              "l_returnflag AS relationship", "l_linestatus AS direction",
              "l_orderkey * 8 + l_linenumber AS pos", "l_partkey"]
CONTRAST_SELECT = [f"'P' || {_s('l_partkey')} AS concept_id", f"'S' || {_s('l_suppkey')} AS task_id",
                   "'contrast ' || l_returnflag AS relationship", "l_orderkey * 8 + l_linenumber AS pos",
                   "l_partkey", "l_quantity"]
CONCEPT_JSON = (
    f"CASE WHEN event_id % 31 = 4 THEN '{{\"id\": \"cut ' || {_s('event_id')} WHEN event_id % 31 = 6 THEN 'e' || {_s('event_id')} "
    f"ELSE CASE event_id % 3 WHEN 0 THEN '{{\"id\": \"e' || {_s('event_id')} || '\", \"name\": \"' || event_type || "
    f"'\", \"id_concept_class\": \"' || {_s('user_id')} || '\"}}' "
    f"WHEN 1 THEN '{{\"id\": \"e' || {_s('event_id')} || '\", \"definition_text\": \"' || event_type || '\"}}' "
    f"ELSE '{{\"id\": \"e' || {_s('event_id')} || '\", \"name\": null, \"id_concept_class\": null}}' END END AS js")


def _union(spark, sf_dir, pieces):
    from functools import reduce
    dfs = [read_table(spark, sf_dir, t).selectExpr(*sel) for t, sel in pieces]
    return reduce(lambda a, b: a.union(b), dfs)


def _union_sql(pieces):
    return " UNION ALL ".join(f"SELECT {', '.join(sel)} FROM {t}" for t, sel in pieces)


def fx_structures(spark, sf_dir):
    return _union(spark, sf_dir, list(STRUCTURE_SELECTS.items()))


def fx_structures_cte():
    return f"fx_structures AS ({_union_sql(list(STRUCTURE_SELECTS.items()))})"


def fx_parents(spark, sf_dir):
    return _union(spark, sf_dir, PARENT_SELECTS)


def fx_parents_cte():
    return f"fx_parents AS ({_union_sql(PARENT_SELECTS)})"


def fx_synonyms(spark, sf_dir):
    return read_table(spark, sf_dir, "part").selectExpr(*SYNONYM_SELECT)


def fx_synonyms_cte():
    return cte("fx_synonyms", SYNONYM_SELECT, "part")


def fx_updates(spark, sf_dir):
    return read_table(spark, sf_dir, "orders").selectExpr(*UPDATE_SELECT)


def fx_updates_cte():
    return cte("fx_updates", UPDATE_SELECT, "orders")


def fx_classes(spark, sf_dir):
    return read_table(spark, sf_dir, "part").selectExpr(*CLASS_SELECT)


def fx_classes_cte():
    return cte("fx_classes", CLASS_SELECT, "part")


def fx_relationships(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").selectExpr(*REL_SELECT)


def fx_contrasts(spark, sf_dir):
    return read_table(spark, sf_dir, "lineitem").selectExpr(*CONTRAST_SELECT)


def fx_concept_json(spark, sf_dir):
    return read_table(spark, sf_dir, "events").selectExpr(CONCEPT_JSON)


def fx_concept_json_cte():
    return cte("fx_concepts", [CONCEPT_JSON], "events")


# Person names for the name-masking fixture: the author names of the article
# headers plus every customer name of the driver table.
PERSON_NAMES = ["Jane Smith", "Tom Brown", "Ann Lee", "Maria Garcia", "Li Wei", "Alan Turing"]


def fx_person_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F
    names = spark.createDataFrame([("PERSON", n) for n in PERSON_NAMES], "label string, name string")
    cust = read_table(spark, sf_dir, "customer").select(F.lit("PERSON").alias("label"), F.col("c_name").alias("name"))
    return names.unionByName(cust)


def fx_person_names_sql() -> str:
    vals = ", ".join(f"('PERSON', '{n}')" for n in PERSON_NAMES)
    return (f"SELECT label, name, 'extra' AS source FROM (SELECT * FROM (VALUES {vals}) t(label, name) "
            f"UNION ALL SELECT 'PERSON', c_name FROM customer) u WHERE name IS NOT NULL AND length(name) > 1")


def fx_structures_json(spark: SparkSession, sf_dir: str) -> str:
    """Write the structure fixture as nested JSON Lines (parents and synonyms as
    arrays, like the landed source) under the shared checkpoint folder; returns the path."""
    import uuid

    from pyspark.sql import functions as F

    from pagewright.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark)
    st = fx_structures(spark, sf_dir)
    par = fx_parents(spark, sf_dir).groupBy("child_key").agg(F.sort_array(F.collect_list(F.struct(
        "pos", F.struct(F.col("parent_key").alias("parentNeuroNamesId"),
                        F.col("parent_name").alias("parentStandardName"),
                        F.col("model_name").alias("modelName"),
                        F.col("model_status").alias("modelStatus")).alias("p")))).alias("ps"))
    syn = fx_synonyms(spark, sf_dir).groupBy("owner_key").agg(F.collect_list(F.struct(
        F.col("synonym_language").alias("synonymLanguage"), F.col("organism").alias("organism"),
        F.col("synonym_name").alias("synonymName"), F.col("synonym_source").alias("synonymSource"),
        F.col("source_title").alias("synonymSourceTitle"), F.col("pubmed_hits").alias("pubMedHits"))).alias("syns"))
    doc = (st.join(par, st["neuronames_id"] == par["child_key"], "left")
           .join(syn, st["neuronames_id"] == syn["owner_key"], "left")
           .select(F.col("neuronames_id").alias("neuroNamesID"), F.col("standard_name").alias("standardName"),
                   F.col("standard_acronym").alias("standardAcronym"), F.col("definition").alias("cDefinition"),
                   F.col("brain_info_url").alias("brainInfoURL"), F.col("structure_type").alias("brainStructureType"),
                   F.transform("ps", lambda x: x["p"]).alias("parents"), F.col("syns").alias("synonyms"), "ordinal")
           .orderBy("ordinal").drop("ordinal"))
    path = f"{base.rstrip('/')}/fixtures/structures_{uuid.uuid4().hex}"
    doc.write.mode("overwrite").json(path)
    return path


def _json_line(prefix: str, *parts: str) -> str:
    """A record as JSON text: id (null in some) and name (null in every fifth), then parts that
    may be absent; some lines are cut off, arrays, plain text, empty or an array's brackets, and some
    end with its comma."""
    whole = (f"'{{\"id\": ' || CASE WHEN event_id % 23 = 7 THEN 'null' ELSE '\"{prefix}' || {_s('user_id')} || '\"' END || ', \"name\": ' || "
             "CASE WHEN event_id % 5 = 0 THEN 'null' ELSE '\"' || event_type || '\"' END || "
             + " || ".join(parts) + " || '}'")
    return (f"CASE event_id % 29 WHEN 3 THEN substr({whole}, 1, 24) WHEN 9 THEN '[' || {whole} || ']' WHEN 14 THEN 'no record, ' || event_type "
            f"WHEN 17 THEN '' WHEN 18 THEN '[' WHEN 19 THEN '  ]' WHEN 20 THEN '\"text\"' WHEN 21 THEN ' ' || {whole} || ' ,' ELSE {whole} END AS js")


def _stamp_part(key: str, valid: str, shift: int = 0) -> str:
    return (f"CASE (event_id + {shift}) % 4 WHEN 0 THEN ', \"{key}\": \"{valid}\"' WHEN 1 THEN ', \"{key}\": \"bad\"' "
            f"WHEN 2 THEN ', \"{key}\": null' ELSE '' END")


_DEFINED = "CASE WHEN event_id % 3 = 0 THEN '' ELSE ', \"{}\": \"' || event_type || '\"' END"
_CREATED = f"CASE WHEN event_id % 7 < 3 THEN '' ELSE ', \"creation_time\": ' || {_s('event_id')} END"
CONCEPT_LINE = _json_line("c", _DEFINED.format("definition_text"), _CREATED, _stamp_part("event_stamp", "1304416800000"))
DISORDER_LINE = _json_line("d", _DEFINED.format("definition"), _CREATED, _stamp_part("event_stamp", "2011-05-03T10:00:00+00:00"))
TASK_LINE = _json_line("t", _DEFINED.format("alias"), _CREATED, _stamp_part("event_stamp", "2012-11-03T22:30:00+02:00"),
                       _stamp_part("def_event_stamp", "2013-01-31T00:15:30Z", 1))


def fx_landed(spark: SparkSession, sf_dir: str, line: str) -> str:
    """Records as landed JSON text (one object per line, in event order, over eight files
    of unequal size) under the shared checkpoint folder; ids repeat per user, some names are null."""
    import uuid

    from pyspark.sql import functions as F

    from pagewright.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fixtures/landed_{uuid.uuid4().hex}"
    events = read_table(spark, sf_dir, "events")
    # part k holds the events up to (k + 1)^2 / 64 of all, part -1 those without an id: one job, dealt and
    # ordered by id, so the names of a part's files follow the order of its events
    top = events.agg(F.max("event_id")).first()[0] or 0
    part = F.coalesce(F.floor(F.sqrt(F.col("event_id") * 64.0 / (top + 1))).cast("int"), F.lit(-1))
    rows = events.selectExpr("event_id", line).withColumn("part", part)
    rows.repartitionByRange("part", "event_id").sortWithinPartitions("part", "event_id").select("js", "part").write.partitionBy("part").text(path)
    return path


# Concept details as the landed source nests them: a part is a concept, its line items relate it to suppliers.
DETAIL_SELECT = ["'P' || CAST(p_partkey AS STRING) AS id", "p_type AS class_id", "p_brand AS class_name", "p_name AS class_description",
                 "CAST(p_size AS STRING) AS class_order", "p_partkey"]


def fx_details_json(spark: SparkSession, sf_dir: str) -> str:
    """Concept details as nested JSON Lines: classes, relationships and contrasts as arrays, in
    order; every seventh concept has no id, and broken lines stand between."""
    import uuid

    from pyspark.sql import functions as F

    from pagewright.session import ensure_checkpoint_dir
    part = read_table(spark, sf_dir, "part").selectExpr(*DETAIL_SELECT)
    li = read_table(spark, sf_dir, "lineitem").selectExpr(*REL_SELECT)
    rel = li.groupBy("l_partkey").agg(F.sort_array(F.collect_list(F.struct("pos", "related_concept_id", "relationship", "direction"))).alias("rs"))
    doc = part.join(rel, part["p_partkey"] == rel["l_partkey"], "left")
    js = F.to_json(F.struct(
        F.when(F.col("p_partkey") % 7 != 0, F.col("id")).alias("id"),
        F.array(F.struct(F.col("class_id").alias("id"), F.col("class_name").alias("name"), F.col("class_description").alias("description"),
                         F.col("class_order").alias("display_order"))).alias("conceptclasses"),
        F.transform("rs", lambda r: F.struct(r["related_concept_id"].alias("id"), r["relationship"], r["direction"])).alias("relationships"),
        F.transform(F.filter("rs", lambda r: r["pos"] % 3 == 0), lambda r: F.struct(
            r["related_concept_id"].alias("task_id"), F.concat(F.lit("contrast "), r["relationship"]).alias("relationship"))).alias("contrasts")))
    line = F.when(F.col("p_partkey") % 11 == 5, F.substring(js, 1, 30)).otherwise(js)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fixtures/details_{uuid.uuid4().hex}"
    doc.repartitionByRange("p_partkey").sortWithinPartitions("p_partkey").select(line.alias("value")).write.text(path)
    return path
