"""Brain-structure hierarchy loads: id resolution (J3-J5), missing-parent
report (A3, T1, T2), synonyms (E8), load totals (A8).

Structures, parent links and synonyms are flat DataFrames (the nested JSON
arrays are exploded at the scan, see :mod:`pagewright.sources.json_sources`).
The id map is a dimension (one row per structure) joined by key; whether it
is broadcast is Spark's choice, by its size in bytes, also at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.operators.partitioning import stored

TOP_MISSING = 10


def digits_or_zero(col: Column) -> Column:
    """An all-digit string as an int, anything else (or overflow) 0."""
    return F.coalesce(F.when(col.rlike(r"\A[0-9]+\z"), col.try_cast("int")), F.lit(0))


def resolve_parents(parents: DataFrame, id_map: DataFrame, store: bool = False):
    """J3 + J4 in one pass: returns (edges, missing).

    ``parents``: child_key, parent_key, parent_name, model_name, model_status, ordinal, pos.
    ``id_map``: key, id.  Children without an id are skipped (O6); parents
    without an id go to ``missing`` (one left join, split on null).  With ``store`` the
    join is written, so that both are read from its result and it runs once.
    """
    ids = id_map.select("key", "id")
    child = parents.join(ids.withColumnRenamed("key", "child_key").withColumnRenamed("id", "child_id"),
                         "child_key")
    both = child.join(ids.withColumnRenamed("key", "parent_key").withColumnRenamed("id", "parent_id"),
                      "parent_key", "left")
    if store:
        both = stored(both)
    edges = both.where(F.col("parent_id").isNotNull()).select(
        "child_id", "parent_id", F.coalesce("model_name", F.lit("")).alias("hierarchy_model_name"),
        F.coalesce("model_status", F.lit("")).alias("model_status"))
    missing = both.where(F.col("parent_id").isNull()).select(
        "parent_key", "parent_name", "model_name", "ordinal", "pos")
    return edges, missing


def missing_parent_summary(missing: DataFrame) -> DataFrame:
    """A3: per missing parent id, its count and the name/model of its first sighting."""
    first = F.min_by(F.struct(F.coalesce("parent_name", F.lit("Unknown")).alias("name"),
                              F.coalesce("model_name", F.lit("Unknown")).alias("model")),
                     F.struct("ordinal", "pos"))
    g = missing.groupBy("parent_key").agg(F.count(F.lit(1)).alias("count"), first.alias("f"),
                                          F.min(F.struct("ordinal", "pos")).alias("first_seen"))
    return g.select("parent_key", "count", F.col("f.name").alias("name"), F.col("f.model").alias("model"),
                    "first_seen")


def top_missing(summary: DataFrame, n: int = TOP_MISSING) -> DataFrame:
    """T1 + T2: the ``n`` most frequent missing parents (ties: first seen first),
    with the number of further distinct missing parents on every row."""
    top = summary.orderBy(F.desc("count"), F.asc("first_seen")).limit(n)
    total = summary.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).cast("long").alias("n_more"))
    return top.crossJoin(F.broadcast(total)).select("parent_key", "count", "name", "model", "n_more")   # one row


def resolve_synonyms(synonyms: DataFrame, id_map: DataFrame) -> DataFrame:
    """J5 + E8: synonyms of known structures with their id; hits parsed as digits or 0."""
    ids = id_map.select(F.col("key").alias("owner_key"), F.col("id").alias("brain_structure_id"))
    s = synonyms.join(ids, "owner_key")
    return s.select("brain_structure_id",
                    *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in
                      ("synonym_language", "organism", "synonym_name", "synonym_source", "source_title")],
                    digits_or_zero(F.col("pubmed_hits")).alias("pubmed_hit_count"))
