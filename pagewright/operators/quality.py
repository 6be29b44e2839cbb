"""Data-quality operators for the region vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.operators.upsert import latest_per_key


def merge_region_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """Union of region tables tagged with their source; one row per
    (source, region_key), the last by ``ordinal`` wins.

    Each input has ``region_key, name, parent_name, ordinal``.
    """
    parts = [df.select(F.lit(src).alias("source"), "region_key", "name", "parent_name", "ordinal")
             for src, df in sources.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return latest_per_key(u, ["source", "region_key"], ["ordinal"]).drop("ordinal")


def _long(row: DataFrame, name: str) -> DataFrame:
    """One row of totals as rows ``name, n``."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("n"))
                                          for c in row.columns])).alias("m")).select("m.*")


def totals(**tables: tuple[DataFrame, str]) -> DataFrame:
    """``metric, n``, the number of rows of each table under its metric's name."""
    out = None
    for df, name in tables.values():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def validate_regions(structures: DataFrame, parents: DataFrame, key: str = "neuronames_id",
                     required: tuple[str, ...] = ("neuronames_id", "standard_name")) -> DataFrame:
    """One row per check with the number of offending records.

    required-field nulls, duplicate keys, dangling parent links, self-parent links: both
    tables are read once, grouped by key, met in one full join, and summed in one aggregate.
    A link without a parent key is dangling.
    """
    nulls = None
    for c in required:
        cond = F.col(c).isNull()
        nulls = cond if nulls is None else nulls | cond
    have = structures.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.sum(nulls.cast("long")).alias("_null"))
    used = parents.groupBy("parent_key").agg(F.count(F.lit(1)).alias("_links"),
                                             F.sum((F.col("child_key") == F.col("parent_key")).cast("long")).alias("_self"))
    both = have.join(used, have["_key"] == used["parent_key"], "full")
    row = both.agg(F.sum("_null").alias("required_null"), F.sum((F.col("_n") > 1).cast("long")).alias("duplicate_key"),
                   F.sum(F.when(F.col("_n").isNull(), F.col("_links"))).alias("dangling_parent"), F.sum("_self").alias("self_parent"))
    return _long(row, "check")


def import_log(counts: DataFrame, run_id: str, source: str) -> DataFrame:
    """D3: load totals (metric, n) tagged with a run id and source, ready to append."""
    return counts.select(F.lit(run_id).alias("run_id"), F.lit(source).alias("source"), "metric", "n")


def append_log(log: DataFrame, path: str) -> None:
    """D3: add a run's totals to the log below ``path``.  Each run id has a folder of its own,
    which a rerun of the run replaces, so a run is in the log once."""
    log.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "source").parquet(path)


def profile_structures(structures: DataFrame, parents: DataFrame, synonyms: DataFrame,
                       key: str = "neuronames_id") -> DataFrame:
    """Entry count, entries with parents, entries with synonyms, distinct parent ids.

    Every table is read once: its keys are tagged with what they say, and one grouping by key
    and one aggregate give all four numbers.
    """
    tag = lambda c, what: F.struct(F.col(c).cast("string").alias("k"), F.lit(what).alias("w"))
    rows = structures.select(tag(key, "s").alias("t")).unionByName(
        parents.select(F.explode(F.array(tag("child_key", "c"), tag("parent_key", "p"))).alias("t"))).unionByName(
        synonyms.select(tag("owner_key", "y").alias("t")))
    has = lambda what: F.count(F.when(F.col("t.w") == what, 1))
    by = rows.groupBy(F.col("t.k").alias("k")).agg(has("s").alias("s"), has("c").alias("c"), has("p").alias("p"), has("y").alias("y"))
    known = F.col("k").isNotNull()
    row = by.agg(F.sum("s").alias("entries"), F.sum((known & (F.col("s") > 0) & (F.col("c") > 0)).cast("long")).alias("with_parents"),
                 F.sum((known & (F.col("s") > 0) & (F.col("y") > 0)).cast("long")).alias("with_synonyms"),
                 F.sum((known & (F.col("p") > 0)).cast("long")).alias("distinct_parent_ids"))
    return _long(row, "metric")


def sample_entries(structures: DataFrame, parents: DataFrame, synonyms: DataFrame, n: int = 10,
                   key: str = "neuronames_id") -> DataFrame:
    """The first ``n`` entries (by ordinal) flagged with whether they have
    parents / synonyms.  The limit is the feature (a profile sample)."""
    first = structures.orderBy("ordinal").limit(n)
    par = parents.select(F.col("child_key").alias(key)).distinct().withColumn("has_parents", F.lit(True))
    syn = synonyms.select(F.col("owner_key").alias(key)).distinct().withColumn("has_synonyms", F.lit(True))
    out = first.join(par, key, "left").join(syn, key, "left")
    return out.fillna(False, ["has_parents", "has_synonyms"])
