"""Sharding of records by weighted rendezvous hashing, as DataFrame expressions.

Every record key draws one uniform number per shard from a hash of (key, shard),
and goes to the shard with the highest ``-weight / ln(u)``.  A shard wins a share
of the keys in proportion to its weight, and a new shard can only win keys for
itself: no record moves between two old shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash groups into which the rows of a shard are dealt to number them.
SLOT_GROUPS = 1024


def uniform(text: Column) -> Column:
    """A number in (0, 1) from the first 13 hexadecimal digits of the MD5."""
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _bid(key: Column, shard: Column, weight: Column) -> Column:
    return weight / -F.log(uniform(F.concat(key, F.lit(":"), shard.cast("string"))))


def with_shard(df: DataFrame, key: Column, weights: list[float], grown_weight: float = 1.0,
               shard_col: str = "shard", grown_col: str = "grown_shard") -> DataFrame:
    """``df`` with its shard among ``len(weights)``, and the shard it would have if
    one more, of ``grown_weight``, were added.  A null key counts as the key ``null``;
    equal bids go to the lower shard.  Weights must be positive."""
    if not weights or min(weights) <= 0 or grown_weight <= 0:
        raise ValueError("every shard needs a weight above 0")
    k = F.coalesce(key.cast("string"), F.lit("null"))
    shards = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(w)).alias("w")) for j, w in enumerate(weights)])
    best = F.array_max(F.transform(shards, lambda s: F.struct(
        _bid(F.col("_key"), s["j"], s["w"]).alias("bid"), (-s["j"]).alias("neg"))))
    grown = _bid(F.col("_key"), F.lit(len(weights)), F.lit(float(grown_weight)))
    return (df.withColumn("_key", k).withColumn("_best", best)
            .withColumn(grown_col, F.when(grown > F.col("_best.bid"), F.lit(len(weights)))
                        .otherwise(-F.col("_best.neg")).cast("int"))
            .withColumn(shard_col, (-F.col("_best.neg")).cast("int"))
            .drop("_key", "_best"))


def shard_records(docs: DataFrame, weights: list[float], grown_weight: float = 1.0,
                  slot_groups: int = SLOT_GROUPS) -> DataFrame:
    """Shard, slot in the shard and digest of every row of ``docs``.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; other
    columns of ``docs`` are left out, whatever their names.  Size is the UTF-8
    length of the text plus 16 (null text: 16, checksum 0).  Slots number a shard's
    rows from 0 without a gap, in the order of a hash group, then doc_id.  Equal
    rows are counted before they are shuffled and expanded after it; rows with a
    null doc_id share a shard, and their slot groups differ with the text.  An
    empty table gives an empty result.

    Only the narrow rows are shuffled.  No task numbers a whole shard: rows are
    numbered per (shard, hash group), and the groups' offsets come from their
    counts, at most ``len(weights) * slot_groups`` rows, which bounds the broadcast.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 16).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_copies"))
    rows = with_shard(rows, F.col("doc_id"), weights, grown_weight)
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                               F.col("text_crc32").cast("string")))
    rows = rows.withColumn("_group", (F.conv(F.substring(digest, 1, 6), 16, 10).cast("int") % slot_groups))

    before = Window.unboundedPreceding, -1
    groups = rows.groupBy("shard", "_group").agg(F.sum("_copies").alias("_n"))
    groups = groups.select("shard", "_group", F.coalesce(F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_group").rowsBetween(*before)), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("shard", "_group").orderBy("doc_id", "text_crc32", "size").rowsBetween(*before)
    rows = rows.withColumn("_first", F.coalesce(F.sum("_copies").over(inside), F.lit(0)))
    out = rows.join(F.broadcast(groups), ["shard", "_group"])
    # equal rows are expanded in runs, so that no array grows with their number
    run = 4096
    out = out.withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / run))))
    last = F.least(F.col("_copies") - 1, F.col("_run") * run + run - 1)
    out = out.withColumn("_i", F.explode(F.sequence(F.col("_run") * run, last)))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                      (F.col("_base") + F.col("_first") + F.col("_i")).cast("long").alias("slot"), "grown_shard")
