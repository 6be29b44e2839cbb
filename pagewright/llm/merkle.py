"""Merkle manifest of a dataset, by a rollup of nested structs.

A row is a leaf.  Within a group, leaves ascend and have a rank, whose digits (to the base
of the tree's arity) become columns; grouping by all digits but the lowest joins each run
of siblings into a struct that holds its children, and so on, until one nested struct holds
a bounded block of leaves.  Blocks are the leaves of the next, far smaller rollup.  One
transform of the nested structs, from the top down, gives every leaf its path, and an
explode emits it: within a block there is no join, and a block meets what is above it once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import written

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A block holds the leaves below a node of so many levels, or fewer where all groups have fewer.
DIGITS = 10
#: Tables of up to so many bytes are broadcast: first ranks, and what is above each block.
BROADCAST_BYTES = 32 << 20
#: A row of a path: two hex digests at most and their array slots.
_STEP_BYTES = 180


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts one after the other."""
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _small(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """``df``, to be broadcast if its rows of ``row_bytes`` prove small enough."""
    return F.broadcast(df) if (df.count() if rows is None else rows) * row_bytes <= BROADCAST_BYTES else df


def ranked(rows: DataFrame, by: str, order: Sequence[str]) -> tuple[DataFrame, int]:
    """``rows`` with their ``rank`` from 0 among the rows of equal ``by`` and the number ``n``
    of those, and the largest ``n`` of all.

    Rows are dealt by ranges of ``by`` and ``order``, so that a group of any size spreads
    over tasks; ranges are counted, and the counts give each range its first rank.
    """
    dealt = written(rows.repartitionByRange(by, *order).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy(by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(by)
    first = F.sum("_n").over(group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    counts = written(counts.select(by, "_range", F.coalesce(first, F.lit(0)).alias("_first"), F.sum("_n").over(group).alias("n")))
    size = counts.agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("k")).first()
    inside = F.row_number().over(Window.partitionBy(by, "_range").orderBy(*order))
    out = dealt.withColumn("_i", inside).join(_small(counts, 120, size["k"]), [by, "_range"]).withColumn(
        "rank", F.col("_first") + F.col("_i") - 1).drop("_i", "_first", "_range")
    return out, size["n"] or 0


def rollup(nodes: DataFrame, by: str, arity: int, levels: int = DIGITS) -> DataFrame:
    """``by, block, n, tree`` from ``by, rank, n, hash, leaf``: a row per block of
    ``arity ** levels`` nodes; ``tree`` has its ``hash`` and, nested, the ``run`` below it.

    A group's levels end where one node is left, so the block of a group of few nodes
    passes its top up as it is.
    """
    digits = [f"_d{k}" for k in range(levels)]
    cut = nodes.select(by, "n", F.floor(F.col("rank") / arity ** levels).alias("block"), *[
        F.pmod(F.floor(F.col("rank") / arity ** k), F.lit(arity)).cast("int").alias(d) for k, d in enumerate(digits)],
        F.struct("hash", "leaf").alias("tree"))
    # dealt by block once; every further grouping finds a block's rows in one place
    out = cut.repartition(by, "block")
    for k, d in enumerate(digits):
        left = [by, "block", "n", *digits[k + 1:]]
        out = out.groupBy(*left).agg(F.sort_array(F.collect_list(F.struct(F.col(d).alias("at"), F.col("tree").alias("node")))).alias("run"))
        joined = F.sha2(F.array_join(F.transform("run", lambda c: c["node"]["hash"]), ""), 256)
        out = out.select(*left, F.struct(F.when(F.col("n") <= arity ** k, F.col("run")[0]["node"]["hash"]).otherwise(joined).alias("hash"),
                                         "run").alias("tree"))
    return out


def emitted(blocks: DataFrame, by: str, arity: int, levels: int = DIGITS) -> DataFrame:
    """``by, leaf, hash, path, subroot, root`` of every leaf of ``by, n, tree, path, subroot,
    root``, where ``path`` is the way up from the block; steps are (``before``, ``after``), the
    digests of the siblings on both sides one after the other."""
    nodes = F.array(F.struct(F.col("tree").alias("node"), F.col("path")))

    def step(run: Column, at: Column) -> Column:
        side = lambda keep: F.array_join(F.transform(F.filter(run, keep), lambda s: s["node"]["hash"]), "")
        return F.array(F.struct(side(lambda s: s["at"] < at).alias("before"), side(lambda s: s["at"] > at).alias("after")))

    for k in reversed(range(levels)):
        alone = F.col("n") <= arity ** k
        nodes = F.flatten(F.transform(nodes, lambda x: F.transform(x["node"]["run"], lambda c: F.struct(  # noqa: B023
            c["node"].alias("node"),
            F.when(alone, x["path"]).otherwise(F.concat(step(x["node"]["run"], c["at"]), x["path"])).alias("path")))))  # noqa: B023
    out = blocks.select(by, "subroot", "root", F.explode(nodes).alias("_x"))
    return out.select(by, F.col("_x.node.leaf").alias("leaf"), F.col("_x.node.hash").alias("hash"), F.col("_x.path").alias("path"),
                      "subroot", "root")


def climb(nodes: DataFrame, by: str, most: int, arity: int, above: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Paths from every one of ``nodes`` (see ``rollup``) to the root.  ``above`` takes the
    tops of all groups (``by, hash``) and gives ``by, path, root``."""
    depth = next(k for k in range(1, 200) if arity ** k >= most)
    levels = min(DIGITS, depth)
    blocks, width, row_bytes = rollup(nodes, by, arity, levels), arity ** levels, 300 + _STEP_BYTES * (depth + 2 * DIGITS)
    if most > width:
        up = blocks.select(by, F.col("block").alias("rank"), F.ceil(F.col("n") / width).alias("n"), F.col("tree.hash").alias("hash"),
                           F.struct("block").alias("leaf"))
        up = written(climb(up, by, -(-most // width), arity, above).select(by, "leaf.block", "path", "subroot", "root"))
        return emitted(blocks.join(_small(up, row_bytes), [by, "block"]), by, arity, levels)
    roots = written(above(blocks.select(by, F.col("tree.hash").alias("hash"))))
    return emitted(blocks.join(_small(roots, row_bytes), by).withColumn("subroot", F.col("tree.hash")), by, arity, levels)


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", arity: int = 2,
             carry: dict[str, Column] | None = None) -> DataFrame:
    """A row per row of ``docs``: ``order``, ``group``, ``leaf``, ``proof``, ``subroot``, ``root``
    and the columns of ``carry``, taken from ``docs``.

    A leaf is the digest of a row's ``fields``.  Each group is a tree over its leaves by
    ``order``, and one tree over the groups' tops (null first, then bytewise) gives the root.
    ``proof`` lists the way up: the digests before and after the node among its run.  Null
    ``order`` comes first; rows of equal ``order`` follow their leaves' digests, and repeated rows
    have equal leaves and each a place.  A null or empty field is told apart; texts are taken whole.  Columns
    beyond the named ones are left out; an empty table gives an empty result.
    """
    if arity < 2:
        raise ValueError("a run has two nodes or more")
    carry = carry or {}
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    leaves = written(docs.select(F.col(order).alias("_order"), key.alias("_key"), digest(*[field(F.col(c)) for c in fields]).alias("hash"),
                                 F.struct(F.col(group).alias("_group"), *[c.alias(k) for k, c in carry.items()]).alias("_kept"),
                                 F.monotonically_increasing_id().alias("_nth")))
    rows, most = ranked(leaves, "_key", ["_order", "hash", "_nth"])

    def above(tops: DataFrame) -> DataFrame:
        tops, groups = ranked(tops.withColumn("_all", F.lit(0)), "_all", ["_key"])
        one = lambda t: t.select("_all", F.array().cast("array<struct<before:string,after:string>>").alias("path"), F.col("hash").alias("root"))
        up = climb(tops.select("_all", "rank", "n", "hash", F.struct("_key").alias("leaf")), "_all", groups, arity, one)
        return up.select("leaf._key", "path", "root")

    out = climb(rows.select("_key", "rank", "n", "hash", F.struct("_order", "_kept").alias("leaf")), "_key", most, arity, above)
    return out.select(F.col("leaf._order").alias(order), F.col("leaf._kept._group").alias(group), F.col("hash").alias("leaf"),
                      F.col("path").alias("proof"), "subroot", "root", *[F.col(f"leaf._kept.{k}").alias(k) for k in carry])


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)
