"""Exact top-k inner products over an impact-ordered index, score at a time.

Vectors are dealt into blocks.  A block keeps one posting list per dimension, and a
query weighs each list by its impact, the largest product that any of its postings
can add.  Lists are processed in descending order of their quantised impact, a segment
of equal impacts at a time; after each, the vectors that can still be among the best
k are known by proof (partial score plus or minus the product of the lengths of what
is left of query and vector), and the search of the block stops when these are few.
They are then scored exactly.  No list or vector is left out without such a proof.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of an index block, and queries of a query block.
INDEX_BLOCK, QUERY_BLOCK = 16384, 2048
#: Segments per power of two of the impact.
LEVELS = 2


def whole(vector: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` of every component, and null for a vector that is null or
    empty or holds a null, a NaN or an infinite component."""
    x = vector.cast("array<double>")
    usable = vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(usable, F.transform(x, lambda v: F.floor(v * float(scale)).cast("long")))


class Block:
    """The posting lists of some vectors: values by dimension, dense."""

    def __init__(self, vectors: np.ndarray):
        self.lists = np.ascontiguousarray(vectors.T, dtype=np.float64)
        self.squares = self.lists ** 2
        self.length2 = self.squares.sum(axis=0)
        self.most = np.abs(self.lists).max(axis=1)

    def best(self, query: np.ndarray, k: int, floor: float = -np.inf) -> np.ndarray:
        """Positions that may be among the block's best ``k``: all true members, few others."""
        q = query.astype(np.float64)
        impact = np.abs(q) * self.most
        live = np.flatnonzero(impact > 0)
        n = self.lists.shape[1]
        if not len(live) or n <= 2 * k:
            return np.arange(n)
        level = np.floor(np.log2(impact[live]) * LEVELS).astype(int)
        rest_q = float((q[live] ** 2).sum())
        score, rest_v, alive = np.zeros(n), self.length2.copy(), None
        for lv in np.unique(level)[::-1]:
            dims = live[level == lv]
            at = self.lists[dims] if alive is None else self.lists[np.ix_(dims, alive)]
            score += q[dims] @ at
            rest_v -= (self.squares[dims] if alive is None else self.squares[np.ix_(dims, alive)]).sum(axis=0)
            rest_q -= float((q[dims] ** 2).sum())
            # Cauchy-Schwarz on what is left; the margin covers rounding of the partial sums
            slack = np.sqrt(max(rest_q, 0.0) * np.maximum(rest_v, 0.0)) * (1 + 1e-9) + 1e-3
            low = score - slack
            bar = max(floor, np.partition(low, len(low) - k)[len(low) - k]) if len(low) > k else floor
            keep = score + slack >= bar
            if keep.sum() < 0.7 * len(score):
                alive = np.flatnonzero(keep) if alive is None else alive[keep]
                score, rest_v = score[keep], rest_v[keep]
            if len(score) <= 2 * k:
                break
        return np.arange(n) if alive is None else alive


def _ints(rows) -> np.ndarray:
    return np.array(list(rows), dtype=np.int64)


def _search(k: int):
    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(queries):
            vectors, ids = _ints(index["vec"]), index["vec_id"].to_numpy()
            block = Block(vectors)
            for rep, q in zip(queries["rep"], _ints(queries["vec"])):
                at = block.best(q, k)
                score = vectors[at] @ q
                if len(at) > k:
                    bar = np.partition(score, len(score) - k)[len(score) - k]
                    at, score = at[score >= bar], score[score >= bar]
                order = np.lexsort((ids[at], -score))[:k]
                out.append(pd.DataFrame({"rep": rep, "vec_id": ids[at][order], "score": score[order]}))
        return pd.concat(out) if out else pd.DataFrame({"rep": [], "vec_id": [], "score": []}).astype("int64")

    return run


def search(index: DataFrame, queries: DataFrame, k: int = 20, exclude_own: bool = True) -> DataFrame:
    """The ``k`` best of ``index`` for every row of ``queries``; both have ``vec_id`` and
    ``vec`` (whole numbers, of any one length).  Ties go to the smaller vec_id.

    Returns ``query_id, rank, vec_id, score``; with ``exclude_own``, a query's own
    vec_id is no candidate.  Vectors meet only those of their own length; rows with a
    null vec or vec_id take no part; rows that repeat a vec_id and vec count once; an
    empty side gives an empty result.

    Of equal vectors only the ``k + 1`` smallest ids can be in a result, so others
    leave the index (before the shuffle, in part), and each different query vector is
    searched once: a large group of copies costs one row.  Every query block meets
    every index block in a group of bounded size.
    """
    index = index.where(F.col("vec").isNotNull() & F.col("vec_id").isNotNull()).select("vec_id", "vec").distinct()
    queries = queries.where(F.col("vec").isNotNull() & F.col("vec_id").isNotNull()).select("vec_id", "vec").distinct()
    twins = Window.partitionBy("vec").orderBy("vec_id")
    index = index.withColumn("_n", F.row_number().over(twins)).where(F.col("_n") <= k + 1).drop("_n")
    reps = queries.groupBy("vec").agg(F.min("vec_id").alias("rep"))
    ni = max(1, math.ceil(index.count() / INDEX_BLOCK))
    nq = max(1, math.ceil(reps.count() / QUERY_BLOCK))
    part = lambda c, n: F.pmod(F.xxhash64(F.col(c)), F.lit(n)).cast("int")
    left = index.withColumn("bi", part("vec_id", ni)).withColumn("bq", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    right = reps.withColumn("bq", part("rep", nq)).withColumn("bi", F.explode(F.sequence(F.lit(0), F.lit(ni - 1))))
    key = ["bi", "bq", "dim"]
    left, right = (d.withColumn("dim", F.size("vec")) for d in (left, right))
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        _search(k + 1 if exclude_own else k), "rep long, vec_id long, score long")
    # the best of a query over all blocks, then of each row that asks it
    by = Window.partitionBy("rep").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= (k + 1 if exclude_own else k)).drop("_r")
    asks = queries.join(reps, "vec").select(F.col("vec_id").alias("query_id"), "rep")
    out = asks.join(best, "rep")
    if exclude_own:
        out = out.where(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return (out.select("query_id", "vec_id", "score").withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
