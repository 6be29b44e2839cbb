"""Exact top-k search against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagewright.llm import topk as K


def _brute(rows, k, every):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(64 * x) for x in v]
    out = {}
    for q, qv in usable.items():
        if q % every == 0:
            s = sorted(((-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable.items() if i != q and len(v) == len(qv)))[:k]
            out[q] = [(i, -x) for x, i in s]
    return {q: s for q, s in out.items() if s}


@pytest.mark.parametrize("block", [16384, 64])
def test_search_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(K, "INDEX_BLOCK", block)
    monkeypatch.setattr(K, "QUERY_BLOCK", block)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(500, 16))
    v /= np.linalg.norm(v, axis=1)[:, None]
    rows = [(int(i), [float(x) for x in r]) for i, r in enumerate(v)]
    hot = rows[40][1]
    rows += [(1000 + i, hot) for i in range(120)] + [(7, rows[7][1])]
    rows += [(2000, None), (2020, []), (2040, [None] * 16), (2060, [float("nan")] * 16), (2080, [float("inf")] * 16),
             (2100, [0.0] * 16), (None, hot), (2120, [1.0, -1.0]), (2121, [0.5, 0.5]), (2140, [3e4] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).withColumn("score", F.lit(2))
    whole = df.select("vec_id", K.whole(F.col("embedding")).alias("vec"))
    got = {}
    for r in K.search(whole, whole.where("vec_id % 20 = 0"), k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    assert got == _brute(rows, 20, 20)


def test_block_keeps_every_member():
    rng = np.random.default_rng(6)
    for scale in (1, 8, 300):
        v = np.floor(rng.normal(size=(400, 24)) * scale).astype(np.int64)
        block = K.Block(v)
        for q in v[:40]:
            kept = set(block.best(q, 10).tolist())
            s = v @ q
            assert set(np.flatnonzero(s >= np.sort(s)[-10]).tolist()) <= kept


def test_empty_sides(spark):
    none = spark.createDataFrame([], "vec_id long, vec array<long>")
    assert K.search(none, none).count() == 0
    assert K.search(spark.createDataFrame([(0, [1, 2])], "vec_id long, vec array<long>"), none).count() == 0
