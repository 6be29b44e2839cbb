"""Whitening against numpy's eigenvectors, and awkward vectors."""

import numpy as np
import pytest

from pagewright.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, component string, key string, x string"
NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    return spark.createDataFrame([(i, v, "clash", "clash", "clash") for i, v in rows], SCHEMA)


def brute(rows, components=4):
    kept = [(i, [int(np.floor(256 * c)) for c in v]) for i, v in rows
            if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in kept}), dtype=float)
    a = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(a.T @ a / len(x))
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-12 * values.max()]
    n, sums = len(x), [sum(int(r[k]) for r in x) for k in range(x.shape[1])]
    out = {}
    for i, v in kept:
        w = (np.array(v, dtype=float) - x.mean(axis=0)) @ vectors[:, order] / np.sqrt(values[order])
        for c, k in enumerate(order):
            out.setdefault((i, c + 1), []).append((n, sum((n * a - s) ** 2 for a, s in zip(v, sums)), w[c], values[k] / values.sum()))
    return out


def check(got, want):
    signs = {}
    rows = {}
    for r in got:
        rows.setdefault((r.vec_id, r.component), []).append(r)
    assert rows.keys() == want.keys()
    for k, rs in rows.items():
        for r, w in zip(sorted(rs, key=lambda r: r.deviation), sorted(want[k], key=lambda w: w[1])):
            assert (r.n, r.deviation) == w[:2]
            assert r.explained == pytest.approx(w[3], rel=1e-9) and r.identity_error < 1e-9
            if abs(w[2]) > 1e-6:
                sign = signs.setdefault(k[1], np.sign(w[2] * r.whitened))
                assert r.whitened == pytest.approx(sign * w[2], rel=1e-6, abs=1e-9)


def test_matches_eigenvectors_and_handles_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    mix = rng.standard_normal((7, 7)) * np.array([9, 7, 5, 3.5, 2, 1, .5])
    rows = [(int(k), (rng.standard_normal(7) @ mix / 9).tolist()) for k in range(300)]
    rows += rows[:100] * 3 + [(1, rows[5][1]), (None, rows[6][1]), (401, [-0.0, 0.0, -1e-9, 1e-9, 0.0, 0.0, 0.0])]
    want = brute([r for r in rows])
    bad = [(900, None), (901, []), (902, [NAN] + [0.0] * 6), (903, [INF] + [0.] * 6), (904, [None] + [0.] * 6), (905, [1.0, 2.0])]
    check(W.whiten(table(spark, rows + bad)).collect(), want)


def test_equal_eigenvalues_and_low_rank_are_white(spark):
    corners = [(k, [float(s if j == k else 0) for j in range(5)]) for k in range(5) for s in (-1, 1)]
    got = W.whiten(table(spark, corners)).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and all(r.identity_error < 1e-9 and abs(r.explained - .2) < 1e-9 for r in got)
    line = [(k, [float(k), float(2 * k), 1.0]) for k in range(6)]
    got = W.whiten(table(spark, line)).collect()
    assert {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-9 for r in got)


def test_no_spread_gives_no_rows(spark):
    assert W.whiten(table(spark, [])).collect() == []
    assert W.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []


def test_deviation_is_exact_beyond_doubles():
    x = np.array([[3_000_000, -7], [1, 2]])
    assert W.deviations(x, 1_000, np.array([5, 6], dtype=object)) == [(3_000_000_000 - 5) ** 2 + 7006 ** 2, 995 ** 2 + 1994 ** 2]
    assert W.deviations(x, 10 ** 6, np.array([5, 6], dtype=object))[0] is None


def test_query_is_white_on_the_tables(spark):
    from pagewright.llm.q_vectors import op12_embedding_whitening
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(op12_embedding_whitening(spark, sf).collect(), brute(rows))
