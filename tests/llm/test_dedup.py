"""Near-duplicates and line dedup against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from awkward import awkward_rows, brute_components, brute_repeats, documents, empty, sentence, shingles, words
from pagewright.llm import components as C
from pagewright.llm import line_dedup as L
from pagewright.llm import minhash as M


def _corpus():
    """Families of near copies of many degrees, a hot shared passage and exact copies."""
    rng = random.Random(7)
    vocab = [f"v{i}" for i in range(400)]
    hot = [rng.choice(vocab) for _ in range(80)]
    rows, i = [], 0
    for fam in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([6, 30, 120, 200]))]
        for _ in range(14):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 18))):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if fam % 3 == 0:
                cut = rng.randrange(len(w) + 1)
                w = w[:cut] + hot + w[cut:]
            rows.append((i, " ".join(w)))
            i += 1
    rows += [(i + k, rows[3][1]) for k in range(10)]
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = [(1000 + i, t, None, None, 0) for i, t in _corpus()] + awkward_rows()
    got = M.near_duplicates(documents(spark, rows)).collect()
    want = brute_components([(r[0], r[1]) for r in rows])
    assert len(got) == len(rows)
    expected = Counter((i, len(shingles(t)), None if i is None else want.get((i, t), i)) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_ids_with_several_texts_keep_every_link(spark):
    rows = [(i // 3, t, None, None, 0) for i, t in _corpus()]
    random.Random(4).shuffle(rows)
    want = brute_components([(r[0], r[1]) for r in rows])
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in M.near_duplicates(documents(spark, rows)).collect())
    assert got == Counter((i, len(shingles(t)), want[i, t]) for i, t, *_ in rows)


def test_few_pairs_at_the_threshold_share_no_key():
    rng = np.random.default_rng(11)
    x = rng.integers(0, 1 << 63, (4000, 800), dtype=np.uint64)
    a, b = (M.keys(M.signatures([np.sort(np.append(r[:600], r[s])) for r in x])) for s in (slice(600, 700), slice(700, 800)))
    assert (a == b).any(axis=1).sum() >= 3998


def test_bitmaps_pass_over_no_pair_that_is_similar_enough():
    rng = np.random.default_rng(12)
    for n in (4, 40, 400, 4000, 40000):
        x = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64))
        sets = [np.sort(np.append(x[:n], x[n:n + n // 3 - k])) for k in range(min(4, n // 3))] + [x[:n]]
        size, bits = np.array([len(s) for s in sets]), np.stack([M.bitmap(s) for s in sets])
        i, j = (v.ravel() for v in np.mgrid[:len(sets), :len(sets)])
        shared = [len(np.intersect1d(sets[p], sets[q])) for p, q in zip(i, j)]
        linked = np.array([100 * s >= 75 * (size[p] + size[q] - s) for s, p, q in zip(shared, i, j)])
        assert (M._may_link(size, bits, i, j, 75) | ~linked).all()
    far = [np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64)) for _ in range(2)]
    assert not M._may_link(np.array([500, 500]), np.stack([M.bitmap(s) for s in far]), np.array([0]), np.array([1]), 75)[0]


def test_pairs_within_the_signature_distance_share_a_key():
    rng = np.random.default_rng(2)
    most = 2 * (M.POSITIONS // M.CHUNK) - 1
    a = rng.integers(0, 1 << 16, (300, M.POSITIONS), dtype=np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(M.POSITIONS, most, replace=False)] ^= 1
    assert all(set(x) & set(y) for x, y in zip(M.keys(a), M.keys(b)))


def test_blocks_of_a_hot_key_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 5)
    rows = [(i, t, None, None, 0) for i, t in _corpus()[:60]]
    want = brute_components([(r[0], r[1]) for r in rows])
    got = {r.doc_id: r.component_id for r in M.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: want[(i, t)] for i, t, *_ in rows}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(5, 5), (120, 100)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.a: r.b for r in C.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}}
    assert C.components(df.where("false")).count() == 0


def _spans(row):
    return [tuple(map(int, s.split(":"))) for s in row.removed_spans.split(",") if s]


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(11)
    fresh = iter(range(10 ** 6))
    text = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    passages = [text(n) for n in (49, 50, 51, 60, 77, 130)]
    docs = []
    for i in range(40):
        w = text(rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            cut = rng.randrange(len(w) + 1)
            w = w[:cut] + p + w[cut:]
        docs.append((i, (rng.choice([" ", "\n", " \t "])).join(w)))
    docs += [(50, docs[3][1]), (51, "be " * 200), (52, "be " * 200), (53, " ".join(text(70) * 3))]
    want = brute_repeats(docs)
    got = L.remove_repeats(documents(spark, [(i, t, None, None, 0) for i, t in docs])).collect()
    assert len(got) == len(docs)
    for r in got:
        gone = [False] * r.n_words
        for a, b in _spans(r):
            gone[a:b] = [True] * (b - a)
        assert gone == want[r.doc_id], r.doc_id
        kept = [w for w, g in zip(words(dict(docs)[r.doc_id]), gone) if not g]
        assert words(r.text) == kept and r.removed_words == sum(gone)


def _gone(row):
    gone = [False] * row.n_words
    for a, b in _spans(row):
        gone[a:b] = [True] * (b - a)
    return gone


def test_line_dedup_of_variants_of_a_passage_equals_brute_force(spark):
    rng = random.Random(23)
    fresh = iter(range(10 ** 6))
    text = lambda n: [f"u{next(fresh)}" for _ in range(n)]
    docs = []
    for _ in range(25):
        long = text(rng.choice([75, 110, 160]))
        for k in range(6):
            kind, a, b = rng.choice("psm"), rng.randint(1, 30), rng.randint(1, 30)
            part = long[:-b] if kind == "p" else long[a:] if kind == "s" else long[a:-b]
            docs.append(text(rng.randint(0, 30)) + (long if k == 4 else part) + text(rng.randint(0, 30)))
    for n in range(1, 25):
        p, tail = text(60), text(n)
        docs += [text(9) + p + text(9), p + tail + text(9), text(9) + p + tail + text(3)]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    want = brute_repeats(docs)
    got = {r.doc_id: _gone(r) for r in L.remove_repeats(documents(spark, [(i, t, None, None, 0) for i, t in docs])).collect()}
    assert [i for i in want if got[i] != want[i]] == []


def _gaps(w):
    return np.diff(L.fingerprints([" ".join(w)])[1])


def test_line_dedup_of_edited_words_and_of_lines_far_apart(spark):
    rng = random.Random(5)
    text = lambda n: [f"r{rng.randrange(10 ** 9)}" for _ in range(n)]
    edited, docs = 0, []
    while edited < 4:
        one, two, around = text(25), text(25), [text(40) for _ in range(4)]
        a, b = ([*around[k], *one, *text(1), *two, *around[k + 1]] for k in (0, 2))
        at = [set(L.fingerprints([" ".join(w)])[1]) for w in (a, b)]
        if all({40, 66} <= s for s in at):
            edited += 1
            docs += [a, b]
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    rows = lambda d: documents(spark, [(i, t, None, None, 0) for i, t in d])
    assert [r.doc_id for r in L.remove_repeats(rows(docs)).collect() if r.removed_words] == []
    far = next(w for w in iter(lambda: text(130), None) if (_gaps(w) == 26).any())
    pair = [(1, " ".join(far)), (2, " ".join(text(9) + far + text(9)))]
    got = {r.doc_id: r.removed_spans for r in L.remove_repeats(rows(pair), min_run=100).collect()}
    assert got == {1: "", 2: "9:139"}


def test_line_dedup_on_awkward_rows(spark):
    rows = awkward_rows()
    docs = documents(spark, rows)
    got = L.remove_repeats(docs)
    assert set(docs.columns) | set(L.ADDED) == set(got.columns)
    got = got.collect()
    assert len(got) == len(rows)
    assert [r.text for r in got if r.doc_id is None or r.doc_id == 1].count(None) == 2
    assert sorted(r.removed_words for r in got if r.doc_id in (5, 6)) == [0, 120, 120]
    assert next(r for r in got if r.doc_id == 7).text == "tail of it."
    assert next(r for r in got if r.doc_id == -11).text.strip() == sentence(60, 4)
    assert next(r for r in got if r.doc_id == 9).lang == "en"


def test_short_runs_cannot_be_asked_for(spark):
    with pytest.raises(ValueError):
        L.remove_repeats(empty(spark), min_run=20)


def test_dedup_of_an_empty_table(spark):
    assert M.near_duplicates(empty(spark)).count() == 0
    assert L.remove_repeats(empty(spark)).count() == 0
