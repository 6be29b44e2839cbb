"""Removal of repeated byte strings against brute force."""

import random
from collections import Counter

import numpy as np
import pytest

from awkward import awkward_rows, documents, empty
from pagewright.llm import suffix_dedup as X


def brute(rows):
    """(doc_id, kept, n_bytes, n_removed, spans) of each row, documents in the order of doc_id;
    equal ids only with equal texts."""
    seen, done = set(), {}
    for i, text in sorted({(i, t or "") for i, t, *_ in rows if i is not None}):
        raw, gone, new = text.encode(), bytearray(len(text.encode())), []
        own = set()
        for p in range(len(raw) - X.LENGTH + 1):
            w = raw[p:p + X.LENGTH]
            if w in seen or w in own:
                gone[p:p + X.LENGTH] = b"\x01" * X.LENGTH
            own.add(w)
            new.append(w)
        seen.update(new)
        done[i] = raw, gone
    out = []
    for i, t, *_ in rows:
        raw, gone = done[i] if i is not None else ((t or "").encode(), bytes(len((t or "").encode())))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.frombuffer(bytes(gone), np.uint8), [0]]).astype(int)))
        out.append((i, bytes(b for b, g in zip(raw, gone) if not g), len(raw), sum(gone), tuple(zip(edges[::2].tolist(), edges[1::2].tolist()))))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, bytes(r.kept), r.n_bytes, r.n_removed, tuple((s.start, s.end) for s in r.spans)) for r in df.collect())


def rows_of(seed, n):
    rng = random.Random(seed)
    letters = "abcdefghij é日"
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passages = [word(rng.choice([60, 99, 100, 101, 120, 149, 150, 199, 260, 700])) for _ in range(12)]
    rows = []
    for i in rng.sample(range(-50, 4 * n), n):
        parts = []
        for _ in range(rng.randrange(0, 7)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p)) if rng.random() < .4 else 0
            end = rng.randrange(cut, len(p) + 1) if rng.random() < .4 else len(p)
            p = p[cut:end]
            if p and rng.random() < .3:
                k = rng.randrange(len(p))
                p = p[:k] + rng.choice(letters) + p[k + 1:]
            parts += [p, word(rng.randrange(0, 40))]
        rows.append((i, "".join(parts), "en", "s", 0))
    text = rows[0][1]
    return rows + [(5000, text, "en", "s", 0), (5001, text, "en", "s", 0), (5002, "ab" * 400, "en", "s", 0), (5003, "a" * 333, "en", "s", 0),
                   (5004, "xyzw" * 30 + "ba" * 90, "en", "s", 0)]


def test_cover_leads_any_two_positions_to_sampled_ones():
    assert {(a - b) % X.PERIOD for a in X.COVER.tolist() for b in X.COVER.tolist()} == set(range(X.PERIOD))
    assert X.STRING >= X.PERIOD and X.STRING + X.PERIOD - 1 <= X.LENGTH


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, monkeypatch, seed):
    # small slices, ranges and groups, so that everything meets across them
    for name, size in (("SLICE", 500), ("RANGE_BYTES", 5_000), ("GROUP_BYTES", 4_000)):
        monkeypatch.setattr(X, name, size)
    rows = rows_of(seed, 90)
    assert got(X.remove_repeats(documents(spark, rows).repartition(3))) == brute(rows)


def test_awkward_rows(spark):
    rows = awkward_rows()
    assert got(X.remove_repeats(documents(spark, rows))) == brute(rows)
    assert X.remove_repeats(empty(spark)).collect() == []


def test_rows_that_share_an_id(spark):
    rng = random.Random(8)
    shared = "".join(rng.choice("abcdef") for _ in range(300))
    rows = [(7, "one:" + shared, "en", "s", 0), (7, "two and " + shared, "en", "s", 0), (8, shared, "en", "s", 0), (3, "x" * 20, "en", "s", 0)]
    out = X.remove_repeats(documents(spark, rows)).collect()
    assert sorted(r.n_removed for r in out) == [0, 0, 300, 300] and all(r.n_removed == 300 for r in out if r.doc_id == 8)


def test_query_matches_brute_force(spark):
    import hashlib

    from pagewright.llm.q_dedup import op11_suffix_dedup
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = Counter((i, n, gone, len(spans), hashlib.sha256(kept).hexdigest()) for (i, kept, n, gone, spans) in brute(rows).elements())
    assert Counter(map(tuple, op11_suffix_dedup(spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())) == want
