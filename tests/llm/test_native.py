"""Quality rules, secret scan and sharding: brute force and awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from awkward import awkward_rows, documents, empty, words
from pagewright.llm import quality_rules as Q
from pagewright.llm import secrets as S
from pagewright.llm import sharding as H
from pagewright.llm.trigrams import clauses


def _measures(text):
    w = words(text)
    seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            covered |= set(range(i, i + 8))
    lines = [ln for ln in (text or "").split("\n") if words(ln)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_quality_measures_match_brute_force(spark):
    rows = awkward_rows() + [(90, "a b c d e f g h a b c d e f g h i j\nx y.\nx y.\n\n", "en", "s", 1)]
    got = Q.clean_documents(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = Counter((i, *_measures(t)) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_quality_removes_lines_and_rejects(spark):
    prose = "The river ran high after the long rain. People came to look at it from both banks."
    menu, shout = "Home | News | Sport | Weather", "BUY THIS NOW BEFORE IT IS GONE FOREVER AND EVER."
    more = "Nobody had seen so much water there since the old mill was built."
    rows = [(1, f"{prose}\n{menu}\n{more} Again.\n{shout}", None, None, 0),
            (2, "\n".join([menu] * 3 + [shout] * 4 + [prose]), None, None, 0),
            (3, f"{prose} {more}\nAccept cookies to go on.", None, None, 0)]
    got = {r.doc_id: r for r in Q.clean_documents(documents(spark, rows)).collect()}
    assert got[1].clean_text == f"{prose}\n{more} Again." and got[1].kept
    assert not got[2].kept and got[3].clean_text == f"{prose} {more}"


def _brute_spans(text):
    """Spans with the plain patterns, then the least lengths."""
    out = []
    plain = {"access": (r"AKIA[A-Z0-9]+", 20), "hex": (r"[0-9a-f]+", 24)}
    for n, rule in enumerate(S.RULES):
        pattern, least = plain.get(rule.kind, (rule.pattern, 0))
        for m in re.finditer(pattern, text or "", re.ASCII):
            if len(m[0]) >= least and len(m[rule.group]) >= rule.least:
                out.append((m.start(), n, m.end(), rule.kind))
    return sorted(out)


def _secret_texts():
    rng = random.Random(3)
    parts = ["token=", "Secret : ", "api_key='", "APIKEY=\"", "passwd=", "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef",
             "ghp_", "é", "\U0001f600", " ", "\n", "x", "abc", "secret=token:", "-----BEGIN RSA PRIVATE KEY-----", "xoxb-1234567890ab",
             "=" , "password", "eyJhbGciOiJI.eyJzdWIiOiIx.abc", "Zz9_" * 9]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    return texts + [None, "", "secret=token:abcdefgh", "token=abc", "AKIA" * 8, "a" * 23, "a" * 24, "f" * 5000, "token=abcdef " * 3000]


def test_secrets_match_brute_force(spark):
    texts = _secret_texts()
    rows = [(k if k % 7 else None, t, None, None, 0) for k, t in enumerate(texts)] + [(1, texts[2], None, None, 0)]
    got = S.scan_secrets(documents(spark, rows)).withColumn("spans", S.joined(F.col("found"))).collect()
    want = Counter((r[0], ",".join(f"{k}:{s}:{e}" for s, _, e, k in _brute_spans(r[1]))) for r in rows)
    assert Counter((r.doc_id, r.spans) for r in got) == want


def test_every_match_answers_its_trigram_query():
    assert clauses(S.RULES[2].pattern) is None
    for rule in S.RULES:
        query = clauses(rule.pattern)
        for text in filter(None, _secret_texts()):
            if re.search(rule.pattern, text) and query:
                low = text.lower()
                assert any(all(t in low for t in c) for c in query), (rule.kind, text)
    assert set(map(frozenset, clauses("(abc|xyz)d?[0-9]+ef"))) == {frozenset({"abc"}), frozenset({"abc", "bcd"}),
                                                                   frozenset({"xyz"}), frozenset({"xyz", "yzd"})}


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 700])
def test_prefix_sums(spark, n):
    xs = [(7 * i) % 11 for i in range(n)]
    df = spark.createDataFrame([(xs,)], "x array<long>")
    assert df.select(S.prefix_sums(F.col("x"))).first()[0] == [sum(xs[:i]) for i in range(n)]


def test_sharding_law_slots_and_digest(spark):
    rows = awkward_rows()
    got = H.shard_records(documents(spark, rows), [1.0] * 40).collect()
    digest = lambda t: (len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, *digest(t)) for i, t, *_ in rows)
    for s in {r.shard for r in got}:
        slots = [r.slot for r in got if r.shard == s]
        assert sorted(slots) == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 40) for r in got)
    assert len({r.shard for r in got if r.doc_id is None}) == 1


def test_sharding_by_weight_moves_only_to_the_new_shard(spark):
    keys = spark.range(20_000).withColumn("text", F.lit("t"))
    three = {r.id: (r.shard, r.grown_shard) for r in H.with_shard(keys, F.col("id"), [1.0, 2.0, 1.0], 4.0).collect()}
    four = {r.id: r.shard for r in H.with_shard(keys, F.col("id"), [1.0, 2.0, 1.0, 4.0]).collect()}
    assert all(three[k][1] == four[k] and four[k] in (three[k][0], 3) for k in four)
    share = Counter(four.values())
    assert all(abs(share[j] / 20_000 - w / 8) < 0.02 for j, w in enumerate([1, 2, 1, 4]))
    with pytest.raises(ValueError):
        H.with_shard(keys, F.col("id"), [1.0, 0.0])


def test_uniform_is_the_md5(spark):
    u = spark.createDataFrame([("a:1",)], "k string").select(H.uniform(F.col("k"))).first()[0]
    assert u == (int(hashlib.md5(b"a:1").hexdigest()[:13], 16) + 0.5) / 2 ** 52


def test_native_operators_on_an_empty_table(spark):
    none = empty(spark)
    assert Q.clean_documents(none).count() == S.scan_secrets(none).count() == H.shard_records(none, [1.0]).count() == 0
