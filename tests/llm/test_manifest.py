"""Merkle manifest: brute force, blocks, arities, proofs and awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from awkward import SCHEMA, awkward_rows, documents, empty
from pagewright.llm import merkle as M


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(doc_id, text, lang, source, n_chars):
    return sha(*map(field, (doc_id, source, lang, n_chars, text)))


def climb(nodes, arity):
    """The top of a list of digests, and the (before, after) steps of each of them."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i // arity * arity:i // arity * arity + arity]
            paths[k].append(("".join(run[:i % arity]), "".join(run[i % arity + 1:])))
            at[k] = i // arity
        nodes = [sha(*nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0], paths


def brute(rows, arity=2):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(((r[0] is not None, r[0] or 0), leaf(*r), r))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    tops = {}
    for k in keys:
        groups[k].sort(key=lambda x: x[:2])
        tops[k] = climb([x[1] for x in groups[k]], arity)
    root, above = climb([tops[k][0] for k in keys], arity)
    out = []
    for k, up in zip(keys, above):
        for (_, own, r), path in zip(groups[k], tops[k][1]):
            out.append((r[0], own, tops[k][0], root, tuple(path + up)))
    return out


def got(df):
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof)) for r in df.collect())


@pytest.mark.parametrize("arity,digits", [(2, 10), (3, 2)])
def test_manifest_matches_brute_force(spark, monkeypatch, arity, digits):
    monkeypatch.setattr(M, "DIGITS", digits)
    rng = random.Random(arity)
    rows = awkward_rows() + [(rng.randrange(500), f"t{k}", rng.choice(["en", "é", "z", None, ""]), None, k) for k in range(150)]
    assert got(M.manifest(documents(spark, rows), arity=arity)) == Counter(brute(rows, arity))


def test_groups_of_every_size(spark, monkeypatch):
    monkeypatch.setattr(M, "DIGITS", 2)
    rows = [(k, f"t{k}", f"l{n}", "s", k) for n in range(1, 18) for k in range(n)]
    assert got(M.manifest(documents(spark, rows))) == Counter(brute(rows))


def test_proofs_fold_to_the_root_unless_a_row_changed(spark):
    rows = [(k, f"text {k}", "en" if k % 3 else "fr", "s", None if k % 5 == 0 else k) for k in range(200)]
    changed = F.col("doc_id") % 4 == 0
    values = {c: F.col(c) for c in M.FIELDS} | {"n_chars": F.col("n_chars") + F.when(changed, 1).otherwise(0)}
    out = M.manifest(documents(spark, rows), carry={"now": M.digest(*[M.field(values[c]) for c in M.FIELDS])})
    for r in out.withColumns({"folded": M.fold(F.col("now"), F.col("proof")), "p": M.proof_digest(F.col("proof"))}).collect():
        assert (r.folded == r.root) == (r.doc_id % 4 != 0 or r.doc_id % 5 == 0)
        assert r.p == sha(*[b + a for b, a in r.proof])


def test_empty_table_and_bad_arity(spark):
    assert M.manifest(empty(spark)).collect() == []
    with pytest.raises(ValueError):
        M.manifest(spark.createDataFrame([], SCHEMA), arity=1)


def test_query_tampers_by_crc(spark, tmp_path):
    from pagewright.llm.q_manifest import op13_merkle_manifest
    rows = awkward_rows() + [(k, f"t{k}", "en", "s", k) for k in range(100, 160)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    out = op13_merkle_manifest(spark, str(tmp_path)).collect()
    assert len(out) == len(rows)
    kept = {r[0]: r[4] is None or r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 0 for r in rows}
    assert all(r.verified == kept[r.doc_id] and r.verified == (r.folded_root == r.root) for r in out) and not all(kept.values())
