"""Query of the Merkle manifest, and its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.llm import merkle as M
from pagewright.llm.common import read

#: Rows of which the crc32 of the decimal doc_id is a multiple of this are tampered with.
TAMPERED = 7


def op13_merkle_manifest(spark, sf_dir):
    """All documents as leaves of one tree, and what tampering with some of them gives.
    A row without a doc_id is not tampered with."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, F.lit(False))
    values = {c: F.col(c) for c in M.FIELDS} | {"n_chars": F.col("n_chars") + F.when(tampered, 1).otherwise(0)}
    out = M.manifest(read(spark, sf_dir, "documents"), carry={"now": M.digest(*[M.field(values[c]) for c in M.FIELDS])})
    folded = M.fold(F.col("now"), F.col("proof"))
    return out.select("doc_id", "leaf", "subroot", "root", M.proof_digest(F.col("proof")).alias("proof_sha256"),
                      folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql() -> str:
    value = "coalesce(strlen({0}::VARCHAR) || ':' || {0}, '-')"
    leaf = lambda n: "sha256(" + " || ".join(value.format(n if c == "n_chars" else c) for c in M.FIELDS) + ")"
    crc = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, x: xor(c >> 8, tb[(xor(c, x) & 255) + 1])))"""
    run = """SELECT k, lvl + 1, r // 2, sha256(string_agg(h, '' ORDER BY r)), (n + 1) // 2
  FROM {t} WHERE n > 1 GROUP BY k, lvl, r // 2, n"""
    return f"""
WITH RECURSIVE tab AS (SELECT list(v ORDER BY i) AS tb FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) t(i))),
d AS (SELECT *, n_chars + CASE WHEN doc_id IS NOT NULL AND {crc} % {TAMPERED} = 0 THEN 1 ELSE 0 END AS m FROM documents, tab),
f AS (SELECT doc_id, coalesce('=' || lang, '') AS k, {leaf('n_chars')} AS leaf, {leaf('m')} AS now FROM d),
l AS (SELECT row_number() OVER () AS id, *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
  count(*) OVER (PARTITION BY k) AS n FROM f),
t AS (SELECT k, 0 AS lvl, r, leaf AS h, n FROM l UNION ALL {run.format(t='t')}),
tops AS (SELECT k, h AS subroot FROM t WHERE n = 1),
u0 AS (SELECT k AS own, 0 AS k, row_number() OVER (ORDER BY encode(k)) - 1 AS r, subroot AS h, count(*) OVER () AS n FROM tops),
u AS (SELECT k, 0 AS lvl, r, h, n FROM u0 UNION ALL {run.format(t='u')}),
top AS (SELECT h AS root FROM u WHERE n = 1),
-- a node's siblings at its level: one before or one after, or none
s AS (SELECT a.k, a.lvl, a.r, CASE WHEN b.r < a.r THEN b.h ELSE '' END AS b4, CASE WHEN b.r > a.r THEN b.h ELSE '' END AS af
  FROM t a LEFT JOIN t b ON b.k = a.k AND b.lvl = a.lvl AND b.r // 2 = a.r // 2 AND b.r <> a.r WHERE a.n > 1),
su AS (SELECT a.lvl, a.r, CASE WHEN b.r < a.r THEN b.h ELSE '' END AS b4, CASE WHEN b.r > a.r THEN b.h ELSE '' END AS af
  FROM u a LEFT JOIN u b ON b.lvl = a.lvl AND b.r // 2 = a.r // 2 AND b.r <> a.r WHERE a.n > 1),
up AS (SELECT id, k, 0 AS lvl, r, now AS h, '' AS p FROM l UNION ALL
  SELECT up.id, up.k, up.lvl + 1, up.r // 2, sha256(coalesce(s.b4, '') || up.h || coalesce(s.af, '')), up.p || coalesce(s.b4, '') || coalesce(s.af, '')
  FROM up JOIN s ON s.k = up.k AND s.lvl = up.lvl AND s.r = up.r),
e AS (SELECT id, arg_max(h, lvl) AS h, arg_max(p, lvl) AS p FROM up GROUP BY id),
uu AS (SELECT l.id, 0 AS lvl, u0.r, e.h, e.p FROM l JOIN e USING (id) JOIN u0 ON u0.own = l.k UNION ALL
  SELECT uu.id, uu.lvl + 1, uu.r // 2, sha256(coalesce(su.b4, '') || uu.h || coalesce(su.af, '')), uu.p || coalesce(su.b4, '') || coalesce(su.af, '')
  FROM uu JOIN su ON su.lvl = uu.lvl AND su.r = uu.r),
z AS (SELECT id, arg_max(h, lvl) AS folded_root, arg_max(p, lvl) AS p FROM uu GROUP BY id)
SELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN z USING (id) JOIN tops ON tops.k = l.k, top"""


QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
ORACLE = {"op13_merkle_manifest": _sql()}
