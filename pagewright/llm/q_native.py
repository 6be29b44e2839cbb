"""Queries of the operators that are DataFrame expressions alone, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.llm import quality_rules as Q
from pagewright.llm import secrets as S
from pagewright.llm import sharding as H
from pagewright.llm.common import SPACE, WORD, read

SHARDS = 40


def op1_quality_rules(spark, sf_dir):
    """Line-first quality rules over all documents."""
    return Q.clean_documents(read(spark, sf_dir, "documents")).drop("clean_text")


def op2_secret_scan(spark, sf_dir):
    """Secrets in all documents, found through the trigram index."""
    base = [r.kind for r in S.BASE]
    out = S.scan_secrets(read(spark, sf_dir, "documents"))
    of = lambda kinds: F.filter("found", lambda s: s["kind"].isin(kinds))
    return out.select("doc_id", *[F.size(of([k])).cast("long").alias(f"n_{k}") for k in base],
                      F.sha2(S.joined(of(base)), 256).alias("base_sha256"), S.joined(F.col("found")).alias("spans"))


def op5_sharding(spark, sf_dir):
    """All documents in 40 equal shards by rendezvous hashing of doc_id."""
    return H.shard_records(read(spark, sf_dir, "documents"), [1.0] * SHARDS)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _op1_sql() -> str:
    words = f"regexp_extract_all(coalesce(text, ''), {quote(WORD)})"
    k = Q.REPEAT_WINDOW
    count = lambda what, of: f"len(regexp_extract_all({of}, {quote(what)}))"
    solid = f"length(regexp_replace(ln, {quote(SPACE)}, '', 'g'))"
    passes = (f"regexp_matches(ln, {quote(Q.SENTENCE_END)}) AND {count(Q.NAVIGATION, 'ln')} < {Q.MAX_SEPARATORS} "
              f"AND {count('[#*$%&|<>!]', 'ln')} * {Q.SYMBOL_SHARE} <= {solid} "
              f"AND ({count(chr(92) + 'p{Lu}', 'ln')} * 2 <= {count(chr(92) + 'p{L}', 'ln')} OR {count(chr(92) + 'p{L}', 'ln')} < 20) "
              f"AND NOT regexp_matches(ln, {quote(Q.BOILERPLATE)})")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, {words} AS ws FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - {k - 2})) AS i, ws FROM w WHERE len(ws) > {k - 1}),
h AS (SELECT r, i, list_slice(ws, i, i + {k - 1}) AS win FROM g),
s AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM h),
p AS (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM s WHERE n > 1),
rep AS (SELECT r, sum(least({k}, coalesce(nxt - i, {k}))) AS n FROM p GROUP BY r),
ln AS (SELECT r, unnest(string_split(text, chr(10))) AS ln FROM d),
lw AS (SELECT r, ln FROM ln WHERE regexp_matches(ln, {quote(WORD)})),
ll AS (SELECT r, count(*) - count(DISTINCT ln) AS dup,
  sum(CASE WHEN {passes} THEN {count(WORD, 'ln')} ELSE 0 END) AS kept_words FROM lw GROUP BY r),
f AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, {quote(SPACE)}, '', 'g'))::BIGINT AS word_chars,
  {count(Q.SYMBOL, 'text')}::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines,
  coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(kept_words, 0)::BIGINT AS n_kept_words
  FROM w LEFT JOIN ll USING (r) LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {Q.MIN_WORDS} OR n_repeat_words * 100 > n_words * {Q.MAX_REPEAT_PERCENT} AS base_failed, n_kept_words,
  NOT (n_words < {Q.MIN_WORDS} OR n_repeat_words * 100 > n_words * {Q.MAX_REPEAT_PERCENT})
    AND n_kept_words * 100 >= n_words * {Q.KEEP_PERCENT} AS kept
FROM f"""


def _op2_sql() -> str:
    parts = []
    for n, r in enumerate(S.RULES):
        whole, kind = quote(r.pattern), quote(r.kind)
        good = f"length(regexp_extract(m, {whole}, {r.group})) >= {r.least}" if r.least else "true"
        parts.append(f"""
SELECT r, {n} AS ord, {kind} AS kind, b + length(g) AS s, b + length(g) + length(m) AS e FROM (
  SELECT r, g, m, coalesce(sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b
  FROM (SELECT r, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS g FROM (
    SELECT r, regexp_extract_all(text, {whole}) AS ms, string_split_regex(text, {whole}) AS gs FROM d)))
WHERE {good}""")
    text = "kind || ':' || s || ':' || e"
    base = ", ".join(quote(r.kind) for r in S.BASE)
    counts = ", ".join(f"count(*) FILTER (kind = {quote(r.kind)}) AS n_{r.kind}" for r in S.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({' UNION ALL '.join(parts)}),
a AS (SELECT r, {counts}, string_agg({text}, ',' ORDER BY s, ord) FILTER (kind IN ({base})) AS base,
  string_agg({text}, ',' ORDER BY s, ord) AS spans FROM f GROUP BY r)
SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in S.BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (r)"""


def _op5_sql() -> str:
    u = "((('0x' || substr(md5({k} || ':' || {j}), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"
    bid = f"1.0 / -ln({u.format(k='k', j='j')})"
    return f"""
WITH tab AS (SELECT list(v ORDER BY i) AS tb FROM (SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)::BIGINT[]),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v FROM range(256) t(i))),
b AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null') AS k, strlen(coalesce(text, '')) + 16 AS size,
  list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bs FROM documents),
c AS (SELECT doc_id, k, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, bs),
  lambda c, x: xor(c >> 8, tb[(xor(c, x) & 255) + 1]))) AS crc, row_number() OVER () AS r FROM b, tab),
bids AS (SELECT r, j, {bid} AS bid FROM c, range({SHARDS + 1}) t(j)),
won AS (SELECT r, arg_max(j, (bid, -j)) FILTER (j < {SHARDS}) AS shard, arg_max(j, (bid, -j)) AS grown FROM bids GROUP BY r),
g AS (SELECT *, ('0x' || substr(md5(k || ':' || crc), 1, 6))::BIGINT % {H.SLOT_GROUPS} AS grp FROM c JOIN won USING (r))
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'key' AS law, shard::INT AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY grp, doc_id, crc, size) - 1 AS slot, grown::INT AS grown_shard FROM g"""


QUERIES = {"op1_quality_rules": op1_quality_rules, "op2_secret_scan": op2_secret_scan, "op5_sharding": op5_sharding}
ORACLE = {"op1_quality_rules": _op1_sql(), "op2_secret_scan": _op2_sql(), "op5_sharding": _op5_sql()}
