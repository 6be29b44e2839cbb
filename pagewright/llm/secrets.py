"""Secret scan over an inverted index of trigrams, as DataFrame expressions.

Each rule is a regular expression.  Its mandatory trigrams give a Boolean query;
postings ``(trigram, document)`` of the queried trigrams are intersected per clause,
and only the candidates are verified with the expression itself.  A rule without a
mandatory trigram scans every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import let
from pagewright.llm.trigrams import clauses


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  ``group`` must be ``least`` characters or longer; matches
    that fail are dropped after the non-overlapping matches are found."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base kinds, in the order in which spans of equal start are listed.  The hex and access
#: patterns hold their least lengths, which finds the same spans: a run's first start has the longest match.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{30,}"),
    Rule("slack", r"xox[abps]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]{2,10} ){0,2}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE + MORE


def prefix_sums(numbers: Column, block: int = 256) -> Column:
    """For each number of an array the sum of those before it.  Blocks of ``block``
    keep the copying of growing arrays linear in the length."""
    zero = F.lit(0).cast("long")

    def running(first: Column, xs: Column) -> Column:
        return F.aggregate(xs, F.array(first), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def of_blocks(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, x: a + x))
        return let(running(zero, sums), lambda bases: F.flatten(F.transform(
            blocks, lambda b, i: F.slice(running(F.get(bases, i), b), 1, F.size(b)))))

    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / block)),
                      lambda c: F.slice(numbers, (c * block + 1).cast("int"), block))
    return F.when(F.size(numbers) == 0, F.array().cast("array<bigint>")).otherwise(let(cut, of_blocks))


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans ``(start, ord, end, kind)`` of a rule in code points, end exclusive."""
    kind = "array<struct<start:bigint,ord:int,end:bigint,kind:string>>"

    def place(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, rule.pattern, -1), 1, F.size(found)), lambda g: F.length(g).cast("long"))
        sizes = F.transform(found, lambda m: F.length(m).cast("long"))

        def located(pairs: Column) -> Column:
            return let(prefix_sums(F.transform(pairs, lambda p: p["g"] + p["m"])), lambda before: F.transform(
                pairs, lambda p, i: F.struct((F.get(before, i) + p["g"]).alias("start"), F.lit(order).alias("ord"),
                                             (F.get(before, i) + p["g"] + p["m"]).alias("end"), F.lit(rule.kind).alias("kind"))))

        good = (lambda i: F.length(F.regexp_extract(F.get(found, i), rule.pattern, rule.group)) >= rule.least) if rule.least else None
        at = let(F.zip_with(gaps, sizes, lambda g, m: F.struct(g.alias("g"), m.alias("m"))), located)
        return F.filter(at, lambda _s, i: good(i)) if good else at

    found = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1))
    return F.when(text.rlike(rule.pattern), let(found, place)).otherwise(F.array()).cast(kind)


def trigram_postings(docs: DataFrame, key: str, text: str, trigrams: list[str]) -> DataFrame:
    """Postings ``(trigram, key)`` of the given trigrams in the ASCII-lower-cased
    texts, one per document that holds the trigram."""
    held = let(F.lower(F.col(text)), lambda low: F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(low, t)))
    return docs.select(F.explode(held).alias("trigram"), F.col(key))


def candidates(docs: DataFrame, key: str, text: str, rules) -> DataFrame:
    """``key`` and the indexed rules whose trigram query the document answers.

    Postings of a clause are intersected by counting them per document and clause;
    the count combines before the shuffle, and no posting list is gathered, however
    common its trigram is.  The clause table is as large as the rules, not the data.
    """
    spark = docs.sparkSession
    need = [(r.kind, n, t, len(c)) for r in rules for n, c in enumerate(clauses(r.pattern) or []) for t in sorted(c)]
    table = spark.createDataFrame(need, "kind string, clause int, trigram string, need int")
    postings = trigram_postings(docs, key, text, sorted({t for _, _, t, _ in need}))
    met = (postings.join(F.broadcast(table), "trigram").groupBy(key, "kind", "clause", "need")
           .agg(F.count_distinct("trigram").alias("n")).where("n = need"))
    return met.groupBy(key).agg(F.collect_set("kind").alias("kinds"))


def scan_secrets(docs: DataFrame, rules=RULES) -> DataFrame:
    """Secrets in every row of ``docs``: ``doc_id`` and ``found``, an array of
    ``(start, ord, end, kind)`` by start, then order of the rules.

    Other columns are left out.  Null text has no secrets.  Rows that share a doc_id
    or have none are verified for each other's candidates too, which changes no
    result: every span comes from the expression on the row's own text.  An empty
    table gives an empty result.
    """
    rows = docs.select("doc_id", "text", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_k"))
    indexed = [r for r in rules if clauses(r.pattern)]
    if indexed:
        rows = rows.join(candidates(rows, "_k", "text", indexed), "_k", "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:bigint,ord:int,end:bigint,kind:string>>")
    each = [F.when(F.array_contains("kinds", r.kind), spans(text, r, n)).otherwise(none) if r in indexed
            else spans(text, r, n) for n, r in enumerate(rules)]
    return rows.select("doc_id", F.array_sort(F.concat(*each)).alias("found"))


def joined(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
