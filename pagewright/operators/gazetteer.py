"""Gazetteer match (J1): every vocabulary phrase against every article, inside the scan.

1. An article is cut before each token that may begin a phrase (:func:`cut_pattern`), in its
   row: the tokens between are passed over by the regular expression and never built.
2. Each cut becomes a row with the few tokens that follow it, its character offset and, if
   asked for, the text around it, cut from the article's blocks.
3. Its 1..k-token n-grams are joined to the gazetteer on the normalised key: broadcast
   behind a check of the gazetteer's bytes, a shuffle join of these few rows above it.

There is no exchange, sort or window between the scan of the articles and that join, and
the text of an article is in no join at all.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.regex import WS, WS_CHARS
from pagewright.operators.partitioning import ROW, stored
from pagewright.operators.tokens import SPARK_PIECE_RE, SPARK_PIECE_HERE_RE, chunk_rows, offset_of, run_of, with_offsets

#: Characters of a block of text, as a power of two: about a window, which touches few blocks and
#: has little to pass over in them.
TEXT_BLOCK_BITS = 8
TEXT_BLOCK = 1 << TEXT_BLOCK_BITS


class Gazetteer:
    """A gazetteer written once, with its longest phrase, the tokens that begin phrases (None
    where they are more than ``inline_firsts``) and whether it may be broadcast."""

    def __init__(self, table: DataFrame, broadcast_max_bytes: int = 64 << 20, inline_firsts: int = 50_000):
        self.table = stored(table)
        size = F.sum(F.octet_length("key") + F.octet_length("name") + F.coalesce(F.octet_length("ekey"), F.lit(0)) + 80)
        row = self.table.agg(F.max("n_tokens").alias("n"), size.alias("bytes")).first()
        self.max_n, self.small = int(row["n"] or 1), (row["bytes"] or 0) <= broadcast_max_bytes
        firsts = [r["first"] for r in self.table.select("first").distinct().limit(inline_firsts + 1).collect()]
        self.firsts = firsts if len(firsts) <= inline_firsts else None
        longer = self.table.where("n_tokens > 1").select("first").distinct()
        self.longer = [r["first"] for r in longer.collect()] if self.firsts is not None else None

    def goes_on(self, norm: Column) -> Column:
        """Whether a phrase of several tokens may begin with this lower-cased token."""
        return norm.isin(self.longer) if self.longer is not None else F.lit(True)

    @property
    def pieces(self) -> str:
        """The pattern that cuts a text at least before each token that begins a phrase."""
        return SPARK_PIECE_RE if self.firsts is None else cut_pattern(self.firsts)


#: Characters of a first token that the cutting pattern reads.
FIRST_CHARS = 40
# All characters that become these ASCII letters when lower-cased, besides their own capitals.
_ALSO = {"i": "\u0130", "k": "\u212a"}
_NOT_ASCII = r"[^\x00-\x7f]"


def _in_any_case(c: str) -> str:
    """A lower-cased character in any letter case; for all that are not ASCII any of these stands, for
    the tables of letter cases differ between Java's patterns and ``lower``.  A class of the few spellings of
    a letter is one look into a table; Java's own test of letter cases takes several, at each word of a text."""
    if not c.isascii():
        return _NOT_ASCII
    return f"[{c}{c.upper()}{_ALSO.get(c, '')}]" if c.isalpha() else re.escape(c)


def _any_of(words: list[str]) -> str:
    """A regular expression for some words, in any letter case, that tries a common beginning once."""
    tree: dict = {}
    for w in words:
        node = tree
        for c in w:
            node = node.setdefault(_in_any_case(c), {})
        node[""] = {}

    def spelt(node: dict) -> str:
        ways = [c + spelt(n) for c, n in sorted(node.items()) if c]
        if not ways or (len(ways) == 1 and "" not in node):
            return "".join(ways)           # a group costs Java a step
        return f"(?:{'|'.join(ways)})" + ("?" if "" in node else "")
    return spelt(tree)


def cut_pattern(firsts: list[str]) -> str:
    """Cuts a text into pieces of whole tokens, one beginning wherever a token is one of ``firsts``
    (lower-cased tokens) in any letter case.

    It may also cut before a few other tokens: other characters may stand for those that are not
    ASCII, and of a long first token only the beginning is read.  White space at the start of a
    text stays before its first piece, which may begin with any token.
    """
    # a capital i with a dot becomes two characters, so nothing is read from the second on
    heads = [f.split("\u0307")[0][:FIRST_CHARS] for f in firsts]
    word = [f == h and f[:1].isascii() and f[:1].isalnum() for f, h in zip(firsts, heads)]
    whole = [f for f, w in zip(firsts, word) if w]
    part = [h for h, w in zip(heads, word) if h and not w]
    ways = [rf"{_any_of(whole)}(?!-?[\p{{L}}\p{{N}}])"] if whole else []
    ways += [_any_of(part)] if part else []
    ways += [_NOT_ASCII] if not all(heads) else []
    more = rf"(?:(?!{'|'.join(ways)}){SPARK_PIECE_HERE_RE})*+" if ways else rf"(?:{SPARK_PIECE_HERE_RE})*+"
    return rf"(?s)\A{WS}++{more}|{SPARK_PIECE_HERE_RE}{more}"


def text_blocks(text: str) -> Column:
    """Column ``blocks`` that :func:`text_window` reads."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{TEXT_BLOCK}}}"), 0).alias("blocks")


def text_window(blocks: str, start: Column, end: Column) -> Column:
    """``text[start:end]`` (start from 0) from the blocks that it touches; for use inside lambdas
    (the blocks are named twice, see :func:`pagewright.operators.tokens.offset_of`)."""
    first = F.shiftright(start, TEXT_BLOCK_BITS).cast("int")
    count = F.shiftright(F.greatest(end - 1, start), TEXT_BLOCK_BITS).cast("int") - first + 1
    joined = F.array_join(run_of(blocks, first, count), "")
    cut = F.substring(joined, (start - first * TEXT_BLOCK + 1).cast("int"), (end - start).cast("int"))
    return F.when(F.size(blocks) > first, cut).otherwise(F.lit(""))


def match_gazetteer(docs: DataFrame, gazetteer: Gazetteer, before: int = 0, after: int = 0,
                    chunk_chars: int | None = None) -> DataFrame:
    """Candidate matches ``(doc_id, n_tokens, start, end, label, source, priority, text)`` of
    articles ``(doc_id, text)``.

    Offsets are character offsets of the article.  With ``before``/``after``, column ``win``
    holds ``text[start - before : end + after]`` of the article and ``win_start`` where it
    begins.  Overlapping candidates are all returned; see :mod:`pagewright.operators.spans`.
    ``chunk_chars`` cuts articles into chunks first, for articles that are too long for a
    task; there is no ``win`` then.  Null texts have no matches.  A match of articles with
    :data:`ROW` keeps it, unless they are cut into chunks.
    """
    k = gazetteer.max_n
    row = [c for c in docs.columns if c == ROW and not chunk_chars]
    rows = docs.select("doc_id", *row, "text", F.lit(0).cast("long").alias("base"), F.lit(None).cast("long").alias("own"))
    if chunk_chars:
        rows = chunk_rows(docs, chunk_chars, max(k - 1, 0))
    keep = ["doc_id", *row, "base", "own"]
    if before or after:
        rows = rows.select("*", text_blocks("text"))
        keep.append("blocks")
    t = rows.select(*keep, F.regexp_extract_all("text", F.lit(gazetteer.pieces), 0).alias("pieces"), F.lit(0).alias("lead"))
    t = with_offsets(t, *keep)
    # a piece that begins with white space begins the text, and no phrase begins in it
    low = F.when(F.ltrim(F.get("pieces", F.lit(0)), F.lit(WS_CHARS)) == F.get("pieces", F.lit(0)), 0).otherwise(1)
    at = F.when(F.size("pieces") > low, F.sequence(low, F.size("pieces") - 1)).otherwise(F.array().cast("array<int>"))
    t = t.select("*", at.alias("_at"))

    def first(i: Column) -> Column:
        head = F.regexp_extract(F.get("pieces", i), rf"(?s)\A{SPARK_PIECE_HERE_RE}", 0)
        return F.struct(i.alias("i"), head.alias("head"), F.lower(F.rtrim(head, F.lit(WS_CHARS))).alias("norm"))

    def here(h: Column) -> Column:
        # each piece has a token, so this many hold the longest phrase
        head = F.regexp_extract(F.array_join(run_of("pieces", h["i"], F.lit(k)), ""), rf"(?s)\A(?:{SPARK_PIECE_HERE_RE}){{1,{k}}}+", 0)
        p = F.when(gazetteer.goes_on(h["norm"]), F.regexp_extract_all(head, F.lit(SPARK_PIECE_RE), 0)).otherwise(F.array(h["head"]))
        return F.struct(offset_of(h["i"]).alias("start"), p.alias("p"))

    def around(h: Column) -> Column:
        fields = [h["start"].alias("start"), F.transform(h["p"], lambda x: F.rtrim(x, F.lit(WS_CHARS))).alias("t"), h["p"].alias("p")]
        if before or after:
            low = F.greatest(h["start"] - before, F.lit(0).cast("long"))
            # up to the end of the longest phrase that may begin here
            high = h["start"] + F.length(F.array_join(h["p"], "")) + after
            fields += [low.alias("win_start"), text_window("blocks", low, high).alias("win")]
        return F.struct(*fields)

    hits = F.transform(F.transform(F.transform("_at", first), here), around)
    # exploded as an expression, not as a column: Spark would test a column before, and so build it twice
    hit = t.select("doc_id", *row, "base", "own", F.explode(hits).alias("h"))
    # tokens of the chunk after only feed phrases that begin in their own
    hit = hit.where(F.col("own").isNull() | (F.col("h.start") < F.col("own")))
    window = ["win_start", "win"] if before or after else []
    gram = hit.select("doc_id", *row, (F.col("base") + F.col("h.start")).alias("start"), F.col("h.t").alias("t"), F.col("h.p").alias("p"),
                      *[F.col(f"h.{w}").alias(w) for w in window], F.explode(F.sequence(F.lit(1), F.size("h.t"))).alias("n_tokens"))
    if gazetteer.firsts is None:
        firsts = gazetteer.table.select(F.col("first").alias("_first")).distinct()
        gram = gram.join(F.broadcast(firsts) if gazetteer.small else firsts, F.lower(F.col("t")[0]) == F.col("_first"), "left_semi")
    head = F.slice("t", F.lit(1), F.col("n_tokens"))
    gram = gram.select("*", F.array_join(F.transform(head, F.lower), " ").alias("key"))
    # entries of exact case (acronyms) also need the n-gram as it is spelt, which is looked at on the few joined rows
    names = gazetteer.table.select("key", F.col("exact").alias("g_exact"), F.col("ekey").alias("g_ekey"), "label", "source", "priority")
    m = gram.join(F.broadcast(names) if gazetteer.small else names, "key").where(~F.col("g_exact") | (F.array_join(head, " ") == F.col("g_ekey")))
    text = F.concat(F.array_join(F.slice("p", F.lit(1), F.col("n_tokens") - 1), ""), F.get("t", F.col("n_tokens") - 1))
    m = m.select("doc_id", "n_tokens", "start", "label", "source", "priority", text.alias("text"), *row, *window)
    m = m.select("doc_id", "n_tokens", "start", (F.col("start") + F.length("text")).alias("end"), "label", "source", "priority", "text",
                 *row, *window)
    if window:
        m = m.withColumn("win", F.expr("substring(win, 1, int(`end` + %d - win_start))" % after))
    return m
