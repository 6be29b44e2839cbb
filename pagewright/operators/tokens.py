"""Tokens with exact character offsets, without a UDF.

A text is cut into *pieces*: one token plus the whitespace that follows it
(``regexp_extract_all``).  A token's start offset is the sum of the lengths of the pieces
before it.  Lengths count code points, as Python slicing does; regex match positions
(UTF-16 in Java) are never used.

``token_arrays`` keeps the tokens of an article in its row, so what is done with them there
needs no exchange, sort or window; ``tokenize`` gives a row per token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.functions.regex import NOT_WS, WS, WS_CHARS

# The tokenizer.  A word is letters/digits with inner hyphens;
# a possessive "'s" is its own token; any other non-space character is a token.
WORD_TOKEN = r"[\p{L}\p{N}]+(?:-[\p{L}\p{N}]+)*"
POSSESSIVE_TOKEN = r"['’][sS]"
TOKEN_RE = f"{WORD_TOKEN}|{POSSESSIVE_TOKEN}|{NOT_WS}"
# A piece is a token with its trailing whitespace; whitespace at the very start
# of the text is a piece of its own (empty token), so offsets need nothing but
# the pieces themselves and the text is not carried past the explode.
PIECE_RE = rf"(?s)\A{WS}+|(?:{TOKEN_RE}){WS}*"
TOKEN_AT_START_RE = rf"\A(?:{TOKEN_RE})"
# Java recurses once per hyphenated part of a word; Spark uses an equivalent possessive
# spelling (nothing after a part can make the word give it back), matched in a loop.  The
# characters that most texts are made of are tried first: Java asks each range of a class in turn.
_SPARK_WORD = r"(?:[a-z]++|[\p{L}\p{N}])++"
_SPARK_WS = rf"(?: ++|(?![!-~]){WS})*+"
SPARK_TOKEN_RE = rf"{_SPARK_WORD}(?:-{_SPARK_WORD})*+|{POSSESSIVE_TOKEN}|[!-~]|{NOT_WS}"
SPARK_PIECE_RE = rf"(?s)\A{WS}++|(?:{SPARK_TOKEN_RE}){_SPARK_WS}"
SPARK_PIECE_HERE_RE = rf"(?:{SPARK_TOKEN_RE}){_SPARK_WS}"
SPARK_TOKEN_AT_START_RE = rf"\A(?:{SPARK_TOKEN_RE})"


def token_array(col: Column) -> Column:
    """Tokens of a short string (gazetteer names), lower-cased."""
    return F.transform(F.regexp_extract_all(col, F.lit(SPARK_TOKEN_RE), 0), F.lower)


def normalize_name(col: Column) -> Column:
    """Gazetteer key: lower-cased tokens joined by one space."""
    return F.array_join(token_array(col), " ")


#: Offsets are summed in blocks of this many pieces, or more where that would give over 1024 blocks.
OFFSET_BLOCK, OFFSET_BLOCKS = 16, 1024


def token_arrays(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and arrays in each row: ``toks`` (tokens), ``pieces`` (token and
    white space), and what :func:`offset_of` reads: ``lens``, ``lead``, ``block``, ``upto``.

    Offsets of all pieces would be as many running sums; here only sums over blocks are
    kept, and the offset of a token that is asked for adds the few lengths inside its block.
    Null text has no tokens.
    """
    a = docs.select(*keep, F.regexp_extract_all(F.col(text_col), F.lit(SPARK_PIECE_RE), 0).alias("_p"))
    # white space at the start is a piece without a token
    spare = F.rtrim(F.get("_p", F.lit(0)), F.lit(WS_CHARS)) == ""
    a = a.select(*keep, F.when(spare, F.slice("_p", 2, F.greatest(F.size("_p"), F.lit(1)))).otherwise(F.col("_p")).alias("pieces"),
                 F.when(spare, F.length(F.col("_p")[0])).otherwise(0).alias("lead"))
    a = a.select(*keep, F.transform("pieces", lambda p: F.rtrim(p, F.lit(WS_CHARS))).alias("toks"), "pieces", "lead")
    return with_offsets(a, *keep, "toks")


def with_offsets(rows: DataFrame, *keep: str) -> DataFrame:
    """Rows with ``pieces`` (consecutive parts of a text) and ``lead`` (characters before the
    first), and what :func:`offset_of` reads."""
    a = rows.select(*keep, "pieces", "lead", F.transform("pieces", F.length).alias("lens"),
                    F.greatest(F.lit(OFFSET_BLOCK), F.ceil(F.size("pieces") / OFFSET_BLOCKS)).cast("int").alias("block"))
    # entries are taken one by one: a slice would copy the whole array first
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size("lens") - 1, F.lit(0)) / F.col("block")).cast("int")),
                         lambda b: _lengths(b * F.col("block"), (b + 1) * F.col("block")))
    a = a.select("*", blocks.alias("_sums"))
    upto = F.aggregate("_sums", F.array(F.col("lead")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    return a.select(*keep, "pieces", "lens", "lead", "block", upto.alias("upto"))


def _lengths(low: Column, high: Column) -> Column:
    """The sum of the lengths of pieces ``low`` to ``high`` (exclusive), as many as there are."""
    each = F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(each, F.lit(0), lambda acc, j: acc + F.coalesce(F.get("lens", j), F.lit(0)))


def run_of(array: str, low: Column, n: Column) -> Column:
    """``n`` entries of an array column from place ``low`` (from 0), for use inside lambdas."""
    return F.when((n > 0) & (F.size(array) > low), F.transform(F.sequence(low, F.least(low + n, F.size(array)) - 1), lambda j: F.get(array, j))) \
        .otherwise(F.array().cast("array<string>"))


def offset_of(i: Column) -> Column:
    """The start of token ``i`` (from 0) of a row of :func:`token_arrays`; null beyond the last.

    For use inside lambdas.  The arrays are named more than once, so that Spark keeps them as
    columns: it would put an expression that is named once in its place, for every element.
    """
    b = F.floor(i / F.col("block")).cast("int")
    start = (F.get("upto", b) + _lengths(b * F.col("block"), i)).cast("long")
    return F.when((F.size("lens") > i) & (F.size("upto") > b), start)


def offset_sum() -> Column:
    """The sum of :func:`offset_of` over all tokens of a row, in one pass over the lengths."""
    start = F.struct(F.col("lead").cast("long").alias("at"), F.lit(0).cast("long").alias("total"))
    return F.aggregate("lens", start, lambda acc, n: F.struct((acc["at"] + n).alias("at"), (acc["total"] + acc["at"]).alias("total")),
                       lambda acc: acc["total"])


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, pos, token, norm, start, end, piece)``; offsets are 0-based, end exclusive.

    ``piece`` is the token followed by its whitespace, so the surface text of
    a run of tokens is the concatenation of their pieces (minus the last
    piece's whitespace) - no substring of the article is needed for it.
    """
    pieces = docs.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(SPARK_PIECE_RE), 0)).alias("pos", "piece"))
    w = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    token = F.regexp_extract(F.col("piece"), SPARK_TOKEN_AT_START_RE, 0)
    start = F.coalesce(F.sum(F.length("piece")).over(w), F.lit(0))
    out = pieces.select("doc_id", "pos", "piece", token.alias("token"), start.alias("start")) \
        .where(F.col("token") != "")
    return out.select("doc_id", "pos", "token", F.lower("token").alias("norm"), "start",
                      (F.col("start") + F.length("token")).alias("end"), "piece")


def chunk_pattern(chunk_chars: int) -> str:
    """Cut text into pieces that end after the first whole run of non-space characters
    past ``chunk_chars`` characters, with the white space after it: no token is ever cut,
    and every chunk but white space at the very start of a text has a token."""
    return rf"(?s).{{1,{chunk_chars}}}+{NOT_WS}*+{WS}*+"


def chunk_rows(docs: DataFrame, chunk_chars: int, lookahead: int, text_col: str = "text") -> DataFrame:
    """``doc_id, text, base, own``: chunks of (possibly huge) articles, spread over tasks.

    ``text`` is the chunk, of ``own`` characters, and the ``lookahead`` tokens that follow it,
    over as many chunks as that takes, so n-grams that cross chunk boundaries are still seen;
    ``base`` is the chunk's offset, from a window over the article's chunk rows.
    """
    ch = docs.select("doc_id", F.posexplode(
        F.regexp_extract_all(F.col(text_col), F.lit(chunk_pattern(chunk_chars)), 0)).alias("part", "chunk"))
    wc = Window.partitionBy("doc_id").orderBy("part")
    head = rf"\A(?:{WS}*+(?:{SPARK_TOKEN_RE})){{0,{lookahead}}}{WS}*+"
    ch = ch.withColumn("head", F.regexp_extract("chunk", head, 0))
    # each further chunk has a token, so this many hold enough
    ahead = F.concat(F.lit(""), *[F.coalesce(F.lead("head", j).over(wc), F.lit("")) for j in range(1, lookahead + 1)])
    base = F.coalesce(F.sum(F.length("chunk")).over(wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ch = ch.select("doc_id", "part", "chunk", base.alias("base"), F.regexp_extract(ahead, head, 0).alias("ahead"))
    return ch.repartition("doc_id", "part").select(
        "doc_id", F.concat("chunk", "ahead").alias("text"), F.col("base").cast("long").alias("base"),
        F.length("chunk").cast("long").alias("own"))
