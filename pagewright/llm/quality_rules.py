"""Line-first quality rules, as DataFrame expressions.

Every line is judged alone by rules on punctuation, navigation and boilerplate.
Lines that fail are removed, and a document that loses too many of its words is
rejected.  Document measures (repeated windows of words, repeated lines, symbols)
are computed in the row, with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import SPACE, WORD, count_words, let

SYMBOL = r"[#*$%&|<>]"
#: A sentence ends with one of these, with or without a closing quote or bracket.
SENTENCE_END = r"""[.!?;:…。！？]["')\]”’»]*[\x20\x09-\x0D]*$"""
#: Parts of a menu, a breadcrumb or a table row.
NAVIGATION = r"(?:^|[\x20\x09])[|>»›•·]+(?:[\x20\x09]|$)"
BOILERPLATE = (
    r"(?i)(?:cookie policy|accept (?:all )?cookies|all rights reserved|terms of (?:use|service)|privacy policy|"
    r"enable javascript|lorem ipsum|sign up for our newsletter|click here to|subscribe now|skip to content|"
    r"share on (?:facebook|twitter|x)|log ?in to (?:continue|comment)|\(c\) ?[0-9]{4}|© ?[0-9]{4})"
)
MIN_WORDS = 20
#: A window of so many words that is found twice in a text is a repetition.
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
#: Of a line's characters without white space, symbols and exclamation marks may be one in this many.
SYMBOL_SHARE = 10
#: A document stays if at least this percentage of its words is in lines that stay.
KEEP_PERCENT = 60
#: Separators from which on a line is a menu.
MAX_SEPARATORS = 2


def line_passes(line: Column) -> Column:
    """Whether a line with words passes each rule: it ends as a sentence does, is
    not a menu, is not full of symbols, is not shouted and holds no boilerplate."""
    solid = F.length(F.regexp_replace(line, SPACE, ""))
    letters = F.regexp_count(line, F.lit(r"\p{L}"))
    capitals = F.regexp_count(line, F.lit(r"\p{Lu}"))
    return (line.rlike(SENTENCE_END)
            & (F.regexp_count(line, F.lit(NAVIGATION)) < MAX_SEPARATORS)
            & (F.regexp_count(line, F.lit(r"[#*$%&|<>!]")) * SYMBOL_SHARE <= solid)
            & ((capitals * 2 <= letters) | (letters < 20))
            & ~line.rlike(BOILERPLATE))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _repeat_words(words: Column) -> Column:
    """Words inside windows that occur twice or more.  Windows are compared by a
    64-bit hash; only texts with an equal pair are sorted to place them."""
    k = REPEAT_WINDOW

    def covered(hashes: Column) -> Column:
        def starts(ranked: Column) -> Column:
            twin = F.filter(ranked, lambda e, j: (e["h"] == F.get(ranked, j - 1)["h"]) | (e["h"] == F.get(ranked, j + 1)["h"]))
            return F.array_sort(F.transform(twin, lambda e: e["i"]))

        def length(at: Column) -> Column:
            # each start covers k words, or as many as lie before the next start
            steps = F.transform(at, lambda p, j: F.coalesce(F.least(F.lit(k), F.get(at, j + 1) - p), F.lit(k)))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        ranked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes),
                      let(let(ranked, starts), length)).otherwise(F.lit(0).cast("long"))

    def windows(ws: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(ws) - (k - 1)), lambda i: F.xxhash64(F.slice(ws, i, k)))

    return let(words, lambda ws: F.when(F.size(ws) <= k, F.lit(0).cast("long"))
               .otherwise(let(windows(ws), covered)))


def clean_documents(docs: DataFrame) -> DataFrame:
    """Measures, verdict and cleaned text of every row of ``docs``.

    Returns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, n_kept_words, kept, clean_text``; further columns of ``docs`` are
    left out.  A null or empty text has no words, fails, and keeps its null or empty
    text.  Rows are judged one by one: repeated rows get equal results, and an empty
    table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", F.col("text"))
    lines = F.filter(F.split(text, "\n", -1), _has_word)
    df = df.select(
        "doc_id", "text",
        _repeat_words(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))).alias("n_repeat_words"),
        count_words(F.col("text")).alias("n_words"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        F.array_join(F.filter(lines, line_passes), "\n").alias("clean_text"))
    df = df.withColumn("n_kept_words", count_words(F.col("clean_text")))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                       | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT))
    kept = ~F.col("base_failed") & (F.col("n_kept_words") * 100 >= F.col("n_words") * KEEP_PERCENT)
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     "base_failed", "n_kept_words", kept.alias("kept"),
                     F.when(F.col("text").isNotNull(), F.col("clean_text")).alias("clean_text"))
