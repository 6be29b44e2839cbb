"""Parenthesised aliases (E7) with last-wins per term."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.functions.regex import WS, WS_SET
from pagewright.functions.text import strip

# Fixed value: the alias rule, "<run of letters, spaces, apostrophes, hyphens>
# (<1-5 capitals>)"; the term is the whole preceding run, stripped.
ALIAS_RE = rf"([A-Za-z{WS_SET}'-]+){WS}*\(([A-Z]{{1,5}})\)"
# Equivalent spelling for Java's backtracking matcher: start only at the first
# character of a run and take the run possessively (it already holds the
# spaces before "("), which keeps the scan linear instead of quadratic.
_RUN = f"[A-Za-z{WS_SET}'-]"
ALIAS_RE_SPARK = rf"(?<!{_RUN})({_RUN}++)\(([A-Z]{{1,5}})\)"


def extract_aliases(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, term, alias)``: one row per distinct term, the last alias seen wins."""
    t = docs.where(F.instr(F.col(text_col), "(") > 0)
    pairs = t.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.arrays_zip(
            F.regexp_extract_all(F.col(text_col), F.lit(ALIAS_RE_SPARK), 1).alias("term"),
            F.regexp_extract_all(F.col(text_col), F.lit(ALIAS_RE_SPARK), 2).alias("alias"))).alias("pos", "m"))
    pairs = pairs.select("doc_id", "pos", strip(F.col("m.term")).alias("term"),
                         strip(F.col("m.alias")).alias("alias"))
    return pairs.groupBy("doc_id", "term").agg(F.max_by("alias", "pos").alias("alias"))


def trim_alias_term(term: Column, alias: Column) -> Column:
    """Corrected E7: the last ``len(alias)`` words of the term when their
    initials spell the alias ("We studied Alzheimer's disease" + AD ->
    "Alzheimer's disease"); otherwise the whole term."""
    words = F.split(term, f"{WS}+", -1)
    n = F.length(alias)
    last = F.slice(words, -n, n)
    initials = F.array_join(F.transform(last, lambda w: F.upper(F.substring(w, 1, 1))), "")
    return F.when((F.size(words) >= n) & (initials == F.upper(alias)), F.array_join(last, " ")).otherwise(term)


def extract_aliases_corrected(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Aliases with the corrected term trimming; last wins per trimmed term."""
    a = docs.where(F.instr(F.col(text_col), "(") > 0).select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.arrays_zip(
            F.regexp_extract_all(F.col(text_col), F.lit(ALIAS_RE_SPARK), 1).alias("term"),
            F.regexp_extract_all(F.col(text_col), F.lit(ALIAS_RE_SPARK), 2).alias("alias"))).alias("pos", "m"))
    a = a.select("doc_id", "pos", strip(F.col("m.term")).alias("term"), strip(F.col("m.alias")).alias("alias"))
    a = a.select("doc_id", "pos", trim_alias_term(F.col("term"), F.col("alias")).alias("term"), "alias")
    return a.groupBy("doc_id", "term").agg(F.max_by("alias", "pos").alias("alias"))
