"""Span resolution and per-article entity tables.

Overlap resolution is a greedy choice: longest span first, then earliest
start, then best source priority; a span is accepted if it overlaps no span
accepted before it.  Spans in different *islands* (maximal runs of
overlapping candidates, found with one running-max window) never conflict:

* a candidate that is alone in its island is kept as it is;
* an island of up to ``LONG_ISLAND`` candidates is resolved in one row;
* a longer one, where overlaps chain through an article, is resolved by rounds over its
  candidates, one per length, the longest first: among spans of one length the greedy takes
  them from left to right, which a stream in order of place does with the last end in hand,
  and what the kept spans overlap goes before the next round.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.operators.gazetteer import text_blocks, text_window
from pagewright.operators.partitioning import ROW, stored, text_side

#: Candidates of an island that one row may hold.
LONG_ISLAND = 256


def islands(matches: DataFrame) -> DataFrame:
    """``matches`` with ``_island``, the number of a candidate's island in its article, and
    ``_size``, the number of candidates in it."""
    cols = matches.columns
    by = Window.partitionBy("doc_id").orderBy("start", "end", "priority", "label")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    m = matches.select(*cols, (reach.isNull() | (F.col("start") >= reach)).cast("int").alias("_new"))
    m = m.select(*cols, F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("_island"))
    return m.select("*", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "_island")).alias("_size"))


def resolve_overlaps(matches: DataFrame) -> DataFrame:
    """Keep a non-overlapping subset of candidate matches (same columns out).

    Spans are token-aligned, so two spans overlap in tokens exactly when their
    character intervals ``[start, end)`` overlap, which is what is tested.  Order of
    preference: more tokens, earlier start, better priority, label.  The candidates are
    written with their islands, so they are matched once however often the result is read.
    """
    cols = matches.columns
    m = stored(islands(matches))
    out = m.where("_size = 1").select(*cols).unionByName(_resolve_rows(m.where(f"_size BETWEEN 2 AND {LONG_ISLAND}"), cols))
    if (m.agg(F.max("_size")).first()[0] or 0) > LONG_ISLAND:
        out = out.unionByName(_resolve_rounds(m.where(f"_size > {LONG_ISLAND}"), cols))
    return out


def _resolve_rows(m: DataFrame, cols: list[str]) -> DataFrame:
    rest = [c for c in cols if c not in ("doc_id", "start", "priority", "label")]
    crowd = m.groupBy("doc_id", "_island").agg(F.sort_array(F.collect_list(F.struct(
        (-F.col("n_tokens")).alias("neg_len"), "start", "priority", "label", *rest))).alias("c"))

    def step(acc: Column, x: Column) -> Column:
        clash = F.exists(acc, lambda a: (a["start"] < x["end"]) & (x["start"] < a["end"]))
        return F.when(clash, acc).otherwise(F.concat(acc, F.array(x)))

    kept = F.aggregate(F.slice("c", 2, F.size("c")), F.slice("c", 1, 1), step)
    out = crowd.select("doc_id", F.explode(kept).alias("x"))
    return out.select("doc_id", *[F.col(f"x.{c}").alias(c) for c in cols if c != "doc_id"]).select(*cols)


def _from_left(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of spans in order of article, island and place, those that begin where the last kept one has ended."""
    key, end = None, 0
    for pdf in batches:
        keep = []
        for k, start, stop in zip(zip(pdf["doc_id"], pdf["_island"]), pdf["start"], pdf["end"]):
            if k != key or start >= end:
                key, end = k, stop
                keep.append(True)
            else:
                keep.append(False)
        yield pdf[keep]


def _resolve_rounds(m: DataFrame, cols: list[str]) -> DataFrame:
    """Long islands, a round per length; kept and live spans are written between rounds."""
    live = stored(m.drop("_size"))
    kept = None
    for n in sorted((r[0] for r in live.select("n_tokens").distinct().collect()), reverse=True):
        one = live.where(F.col("n_tokens") == n).repartition("doc_id", "_island").sortWithinPartitions(
            "doc_id", "_island", "start", "priority", "label")
        one = stored(one.mapInPandas(_from_left, one.schema))
        kept = one if kept is None else kept.unionByName(one)
        live = stored(drop_overlapping(live.where(F.col("n_tokens") < n), one))
    return kept.select(*cols)


def slice_text(text: Column, start: Column, end: Column) -> Column:
    """Python ``text[start:end]`` for 0 <= start; empty when end <= start."""
    return F.when(end > start, F.substring(text, start + 1, end - start)).otherwise(F.lit(""))


def window_text(text: Column, start: Column, end: Column, before: int, after: int,
                text_len: Column | None = None) -> Column:
    """``text[max(0, start-before) : min(len, end+after)]``."""
    lo = F.greatest(start - before, F.lit(0))
    hi = F.least(end + after, F.length(text) if text_len is None else text_len)
    return slice_text(text, lo, hi)


def attach_context(spans: DataFrame, docs: DataFrame | None = None, context_chars: int = 50) -> DataFrame:
    """``text[start-50 : end+50]`` of each span.

    From the window that a span carries (``win``, ``win_start``), which reaches that far;
    spans without one are joined back to the text of ``docs``.
    """
    keep = [c for c in spans.columns if c not in ("win", "win_start")]
    if "win" in spans.columns:
        low = F.greatest(F.col("start") - context_chars, F.lit(0))
        cut = F.substring("win", (low - F.col("win_start") + 1).cast("int"), (F.col("end") + context_chars - low).cast("int"))
        return spans.select(*spans.columns, cut.alias("context"))
    j = spans.join(text_side(docs), "doc_id")
    return j.select(*keep, window_text(F.col("text_body"), F.col("start"), F.col("end"),
                                       context_chars, context_chars, F.col("text_len")).alias("context"))


def attach_windows(spans: DataFrame, docs: DataFrame, before: int, after: int) -> DataFrame:
    """``spans`` without :data:`ROW` but with the text around them (``win``, ``win_start``), as
    matches carry it, from the rows of ``docs`` that they name.

    For spans that are few beside those they were chosen from: the spans of an article go to its
    text as one array, and only they get a window.
    """
    cols = [c for c in spans.columns if c != ROW]
    of = spans.groupBy(ROW).agg(F.sort_array(F.collect_list(F.struct("start", *[c for c in cols if c != "start"]))).alias("_spans"))
    # rows of one id and text are the same here: the first stands for all
    again = F.lag(ROW).over(Window.partitionBy(ROW).orderBy(ROW))
    texts = docs.select(ROW, "text", again.alias("_again")).where(F.col("_again").isNull()).hint("merge")
    rows = of.join(texts, ROW, "left").select("_spans", text_blocks("text"))

    def around(s: Column) -> Column:
        low = F.greatest(s["start"] - before, F.lit(0).cast("long"))
        return F.struct(*[s[c].alias(c) for c in cols], low.alias("win_start"), text_window("blocks", low, s["end"] + after).alias("win"))
    return rows.select(F.explode(F.transform("_spans", around)).alias("s")).select("s.*")


def first_occurrence(entities: DataFrame) -> DataFrame:
    """A5: per (article, label, lower-cased text) keep the earliest occurrence.

    An aggregate (partial on the map side) rather than a window.  Works with or
    without a ``context`` column.
    """
    carry = [c for c in ("start", "end", "text", "context", "source", "win_start", "win", ROW) if c in entities.columns]
    g = entities.groupBy("doc_id", "label", F.lower("text").alias("_k")).agg(
        F.min(F.struct(*carry)).alias("f"))
    return g.select("doc_id", "label", *[F.col(f"f.{c}").alias(c) for c in carry])


def entity_counts(entities: DataFrame) -> DataFrame:
    """A1: entities per label per article."""
    return entities.groupBy("doc_id", "label").agg(F.count(F.lit(1)).alias("n_entities"))


def drop_overlapping(candidates: DataFrame, blockers: DataFrame, bucket: int = 256) -> DataFrame:
    """J8 (compat): drop candidates that overlap any existing span in ``blockers``.

    Existing entities (for instance from a statistical-model hook) are never
    displaced by gazetteer matches.  Candidates and blockers of an article go through one
    window in order of place: a candidate overlaps a blocker when some blocker that begins
    before the candidate's end ends after its start.  Candidates are exchanged once, by
    article, as :func:`islands` needs them, and never written; ``bucket`` has no
    effect since.
    """
    key = ["doc_id", "start", "end"]
    cols = key + [c for c in candidates.columns if c not in key]
    c = candidates.select(*cols, F.lit(True).alias("_cand"), F.col("end").cast("long").alias("_at"))
    b = blockers.select(F.col("doc_id").cast(candidates.schema["doc_id"].dataType).alias("doc_id"),
                        F.lit(False).alias("_cand"), F.col("start").cast("long").alias("_at"), F.col("end").alias("_until"))
    b = b.where(F.col("doc_id").isNotNull() & F.col("_at").isNotNull() & F.col("_until").isNotNull())
    begun = Window.partitionBy("doc_id").orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    both = c.unionByName(b, allowMissingColumns=True).select("*", F.max("_until").over(begun).alias("_reach"))
    hit = F.coalesce(F.col("_reach") > F.col("start"), F.lit(False))
    return both.where(F.col("_cand") & ~hit).select(*cols)
