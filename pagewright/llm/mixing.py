"""Mixing sources to target weights by entropy balancing.

Targets are words per source.  Among all document rates with a source's target in
expected words, the one of least entropy relative to the base rate ``cap`` is
``cap * exp(-dual * size / mean size)``: an exponential tilt with one dual number
per source.  Newton iterations on the convex dual find it; each is one distributed
aggregation.  Rates are rounded into whole copies, by a hash of doc_id and text and a
threshold per source that brings the rounded words to the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import count_words, written
from pagewright.llm.sharding import uniform
from pagewright.operators.partitioning import size_checked_broadcast

WEIGHTS = (3.0, 1.0, 2.0)
#: Newton iterations; from a dual of 0 they come from one side, and the last steps are quadratic.
ITERATIONS = 40
#: Expected words may miss a target by this part of it.
PRECISION = 1e-9
#: The rounding threshold is searched in so many bins, so many times over.
BINS, PASSES = 4096, 3
#: Documents that fill what a source's rounded words are short of its target.
FILLS = 3
#: Up to so many sources (some dozen bytes each) are broadcast; beyond, the join is a shuffle that Spark splits by skew.
BROADCAST_SOURCES = 200_000


def source_targets(sizes: DataFrame, budget_share: float = 1.5, cap: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """``source, source_size, target`` from rows ``source, size, n`` (``n`` documents of a size).

    Sources by code point, null last, weigh ``weights`` in turn and share
    ``budget_share`` of all words.  A target stops at ``cap`` times its source's words
    and the excess is shared by weight among the others: the sources are filled in the
    order of cap by weight, so that one pass finds the level at which none is above.
    The ordered windows see one row per source.
    """
    s = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])
    s = s.withColumn("w", F.get(turn, ((F.row_number().over(order) - 1) % len(weights)).cast("int")))
    s = s.withColumn("most", F.col("source_size") * F.lit(cap))
    fill = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) * F.lit(budget_share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_ = F.sum("w").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    s = s.withColumn("level", left / open_)
    s = s.withColumn("level", F.max(F.when(F.col("level") * F.col("w") <= F.col("most"), F.col("level"))).over(whole))
    return s.select("source", "source_size", F.when(F.col("level").isNull() | (F.col("level") * F.col("w") >= F.col("most")),
                                                    F.col("most")).otherwise(F.col("level") * F.col("w")).alias("target"))


def _rate(size: Column, mean: Column, dual: Column, cap: float) -> Column:
    return F.lit(cap) * F.exp(-dual * F.when(mean > 0, size / mean).otherwise(F.lit(0.0)))


def _exact(x: Column) -> Column:
    """A sum that does not depend on the order of its terms."""
    return F.sum(x.cast("decimal(38,8)")).cast("double")


def balance(sizes: DataFrame, targets: DataFrame, cap: float = 2.0) -> DataFrame:
    """``targets`` with the dual and the mean size of each source.

    ``sizes`` has a row per source and size, so a source with a third of all documents
    is no larger a group than its number of different sizes.
    """
    mean = sizes.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = targets.join(mean, targets["source"].eqNullSafe(mean["source"])).select(
        targets["*"], "mean", F.lit(0.0).alias("dual"), F.lit(1.0).alias("miss"))
    state = written(state)
    few = state.count() <= BROADCAST_SOURCES
    for _ in range(ITERATIONS):
        t = sizes.join(F.broadcast(state) if few else state, sizes["source"].eqNullSafe(state["source"])).select(
            state["*"], "size", "n")
        words = F.col("n") * F.col("size") * _rate(F.col("size"), F.col("mean"), F.col("dual"), cap)
        sums = t.groupBy(*state.columns).agg(
            _exact(words).alias("_f"),
            _exact(words * F.when(F.col("mean") > 0, F.col("size") / F.col("mean")).otherwise(0.0)).alias("_g"))
        step = F.when(F.col("_g") > 0, (F.col("_f") - F.col("target")) / F.col("_g")).otherwise(F.lit(0.0))
        state = written(sums.select("source", "source_size", "target", "mean",
                                    F.greatest(F.col("dual") + step, F.lit(0.0)).alias("dual"),
                                    (F.abs(F.col("_f") - F.col("target")) / F.greatest(F.col("target"), F.lit(1.0))).alias("miss")))
        if not state.where(F.col("miss") > PRECISION).take(1):
            break
    return state.drop("miss")


def solve(docs: DataFrame, budget_share: float = 1.5, cap: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """What decides the copies of a document, a row per source: target, dual, the rounding
    threshold and the documents that fill the rest.  ``with_copies`` applies it."""
    rows = docs.select(_key(), "source", count_words(F.col("text")).alias("_mx_size"))
    # rows of equal doc_id and text have one key, and count together
    rows = written(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_mx_n")))
    sizes = written(rows.groupBy("source", F.col("_mx_size").alias("size")).agg(F.sum("_mx_n").alias("n")))
    state = balance(sizes, source_targets(sizes, budget_share, cap, weights), cap)
    state = state.select(*[F.col(c).alias(f"_mx_{c}") for c in state.columns])
    own = list(state.columns)

    # the threshold: the bin whose words pass the target, then again the bin inside it
    state = state.withColumns({"_mx_low": F.lit(-1.0), "_mx_width": F.lit(2.0), "_mx_fill": F.array().cast("array<string>")})
    low, width, whole = (F.col(f"_mx_{c}") for c in ("low", "width", "whole"))
    size = F.col("_mx_size") * F.col("_mx_n")
    for _ in range(PASSES):
        t = _with_rate(rows, state, cap)
        inside = (F.col("_mx_v") >= low) & (F.col("_mx_v") < low + width)
        at = F.least(F.floor((F.col("_mx_v") - low) / width * BINS), F.lit(BINS - 1))
        sure = size * (whole + F.when(F.col("_mx_v") < low, 1).otherwise(0))
        hist = t.withColumn("_bin", F.when(inside, at).otherwise(-1).cast("int")).groupBy(*state.columns, "_bin").agg(
            F.sum(sure).alias("_sure"), F.sum(F.when(F.col("_bin") >= 0, size).otherwise(0)).alias("_words"))
        by = Window.partitionBy("_mx_source")
        hist = hist.withColumn("_gap", F.col("_mx_target") - F.sum("_sure").over(by)).withColumn(
            "_upto", F.sum("_words").over(by.orderBy("_bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        passed = F.min(F.when((F.col("_bin") >= 0) & (F.col("_upto") > F.col("_gap")), F.col("_bin")))
        step = width / BINS
        state = written(hist.groupBy(*state.columns).agg(passed.alias("_at")).select(
            *own, F.coalesce(low + step * F.col("_at"), low + width).alias("_mx_low"), step.alias("_mx_width"), "_mx_fill"))

    # what the threshold leaves short is filled by the largest document that fits, with all rows
    # that are equal to it, a few times over; none that has as many copies as it may
    state = written(_with_rate(rows, state, cap).groupBy(*state.columns).agg(
        (F.first("_mx_target") - F.sum(size * F.col("_mx_copies"))).alias("_mx_gap")))
    for _ in range(FILLS):
        t = _with_rate(rows, state, cap)
        fits = (size > 0) & (size <= F.col("_mx_gap")) & (F.col("_mx_copies") == F.col("_mx_base")) & (F.col("_mx_copies") < int(cap))
        pick = F.max(F.when(fits, F.struct(size.alias("size"), "_mx_v", F.col("_mx_key").alias("id"))))
        state = written(t.groupBy(*state.columns).agg(pick.alias("_pick")).select(
            *own, "_mx_low", "_mx_width",
            F.when(F.col("_pick").isNotNull(), F.concat("_mx_fill", F.array("_pick.id"))).otherwise(F.col("_mx_fill")).alias("_mx_fill"),
            (F.col("_mx_gap") - F.coalesce(F.col("_pick.size"), F.lit(0))).alias("_mx_gap")))
    return state


def _key() -> Column:
    """What tells a document, also among those that share a doc_id or have none."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                       F.hex(F.xxhash64("text")), F.hex(F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")))).alias("_mx_key")


def _with_rate(rows: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """``rows`` (with ``_mx_key, _mx_size``) joined to their source's state, and their copies."""
    draw = uniform(F.concat(F.lit("mix:"), F.col("_mx_key")))
    rate = _rate(F.col("_mx_size"), F.col("_mx_mean"), F.col("_mx_dual"), cap)
    t = rows.join(size_checked_broadcast(state, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("_mx_source")))
    t = t.withColumn("_mx_rate", rate).withColumn("_mx_whole", F.least(F.floor("_mx_rate"), F.lit(int(cap))).cast("int"))
    # a further copy is taken where the draw is below the rate's fraction by more than the threshold
    t = t.withColumn("_mx_v", F.when(F.col("_mx_whole") < int(cap), draw - (F.col("_mx_rate") - F.col("_mx_whole"))))
    t = t.withColumn("_mx_base", F.col("_mx_whole") + F.when(F.col("_mx_v") < F.col("_mx_low"), 1).otherwise(0))
    return t.withColumn("_mx_copies", F.when(F.array_contains("_mx_fill", F.col("_mx_key")), F.col("_mx_base") + 1)
                        .otherwise(F.col("_mx_base")).cast("int"))


def with_copies(docs: DataFrame, state: DataFrame, cap: float = 2.0) -> DataFrame:
    """``docs`` with all their columns and ``_mx_copies``, ``_mx_size`` and the state's columns."""
    return _with_rate(docs.withColumns({"_mx_key": _key(), "_mx_size": count_words(F.col("text"))}), state, cap)


def mix_documents(docs: DataFrame, budget_share: float = 1.5, cap: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """Copies of every row of ``docs``: ``doc_id, source, size, source_size, target, rate, copies, taken``.

    Size is the number of words (null text: 0, which takes no part in the totals but
    gets copies like any other).  A null source is a source of its own, last in order.
    No document gets more than ``cap`` copies, a whole number.  Rows with equal doc_id
    and text get equal copies.  Equal input gives equal output: sums are exact and the
    draw is a hash of doc_id and text.  A source's words fall short of its target by less than
    the next draw's words, and mostly by far less.  Other columns are left out; an empty
    table gives an empty result.
    """
    docs = docs.select("doc_id", "source", "text")
    out = with_copies(docs, solve(docs, budget_share, cap, weights), cap)
    return out.select("doc_id", "source", *[F.col(f"_mx_{c}").alias(c) for c in ("size", "source_size", "target", "rate", "copies")],
                      (F.col("_mx_size") * F.col("_mx_copies")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, budget_share: float = 1.5, cap: float = 2.0, weights=WEIGHTS) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it has copies."""
    out = with_copies(docs, solve(docs, budget_share, cap, weights), cap).where("_mx_copies > 0")
    return out.withColumn("_mx_copy", F.explode(F.sequence(F.lit(1), "_mx_copies"))).select(*docs.columns)
