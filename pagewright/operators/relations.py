"""Nearby-entity pairs (J2, W1, O7, E4-E6), rule scorer (X2), confidence filter (O8), counts (A2).

Pairs are every ordered (e1, e2) of one article with e1 before e2 in
``(start, label, end)`` order and ``e2.start - e1.end <= max_gap``.  Spark
has no range-join operator, so the join is bucketed: e2 sits in bucket
``floor(start / B)``, e1 is exploded over the buckets its reach
``[start, end + max_gap]`` touches, and the pair is an equi-join on
``(doc_id, bucket)`` plus the exact predicate.  Each e2 has one bucket, so no
pair is produced twice, and a long article is spread over many buckets
(tasks) instead of one.  No partner cap: every pair within the gap is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.operators.partitioning import text_side

from pagewright.operators.spans import slice_text, window_text

# ---------------------------------------------------------------------------
# Default rule scorer (relation, confidence).
# ---------------------------------------------------------------------------
COPULA_CUE = r"(?i)(?:\A|[^A-Za-z])(?:is|are|was|were|as)(?:[^A-Za-z]|\z)"
LOCATION_CUE = r"(?i)(?:\A|[^A-Za-z])(?:found|located|in)(?:[^A-Za-z]|\z)"
RULES = [
    ("HAS_BIOMARKER", 0.9),   # disease with biomarker, either order
    ("IS_A", 0.85),           # protein and biomarker with a copula cue, either order
    ("FOUND_IN", 0.8),        # protein and brain region with a location cue
    ("RELATED_TO", 0.5),      # anything else (below the default threshold)
]


def entity_pairs(entities: DataFrame, max_gap: int = 200, bucket: int = 256) -> DataFrame:
    """``(doc_id, e1_*, e2_*)`` for all ordered pairs within ``max_gap`` characters."""
    cols = ["label", "text", "start", "end", *[c for c in ("win_start", "win") if c in entities.columns]]
    e = entities.select("doc_id", *cols)
    a = e.select("doc_id", *[F.col(c).alias(f"e1_{c}") for c in cols],
                 F.explode(F.sequence(F.floor(F.col("start") / bucket),
                                      F.floor((F.col("end") + max_gap) / bucket))).alias("bucket"))
    b = e.select("doc_id", *[F.col(c).alias(f"e2_{c}") for c in cols],
                 F.floor(F.col("start") / bucket).alias("bucket"))
    first = F.struct("e1_start", "e1_label", "e1_end") < F.struct("e2_start", "e2_label", "e2_end")
    j = a.join(b, ["doc_id", "bucket"]).where(first & (F.col("e2_start") - F.col("e1_end") <= max_gap))
    return j.drop("bucket")


def pair_text(pairs: DataFrame, docs: DataFrame | None = None, context_chars: int = 20) -> DataFrame:
    """Add between-text, the model sample string and the pair context.

    Both entities carry the text around them (``e1_win``, ``e2_win``): the first one's reaches
    to where the second may begin, so the text between and the context are cut from the two.
    Pairs without them are joined back to the text of ``docs``.
    """
    if "e1_win" in pairs.columns:
        def cut(e: str, low: Column, high: Column) -> Column:
            return F.when(high > low, F.substring(f"{e}_win", (low - F.col(f"{e}_win_start") + 1).cast("int"), (high - low).cast("int"))) \
                .otherwise(F.lit(""))
        start = F.greatest(F.col("e1_start") - context_chars, F.lit(0))
        between = cut("e1", F.col("e1_end"), F.col("e2_start"))
        ctx = F.concat(cut("e1", start, F.col("e2_start")), cut("e2", F.col("e2_start"), F.col("e2_end") + context_chars))
        j, keep = pairs, [c for c in pairs.columns if not c.endswith(("_win", "_win_start"))]
    else:
        j, keep = pairs.join(text_side(docs), "doc_id"), pairs.columns
        between = slice_text(F.col("text_body"), F.col("e1_end"), F.col("e2_start"))
        ctx = window_text(F.col("text_body"), F.col("e1_start"), F.col("e2_end"), context_chars, context_chars, F.col("text_len"))
    return j.select(*keep, between.alias("between"), F.concat_ws(" [SEP] ", "e1_text", between, "e2_text").alias("sample"),
                    ctx.alias("context"))


def rule_score(t1: Column, t2: Column, between: Column) -> Column:
    """Default scorer: struct(relation, confidence) from the types and the between-text."""
    def pair(x, y):
        return ((t1 == x) & (t2 == y)) | ((t1 == y) & (t2 == x))
    rel = (F.when(pair("DISEASE", "BIOMARKER"), F.lit(RULES[0][0]))
           .when(pair("PROTEIN", "BIOMARKER") & between.rlike(COPULA_CUE), F.lit(RULES[1][0]))
           .when(pair("PROTEIN", "BRAIN_REGION") & between.rlike(LOCATION_CUE), F.lit(RULES[2][0]))
           .otherwise(F.lit(RULES[3][0])))
    # by the same conditions and not by the relation: a test of a text is made only where the types fit
    conf = F.when(pair("DISEASE", "BIOMARKER"), RULES[0][1]).when(pair("PROTEIN", "BIOMARKER") & between.rlike(COPULA_CUE), RULES[1][1]) \
        .when(pair("PROTEIN", "BRAIN_REGION") & between.rlike(LOCATION_CUE), RULES[2][1]).otherwise(RULES[3][1])
    return F.struct(rel.alias("relation"), conf.cast("double").alias("confidence"))


def score_relations(pairs_with_text: DataFrame, min_confidence: float = 0.7) -> DataFrame:
    """X2 + O8: score each pair, keep those strictly above ``min_confidence``."""
    s = pairs_with_text.select(
        "doc_id", F.col("e1_text").alias("entity1"), F.col("e1_label").alias("entity1_type"),
        F.col("e2_text").alias("entity2"), F.col("e2_label").alias("entity2_type"),
        rule_score(F.col("e1_label"), F.col("e2_label"), F.col("between")).alias("r"), "context")
    s = s.select("doc_id", "entity1", "entity1_type", "entity2", "entity2_type",
                 F.col("r.relation").alias("relation"), F.col("r.confidence").alias("confidence"), "context")
    return s.where(F.col("confidence") > min_confidence)


def per_article_counts(docs: DataFrame, entities: DataFrame, relations: DataFrame,
                       aliases: DataFrame) -> DataFrame:
    """A1/A2 totals per article; articles with nothing found show zeros."""
    def cnt(df, name):
        return df.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name))
    out = docs.select("doc_id")
    for df, name in ((entities, "n_entities"), (relations, "n_relations"), (aliases, "n_aliases")):
        out = out.join(cnt(df, name), "doc_id", "left")
    return out.fillna(0, ["n_entities", "n_relations", "n_aliases"])


RELATION_SCORE_SCHEMA = "relation string, confidence double"


def score_relations_with_model(pairs_with_text: DataFrame, scorer, min_confidence: float = 0.7) -> DataFrame:
    """X2 hook: a caller-supplied batch classifier on the ``sample`` strings.

    ``scorer(pandas.Series of samples) -> pandas.DataFrame(relation, confidence)``
    runs through ``mapInPandas`` (Arrow batches, one model load per Python
    worker); the threshold O8 stays a Spark filter.
    """
    import pandas as pd

    from pyspark.sql import types as T
    out_schema = T.StructType(list(pairs_with_text.schema.fields) + [
        T.StructField("relation", T.StringType()), T.StructField("confidence", T.DoubleType())])

    def batches(it):
        for pdf in it:
            scored = scorer(pdf["sample"])
            yield pd.concat([pdf.reset_index(drop=True), scored.reset_index(drop=True)], axis=1)

    s = pairs_with_text.mapInPandas(batches, out_schema)
    s = s.select("doc_id", F.col("e1_text").alias("entity1"), F.col("e1_label").alias("entity1_type"),
                 F.col("e2_text").alias("entity2"), F.col("e2_label").alias("entity2_type"),
                 "relation", "confidence", "context")
    return s.where(F.col("confidence") > min_confidence)
