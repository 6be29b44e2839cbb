"""Queries of the operators that learn from labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagewright.llm import nbsvm as N
from pagewright.llm import toxicity as X
from pagewright.llm.common import read
from pagewright.llm.training import fold_of


def op6_toxicity(spark, sf_dir):
    """Toxicity of all documents by a lexicon learned outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    lexicon = X.fit(docs, read(spark, sf_dir, "labels"))
    return X.score(docs, lexicon).select(
        "doc_id", (fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted", "hits")


def op8_quality_classifier(spark, sf_dir):
    """Quality of all documents by a model learned outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    model = N.fit(docs, read(spark, sf_dir, "labels"))
    return N.score(docs, model).select("doc_id", (fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


QUERIES = {"op6_toxicity": op6_toxicity, "op8_quality_classifier": op8_quality_classifier}
ORACLE: dict[str, str] = {}
