"""Labelled rows of a text table, and small fits, shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.operators.partitioning import size_checked_broadcast

#: Up to so many labelled ids (16 bytes each) are broadcast; beyond that the texts are joined by a shuffle.
BROADCAST_LABELS = 4_000_000


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the doc_id as text, modulo ``folds``; a null doc_id counts as empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """``doc_id, y`` of the labelled ids outside the held-out fold.  Null ids and labels
    are left out; an id with several labels has the one that most of its rows have, 1 if equal."""
    rows = labels.select("doc_id", F.col(label).cast("double").alias("v")).where(
        F.col("doc_id").isNotNull() & F.col("v").isNotNull() & (fold_of(F.col("doc_id"), folds) != held_out))
    return rows.groupBy("doc_id").agg((F.avg("v") >= 0.5).cast("int").alias("y"))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, y`` of the labelled documents, null texts as empty."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).join(
        size_checked_broadcast(labels, BROADCAST_LABELS), "doc_id")


def bounded_sample(labels: DataFrame, most: int) -> DataFrame:
    """At most ``most`` labelled ids, those of lowest hash: a fixed random sample."""
    return labels.orderBy(F.xxhash64(F.col("doc_id")), "doc_id").limit(most)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression on a few columns, the last a constant."""
    x = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], ridge)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep + 1e-9), x.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
