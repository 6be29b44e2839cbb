"""Quality classifier: a linear support vector machine on n-gram indicators that are
scaled by their class log-count ratios (naive Bayes support vectors).

The log-count ratios come from all labelled training rows, counted on the executors.
The hinge-loss model is then fitted by dual coordinate descent on a bounded sample
of those rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pagewright.llm import training as T
from pagewright.llm import wordhash as H

#: n-grams are hashed to so many columns.
COLUMNS = 1 << 18
#: Labelled rows on which the hinge-loss model is fitted, the only sampled step.
SAMPLE = 6000
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 20

_CLASS = bytearray(range(256))
for _c in range(256):
    _CLASS[_c] = (ord("A") if 65 <= _c <= 90 else ord("a") if 97 <= _c <= 122 or _c >= 128
                  else ord("9") if 48 <= _c <= 57 else _c)
_CLASS = bytes(_CLASS)


def _shape(word: bytes) -> int:
    """The kinds of a word's first two and last two characters."""
    kinds = word.translate(_CLASS)
    return int.from_bytes(kinds[:2] + kinds[-2:], "little")


def features(texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature columns of each text, as one array and each text's start in it.

    Features are the words, and n-grams of one to three word shapes; a shape also tells
    whether the word equals the one before it.
    """
    words, at = H.split_words(texts, lower=False)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    if not words:
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    codes, unique = pd.factorize(H.as_objects(words))
    word = H.hashes(list(unique))[codes]
    shape = np.array([_shape(u) for u in unique], dtype=np.uint64)[codes]
    inside = np.ones(len(codes), bool)
    inside[at[:-1][at[:-1] < len(codes)]] = False
    shape[1:] |= (inside[1:] & (codes[1:] == codes[:-1])).astype(np.uint64) << np.uint64(40)
    parts = [(doc, word)]
    for k in (1, 2, 3):
        n = len(shape) - k + 1
        if n > 0:
            same = doc[:n] == doc[k - 1:]
            parts.append((doc[:n][same], (H.windows(shape, k) + np.uint64(k))[same]))
    key = np.concatenate([d.astype(np.int64) * COLUMNS + (H.mix(x) % np.uint64(COLUMNS)).astype(np.int64) for d, x in parts])
    key = np.unique(key)
    owner = key // COLUMNS
    return key % COLUMNS, np.searchsorted(owner, np.arange(len(at)))


@dataclass
class Model:
    """``score`` is a sigmoid of the margin; a model without both classes gives ``prior``."""

    ratio: np.ndarray
    weight: np.ndarray
    slope: float
    shift: float
    prior: float


def _counts(batches):
    total = np.zeros((2, COLUMNS), np.int64)
    docs = np.zeros(2, np.int64)
    for pdf in batches:
        for low, high in H.chunks(pdf["text"]):
            y = pdf["y"].to_numpy()[low:high]
            column, at = features(pdf["text"].iloc[low:high])
            label = np.repeat(y, np.diff(at))
            for c in (0, 1):
                total[c] += np.bincount(column[label == c], minlength=COLUMNS)
                docs[c] += int((y == c).sum())
    some = np.flatnonzero(total.any(axis=0))
    yield pd.DataFrame({"column": np.append(some, -1), "n0": np.append(total[0][some], docs[0]),
                        "n1": np.append(total[1][some], docs[1])})


def _sampled(batches):
    for pdf in batches:
        for low, high in H.chunks(pdf["text"]):
            column, at = features(pdf["text"].iloc[low:high])
            part = pdf.iloc[low:high]
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "y": part["y"].to_numpy(),
                                "columns": np.split(column.astype(np.int32), at[1:-1])})


def descend(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Dual coordinate descent for the squared hinge loss on unit-length rows."""
    x = []
    for r in rows:
        v = ratio[r]
        x.append(v / (np.sqrt((v * v).sum()) or 1.0))
    weight, alpha, sign = np.zeros(len(ratio)), np.zeros(len(rows)), np.where(y == 1, 1.0, -1.0)
    order, draw = np.arange(len(rows)), np.random.default_rng(1)
    # the rarer class costs as much in sum
    share = np.array([max(1, (y == c).sum()) for c in (0, 1)])
    diagonal = (0.5 * share / (cost * share.min()))[y]
    square = np.array([(v * v).sum() for v in x]) + diagonal
    for _ in range(epochs):
        draw.shuffle(order)
        most = 0.0
        for i in order:
            r, v = rows[i], x[i]
            if not len(r):
                continue
            slope = sign[i] * (weight[r] @ v) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - slope / square[i], 0.0)
            if new != alpha[i]:
                most = max(most, abs(new - alpha[i]))
                weight[r] += (new - alpha[i]) * sign[i] * v
                alpha[i] = new
        if most < 1e-4:
            break
    return weight


def _margins(column: np.ndarray, at: np.ndarray, ratio: np.ndarray, weight: np.ndarray) -> np.ndarray:
    v = ratio[column]
    top = np.concatenate([[0], np.cumsum(v * weight[column])])
    norm = np.concatenate([[0], np.cumsum(v * v)])
    return (top[at[1:]] - top[at[:-1]]) / np.sqrt(np.maximum(norm[at[1:]] - norm[at[:-1]], 1e-12))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0,
        sample: int = SAMPLE) -> Model:
    """A model from the labelled rows outside the held-out fold.

    To the driver come one count row per hashed column, and the distinct columns of at
    most ``sample`` rows; both are bounded whatever the size of the input.
    """
    wanted = T.training_labels(labels, label, folds, held_out)
    counts = (T.labelled(docs, wanted).select("text", "y").mapInPandas(_counts, "column long, n0 long, n1 long")
              .groupBy("column").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas())
    n = np.zeros((2, COLUMNS))
    head = counts["column"] == -1
    docs0, docs1 = (float(counts.loc[head, c].sum()) for c in ("n0", "n1"))
    prior = (docs1 + 1) / (docs0 + docs1 + 2)
    if not docs0 or not docs1:
        return Model(np.zeros(COLUMNS), np.zeros(COLUMNS), 0.0, 0.0, prior)
    body = counts[~head]
    n[0, body["column"]], n[1, body["column"]] = body["n0"], body["n1"]
    n += SMOOTHING
    ratio = np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum())
    part = T.labelled(docs, T.bounded_sample(wanted, sample)).mapInPandas(
        _sampled, "doc_id long, y int, columns array<int>").toPandas().sort_values("doc_id", kind="stable")
    rows, y = [np.asarray(r, dtype=np.int64) for r in part["columns"]], part["y"].to_numpy()
    if len(set(y)) < 2:
        return Model(np.zeros(COLUMNS), np.zeros(COLUMNS), 0.0, 0.0, prior)
    weight = descend(rows, ratio, y)
    # the sigmoid is fitted on margins of rows that their own model has not seen
    half = np.arange(len(y)) % 2
    margin = np.zeros(len(y))
    for h in (0, 1):
        if len(set(y[half != h])) == 2:
            w = descend([r for r, k in zip(rows, half) if k != h], ratio, y[half != h])
        else:
            w = weight
        own = [r for r, k in zip(rows, half) if k == h]
        at = np.concatenate([[0], np.cumsum([len(r) for r in own])]).astype(np.int64)
        margin[half == h] = _margins(np.concatenate(own) if own else np.zeros(0, np.int64), at, ratio, w)
    slope, shift = T.logistic(margin[:, None], y.astype(float))
    return Model(ratio, weight, float(slope), float(shift), prior)


def scorer(model: Model):
    """A column function: the score of a text column.  Only the text is read; a null or
    empty text has no features and gets the model's score at margin 0."""
    ratio, weight = model.ratio.astype(np.float32), model.weight.astype(np.float32)
    slope, shift, prior, flat = model.slope, model.shift, model.prior, not model.weight.any()

    def scored(texts: pd.Series) -> pd.Series:
        wide, tall = ratio.astype(np.float64), weight.astype(np.float64)
        out = np.full(len(texts), prior)
        for low, high in () if flat else H.chunks(texts):
            column, at = features(texts.iloc[low:high])
            out[low:high] = T.sigmoid(slope * _margins(column, at, wide, tall) + shift)
        return pd.Series(out)

    return F.pandas_udf(scored, DoubleType())


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``docs``.  Other columns are left out;
    an empty table gives an empty result."""
    out = docs.select("doc_id", scorer(model)(F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
