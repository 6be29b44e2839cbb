"""Classifiers: held-out accuracy, no look at held-out labels, awkward rows."""

import numpy as np
from pyspark.sql import functions as F

from awkward import awkward_rows, documents, empty
from pagewright.llm import nbsvm as N
from pagewright.llm import q_models
from pagewright.llm import toxicity as X
from pagewright.llm.training import fold_of

SF = "/root/testdata/sf0.01"


def _tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def _held_out(spark, query, label):
    pdf = query(spark, SF).join(_tables(spark)[1], "doc_id").where("held_out").toPandas()
    return pdf["predicted"].to_numpy(), pdf[label].to_numpy(), pdf["score"].to_numpy()


def test_quality_on_held_out_rows(spark):
    p, y, s = _held_out(spark, q_models.op8_quality_classifier, "quality")
    assert (p == y).mean() > 0.95 and ((s >= 0) & (s <= 1)).all()


def test_toxicity_on_held_out_rows(spark):
    p, y, s = _held_out(spark, q_models.op6_toxicity, "toxic")
    assert (p == y).mean() > 0.9 and p[y == 1].mean() > 0.6 and p[y == 0].mean() < 0.05


def test_held_out_labels_and_ids_are_not_read(spark):
    docs, labels = _tables(spark)
    flipped = labels.withColumn("quality", F.when(fold_of(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = N.fit(docs, labels), N.fit(docs.drop("lang", "source"), flipped)
    assert np.array_equal(a.weight, b.weight) and (a.slope, a.shift) == (b.slope, b.shift)


def test_hinge_fit_separates_and_prefers_the_right_columns():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 200)
    rows = [np.array([0 if k else 1, 2 + int(rng.integers(0, 50))]) for k in y]
    w = N.descend(rows, np.ones(60), y)
    assert w[0] > 0 > w[1]
    assert all((w[r].sum() > 0) == bool(k) for r, k in zip(rows, y))


def test_models_on_awkward_rows(spark):
    docs, labels = _tables(spark)
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 1), (5, None, None), (5, 0, 1), (5, 1, 0)], labels.schema))
    model, lexicon = N.fit(docs, labels), X.fit(docs, labels)
    odd = documents(spark)
    n = len(awkward_rows())
    for out in (N.score(odd, model), X.score(odd, lexicon)):
        rows = out.collect()
        assert len(rows) == n and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    for out in (N.score(empty(spark), model), X.score(empty(spark), lexicon)):
        assert out.count() == 0


def test_without_labels_the_score_is_the_prior(spark):
    docs, labels = _tables(spark)
    none = labels.where("false")
    assert {r.score for r in N.score(docs.limit(5), N.fit(docs, none)).collect()} == {0.5}
    assert {r.score for r in X.score(docs.limit(5), X.fit(docs, none)).collect()} == {0.5}


def test_folding():
    assert X.fold("IDI0T ѕtupіd l0$er 1oser") == "idiot stupid loser ioser"
    assert X.fold("in 2019, 40 of 5") == "in 2019, 40 of 5"
    assert X.fold("st​upid") == "stupid"


def test_rare_words_stay_in_the_lexicon_however_many_rows_there_are(spark, monkeypatch):
    n = 2400
    rows = [(i, f"common words of text {i % 50} " + ("vilerabbit" if i < 24 else "horrid" if i % 2 == 0 else "nice") + " and more", None, None, 0)
            for i in range(n)]
    labels = spark.createDataFrame([(i, 1, int(i % 2 == 0 or i < 24)) for i in range(n)], "doc_id long, quality int, toxic int")
    a = X.fit(documents(spark, rows), labels)
    assert {"=vilerabbit", "=horrid"} <= a.weights.keys() and "=common" not in a.weights
    monkeypatch.setattr(X, "BY_NAME", 0)
    b = X.fit(documents(spark, rows), labels)
    assert a.weights == b.weights and a.exceptions == b.exceptions


def test_weights_equal_plain_counts(spark):
    docs, labels = _tables(spark)
    pdf = docs.join(labels, "doc_id").where((fold_of(F.col("doc_id"), 4) != 2)).select("text", "toxic").toPandas()
    counts, n = ({}, {}), [0, 0]
    for t, y in zip(pdf["text"], pdf["toxic"]):
        n[y] += 1
        for e in X.entries(t or ""):
            counts[y][e] = counts[y].get(e, 0) + 1
    want = {e: np.log((k + .5) / (n[1] + 1)) - np.log((counts[0].get(e, 0) + .5) / (n[0] + 1)) for e, k in counts[1].items() if k >= X.MIN_DOCS}
    got = X.fit(docs, labels).weights
    assert got.keys() == {e for e, w in want.items() if w >= X.MIN_WEIGHT} and all(abs(want[e] - w) < 1e-9 for e, w in got.items())


def test_the_word_before_a_hit_may_be_long():
    word = "extraordinarily" * 6
    lex = X.Lexicon({"=trash": 5.0}, {word + " trash"})
    assert X.measure(f"so {word} ,, trash", lex.automaton(), lex.exceptions)[0] == 0.0
    assert X.phrases("a1b trash", 4, 9) == ["b trash"] and X.phrases("trash", 0, 5) == []


def test_exceptions_and_length():
    lex = X.Lexicon({"=trash": 5.0, "scum": 4.0}, {"trash can"})
    a = lex.automaton()
    assert X.measure("the trash can", a, lex.exceptions) == (0.0, 3)
    assert X.measure("you trash, scummy", a, lex.exceptions) == (9.0, 3)
    assert X.measure("trashy unscum", a, lex.exceptions) == (0.0, 2)
    few, many = X.columns([5.0, 5.0], [10, 5000])
    assert few[1] > many[1]
