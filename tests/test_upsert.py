"""Keyed writes: last wins, first wins, idempotent append, concept relationships."""

from pagewright.operators import upsert as U


def test_upsert_last_wins_keeps_id(spark):
    ex = spark.createDataFrame([("a", 1, "old", 1), ("b", 2, "b0", 2)], "key string, id long, value string, ordinal long")
    inc = spark.createDataFrame([("a", "v1", 5), ("a", "v2", 9), ("c", "c1", 3)], "key string, value string, ordinal long")
    out = {r.key: (r.id, r.value) for r in U.upsert_last_wins(ex, inc, "key", ["ordinal"]).collect()}
    assert out == {"a": (1, "v2"), "b": (2, "b0"), "c": (3, "c1")}


def test_first_wins_and_idempotent_append(spark):
    ex = spark.createDataFrame([("a", "x", 1)], "key string, value string, ordinal long")
    inc = spark.createDataFrame([("a", "y", 0), ("b", "p", 7), ("b", "q", 4)], "key string, value string, ordinal long")
    out = {r.key: r.value for r in U.insert_first_wins(ex, inc, "key", ["ordinal"]).collect()}
    assert out == {"a": "x", "b": "q"}
    once = U.append_idempotent(ex.select("key", "value"), inc.select("key", "value"), ["key", "value"])
    twice = U.append_idempotent(once, inc.select("key", "value"), ["key", "value"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_contrast_beats_relationship(spark):
    rel = spark.createDataFrame([("c1", "t1", "rel", "fwd", 0)],
                                "concept_id string, related_concept_id string, relationship string, direction string, pos long")
    con = spark.createDataFrame([("c1", "t1", "measures", 0)], "concept_id string, task_id string, relationship string, pos long")
    r = U.upsert_concept_relationships(rel, con).collect()
    assert [(x.related_concept_id, x.relationship, x.direction) for x in r] == [("t1", "measures", "MEASUREDBY")]


def test_dense_ids_are_contiguous(spark):
    keys = spark.range(0, 1000).selectExpr("CAST(id * 7 % 1000 AS STRING) AS key").repartition(5)
    ids = sorted(r.id for r in U.dense_ids(keys, "key", 10).collect())
    assert ids == list(range(11, 1011))


def test_reruns_with_nulls_add_nothing(spark):
    from pagewright.operators import upsert as U
    rows = spark.createDataFrame([("a", None, 1), (None, "x", 2), (None, None, 3)], "k string, v string, ordinal long")
    none = rows.limit(0)
    once = U.append_idempotent(none, rows, ["k", "v"])
    assert once.count() == U.append_idempotent(once, rows, ["k", "v"]).count() == 3
    first = U.insert_first_wins(none, rows, "k", ["ordinal"])
    assert first.count() == U.insert_first_wins(first, rows, "k", ["ordinal"]).count() == 2
    assert {r.k for r in U.dense_ids(rows, "k").collect()} == {"a"}
