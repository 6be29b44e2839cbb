"""Plan-shape and invariance checks."""

from pagewright.plans import registry as R

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _static(spark, build):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return _plan(build())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_matching_stays_in_the_scan_stage(spark):
    from pagewright.operators.gazetteer import match_gazetteer
    from pagewright.plans import pipeline as PL
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    g = PL.gazetteer_of(R._gazetteer(spark, SF))
    for around in (0, 50):
        plan = _static(spark, lambda: match_gazetteer(docs, g, around, around))  # noqa: B023
        # the documents scan reads only the two columns it needs, and flows into the gazetteer join
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
        assert plan.count("documents.parquet") == 1 and "BroadcastHashJoin" in plan
        head = plan.split("BroadcastExchange")[0]
        assert "Exchange" not in head and "Sort" not in plan and "Window" not in plan


def test_contexts_and_pairs_never_read_the_text_again(spark):
    for name in ("entity_first", "entity_pairs", "relations"):
        plan = _static(spark, lambda: R.QUERIES[name](spark, SF))  # noqa: B023
        assert "documents.parquet" not in plan, name


def test_no_dataset_stays_persisted(spark):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    for name in ("entity_match", "relations", "relation_counts"):
        R.QUERIES[name](spark, SF).count()
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_result_independent_of_partition_count(spark):
    out = []
    for n in (3, 11):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        out.append(sorted(tuple(r) for r in R.QUERIES["relations"](spark, SF).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1]


def test_relation_plan_uses_bucketed_equi_join(spark):
    import re
    plan = _static(spark, lambda: R.QUERIES["relations"](spark, SF))
    assert re.search(r"hashpartitioning\(doc_id#\d+L?, bucket#\d+L?", plan) or re.search(r"BroadcastHashJoin \[doc_id#\d+L?, bucket#", plan), \
        "pair join is not keyed by (doc_id, bucket)"
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
