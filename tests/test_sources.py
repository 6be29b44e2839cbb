"""JSON sources (S4-S8), labelled tokens (S12), store writes (K7) and streaming."""

import json
import os

from pyspark.sql import functions as F

from pagewright.operators import hierarchy as H
from pagewright.operators import store as ST
from pagewright.operators import upsert as U
from pagewright.sources import json_sources as JS


def test_structures_json(spark, tmp_path):
    data = [
        {"neuroNamesID": "1", "standardName": "root", "parents": [], "synonyms": [{"synonymName": "r", "pubMedHits": "12"}]},
        {"neuroNamesID": "2", "standardName": "kid", "parents": [{"parentNeuroNamesId": "1", "modelName": "m"},
                                                                 {"parentNeuroNamesId": "99", "parentStandardName": "lost"}],
         "synonyms": [{"synonymName": "k", "pubMedHits": "x"}]},
        {"neuroNamesID": "3", "standardName": "other", "parents": [{"parentNeuroNamesId": "99"}]},
    ]
    path = tmp_path / "structures.json"
    path.write_text(json.dumps(data))
    raw = JS.read_json_array(spark, str(path), JS.STRUCTURE_SCHEMA)
    st, par, syn = JS.structures_flat(raw)
    ids = U.dense_ids(st.select(F.col("neuronames_id").alias("key")), "key")
    edges, missing = H.resolve_parents(par, ids)
    assert edges.count() == 1
    summary = {r.parent_key: (r["count"], r.name) for r in H.missing_parent_summary(missing).collect()}
    assert summary == {"99": (2, "lost")}
    hits = sorted(r.pubmed_hit_count for r in H.resolve_synonyms(syn, ids).collect())
    assert hits == [0, 12]


def test_concept_details(spark, tmp_path):
    details = [{"id": "c1", "conceptclasses": [{"id": "k", "name": "n1"}],
                "relationships": [{"id": "c2", "relationship": "kind of", "direction": "parent"}],
                "contrasts": [{"task_id": "c2", "relationship": "measures"}]},
               {"id": "c9", "relationships": [{"id": "c1"}]}]
    path = tmp_path / "details.json"
    path.write_text("\n".join(json.dumps(d) for d in details))
    raw = JS.read_json_array(spark, str(path), JS.CONCEPT_DETAIL_SCHEMA, multi_line=False)
    assert raw.count() == 2
    concepts = spark.createDataFrame([("c1",)], "concept_id string")          # c9 is not stored
    classes, rels, cons = JS.concept_details_flat(raw, concepts)
    out = U.upsert_concept_relationships(rels, cons).collect()
    assert [(r.concept_id, r.related_concept_id, r.direction) for r in out] == [("c1", "c2", "MEASUREDBY")]
    assert U.upsert_concept_classes(classes).count() == 1


def test_labelled_tokens(spark, tmp_path):
    lines = ["[",
             '{"tokens": ["The", "Alzheimer", "\'s"], "ner_tags": [0, 1, 2]}',
             '{"tokens": ["memory"], "ner_tags": [3]}',
             "]"]
    path = tmp_path / "labels.json"
    path.write_text("\n".join(lines))
    rows = JS.read_labelled_tokens(spark, str(path)).collect()
    assert sorted((r.token, r.ner_tag) for r in rows) == [("'s", 2), ("Alzheimer", 1), ("The", 0), ("memory", 3)]


def _store_tables(spark, rows, aliases=()):
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    cites = spark.createDataFrame([(i, w) for i, t in rows for w in (t or "").split()], "doc_id long, word string")
    return {"articles": docs, "entity_citations": cites, "entity_aliases": spark.createDataFrame(list(aliases), "doc_id long, alias string")}


def test_store_loads_again_and_replaces_articles(spark, tmp_path):
    base = str(tmp_path / "store")
    state = lambda t: sorted(map(tuple, ST.read_store(spark, base, t).collect()), key=str)
    first = _store_tables(spark, [(k, f"a b{k}") for k in range(40)] + [(None, "lost")])
    assert ST.write_store(first, base, buckets=8) == 1
    once = {t: state(t) for t in first}
    assert len(once["articles"]) == 40 and once["entity_aliases"] == []
    assert ST.write_store(first, base) == 2 and {t: state(t) for t in first} == once
    # a changed subset: one article loses its rows, one is new
    change = _store_tables(spark, [(3, "c"), (4, ""), (99, "d e")], [(3, "X")])
    ST.write_store(change, base)
    assert [r for r in state("entity_citations") if r[0] in (3, 4, 99)] == [(3, "c"), (99, "d"), (99, "e")]
    assert len(state("articles")) == 41 and state("entity_aliases") == [(3, "X")]
    # a load that broke off before its manifest is not seen
    before = state("articles")
    change["articles"].withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{base}/articles/load=77")
    assert state("articles") == before


def test_co_mentions_over_blocks_equal_brute_force(spark):
    import random
    from collections import Counter
    from itertools import combinations
    rnd = random.Random(9)
    cites = {(d, rnd.choice("AB"), f"t{rnd.randrange(30)}") for d in range(30) for _ in range(rnd.randrange(25))} | {(d, "A", "hot") for d in range(30)}
    df = spark.createDataFrame(sorted(cites), "doc_id long, label string, norm_text string")
    pairs, n = Counter(), Counter((lab, t) for _, lab, t in cites)
    for d in range(30):
        pairs.update(combinations(sorted((lab, t) for i, lab, t in cites if i == d), 2))
    want = sorted((*a, *b, k, n[a], n[b]) for (a, b), k in pairs.items())
    for block in (3, 256):
        assert sorted(map(tuple, ST.co_mentions(df, block).collect())) == want


def test_broken_lines_go_to_quarantine(spark, tmp_path):
    from pagewright.plans import vocab_load as VL
    good = '{"id": "a", "name": "n", "creation_time": 5}'
    lines = ["[", good + ",", '{"id": "b", "name": "m"', '["id", "c"]', "plain text", "", '{"id": null, "name": "x"}', '{"id": "d"}',
             '{"id": "e", "name": null}', '"text"', '{"id": "f", "name": "q"} {"id": "g"}', "]"]
    (tmp_path / "c.json").write_text("\n".join(lines))
    table, bad = VL.load_concepts(spark, str(tmp_path / "c.json"))
    assert {(r.concept_id, r.name) for r in table.collect()} == {("a", "n"), ("d", "No Name found")}
    rows = bad.orderBy("ordinal").collect()
    assert [(r.record, r.reason) for r in rows if r.reason == "broken"] == [
        ('{"id": "b", "name": "m"', "broken"), ('["id", "c"]', "broken"), ("plain text", "broken"), ('"text"', "broken"), (lines[10], "broken")]
    assert [r.record for r in rows if r.reason == "incomplete"] == [lines[6], lines[8]]


def test_streaming_pages(spark, tmp_path):
    from pagewright.sources.pages import pages_by_page
    from pagewright.streaming.pages_stream import cleaned_page_stream
    src = tmp_path / "in"
    pages = spark.createDataFrame([(1, 0, "Tau was found in the hippo-\ncampus."), (1, 1, "More text (AD) here.")],
                                  "doc_id long, page_num long, page_text string")
    pages.write.parquet(str(src))
    q = (cleaned_page_stream(spark, str(src)).writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, pages_by_page(pages).select(*got.columns).collect()))


def test_list_pdf_files(spark, tmp_path):
    from pagewright.sources.pages import list_pdf_files
    (tmp_path / "a.PDF").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "b.pdf").write_bytes(b"%PDF-1.4 yy")
    (tmp_path / "c.txt").write_bytes(b"nope")
    names = sorted(r.path.rsplit("/", 1)[1] for r in list_pdf_files(spark, str(tmp_path)).collect())
    assert names == ["a.PDF", "b.pdf"]


def test_model_relation_hook(spark):
    import pandas as pd
    from pagewright.operators.relations import score_relations_with_model
    p = spark.createDataFrame([(1, "tau", "PROTEIN", 0, 3, "x", "BIOMARKER", 10, 11, " is ", "tau [SEP]  is  [SEP] x", "c")],
                              "doc_id long, e1_text string, e1_label string, e1_start long, e1_end long, "
                              "e2_text string, e2_label string, e2_start long, e2_end long, between string, "
                              "sample string, context string")
    def scorer(samples):
        return pd.DataFrame({"relation": ["IS_A"] * len(samples), "confidence": [0.95] * len(samples)})
    r = score_relations_with_model(p, scorer).collect()
    assert [(x.entity1, x.relation) for x in r] == [("tau", "IS_A")]


def test_vocab_load_plans(spark, tmp_path):
    from pagewright.plans.vocab_load import load_brain_structures, load_concepts
    from pagewright.sources.json_sources import ORDINAL_TYPE
    data = [{"neuroNamesID": "10", "standardName": "a", "parents": [{"parentNeuroNamesId": "11"}]},
            {"neuroNamesID": "11", "standardName": "b", "parents": [{"parentNeuroNamesId": "77", "parentStandardName": "gone"}],
             "synonyms": [{"synonymName": "bee", "pubMedHits": "3"}]},
            {"neuroNamesID": "10", "standardName": "a2"}]
    p = tmp_path / "s.json"
    p.write_text(json.dumps(data))
    first = load_brain_structures(spark, str(p))
    names = {r.neuronames_id: (r.id, r.standard_name) for r in first.structures.collect()}
    assert names == {"10": (1, "a2"), "11": (2, "b")}          # same key twice: last attributes win
    again = load_brain_structures(spark, str(p), existing=first.structures.withColumnRenamed("neuronames_id", "key")
                                  .withColumn("ordinal", F.lit(None).cast(ORDINAL_TYPE)))
    assert {r.neuronames_id: r.id for r in again.structures.collect()} == {"10": 1, "11": 2}   # ids unchanged
    assert [(r.parent_key, r["count"], r.name) for r in first.missing.collect()] == [("77", 1, "gone")]
    assert {r.metric: r.n for r in first.log.collect()}["parent_links"] == 1
    c = tmp_path / "c.json"
    c.write_text('{"id": "c1", "name": "x"}\n{"id": "c1", "name": "y"}\n{"id": "c2", "name": null}\n{"id": "c3"}\n')
    table, bad = load_concepts(spark, str(c))
    assert sorted((r.concept_id, r.name) for r in table.collect()) == [("c1", "x"), ("c3", "No Name found")]
    assert [r.concept_id for r in bad.collect()] == ["c2"]


def test_first_and_last_wins_follow_files_of_unequal_size(spark, tmp_path):
    """Spark packs large files before small ones; the order of the landed files must hold."""
    from pagewright.plans.vocab_load import load_brain_structures, load_concepts
    c, st = tmp_path / "c", tmp_path / "s"
    c.mkdir(), st.mkdir()
    for k in range(9):
        pad = "x" * (40_000 if k % 2 else 10)
        (c / f"part-{k:03d}.json").write_text("".join(
            json.dumps({"id": f"c{i}", "name": f"{k}", "definition_text": pad}) + "\n" for i in range(k, 20)))
        (st / f"part-{k:03d}.json").write_text("".join(
            json.dumps({"neuroNamesID": f"n{i}", "standardName": f"{k}", "cDefinition": pad}) + "\n" for i in range(20 - k)))
    table, _ = load_concepts(spark, str(c))
    assert {r.concept_id: r.name for r in table.collect()} == {f"c{i}": "0" for i in range(20)}
    got = load_brain_structures(spark, str(st), multi_line=False).structures.collect()
    assert {r.neuronames_id: r.standard_name for r in got} == {f"n{i}": str(min(8, 19 - i)) for i in range(20)}


def test_broken_records_and_null_keys_are_quarantined(spark, tmp_path):
    from pagewright.plans.vocab_load import load_brain_structures
    p = tmp_path / "s.json"
    p.write_text('{"neuroNamesID": "10", "standardName": "a"\n{"neuroNamesID": "11", "standardName": "b"}\n{"standardName": "no key"}\n')
    load = load_brain_structures(spark, str(p), multi_line=False)
    assert [(r.neuronames_id, r.id) for r in load.structures.collect()] == [("11", 1)]
    assert sorted(r.record[:21] for r in load.quarantine.collect()) == ['{"neuroNamesID": "10"', '{"standardName":"no k']
