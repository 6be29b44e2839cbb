"""The pipeline's stages, each on its own input, against brute force."""

import corpus_pipeline as P
from awkward import brute_components, brute_repeats, documents, empty, sentence, words
from pagewright.llm import mixing, nbsvm
from pagewright.llm.common import written

SF = "/root/testdata/sf0.001"


def test_stages_on_a_small_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = nbsvm.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in nbsvm.score(docs, model).where("score >= 0.3").collect()}
    a = written(P.STAGES[0][1](spark, docs, SF))
    assert {r.doc_id for r in a.collect()} == good and a.schema == docs.schema

    b = written(P.STAGES[1][1](spark, a, SF))
    assert b.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in a.collect()]
    left = {}
    for i, gone in brute_repeats(rows).items():
        kept = [w for w, g in zip(words(dict(rows)[i]), gone) if not g]
        if kept or not gone:
            left[i] = kept
    assert {r.doc_id: words(r.text) for r in b.collect()} == left
    assert all(r.n_chars == len(r.text) for r in b.collect() if len(left[r.doc_id]) < len(words(dict(rows)[r.doc_id])))

    c = written(P.STAGES[2][1](spark, b, SF))
    found = brute_components([(r.doc_id, r.text) for r in b.collect()])
    assert sorted(r.doc_id for r in c.collect()) == sorted(i for (i, _), top in found.items() if top == i)

    d = written(P.STAGES[3][1](spark, c, SF))
    copies = {r.doc_id: r.copies for r in mixing.mix_documents(c).collect() if r.copies}
    assert {r.doc_id: r["count"] for r in d.groupBy("doc_id").count().collect()} == copies

    e = P.STAGES[4][1](spark, d, SF).toPandas()
    assert set(e["doc_id"]) == set(copies)
    for i, n in copies.items():
        mine = e[e["doc_id"] == i]
        assert mine["length"].sum() == n * mine["doc_tokens"].iloc[0]


def test_stages_on_awkward_and_empty_tables(spark):
    for docs in (documents(spark), empty(spark)):
        n = docs.count()
        for name, stage in P.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            out = written(out)
            if not n:
                assert out.count() == 0
        kept = [r.doc_id for r in P.near_duplicates(spark, docs, SF).collect()]
        # the awkward table repeats an id only with an equal text
        assert len([i for i in kept if i is not None]) == len({i for i in kept if i is not None})


def test_registered(spark):
    import __spark_entry__ as E
    names = E.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14))


def test_near_duplicates_keep_unlike_texts_of_one_doc_id(spark):
    near = sentence(200, 5)
    rows = [(1, sentence(100, 1)), (1, sentence(100, 2)), (1, sentence(100, 1)), (2, sentence(100, 3)), (3, near), (3, near + " and a tail"), (4, near), (None, near), (5, None)]
    docs = documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
    got = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, docs, "").collect()), key=str)
    first = [t for i, t in got if i == 3]
    assert len(first) == 1 and first[0] in (near, near + " and a tail")
    assert sorted((x for x in got if x[0] != 3), key=str) == sorted([(1, sentence(100, 1)), (1, sentence(100, 2)), (2, sentence(100, 3)), (None, near), (5, None)], key=str)
