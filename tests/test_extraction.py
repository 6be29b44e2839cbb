"""Entity matching, overlap resolution, aliases and relations."""

import random

from pyspark.sql import functions as F

from pagewright.config import PipelineConfig
from pagewright.operators import relations as RL
from pagewright.operators import spans as SP
from pagewright.operators.aliases import extract_aliases, extract_aliases_corrected
from pagewright.plans import pipeline as PL
from pagewright.sources import vocab as V

README_TEXT = (
    "It is necessary to separate syndrome (clinically identified impairment) from biology (etiology). "
    "Alzheimer's disease (AD) is defined by its biology with the following implications. "
    "AD is defined by its unique neuropathologic findings; therefore, detection of AD neuropathologic "
    "change by biomarkers is equivalent to diagnosing the disease. Tau and p-tau are important "
    "biomarkers found in the hippocampus and temporal lobe regions.")


def test_readme_example(spark):
    docs = spark.createDataFrame([(1, README_TEXT)], "doc_id long, text string")
    ex = PL.extract_knowledge(docs, V.default_gazetteer(spark), PipelineConfig())
    ents = {(r.label, r.text) for r in ex.entities.collect()}
    for want in [("DISEASE", "Alzheimer's disease"), ("SYNDROME", "syndrome"), ("BIOMARKER", "biomarkers"),
                 ("PROTEIN", "Tau"), ("PROTEIN", "p-tau"), ("BRAIN_REGION", "hippocampus"),
                 ("BRAIN_REGION", "temporal lobe"), ("NEUROPATHOLOGIC", "neuropathologic findings")]:
        assert want in ents, want
    for r in ex.mentions.collect():          # offsets point at the text
        assert README_TEXT[r.start:r.end] == r.text
    aliases = {r.term: r.alias for r in ex.aliases.collect()}
    assert aliases["Alzheimer's disease"] == "AD"
    rels = {(r.entity1, r.relation, r.entity2) for r in ex.relations.collect()}
    # the first "biomarkers" (kept by the per-label dedupe) precedes Tau, so the pair is ordered that way
    assert ("biomarkers", "IS_A", "Tau") in rels or ("Tau", "IS_A", "biomarkers") in rels
    assert ("Alzheimer's disease", "HAS_BIOMARKER", "biomarkers") in rels
    assert ("Tau", "FOUND_IN", "hippocampus") in rels and ("p-tau", "FOUND_IN", "temporal lobe") in rels


def test_alias_term_is_whole_run(spark):
    docs = spark.createDataFrame([(1, "We studied Alzheimer's disease (AD).")], "doc_id long, text string")
    r = extract_aliases(docs).collect()
    assert [(x.term, x.alias) for x in r] == [("We studied Alzheimer's disease", "AD")]


def greedy(spans):
    kept = []
    for s in sorted(spans, key=lambda s: (-(s[1] - s[0]), s[0], s[2], s[3])):
        if all(not (a[0] < s[1] and s[0] < a[1]) for a in kept):
            kept.append(s)
    return sorted(kept)


def test_resolve_overlaps_matches_greedy(spark):
    rnd = random.Random(7)
    rows, expect = [], []
    for doc in range(20):
        spans = set()
        for _ in range(80):
            st = rnd.randrange(0, 300)
            spans.add((st, st + rnd.randint(1, 4), rnd.randint(0, 3), rnd.choice("ABC")))
        spans = list(spans)
        rows += [(doc, s, e, e - s, s * 10, e * 10, lab, "src", p) for s, e, p, lab in spans]
        expect += [(doc, s, e, p, lab) for s, e, p, lab in greedy(spans)]
    df = spark.createDataFrame(rows, "doc_id long, tok_start long, tok_end long, n_tokens long, start long, "
                                     "end long, label string, source string, priority int")
    got = sorted((r.doc_id, r.tok_start, r.tok_end, r.priority, r.label)
                 for r in SP.resolve_overlaps(df).collect())
    assert got == sorted(expect)


def test_bucketed_pairs_equal_naive(spark):
    rnd = random.Random(3)
    ents = []
    for doc in range(5):
        pos = 0
        for i in range(150):
            pos += rnd.randint(0, 120)
            ln = rnd.randint(1, 15)
            ents.append((doc, rnd.choice(["A", "B"]), f"t{i}", pos, pos + ln))
            pos += ln
    df = spark.createDataFrame(ents, "doc_id long, label string, text string, start long, end long")
    got = sorted((r.doc_id, r.e1_start, r.e1_label, r.e2_start, r.e2_label)
                 for r in RL.entity_pairs(df, 200, 64).collect())
    naive = sorted((a[0], a[3], a[1], b[3], b[1]) for a in ents for b in ents
                   if a[0] == b[0] and (a[3], a[1], a[4]) < (b[3], b[1], b[4]) and b[3] - a[4] <= 200)
    assert got == naive


def test_gap_and_confidence_bounds(spark):
    ents = spark.createDataFrame([(1, "A", "x", 0, 5), (1, "A", "y", 205, 210), (1, "A", "z", 412, 415)],
                                 "doc_id long, label string, text string, start long, end long")
    pairs = {(r.e1_text, r.e2_text) for r in RL.entity_pairs(ents, 200).collect()}
    assert ("x", "y") in pairs and ("y", "z") not in pairs       # gap 200 kept, 202 dropped
    s = spark.createDataFrame([(1, "x", "PROTEIN", "y", "BIOMARKER", " are ", "c")],
                              "doc_id long, e1_text string, e1_label string, e2_text string, e2_label string, "
                              "between string, context string")
    assert RL.score_relations(s, 0.7).count() == 1
    assert RL.score_relations(s, 0.85).count() == 0             # strictly greater


def test_acronym_typing(spark):
    t = V.seed_tables(spark)["acronyms"].select("acronym", V.acronym_type(F.col("full_form")).alias("t"))
    types = {r.acronym: r.t for r in t.collect()}
    assert types["AD"] == types["PD"] == types["HD"] == "DISEASE"
    assert types["APOE"] == "PROTEIN" and types["BBB"] == "BRAIN_REGION"
    assert sum(1 for v in types.values() if v == "ACRONYM") == 15


def test_alias_trimming(spark):
    docs = spark.createDataFrame([(1, "We studied Alzheimer's disease (AD). Levels of Cerebrospinal Fluid (CSF).")],
                                 "doc_id long, text string")
    r = {x.alias: x.term for x in extract_aliases_corrected(docs).collect()}
    assert r == {"AD": "Alzheimer's disease", "CSF": "Levels of Cerebrospinal Fluid"}


def test_drop_overlapping_matches_brute_force(spark):
    rnd = random.Random(11)
    cands, blocks = [], []
    for doc in range(4):
        for i in range(120):
            s = rnd.randrange(0, 2000)
            cands.append((doc, i, i + 1, "L", s, s + rnd.randint(1, 40)))
        for _ in range(30):
            s = rnd.randrange(0, 2000)
            blocks.append((doc, s, s + rnd.randint(1, 60)))
    cdf = spark.createDataFrame(cands, "doc_id long, tok_start long, tok_end long, label string, start long, end long")
    bdf = spark.createDataFrame(blocks, "doc_id long, start long, end long")
    got = sorted((r.doc_id, r.tok_start) for r in SP.drop_overlapping(cdf, bdf, 64).collect())
    want = sorted((c[0], c[1]) for c in cands
                  if not any(b[0] == c[0] and c[4] < b[2] and b[1] < c[5] for b in blocks))
    assert got == want


def test_chunked_tokenization_equals_whole(spark):
    from dataclasses import replace

    from pagewright.config import ExtractConfig
    from pagewright.plans import fixtures as FX
    from pagewright.plans import registry as R
    sf = "/root/testdata/sf0.001"
    docs = FX.fx_articles(spark, sf)
    gz = R._gazetteer(spark, sf)
    whole = PL.entity_mentions(docs, gz, PipelineConfig())
    cfg = replace(PipelineConfig(), extract=ExtractConfig(chunk_chars=80))
    chunked = PL.entity_mentions(docs, gz, cfg)
    a = sorted(tuple(r) for r in whole.collect())
    b = sorted(tuple(r) for r in chunked.collect())
    assert len(a) > 1000 and a == b


def test_author_lists_of_any_length(spark):
    from pagewright.functions import metadata as M
    plain = ", ".join("Ann Lee" for _ in range(3000))
    rows = [(1, f"Title\n{plain}\nbody"), (2, f"Title\n{plain} and Tom Brown\nbody"),
            (3, "X\nAnn Lee, and Tom and Jerry Smith\n"), (4, "X\nAnn Lee, and Tom, Bob Ray\n")]
    got = {r.i: r.a for r in spark.createDataFrame(rows, "i long, t string").select("i", M.authors(F.col("t")).alias("a")).collect()}
    assert got == {1: plain, 2: plain + " and Tom Brown", 3: "Ann Lee, and Tom and Jerry Smith", 4: "Ann Lee, and Tom, Bob Ray"}


def test_token_of_very_many_parts(spark):
    from pagewright.operators.tokens import tokenize
    long = "-".join("ab" for _ in range(100_000))
    got = tokenize(spark.createDataFrame([(1, f"x {long} y")], "doc_id long, text string")).orderBy("pos").collect()
    assert [(r.start, r.end) for r in got] == [(0, 1), (2, 2 + len(long)), (3 + len(long), 4 + len(long))]


def test_chunks_of_any_size_lose_no_phrase(spark):
    from pagewright.config import ExtractConfig, PipelineConfig
    from pagewright.plans.pipeline import entity_mentions
    from pagewright.sources.vocab import default_gazetteer
    extra = spark.createDataFrame([("SYMPTOM", "REM sleep behavior disorder")], "label string, name string")
    gz = default_gazetteer(spark, extra)
    docs = spark.createDataFrame([(1, "He has  REM sleep   behavior disorder and antidisestablishmentarianism."),
                                  (2, "  REM sleep behavior disorder")], "doc_id long, text string")
    want = {(r.doc_id, r.start, r.end) for r in entity_mentions(docs, gz).collect()}
    assert {w[0] for w in want} == {1, 2}
    for n in (1, 4, 8, 12, 20, 1000):
        cfg = PipelineConfig(extract=ExtractConfig(chunk_chars=n))
        assert {(r.doc_id, r.start, r.end) for r in entity_mentions(docs, gz, cfg).collect()} == want, n


def _long_chain(n, seed):
    rnd = random.Random(seed)
    return [(7, k, k + m, m, k * 3, (k + m) * 3, rnd.choice("AB"), "src", rnd.randint(0, 2)) for k in range(n) for m in ({2, rnd.randint(1, 5)})]


def test_a_chain_of_overlaps_through_a_whole_article(spark):
    rows = _long_chain(60_000, 5) + [(8, s, e, n, a, b, lab, src, p) for _, s, e, n, a, b, lab, src, p in _long_chain(3, 6)]
    taken, want = {7: set(), 8: set()}, []
    for d, s, e, n, a, b, lab, _, p in sorted(rows, key=lambda r: (-r[3], r[1], r[8], r[6])):
        if not any(x in taken[d] for x in range(s, e)):
            taken[d].update(range(s, e))
            want.append((d, s, e, p, lab))
    df = spark.createDataFrame(rows, "doc_id long, tok_start long, tok_end long, n_tokens long, start long, "
                                     "end long, label string, source string, priority int")
    got = sorted((r.doc_id, r.tok_start, r.tok_end, r.priority, r.label) for r in SP.resolve_overlaps(df).collect())
    assert len(rows) > 100_000 and got == sorted(want)


def test_offsets_of_arrays_equal_tokens(spark):
    from pagewright.operators import tokens as TK
    texts = ["", None, "  lead", "a", "x\n\n y  ", "one-two's 3,4 \U0001f600 é" * 40, " ".join(f"w{i}" for i in range(30_000))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    t = TK.token_arrays(docs, "doc_id").select("doc_id", F.posexplode(F.transform("toks", lambda x, i: F.struct(x.alias("t"), TK.offset_of(i).alias("s")))))
    got = sorted((r.doc_id, r.pos, r.col.t, r.col.s) for r in t.collect())
    rows = sorted((r.doc_id, r.start, r.token) for r in TK.tokenize(docs).collect())
    assert [(d, t_, s) for d, _, t_, s in got] == [(d, t_, s) for d, s, t_ in rows] and len(got) > 30_000
    assert all(texts[d][s:s + len(t_)] == t_ for d, _, t_, s in got)


def test_windows_and_contexts_equal_slices(spark):
    from pagewright.operators.gazetteer import Gazetteer, match_gazetteer
    rnd = random.Random(2)
    texts = {k: "".join(rnd.choice(["tau ", "x", "é\U0001f600 ", "temporal  lobe. ", "y" * 90 + " "]) for _ in range(n)) for k, n in enumerate((0, 1, 5, 90, 2000))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    m = match_gazetteer(docs, Gazetteer(V.default_gazetteer(spark)), 50, 200)
    rows = SP.attach_context(m, None, 50).collect()
    assert len(rows) > 300
    for r in rows:
        t = texts[r.doc_id]
        assert t[r.start:r.end] == r.text and r.win == t[max(0, r.start - 50):r.end + 200] and r.win_start == max(0, r.start - 50)
        assert r.context == t[max(0, r.start - 50):r.end + 50]


def test_vocabularies_beyond_the_bounds_match_alike(spark):
    docs = spark.createDataFrame([(1, README_TEXT), (2, " Tau, tau and p-tau")], "doc_id long, text string")
    gz = V.default_gazetteer(spark)
    from dataclasses import replace

    from pagewright.config import ExtractConfig
    cfg = replace(PipelineConfig(), extract=ExtractConfig(broadcast_max_bytes=0, inline_firsts=1))
    a, b = (sorted(map(tuple, PL.entity_mentions(docs, gz, c).collect())) for c in (PipelineConfig(), cfg))
    assert a == b and len(a) > 10


def test_model_words_of_several_tokens(spark):
    import pandas as pd

    from pagewright.operators import hooks as HK
    text = "The APPs and  prion   protein, APP; a prion protein."
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    words = ["prion protein", "APP", "prion", "protein, APP", "proteins", "", "  ", "app"]
    scorer = lambda pdf: pd.DataFrame([(d, None, w) for d in pdf["doc_id"] for w in words], columns=["doc_id", "label", "word"])
    got = {(r.text, r.start, r.end, r.label) for r in HK.locate_words(docs, scorer).collect()}
    assert got == {("prion   protein", 14, 29, "Unknown"), ("APP", 31, 34, "Unknown"), ("prion", 14, 19, "Unknown"), ("protein, APP", 22, 34, "Unknown")}


def test_names_are_masked_as_plain_substrings(spark):
    from pagewright.operators import hooks as HK
    rows = [(1, "LI WEI met Li Weiss, Li and Ann Lee Brown ($1.x)", ["Li Wei", "Li", "Ann Lee", "Lee Brown", "$1.x", "", None]), (2, "as is", []),
            (3, None, ["a"]), (4, "abab", ["b", "ab"])]
    df = spark.createDataFrame(rows, "i long, t string, n array<string>")
    got = {r.i: (r.a, r.b) for r in df.select("i", HK.mask_all(F.col("t"), F.col("n")).alias("a"), HK.mask_all(F.col("t"), F.col("n"), word_aligned=True).alias("b")).collect()}
    assert got[1] == ("LI WEI met [NAME]ss, [NAME] and [NAME] Brown ([NAME])", "LI WEI met [NAME] Weiss, [NAME] and [NAME] Brown ([NAME])")
    assert got[2] == ("as is", "as is") and got[3] == (None, None) and got[4] == ("[NAME][NAME]", "abab")


def test_scorers_and_names_in_the_page_pipeline(spark):
    import pandas as pd

    from pagewright.config import CleanConfig
    pages = spark.createDataFrame([(1, 0, "Jane Smith saw tau in the temporal lobe.\nMany biomarkers of prion protein.")], "doc_id long, page_num long, page_text string")
    span = lambda pdf: pd.DataFrame([(d, "SPAN", t.index("temporal"), t.index("lobe") + 2) for d, t in zip(pdf["doc_id"], pdf["text"])],
                                    columns=["doc_id", "label", "start", "end"])
    word = lambda pdf: pd.DataFrame([(d, "PROTEIN", w) for d in pdf["doc_id"] for w in ("Tau", "tau", "prion protein", "saw tau")], columns=["doc_id", "label", "word"])
    name = lambda pdf: pd.DataFrame([(d, "PERSON", "Jane Smith") for d in pdf["doc_id"]], columns=["doc_id", "label", "word"])
    articles, ex, counts = PL.process_pages(pages, V.default_gazetteer(spark), PipelineConfig(clean=CleanConfig(remove_names=True)), span, word, name)
    assert articles.first().processed_text.startswith("[NAME] saw tau")
    ents = {(r.label, r.text, r.source) for r in ex.entities.collect()}
    assert ("SPAN", "temporal lo", "model") in ents and not any(t == "temporal lobe" for _, t, _ in ents)
    assert ("PROTEIN", "saw tau", "model") in ents and ("PROTEIN", "tau", "model") not in ents and ("PROTEIN", "tau", "builtin") in ents
    assert counts.first().n_entities == len(ents)


def test_cuts_find_the_tokens_that_begin_phrases(spark):
    import re

    from pagewright.operators.gazetteer import _any_of, cut_pattern
    from pagewright.operators.tokens import tokenize
    words = ["tau", "taupe", "ta", "p-tau", "x.y"]
    assert [w for w in ["t", "ta", "tau", "taup", "taupe", "p-tau", "xzy"] if re.fullmatch(_any_of(words), w)] == ["ta", "tau", "taupe", "p-tau"]
    firsts = ["tau", "p-tau", "αβ", "aβ", "(", "'s", "k", "a" * 60]
    rnd = random.Random(4)
    bits = ["Tau", "tau-x", "x-tau", "P-TAU", "p", "-", " ", "\n ", "ΑΒ", "Aβ", "(", "'s", "'stau", "dog", "K", "a" * 60, "A" * 61, "\U0001f600", "9"]
    rows = [(n, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40)))) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(r.doc_id, r.start) for r in tokenize(docs).collect() if r.token.lower() in firsts}
    cuts = docs.select("doc_id", F.regexp_extract_all("text", F.lit(cut_pattern(firsts)), 0).alias("p"), "text").collect()
    ends = set()
    for r in cuts:
        assert "".join(r.p) == r.text
        ends |= {(r.doc_id, sum(map(len, r.p[:n]))) for n in range(len(r.p))}
    assert want <= ends and len(want) > 500
    # a text without first tokens is one piece, so nothing is built for the tokens between
    assert docs.limit(1).select(F.size(F.regexp_extract_all(F.lit("one two three four"), F.lit(cut_pattern(firsts)), 0))).first()[0] == 1


def test_cuts_pass_over_words_that_only_begin_alike(spark):
    from pagewright.operators.gazetteer import cut_pattern
    firsts = ["α-synuclein", "aβ", "kin", "i\u0307n"]
    text = "an été à Α-Synuclein α-syn aβ and élan aβc İn \u212aIN ki"
    got = spark.range(1).select(F.regexp_extract_all(F.lit(text), F.lit(cut_pattern(firsts)), 0)).first()[0]
    assert got == ["an été à ", "Α-Synuclein α-syn ", "aβ and élan aβc ", "İn ", "\u212aIN ki"]


def test_a_relation_is_scored_by_one_test_of_each_text():
    from pagewright.operators.relations import rule_score
    score = rule_score(F.col("a"), F.col("b"), F.col("t"))
    assert str(score).upper().count("RLIKE") == 4      # two for the relation, two for its confidence


def test_store_tables_share_pairs_and_aliases(spark):
    from pagewright.operators import store as ST
    docs = spark.createDataFrame([(1, "Tau is a biomarker (BM)."), (2, "Alzheimer's disease and the biomarker.")], "doc_id long, text string")
    tables = ST.article_tables(docs, PL.extract_knowledge(docs, V.default_gazetteer(spark)))
    for name in ("entity_relationships", "relationship_citations", "entity_aliases"):
        plan = tables[name]._jdf.queryExecution().optimizedPlan().toString()
        assert tables[name].count() and "Join" not in plan and "regexp_extract_all" not in plan, plan
    assert {r.relation for r in tables["entity_relationships"].collect()} == {"IS_A", "HAS_BIOMARKER"}


def test_a_scorer_sees_few_articles_at_once(spark):
    import pandas as pd

    from pagewright.operators import hooks as HK
    docs = spark.range(1500).select(F.col("id").alias("doc_id"), F.concat(F.lit("tau "), F.col("id")).alias("text")).coalesce(1)

    def scorer(pdf):
        assert len(pdf) <= HK.SCORED_ROWS
        return pd.DataFrame([(d, "A", t) for d, t in zip(pdf["doc_id"], pdf["text"]) if d % 3][::-1], columns=["doc_id", "label", "word"])
    assert {(r.doc_id, r.word) for r in HK.run_scorer(docs, scorer).collect()} == {(d, f"tau {d}") for d in range(1500) if d % 3}
    found = HK.locate_words(docs, scorer).collect()
    assert {(r.doc_id, r.text, r.start) for r in found} == {(d, f"tau {d}", 0) for d in range(1500) if d % 3}


def test_spans_are_masked_in_their_own_row(spark):
    from pagewright.operators import hooks as HK
    docs = spark.createDataFrame([(1, "ab cd ef"), (2, "as is"), (3, None), (4, "x" * 3000 + "\U0001f600NAME" + "y" * 2000)], "doc_id long, text string")
    spans = spark.createDataFrame([(1, 3, 5), (1, 0, 2), (4, 3001, 3005)], "doc_id long, start long, end long")
    got = {r.doc_id: r.text for r in HK.mask_spans(docs, spans).collect()}
    assert got == {1: "[NAME] [NAME] ef", 2: "as is", 3: None, 4: "x" * 3000 + "\U0001f600[NAME]" + "y" * 2000}


def test_name_mask_looks_for_the_names_of_all_customers(spark, tmp_path):
    from pagewright.plans import registry as R
    rows = [(1, "we met customer#000000007, twice: Customer#000000007."), (2, "Customer#000000008 and Li Wei"), (2, "nobody")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("Customer#000000007",), ("Customer#000000008",)], "c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    got = [r.text for r in R.QUERIES["name_mask"](spark, str(tmp_path)).collect()]
    assert sum("we met [NAME], twice: [NAME]." in t for t in got) == 1 and sum("[NAME] and [NAME]" in t for t in got) == 1
    assert sum("nobody" in t for t in got) == 1 and not any("#0000" in t for t in got)


def _written(spark):
    import os

    from pagewright.session import ensure_checkpoint_dir
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(ensure_checkpoint_dir(spark)) for f in fs)


def test_blocked_matches_are_written_without_the_text_around_them(spark):
    import pandas as pd
    rnd = random.Random(3)
    noise = lambda n: "".join(rnd.choice("bcdfgklmnprstvwz ") for _ in range(n))
    texts = {k: " tau ".join(noise(20) for _ in range(300)) + f" in the temporal lobe of Dr {k} \U0001f600 MRI" for k in range(60)}
    rows = [*texts.items(), (7, texts[7]), (None, texts[8]), (90, None), (91, "")]      # the same row twice, no id, no text
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    span = lambda pdf: pd.DataFrame([(d, "MODEL", t.index("lobe"), t.index("lobe") + 7) for d, t in zip(pdf["doc_id"], pdf["text"]) if t],
                                    columns=["doc_id", "label", "start", "end"])
    word = lambda pdf: pd.DataFrame([(d, "TITLE", "of Dr") for d in pdf["doc_id"]], columns=["doc_id", "label", "word"])
    gz = PL.gazetteer_of(V.default_gazetteer(spark))
    before = _written(spark)
    ex = PL.extract_knowledge(docs, gz, span_scorer=span, word_scorer=word)
    got = ex.entities.collect()
    assert _written(spark) - before < sum(map(len, texts.values()))
    assert len(got) == len({(r.doc_id, r.label, r.text.lower()) for r in got}) and {r.doc_id for r in got} == {*texts, None}
    for r in got:
        t = texts[8 if r.doc_id is None else r.doc_id]
        assert t[r.start:r.end] == r.text and r.context == t[max(0, r.start - 50):r.end + 50]
    mine = {(r.label, r.text) for r in got if r.doc_id == 7}
    assert {("MODEL", "lobe of"), ("TITLE", "of Dr")} <= mine and not any(x == "temporal lobe" for _, x in mine)
    assert ex.mentions.where("doc_id = 7 AND text = 'tau'").count() == 299
    rel = ex.relations.where("doc_id = 7").collect()
    assert all(r.context in texts[7] for r in rel)


def test_candidates_are_exchanged_once_to_drop_overlaps_and_find_islands(spark):
    rnd = random.Random(4)
    span = lambda: (s := rnd.randrange(0, 900), s + rnd.randint(-3, 12))  # noqa: E731, empty and reversed ones too
    cands = [(rnd.choice([0, 1, None]), i, *span()) for i in range(300)] + [(0, 300, None, 5), (0, 301, 5, None)]
    blocks = [(rnd.choice([0, 1, 2, None]), *span()) for _ in range(60)] + [(0, None, 800), (0, 3, None)]
    c = spark.createDataFrame([(*x, 1, "L", 0) for x in cands], "doc_id int, i int, start long, end long, n_tokens int, label string, priority int")
    b = spark.createDataFrame(blocks, "doc_id long, start long, end long")
    got = SP.drop_overlapping(c, b)
    want = [x[1] for x in cands if None in (x[0], *x[2:]) or not any(None not in y and y[0] == x[0] and x[2] < y[2] and y[1] < x[3] for y in blocks)]
    assert dict(got.dtypes) == dict(c.dtypes) and sorted(r.i for r in got.collect()) == sorted(want) and 0 < len(want) < 300
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = SP.islands(got)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
