"""Model hooks and the operators around them.

No pretrained model ships with the engine.  A caller supplies a *scorer*: a
function from a pandas DataFrame ``(doc_id, text)`` to a pandas DataFrame
``(doc_id, label, word)``.  It runs through ``mapInArrow`` (Arrow batches, of which it
sees ``SCORED_ROWS`` rows at a time, one model load per Python worker), never row by row.  Everything after the
scorer - locating words in the text, merging with gazetteer entities,
categorising - is plain DataFrame work.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagewright.operators.gazetteer import text_blocks, text_window
from pagewright.operators.partitioning import ROW
from pagewright.operators.tokens import SPARK_TOKEN_RE, offset_of, run_of, token_arrays

MODEL_ENTITY_SCHEMA = "doc_id long, label string, word string"
# Fixed value: the label of a model entity that has none.
UNKNOWN = "Unknown"


#: Articles that a scorer is given at once.  What it makes of them leaves before the next ones
#: are read, so a Python worker holds an Arrow batch and the results of this many articles.
SCORED_ROWS = 256


def run_scorer(docs: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Apply a caller-supplied batch scorer to every article."""
    def batches(it):
        for batch in it:
            for at in range(0, batch.num_rows, SCORED_ROWS):
                out = scorer(batch.slice(at, SCORED_ROWS).to_pandas())
                yield _record_batch(out, [("doc_id", "int64"), ("label", "string"), ("word", "string")])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(batches, MODEL_ENTITY_SCHEMA)


def _record_batch(rows: pd.DataFrame, fields: list[tuple[str, str]]):
    import pyarrow as pa
    kinds = {"int64": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.Array.from_pandas(rows[n], type=kinds[k]) for n, k in fields], names=[n for n, _ in fields])


TOY_WORD_RE = "[A-Z][A-Z0-9]{1,4}"


def toy_acronym_scorer(pdf: pd.DataFrame) -> pd.DataFrame:
    """A stand-in scorer for tests: every all-capitals token of 2-5 characters.

    Tokens come from the engine's own tokenizer pattern (``regex`` reads the
    same Unicode classes as Java), so the scorer's words always line up with
    token boundaries.
    """
    import regex

    from pagewright.functions.regex import to_python
    from pagewright.operators.tokens import TOKEN_RE
    tok = regex.compile(to_python(TOKEN_RE))
    word = regex.compile(TOY_WORD_RE)
    rows = [(d, "MODEL_ACRONYM", w) for d, t in zip(pdf["doc_id"], pdf["text"])
            for w in tok.findall(t or "") if word.fullmatch(w)]
    return pd.DataFrame(rows, columns=["doc_id", "label", "word"])


#: Stands between tokens where phrases are looked for; no token holds it alone.
_BETWEEN = "\x01"


def _scored(docs: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], fields: list[tuple[str, str]]) -> DataFrame:
    """``docs`` with ``found``, what a scorer says of the article: an array in its row, so that
    nothing is joined back to the text.  Rows given to it at once that share a doc_id share what is
    found.  Only the scorer sees texts as Python objects; they go on as the Arrow buffers they came in."""
    names = docs.columns

    def batches(it):
        import numpy as np
        import pyarrow as pa
        for whole in it:
            for at in range(0, whole.num_rows, SCORED_ROWS):
                batch = whole.slice(at, SCORED_ROWS)
                pdf = batch.select(["doc_id", "text"]).to_pandas()
                code, ids = pd.factorize(pdf["doc_id"])
                out = scorer(pdf)
                of = pd.Index(ids).get_indexer(out["doc_id"]) if len(out) else np.empty(0, dtype=int)
                out, of = out[of >= 0], of[of >= 0]
                out, of = out.iloc[order := np.argsort(of, kind="stable")], of[order]
                n = np.append(np.bincount(of, minlength=len(ids)), 0)      # the last: rows without a doc_id
                first, each = np.cumsum(n) - n, n[code]
                ends = np.cumsum(each)
                place = np.repeat(first[code] - (ends - each), each) + np.arange(ends[-1])
                values = _record_batch(out, fields).take(pa.array(place))
                found = pa.ListArray.from_arrays(pa.array(np.append(0, ends), type=pa.int32()), values.to_struct_array())
                yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*names, "found"])
    found = T.ArrayType(T.StructType([T.StructField(n, T.LongType() if k == "int64" else T.StringType()) for n, k in fields]))
    return docs.mapInArrow(batches, T.StructType([*docs.schema.fields, T.StructField("found", found)]))


def _windowed(rows: DataFrame, hits: Column, source: str, before: int, after: int) -> DataFrame:
    """Spans ``doc_id, label, text, start, end, source`` from ``hits`` of rows with ``blocks``, and
    with the text around them if asked for, or the name of the row that has it."""
    keep = ["doc_id", *_row(rows)]
    s = rows.select(*keep, F.explode(hits).alias("h")).select(*keep, "h.*")
    s = s.withColumn("source", F.lit(source))
    return s if before or after else s.drop("win_start", "win")


def _hit(label: Column, text: Column, start: Column, end: Column, before: int, after: int) -> Column:
    low = F.greatest(start - before, F.lit(0).cast("long"))
    return F.struct(label.alias("label"), text.alias("text"), start.alias("start"), end.alias("end"), low.alias("win_start"),
                    text_window("blocks", low, end + after).alias("win"))


def _row(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c == ROW]


def model_spans(docs: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], before: int = 0, after: int = 0) -> DataFrame:
    """Existing entities of a caller's scorer, ``(doc_id, label, start, end)`` in characters, with
    their text; spans that are empty or reach beyond the text are left out, and so are repeated ones."""
    rows = _scored(docs.select("doc_id", *_row(docs), "text"), scorer, [("label", "string"), ("start", "int64"), ("end", "int64")])
    rows = rows.select("doc_id", *_row(docs), "text", "found", text_blocks("text"))
    inside = F.filter(F.array_distinct("found"), lambda f: (f["start"] >= 0) & (f["start"] < f["end"]) & (f["end"] <= F.length("text")))
    hits = F.transform(inside, lambda f: _hit(F.coalesce(f["label"], F.lit(UNKNOWN)), text_window("blocks", f["start"], f["end"]),
                                              f["start"], f["end"], before, after))
    return _windowed(rows, hits, "model", before, after)


def locate_words(docs: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], before: int = 0, after: int = 0) -> DataFrame:
    """The first case-sensitive occurrence, on token boundaries, of each word or phrase that a
    scorer gives for an article; what does not occur is dropped.

    Done in the article's row: its tokens, joined, are searched for the phrase's tokens joined
    alike, and the number of tokens before that place gives the offset.  A phrase may have any
    number of tokens, whatever white space is between them.
    """
    keep = ["doc_id", *_row(docs)]
    rows = _scored(docs.select(*keep, "text"), scorer, [("label", "string"), ("word", "string")])
    rows = token_arrays(rows.select(*keep, "found", "text", text_blocks("text")), *keep, "found", "blocks")
    joined = F.concat(F.lit(_BETWEEN), F.array_join("toks", _BETWEEN), F.lit(_BETWEEN))
    words = F.transform(F.array_distinct("found"), lambda f: F.struct(
        F.coalesce(f["label"], F.lit(UNKNOWN)).alias("label"), F.regexp_extract_all(f["word"], F.lit(SPARK_TOKEN_RE), 0).alias("w")))
    rows = rows.select("*", joined.alias("_joined"), F.filter(words, lambda f: F.size(f["w"]) > 0).alias("_words"))

    def place(f: Column) -> Column:
        phrase = F.concat(F.lit(_BETWEEN), F.array_join(f["w"], _BETWEEN), F.lit(_BETWEEN))
        at = F.call_function("instr", F.col("_joined"), phrase)
        head = F.substring(F.col("_joined"), F.lit(1), at - 1)
        return F.struct(f["label"].alias("label"), F.size(f["w"]).alias("n"), at.alias("at"),
                        (F.length(head) - F.length(F.translate(head, _BETWEEN, ""))).alias("i"))

    spans = F.transform(F.filter(F.transform("_words", place), lambda f: f["at"] > 0), lambda f: F.struct(
        f["label"].alias("label"), offset_of(f["i"]).alias("start"),
        F.concat(F.array_join(run_of("pieces", f["i"], f["n"] - 1), ""), F.get("toks", f["i"] + f["n"] - 1)).alias("text")))
    hits = F.transform(spans, lambda f: _hit(f["label"], f["text"], f["start"], f["start"] + F.length(f["text"]), before, after))
    return _windowed(rows, hits, "model", before, after).dropDuplicates(["doc_id", "label", "start", "end"])


def merge_entities(ruler: DataFrame, model: DataFrame) -> DataFrame:
    """Model entities join the gazetteer ones only when (article, label,
    lower text) is new; gazetteer entities win."""
    key = ["doc_id", "label", "_k"]
    r = ruler.withColumn("_k", F.lower("text"))
    rest = ["start", *[c for c in ruler.columns if c not in ("doc_id", "label", "start")]]
    m = model.withColumn("_k", F.lower("text")).groupBy(*key).agg(F.min(F.struct(*rest)).alias("f")).select(*key, "f.*")
    new = m.join(r.select(*key), key, "left_anti")
    return r.unionByName(new.select(*r.columns)).drop("_k")


def words_by_label(model_entities: DataFrame) -> DataFrame:
    """A4: a row per word that a scorer gave, under its label or ``'Unknown'``; duplicates kept."""
    return model_entities.select("doc_id", F.coalesce(F.col("label"), F.lit(UNKNOWN)).alias("label"), "word")


def categorise(model_entities: DataFrame) -> DataFrame:
    """A4 in numbers: words and different words per label."""
    return words_by_label(model_entities).groupBy("label").agg(F.count(F.lit(1)).alias("n_words"), F.countDistinct("word").alias("n_distinct"))


# Characters that have a meaning in a regular expression.
_SPECIAL = r"([\\\^$.|?*+()\[\]{}#&~-])"


def _name_pattern(names: Column, word_aligned: bool) -> Column:
    longest = F.array_sort(names, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a))
                           .when(a < b, -1).when(a > b, 1).otherwise(0))
    quoted = F.array_join(F.transform(longest, lambda n: F.regexp_replace(n, _SPECIAL, r"\\$1")), "|")
    if word_aligned:
        return F.concat(F.lit(r"(?<![\p{L}\p{N}])(?:"), quoted, F.lit(r")(?![\p{L}\p{N}])"))
    return F.concat(F.lit("(?:"), quoted, F.lit(")"))


def mask_all(text: Column, names: Column, placeholder: str = "[NAME]", word_aligned: bool = False) -> Column:
    """H5: ``text`` with every occurrence of ``names`` (an array) replaced by ``placeholder``, in one
    pass from left to right, the longest name first.

    A name is replaced as a plain substring in its own letter case, also inside a longer word,
    as the reference does; ``word_aligned`` replaces it only where no letter or digit touches it.
    Null and empty names do nothing; a null text stays null.
    """
    some = F.array_distinct(F.filter(names, lambda n: F.length(n) > 0))
    return F.when(F.size(some) > 0, F.call_function("regexp_replace", text, _name_pattern(some, word_aligned), F.lit(placeholder))).otherwise(text)


def mask_spans(docs: DataFrame, spans: DataFrame, key: str = "doc_id", placeholder: str = "[NAME]") -> DataFrame:
    """H5: ``docs`` with each span (``key``, start, end; none overlapping) replaced by ``placeholder``.

    The spans of an article join its row as one array, and the text between them is taken from
    the blocks of the text; an article without spans stays as it is.
    """
    of = spans.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    rows = docs.join(of, key, "left").select(*docs.columns, "_spans", F.when(F.col("_spans").isNotNull(), text_blocks("text")).alias("blocks"))
    size = F.size("_spans")

    def before(x: Column, i: Column) -> Column:
        low = F.when(i > 0, F.get("_spans", i - 1)["end"]).otherwise(0)
        return F.concat(F.when(x["start"] > low, text_window("blocks", low, x["start"])).otherwise(F.lit("")), F.lit(placeholder))
    last = F.get("_spans", size - 1)["end"]
    tail = F.when(F.length("text") > last, text_window("blocks", last, F.length("text"))).otherwise(F.lit(""))
    masked = F.when(size > 0, F.concat(F.array_join(F.transform("_spans", before), ""), tail)).otherwise(F.col("text"))
    return rows.select(*[masked.alias("text") if c == "text" else F.col(c) for c in docs.columns])


def mask_scored_names(docs: DataFrame, scorer: Callable[[pd.DataFrame], pd.DataFrame], label: str = "PERSON",
                      word_aligned: bool = False) -> DataFrame:
    """H5: ``docs`` without the names that a scorer (``doc_id, label, word``) finds in each
    article under ``label``; done in the article's row."""
    rows = _scored(docs, scorer, [("label", "string"), ("word", "string")])
    names = F.transform(F.filter("found", lambda f: f["label"] == label), lambda f: f["word"])
    rows = rows.select(*docs.columns, names.alias("_names"))
    return rows.select(*[mask_all(F.col("text"), F.col("_names"), word_aligned=word_aligned).alias("text") if c == "text" else F.col(c)
                         for c in docs.columns])
