"""Removal of passages that repeat, by winnowing over line hashes.

Text is read as lines of a fixed number of words, one beginning at every word, so a
passage is met wherever it begins and ends; a line between line breaks would miss
passages that begin within one.  The smallest line hash of every window of lines is a
fingerprint: two texts that share ``LINE + WINDOW - 1`` words share one, without fail.
Each fingerprint's first occurrence, by doc_id and position, is joined to all others;
chained matches are extended both ways word by word, and of every run that is long
enough the later occurrence is deleted.  Where a line has further places and its run does
not hold all runs of ``MIN_RUN`` words around it, those are compared as wholes.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pagewright.llm import wordhash as H
from pagewright.llm.common import written
from pagewright.operators.partitioning import size_checked_broadcast

#: Words of a line, and lines of a window: runs of 50 words always share a fingerprint.
LINE, WINDOW = 25, 26
#: Runs of so many words on are deleted; two lines' words.
MIN_RUN = LINE + WINDOW - 1
#: Words to which a chain of matches can extend beyond its last fingerprint before there must be another.
REACH = WINDOW
#: Up to so many ids (8 bytes each) are broadcast to pick texts; beyond, texts are joined by a shuffle.
BROADCAST_IDS = 4_000_000
ADDED = ("n_words", "removed_words", "removed_spans")

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def window_minima(line: np.ndarray) -> np.ndarray:
    """Position of the smallest entry of each ``WINDOW`` consecutive ones, the first of equals.

    Hashes are ordered by their upper 36 bits, then place, packed into one number; a
    window's minimum is that of overlapping power-of-two windows.
    """
    low = np.uint64((1 << 28) - 1)
    packed = (line & ~low) | np.arange(len(line), dtype=np.uint64)
    size = 1
    while 2 * size <= WINDOW:
        packed = np.minimum(packed[:-size], packed[size:])
        size *= 2
    rest = WINDOW - size
    packed = np.minimum(packed[:-rest], packed[rest:]) if rest else packed
    return (packed & low).astype(np.int64)


def fingerprints(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, position, line hash)`` of each text's window minima."""
    words, at = H.split_words(texts, lower=False)
    if len(words) < MIN_RUN:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    line = H.windows(H.hashes(words), LINE)
    least = window_minima(line)
    inside = np.zeros(len(least) + 1, bool)
    for a, b in zip(at[:-1], at[1:]):
        inside[a:max(a, b - MIN_RUN + 1)] = True
    least = least[inside[:-1]]
    pick = least[np.append(True, least[1:] != least[:-1])] if len(least) else least
    owner = np.searchsorted(at, pick, side="right") - 1
    return owner, pick - at[owner], line[pick]


def _fingerprint_rows(part, texts):
    """Fingerprints, each with its last place before in the same text, or -1."""
    text, at, h = fingerprints(texts)
    order = np.lexsort((at, h, text))
    again = np.append(False, (text[order][1:] == text[order][:-1]) & (h[order][1:] == h[order][:-1]))[:len(order)]
    prev = np.full(len(at), -1, np.int64)
    prev[order[again]] = at[order[np.flatnonzero(again) - 1]]
    return pd.DataFrame({"fp": h.astype(np.int64), "doc_id": part.column("doc_id").to_numpy()[text], "pos": at.astype(np.int32),
                         "prev": prev.astype(np.int32)})


def _short(hashes: np.ndarray) -> np.ndarray:
    """31-bit hashes of words, to compare them at a run's ends."""
    return (H.mix(hashes) >> np.uint64(33)).astype(np.int32)


def _word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    words, at = H.split_words(texts, lower=False)
    return H.hashes(words), at


def _contexts(part, texts):
    """Words before (side 0) or after (side 1) each asked position of a text, as bytes."""
    hashes, at = _word_hashes(texts)
    short, rows = _short(hashes), []
    for doc, asked, a, b in zip(part.column("doc_id").to_pylist(), part.column("asked").to_pylist(), at[:-1], at[1:]):
        for code in asked:
            side, pos = code & 1, code >> 1
            span = (a + pos, min(b, a + pos + REACH)) if side else (max(a, a + pos - REACH), a + pos)
            rows.append((doc, side, pos, short[span[0]:span[1]].tobytes()))
    return pd.DataFrame(rows, columns=["first_doc", "side", "pos", "words"])


def _equal(x: np.ndarray, y: np.ndarray) -> int:
    """How many leading entries are equal."""
    n = min(len(x), len(y))
    same = x[:n] == y[:n]
    return n if same.all() else int(same.argmin())


def extend(words: np.ndarray, start: int, stop: int, before: np.ndarray, after: np.ndarray) -> tuple[int, int]:
    """A run grown to both sides as long as its words equal those around the first occurrence."""
    left = _equal(words[max(0, start - REACH):start][::-1], before[::-1])
    return start - left, stop + _equal(words[stop:stop + REACH], after)


def _extended(part, texts):
    """Each run of a text, grown to both sides, and its lines of which not all runs of
    ``MIN_RUN`` words lie within it (``open``)."""
    hashes, at = _word_hashes(texts)
    short, line, rows = _short(hashes), H.windows(hashes, LINE).astype(np.int64), []
    for doc, key, runs, a, b in zip(*(part.column(c).to_pylist() for c in ("doc_id", "_t", "_runs")), at[:-1], at[1:]):
        words, spans, last = short[a:b], [], None
        for r in sorted(runs, key=lambda r: (r["first_doc"], r["shift"], r["start"])):
            low, high = 0, 0
            # rows that share a doc_id may not have the text that the run was found in
            if r["start"] <= b - a - LINE and line[a + r["start"]] == r["fp"]:
                before, after = (np.frombuffer(r[c] or b"", np.int32) for c in ("before", "after"))
                low, high = extend(words, r["start"], min(r["stop"], b - a), before, after)
            edge = [p for p in r["edge"] if p <= b - a - LINE]
            # runs at one shift that meet are one
            if high and last == (r["first_doc"], r["shift"]) and low <= spans[-1][1]:
                spans[-1] = (spans[-1][0], max(spans[-1][1], high), spans[-1][2] + edge)
            else:
                spans.append((low, high, edge))
                last = (r["first_doc"], r["shift"]) if high else None
        for low, high, edge in spans:
            edge = np.array(edge, dtype=np.int64)
            closed = (low <= np.maximum(0, edge + LINE - MIN_RUN)) & (high >= np.minimum(b - a, edge + MIN_RUN))
            rows.append((doc, key, low, high, line[a + edge[~closed]]))
    return pd.DataFrame(rows, columns=["doc_id", "_t", "a", "b", "open"])


def _gram_rows(part, texts):
    """Hashes of the runs of ``MIN_RUN`` words that hold one of a text's given lines and
    are not within a span that goes: such a run has an earlier place, which gives it."""
    hashes, at = _word_hashes(texts)
    line, docs, keys, starts, grams = H.windows(hashes, LINE), [], [], [], []
    columns = (part.column(c).to_pylist() for c in ("doc_id", "_t", "_lines", "_held"))
    for doc, key, lines, held, a, b in zip(*columns, at[:-1], at[1:]):
        own = line[a:max(a, b - LINE + 1)]
        n = max(0, b - a - MIN_RUN + 1)
        pos, fp = (np.array([x[c] for x in lines], dtype=np.int64) for c in ("pos", "fp"))
        fp, pos = fp[pos < len(own)], pos[pos < len(own)]
        pos = pos[own[pos].view(np.int64) == fp]
        want, gone = np.zeros(n, bool), np.zeros(n + 1, np.int64)
        for x in pos:
            want[max(0, x - WINDOW + 1):x + 1] = True
        for r in held or []:
            if r["_t"] == key:
                gone[r["a"]] += 1
                gone[r["b"] - MIN_RUN + 1] -= 1
        start = np.flatnonzero(want & (np.cumsum(gone)[:n] == 0))
        # a run is two lines, one after the other
        grams.append(H.mix(H.mix(own[start]) + own[start + LINE]))
        starts.append(start)
        docs.append(np.full(len(start), doc))
        keys.append(np.full(len(start), key))
    return pd.DataFrame({"gram": np.concatenate(grams).astype(np.int64), "doc_id": np.concatenate(docs),
                         "_t": np.concatenate(keys), "a": np.concatenate(starts)})


def remove(text: str, spans) -> tuple[str, int, list[tuple[int, int]]]:
    """``text`` without some ranges of words, its number of words and the ranges' union."""
    begins = [m.start() for m in _WORD.finditer(text)]
    gone = np.zeros(len(begins) + 1, np.int64)
    for r in spans:
        gone[r["a"]] += 1
        gone[r["b"]] -= 1
    flag = np.concatenate([[0], (np.cumsum(gone[:-1]) > 0).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(flag))
    ranges = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
    out, at = [], 0
    for a, b in ranges:
        out.append(text[at:begins[a]])
        at = begins[b] if b < len(begins) else len(text)
    return "".join(out) + text[at:], len(begins), ranges


def first_places(prints: DataFrame) -> DataFrame:
    """``fp, first_doc, first_pos, n`` of the lines that have ``n`` places, two or more."""
    place = F.struct("doc_id", "pos")
    firsts = prints.groupBy("fp").agg(F.min(place).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return firsts.select("fp", F.col("f.doc_id").alias("first_doc"), F.col("f.pos").alias("first_pos"), "n")


def matches(prints: DataFrame, firsts: DataFrame) -> DataFrame:
    """Fingerprints (``fp, doc_id, pos``) that have an earlier place, with its document
    ``first_doc`` and the ``shift`` to it, and the ``run`` of their chain: fingerprints at
    one shift from the same document, a line or less apart, so that no word between them
    is left out.  ``many`` is false where
    the line is known to have no third place.

    The earlier place is the line's last place before in the same text, so that a text
    that repeats itself gives one chain; else it is the line's first place of all.
    """
    columns = ["fp", "doc_id", "pos", "first_doc", "shift", "many"]
    own = prints.where("prev >= 0").select("fp", "doc_id", "pos", F.col("doc_id").alias("first_doc"),
                                           (F.col("pos") - F.col("prev")).alias("shift"), F.lit(True).alias("many"))
    far = prints.where("prev < 0").join(firsts, "fp").where(F.col("doc_id") != F.col("first_doc")).select(
        "fp", "doc_id", "pos", "first_doc", (F.col("pos") - F.col("first_pos")).alias("shift"), (F.col("n") > 2).alias("many"))
    chain = Window.partitionBy("doc_id", "first_doc", "shift").orderBy("pos")
    new = F.coalesce((F.col("pos") - F.lag("pos").over(chain) > LINE).cast("int"), F.lit(1))
    later = own.select(*columns).unionByName(far.select(*columns)).withColumn("_new", new)
    return later.withColumn("run", F.sum("_new").over(chain.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_new")


def _of(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    return docs.join(size_checked_broadcast(ids, BROADCAST_IDS), "doc_id", how)


def remove_repeats(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` with every later occurrence of a run of ``min_run`` words or more deleted
    from ``text``, and ``n_words`` (before), ``removed_words``, ``removed_spans`` (ranges of
    words, ``start:end`` comma-joined).

    Occurrences are ordered by doc_id, then position; what is deleted in one place stays
    in an earlier one.  All columns of ``docs`` stay, but columns named like the added ones
    are replaced.  Words are compared as they are, white space does not matter.  A null
    text stays null; a row with a null doc_id has no place in the order, and stays whole.
    Rows of equal doc_id and text are one document and stay alike.  An empty table gives an
    empty result.  ``min_run`` may not be below ``LINE + WINDOW - 1``, from which on every
    run is found; a longer one, where it repeats the first place of its lines.
    """
    if min_run < MIN_RUN:
        raise ValueError(f"runs below {MIN_RUN} words need not share a fingerprint")
    docs = docs.drop(*ADDED)
    usable = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_t"))
    prints = written(H.map_texts(usable.select("doc_id", "text"), _fingerprint_rows, "fp long, doc_id long, pos int, prev int"))
    # written, so that the join with it has two plain sides and Spark can split a line that very many texts have
    firsts = written(first_places(prints))
    chain = ["doc_id", "first_doc", "shift", "run"]
    # edge: the lines so near a run's ends that the runs of MIN_RUN words around them may reach beyond it
    near = lambda p: (p < F.col("_s.pos") + (MIN_RUN - LINE)) | (p > F.col("stop") - MIN_RUN)
    runs = written(matches(prints, firsts).groupBy(*chain).agg(
        F.min(F.struct("pos", "fp")).alias("_s"), (F.max("pos") + LINE).alias("stop"),
        F.collect_list(F.when(F.col("many"), F.col("pos"))).alias("_p"))
                   .select(*chain, F.col("_s.pos").alias("start"), "stop", F.col("_s.fp").alias("fp"), F.filter("_p", near).alias("edge"))
                   .withColumn("_before", F.col("start") - F.col("shift")).withColumn("_after", F.col("stop") - F.col("shift")))
    touched = written(runs.select("doc_id").distinct())

    # the words around each first occurrence; a place that many runs repeat is asked for once
    ends = runs.select(F.col("first_doc").alias("doc_id"), F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("_before").alias("pos")),
        F.struct(F.lit(1).alias("side"), F.col("_after").alias("pos")))).alias("e"))
    asked = ends.select("doc_id", "e.side", "e.pos").distinct().groupBy("doc_id").agg(
        F.collect_list(F.col("pos") * 2 + F.col("side")).alias("asked"))
    ids = written(runs.select(F.col("first_doc").alias("doc_id")).distinct())
    around = written(H.map_texts(_of(usable, ids, "left_semi").join(asked, "doc_id"), _contexts, "first_doc long, side int, pos int, words binary")
                     .groupBy("first_doc", "side", "pos").agg(F.min("words").alias("words")))

    def side(n: int, name: str) -> DataFrame:
        return around.where(F.col("side") == n).select("first_doc", F.col("pos").alias(f"_{name}"), F.col("words").alias(name))

    found = (runs.join(side(0, "before"), ["first_doc", "_before"], "left").join(side(1, "after"), ["first_doc", "_after"], "left")
             .groupBy("doc_id").agg(F.collect_list(F.struct("first_doc", "shift", "run", "start", "stop", "fp", "edge", "before", "after")).alias("_runs")))
    grown = written(H.map_texts(_of(usable, touched, "left_semi").join(found, "doc_id"), _extended,
                                "doc_id long, _t long, a int, b int, open array<long>"))
    spans = grown.where(F.col("b") - F.col("a") >= min_run).select("doc_id", "_t", "a", "b")

    # a line may repeat another place in more words than the one it was held against: there, whole runs are compared
    open_ = written(grown.select(F.explode("open").alias("fp")).distinct().join(firsts.where("n > 2").select("fp"), "fp"))
    held = spans.groupBy("doc_id").agg(F.collect_list(F.struct("_t", "a", "b")).alias("_held"))
    places = written(prints.join(size_checked_broadcast(open_, BROADCAST_IDS), "fp").groupBy("doc_id").agg(
        F.collect_list(F.struct("pos", "fp")).alias("_lines")).join(held, "doc_id", "left"))
    if min_run == MIN_RUN and places.take(1):
        grams = written(H.map_texts(_of(usable, places.select("doc_id"), "left_semi").join(places, "doc_id"), _gram_rows,
                                    "gram long, doc_id long, _t long, a int"))
        place = F.struct("doc_id", "_t", "a")
        earliest = written(grams.groupBy("gram").agg(F.min(place).alias("_e"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
        again = grams.join(earliest, "gram").where(place != F.col("_e"))
        # runs that begin at one word after the other are one span
        island = F.col("a") - F.row_number().over(Window.partitionBy("doc_id", "_t").orderBy("a"))
        again = again.select("doc_id", "_t", "a").distinct().withColumn("_i", island).groupBy("doc_id", "_t", "_i").agg(
            F.min("a").alias("a"), (F.max("a") + MIN_RUN).alias("b"))
        spans = spans.unionByName(again.select("doc_id", "_t", "a", "b"))

    spans = spans.distinct().groupBy("doc_id", "_t").agg(F.collect_list(F.struct("a", "b")).alias("_spans"))
    gone = written(spans.select("doc_id").distinct())
    plain = _of(docs, gone, "left_anti").withColumns({
        "n_words": F.arrow_udf(H.word_counts, LongType())(F.col("text")),
        "removed_words": F.lit(0).cast("long"), "removed_spans": F.lit("")})
    schema = StructType([*docs.schema.fields, StructField("n_words", LongType()), StructField("removed_words", LongType()),
                         StructField("removed_spans", StringType())])
    names = docs.columns

    def clean(batches):
        for batch in batches:
            got = [remove(t, r or []) if t is not None else (None, 0, [])
                   for t, r in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist())]
            columns = [pa.array([g[0] for g in got], batch.column("text").type) if c == "text" else batch.column(c) for c in names]
            columns += [pa.array([g[1] for g in got], pa.int64()), pa.array([sum(b - a for a, b in g[2]) for g in got], pa.int64()),
                        pa.array([",".join(f"{a}:{b}" for a, b in g[2]) for g in got], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *ADDED])

    changed = _of(docs, gone, "left_semi").withColumn("_t", F.xxhash64("text")).join(spans, ["doc_id", "_t"], "left").select(
        *names, "_spans").mapInArrow(clean, schema)
    return plain.select(*names, *ADDED).unionByName(changed)
