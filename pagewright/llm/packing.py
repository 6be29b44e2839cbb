"""Packing of tokenized documents into sequences, by cutting-stock patterns.

Documents are cut into full sequences and a last piece.  A histogram of piece lengths
goes to the driver, where column generation finds the patterns and how often to use
each.  Pieces are ranked within their length class on the executors, and a piece's
rank gives its sequence.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagewright.llm.common import written
from pagewright.llm.cutting_stock import patterns

CAPACITY = 2048
#: Lengths are rounded up to multiples of this before they are matched.
GRAIN = 4
#: What a document has over full sequences is cut once more, at the last multiple of this:
#: few different and mostly short lengths fill sequences almost wholly.
CUT = 512
#: Id after each document.
END_ID = 1
#: Bytes of text taken at once, words (and as many parts of words) whose ids a task remembers, and words that it
#: learns in one call.
SLICE, REMEMBER, AT_ONCE = 4_000_000, 600_000, 2_000
#: A text with words of many kinds, by which a tokenizer shows whether it separates at white space.
PROBE = ["Hello", "wörld's", "x", "12ab", "(it's", "don't)", "ÀÉ", "日本", "a.b,c!", "😀", "<|x|>", "ĳ", "#&*", "é"]


class WordIds:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    Where a tokenizer separates at white space, which is tried on load, a text's ids are those
    of its words, and each different word is encoded once while it is remembered: by the
    tokenizer's own normalizer and pre-tokenizer on many words at once, and its model on each
    different piece.  Words with a special token, or in which these do not keep words apart,
    are encoded whole; so are all texts of another tokenizer.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {"": b""}
        self.pieces: dict[str, bytes] = {}
        self.by_word = all(self._whole(s.join(PROBE)) == b"".join(map(self._whole, PROBE))
                           and self._whole(s + s.join(PROBE) + s) == self._whole(s.join(PROBE))
                           for s in (" ", "\n", "\t", "\r\n", "\x0b", "\x0c", "  "))

    def _whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    @staticmethod
    def _pack(*ids: int) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ids_of(self, found: list[str]) -> list[bytes]:
        """Ids of each of some pieces; the model sees those it has not met."""
        if len(self.pieces) + len(found) > REMEMBER:
            self.pieces = {}
        known = self.pieces
        tokenize = self.tokenizer.model.tokenize
        for p in {p for p in found if p not in known}:
            known[p] = self._pack(*[t.id for t in tokenize(p)])
        return [known[p] for p in found]

    def _learn(self, words: list[str]) -> None:
        for low in range(0, len(words), AT_ONCE):
            some = words[low:low + AT_ONCE]
            joined = " ".join(some)
            if any(s in joined for s in self.special):
                self.known.update((w, self._whole(w)) for w in some if any(s in w for s in self.special))
                some = [w for w in some if w not in self.known]
                joined = " ".join(some)
            if some:
                self._learn_plain(some, joined)

    def _learn_plain(self, words: list[str], joined: str) -> None:
        if self.tokenizer.normalizer is not None:
            joined = self.tokenizer.normalizer.normalize_str(joined)
        if joined.count(" ") != len(words) - 1:
            # a word with a space of its own, or that has become one
            self.known.update((w, self._whole(w)) for w in words)
            return
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(joined) if self.tokenizer.pre_tokenizer is not None else []
        begin = np.cumsum([0] + [len(w) + 1 for w in joined.split(" ")])
        spans = np.array([at for _, at in found], dtype=np.int64).reshape(-1, 2)
        owner = np.searchsorted(begin, spans[:, 0], side="right") - 1
        if self.tokenizer.pre_tokenizer is None or (spans[:, 1] > begin[owner + 1] - 1).any():
            self.known.update((w, self._whole(w)) for w in words)
            return
        ids = self._ids_of([p for p, _ in found])
        edge = np.searchsorted(owner, np.arange(len(words) + 1)).tolist()
        self.known.update((w, ids[a] if b == a + 1 else b"".join(ids[a:b])) for w, a, b in zip(words, edge, edge[1:]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of an Arrow array of strings without nulls, one after the other,
        and where each text's begin (one more entry at the end)."""
        if not self.by_word:
            raw = [self._whole(t) for t in texts.to_pylist()]
            return np.frombuffer(b"".join(raw), "<u4"), np.cumsum([0] + [len(r) // 4 for r in raw])
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        different = words.dictionary.to_pylist()
        missing = [w for w in different if w not in self.known]
        if len(self.known) + len(missing) > REMEMBER:
            self.known, missing = {"": b""}, different
        self._learn(missing)
        # the ids of each different word are laid out once, and taken for every word
        ids = [self.known[w] for w in different]
        size = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        flat, code = np.frombuffer(b"".join(ids), "<u4"), words.indices.to_numpy()
        many = size[code]
        end = np.cumsum(many)
        # places fit 32 bits: there are no more of them than bytes of text in a slice
        take = np.repeat(((np.cumsum(size) - size)[code] - (end - many)).astype(np.int32), many)
        take += np.arange(len(take), dtype=np.int32)
        edge = split.offsets.to_numpy() - split.offsets[0].as_py()
        return flat[take], np.concatenate([[0], end])[edge]


_TOKENIZERS: dict[str, WordIds] = {}


def _tokenizer(path: str) -> WordIds:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def bounds(n: int, capacity: int, cut: int) -> list[int]:
    """Where the pieces of ``n`` tokens begin, and ``n``."""
    at = list(range(0, n, capacity))
    if cut and n - at[-1] > cut and (n - at[-1]) % cut and n - at[-1] < capacity:
        at.append(n - (n - at[-1]) % cut)
    return [*at, n]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           keep_ids: bool = False, cut_at: int = CUT) -> DataFrame:
    """Pieces of every document: full sequences, and what is over in one or two pieces.

    Null text counts as empty, and has the end id alone.  With ``keep_ids`` a column
    ``ids`` holds a piece's token ids.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = PIECE + (", ids array<int>" if keep_ids else "")
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def cut(batches):
        tok = _tokenizer(tokenizer_path)
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            upto = np.cumsum(size)
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(upto, upto[low] - size[low] + SLICE)))
                part = batch.slice(low, high - low)
                low = high
                ids, at = tok.encode(part.column("text"))
                rows = []
                for doc, a, b in zip(part.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4")
                    edges = bounds(len(own), capacity, cut_at)
                    for start, stop in zip(edges, edges[1:]):
                        rows.append((doc, start, stop - start, zlib.crc32(own[start:stop].tobytes()), len(own),
                                     own[start:stop].astype(np.int32) if keep_ids else None))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)], schema=arrow)

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInArrow(cut, schema)


def ranked(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, from 0, among the rows of equal ``by``.

    Rows are dealt by range, so that a class with many rows spreads over tasks; the ranges
    are written, each class counted per range, and the counts give each range its first
    rank.  There are at most as many counts as ranges and classes.
    """
    spread = written(rows.repartitionByRange(by, *order).withColumn("_range", F.spark_partition_id()))
    counts = spread.groupBy(by, "_range").agg(F.count(F.lit(1)).alias("_n"))
    first = counts.select(by, "_range", F.coalesce(F.sum("_n").over(
        Window.partitionBy(by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy(by, "_range").orderBy(*order))
    return spread.withColumn("_i", inside).join(F.broadcast(first), [by, "_range"]).withColumn(
        "rank", F.col("_first") + F.col("_i") - 1).drop("_i", "_first", "_range")


def assign(rows: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """``rows`` (with ``doc_id, start, length``) with ``sequence_id`` and ``offset``.

    The driver sees a histogram of at most ``capacity / grain`` classes.  Slots of a
    class are numbered over all patterns and their repeats; the piece of that rank takes it.
    """
    rows = rows.withColumn("_class", F.ceil(F.col("length") / grain).cast("int"))
    counts = {r["_class"]: r["n"] for r in rows.groupBy("_class").agg(F.count(F.lit(1)).alias("n")).collect()}
    first_sequence, slots = 0, {}
    for times, pattern in patterns(counts, capacity // grain):
        for size, copies in pattern.items():
            slots.setdefault(size, []).append((times * copies, copies, first_sequence))
        first_sequence += times
    table = {s: (np.cumsum([0] + [n for n, _, _ in v]), np.array([c for _, c, _ in v]), np.array([q for _, _, q in v]))
             for s, v in slots.items()}
    columns = [c for c in rows.columns if c != "_class"]
    kept = rows.select(*columns, "_class").withColumn("_start", F.col("start"))

    def place(batches):
        for pdf in batches:
            sequence, copy = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            klass, rank = pdf["_class"].to_numpy(), pdf["rank"].to_numpy()
            for s in np.unique(klass):
                at = np.flatnonzero(klass == s)
                edges, copies, begin = table[int(s)]
                p = np.searchsorted(edges, rank[at], side="right") - 1
                inside = rank[at] - edges[p]
                sequence[at], copy[at] = begin[p] + inside // copies[p], inside % copies[p]
            yield pdf[columns].assign(sequence_id=sequence, _klass=klass, _copy=copy)

    ranks = ranked(kept, "_class", ["doc_id", "_start"]).drop("_start")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_class")
    placed = ranks.mapInPandas(place, schema + ", sequence_id long, _klass int, _copy long")
    before = Window.partitionBy("sequence_id").orderBy(F.col("_klass").desc(), "_copy").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("_klass", "_copy")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, grain: int = GRAIN,
                   end_id: int = END_ID, keep_ids: bool = False, cut_at: int = CUT) -> DataFrame:
    """Every token of ``docs`` in exactly one piece, and every piece in a sequence of at
    most ``capacity`` tokens.

    Returns a row per piece: ``doc_id, start, length, ids_crc32, doc_tokens``, ``ids``
    with ``keep_ids``, ``sequence_id, offset``.  Other columns of ``docs`` are left out.
    Rows that repeat a document are packed each; a null doc_id stays null.  An empty
    table gives an empty result.
    """
    return assign(written(pieces(docs, tokenizer_path, capacity, end_id, keep_ids, cut_at)), capacity, grain)
