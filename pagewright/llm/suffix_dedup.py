"""Removal of byte strings that occur before, by difference-cover suffix sorting.

The sampled positions of a text are those whose residue modulo ``PERIOD`` lies in a difference
cover: of any two positions some common offset below ``PERIOD`` leads to two sampled ones.  So
two equal strings of ``LENGTH`` bytes hold, at one offset, equal sampled strings of ``STRING``
bytes.  These take the place of triples:

1. Sampled strings are sorted in ranges (equal ones of a task first become one) and named; a
   name is a hash, for equality is all that is asked of names.
2. Names at one distance from their earliest place are read on as strings of names.  As a
   sampled string reaches the next sampled position of its residue, such a chain compares all
   bytes from its first to its last, and one round of it passes ``LENGTH``, where the recursion ends.
3. The remaining positions, sampled or not, that hold a repeated name and lie in no chain, are
   merged: their prefixes of ``LENGTH`` bytes are sorted in ranges and neighbours compared, in a
   few rounds.

Rows between tasks hold whole blocks of names and places, not one each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm import wordhash as H
from pagewright.llm.common import release, written

#: Strings of so many bytes are looked for.
LENGTH = 100
#: A difference cover: every residue is the difference of two of these.
PERIOD, COVER = 50, np.array([0, 5, 11, 15, 24, 25, 27, 32])
#: Bytes of a sampled string; not below the period, so that strings at one residue overlap.
STRING = LENGTH - PERIOD + 1
#: Bytes of text that a task samples at once, per range of names, and per group of texts.
SLICE, RANGE_BYTES, GROUP_BYTES = 8_000_000, 16_000_000, 6_000_000
#: Bytes of a name that blocks hold, beside its range.  Of a sampled string: within a range of about
#: a million names a false repeat is one in a million, and costs a comparison of the whole
#: prefix; a chain takes two, at one distance.  Of a whole prefix, which decides: all.
STRING_BYTES, PREFIX_BYTES = 5, 8
#: Prefixes are compared in so many rounds, by their names, so that not all are on disk at once.
ROUNDS = 2

#: Blocks that tasks exchange: for a range of names (kind 0: documents in order, places and
#: names), or for a group of texts (kind 1: keys and what was found for each).
BLOCK = "kind int, part int, doc binary, key binary, n binary, name binary, pos binary, at binary"
_FIELDS = ["kind", "part", "doc", "key", "n", "name", "pos", "at"]
_SCHEMA = pa.schema([("kind", pa.int32()), ("part", pa.int32()), *[(c, pa.binary()) for c in _FIELDS[2:]]])


def _blocks(rows: list[tuple]) -> pa.Table:
    """Blocks as an Arrow table; what a kind does not use is null."""
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_SCHEMA)], schema=_SCHEMA)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more entry at the end)."""
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), at


def names(data: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes (8 or more) from each position ``at``."""
    if not len(at):
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    h = np.full(len(at), 0x51ED270B7A2F9C15 + length, np.uint64)
    for k in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        h += eight[at + k]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return H.mix(h)


def _range(name: np.ndarray, ranges: int) -> np.ndarray:
    return ((name >> np.uint64(40)) * np.uint64(ranges) >> np.uint64(24)).astype(np.int64)


def _runs(sorted_by: np.ndarray) -> np.ndarray:
    """The number of its run of equal entries, for each entry."""
    return np.cumsum(np.append(False, sorted_by[1:] != sorted_by[:-1])[:len(sorted_by)])


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype("<u2" if x.max(initial=0) < 1 << 16 else "<u4")


def _wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.int64)


def _for_ranges(name: np.ndarray, row: np.ndarray, pos: np.ndarray, doc: np.ndarray, key: np.ndarray, ranges: int,
                width: int) -> Iterator[tuple]:
    """Blocks of names, ``width`` bytes of each, in order of place (``row`` numbers documents in their order)."""
    part = _range(name, ranges)
    order = np.argsort(part, kind="stable")
    edge = np.searchsorted(part[order], np.arange(ranges + 1))
    for p in range(ranges):
        own = order[edge[p]:edge[p + 1]]
        if not len(own):
            continue
        docs, n = np.unique(row[own], return_counts=True)
        step = np.diff(pos[own], prepend=0)
        first = np.cumsum(n) - n
        step[first] = pos[own][first]
        yield (0, p, doc[docs].tobytes(), key[docs].tobytes(), _narrow(n).tobytes(),
               name[own].view(np.uint8).reshape(-1, 8)[:, :width].tobytes(), _narrow(step).tobytes(), None)


def _from_range(table: pa.Table) -> tuple[np.ndarray, ...]:
    """``name, doc, key, pos`` of all entries of a range's blocks."""
    out = [], [], [], []
    for doc, key, n, name, pos in zip(*(table.column(c).to_pylist() for c in ("doc", "key", "n", "name", "pos"))):
        n = _wide(n, len(doc) // 8)
        wide = np.zeros((n.sum(), 8), np.uint8)
        short = np.frombuffer(name, np.uint8).reshape(len(wide), -1)
        wide[:, :short.shape[1]] = short
        step = _wide(pos, len(wide))
        total, first = np.cumsum(step), np.cumsum(n) - n
        for c, v in zip(out, (wide.view("<u8").ravel(), np.repeat(np.frombuffer(doc, np.int64), n),
                              np.repeat(np.frombuffer(key, np.int64), n), total - np.repeat(total[first] - step[first], n))):
            c.append(v)
    return tuple(np.concatenate(c) for c in out)


def _for_groups(groups: int, key: np.ndarray, pos: np.ndarray, name: np.ndarray | None = None, at: np.ndarray | None = None) -> Iterator[tuple]:
    """Blocks of what was found for documents, by their group of texts, ordered by place."""
    group = np.mod(key, groups)
    order = np.lexsort((pos, key, group))
    edge = np.searchsorted(group[order], np.arange(groups + 1))
    for g in np.flatnonzero(np.diff(edge)):
        own = order[edge[g]:edge[g + 1]]
        yield (1, int(g), None, key[own].tobytes(), None, None if name is None else name[own].tobytes(),
               pos[own].astype("<i4").tobytes(), None if at is None else at[own].astype("<i4").tobytes())


def _from_group(table: pa.Table) -> tuple[np.ndarray, ...]:
    """``key, name, pos, at`` of a group's blocks."""
    def whole(c, kind):
        return np.frombuffer(b"".join(x for x in table.column(c).to_pylist() if x is not None), kind)
    return whole("key", np.int64), whole("name", np.int64), whole("pos", "<i4").astype(np.int64), whole("at", "<i4").astype(np.int64)


def _earliest(name: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For entries of which ``order`` sorts names, and places within equal names: the index of
    the first entry of each entry's name."""
    run = _runs(name[order])
    first = order[np.flatnonzero(np.append(True, run[1:] != run[:-1]))] if len(order) else order
    out = np.empty(len(order), np.int64)
    out[order] = first[run]
    return out


def _repeated(name: np.ndarray) -> np.ndarray:
    """The indexes of entries whose name others have too, by name."""
    order = np.argsort(name)
    same = name[order][1:] == name[order][:-1]
    return order[np.append(same, False)[:len(order)] | np.append(False, same)[:len(order)]]


def sampled(groups: int, ranges: int):
    """A function from batches of ``doc_id, key, text`` to blocks of sampled strings, and of
    the places whose string the same slice holds more than once."""
    def run(batches):
        for batch in batches:
            data, at = _bytes(batch.column("text"))
            doc, key = (batch.column(c).to_numpy() for c in ("doc_id", "key"))
            for row, base, size in _slices(doc, key, np.diff(at)):
                periods = np.maximum(0, (size - STRING) // PERIOD + 1)
                piece = np.repeat(np.arange(len(row)), periods)
                nth = np.arange(len(piece)) - np.repeat(np.cumsum(periods) - periods, periods)
                pos, piece = (nth[:, None] * PERIOD + COVER).ravel(), np.repeat(piece, len(COVER))
                inside = pos <= size[piece] - STRING
                pos, piece = pos[inside] + base[piece[inside]], piece[inside]
                own = row[piece]
                name = names(data, at[own] + pos, STRING)
                first = _earliest(name, np.argsort(name, kind="stable"))
                later = first != np.arange(len(first))
                both = np.append(np.flatnonzero(later), np.unique(first[later]))
                out = list(_for_groups(groups, key[own[both]], pos[both], key[own[first[both]]], pos[first[both]]))
                # the pieces of a document come one after the other, and documents in their order
                head = np.append(True, row[1:] != row[:-1])
                number, docs = (np.cumsum(head) - 1)[piece], row[head]
                out += _for_ranges(name[~later], number[~later], pos[~later], doc[docs], key[docs], ranges, STRING_BYTES)
                yield from _blocks(out).to_batches(max_chunksize=64)

    return run


def _slices(doc: np.ndarray, key: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, base, bytes)`` of pieces of texts, about ``SLICE`` bytes together, in the order of
    documents, each document once; the pieces of a long text overlap."""
    step = SLICE // PERIOD * PERIOD
    order = np.lexsort((key, doc))
    order = order[np.append(True, (doc[order][1:] != doc[order][:-1]) | (key[order][1:] != key[order][:-1]))[:len(order)]]
    row, base, many, held = [], [], [], 0
    for i in order.tolist():
        for b in range(0, max(1, int(size[i])), step):
            row.append(i)
            base.append(b)
            many.append(min(int(size[i]) - b, step + STRING - 1))
            held += many[-1]
            if held >= SLICE:
                yield np.array(row), np.array(base), np.array(many)
                row, base, many, held = [], [], [], 0
    if row:
        yield np.array(row), np.array(base), np.array(many)


def named(groups: int):
    """A function from a range's blocks to the places whose name others have, each with the
    name's earliest place; blocks for groups of texts pass."""
    def run(table: pa.Table) -> pa.Table:
        if table.column("kind")[0].as_py() != 0:
            return table
        name, doc, key, pos = _from_range(table)
        some = _repeated(name)
        name, doc, key, pos = name[some], doc[some], key[some], pos[some]
        first = _earliest(name, np.lexsort((pos, key, doc, name)))
        return _blocks(list(_for_groups(groups, key, pos, key[first], pos[first])))

    return run


def merged(groups: int):
    """As ``named``, for prefixes of whole ``LENGTH``: places that have an earlier equal."""
    def run(table: pa.Table) -> pa.Table:
        if table.column("kind")[0].as_py() != 0:
            return table
        name, doc, key, pos = _from_range(table)
        some = _repeated(name)
        name, doc, key, pos = name[some], doc[some], key[some], pos[some]
        first = _earliest(name, np.lexsort((pos, key, doc, name)))
        later = (key != key[first]) | (pos != pos[first])
        return _blocks(list(_for_groups(groups, key[later], pos[later], at=pos[later] + LENGTH)))

    return run


def _laid(texts: pa.Table) -> tuple[np.ndarray, ...]:
    """``data, at, doc, key`` of a group's documents, each once, in their order."""
    data, at = _bytes(texts.column("text").combine_chunks())
    doc, key = (texts.column(c).to_numpy() for c in ("doc_id", "key"))
    order = np.lexsort((key, doc))
    order = order[np.append(True, key[order][1:] != key[order][:-1])[:len(order)]]
    return data, at[order], np.diff(at)[order], doc[order], key[order]


def chained(groups: int, ranges: int, turn: int):
    """A function from a group's texts and its repeated places to strings that go (those of
    chains in the first round) and to blocks of the prefixes that are left to compare."""
    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        if not texts.num_rows or not found.num_rows:
            return _blocks([])
        data, begin, size, doc, key = _laid(texts)
        of, first, pos, at = _from_group(found)
        by = np.argsort(key)
        row = by[np.searchsorted(key[by], of)]
        # chains: places of a text at one distance from places of one earlier text, or of its own
        later = (first != of) | (at != pos)
        r, f, p, shift = row[later], first[later], pos[later], (pos - at)[later]
        order = np.lexsort((p, shift, f, r))
        r, f, p, shift = r[order], f[order], p[order], shift[order]
        new = np.append(True, (r[1:] != r[:-1]) | (f[1:] != f[:-1]) | (shift[1:] != shift[:-1]) | (p[1:] - p[:-1] > STRING))[:len(r)]
        start = np.flatnonzero(new)
        stop = np.append(start[1:], len(r))[:len(start)] - 1
        a, b, r = p[start], p[stop] + STRING, r[start]
        long = b - a >= LENGTH
        a, b, r = a[long], b[long], r[long]
        # prefixes that hold a repeated place and lie in no chain
        flat = np.cumsum(size) - size
        total = int(size.sum())
        marked = np.zeros(total + PERIOD + 1, np.int32)
        marked[flat[row] + pos + 1] = 1
        np.cumsum(marked, out=marked)
        open_ = marked[PERIOD:total + PERIOD] > marked[:total]
        del marked
        closed = np.zeros(total + 1, np.int32)
        np.add.at(closed, flat[r] + a, 1)
        np.add.at(closed, flat[r] + b - LENGTH + 1, -1)
        open_ &= np.cumsum(closed)[:total] == 0
        del closed
        for k in range(len(size)):
            open_[flat[k] + max(0, size[k] - LENGTH + 1):flat[k] + size[k]] = False
        left = np.flatnonzero(open_)
        own = np.searchsorted(flat, left, side="right") - 1
        left -= flat[own]
        name = names(data, begin[own] + left, LENGTH)
        now = name % np.uint64(ROUNDS) == turn
        name, own, left = name[now], own[now], left[now]
        before = _earliest(name, np.argsort(name, kind="stable"))
        again = before != np.arange(len(before))
        if turn:
            r, a, b = r[:0], a[:0], b[:0]
        out = list(_for_groups(groups, np.append(key[r], key[own[again]]), np.append(a, left[again]),
                               at=np.append(b, left[again] + LENGTH)))
        out += _for_ranges(name[~again], own[~again], left[~again], doc, key, ranges, PREFIX_BYTES)
        return _blocks(out)

    return run


RESULT = "doc_id long, kept binary, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>"
_RESULT = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _cut(texts: pa.Table, found: pa.Table) -> pa.Table:
    """A group's texts without the bytes of the strings that go."""
    rows = []
    data, at = _bytes(texts.column("text").combine_chunks())
    of, _, a, b = _from_group(found)
    order = np.argsort(of, kind="stable")
    of, a, b = of[order], a[order], b[order]
    key = texts.column("key").to_numpy()
    low, high = np.searchsorted(of, key, side="left"), np.searchsorted(of, key, side="right")
    for doc, begin, end, i, j in zip(texts.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), low.tolist(), high.tolist()):
        whole = data[begin:end]
        if i == j:
            rows.append((doc, whole.tobytes(), len(whole), 0, []))
            continue
        edge = np.zeros(len(whole) + 1, np.int32)
        np.add.at(edge, a[i:j], 1)
        np.add.at(edge, b[i:j], -1)
        gone = np.cumsum(edge)[:-1] > 0
        turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
        rows.append((doc, whole[~gone].tobytes(), len(whole), int(gone.sum()),
                     [{"start": s, "end": e} for s, e in zip(turn[::2].tolist(), turn[1::2].tolist())]))
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_RESULT)], schema=_RESULT)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: ``doc_id``, the ``kept`` bytes of its text, ``n_bytes`` before,
    ``n_removed`` and the ``spans`` (byte ranges) that went.

    A byte goes if a string of ``LENGTH`` bytes that covers it starts earlier too: in a document
    of a smaller doc_id, or before in the same one.  Strings are judged on the texts as they
    are and may overlap; they never cross documents.  A null text counts as empty.  A row with
    a null doc_id has no place in the order: it stays whole and makes nothing go.  Rows of equal
    doc_id and text are one document and stay alike; rows of equal doc_id and different texts
    are documents one after the other, ordered by a hash of the text.  Texts shorter than
    ``LENGTH`` bytes stay whole.  Other columns are left out; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    can = F.coalesce(F.col("doc_id").isNotNull() & (F.octet_length("text") >= LENGTH), F.lit(False))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.where(can).agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    groups, ranges = (max(1, -(-total // b)) for b in (GROUP_BYTES, RANGE_BYTES))
    usable = docs.where(can).select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    grouped = usable.withColumn("part", F.pmod(F.col("key"), F.lit(groups)).cast("int"))

    places = written(usable.mapInArrow(sampled(groups, ranges), BLOCK).groupBy("kind", "part").applyInArrow(named(groups), BLOCK))
    release(docs.sparkSession)
    spans = None
    for turn in range(ROUNDS):
        more = written(grouped.groupBy("part").cogroup(places.groupBy("part")).applyInArrow(chained(groups, ranges, turn), BLOCK)
                       .groupBy("kind", "part").applyInArrow(merged(groups), BLOCK))
        release(docs.sparkSession)
        spans = more if spans is None else spans.unionByName(more)
    changed = grouped.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(_cut, RESULT)
    size = F.octet_length(text).cast("long")
    plain = docs.where(~can).select("doc_id", text.cast("binary").alias("kept"), size.alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                                    F.array().cast("array<struct<start:long,end:long>>").alias("spans"))
    return changed.unionByName(plain)
