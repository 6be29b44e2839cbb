"""Near-duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A signature has 50 positions of 16 bits, cut into 10 chunks of 5.  Signatures that
differ in at most 19 positions have, by pigeonhole, a chunk with at most one error, so
they share one of the chunk's keys: the chunk with any one position left out.  Pairs
that share a key are the candidates; links are confirmed on the full shingle sets.

At a similarity of 0.75 a chunk has at most one error with probability 0.63, so a pair
is a candidate but for 1 in 20,000; more similar pairs are lost far more rarely.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from pagewright.llm import wordhash as H
from pagewright.llm.common import WORD, written
from pagewright.llm.components import components, relabel
from pagewright.operators.partitioning import size_checked_broadcast

SHINGLE = 5
POSITIONS, CHUNK = 50, 5
#: Candidates whose signatures differ in more positions are not similar enough: at a
#: similarity of 0.75 that happens to 3 pairs in 100,000.
MOST_DIFFERENT = 25
#: Members of a key's group that are compared in one piece of work.
BLOCK = 2048
#: Up to so many rows of 32 bytes are broadcast to pick texts; beyond, texts are joined by a shuffle.
BROADCAST_IDS = 2_000_000

#: Before full sets are compared, pairs between components are compared by bitmaps of their
#: shingles' hashes: a bit that one has alone stands for at least one shingle that it has alone.
BITS = 8192

_DRAW = np.random.default_rng(20240607)
_MULTIPLY = _DRAW.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _DRAW.integers(1, 1 << 63, POSITIONS, dtype=np.uint64)


def shingle_sets(texts) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes: windows of five words
    in lower case (A-Z), or all words of a shorter text; none without words."""
    words, at = H.split_words(texts)
    h = H.hashes(words)
    wide = H.windows(h, SHINGLE)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= SHINGLE:
            out.append(np.unique(wide[a:b - SHINGLE + 1]))
        else:
            out.append(H.windows(h[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signatures of sets that are not empty, cut to 16 bits."""
    flat = np.concatenate(sets)
    start = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]]).astype(np.int64)
    out = np.empty((len(sets), POSITIONS), np.uint16)
    for k in range(POSITIONS):
        low = np.minimum.reduceat(flat * _MULTIPLY[k] + _ADD[k], start)
        out[:, k] = (H.mix(low) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """The lowest bits of a set's hashes as a bitmap of 64-bit words."""
    bits = np.zeros(BITS, np.uint8)
    bits[H.mix(shingles) % np.uint64(BITS)] = 1
    return np.packbits(bits).view(np.uint64)


def digests(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that tell a set."""
    return (int(H.mix(shingles).sum().astype(np.int64)),
            int(H.mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum().astype(np.int64)))


def keys(signature: np.ndarray) -> np.ndarray:
    """The keys of each signature: every chunk with every position left out in turn."""
    parts = signature.reshape(len(signature), -1, CHUNK).astype(np.uint64)
    out = []
    for c in range(parts.shape[1]):
        for left_out in range(CHUNK):
            kept = [j for j in range(CHUNK) if j != left_out]
            packed = np.zeros(len(signature), np.uint64)
            for j in kept:
                packed = (packed << np.uint64(16)) | parts[:, c, j]
            out.append(H.mix(packed ^ H.mix(np.full(1, 1 + c * CHUNK + left_out, np.uint64))[0]))
    return np.stack(out, axis=1)


def _sketch(part, texts):
    sets = shingle_sets(texts)
    some = [i for i, x in enumerate(sets) if len(x)]
    sig = np.empty(len(sets), dtype=object)
    d = np.zeros((2, len(sets)), np.int64)
    for i, x in zip(some, signatures([sets[i] for i in some]) if some else ()):
        sig[i] = x.tobytes()
        d[:, i] = digests(sets[i])
    return pd.DataFrame({"doc_id": part.column("doc_id").to_pandas(integer_object_nulls=True), "text_key": part.column("text_key").to_numpy(),
                         "n_shingles": np.array([len(x) for x in sets], dtype=np.int64), "d1": d[0], "d2": d[1], "sig": sig})


def _keyed(batches):
    for pdf in batches:
        for low in range(0, len(pdf), 4096):
            part = pdf.iloc[low:low + 4096]
            k = keys(np.frombuffer(b"".join(part["sig"]), np.uint16).reshape(-1, POSITIONS))
            yield pd.DataFrame({"key": k.ravel().astype(np.int64), "rep": np.repeat(part["rep"].to_numpy(), k.shape[1])})


def _wanted(part, texts):
    """``rep`` and shingle set of the texts that a representative stands for: a doc_id may
    have other texts too."""
    sets = shingle_sets(texts)
    for rep, d1, d2, x in zip(*(part.column(c).to_pylist() for c in ("rep", "d1", "d2")), sets):
        if len(x) and digests(x) == (d1, d2):
            yield rep, x


def _set_rows(part, texts):
    rows = [(rep, x.astype(np.int64)) for rep, x in _wanted(part, texts)]
    return pd.DataFrame(rows, columns=["rep", "shingles"])


def _map_rows(part, texts):
    rows = list(_wanted(part, texts))
    both = zip(rows, signatures([x for _, x in rows]) if rows else ())
    return pd.DataFrame([(rep, sig.tobytes(), bitmap(x).tobytes()) for (rep, x), sig in both], columns=["rep", "sig", "bits"])


def _may_link(size: np.ndarray, bits: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets can be similar enough: false only where their sizes, or the bits that one
    has alone, leave too few shingles in common."""
    out = np.zeros(len(i), bool)
    for low in range(0, len(i), 20_000):
        s = slice(low, low + 20_000)
        a, b = i[s], j[s]
        fit = 100 * np.minimum(size[a], size[b]) >= percent * np.maximum(size[a], size[b])
        a, b = a[fit], b[fit]
        alone = np.bitwise_count(bits[a] & ~bits[b]).sum(axis=1, dtype=np.int64), np.bitwise_count(bits[b] & ~bits[a]).sum(axis=1, dtype=np.int64)
        shared = np.minimum(size[a] - alone[0], size[b] - alone[1])
        out[low:low + 20_000][fit] = 100 * shared >= percent * (size[a] + size[b] - shared)
    return out


def _first_common(own: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The first key that rows ``i`` and ``j`` share at the same place."""
    out = np.empty(len(i), own.dtype)
    for low in range(0, len(i), 20_000):
        s = slice(low, low + 20_000)
        out[s] = own[i[s], (own[i[s]] == own[j[s]]).argmax(axis=1)]
    return out


def _cross(percent: int):
    """A function that gives the pairs of different labels in each (key, cell) of rows sorted
    by it; a cell of two blocks gives the pairs across them.  A pair that shares several keys
    is compared under the first of them alone."""
    def pairs(pdf):
        if len(pdf) < 2:
            return
        group = pdf["key"].to_numpy(), pdf["cell"].to_numpy()
        rep, label, side, one, size = (pdf[c].to_numpy() for c in ("rep", "label", "side", "one", "n_shingles"))
        own = keys(np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), -1)).astype(np.int64)
        bits = np.frombuffer(b"".join(pdf["bits"]), np.uint64).reshape(len(pdf), -1)
        at, d = np.arange(len(pdf) - 1), 1
        while len(at):
            at = at[at + d < len(pdf)]
            at = at[(group[0][at] == group[0][at + d]) & (group[1][at] == group[1][at + d])]
            other = at + d
            ok = (label[at] != label[other]) & (one[at] | (side[at] != side[other]))
            i, j = at[ok], other[ok]
            first = _first_common(own, i, j) == group[0][i]
            i, j = i[first], j[first]
            near = _may_link(size, bits, i, j, percent)
            if near.any():
                yield pd.DataFrame({"a": np.maximum(rep[i], rep[j])[near], "b": np.minimum(rep[i], rep[j])[near]})
            d += 1

    def run(batches):
        held = None
        for pdf in batches:
            pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            last = (pdf["key"].to_numpy() == pdf["key"].iat[-1]) & (pdf["cell"].to_numpy() == pdf["cell"].iat[-1])
            held = pdf[last].reset_index(drop=True)
            yield from pairs(pdf[~last].reset_index(drop=True))
        if held is not None:
            yield from pairs(held)

    return run


def _distance(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="int32")
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, POSITIONS) for s in (a, b))
    return pd.Series((x != y).sum(axis=1).astype(np.int32))


def _texts(docs: DataFrame, ids: DataFrame, reps: DataFrame) -> DataFrame:
    """Texts of the representatives in column ``rep`` of ``ids``, with the digests of their sets."""
    wanted = written(reps.select("rep", "doc_id", "d1", "d2").join(ids.distinct(), "rep"))
    return docs.select("doc_id", "text").where(F.col("text").rlike(WORD)).join(size_checked_broadcast(wanted, BROADCAST_IDS), "doc_id")


def _verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Those pairs ``a, b`` whose full shingle sets are similar enough."""
    ids = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))
    sets = H.map_texts(_texts(docs, ids, reps), _set_rows, "rep long, shingles array<long>")
    left, right = (sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_a", "_b"))
    return both.where(shared * 100 >= (F.size("_a") + F.size("_b") - shared) * percent).select("a", "b")


def groups(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``doc_id, text_key, n_shingles, group`` of every row of ``docs``, by ``doc_id`` and
    ``text``: rows that links lead between have one ``group``, rows without links each set its own.

    ``text_key`` is the text's xxhash64, so rows of one doc_id and different texts are told
    apart.  ``group`` is null for a row without words, text or doc_id.  Rows with equal sets
    become one representative, with a number of its own, before anything is compared.  In each
    key's group every member is first compared with one member, the one of lowest number over
    its keys that is nearest to it, which joins groups of copies of any size with one link
    each.  Only pairs that still lie in different components are compared after that, all of
    them, in blocks of bounded size: by size and by bitmaps, which pass over no pair that is
    similar enough, then by full sets.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    sketch = written(H.map_texts(docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text"), _sketch,
                                 "doc_id long, text_key long, n_shingles long, d1 long, d2 long, sig binary"))
    usable = sketch.where("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["n_shingles", "d1", "d2"]
    reps = usable.groupBy(*same).agg(F.min(F.struct("doc_id", "sig")).alias("m")).select(
        *same, F.col("m.doc_id").alias("doc_id"), F.col("m.sig").alias("sig"))
    # numbered in the order of doc_id, so that a group's lowest member is its earliest document
    reps = written(reps.repartitionByRange("doc_id", *same).sortWithinPartitions("doc_id", *same).withColumn(
        "rep", F.monotonically_increasing_id()))
    keyed = written(reps.select("rep", "sig").mapInPandas(_keyed, "key long, rep long"))
    hubs = keyed.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("_top")).where("hub <> _top").drop("_top")
    # written, so that the join has two plain sides and Spark can split a key that very many members have
    members = written(keyed.join(written(hubs), "key"))

    # one link for each member: to the nearest of its groups' lowest members
    sig = reps.select("rep", "sig")
    near = members.where("rep <> hub").select("rep", "hub").distinct()
    near = near.join(sig, "rep").join(sig.select(F.col("rep").alias("hub"), F.col("sig").alias("_sig")), "hub")
    near = near.withColumn("d", F.pandas_udf(_distance, IntegerType())(F.col("sig"), F.col("_sig"))).where(F.col("d") <= MOST_DIFFERENT)
    first = written(near.groupBy("rep").agg(F.min(F.struct("d", "hub")).alias("m")).select(
        F.col("rep").alias("a"), F.col("m.hub").alias("b")))
    labels = components(_verified(first, docs, reps, percent))

    # all pairs that are left between components
    rows = relabel(members.select("key", "rep", F.col("rep").alias("label")), "label", labels)
    mixed = rows.groupBy("key").agg(F.min("label").alias("_l"), F.max("label").alias("_h"), F.count(F.lit(1)).alias("_n")).where("_l <> _h")
    rows = written(rows.join(written(mixed.select("key", "_n")), "key"))
    maps = H.map_texts(_texts(docs, rows.select("rep"), reps), _map_rows, "rep long, sig binary, bits binary")
    maps = maps.groupBy("rep").agg(F.min(F.struct("sig", "bits")).alias("m")).select("rep", "m.sig", "m.bits")
    rows = rows.join(maps, "rep").join(reps.select("rep", "n_shingles"), "rep")
    blocks = F.ceil(F.col("_n") / BLOCK).cast("int")
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    rows = rows.withColumn("_o", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("key", "rep", "label", "n_shingles", "sig", "bits",
                       (F.least("_b", "_o") * blocks + F.greatest("_b", "_o")).alias("cell"),
                       F.col("_b").alias("side"), blocks.alias("_nb"))
    # a row is in a cell once; in a cell of one block all pairs count, in a cell of two those across
    rows = rows.withColumn("one", F.pmod(F.col("cell"), F.col("_nb")) == F.floor(F.col("cell") / F.col("_nb")))
    dealt = rows.drop("_nb").repartition("key", "cell").sortWithinPartitions("key", "cell")
    more = written(dealt.mapInPandas(_cross(percent), "a long, b long").distinct())
    if more.take(1):
        found = _verified(more, docs, reps, percent)
        ends = relabel(relabel(found, "a", labels), "b", labels)
        above = components(ends)
        labels = relabel(labels, "b", above).unionByName(above.join(labels.select("a"), "a", "left_anti")) if above.take(1) else labels

    owner = relabel(reps.select(*same, F.col("rep").alias("group")), "group", labels)
    return sketch.join(owner, same, "left").select(
        "doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("group")).alias("group"))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Rows are linked where ``100 * |A & B| >= percent * |A | B|`` on their distinct
    shingles.  ``component_id`` is the smallest doc_id that links lead to, and ``kept``
    marks the row that has it.  A null or empty text has no shingles and no links, and
    so has a row with a null doc_id, whose component is null and which is kept.  Rows
    with one doc_id and different texts have each their own links and component.  Other
    columns are left out; an empty table gives an empty result.
    """
    rows = written(groups(docs, percent))
    first = rows.where("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("component_id"))
    out = rows.join(first, "group", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
