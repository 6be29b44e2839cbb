"""Words of whole texts as arrays of 64-bit hashes, for tasks that run in Python.

Words are runs of characters other than ASCII white space, which is what
``bytes.split`` separates.  Texts are read from an Arrow batch as bytes, in slices of bounded
size, and never become Python strings; what a slice took is given back before the next one,
so beside the batch itself the memory of a task follows its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes of text turned into word objects at a time.
CHUNK = 1_000_000


def chunks(texts, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges ``(low, high)`` of texts of about ``most`` characters together."""
    low, size = 0, 0
    for n, t in enumerate(texts):
        size += len(t) if t is not None else 0
        if size >= most:
            yield low, n + 1
            low, size = n + 1, 0
    if low < len(texts):
        yield low, len(texts)


def raw(texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of all texts of an Arrow array, and where each begins (one more entry at the
    end); a null text has none."""
    texts = texts.cast(pa.large_binary())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    return memoryview(texts.buffers()[2] or b""), at


def slices(batches, column: str = "text", most: int = CHUNK) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of Arrow batches of about ``most`` bytes of text, and the texts' bytes."""
    for batch in batches:
        data, at = raw(batch.column(column))
        low = 0
        while low < batch.num_rows:
            high = min(batch.num_rows, max(low + 1, int(np.searchsorted(at, at[low] + most))))
            yield batch.slice(low, high - low), [bytes(data[a:b]) for a, b in zip(at[low:high].tolist(), at[low + 1:high + 1].tolist())]
            low = high
        pa.default_memory_pool().release_unused()


def map_texts(df: DataFrame, run, schema: str) -> DataFrame:
    """The rows that ``run`` gives, as a DataFrame of ``schema``, for each slice of ``df`` and
    the bytes of its column ``text``."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def over(batches):
        for part, texts in slices(batches):
            yield pa.RecordBatch.from_pandas(run(part, texts), arrow, preserve_index=False)

    return df.mapInArrow(over, schema)


def split_words(texts, lower: bool = True) -> tuple[list[bytes], np.ndarray]:
    """All words of some texts, and where each text's words begin (one more entry at the end)."""
    words: list[bytes] = []
    at = [0]
    for t in texts:
        if t is not None:
            t = t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass")
            words += (t.lower() if lower else t).split()
        at.append(len(words))
    return words, np.array(at, dtype=np.int64)


def as_objects(words: list[bytes]) -> np.ndarray:
    out = np.empty(len(words), dtype=object)
    out[:] = words
    return out


def hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    return pd.util.hash_array(as_objects(words), categorize=False) if words else np.zeros(0, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` consecutive entries of ``h``."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    out = h[:n].copy()
    for j in range(1, k):
        out *= base
        out += h[j:n + j]
    return mix(out)


def word_counts(texts: pa.Array) -> pa.Array:
    """Words of each text of an Arrow array; a null text has none."""
    data, at = raw(texts)
    return pa.array([len(bytes(data[a:b]).split()) for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.int64())
