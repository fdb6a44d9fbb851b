"""Helpers shared by the corpus operators: written intermediates, checked broadcasts and word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.session import prepare, scratch_path, table

# rows that reach a Python worker at once; whole texts travel in them
BATCH_ROWS = 1000
BROADCAST_ROWS = 200_000
SHINGLE = 5
SLICE_BYTES = 1 << 20  # bytes of text whose words are found at once
LONG = 64  # bytes of a word hashed eight at a time for all words together
_MULT = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return table(ready(spark), folder, name)


def settled(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: it is computed once and outlives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint the broadcast of a written table only if its counted rows are few; else Spark joins by shuffle."""
    return F.broadcast(df) if df.count() <= max_rows else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet, whatever its letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


class WordHashes(dict):
    """Word, as text or in UTF-8, to 64-bit hash, remembered up to a bound."""

    bound = 300_000

    def __missing__(self, word: str | bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word if isinstance(word, bytes) else word.encode("utf-8", "surrogatepass"))
        return h

    def of(self, words: list[str] | list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``k`` words, from the hashes of the words; none for shorter texts."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = np.full(n, seed + k, np.uint64)
    for j in range(k):
        acc = mix(acc * _MULT + h[j : j + n])
    return acc


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values, by doubling."""
    if len(a) < w:
        return a[:0]
    size = 1
    out = a
    while size * 2 <= w:
        out = np.minimum(out[: len(out) - size], out[size:])
        size *= 2
    rest = w - size
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def text_slices(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows of a task in slices of bounded size, with the bytes of their texts (null: none) end to end and the bounds of each."""
    for b in batches:
        if not b.num_rows:
            continue
        text = b.column(place).cast(pa.large_binary()).fill_null(b"")
        bounds = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        lo = 0
        while lo < len(text):
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + SLICE_BYTES, "right")) - 1)
            yield b.slice(lo, hi - lo), data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
            lo = hi


def runs_of(flags: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of set flags; none goes on over a bound."""
    head, tail = flags.copy(), flags.copy()
    head[1:] &= ~flags[:-1]
    tail[:-1] &= ~flags[1:]
    edge = bounds[(bounds > 0) & (bounds < len(flags))]
    head[edge], tail[edge - 1] = flags[edge], flags[edge - 1]
    return np.flatnonzero(head), np.flatnonzero(tail) + 1


def _load(data: np.ndarray, kind: str) -> np.ndarray:
    """The little-endian number that begins at each byte."""
    return np.ndarray((len(data) + 1,), kind, np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of stretches of bytes; those of up to eight bytes never share one with another of their length."""
    eight = _load(data, "<u8")
    size = ends - starts
    out = mix((size.astype(np.uint64) * _MULT) ^ (eight[starts] & _LOW[np.minimum(size, 8)]))
    for at in range(8, LONG, 8):
        more = np.flatnonzero(size > at)
        if not len(more):
            return out
        out[more] = mix(out[more] ^ (eight[starts[more] + at] & _LOW[np.minimum(size[more] - at, 8)]))
    for i in np.flatnonzero(size > LONG):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]])
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """What ``WordHashes`` gives for stretches of bytes: XXH3 for all of up to eight bytes at once, by the library beyond."""
    size = ends - starts
    out = np.empty(len(starts), np.uint64)
    few, some, more = np.flatnonzero(size <= 3), np.flatnonzero((size > 3) & (size <= 8)), np.flatnonzero(size > 8)
    a, n = starts[few], size[few]
    x = data[a].astype(np.uint64) << np.uint64(16) | data[a + (n >> 1)].astype(np.uint64) << np.uint64(24)
    x = (x | data[a + n - 1] | n.astype(np.uint64) << np.uint64(8)) ^ np.uint64(0x87275A9B)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    out[few] = x ^ (x >> np.uint64(32))
    four = _load(data, "<u4")
    x = (four[ends[some] - 4] + (four[starts[some]].astype(np.uint64) << np.uint64(32))) ^ np.uint64(0xC73AB174C5ECD5A2)
    x ^= (x << np.uint64(49) | x >> np.uint64(15)) ^ (x << np.uint64(24) | x >> np.uint64(40))
    x *= np.uint64(0x9FB21C651E98DF25)
    x = (x ^ ((x >> np.uint64(35)) + size[some].astype(np.uint64))) * np.uint64(0x9FB21C651E98DF25)
    out[some] = x ^ (x >> np.uint64(28))
    raw = data.tobytes()
    out[more] = np.fromiter((xxhash.xxh3_64_intdigest(raw[i:j]) for i, j in zip(starts[more].tolist(), ends[more].tolist())), np.uint64, len(more))
    return out
