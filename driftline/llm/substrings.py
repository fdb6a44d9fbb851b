"""Substring de-duplication by relative Lempel-Ziv parsing over 13-word phrases.

The reference of a document is every document with a smaller doc_id, held in blocks. A factor is a stretch of the
document that occurs in the reference; factors of ``window`` words or more are duplicate spans. A stretch has such a
factor exactly where one of its windows starts in the reference, so the parse looks every window up and lets a factor
run on while the next one is found, in whichever block; the windows across a factor's end are looked up like all
others. Spans of neighbouring factors unite.

1. Anchors: each window is represented by the smallest hash of its k-grams. A task indexes a block of documents and
   emits each anchor once, with whether several of the block's documents have it. Counting them over all blocks gives the
   anchors that documents share.
2. Shared anchors set bits in a filter of bounded size (at most ``MAX_BITS``). Windows whose anchor has no bit occur in
   one document only. A false bit lets a window through and changes no result; a corpus too large for the filter sends
   more windows on.
3. Each task compares the windows of its block: all but those of the smallest doc_id are decided at once, the others go
   on as (128-bit hash, doc_id, place). So a passage that any number of documents share is one key with a row per
   block, not per document. Sorted by hash, each run's first row has the smallest doc_id; all later documents hold a
   duplicate there.
4. Places return to their documents by (doc_id, hash of the text).

Defined cases: a null text has no words; documents without a doc_id neither lose words nor serve as reference;
windows that recur inside one document, or in rows of an equal doc_id, are no duplicates; texts of fewer words
than a window stay whole; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import fresh, mix, runs_of, settled, sliding_min, span_hashes, text_slices

WINDOW = 13
GRAM = 5
BLOCK_WORDS = 1_000_000
MIN_BITS, MAX_BITS = 20, 29
CHUNK_BITS = 20
WORD_BYTES = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
_M1, _M2, _M3 = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0x9E3779B97F4A7C15


class Block(NamedTuple):
    """Documents one after another: hashes of all words, and the place of each document's first one (and the end)."""

    docs: np.ndarray
    keys: np.ndarray
    words: np.ndarray
    first: np.ndarray


def spread(terms: list[np.ndarray], factor: int, seed: int) -> np.ndarray:
    """One hash of several columns of hashes."""
    acc = np.full(len(terms[0]), seed, np.uint64)
    for j, t in enumerate(terms):
        acc += t * np.uint64(pow(factor, j + 1, 1 << 64))
    return mix(acc)


def anchors_of(block: Block, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """k-gram hashes of a block, the smallest one in each window, the row each window begins in, and whether it ends there."""
    n = len(block.words)
    g = spread([block.words[j : n - GRAM + 1 + j] for j in range(GRAM)], _M3, GRAM) if n >= GRAM else block.words[:0]
    anchors = sliding_min(g, window - GRAM + 1)
    row = np.repeat(np.arange(len(block.docs)), np.diff(block.first))[: len(anchors)]
    return g, anchors, row, np.arange(window, window + len(anchors)) <= block.first[1:][row]


def window_hashes(g: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the windows that start at ``at``, from overlapping k-grams that cover them."""
    terms = [g[at + s] for s in (*range(0, window - GRAM, GRAM - 1), window - GRAM)]
    return spread(terms, _M1, 0), spread(terms, _M2, window)


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Documents of a task, in blocks of bounded size."""
    held: list[Block] = []

    def block() -> Block:
        docs, keys, words, counts = (np.concatenate(c) for c in zip(*held))
        return Block(docs, keys, words, np.concatenate([[0], np.cumsum(counts)]))

    for rows, data, bounds in text_slices(batches, 2):
        starts, ends = runs_of(WORD_BYTES[data], bounds)
        docs, keys = (rows.column(i).to_numpy().astype(np.int64) for i in range(2))
        held.append(Block(docs, keys, span_hashes(data, starts, ends), np.diff(np.searchsorted(starts, bounds))))
        if sum(len(x.words) for x in held) >= BLOCK_WORDS:
            yield block()
            held.clear()
    if held:
        yield block()


def _emit_anchors(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            _, found, row, whole = anchors_of(block, window)
            # neighbouring windows mostly have the same anchor
            whole[1:] &= (found[1:] != found[:-1]) | (row[1:] != row[:-1])
            found, row = found[whole], row[whole]
            order = np.argsort(found, kind="stable")
            found, row = found[order], row[order]
            head = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.empty(0, np.int64)
            many = row[head] != row[np.append(head[1:], len(found)) - 1] if len(found) else np.empty(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(found[head].view(np.int64)), pa.array(many)], ["anchor", "many"])

    return run


def shared_anchors(keyed: DataFrame, window: int) -> DataFrame:
    found = keyed.mapInArrow(_emit_anchors(window), "anchor bigint, many boolean")
    counts = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("many").alias("many"))
    return counts.where("n > 1 OR many").select("anchor")


def bit_filter(anchors: DataFrame) -> np.ndarray:
    """Bits of the anchors, as packed bytes: 16 bits an anchor up to the bound. Tasks build chunks of it."""
    bits = min(MAX_BITS, max(MIN_BITS, int(16 * anchors.count()).bit_length()))

    def chunk(rows: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(1 << CHUNK_BITS, np.uint8)
        flags[rows["slot"].to_numpy()] = 1
        return pd.DataFrame({"part": [rows["part"].iloc[0]], "bits": [np.packbits(flags).tobytes()]})

    slot = F.col("anchor").bitwiseAND(F.lit((1 << bits) - 1))
    rows = anchors.select(F.shiftright(slot, CHUNK_BITS).cast("int").alias("part"), slot.bitwiseAND(F.lit((1 << CHUNK_BITS) - 1)).cast("int").alias("slot"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    size = (1 << CHUNK_BITS) // 8
    for r in rows.distinct().groupBy("part").applyInPandas(chunk, "part int, bits binary").toLocalIterator():
        out[r["part"] * size : (r["part"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


WINDOWS = "h1 bigint, h2 bigint, doc_id bigint, text_key bigint, pos int, done boolean"


def _emit_windows(window: int, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        mask = np.uint64(len(bits) * 8 - 1)
        for block in blocks_of(batches):
            g, anchors, row, whole = anchors_of(block, window)
            slot = (anchors & mask).astype(np.int64)
            at = np.flatnonzero(whole & (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool))
            if not len(at):
                continue
            one, two = window_hashes(g, at, window)
            row = row[at]
            docs, keys, places = block.docs[row], block.keys[row], at - block.first[row]
            order = np.argsort(one)
            x, y = one[order], two[order]
            if ((x[1:] == x[:-1]) & (y[1:] != y[:-1])).any():  # the first hash alone does not tell them apart
                order = np.lexsort((two, one))
                x, y = one[order], two[order]
            head = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
            least = np.empty_like(docs)
            least[order] = np.repeat(np.minimum.reduceat(docs[order], head), np.diff(np.append(head, len(order))))
            done = docs > least
            # what is decided needs no company: it is spread by its own place, not by its hash
            one = np.where(done, mix(keys.view(np.uint64) * np.uint64(_M1) + places.astype(np.uint64)), one)
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(docs), pa.array(keys), pa.array(places.astype(np.int32)), pa.array(done)],
                ["h1", "h2", "doc_id", "text_key", "pos", "done"],
            )

    return run


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by hash and doc_id: those that are decided, and those behind the first doc_id of their hash."""
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        one, two, docs = (b.column(i).to_numpy() for i in range(3))
        done = b.column(5).to_numpy(zero_copy_only=False)
        first = np.ones(len(one), bool)
        first[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        least = docs[np.maximum.accumulate(np.where(first, np.arange(len(one)), 0))]
        if last and last[:2] == (one[0], two[0]):
            upto = np.flatnonzero(first)[1] if first.sum() > 1 else len(one)
            least = least.copy()
            least[:upto] = last[2]
        last = (one[-1], two[-1], least[-1])
        keep = pa.array(done | (docs > least))
        yield pa.RecordBatch.from_arrays([b.column(i).filter(keep) for i in (2, 3, 4)], ["doc_id", "text_key", "pos"])


def duplicate_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, places) of the windows that also start in a document with a smaller doc_id."""
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    anchors = settled(shared_anchors(keyed, window), "repeat-anchors")
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(anchors).tobytes())
    rows = keyed.mapInArrow(_emit_windows(window, shared), WINDOWS)
    found = rows.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "doc_id").mapInArrow(_judge, "doc_id bigint, text_key bigint, pos int")
    return found.groupBy("doc_id", "text_key").agg(F.collect_list("pos").alias("places"))


def _strings(data: np.ndarray, flags: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The flagged bytes of each text."""
    ends = np.concatenate([[0], np.cumsum(np.add.reduceat(np.append(flags, False), bounds[:-1], dtype=np.int64) * (np.diff(bounds) > 0))])
    return pa.Array.from_buffers(pa.string(), len(bounds) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[flags])])


def _cut(window: int, made: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, data, bounds in text_slices(batches, 0):
            inside = WORD_BYTES[data]
            starts, ends = runs_of(inside, bounds)
            first = np.searchsorted(starts, bounds)
            n_words = np.diff(first)
            places = b.column(1)
            at = places.flatten().to_numpy().astype(np.int64) + np.repeat(first[:-1], pc.list_value_length(places).fill_null(0).to_numpy())
            edge = np.bincount(at, minlength=len(starts) + 1) - np.bincount(at + window, minlength=len(starts) + 1)
            gone = np.cumsum(edge[:-1]) > 0
            lo, hi = runs_of(gone, first)
            of = np.searchsorted(lo, first)
            spans = pa.StructArray.from_arrays([lo - np.repeat(first[:-1], np.diff(of)), hi - lo], ["start", "length"])
            rest = b.column(0).cast(pa.string())
            if len(lo):
                # a removed word takes the white space behind it along
                behind = np.append(starts, len(data))[hi]
                behind = np.minimum(behind, np.repeat(bounds[1:], np.diff(of)))
                left = np.ones(len(data), bool)
                for a, z, e in zip(starts[lo], ends[hi - 1], behind):
                    left[a:e] = False
                    inside[a:z] = False
                rest = pc.if_else(rest.is_valid(), _strings(data, left, bounds), pa.scalar(None, pa.string()))
            # one space behind each kept word that has another one behind it in its text
            stay = np.flatnonzero(~gone)
            text = np.repeat(np.arange(len(n_words)), n_words)[stay]
            gaps = ends[stay[:-1][text[1:] == text[:-1]]]
            data = data.copy()
            data[gaps], inside[gaps] = 0x20, True
            arrays = [
                pa.array(n_words, pa.int64()),
                pa.array(np.diff(np.concatenate([[0], np.cumsum(gone)])[first]), pa.int64()),
                pa.ListArray.from_arrays(pa.array(of.astype(np.int32)), spans),
                _strings(data, inside, bounds),
                rest,
            ]
            yield pa.RecordBatch.from_arrays([*b.columns[2:], *arrays], [*b.schema.names[2:], *made])

    return run


CUT = {
    "n_words": "bigint", "n_removed": "bigint", "spans": "array<struct<start bigint, length bigint>>", "kept": "string", "rest": "string",
}


def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: str = "") -> DataFrame:
    """All rows and columns with n_words, n_removed, the removed spans (in words), and what is left of the text.

    The new names start with ``prefix``. ``kept`` has the kept words with one space between, ``rest`` the text without the removed words. Columns of the
    input with one of these names are replaced.
    """
    made = {f"{prefix}{c}": kind for c, kind in CUT.items()}
    names = [c for c in docs.columns if c.lower() not in {m.lower() for m in made}]
    key, doc, same, places = (fresh(docs, c) for c in ("_text_key", "_span_doc", "_span_key", "_places"))
    spans = duplicate_windows(docs, window).select(F.col("doc_id").alias(doc), F.col("text_key").alias(same), F.col("places").alias(places))
    spans = settled(spans, "repeat-places")
    rows = docs.withColumn(key, F.xxhash64("text"))
    rows = rows.join(spans, (F.col("doc_id") == F.col(doc)) & (F.col(key) == F.col(same)), "left")
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema] + [f"`{c}` {kind}" for c, kind in made.items()])
    fed = rows.select(F.col("text").alias(fresh(rows, "_body")), F.col(places), *[F.col(c) for c in names])
    return fed.mapInArrow(_cut(window, list(made)), schema)
