"""Near-duplicate classes: consistent weighted samples of TF-IDF shingles, banded, verified by weighted Jaccard.

A text is the weighted set of its five-word shingles (of all its words, if it has fewer). A shingle weighs its count in
the text times a smooth inverse document frequency between 1 and 2. Improved consistent weighted sampling draws
``ROWS * BANDS`` samples of each set: two sets agree in a sample with the probability of their weighted Jaccard similarity.
Sets that agree in a whole band are candidates. Samples take the frequencies from a counting table of fixed size that
covers every document, whose slots are shared by more shingles the larger the corpus; every similarity and bound is
computed with exact frequencies, counted over all documents for the shingles of the candidates.

Only different texts are compared; equal ones share a node from the start. A band's members are verified against one
of them, its head; components of the verified links follow. In the next rounds the head is the member with most links,
and only members of other components are compared with it. Members that stay apart from their last head are strays.
Bands with strays are compared as a whole, in blocks of bounded size: a task multiplies two blocks' weighted sets as matrices
and returns only the links that join up their members. So every candidate pair is linked through verified links or compared
itself, and groups of near copies are never expanded into all pairs.

Components come from rounds of minimum labels with pointer jumping, each written to the shared folder. Skewed groups:
copies collapse by an aggregate that combines before its shuffle; joins on bands and labels are plain equi-joins, which
adaptive execution splits; tables written and counted before are broadcast if their rows are few.

Defined cases: a null text counts as empty; texts without words are near duplicates of equal texts only; a null doc_id
takes part with its text and is named by the class of that text, whose id is the smallest doc_id in it, or null if it
has none; repeated rows are each returned. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import SHINGLE, SLICE_BYTES, WordHashes, fresh, mix, runs_of, settled, small_side, word_hashes
from driftline.llm.substrings import bit_filter

SIMILARITY = 0.8
ROWS, BANDS = 5, 16
SLOTS = 1 << 20  # counters of the document frequencies
PIECE = 1 << 14
DRAWS = 1 << 13  # rows of random draws; shingles are dealt to them by hash
CHUNK = 1024
BLOCK = 1 << 20  # shingles counted at once
ROUNDS = 1  # heads tried per band before whole bands are compared
TILE_ROWS = 256  # texts and items of a block, on average at most
TILE_ITEMS = 1 << 20
# what no letter, digit or underscore is: bytes that part words, and characters that the bytes alone do not tell
_PARTS = bytes(b if chr(b).isalnum() or b == 0x5F or b > 0x7F else 0x20 for b in range(256))
_ODD = re.compile(r"[^\x00-\x7f\w]")
_INSIDE = np.array([b != 0x20 for b in _PARTS])
_STEPS = [np.uint64(pow(0x9E3779B97F4A7C15, j + 1, 1 << 64)) for j in range(SHINGLE)]


def plain(text: str) -> bytes:
    """A text in lower case, in which only the bytes of ``_PARTS`` part words."""
    text = text.lower()
    return (text if text.isascii() else _ODD.sub(" ", text)).encode("utf-8", "surrogatepass")


def words_of(text: str) -> list[bytes]:
    """Runs of letters, digits and underscores, in lower case."""
    return plain(text).translate(_PARTS).split()


def shingle_hashes(h: np.ndarray) -> np.ndarray:
    """Hashes of all shingles, from the hashes of the words; fewer words than a shingle has are one."""
    k = min(SHINGLE, max(1, len(h)))
    acc = np.full(max(0, len(h) - k + 1), k, np.uint64)
    for j in range(k):
        acc += h[j : j + len(acc)] * _STEPS[j]
    return mix(acc)


def shingles_of(text: str, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a text, ascending, and how often each occurs."""
    return np.unique(shingle_hashes(known.of(words_of(text))), return_counts=True)


def shingle_sets(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``shingles_of`` each text, null as an empty one; the words of about ``SLICE_BYTES`` of text are hashed at once."""
    held, size = [], 0
    for i, text in enumerate(texts):
        held.append(plain(text or ""))
        size += len(held[-1])
        if size < SLICE_BYTES and i + 1 < len(texts):
            continue
        data, bounds = np.frombuffer(b"".join(held), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in held])])
        starts, ends = runs_of(_INSIDE[data], bounds)
        words, first = word_hashes(data, starts, ends), np.searchsorted(starts, bounds).tolist()
        found = shingle_hashes(words)
        for lo, hi in zip(first, first[1:]):
            own = found[lo : hi - SHINGLE + 1] if hi - lo >= SHINGLE else shingle_hashes(words[lo:hi])
            yield np.unique(own, return_counts=True)
        held, size = [], 0


def idf_of(counts: np.ndarray, documents: int) -> np.ndarray:
    """Frequent shingles weigh less, at least 1 and less than 2."""
    n = max(1, documents)
    return (1 + np.log((1 + n) / (1 + np.minimum(counts, n))) / np.log(2 + n)).astype(np.float32)


class Frequencies:
    """Document frequencies by slot."""

    def __init__(self, counts: np.ndarray, documents: int):
        self.idf = idf_of(counts, documents)

    def of(self, shingles: np.ndarray) -> np.ndarray:
        return self.idf[(shingles >> np.uint64(40)) & np.uint64(SLOTS - 1)]


class Sampler:
    """Improved consistent weighted sampling with the random draws of each shingle in a table."""

    def __init__(self):
        u = (mix(np.arange(1, 5 * DRAWS * ROWS * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64)
        u = ((u + 0.5) / 2.0**53).reshape(5, DRAWS, ROWS * BANDS)
        r = -np.log(u[0] * u[1])  # Gamma(2, 1)
        c = -np.log(u[2] * u[3])
        self.r, self.per_r, self.shift = (x.astype(np.float32) for x in (r, 1 / r, u[4]))
        self.offset = (np.log(c) - r + r * u[4]).astype(np.float32)

    def bands(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """A key for each band; equal sets have equal keys."""
        best = np.full(ROWS * BANDS, np.inf, np.float32)
        sample = np.zeros(ROWS * BANDS, np.uint64)
        each = np.arange(ROWS * BANDS)
        logs = np.log(weights).astype(np.float32)
        for i in range(0, len(shingles), CHUNK):
            part = shingles[i : i + CHUNK]
            row = (part & np.uint64(DRAWS - 1)).astype(np.int64)
            # in place: floor(log weight / r + shift), then offset - r * level
            level = np.take(self.per_r, row, axis=0)
            level *= logs[i : i + CHUNK, None]
            level += np.take(self.shift, row, axis=0)
            np.floor(level, out=level)
            cost = np.take(self.r, row, axis=0)
            cost *= level
            np.subtract(np.take(self.offset, row, axis=0), cost, out=cost)
            at = cost.argmin(axis=0)
            least = cost[at, each]
            better = least < best
            best = np.where(better, least, best)
            found = mix(part[at] ^ mix(level[at, each].astype(np.int64).view(np.uint64)))
            sample = np.where(better, found, sample)
        keys = np.arange(BANDS, dtype=np.uint64)
        for j in range(ROWS):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + sample[j::ROWS])
        return keys.view(np.int64)


def node_of(text: Column) -> Column:
    """Equal texts are one node."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, documents = np.zeros(SLOTS, np.int64), 0
    for b in batches:
        for s, _ in shingle_sets(b.column(0).to_pylist()):
            np.add.at(counts, ((s >> np.uint64(40)) & np.uint64(SLOTS - 1)).astype(np.int64), 1)
            documents += 1
    part = TaskContext.get().partitionId()
    pieces = [(i, part, counts[i * PIECE : (i + 1) * PIECE].tobytes()) for i in range(SLOTS // PIECE)] if documents else []
    pieces.append((-1, part, np.array([documents], np.int64).tobytes()))
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*pieces), (pa.int32(), pa.int32(), pa.binary()))], ["piece", "part", "counts"])


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(c, np.int64) for c in rows["counts"]], axis=0, dtype=np.int64)
    return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "part": [rows["part"].iloc[0]], "counts": [total.tobytes()]})


def document_frequencies(docs: DataFrame) -> tuple[bytes, int]:
    """The counting table over all documents, added up in a tree, and how many there are. Its size is fixed."""
    schema = "piece int, part int, counts binary"
    counts = docs.select("text").mapInArrow(_count, schema)
    for level in (32, 1 << 30):
        counts = counts.withColumn("part", F.floor(F.col("part") / level).cast("int")).groupBy("piece", "part").applyInPandas(_add, schema)
    table, documents = np.zeros(SLOTS, np.int32), 0
    for r in counts.collect():
        got = np.frombuffer(r["counts"], np.int64)
        if r["piece"] < 0:
            documents = int(got[0])
        else:
            table[r["piece"] * PIECE : (r["piece"] + 1) * PIECE] = np.minimum(got, np.iinfo(np.int32).max)
    return table.tobytes(), documents


def _read(shared) -> Frequencies:
    table, documents = shared.value
    return Frequencies(np.frombuffer(table, np.int32), documents)


def signatures(docs: DataFrame, shared) -> DataFrame:
    """(doc_id, node, bands) of every row; texts without words have no bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq, sampler = _read(shared), Sampler()
        for b in batches:
            bands = []
            for s, n in shingle_sets(b.column(2).to_pylist()):
                bands.append(sampler.bands(s, n * freq.of(s)) if len(s) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "node", "bands"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", node_of(F.col("text")).alias("node"), "text").mapInArrow(run, f"doc_id {kind}, node binary, bands array<bigint>")


def _sums(shingles: np.ndarray, n: int) -> pa.RecordBatch:
    found, times = np.unique(shingles, return_counts=True) if n else (np.empty(0, np.uint64), np.empty(0, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times.astype(np.int64))], ["anchor", "n"])


def _occurrences(shared=None):
    """Shingles with the number of documents of a block they occur in; those without a bit in the filter are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else np.frombuffer(shared.value, np.uint8)
        held: list[np.ndarray] = []
        size = 0
        for b in batches:
            for s, _ in shingle_sets(b.column(0).to_pylist()):
                if bits is not None:
                    slot = (s & np.uint64(len(bits) * 8 - 1)).astype(np.int64)
                    s = s[(bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)]
                held.append(s)
                size += len(s)
                if size >= BLOCK:
                    yield _sums(np.concatenate(held), size)
                    held, size = [], 0
        if size:
            yield _sums(np.concatenate(held), size)

    return run


def exact_frequencies(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(shingle, df): in how many documents the shingles of the texts occur, if in more than one.

    A filter of bounded size keeps most other shingles out of the shuffle; a false bit only counts a shingle nobody asks for.
    """
    schema = "anchor bigint, n bigint"
    wanted = settled(texts.select("text").mapInArrow(_occurrences(), schema).select("anchor").distinct(), "near-wanted-shingles")
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted).tobytes())
    counts = docs.select("text").mapInArrow(_occurrences(shared), schema).groupBy(F.col("anchor").alias("shingle")).agg(F.sum("n").alias("df"))
    return settled(counts.where("df > 1"), "near-frequencies")


def with_frequencies(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``held`` to the texts: places of their shingles, in ascending order, and frequencies; those left out occur once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (s, _) in enumerate(shingle_sets(b.column(1).to_pylist())):
                nodes = b.column(0).take(pa.array(np.full(len(s), i)))
                yield pa.RecordBatch.from_arrays([nodes, pa.array(np.arange(len(s), dtype=np.int32)), pa.array(s.view(np.int64))], ["node", "place", "shingle"])

    places = texts.select("node", "text").mapInArrow(run, "node binary, place int, shingle bigint")
    held = places.join(small_side(counts), "shingle").groupBy("node").agg(F.collect_list(F.struct("place", "df")).alias("held"))
    return texts.join(held, "node", "left").select("node", "text", "held")


def weighted_set(text: str, held: pa.Scalar, documents: int, known: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of a text, their counts and exact inverse document frequencies."""
    s, n = shingles_of(text, known)
    df = np.ones(len(s), np.int64)
    if held.is_valid:
        df[held.values.field("place").to_numpy()] = held.values.field("df").to_numpy()
    return s, n, idf_of(df, documents)


def verified(pairs: DataFrame, texts: DataFrame, documents: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts reach the weighted Jaccard similarity, each text once per shuffle."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"), F.col("held").alias("held_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"), F.col("held").alias("held_b"))
    rows = pairs.select("a", "b").join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b", "held_a", "held_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        last, one = None, None
        for batch in batches:
            nodes, others, ones, twos, held_one, held_two = (batch.column(i) for i in range(6))
            keep = []
            for i, node in enumerate(nodes.to_pylist()):
                if node != last:
                    last, one = node, weighted_set(ones[i].as_py(), held_one[i], documents, known)
                two = weighted_set(twos[i].as_py(), held_two[i], documents, known)
                keep.append(similarity_of(one, two) >= similarity)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([nodes.filter(mask), others.filter(mask)], ["a", "b"])

    return rows.mapInArrow(run, "a binary, b binary")


def similarity_of(one: tuple, two: tuple) -> float:
    """Weighted Jaccard similarity of two sets of (shingles, counts, inverse document frequencies)."""
    (s, n, v), (t, m, w) = one, two
    both, i, j = np.intersect1d(s, t, assume_unique=True, return_indices=True)
    low = float((np.minimum(n[i], m[j]) * v[i]).sum(dtype=np.float64))
    total = float((n * v).sum(dtype=np.float64)) + float((m * w).sum(dtype=np.float64))
    return low / (total - low) if total > low else 1.0


def weighted_jaccard(one: tuple, two: tuple, freq: Frequencies) -> float:
    return similarity_of((*one, freq.of(one[0])), (*two, freq.of(two[0])))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of the linked nodes: the smallest node of each component, by labels and pointer jumping."""
    both = settled(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "near-both")
    labels = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "near-labels")
    while True:
        labels = small_side(labels)
        over = labels.select(F.col("node").alias("b"), "label")
        least = both.join(over, "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("next"))
        step = least.join(labels, "node").select("node", "label", F.least("label", "next").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = settled(step.join(jump, "next", "left").select("node", "label", F.least("next", "far").alias("next")), "near-labels")
        moved = step.where("next < label").limit(1).count()
        labels = step.select("node", F.col("next").alias("label"))
        if not moved:
            return labels


def weighed(texts: DataFrame, documents: int) -> DataFrame:
    """(node, items, weights): the weighted set of each text as a plain one, in which the k-th occurrence of a shingle is
    an item of its own. Overlaps of weighted sets are then sums over common items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in batches:
            items, weights = [], []
            for text, held in zip(b.column(1).to_pylist(), b.column(2)):
                s, n, idf = weighted_set(text, held, documents, known)
                turn = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                items.append(mix(np.repeat(s, n) + turn.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).tobytes())
                weights.append(np.repeat(idf, n).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(items, pa.binary()), pa.array(weights, pa.binary())], ["node", "items", "weights"])

    return texts.select("node", "text", "held").mapInArrow(run, "node binary, items binary, weights binary")


def overlaps(items: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    """Weight that each two sets have in common."""
    n = len(items)
    flat, row = np.concatenate(items), np.repeat(np.arange(n), [len(x) for x in items])
    found, first, place, times = np.unique(flat, return_index=True, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(times > 1)
    column = np.full(len(found), -1, np.int64)
    column[shared] = np.arange(len(shared))
    weight = np.concatenate(weights)[first[shared]].astype(np.float64)
    column = column[place]
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((n, n))
    for k in range(0, len(shared), CHUNK):
        lo, hi = np.searchsorted(column, [k, k + CHUNK])
        held = np.zeros((n, min(CHUNK, len(shared) - k)))
        held[row[lo:hi], column[lo:hi] - k] = 1
        total += (held * weight[k : k + CHUNK]) @ held.T
    return total


def tile_links(rows: list[tuple[bytes, int, np.ndarray, np.ndarray]], similarity: float) -> list[tuple[bytes, bytes]]:
    """Links that join up whatever reaches the similarity among (node, block, items, weights), one per member at most."""
    low = overlaps([r[2] for r in rows], [r[3] for r in rows])
    size = np.array([float(r[3].sum(dtype=np.float64)) for r in rows])
    near = low >= similarity * (size[:, None] + size[None, :] - low)
    block = np.array([r[1] for r in rows])
    if block.min() != block.max():  # each block meets itself in a tile of its own
        near &= block[:, None] != block[None, :]
    label = np.arange(len(rows))
    while True:
        least = np.where(near, label[None, :], len(rows)).min(axis=1)
        least = np.minimum(label, least)[np.minimum(label, least)]
        if (least == label).all():
            return [(rows[j][0], rows[i][0]) for i, j in enumerate(label) if i != j]
        label = least


def links_within(groups: DataFrame, texts: DataFrame, documents: int, similarity: float) -> DataFrame:
    """(a, b): links that join up all texts of a group (key, node) that reach the similarity, directly or not.

    Groups of equal members count once. A group is dealt to blocks of bounded size; two blocks at a time are compared in
    a task, by matrix products over the items they share, and only the links that join up their members leave it.
    """
    sets = settled(weighed(texts.join(small_side(groups.select("node").distinct()), "node"), documents), "near-weighted-sets")
    sized = groups.join(small_side(sets.select("node", (F.octet_length("items") / 8).alias("size"))), "node")
    h = F.xxhash64("node")
    plan = sized.groupBy("key").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / TILE_ROWS), F.ceil(F.sum("size") / TILE_ITEMS)).cast("int").alias("blocks"),
        F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("one"), F.bit_xor(F.xxhash64(h)).alias("two"),
    )
    plan = settled(plan.groupBy("n", "one", "two").agg(F.min("key").alias("key"), F.min("blocks").alias("blocks")).where("n > 1"), "near-tiles")
    block = F.pmod(h, F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = groups.join(small_side(plan.select("key", "blocks")), "key").select("key", "node", block.alias("block"), other.alias("other"))
    tiles = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node").join(sets, "node")
    by = ("key", "i", "j")
    tiles = tiles.select(*by, "block", "node", "items", "weights").repartition(*by).sortWithinPartitions(*by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []

        def done() -> pa.RecordBatch:
            links = tile_links(held, similarity) if len(held) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.binary()) for k in (0, 1)], ["a", "b"])

        for b in batches:
            names, own = list(zip(*(b.column(k).to_pylist() for k in range(3)))), [b.column(k).to_pylist() for k in range(3, 7)]
            for name, block, node, items, weights in zip(names, *own):
                if name != tile:
                    if held:
                        yield done()
                    tile, held = name, []
                held.append((node, block, np.frombuffer(items, np.uint64), np.frombuffer(weights, np.float32)))
        if held:
            yield done()

    return tiles.mapInArrow(run, "a binary, b binary")


def labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, node, class_id, class_node) of every row: ``class_node`` tells classes apart, also those without an id."""
    sc = docs.sparkSession.sparkContext
    table, documents = document_frequencies(docs)
    shared = sc.broadcast((table, documents))
    rows = settled(signatures(docs, shared), "near-rows")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands"))
    nodes = settled(nodes, "near-nodes")

    members = nodes.select("node", F.posexplode("bands").alias("band", "key")).select("node", F.xxhash64("band", "key").alias("key"))
    heads = members.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = settled(members.join(heads, "key"), "near-members")
    heads = small_side(settled(members.select("key", "head").distinct(), "near-heads"))
    members = members.select("key", "node")
    # one row for each text that is compared
    wanted = small_side(settled(members.select("node").distinct(), "near-wanted"))
    named = small_side(settled(nodes.select("node", "first").join(wanted, "node"), "near-named"))
    texts = docs.select("doc_id", node_of(F.col("text")).alias("node"), F.coalesce("text", F.lit("")).alias("text")).alias("d")
    texts = texts.join(named.alias("n"), (F.col("d.node") == F.col("n.node")) & F.col("d.doc_id").eqNullSafe(F.col("n.first")), "left_semi")
    texts = settled(texts.dropDuplicates(["node"]).select("node", "text"), "near-texts")
    texts = settled(with_frequencies(texts, exact_frequencies(docs, texts)), "near-weighed")

    none = heads.sparkSession.createDataFrame([], "node binary, label binary")
    links, labels = None, none
    for k in range(rounds + 1):
        # members apart from the head of one of their bands
        placed = labelled(members, labels).join(heads, "key")
        placed = placed.join(labels.select(F.col("node").alias("head"), F.col("label").alias("head_label")), "head", "left")
        strays = settled(placed.where(F.col("label") != F.coalesce("head_label", "head")).select("key", "node", "head"), f"near-strays-{k}")
        if k == rounds or not strays.limit(1).count():
            break
        pairs = small_side(settled(strays.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), f"near-pairs-{k}"))
        found = settled(verified(pairs, texts, documents, similarity), f"near-links-{k}")
        links = found if links is None else links.union(found)
        labels = small_side(components(links))
        degrees = links.select("a").union(links.select("b")).groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
        degrees = small_side(settled(degrees, f"near-degrees-{k}"))
        ranked = members.join(small_side(strays).select("key"), "key", "left_semi").join(degrees, "node", "left")
        heads = ranked.groupBy("key").agg(F.max(F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "node")).alias("best"))
        heads = small_side(settled(heads.select("key", F.col("best.node").alias("head")), f"near-heads-{k}"))

    if strays.limit(1).count():
        groups = settled(members.join(small_side(settled(strays.select("key").distinct(), "near-open")), "key"), "near-groups")
        more = settled(links_within(groups, texts, documents, similarity), "near-more")
        if more.limit(1).count():
            labels = small_side(components(more if links is None else links.union(more)))

    classes = nodes.select("node", "first").join(labels, "node", "left").select("node", "first", F.coalesce("label", "node").alias("class_node"))
    classes = settled(classes, "near-classes")
    ids = classes.groupBy("class_node").agg(F.min("first").alias("class_id"))
    classes = classes.join(ids, "class_node").select("node", "class_node", "class_id")
    return rows.select("doc_id", "node").join(classes, "node").select("doc_id", "node", "class_id", "class_node")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with its own columns: the one with the smallest doc_id (without any: some one)."""
    found = settled(near_duplicates(docs, similarity), "near-found")
    best = found.groupBy("class_node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node")).alias("best"))
    chosen = settled(best.select("best.doc_id", "best.node"), "near-chosen")
    twice = found.groupBy("doc_id", "node").count().where("count > 1").select("doc_id", "node")
    twice = settled(chosen.alias("c").join(twice.alias("t"), F.col("c.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("c.node") == F.col("t.node")), "left_semi"), "near-twice")
    node = fresh(docs, "_node")
    rows = docs.withColumn(node, node_of(F.col("text")))

    def among(frame: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        k = keys.select(F.col("doc_id").alias("_k_doc"), F.col("node").alias("_k_node"))
        return frame.join(k, frame["doc_id"].eqNullSafe(k["_k_doc"]) & (frame[node] == k["_k_node"]), how)

    kept = among(rows, chosen, "left_semi")
    if not twice.limit(1).count():
        return kept.drop(node)
    single = among(kept, small_side(twice), "left_anti")
    again = among(kept, small_side(twice), "left_semi").dropDuplicates(["doc_id", node])
    return single.unionByName(again).drop(node)
