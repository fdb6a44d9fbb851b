"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids are linked across the corpus.

Tokenizer A is a byte-level BPE, B a SentencePiece model with byte fallback. Both cut a text into tokens over the bytes of
a blank and the text. Offsets where tokens of both end cut the tokens into groups; two tokens are linked if their bytes
overlap; the count of an id pair says how many documents hold it linked.

Identity map: an array gives each id of A the id of B with the same bytes. Linked pairs of that kind, which are the exact
one-to-one groups, are counted in one vector as long as A's vocabulary per task; the vectors are added up in a tree. Only
pairs from irregular groups go through the pair shuffle, combined before it. Best counts per id of A are a vector too.
Both vectors have the fixed size of the vocabulary, so tasks get them as a broadcast; the table of irregular pairs is
broadcast only if its counted rows are few, otherwise joined by shuffle.

Each text is encoded once. A chunk starts at a blank after anything but white space. Neither tokenizer has tokens across
such a place, so all counts of a text add up over its chunks; each task encodes and aligns a distinct chunk once, keeps
what it found in arrays, and starts them anew at ``TABLE`` links. A's ids come from the vocabulary of its file as merge
ranks, checked against its merges; chunks with characters beyond Latin ones go to the tokenizers library itself. Chunks are
taken ``STEP`` at a time, so that the arrays stay small whatever the length of a text.

Defined cases: texts that are null or empty, or whose tokens of A or of B do not spell the blank and the text (a text with
U+2581, which B takes for a blank), have no tokens: zeros and no groups. Repeated rows count as documents of their own.
A null id passes through. Special tokens inside texts are plain text. Other columns are kept, but for those whose names the
results take.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import fresh, settled, small_side
from driftline.llm.encoding import MARK, check_model, load_model

TABLE = 2_000_000
STEP = 100_000
PIECE = 1 << 14
# Fixed value: the pattern by which byte-level BPE cuts words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_START = re.compile(r"(?<=\S)(?= )")
# letters whose classes do not depend on the version of the character tables
_PLAIN = re.compile(r"[\n\x20-\x7e\xa1-ɏ]*")


def byte_letters() -> dict[str, int]:
    """The printable characters that byte-level BPE writes for bytes: visible Latin-1 ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass
class Vocabularies:
    """Bytes of all ids, their lengths, and A's ids mapped to B's of the same bytes (-1: none)."""

    a_bytes: list[bytes]
    b_bytes: list[bytes]

    def __post_init__(self):
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        of = {x: i for i, x in reversed(list(enumerate(self.b_bytes)))}
        self.same = np.array([of.get(x, -1) if x else -1 for x in self.a_bytes], np.int64)


class Tokenizers:
    """Both tokenizers, made from the contents of their files."""

    def __init__(self, a_file: bytes, b_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the unit of parallel work
        self.whole = tokenizers.Tokenizer.from_str(a_file.decode())
        self.whole.encode_special_tokens = True
        self.piece = load_model(b_file)
        made = json.loads(a_file)
        letters = byte_letters()
        special = {t["id"]: t["content"].encode() for t in made["added_tokens"]}
        a_bytes = [b""] * (max([*made["model"]["vocab"].values(), *special], default=-1) + 1)
        for token, i in made["model"]["vocab"].items():
            a_bytes[i] = bytes(letters[c] for c in token) if i not in special else b""
        for i, content in special.items():
            a_bytes[i] = content
        ranks = {x: i for i, x in enumerate(a_bytes) if x and i not in special}
        self.quick = tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={}) if self.by_rank(made, a_bytes, letters) else None
        p = self.piece
        b_bytes = [bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace(MARK, " ").encode() for i in range(p.vocab_size())]
        self.vocabularies = Vocabularies(a_bytes, b_bytes)

    @staticmethod
    def by_rank(made: dict, a_bytes: list[bytes], letters: dict[str, int]) -> bool:
        """Whether merges come in the order of the ids they make, under the usual pattern."""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in made["model"]["merges"]]
        merged = [bytes(letters[c] for c in a + b) for a, b in pairs]
        cut = made["pre_tokenizer"] or {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and made["normalizer"] is None
        return plain and not made["model"].get("ignore_merges") and merged == a_bytes[256 : 256 + len(merged)]

    def encode_a(self, chunks: list[str]) -> list[list[int]]:
        out = [self.quick.encode_ordinary(c) if self.quick and _PLAIN.fullmatch(c) else None for c in chunks]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, found in zip(rest, self.whole.encode_batch_fast([chunks[i] for i in rest], add_special_tokens=False)):
            out[i] = found.ids
        return out

    def encode_b(self, chunks: list[str]) -> list[list[int]]:
        """Of chunks that start with the blank which the library puts in front itself."""
        out = self.piece.encode([c[1:] for c in chunks], num_threads=1)
        return [ids if len(c) > 1 else [self.piece.piece_to_id(MARK)] for c, ids in zip(chunks, out)]


def flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((x for ids in lists for x in ids), np.int64, int(sizes.sum())), sizes


def starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each size in turn."""
    return np.arange(int(sizes.sum())) - np.repeat(starts(sizes) - first, sizes)


@dataclass
class Aligned:
    """What alignment finds for each of some chunks; links are packed as id of A times B's size plus id of B."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    links: np.ndarray
    groups: list[str]


def align(a: list[list[int]], b: list[list[int]], v: Vocabularies) -> Aligned:
    """Align the tokens of chunks whose tokens spell the same bytes, all chunks at once."""
    (a_ids, n_a), (b_ids, n_b) = flat(a), flat(b)
    a_end, b_end = np.cumsum(v.a_size[a_ids]), np.cumsum(v.b_size[b_ids])
    a_start, b_start = a_end - v.a_size[a_ids], b_end - v.b_size[b_ids]
    # B's tokens that overlap each of A's: the first to end after its start up to the last to start before its end
    first = np.searchsorted(b_end, a_start, "right")
    many = np.searchsorted(b_start, a_end, "left") - first
    links = np.repeat(a_ids, many) * len(v.b_bytes) + b_ids[spread(first, many)]
    a_chunk, b_chunk = np.repeat(np.arange(len(a)), n_a), np.repeat(np.arange(len(b)), n_b)
    n_links = np.bincount(a_chunk, many, len(a)).astype(np.int64)
    # a group ends where tokens of both do
    a_last, b_last = np.isin(a_end, b_end), np.isin(b_end, a_end)
    n_groups = np.bincount(a_chunk[a_last], minlength=len(a))
    a_text = join_groups(a_ids, a_last)
    b_text = join_groups(b_ids, b_last)
    pairs = [f"{x}|{y}" for x, y in zip(a_text, b_text)]
    bounds = np.r_[0, np.cumsum(n_groups)].tolist()
    return Aligned(n_a, n_b, n_groups, n_links, links, [";".join(pairs[i:j]) for i, j in zip(bounds, bounds[1:])])


def join_groups(ids: np.ndarray, last: np.ndarray) -> list[str]:
    names = list(map(str, ids.tolist()))
    cuts = (np.flatnonzero(last) + 1).tolist()
    return [names[i] if j == i + 1 else ",".join(names[i:j]) for i, j in zip([0, *cuts], cuts)]


class Chunks:
    """Aligned distinct chunks, found again by their text; emptied once they hold ``TABLE`` links."""

    def __init__(self, tools: Tokenizers):
        self.tools, self.v = tools, tools.vocabularies
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.zeros((4, 0), np.int64)  # of A, of B, groups, links
        self.good = np.zeros(0, bool)
        self.links = np.zeros(0, np.int64)
        self.first = np.zeros(0, np.int64)

    def numbers(self, chunks: list[str]) -> np.ndarray:
        if len(self.links) > TABLE:
            self.clear()
        new = list(dict.fromkeys(c for c in chunks if c not in self.known))
        if new:
            self.add(new)
        return np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))

    def add(self, new: list[str]) -> None:
        a, b = self.tools.encode_a(new), self.tools.encode_b(new)
        good = np.ones(len(new), bool)
        for side, ids in ((self.v.a_bytes, a), (self.v.b_bytes, b)):
            if b"".join([side[i] for x in ids for i in x]) != "".join(new).encode():
                good &= [b"".join([side[i] for i in x]) == c.encode() for x, c in zip(ids, new)]
        if not good.all():
            a, b = ([x if g else [] for x, g in zip(ids, good)] for ids in (a, b))
        got = align(a, b, self.v)
        self.known.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
        self.groups += got.groups
        self.first = np.r_[self.first, len(self.links) + starts(got.n_links)]
        self.links = np.r_[self.links, got.links]
        self.counts = np.c_[self.counts, [got.n_a, got.n_b, got.n_groups, got.n_links]]
        self.good = np.r_[self.good, good]


class Measured:
    """One text: its counts, its distinct links with their occurrences, and its groups."""

    def __init__(self, keep: bool):
        self.counts = np.zeros(4, np.int64)
        self.links, self.times = np.empty(0, np.int64), np.empty(0, np.int64)
        self.sha, self.kept, self.empty = hashlib.sha256(), [] if keep else None, True

    def add(self, chunks: Chunks, at: np.ndarray, own: tuple[np.ndarray, np.ndarray]) -> None:
        self.counts += chunks.counts[:, at].sum(axis=1)
        links, times = np.r_[self.links, own[0]], np.r_[self.times, own[1]]
        if len(self.links):
            links, place = np.unique(links, return_inverse=True)
            times = np.bincount(place, times).astype(np.int64)
        self.links, self.times = links, times
        text = ";".join(map(chunks.groups.__getitem__, at.tolist()))
        self.sha.update((text if self.empty else ";" + text).encode())
        self.empty = False
        if self.kept is not None:
            self.kept.append(text)


def measure(texts: list[str | None], chunks: Chunks, keep: bool = False) -> list[Measured | None]:
    """Align texts; None for those without tokens."""
    out: list[Measured | None] = [Measured(keep) if t else None for t in texts]
    parts = [_START.split(" " + t) if t else [] for t in texts]
    todo = [(i, p[j : j + STEP]) for i, p in enumerate(parts) for j in range(0, len(p), STEP)]
    bad: list[int] = []
    while todo:
        size, some = 0, []
        while todo and (not some or size + len(todo[0][1]) <= STEP):
            some.append(todo.pop(0))
            size += len(some[-1][1])
        at = chunks.numbers([c for _, p in some for c in p])
        sizes = np.array([len(p) for _, p in some])
        # distinct links of each text, all texts at once
        many = chunks.counts[3, at]
        links = chunks.links[spread(chunks.first[at], many)]
        span = len(chunks.v.a_bytes) * len(chunks.v.b_bytes)
        row = np.repeat(np.repeat(np.arange(len(some)), sizes), many)
        keys, times = np.unique(row * span + links, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(len(some) + 1) * span)
        for k, (i, _) in enumerate(some):
            own = at[int(sizes[:k].sum()) : int(sizes[: k + 1].sum())]
            if not chunks.good[own].all():
                bad.append(i)
            elif out[i] is not None:
                out[i].add(chunks, own, (keys[cuts[k] : cuts[k + 1]] - k * span, times[cuts[k] : cuts[k + 1]]))
    for i in dict.fromkeys(bad):  # some chunk does not spell its bytes; whether the whole text does is what counts
        at = chunks.numbers([" " + texts[i]])
        out[i] = None
        if chunks.good[at].all():
            out[i] = Measured(keep)
            first = int(chunks.first[at[0]])
            out[i].add(chunks, at, np.unique(chunks.links[first : first + int(chunks.counts[3, at[0]])], return_counts=True))
    return out


COUNTS = ("n_a", "n_b", "n_groups", "n_links")
FOUND = [*((n, pa.int64()) for n in COUNTS), ("groups_sha256", pa.string()), ("groups", pa.string()), *((n, pa.list_(pa.int64())) for n in ("same", "same_n", "other", "other_n"))]
FOUND_SQL = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, groups string, same array<bigint>, same_n array<bigint>, other array<bigint>, other_n array<bigint>"


def as_columns(found: list[Measured | None], v: Vocabularies, keep: bool) -> list[pa.Array]:
    zero = np.empty(0, np.int64)
    lists: list[list[np.ndarray]] = [[], [], [], []]
    for m in found:
        links, times = (m.links, m.times) if m else (zero, zero)
        ids = links // len(v.b_bytes)
        same = v.same[ids] == links % len(v.b_bytes)
        for store, values in zip(lists, (ids[same], times[same], links[~same], times[~same])):
            store.append(values)
    counts = np.array([m.counts if m else np.zeros(4, np.int64) for m in found], np.int64).reshape(-1, 4)
    shas = [m.sha.hexdigest() if m else "" for m in found]
    texts = [(";".join(m.kept) if m else "") if keep else None for m in found]

    def listed(values: list[np.ndarray]) -> pa.Array:
        offsets = np.r_[0, np.cumsum([len(x) for x in values])].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([zero, *values])))

    return [*(pa.array(counts[:, j]) for j in range(4)), pa.array(shas, pa.string()), pa.array(texts, pa.string()), *map(listed, lists)]


def align_tokens(docs: DataFrame, a_file: bytes, b_file: bytes, text: str = "text", groups: bool = False) -> DataFrame:
    """Add to each row its token, group and link counts, the digest of its groups, the groups themselves if wanted, and
    its distinct links with their occurrences: ``same`` by id of A alone, ``other`` as id of A times B's size plus id of B."""
    check_model(b_file)
    shared = docs.sparkSession.sparkContext.broadcast((a_file, b_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = Chunks(Tokenizers(*shared.value))
        for b in batches:
            found = measure(b.column(0).to_pylist(), chunks, groups)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *as_columns(found, chunks.v, groups)], [*b.schema.names[1:], *(n for n, _ in FOUND)])

    names = {n for n, _ in FOUND}
    kept = [c for c in docs.columns if c.lower() not in names]
    body = fresh(docs, "_body")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(F.col(text).alias(body), *kept).mapInArrow(run, f"{schema}, {FOUND_SQL}" if schema else FOUND_SQL)


def _count_same(size: int):
    """One vector per task: how many rows hold each id linked to its twin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for b in batches:
            counts += np.bincount(b.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        part = TaskContext.get().partitionId()
        rows = [(i, part, counts[i * PIECE : (i + 1) * PIECE].tobytes()) for i in range(-(-size // PIECE))]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary()))], ["piece", "part", "counts"])

    return run


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(c, np.int64) for c in rows["counts"]], axis=0, dtype=np.int64)
    return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "part": [rows["part"].iloc[0]], "counts": [total.tobytes()]})


def same_counts(found: DataFrame, size: int) -> np.ndarray:
    """Documents by id of A that hold it linked to the id of B with the same bytes; as long as A's vocabulary."""
    schema = "piece int, part int, counts binary"
    vectors = found.select("same").mapInArrow(_count_same(size), schema)
    for level in (32, 1 << 30):
        vectors = vectors.withColumn("part", F.floor(F.col("part") / level).cast("int")).groupBy("piece", "part").applyInPandas(_add, schema)
    pieces = {r["piece"]: np.frombuffer(r["counts"], np.int64) for r in vectors.collect()}
    return np.concatenate([pieces.get(i, np.zeros(min(PIECE, size - i * PIECE), np.int64)) for i in range(-(-size // PIECE))])


def link_counts(found: DataFrame, v: Vocabularies) -> tuple[np.ndarray, DataFrame, np.ndarray]:
    """Documents per pair: the vector of identical pairs, the written table (pair, df) of the others, and the best of
    each id of A, as a vector too."""
    same = same_counts(found, len(v.a_bytes))
    other = settled(found.select(F.explode("other").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("df")), "align-pairs")
    best = same.copy()
    most = other.groupBy((F.col("pair") / len(v.b_bytes)).cast("bigint").alias("a")).agg(F.max("df").alias("df"))
    for r in most.collect():  # one row per id of A at most
        best[r["a"]] = max(best[r["a"]], r["df"])
    return same, other, best


def score_links(found: DataFrame, v: Vocabularies) -> DataFrame:
    """Add ``n_best``, links whose pair has the highest count of its id of A, and ``count_sum``, the counts over all links."""
    row = fresh(found, "_row")
    found = settled(found.withColumn(row, F.monotonically_increasing_id()), "align-rows")
    same, other, best = link_counts(found, v)
    shared = found.sparkSession.sparkContext.broadcast((same, best))
    size = len(v.b_bytes)

    def add_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = shared.value[1]
        for b in batches:
            pair, df = b.column(0).to_numpy(), b.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(df == top[pair // size])], ["pair", "df", "top"])

    counted = settled(other.mapInArrow(add_best, "pair bigint, df bigint, top boolean"), "align-counted")
    links = found.select(row, F.explode(F.arrays_zip("other", "other_n")).alias("l")).select(row, F.col("l.other").alias("pair"), F.col("l.other_n").alias("n"))
    sums = links.join(small_side(counted), "pair").groupBy(row).agg(
        F.sum(F.col("n") * F.col("df")).alias("_sum"), F.sum(F.when(F.col("top"), F.col("n")).otherwise(0)).alias("_best")
    )
    kept = [c for c in found.columns if c not in ("same", "same_n", "other", "other_n")]

    def add_same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, top = shared.value
        for b in batches:
            ids, times = (b.column(j).flatten().to_numpy(zero_copy_only=False) for j in (0, 1))
            at = np.repeat(np.arange(b.num_rows), np.diff(b.column(0).offsets.to_numpy()))
            sums = [np.bincount(at, times * x, b.num_rows).astype(np.int64) for x in (counts[ids], counts[ids] == top[ids])]
            yield pa.RecordBatch.from_arrays([*b.columns[2:], *map(pa.array, sums)], [*b.schema.names[2:], "_same_sum", "_same_best"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.select(*kept).schema)
    rows = found.select("same", "same_n", *kept).mapInArrow(add_same, f"{schema}, _same_sum bigint, _same_best bigint")
    out = rows.join(sums, row, "left")
    total = {n: (F.col(f"_same_{s}") + F.coalesce(F.col(f"_{s}"), F.lit(0))).cast("bigint").alias(n) for n, s in (("n_best", "best"), ("count_sum", "sum"))}
    return out.select(*[c for c in kept if c != row and c not in total], *total.values())
