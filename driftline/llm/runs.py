"""Periodic runs of words: string synchronising sets propose periods, direct comparison settles the runs.

A run is a maximal stretch of consecutive words whose smallest period q fits into it at least ``EXPONENT`` = 4 times.

Scales t = 1, 2, 4, ... look for the periods t <= q < 2t. Every position is named by a hash of its next t words. Positions
whose t words repeat with a period of at most t / 4 are highly periodic; they lie in runs that earlier scales have
found, which supply these small periods, and are left out here. Of the rest a position is selected if the least name
among it and its next t positions stands at either end. That choice depends on the next 2t words only (the context), so
equal contexts are selected alike, and any 2t positions that are not all highly periodic select one of their first t.
A run of period q in the range has 4q >= 3t + q words, hence a selected position whose whole context recurs q words on;
by the periodicity lemma no equal context lies in between. So neighbouring positions of equal context, t to 2t - 1 apart,
propose the periods of all runs, and no others than smallest ones. Each proposal is extended both ways word by word, once
per run. Names are 64-bit hashes: words decide every extension, and two of a text's n names collide with odds of n^2 / 2^64.

A scale keeps about 2n / t positions, so a text costs O(n log n) time and O(n) memory in the task that holds its row.
Nothing is shuffled.

Defined cases: a null or empty text, or one of white space only, has no words and no runs, and collapses to an empty
text; texts of fewer than 6 words have no runs; repeated rows are each returned; the other columns are kept, but for
those whose names the results take.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import fresh, mix, sliding_min

EXPONENT = 4
LEAST_WORDS = 6
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_BLOCK = 64


def words_of(text: str) -> list[bytes]:
    """Words between blanks and the control characters 9 to 13."""
    return text.encode("utf-8", "surrogatepass").split()


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def equal_ahead(w: np.ndarray, a: int, b: int) -> int:
    """How many words agree from ``a`` and from ``b`` > ``a`` on."""
    done, size = 0, _BLOCK
    while b + done < len(w):
        differ = w[a + done : a + done + size][: len(w) - b - done] != w[b + done : b + done + size]
        if differ.any():
            return done + int(differ.argmax())
        done += len(differ)
        size *= 2
    return done


def equal_behind(w: np.ndarray, a: int, b: int) -> int:
    """How many words agree before ``a`` and before ``b`` > ``a``."""
    done, size = 0, _BLOCK
    while done < a:
        step = min(size, a - done)
        differ = w[a - done - step : a - done] != w[b - done - step : b - done]
        if differ.any():
            return done + int(differ[::-1].argmax())
        done += step
        size *= 2
    return done


def synchronising(names: np.ndarray, t: int, regions: list[tuple[int, int, int]]) -> np.ndarray:
    """Selected positions of a scale, ascending; ``regions`` are the (start, length, period) of runs found before."""
    periodic = [(start, start + length - t + 1) for start, length, period in regions if 4 * period <= t <= length]
    if periodic:
        edges = np.zeros(len(names) + 1, np.int64)
        for first, past in periodic:
            edges[first] += 1
            edges[past] -= 1
        names = np.where(np.cumsum(edges[:-1]) > 0, _TOP, names)
    least = sliding_min(names, t + 1)
    here = (least == names[: len(least)]) | (least == names[t:])
    return np.flatnonzero(here & (least != _TOP))


def extended(w: np.ndarray, at: np.ndarray, period: int, context: int) -> Iterator[tuple[int, int, int]]:
    """The maximal stretches of a period around the proposed positions, which ascend."""
    k = 0
    while k < len(at):
        i = int(at[k])
        ahead = equal_ahead(w, i, i + period)
        if ahead < context:  # names collided
            k += 1
            continue
        start = i - equal_behind(w, i, i + period)
        yield start, i + ahead + period - start, period
        k = int(np.searchsorted(at, i + ahead))


def runs_of(w: np.ndarray) -> list[tuple[int, int, int]]:
    """All (start, length, period) of runs that hold their smallest period four times, by start and period."""
    found: list[tuple[int, int, int]] = []
    names, t = mix(w.astype(np.uint64) + np.uint64(1)), 1
    while EXPONENT * t <= len(w):
        contexts = mix(names[:-t] * _STEP + names[t:])
        at = synchronising(names, t, found)
        own = contexts[at]
        order = np.argsort(own, kind="stable")
        at, own = at[order], own[order]
        apart = np.diff(at)
        paired = np.flatnonzero((own[1:] == own[:-1]) & (apart >= t) & (apart < 2 * t))
        if len(paired):
            first, period = at[paired], apart[paired]
            order = np.lexsort((first, period))
            first, period = first[order], period[order]
            cuts = np.flatnonzero(np.diff(period)) + 1
            for part, q in zip(np.split(first, cuts), period[np.r_[0, cuts]].tolist()):
                found += [run for run in extended(w, part, q, 2 * t) if run[1] >= EXPONENT * q]
        names, t = contexts, 2 * t
    return sorted((r for r in found if r[1] >= LEAST_WORDS), key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run keeps its first period only."""
    edges = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return np.cumsum(edges[:-1]) == 0


def find_runs(docs: DataFrame, text: str = "text", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """Add the runs of each text, by start and period, and the text that is left when each run keeps its first period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, rows, rest = [0], [], []
            for body in b.column(0).to_pylist():
                words = words_of(body or "")
                got = runs_of(numbered(words))
                sizes.append(sizes[-1] + len(got))
                rows += got
                if got:
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), got))]
                rest.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            table = np.array(rows, np.int64).reshape(-1, 3)
            made = pa.StructArray.from_arrays([pa.array(table[:, j]) for j in range(3)], ["start", "length", "period"])
            listed = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), made)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], listed, pa.array(rest, pa.string())], [*b.schema.names[1:], runs, collapsed])

    kept = [c for c in docs.columns if c.lower() not in (runs.lower(), collapsed.lower())]
    body = fresh(docs, "_body")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return docs.select(F.col(text).alias(body), *kept).mapInArrow(run, f"{schema}, `{runs}` {RUNS}, `{collapsed}` string")


def repeat_tail(ident: Column, text: Column) -> Column:
    """The text with its tail made periodic if the checksum of the id asks for it; other texts stay as they are."""
    h = F.crc32(ident.cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(place, lambda i: F.get(w, i.cast("int"))), " ")

    # a list of one, so that the words are taken once
    whole = F.element_at(F.transform(F.array(words), repeated), 1)
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), whole).otherwise(text)
