"""Benchmark decontamination by winnowing, in DataFrame functions only.

Both sides keep the smallest k-gram hash of every window of w consecutive k-grams. With k + w - 1 equal to the words of
a benchmark window, any shared window gives a shared fingerprint, so the join of fingerprints finds every document
that can be hit. Hits are then extended: in those documents each run of as many words is compared with the benchmark's
runs, by 128-bit hash. Items shorter than ``window`` words are one window of their own length; each length that occurs
is winnowed by the same rule.

Fingerprints of documents meet those of the benchmark in a join on the hash, which Spark broadcasts only if the counted
benchmark rows are few. What follows reads the documents with a shared fingerprint only, keyed by (doc_id, hash of the
text); a passage that a third of all documents quote adds rows to each of these documents, never to one key.

Defined cases: a null text has no words; an item without words gives no window; items without an item_id mark words as
hit but are neither counted nor listed; a repeated item_id counts once; equal rows give equal results, rows that share
a doc_id but not a text are judged by their own text; a null doc_id is judged like any other. Other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import settled, small_side

WINDOW = 13
GRAM = 5
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # after lower-casing A-Z
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARE = 20  # contaminated: one word in so many is hit


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), SEPARATORS), lambda w: w != "")


def grams_of(hashes: Column, k: int) -> Column:
    """Hashes of all runs of k words, from an array of word hashes; empty for shorter texts."""
    at = F.sequence(F.lit(0), F.size(hashes) - k)
    runs = F.transform(at, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))
    return F.when(F.size(hashes) >= k, runs).otherwise(F.array().cast("array<bigint>"))


def winnow(grams: Column, w: int) -> Column:
    """The distinct minima of every w consecutive hashes; of fewer, none."""
    if w == 1:
        return F.array_distinct(grams)
    at = F.sequence(F.lit(0), F.size(grams) - w)
    least = F.transform(at, lambda i: F.least(*[F.get(grams, i + j) for j in range(w)]))
    return F.when(F.size(grams) >= w, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>"))


def with_fingerprints(rows: DataFrame, length: int, hashes: str = "hashes") -> DataFrame:
    """Add the fingerprints ``prints_<length>`` that any shared run of ``length`` words must share."""
    k = min(GRAM, length)
    grams = f"_grams_{length}"
    return rows.withColumn(grams, grams_of(F.col(hashes), k)).withColumn(f"prints_{length}", winnow(F.col(grams), length - k + 1)).drop(grams)


def windows_of(rows: DataFrame, length: int, hashes: str = "hashes", *, keep: tuple[str, ...]) -> DataFrame:
    """A row for each run of ``length`` words: its first place and two hashes of it."""
    at = F.sequence(F.lit(0), F.size(hashes) - length)

    def run(i: Column) -> Column:
        parts = [F.get(F.col(hashes), i + j) for j in range(length)]
        return F.struct(i.alias("pos"), F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(length), *reversed(parts)).alias("h2"))

    return (
        rows.where(F.size(hashes) >= length)
        .select(*keep, F.explode(F.transform(at, run)).alias("run"))
        .select(*keep, F.lit(length).alias("length"), "run.pos", "run.h1", "run.h2")
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated) and ``text_key`` of every row; items as a sorted array of strings."""
    hashed = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), hashed.alias("hashes"))
    items = items.withColumn("length", F.least(F.size("hashes"), F.lit(window))).where("length > 0")
    items = settled(items, "bench-items")
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())  # at most ``window`` numbers

    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), hashed.alias("hashes"))
    prints = keyed.withColumn("n_words", F.size("hashes"))
    for n in lengths:
        prints = with_fingerprints(prints, n)
    prints = settled(prints.drop("hashes"), "bench-prints")
    clean = prints.select("doc_id", "text_key", F.col("n_words").cast("bigint").alias("n_words"))
    if not lengths:
        return clean.select("*", F.lit(0).cast("bigint").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.lit(False).alias("contaminated"))

    def exploded(rows: DataFrame, n: int, *keep: str) -> DataFrame:
        return rows.select(*keep, F.lit(n).alias("length"), F.explode(f"prints_{n}").alias("print"))

    known = [exploded(with_fingerprints(items.where(F.col("length") == n), n), n).distinct() for n in lengths]
    known = small_side(settled(_union(known), "bench-known"))
    met = _union([exploded(prints, n, "doc_id", "text_key") for n in lengths]).join(known, ["length", "print"], "left_semi")
    met = small_side(settled(met.select("doc_id", "text_key").distinct(), "bench-met"))

    runs = [windows_of(items.where(F.col("length") == n), n, keep=("item",)).select("item", "length", "h1", "h2").distinct() for n in lengths]
    runs = small_side(settled(_union(runs), "bench-runs"))
    suspects = keyed.alias("d").join(
        met.alias("m"), F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.text_key") == F.col("m.text_key")), "left_semi"
    ).dropDuplicates(["doc_id", "text_key"])
    suspects = settled(suspects, "bench-suspects")
    spots = _union([windows_of(suspects, n, keep=("doc_id", "text_key")) for n in lengths])
    hits = settled(spots.join(runs, ["length", "h1", "h2"]).select("doc_id", "text_key", "pos", "length", "item"), "bench-hits")

    by = ["doc_id", "text_key"]
    covered = hits.select(*by, "pos", "length").distinct().select(*by, F.explode(F.expr("sequence(pos, pos + length - 1)")).alias("word"))
    n_hit = covered.distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n_hit"))
    named = hits.select(*by, "item").distinct().groupBy(*by).agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = n_hit.join(named, (n_hit.doc_id.eqNullSafe(named.doc_id)) & (n_hit.text_key == named.text_key)).select(n_hit.doc_id, n_hit.text_key, "n_hit", "items")
    found = small_side(settled(found, "bench-found"))
    out = clean.join(found, clean.doc_id.eqNullSafe(found.doc_id) & (clean.text_key == found.text_key), "left")
    n = F.coalesce(found.n_hit, F.lit(0))
    return out.select(
        clean.doc_id, clean.text_key, "n_words", n.cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n > 0) & (SHARE * n >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with their own columns, that the benchmark does not contaminate."""
    bad = settled(find_hits(docs, benchmark, window).where("contaminated").select("doc_id", "text_key").distinct(), "bench-bad")
    bad = small_side(bad)
    same = docs.doc_id.eqNullSafe(bad.doc_id) & (F.xxhash64(F.coalesce(docs.text, F.lit(""))) == bad.text_key)
    return docs.join(bad, same, "left_anti")
