"""Near duplicates on made-up families: a base, copies with few to many edits, and texts that only quote a passage."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from driftline.llm import common, neardup
from driftline.llm.common import WordHashes

SCHEMA = "doc_id bigint, text string, node string, class_id string"


def family(seed=3, copies=240):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for i in range(copies):
        text = list(base)
        for _ in range(rng.randrange(1, 7)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append(" ".join(text))
    rows += [" ".join(base[:40] + [rng.choice(words) for _ in range(100)]) for _ in range(60)]
    return rows


def exact_classes(docs, freq):
    known = WordHashes()
    sets = {d: neardup.shingles_of(t or "", known) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            same = (docs[a] or "") == (docs[b] or "")
            if same or len(sets[a][0]) and len(sets[b][0]) and neardup.weighted_jaccard(sets[a], sets[b], freq) >= 0.8:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: root(d) for d in docs}


def test_families_and_odd_rows(corpus):
    texts = [*family(), None, "", "", "!!! ...", "two words", "two  Words", "x " * 9000, "x " * 9000]
    docs = dict(enumerate(texts))
    frame = corpus.createDataFrame([(d, t, "n", "c") for d, t in docs.items()], SCHEMA)
    table, n = neardup.document_frequencies(frame)
    want = exact_classes(docs, neardup.Frequencies(np.frombuffer(table, np.int32), n))
    for rounds in (0, 3):
        got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(frame, rounds=rounds).collect()}
        assert got == want
    assert 40 < len(set(want.values())) < len(docs) - 40


def test_keep_one_of_repeated_and_unnamed_rows(corpus):
    rows = [(1, "a b c d e f", "n", "c"), (1, "a b c d e f", "n", "c"), (2, "a b c d e f", "n", "c"), (None, "q r s", "n", "c"), (None, "q r s", "n", "c"), (1, "z", "n", "c")]
    frame = corpus.createDataFrame(rows, SCHEMA)
    kept = neardup.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == [(0, "q r s"), (1, "a b c d e f"), (1, "z")]
    assert neardup.keep_one(frame.limit(0)).count() == 0


def test_samples_agree_as_often_as_the_sets_are_similar():
    rng = np.random.default_rng(1)
    s = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))
    sampler, hits = neardup.Sampler(), 0
    one, two = s[:360], s[40:]
    w = rng.random(len(s)).astype(np.float32) + 1
    a, b = sampler.bands(one, w[:360]), sampler.bands(two, w[40:])
    hits = (a == b).sum()
    assert hits >= 1 and (sampler.bands(one, w[:360]) == a).all()


def test_similarities_take_true_frequencies(corpus):
    """More shingles than slots: the table counts each far too often."""
    rng = random.Random(5)
    fill = [" ".join(f"v{rng.randrange(10**9)}" for _ in range(20_000)) for _ in range(120)]
    common = [f"line{i}" for i in range(60)]
    rows = []
    for k in range(120):
        own = [f"p{k}x{i}" for i in range(6 + k // 4)]
        rows += [" ".join(common + own), " ".join(common + own[:-6] + [f"q{k}x{i}" for i in range(6)])]
    rows += [" ".join(common + [f"z{i}y{j}" for j in range(60)]) for i in range(300)]
    docs = dict(enumerate(rows))
    everything = rows + fill
    frame = corpus.createDataFrame([(i, t, "n", "c") for i, t in enumerate(everything)], SCHEMA).repartition(8)
    known, df = WordHashes(), {}
    for t in everything:
        for s in neardup.shingles_of(t, known)[0].tolist():
            df[s] = df.get(s, 0) + 1

    class True_:
        def of(self, shingles):
            return neardup.idf_of(np.array([df[s] for s in shingles.tolist()]), len(everything))

    table, n = neardup.document_frequencies(frame)
    sets = {d: neardup.shingles_of(t, known) for d, t in docs.items()}
    slots = neardup.Frequencies(np.frombuffer(table, np.int32), n)

    def linked(freq):
        return {k for k in range(120) if neardup.weighted_jaccard(sets[2 * k], sets[2 * k + 1], freq) >= 0.8}

    want = linked(True_())
    assert want != linked(slots)
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(frame).collect()}
    assert {k for k in range(120) if got[2 * k] == got[2 * k + 1]} == want


@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_shingles_of_many_texts_are_those_of_each(monkeypatch, size):
    monkeypatch.setattr(neardup, "SLICE_BYTES", size)
    rng = random.Random(size)
    letters = "abcXYZ_09 \t\n.,-!éßİKſ漢字。“”—\u0307\u200b٣१😀\x00\x85\xa0ǅ"
    texts = [None, "", "a", "a b c d", "a b c d e", " ", "!!!", *("".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(300)), "", None]
    texts += [" ".join("x" * rng.randrange(1, 300) for _ in range(k)) for k in range(12)]
    words = [[w.encode() for w in re.findall(r"\w+", (t or "").lower())] for t in texts]
    assert [neardup.words_of(t or "") for t in texts] == words
    known, got = WordHashes(), list(neardup.shingle_sets(texts))
    assert len(got) == len(texts)
    for t, (s, n) in zip(texts, got):
        one, times = neardup.shingles_of(t or "", known)
        assert s.tolist() == one.tolist() and n.tolist() == times.tolist()
    assert list(neardup.shingle_sets([])) == []


def test_hashes_of_stretches_are_those_of_the_library():
    rng = np.random.default_rng(6)
    data = rng.integers(0, 256, 3000, dtype=np.uint8)
    starts = rng.integers(0, 2900, 2000)
    ends = np.minimum(starts + rng.integers(1, 20, 2000), len(data))
    starts, ends = np.append(starts, len(data) - np.arange(1, 10)), np.append(ends, np.full(9, len(data)))
    want = [xxhash.xxh3_64_intdigest(data[a:z].tobytes()) for a, z in zip(starts, ends)]
    assert common.word_hashes(data, starts, ends).tolist() == want


def test_a_pass_over_all_texts_costs_little_more_than_a_scan():
    """Three passes take the shingles of all texts; each used to look every word up on its own."""
    rng = random.Random(4)
    rows = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(500)) for _ in range(800)]
    b = pa.RecordBatch.from_arrays([pa.array(rows)], ["text"])

    def least(f):
        took = []
        for _ in range(3):
            a = time.process_time()
            f()
            took.append(time.process_time() - a)
        return min(took)

    scan = least(lambda: [re.findall(r"\w+", t.lower()) for t in rows])
    took = least(lambda: list(neardup._occurrences()(iter([b]))))
    assert took < 2 * scan
