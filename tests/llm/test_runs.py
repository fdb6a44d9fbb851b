"""Runs of words against a plain version that tries every period."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import runs


def plain_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i, n = 0, len(w) - q
        while i < n:
            j = i
            while j < n and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q) and not any(s <= i and i + (j - i + q) <= s + m and p < q for s, m, p in out):
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(w):
    return [tuple(map(int, r)) for r in runs.runs_of(np.array(w, np.int64))]


@pytest.mark.parametrize("seed", range(4))
def test_made_up_texts(seed):
    rng = random.Random(seed)
    total = 0
    for _ in range(500):
        n, letters = rng.randint(0, 120), rng.choice([1, 2, 2, 3, 5, 50])
        w = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 4)):
            if n > 10:
                q, s = rng.randint(1, n // 4), rng.randrange(n)
                for i in range(s + q, min(n, s + q * rng.randint(3, 9) + rng.randint(0, 3))):
                    w[i] = w[i - q]
        want = plain_runs(w)
        total += len(want)
        assert found(w) == want
    assert total > 100


def test_every_period_of_a_long_text():
    for q in (1, 2, 3, 63, 64, 65, 700):
        w = list(range(10_000, 10_050)) + [i % q for i in range(4 * q + 7)] + list(range(20_000, 20_050))
        assert (50, 4 * q + 7, q) in found(w)
        assert found(w) == plain_runs(w) or q > 100


def test_one_word_a_million_times():
    assert found([7] * 1_000_000) == [(0, 1_000_000, 1)]


def test_short_of_the_exponent():
    assert found([1, 2, 3] * 4) == [(0, 12, 3)]
    assert found(([1, 2, 3] * 4)[:-1]) == []
    assert found([1] * 5) == [] and found([1] * 6) == [(0, 6, 1)]


def test_colliding_names_are_settled_by_words(monkeypatch):
    monkeypatch.setattr(runs, "mix", lambda x: x & np.uint64(3))
    rng = random.Random(3)
    for _ in range(100):
        w = [rng.randrange(4) for _ in range(40)]
        assert set(found(w)) <= set(plain_runs(w))


def test_rows_and_defined_cases(corpus):
    texts = [None, "", " \n\t ", "a b", "x " + "a b\tc\n" * 4 + "y", "x " + "a b\tc\n" * 4 + "y", "\xa0a " * 7, "\xa0b" * 6]
    docs = corpus.createDataFrame([(i, t, i, "own") for i, t in enumerate(texts)], "doc_id long, text string, _body long, Runs string")
    got = {r["doc_id"]: r for r in runs.find_runs(docs).collect()}
    assert len(got) == len(texts) and got[4]["_body"] == 4
    assert [tuple(r) for r in got[4]["runs"]] == [(1, 12, 3)] and got[4]["collapsed"] == "x a b c y"
    assert got[4]["runs"] == got[5]["runs"]
    assert [len(got[i]["runs"]) for i in range(4)] == [0] * 4
    assert [got[i]["collapsed"] for i in range(4)] == ["", "", "", "a b"]
    # only blanks and control characters 9 to 13 part words
    assert got[6]["collapsed"] == "\xa0a" and len(got[7]["runs"]) == 0
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_the_periodic_tail(corpus):
    texts = {i: " ".join(f"w{j}" for j in range(i % 97)) for i in range(400)}
    docs = corpus.createDataFrame([*texts.items(), (None, "a b c")], "doc_id long, text string")
    got = {r["doc_id"]: r["t"] for r in docs.select("doc_id", runs.repeat_tail(F.col("doc_id"), F.col("text")).alias("t")).collect()}
    changed = 0
    for i, text in texts.items():
        words, h = text.split(), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
            changed += 1
        assert got[i].split() == words
    assert changed > 20 and got[None] == "a b c"
