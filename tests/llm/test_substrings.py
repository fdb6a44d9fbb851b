"""Repeated passages: words found for whole slices of texts at once, against a plain scan of each text."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from driftline.llm import common, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " ", " \t\n ", "one", " one ", "x" * 300 + " y", "é▁ü \x00 a b <s> 漢字 😀", None, "\x1c a\x1db \x85 c", "a\x0bb\x0cc\rd\ne\tf", ""]


def texts(n, seed=2):
    rng = random.Random(seed)
    words = ["a", "bb", "é", "漢字" * 9, "w" * 8, "w" * 9, "w" * 64, "w" * 65, *(f"word{i}" for i in range(4000))]
    return ODD + [rng.choice(["", " "]) + "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n\t"]) for _ in range(rng.randrange(60))) for _ in range(n)] + ODD


def batch(rows, places):
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.string()), pa.array(places, pa.list_(pa.int32())), pa.array(range(len(rows)))], ["text", "places", "doc_id"])


def plain_cut(text, places):
    spans = [m.span() for m in WORD.finditer(text or "")]
    gone = {p + k for p in places or [] for k in range(13)}
    stay = [i for i in range(len(spans)) if i not in gone]
    runs = [i for i in sorted(gone) if i - 1 not in gone]
    found = [{"start": i, "length": next(k for k in range(1, len(spans) + 1) if i + k not in gone)} for i in runs]
    rest = text
    if gone:
        rest = text[: spans[0][0]] + "".join(text[spans[i][0] : spans[i + 1][0] if i + 1 < len(spans) else len(text)] for i in stay)
    return len(spans), len(gone), found, " ".join(text[slice(*spans[i])] for i in stay), rest


@pytest.mark.parametrize("size", [1, 200, 1 << 20])
def test_cut_is_that_of_a_plain_scan(monkeypatch, size):
    monkeypatch.setattr(common, "SLICE_BYTES", size)
    rng = random.Random(size)
    rows, places = texts(300), []
    for t in rows:
        n = len(WORD.findall(t or ""))
        places.append([rng.randrange(n - 12) for _ in range(rng.randrange(1, 4))] if n >= 13 and rng.random() < 0.7 else rng.choice([None, []]))
    whole = batch(rows, places)
    for b, lo in ((whole, 0), (whole.slice(7, 90), 7), (whole.slice(0, 0), 0)):
        got = [tuple(r.values()) for x in substrings._cut(13, list(substrings.CUT))(iter([b])) for r in x.to_pylist()]
        assert got == [(lo + i, *plain_cut(rows[lo + i], places[lo + i])) for i in range(b.num_rows)]


@pytest.mark.parametrize("size", [1, 200, 1 << 20])
def test_equal_words_share_a_hash_and_others_do_not(monkeypatch, size):
    monkeypatch.setattr(common, "SLICE_BYTES", size)
    rows, by = [t or "" for t in texts(300)], {}
    b = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(range(len(rows))), pa.array(rows)], ["doc_id", "text_key", "text"])
    for block in substrings.blocks_of(iter([b.slice(0, 5), b.slice(5)])):
        for doc, lo, hi in zip(block.docs, block.first, block.first[1:]):
            words = WORD.findall(rows[doc])
            assert len(words) == hi - lo
            for w, h in zip(words, block.words[lo:hi].tolist()):
                by.setdefault(w, set()).add(h)
    assert all(len(h) == 1 for h in by.values()) and len({h for x in by.values() for h in x}) == len(by) > 3000


def test_work_per_word_is_less_than_a_scan_of_each_text():
    """The operator reads all texts three times; each used to cost several scans by the regular expression."""
    rng = random.Random(4)
    rows = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(500)) for _ in range(800)]
    docs = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(range(len(rows))), pa.array(rows)], ["doc_id", "text_key", "text"])

    def least(f):
        took = []
        for _ in range(3):
            a = time.process_time()
            f()
            took.append(time.process_time() - a)
        return min(took)

    scan = least(lambda: [WORD.findall(t) for t in rows])
    bare = batch(rows, [None] * len(rows))
    assert least(lambda: list(substrings._cut(13, list(substrings.CUT))(iter([bare])))) < scan
    assert least(lambda: list(substrings._emit_anchors(13)(iter([docs])))) < 1.5 * scan


def test_anchors_of_several_documents_are_marked():
    run = " ".join(f"r{i}" for i in range(30))
    rows = [run, "", "x " + run, "few words", " ".join(f"own{i}" for i in range(40)), run.replace("r29", "other"), " ".join(["again"] * 40)]
    b = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(range(len(rows))), pa.array(rows)], ["doc_id", "text_key", "text"])
    per_doc = []
    for i in range(len(rows)):
        got = pa.Table.from_batches(list(substrings._emit_anchors(13)(iter([b.slice(i, 1)]))))
        assert not any(got.column("many").to_pylist())
        per_doc.append(set(got.column("anchor").to_pylist()))
    got = pa.Table.from_batches(list(substrings._emit_anchors(13)(iter([b]))))
    counts = {a: sum(a in x for x in per_doc) for x in per_doc for a in x}
    assert dict(zip(*(got.column(c).to_pylist() for c in ("anchor", "many")))) == {a: n > 1 for a, n in counts.items()}
    assert [len(x) > 0 for x in per_doc] == [True, False, True, False, True, True, True] and np.any(got.column("many"))
