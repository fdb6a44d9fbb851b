"""Odd rows: nulls, empty and very long texts, ties, repeated rows, empty tables and columns of clashing names."""

import hashlib
import re
import zlib
from collections import Counter

import corpus_pipeline
import pytest

from driftline.llm import decontaminate, encoding, html, licenses, quality, queries, sharding, substrings, topk, warc
from driftline.session import scratch_path

LONG = "lorem ipsum dolor " * 40_000
RUN = " ".join(f"shared{i}" for i in range(15))
NOTICE = "Licensed under CC BY 4.0."

# columns that the operators themselves use inside
CLASHES = "_1 string, _2 string, _DOC string, _key string, _text_key string, _places string, text_key string, hashes string, "
CLASHES += "score string, _stats string, _barrier string, _node string, ids string, Spans string, n_words string, row string"
WIDE = f"doc_id bigint, text string, n_chars bigint, {CLASHES}"
FILL = ("x",) * 16


def documents(corpus, rows):
    return corpus.createDataFrame([(d, t, len(t or ""), *FILL) for d, t in rows], WIDE)


ROWS = [
    (1, RUN + " tail of one"), (2, f"head {RUN}\n{RUN}"), (2, f"head {RUN}\n{RUN}"), (3, None), (4, ""), (5, " \t\n "), (6, LONG),
    (None, RUN), (None, None), (7, f"short {NOTICE}"), (8, "é▁ü \x00 a b <s> 漢字 😀"),
]


def counted(rows):
    return Counter(tuple(r) for r in rows)


def test_repeats_of_odd_rows(corpus):
    docs = documents(corpus, ROWS)
    got = substrings.remove_repeats(docs)
    kept = [c for c in docs.columns if c.lower() not in ("spans", "n_words")]
    assert got.columns[: len(kept)] == kept
    rows = got.select("doc_id", "n_words", "n_removed", "kept", "rest").collect()
    assert len(rows) == len(ROWS)
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for r, n in counted((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows).items():
        doc, n_words, removed, left = r
        text = next(t for d, t in ROWS if d == doc and len(word.findall(t or "")) == n_words) or ""
        words = word.findall(text)
        # only document 2 repeats an earlier one, twice, and keeps its first word
        assert (removed, left) == ((30, "head") if doc == 2 else (0, " ".join(words)))
        assert n == (2 if doc == 2 else n)
    assert substrings.remove_repeats(docs.limit(0)).count() == 0


def test_contamination_of_odd_rows(corpus):
    docs = documents(corpus, ROWS)
    bench = corpus.createDataFrame([("b", RUN), ("b", RUN), (None, "tail of one"), ("c", "Short"), ("d", ""), ("e", None)], "item_id string, text string")
    rows = decontaminate.find_hits(docs, bench).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append((r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]))
    assert by[1] == [(18, 18, ["b"], True)] and by[2] == [(31, 30, ["b"], True)] * 2
    assert by[7] == [(7, 1, ["c"], True)] and by[3] == by[4] == by[5] == [(0, 0, [], False)]
    assert by[6] == [(120_000, 0, [], False)] and sorted(by[None]) == [(0, 0, [], False), (15, 15, ["b"], True)]
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert counted(r[:2] for r in clean.collect()) == Counter([x for x in ROWS if x[0] in (3, 4, 5, 6, 8) or x == (None, None)])
    assert decontaminate.find_hits(docs, bench.limit(0)).where("contaminated OR n_hit > 0").count() == 0
    assert decontaminate.find_hits(docs.limit(0), bench).count() == 0


def test_ids_of_odd_rows(corpus):
    content = encoding.read_model(queries.TOKENIZER)
    model = encoding.load_model(content)
    got = encoding.encode(documents(corpus, ROWS), content)
    assert got.columns[-2:] == ["ids", "decoded"] and len(set(got.columns)) == len(got.columns)
    want = []
    for d, t in ROWS:
        ids = model.encode(t or "", add_bos=True, add_eos=True)
        want.append((d, b"".join(i.to_bytes(4, "little") for i in ids), model.decode(ids)))
    assert counted((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in got.collect()) == Counter(want)
    assert encoding.encode(documents(corpus, ROWS).limit(0), content).count() == 0


def test_shards_of_odd_rows(corpus):
    rows = sharding.assign_shards(documents(corpus, ROWS), 8).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    for s in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert all(r["grown_shard"] in (r["shard"], 8) for r in rows)
    assert sharding.assign_shards(documents(corpus, ROWS).limit(0), 8).count() == 0


def test_licenses_of_odd_rows(corpus):
    docs = documents(corpus, [*ROWS, (9, NOTICE), (9, NOTICE), (None, NOTICE)])
    rows = counted((r["doc_id"], r["license"]) for r in licenses.scan(docs).collect())
    assert rows == Counter({(7, "CC-BY-4.0"): 1, (9, "CC-BY-4.0"): 2, (None, "CC-BY-4.0"): 1})
    assert licenses.scan(docs.limit(0)).count() == 0


def test_quality_of_odd_rows(corpus):
    good = [(100 + i, "A plain sentence of ordinary words that reads quite well. " * 3) for i in range(60)]
    bad = [(200 + i, f"$$$ {i} !!! buy {i * 7} %%% buy buy buy") for i in range(60)]
    docs = documents(corpus, [*ROWS, *good, *bad])
    marks = [(d, 1) for d, _ in good] + [(d, 0) for d, _ in bad] + [(100, 1), (None, 1), (5, None), (999, 0)]
    labels = corpus.createDataFrame(marks, "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    scored = quality.score_quality(docs, model)
    assert sorted(scored.columns) == sorted(docs.columns)
    rows = scored.select("doc_id", "score").collect()
    assert len(rows) == len(ROWS) + 120 and all(0 <= r["score"] <= 1 for r in rows)
    assert all((r["score"] >= 0.7) == (r["doc_id"] < 200) for r in rows if r["doc_id"] and r["doc_id"] >= 100)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {d for d, _ in good} <= {r["doc_id"] for r in kept.collect()}
    assert [r["score"] for r in quality.score_quality(docs, quality.fit(docs, labels.limit(0))).limit(3).collect()] == [1.0] * 3
    assert quality.score_quality(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_vectors_of_odd_rows(corpus, empty):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, 1.0]), (0, [0.5, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, None), (6, [inf, 0.0]),
        (7, [1.0]), (None, [9.0, 9.0]), (50, [-0.001, 0.0]), (100, [1e9, 1e9]), (8, []),
    ]
    frame = corpus.createDataFrame([(i, v, "r", 1, 2) for i, v in rows], "vec_id bigint, embedding array<double>, row string, n int, tile int")
    frame = frame.limit(0) if empty else frame
    got = Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(frame, k=2).collect())
    want = Counter()
    whole = [(i, [int(x * 256 // 1) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and abs(x) < inf for x in v)]
    for q, a in [] if empty else whole:
        if q % 50 == 0:
            others = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))
            want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(others[:2]))
    assert got == want


def test_archive_of_odd_rows(corpus):
    big = "<p>" + "WARC/1.1\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n" * 50
    rows = [(1, "u", None), (2, None, ""), (3, "a\r\nb", big), (4, "u", big), (4, "u", big), (5, "u", "ü\n"), (6, "u", "ü\n"), (None, "u", big), (7, "u", "WARC/1."), (8, "u", "x" * 2_000_000)]
    pages = corpus.createDataFrame([(*r, "d", 1) for r in rows], "page_id bigint, url string, html string, digest string, n int")
    path = scratch_path(corpus, "edge-warc")
    warc.write_archive(pages, path)
    got = Counter((r["record_id"], r["type"], r["refers_to"], bytes(r["payload"]).decode(), r["http_length"]) for r in warc.read_archive(corpus, path).collect())
    want = Counter()
    for i, _, h in rows:
        again = i == 4
        want[f"<urn:page:{'none' if i is None else i}>", "revisit" if again else "response", "<urn:page:3>" if again else None, "" if again else h or "", len((h or "").encode())] += 1
    assert got == want
    empty = scratch_path(corpus, "edge-warc")
    warc.write_archive(pages.limit(0), empty)
    assert warc.read_archive(corpus, empty).count() == 0


def test_pages_of_odd_rows(corpus):
    page = "<html><body><nav>Menu</nav><article><h1>One &amp; two</h1><p>Some  \n text<p>More <b>bold</b></article><div class=comments>no</div></body></html>"
    rows = [(1, "http://h/1", None), (2, None, ""), (3, None, page), (3, None, page), (4, "http://h/2", "<p>" + "long " * 300_000), (None, "http://h/3", page), (5, "http://h/4", "bare < text & <b")]
    pages = corpus.createDataFrame([(*r, "t", *"rgabc") for r in rows], "page_id bigint, url string, html string, Text string, _row string, _gone string, _1 string, _url string, _HTML string")
    out = html.extract_text(pages)
    assert out.columns == ["page_id", "url", "html", "_row", "_gone", "_1", "_url", "_HTML", "text"]
    article = "One & two\nSome text\nMore bold"
    want = Counter({(1, ""): 1, (2, ""): 1, (3, article): 2, (4, " ".join(["long"] * 300_000)): 1, (None, article): 1})
    got = Counter((r["page_id"], r["text"]) for r in out.where("page_id IS NULL OR page_id < 5").collect())
    assert got == want and out.where("page_id = 5 AND text LIKE 'bare%'").count() == 1
    assert html.extract_text(pages.limit(0)).count() == 0


def test_stages_of_odd_rows(corpus, tmp_path):
    corpus.createDataFrame([(1, 1), (None, 0)], "doc_id bigint, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    corpus.createDataFrame([("b", RUN), (None, None)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for frame in (documents(corpus, ROWS), documents(corpus, ROWS).limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(corpus, frame, str(tmp_path))
            if name == "sentencepiece_ids":
                assert out.count() == frame.count()
                assert all(len(r["ids_sha256"]) == len(hashlib.sha256().hexdigest()) for r in out.collect())
            else:
                assert out.columns == frame.columns, name
                assert out.count() <= frame.count()
                assert all(tuple(r)[3:] == FILL for r in out.collect()), name
