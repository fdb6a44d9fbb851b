"""Aligned tokens against a plain version that walks over the bytes."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from driftline.llm import alignment
from driftline.llm.encoding import read_model
from driftline.llm.queries import BYTE_TOKENIZER, TOKENIZER

ODD = [
    None, "", " ", "  ", "a ", " a", "\n", "a\n\n  b  ", "x▁y", "▁", "<s> </s> <unk> <|endoftext|>", "日本語 テキスト 😀 emoji",
    "it's we'LL  I'd\t\tx", "\x00\x01 a\x1c b\x85c\xa0 d", "1234567 89 ①②", "a" * 700, " " * 50 + "x", "é́ ﬁ Å", "a\r\n b", "  x 　 y",
    "the one of the", "the one of the", "unhappiness notwithstanding", "été naïve 12:30 -- (really?)",
]


@pytest.fixture(scope="module")
def files():
    return read_model(BYTE_TOKENIZER), read_model(TOKENIZER)


@pytest.fixture(scope="module")
def tools(files):
    return alignment.Tokenizers(*files)


def spans(pieces):
    out, at = [], 0
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(text, tools):
    """(n_a, n_b, groups, links with their occurrences), or None without tokens."""
    if not text:
        return None
    v, body = tools.vocabularies, " " + text
    a = tools.whole.encode(body, add_special_tokens=False).ids
    b = tools.piece.encode(text)
    a_bytes, b_bytes = [v.a_bytes[i] for i in a], [v.b_bytes[i] for i in b]
    if b"".join(a_bytes) != body.encode() or b"".join(b_bytes) != body.encode():
        return None
    a_spans, b_spans = spans(a_bytes), spans(b_bytes)
    groups, low = [], 0
    for cut in sorted({e for _, e in a_spans} & {e for _, e in b_spans}):
        sides = [",".join(str(i) for i, (s, e) in zip(ids, at) if low <= s and e <= cut) for ids, at in ((a, a_spans), (b, b_spans))]
        groups.append("|".join(sides))
        low = cut
    links = collections.Counter()
    for i, (s, e) in zip(a, a_spans):
        for j, (t, f) in zip(b, b_spans):
            links[i, j] += max(s, t) < min(e, f)
    return len(a), len(b), ";".join(groups), +links


def plain_scores(texts, tools):
    found = [plain(t, tools) for t in texts]
    counts = collections.Counter(p for f in found if f for p in f[3])
    best = collections.defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        best_links = sum(n for p, n in links.items() if counts[p] == best[p[0]])
        total = sum(n * counts[p] for p, n in links.items())
        out.append((n_a, n_b, groups.count(";") + 1, sum(links.values()), best_links, total, hashlib.sha256(groups.encode()).hexdigest()))
    return out


def as_rows(scored):
    cols = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return [tuple(r[c] for c in cols) for r in scored.orderBy("doc_id").collect()]


def test_the_vocabulary_is_merged_by_rank(tools):
    assert tools.quick is not None
    assert tools.vocabularies.a_bytes[50256] == b"<|endoftext|>"
    assert tools.encode_a(["it's 日本 été"])[0] == tools.whole.encode("it's 日本 été", add_special_tokens=False).ids


@pytest.mark.parametrize("rows", [alignment.small_side.__defaults__[0], 0], ids=["broadcast", "shuffle"])
def test_scores_against_the_plain_version(corpus, files, tools, rows, monkeypatch):
    texts = ODD + [r["text"] for r in corpus.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 1500").orderBy("doc_id").limit(60).collect()]
    docs = corpus.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    if not rows:  # the table of pairs counts as large
        monkeypatch.setattr(alignment, "small_side", lambda df: df)
    scored = alignment.score_links(alignment.align_tokens(docs, *files), tools.vocabularies)
    assert as_rows(scored) == plain_scores(texts, tools)


def test_long_texts_are_taken_in_steps(tools, monkeypatch):
    text = "the unhappiness of été\n notwithstanding  it " * 60
    monkeypatch.setattr(alignment, "STEP", 37)
    monkeypatch.setattr(alignment, "TABLE", 10)
    got = alignment.measure([text, "x▁" + text, text], alignment.Chunks(tools), True)
    n_a, n_b, groups, links = plain(text, tools)
    assert got[1] is None
    for m in (got[0], got[2]):
        assert m.counts.tolist() == [n_a, n_b, groups.count(";") + 1, sum(links.values())]
        assert ";".join(m.kept) == groups
        assert {divmod(k, 32000): n for k, n in zip(m.links.tolist(), m.times.tolist())} == dict(links)


def test_groups_and_clashing_columns(corpus, files, tools):
    docs = corpus.createDataFrame([(1, "the one", 5, "x", "own"), (None, "the one", 6, "y", None)], "doc_id long, text string, pair int, _row string, Groups string")
    found = alignment.align_tokens(docs, *files, groups=True)
    assert {r["groups"] for r in found.collect()} == {plain("the one", tools)[2]}
    scored = alignment.score_links(found, tools.vocabularies)
    assert {(r["doc_id"], r["pair"], r["_row"], r["n_best"]) for r in scored.collect()} == {(1, 5, "x", 2), (None, 6, "y", 2)}


def test_an_empty_table(corpus, files, tools):
    docs = corpus.createDataFrame([], "doc_id long, text string")
    assert alignment.score_links(alignment.align_tokens(docs, *files), tools.vocabularies).count() == 0
    nothing = corpus.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert as_rows(alignment.score_links(alignment.align_tokens(nothing, *files), tools.vocabularies)) == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_counts_cover_all_documents(corpus, files, tools):
    docs = corpus.createDataFrame([(i, "the one" if i % 2 else "the other") for i in range(40)], "doc_id long, text string").repartition(7)
    scored = alignment.score_links(alignment.align_tokens(docs, *files), tools.vocabularies)
    assert {r["count_sum"] for r in scored.where(F.col("doc_id") % 2 == 1).collect()} == {40 + 20}
