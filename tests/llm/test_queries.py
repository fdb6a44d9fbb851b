"""Corpus queries on the given tables: against SQL, or against a plain version of the same rule."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest

import corpus_pipeline
from driftline.llm import encoding, html, licenses, neardup, queries
from driftline.llm.common import WordHashes
from tests.compare import difference, duck, duck_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in queries.QUERIES.items() if sql))
def test_matches_sql(corpus, con, name):
    run, sql = queries.QUERIES[name]
    assert difference(spark_rows(run(corpus, FOLDER)), duck_rows(con, sql)) is None


def texts(con):
    return dict(con.execute("SELECT doc_id, text FROM documents").fetchall())


def held(template, words):
    """(share of the template's shingles, no telling word lacking or foreign) between the first and last shared one."""
    t = licenses.words_of(template)
    k = min(5, len(t))
    own = {tuple(t[i : i + k]) for i in range(len(t) - k + 1)}
    at = [i for i in range(len(words) - k + 1) if tuple(words[i : i + k]) in own]
    met = {tuple(words[i : i + k]) for i in at}
    if not at:
        return 0.0
    span = words[at[0] : at[-1] + k]
    fits = licenses.telling(t) <= {w for s in met for w in s} and not (set(span) & licenses.VARIANTS) - set(t)
    return len(met) / len(own) if fits else 0.0


def test_licenses_are_those_of_a_plain_scan(corpus, con):
    """Every place of a whole text where as many words as a template has hold 0.8 of it, and nothing that does not."""
    rows = queries.op1_licenses(corpus, FOLDER).collect()
    templates = licenses.TEMPLATES + licenses.family_templates()
    words = {doc: licenses.words_of(text or "") for doc, text in texts(con).items()}
    for r in rows:
        name, template = templates[r["template"]]
        assert r["license"] == name
        share = held(template, words[r["doc_id"]][r["start_word"] : r["start_word"] + r["n_words"]])
        assert share >= 0.8 and abs(share - r["containment"]) < 1e-9
    got = {(r["doc_id"], r["template"]) for r in rows}
    want = set()
    shared = {}
    for number, (_, template) in enumerate(templates):
        t = licenses.words_of(template)
        shared[number] = (t, min(5, len(t)), {tuple(t[i : i + 5]) for i in range(max(1, len(t) - 4))})
    for doc, w in words.items():
        for number, (t, k, own) in shared.items():
            starts = [i for i in range(len(w) - k + 1) if tuple(w[i : i + k]) in own]
            if any(held(templates[number][1], w[i : i + len(t)]) >= 0.8 for i in starts):
                want.add((doc, number))
    assert want and want <= got


def test_quality_is_learnt_without_the_held_out_rows(corpus):
    con = duck(LARGER)
    labels = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = queries.op3_quality(corpus, LARGER).collect()
    assert len(rows) == con.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    judged = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(judged) > 50 and sum(judged) / len(judged) > 0.97


def test_html_gives_the_articles(corpus, con):
    rows = {r["page_id"]: r for r in queries.op4_html(corpus, FOLDER).collect()}
    for page, url, source in con.execute("SELECT page_id, url, html FROM pages").fetchall():
        article = source[source.index("<article>") : source.index("</article>")]
        blocks = [re.sub(r"<[^>]*>", " ", b) for b in re.split(r"</?(?:p|h1|article)>", article)]
        want = [" ".join(html.html.unescape(b).split()) for b in blocks]
        assert rows[page]["text"] == "\n".join(b for b in want if b)
        assert rows[page]["n_chars"] == len(rows[page]["text"]) and rows[page]["url"] == url


def jump(key: int, shards: int) -> int:
    b, j, key = -1, 0, key % 2**64
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_follow_the_published_hash(corpus, con):
    rows = queries.op5_sharding(corpus, FOLDER).collect()
    assert len(rows) == len(texts(con))
    slots = defaultdict(set)
    for r in rows:
        text = (texts_ := texts(con) if not slots else texts_)[r["doc_id"]].encode()
        assert r["size"] == len(text) + 1 and r["text_crc32"] == zlib.crc32(text)
        assert r["shard"] == jump(r["doc_id"], 8) and r["grown_shard"] == jump(r["doc_id"], 9)
        assert r["grown_shard"] in (r["shard"], 8)
        slots[r["shard"]].add(r["slot"])
    assert all(s == set(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == len(rows)


def test_near_duplicates_are_the_components_of_all_similar_pairs(corpus):
    """Every pair of texts at the threshold, found by an inverted index over all shingles."""
    con = duck(LARGER)
    docs = texts(con)
    frame = corpus.read.parquet(f"{LARGER}/documents.parquet")
    table, n = neardup.document_frequencies(frame)
    assert n == len(docs)
    freq, known = neardup.Frequencies(neardup.np.frombuffer(table, neardup.np.int32), n), WordHashes()
    sets = {d: neardup.shingles_of(t, known) for d, t in docs.items()}
    holders, pairs = defaultdict(list), set()
    for d, (s, _) in sets.items():
        for x in s.tolist():
            holders[x].append(d)
    for ds in holders.values():
        pairs.update((a, b) for i, a in enumerate(ds) for b in ds[i + 1 :])
    parent = {d: d for d in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in pairs:
        if neardup.weighted_jaccard(sets[a], sets[b], freq) >= 0.8:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    want = {d: root(d) for d in docs}
    got = {r["doc_id"]: r["class_id"] for r in queries.op7_neardup(corpus, LARGER).collect()}
    assert got.keys() == want.keys()
    assert [d for d in want if got[d] != want[d]] == []
    assert len(set(want.values())) < len(want)


def test_ids_are_those_of_the_library(corpus, con):
    model = encoding.load_model(encoding.read_model(queries.TOKENIZER))
    rows = {r["doc_id"]: r for r in queries.op8_sentencepiece(corpus, FOLDER).collect()}
    for doc, text in texts(con).items():
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert rows[doc]["n_tokens"] == len(ids)
        assert rows[doc]["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert rows[doc]["decoded_sha256"] == hashlib.sha256(model.decode(ids).encode()).hexdigest()


def test_pipeline_stages_apply_in_turn(corpus):
    columns = corpus.read.parquet(f"{FOLDER}/documents.parquet").columns
    docs, left = corpus.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(corpus, docs, FOLDER).cache()
        assert docs.columns == columns, name
        after = {r["doc_id"]: r for r in docs.collect()}
        assert after.keys() <= before.keys() and docs.count() == len(after)
        left.append(len(after))
        if name == "substring_dedup":
            assert after.keys() == before.keys() and any(after[d]["text"] != before[d]["text"] for d in after)
            assert all(len(r["text"]) == r["n_chars"] for r in after.values())
        else:
            assert all(after[d] == before[d] for d in after)
    assert sorted(left, reverse=True) == left and left[0] > left[1] > 0
    ids = corpus_pipeline.run(corpus, FOLDER).collect()
    assert {r["doc_id"] for r in ids} == after.keys()
