"""Queries over the corpus tables, one per operator, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import alignment, decontaminate, encoding, html, licenses, neardup, quality, runs, sharding, substrings, topk, vectors, warc
from driftline.llm.common import load
from driftline.session import scratch_path

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Run, str | None]] = {}


def query(sql: str | None = None):
    def register(fn: Run) -> Run:
        QUERIES[fn.__name__] = (fn, sql)
        return fn

    return register


@query(
    """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest FROM p),
    m AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
           CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN page_id > first THEN first END AS refers_to
    FROM m"""
)
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as WARC records and read back through the chain of record boundaries."""
    path = scratch_path(spark, "warc")
    warc.write_archive(load(spark, folder, "pages"), path)
    revisit = F.col("type") == "revisit"

    def number(name: str):
        return F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")

    return warc.read_archive(spark, path).select(
        number("record_id").alias("page_id"),
        F.when(revisit, F.col("http_length")).otherwise(F.octet_length("payload")).cast("bigint").alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("digest", "^sha256:", "")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, number("refers_to")).alias("refers_to"),
    )


@query()
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents by a sparse ensemble of rules."""
    docs = load(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, load(spark, folder, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        quality.is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query()
def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages, without the templates of their hosts."""
    pages = load(spark, folder, "pages").select("page_id", "url", "html")
    return html.extract_text(pages).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@query()
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in eight shards by jump consistent hashing, and where they go with a ninth."""
    out = sharding.assign_shards(load(spark, folder, "documents"), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
      FROM v AS q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""
)
def op6_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one, by inner product, exactly."""
    return topk.top_k(load(spark, folder, "embeddings"))


TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")


@query()
def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of all documents and what they decode to, as digests."""
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return encoding.digests(encoding.encode(docs, encoding.read_model(TOKENIZER)))


@query(
    """WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
    cut AS (SELECT item_id, w, least(len(w), 13) AS n FROM item WHERE len(w) > 0),
    runs AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS run
      FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM cut)),
    spots AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS run
      FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM words, (SELECT DISTINCT n FROM cut) WHERE len(w) >= n)),
    hits AS (SELECT doc_id, item_id, p, n FROM spots JOIN runs USING (n, run)),
    marked AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) FROM hits) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
      CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM words LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)"""
)
def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all documents that lie in a window of the benchmark."""
    found = decontaminate.find_hits(load(spark, folder, "documents"), load(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query()
def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in all documents."""
    return licenses.scan(load(spark, folder, "documents"))


@query(
    """WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    g AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)),
    m AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
    gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS pos FROM g JOIN m USING (g) WHERE doc_id > first),
    k AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
    s AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept FROM k ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
    n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM d LEFT JOIN s USING (doc_id) LEFT JOIN n USING (doc_id)"""
)
def op9_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the passages of 13 words or more that an earlier one has."""
    out = substrings.remove_repeats(load(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op7_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document, named by its smallest doc_id."""
    found = neardup.near_duplicates(load(spark, folder, "documents"))
    return found.select("doc_id", "class_id")


BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query()
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of two tokenizers aligned over the bytes of all documents, and how common their links are."""
    a, b = encoding.read_model(BYTE_TOKENIZER), encoding.read_model(TOKENIZER)
    found = alignment.align_tokens(load(spark, folder, "documents").select("doc_id", "text"), a, b)
    scored = alignment.score_links(found, alignment.Tokenizers(a, b).vocabularies)
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query(
    """WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
      xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
        lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) AS h FROM documents),
    k AS (SELECT *, CAST(len(w) AS BIGINT) AS n, h // 10 AS g FROM d),
    t AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM k),
    s AS (SELECT *, CAST(1 + (n - a) // (3 + g % 8) AS BIGINT) AS p FROM t),
    x AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w FROM s),
    u AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM x),
    e AS (SELECT u.doc_id, u.i, v.i - u.i AS q FROM u JOIN u AS v ON u.doc_id = v.doc_id AND u.word = v.word AND v.i > u.i AND 4 * (v.i - u.i) <= u.n),
    f AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS z FROM e),
    c AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM f GROUP BY doc_id, q, z HAVING count(*) + q >= greatest(6, 4 * q)),
    r AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS o WHERE o.doc_id = c.doc_id AND o.q < c.q AND o.start <= c.start AND o.start + o.length >= c.start + c.length)),
    m AS (SELECT doc_id, count(*) AS n_runs, arg_max({'s': start, 'l': length, 'q': q}, {'l': length, 's': -start, 'q': -q}) AS b,
        string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM r GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM r),
    l AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM u ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.s AS BIGINT) AS start, CAST(b.l AS BIGINT) AS length, CAST(b.q AS BIGINT) AS period,
      CAST(1000 * b.l // b.q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM x LEFT JOIN m USING (doc_id) LEFT JOIN l USING (doc_id)"""
)
def op12_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of words in all documents, a tenth of which get a periodic tail first."""
    docs = load(spark, folder, "documents").select("doc_id", runs.repeat_tail(F.col("doc_id"), F.col("text")).alias("text"))
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    found = runs.find_runs(docs).withColumn("best", F.array_min(ranked))
    line = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(line, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    """WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9),
    r AS (SELECT vec_id, vec_id AS seen FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.seen = l.a),
    c AS (SELECT vec_id, min(seen) AS component_id FROM r GROUP BY vec_id),
    n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
    SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings LEFT JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)"""
)
def op13_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Links, components and kept vectors among all embeddings."""
    found = vectors.near_vectors(load(spark, folder, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
