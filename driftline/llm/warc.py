"""WARC archives: a writer with revisit records, and a reader that trusts only the chain of record boundaries.

Writing is one text sink whose line separator is the end of a record, so files go wherever Spark writes. Reading
splits files at every occurrence of the record magic, inside payloads too. Each task turns such a candidate into an
offset and the offset of its successor (by its Content-Length); pointer jumping from offset 0 of every file keeps the
candidates that are reached. Text between two candidates goes to the last record reached. Contents are not shuffled,
unless a payload holds the magic; then the pieces of that record alone are gathered.

Defined cases: a null payload is written as an empty one; of records with equal payloads of ``min_revisit`` bytes or
more, all rows with the smallest id are responses and the others revisits; a row without an id is always a response;
line ends inside a url are percent-encoded; a null url gives no target line. A file that does not start with a record,
or breaks off, yields the records that end before that; a record is whole if its stated length lies within the file. Columns other than the three named ones are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm.common import settled, small_side

MAGIC = "WARC/1."
END = "\r\n\r\n"
MIN_REVISIT = 100
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def urn(ident: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(ident.cast("string"), F.lit("none")), F.lit(">"))


def revisits(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(page_id, digest, refers_to) of the rows that repeat the payload of a smaller page_id."""
    rows = (
        pages.where(F.col("page_id").isNotNull())
        .select("page_id", F.coalesce("html", F.lit("")).alias("payload"))
        .where(F.octet_length("payload") >= min_revisit)
        .groupBy("page_id", F.sha2(F.col("payload"), 256).alias("digest"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = settled(rows, "warc-digests")
    first = rows.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = small_side(settled(first, "warc-first"))
    return rows.join(first, "digest").where("page_id > refers_to").select("page_id", "digest", "refers_to")


def write_archive(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, date: str = DATE, records_per_file: int = 2048) -> None:
    """Write a record per row of (page_id, url, html) into uncompressed archives under ``path``."""
    again = small_side(settled(revisits(pages, min_revisit), "warc-revisits"))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).withColumn("digest", F.sha2(F.col("payload"), 256))
    rows = rows.join(again, ["page_id", "digest"], "left")
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(END))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    head = F.concat_ws(
        "\r\n",
        F.lit(f"{MAGIC}1"),
        F.when(revisit, "WARC-Type: revisit").otherwise("WARC-Type: response"),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), uri),  # null without a url, and then left out
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(F.col("body")).cast("string")),
    )
    records = rows.withColumn("body", body).select(F.concat(head, F.lit(END), F.col("body")).alias("value"))
    records.write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).option("compression", "none").text(path)


def fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().lower().decode("latin-1"), value.strip().decode("utf-8", "replace"))
    return out


def record_length(rest: bytes) -> int | None:
    """Bytes of the record whose text after the magic starts with ``rest``; None if this is no record's head."""
    end = rest.find(b"\r\n\r\n")
    if end < 0 or not re.match(rb"\d\r\n", rest):
        return None
    found = fields(rest[:end]).get("content-length", "")
    return len(MAGIC) + end + 4 + int(found) + 4 if re.fullmatch(r"[0-9]{1,15}", found) else None


SCANNED = "file string, block bigint, rel bigint, size bigint, length bigint"


def _scan(contents: bool):
    """Number the pieces of every split: ``rel`` counts the bytes from the first piece that starts in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rel = None, 0
        for b in batches:
            files, blocks, values = (b.column(i).to_pylist() for i in range(3))
            rels, sizes, lengths = [], [], []
            for file, block, value in zip(files, blocks, values):
                if at != (file, block):
                    at, rel = (file, block), 0
                rels.append(rel)
                sizes.append(len(value))
                lengths.append(record_length(value))
                rel += len(value) + len(MAGIC)
            cols = {"file": files, "block": blocks, "rel": rels, "size": sizes, "length": lengths}
            arrays = [pa.array(c, pa.string() if k == "file" else pa.int64()) for k, c in cols.items()]
            yield pa.RecordBatch.from_arrays(arrays + [b.column(2)] * contents, [*cols] + ["value"] * contents)

    return run


def pieces(spark: SparkSession, path: str, contents: bool) -> DataFrame:
    """Everything between two magics, numbered; with its bytes if asked for."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    raw = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    return raw.mapInArrow(_scan(contents), SCANNED + ", value binary" * contents)


def reached(nodes: DataFrame) -> DataFrame:
    """Pointer jumping: (file, start) of the nodes on the chain that starts at offset 0 of each file.

    ``nodes`` has (file, start, next). Each round doubles the distance a pointer spans, so a file with n records takes
    log2(n) + 1 rounds over narrow rows. Keys are (file, offset): no file and no record gathers many rows.
    """
    at = settled(nodes.withColumn("hit", F.col("start") == 0), "warc-jump-0")
    hits, k = at.where("hit").count(), 0
    while True:
        k += 1
        seen = at.where("hit AND next IS NOT NULL").select("file", F.col("next").alias("start"), F.lit(True).alias("seen"))
        ahead = at.select("file", F.col("start").alias("next"), F.col("next").alias("after"))
        step = at.join(seen, ["file", "start"], "left").join(ahead, ["file", "next"], "left")
        at = settled(step.select("file", "start", F.col("after").alias("next"), (F.col("hit") | F.col("seen").isNotNull()).alias("hit")), f"warc-jump-{k}")
        more = at.where("hit").count()
        if more == hits:
            return at.where("hit").select("file", "start")
        hits = more


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``: file, type, record_id, refers_to, uri, digest, http_length, payload.

    The payload is what follows the HTTP head; ``http_length`` is the length that this head states. File names stand
    for themselves as 64-bit hashes inside.
    """
    seen = pieces(spark, path, contents=False).withColumn("f", F.xxhash64("file")).drop("file")
    seen = settled(seen, "warc-pieces")
    per_block = seen.groupBy("f", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    base = F.coalesce(F.sum("bytes").over(Window.partitionBy("f").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the last piece of a file has no magic behind it
    stops = F.sum("bytes").over(Window.partitionBy("f")) - len(MAGIC)
    placed = seen.join(per_block.withColumns({"base": base, "stops": stops}).drop("bytes"), ["f", "block"])
    placed = settled(placed.withColumn("start", F.col("base") + F.col("rel") - len(MAGIC)).drop("base"), "warc-placed")

    nodes = placed.where("start >= 0 AND start + length <= stops").select(F.col("f").alias("file"), "start", (F.col("start") + F.col("length")).alias("next"))
    chain = reached(nodes).withColumnRenamed("file", "f").withColumn("hit", F.lit(True))
    marked = settled(placed.join(chain, ["f", "start"], "left").withColumn("hit", F.col("hit").isNotNull()), "warc-marked")
    # pieces that are not one whole record: what no chain reaches, and records cut by a magic in their payload
    broken = F.col("hit") & (F.col("length") > F.col("size") + len(MAGIC))
    files = marked.where(~F.col("hit") & (F.col("start") >= 0) | broken).select("f").distinct()
    upto = Window.partitionBy("f").orderBy("start")
    owned = marked.join(files, "f", "left_semi")
    for name, value in (("owner", F.col("start")), ("ends", F.col("start") + F.col("length"))):
        owned = owned.withColumn(name, F.last(F.when(F.col("hit"), value), ignorenulls=True).over(upto))
    part = F.col("owner").isNotNull() & (F.col("start") < F.col("ends")) & (~F.col("hit") | broken)
    odd = owned.select("f", "block", "rel", "start", "hit", F.when(part, F.col("owner")).alias("owner")).where(~F.col("hit") | F.col("owner").isNotNull())
    head = marked.where("start < 0").select("f", "block", "rel", "start", "hit", F.lit(None).cast("bigint").alias("owner"))
    odd = settled(odd.where("start >= 0").union(head).drop("hit"), "warc-odd").withColumn("odd", F.lit(True))

    rows = pieces(spark, path, contents=True).withColumn("f", F.xxhash64("file"))
    rows = rows.join(small_side(odd), ["f", "block", "rel"], "left")
    whole = rows.where("odd IS NULL").select("file", F.concat(F.lit(MAGIC).cast("binary"), "value").alias("record"))
    if not odd.where("owner IS NOT NULL").limit(1).count():
        return whole.mapInArrow(_parse, PARSED)
    cut = rows.where("owner IS NOT NULL").groupBy("file", "owner")
    cut = cut.agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("parts"))
    glued = cut.select("file", F.aggregate("parts", F.lit("").cast("binary"), lambda a, p: F.concat(a, F.lit(MAGIC).cast("binary"), p["value"])).alias("record"))
    return whole.union(glued).mapInArrow(_parse, PARSED)


PARSED = "file string, type string, record_id string, refers_to string, uri string, digest string, http_length bigint, payload binary"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in PARSED.split(", ")]
    kinds = [pa.int64() if n == "http_length" else pa.binary() if n == "payload" else pa.string() for n in names]
    for b in batches:
        out: list[tuple] = []
        for file, record in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            end = record.find(b"\r\n\r\n")
            head = fields(record[:end])
            block = record[end + 4 : end + 4 + int(head["content-length"])]
            stated = None
            if "application/http" in head.get("content-type", ""):
                http, _, payload = block.partition(b"\r\n\r\n")
                stated = fields(http).get("content-length", "")
                block, stated = payload, int(stated) if stated.isdigit() else None
            out.append((file, head.get("warc-type"), head.get("warc-record-id"), head.get("warc-refers-to"), head.get("warc-target-uri"), head.get("warc-payload-digest"), stated, block))
        cols = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
