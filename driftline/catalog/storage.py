"""Readers and writers: tables go out through a sink and come back through a reader, payloads are packed and parsed."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.catalog.base import (
    AXES, CANDLES_SQL, INDEX_SQL, NEWS_SQL, PREDICTIONS_SQL, Shape, candles, daily_index, events, news,
    predictions, query,
)
from driftline.catalog.features import wide_sql
from driftline.operators import buckets
from driftline.session import join_same, scratch_path, table
from driftline.sources import files, payloads, sinks

NTZ = "timestamp_ntz"


@query(
    Shape("datetime", "", ((4, "open high low close"),)),
    f"WITH {CANDLES_SQL} FINAL SELECT *, ts AS datetime FROM candles WHERE series_id <> 'error'",
)
def ohlc_csv_round_trip(spark, d):
    """Candles exported as ';' CSV, one series with an unreadable price, read back by the strict reader."""
    path = scratch_path(spark, "ohlc-csv")
    out = candles(spark, d).select(
        F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("datetime"),
        "open",
        "high",
        "low",
        F.when(F.col("series_id") == "error", "n/a").otherwise(F.col("close").cast("string")).alias("close"),
    )
    sinks.export_csv(out, path, ";")
    return files.read_ohlc(spark, path).withColumn("datetime", F.col("datetime").cast(NTZ))


@query(
    Shape("datetime", "", ((4, "price close"),)),
    f"""WITH {CANDLES_SQL} FINAL SELECT ts AS datetime, CASE WHEN series_id <> 'error' THEN close END AS close,
    CASE WHEN series_id <> 'error' THEN close END AS price FROM candles WHERE series_id <> 'view'""",
)
def lenient_prices_round_trip(spark, d):
    path = scratch_path(spark, "prices-csv")
    out = candles(spark, d).select(
        F.when(F.col("series_id") == "view", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("date"),
        F.when(F.col("series_id") == "error", "n/a").otherwise(F.col("close").cast("string")).alias("close"),
    )
    sinks.export_csv(out, path, ";")
    return files.read_prices(spark, path).withColumn("datetime", F.col("datetime").cast(NTZ))


ARTICLES_SQL = """articles AS (SELECT DISTINCT TIMESTAMP '2024-01-01' + INTERVAL (length(text)) MINUTE AS published_at, lang AS title, source FROM documents)"""


def articles(spark, d):
    docs = table(spark, d, "documents")
    at = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, length(text), 0)")
    return docs.select(at.alias("published_at"), F.col("lang").alias("title"), "text", "source", "doc_id")


@query(Shape("published_at title source"), f"WITH {ARTICLES_SQL} FINAL SELECT * FROM articles")
def news_csv_round_trip(spark, d):
    """Whole texts with line breaks and quotes survive the file; copies by (time, title, source) are reduced to one."""
    path = scratch_path(spark, "news-csv")
    out = articles(spark, d).select(
        F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("published_at"), "title", F.col("text").alias("description"), "source"
    )
    sinks.export_csv(out, path)
    return files.read_news(spark, path).withColumn("published_at", F.col("published_at").cast(NTZ))


@query(
    Shape("published_at", "n n_texts"),
    """WITH a AS (SELECT TIMESTAMP '2024-01-01' + INTERVAL (length(text)) MINUTE AS published_at, text FROM documents)
    FINAL SELECT published_at, count(*) AS n, count(DISTINCT text) AS n_texts FROM a GROUP BY 1""",
)
def news_any_time_name(spark, d):
    """The looser reader: another time column, no de-duplication."""
    path = scratch_path(spark, "news-any")
    out = articles(spark, d).select(F.date_format("published_at", "yyyy-MM-dd HH:mm:ss").alias("publishedAt"), "title", "text")
    sinks.export_csv(out, path)
    got = files.read_news_any_ts(spark, path)
    return got.groupBy(F.col("published_at").cast(NTZ).alias("published_at")).agg(
        F.count("*").alias("n"), F.count_distinct("text").alias("n_texts")
    )


@query(Shape("datetime", "fear_greed_index"), f"WITH {INDEX_SQL} FINAL SELECT * FROM daily_index")
def index_csv_round_trip(spark, d):
    """A file whose value column has another name and whose first column is the time."""
    path = scratch_path(spark, "index-csv")
    out = daily_index(spark, d).select(
        F.date_format(F.col("datetime") + F.expr("INTERVAL 17 MINUTE"), "yyyy-MM-dd HH:mm:ss").alias("day"),
        F.col("fear_greed_index").alias("fng_value"),
    )
    sinks.export_csv(out, path)
    return files.read_index(spark, path).withColumn("datetime", F.col("datetime").cast(NTZ))


@query(
    Shape("datetime", "y_pred y_true", ((6, "proba_up"),)),
    f"WITH {PREDICTIONS_SQL} FINAL SELECT date_trunc('second', datetime) AS datetime, y_pred, y_true, proba_up FROM predictions",
)
def predictions_csv_round_trip(spark, d):
    path = scratch_path(spark, "predictions-csv")
    p = predictions(spark, d)
    out = p.select(
        F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("y_pred").alias("forecast"),
        F.col("y_true").alias("actual"),
        "proba_up",
    )
    sinks.export_csv(out, path)
    return files.read_predictions(spark, path).withColumn("datetime", F.col("datetime").cast(NTZ))


@query(
    Shape("timestamp", "total_count", ((6, "sentiment_total_mean"),)),
    f"""WITH {NEWS_SQL}, {wide_sql('series_id', '4 hours')} FINAL SELECT bucket AS timestamp, total_count, sentiment_total_mean FROM wide""",
)
def feature_store_round_trip(spark, d):
    """Two resolutions written side by side, one replaced, one read back through partition pruning."""
    root = scratch_path(spark, "features")
    for res, freq in (("1h", "1 hour"), ("4h", "4 hours"), ("4h", "4 hours")):
        wide = buckets.sentiment_null_policy(buckets.sentiment_wide(news(spark, d), ["series_id"], "published_at", freq, AXES))
        sinks.write_features(wide.withColumnRenamed("bucket", "timestamp"), root, "sentiment", res)
    return files.read_feature_dataset(spark, root, "sentiment", "4h")


@query(
    Shape("event_type", "revision n"),
    "FINAL SELECT event_type, r AS revision, count(*) AS n FROM events, (VALUES (1), (2)) v(r) GROUP BY 1, 2",
)
def versioned_writes(spark, d):
    root = scratch_path(spark, "revisions")
    for _ in range(2):
        sinks.write_versioned(events(spark, d).select("event_type", "value"), root)
    return spark.read.parquet(root).groupBy("event_type", "revision").agg(F.count("*").alias("n"))


@query(
    Shape("timestamp task model resolution", "prediction", ((6, "proba_up confidence"),)),
    f"""WITH {PREDICTIONS_SQL} FINAL SELECT datetime AS timestamp, 'price' AS task, model, '1h' AS resolution, CAST(proba_up >= 0.5 AS INT) AS prediction,
    proba_up, greatest(proba_up, 1 - proba_up) AS confidence FROM predictions""",
)
def prediction_log(spark, d):
    from driftline.plans.score import decide

    root = scratch_path(spark, "log")
    for model in ("rf", "gbt"):
        rows = decide(predictions(spark, d).where(F.col("model") == model)).withColumnRenamed("datetime", "timestamp")
        sinks.write_prediction_log(rows.withColumns({"task": F.lit("price"), "resolution": F.lit("1h")}), root)
    return spark.read.parquet(root)


@query(
    Shape("event_type", "n", ((4, "total"),)),
    """FINAL SELECT event_type, count(*) AS n, sum(CASE WHEN event_type = 'view' THEN value + 1 ELSE value END) AS total FROM events GROUP BY 1""",
)
def refreshed_partition(spark, d):
    """One partition of landed data is overwritten, the others stay."""
    root = scratch_path(spark, "landed")
    e = events(spark, d).select("event_type", "event_id", "value")
    sinks.refresh(e, root, ["event_type"])
    sinks.refresh(e.where("event_type = 'view'").withColumn("value", F.col("value") + 1), root, ["event_type"])
    return spark.read.parquet(root).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


PAGE_ROWS = 200  # rows of a payload, about


def paged(df, keys, ids):
    """Add ``page``: rows of a group are dealt by their ids to so many pages that each holds a bounded number."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    page = F.pmod(F.xxhash64(*ids), F.ceil(F.col("_n") / PAGE_ROWS))
    return join_same(df, counts, keys).withColumn("page", page).drop("_n")


@query(
    Shape("datetime", "", ((2, "fear_greed_index"),)),
    "FINAL SELECT date_trunc('second', ts) AS datetime, value AS fear_greed_index FROM events",
)
def index_payloads(spark, d):
    """Payloads per user and day, in bounded pages, with epoch seconds and values as text."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    item = F.struct(F.col("value").cast("string").alias("value"), seconds.alias("timestamp"))
    rows = paged(events(spark, d).withColumn("day", F.to_date("ts")), ["user_id", "day"], ["event_id"])
    docs = rows.groupBy("user_id", "day", "page").agg(F.to_json(F.struct(F.collect_list(item).alias("data"))).alias("payload"))
    return payloads.parse_index(docs).withColumn("datetime", F.col("datetime").cast(NTZ))


@query(
    Shape("datetime", "", ((4, "open high low close"),)),
    f"WITH {CANDLES_SQL} FINAL SELECT ts AS datetime, open, high, low, close FROM candles",
)
def kline_payloads(spark, d):
    """Positional candle arrays, one payload per series and day."""
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    nums = [F.col(c).cast("string") for c in ("open", "high", "low", "close")]
    row = F.array(ms, *nums, *[F.lit("0")] * 7)
    docs = candles(spark, d).groupBy("series_id", F.to_date("ts").alias("day")).agg(F.to_json(F.collect_list(row)).alias("payload"))
    return payloads.parse_klines(docs).withColumn("datetime", F.col("datetime").cast(NTZ))


@query(
    Shape("published_at source axis", "n_chars"),
    """FINAL SELECT TIMESTAMP '2024-01-01' + INTERVAL (length(text)) MINUTE AS published_at, source, 'TECH' AS axis, length(text) AS n_chars FROM documents WHERE lang <> 'de'""",
)
def article_payloads(spark, d):
    """News responses built from the documents, in bounded pages; responses of one language report an error."""
    article = F.struct(
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss").alias("publishedAt"),
        F.col("title"),
        F.col("text").alias("description"),
        F.struct(F.col("source").alias("name")).alias("source"),
    )
    status = F.when(F.col("title") == "de", "error").otherwise("ok").alias("status")
    rows = articles(spark, d).withColumn("day", F.to_date("published_at"))
    docs = (
        paged(rows, ["title", "source", "day"], ["doc_id"])
        .groupBy("title", "source", "day", "page")
        .agg(F.collect_list(article).alias("articles"))
        .select(F.to_json(F.struct(status, "articles")).alias("payload"), F.lit("TECH").alias("axis"))
    )
    out = payloads.parse_articles(docs)
    return out.withColumns({"published_at": F.col("published_at").cast(NTZ), "n_chars": F.length("description")})


@query(
    Shape("", "event_id k"),
    "FINAL SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def event_properties(spark, d):
    return events(spark, d).select("event_id", F.from_json("props", "struct<k:bigint>")["k"].alias("k"))


@query(
    Shape("t", "event_id", ((4, "value"),)),
    "FINAL SELECT event_id, date_trunc('second', ts) AS t, value FROM events",
)
def older_dataset_names(spark, d):
    """Time under an older name, read by the reader that accepts six of them; then by the strict one."""
    old = events(spark, d).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("publishedAt"), "value")
    again = files.as_old_dataset(old, "datetime").withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))
    return files.as_strict_dataset(again, "datetime", "yyyy-MM-dd HH:mm:ss").withColumn("t", F.col("datetime").cast(NTZ))
