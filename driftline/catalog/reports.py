"""Cleaning, decision rules and report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.catalog.base import (
    AXES, CANDLES_SQL, DAILY_SQL, NEWS_SQL, PREDICTIONS_SQL, PRICES_SQL, Shape, candles, daily, events, news,
    predictions, prices, query,
)
from driftline.catalog.features import wide_sql
from driftline.catalog.timejoins import MERGED_SQL, merged
from driftline.functions.numeric import blend, clip, inv_box_cox, box_cox, score_percent, confidence_percent
from driftline.functions.temporal import epoch_us, freq_of_granularity, granularity_of, safe_lag
from driftline.functions.text import AxisRule
from driftline.operators import buckets, clean, quality
from driftline.plans import signals
from driftline.session import table
from driftline.sources import windows


@query(
    Shape("t", "event_id", ((6, "v"),)),
    "FINAL SELECT event_id, date_trunc('second', ts) AS t, value AS v FROM events WHERE event_type NOT IN ('error', 'signup')",
)
def coerced_text(spark, d):
    """Times and numbers written as text, some unreadable, coerced back; incomplete rows dropped."""
    e = events(spark, d)
    seconds = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    iso = F.when(F.col("event_type") == "click", F.date_format("ts", "dd/MM/yyyy HH:mm:ss")).otherwise(seconds)
    raw = e.select(
        "event_id",
        F.when(F.col("event_type") == "signup", "not a time").otherwise(iso).alias("t"),
        F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string")).alias("v"),
    )
    out = clean.drop_null(clean.coerce_ts(clean.coerce_numeric(raw, ["v"]), "t"))
    return out.withColumn("t", F.col("t").cast("timestamp_ntz"))


@query(
    Shape("ts", "event_id"),
    "FINAL SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12 23:59:59'",
)
def between_days(spark, d):
    return clean.between_days(events(spark, d).select("event_id", "ts"), "ts", "2024-01-05", "2024-01-12")


@query(
    Shape("lang source", "doc_id"),
    "FINAL SELECT * FROM documents WHERE regexp_matches(lower(text || ' '), 'license|worthless|bitcoin|btc')",
)
def relevant_documents(spark, d):
    docs = table(spark, d, "documents").withColumn("description", F.lit(None).cast("string"))
    return clean.relevant_only(docs, "text", "description", "license|worthless|bitcoin|btc")


@query(
    Shape("role", "conv_id turn n"),
    "FINAL SELECT conv_id, turn, role, length(' ' || text) AS n FROM conversations WHERE regexp_matches(text, '\\S')",
)
def nonblank_turns(spark, d):
    turns = table(spark, d, "conversations").withColumnRenamed("text", "description")
    return clean.nonblank_text(turns).withColumn("n", F.length("text_nlp"))


@query(
    Shape("", "n_before n_from all_from"),
    """FINAL SELECT count(*) FILTER (ts < TIMESTAMP '2024-01-12') AS n_before, count(*) FILTER (ts >= TIMESTAMP '2024-01-12') AS n_from,
    CAST(bool_and(ts >= TIMESTAMP '2024-01-12') AS INT) AS all_from FROM events""",
)
def cutoff_counts(spark, d):
    return clean.cutoff_counts(events(spark, d), "ts", "2024-01-12")


@query(Shape("ts", "event_id"), "FINAL SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-12'")
def since_cutoff(spark, d):
    return clean.since_cutoff(events(spark, d), "ts", "2024-01-12")


@query(
    Shape("ts scope", "event_id"),
    "FINAL SELECT *, 'recent' AS scope FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 48 HOUR",
)
def recent_rows(spark, d):
    return clean.recent_or_all(events(spark, d), "ts", "2024-01-31")


@query(Shape("ts scope", "event_id"), "FINAL SELECT *, 'all' AS scope FROM events")
def recent_rows_fallback(spark, d):
    return clean.recent_or_all(events(spark, d), "ts", "2024-06-30")


WANTED = ["sentiment_mean_BTC", "absent_feature", "sentiment_total_mean", "sentiment_count_MACRO"]


@query(
    Shape("bucket", "", ((5, " ".join(WANTED)),)),
    f"""WITH {NEWS_SQL}, {wide_sql('series_id', '1 hour')} FINAL SELECT bucket, CAST(sentiment_mean_BTC AS FLOAT) AS sentiment_mean_BTC,
    0.0 AS absent_feature, CAST(sentiment_total_mean AS FLOAT) AS sentiment_total_mean,
    coalesce(sentiment_count_MACRO, 0) AS sentiment_count_MACRO FROM wide""",
)
def aligned_model_inputs(spark, d):
    """Stored features with target columns, cut to what a model expects."""
    wide = buckets.sentiment_null_policy(buckets.sentiment_wide(news(spark, d), ["series_id"], "published_at", "1 hour", AXES))
    leaky = wide.withColumns({"target_up": F.lit(1), "future_return": F.lit(0.1)})
    return clean.fill_and_cast(clean.align_features(clean.drop_leakage(leaky), WANTED, ["bucket"]), WANTED)


@query(
    Shape("datetime model", "", ((1, "pred"),)),
    f"WITH {MERGED_SQL} FINAL SELECT * FROM (UNPIVOT (SELECT datetime, CAST(y_pred_rf AS DOUBLE) AS y_pred_rf, CAST(y_pred_gbt AS DOUBLE) AS y_pred_gbt FROM merged) ON y_pred_rf, y_pred_gbt INTO NAME model VALUE pred)",
)
def unpivoted_models(spark, d):
    return clean.unpivot_models(merged(spark, d), "datetime", ["y_pred_rf", "y_pred_gbt"])


@query(
    Shape("day model", "", ((7, "mean_pred"),)),
    f"""WITH {PREDICTIONS_SQL} FINAL SELECT CAST(datetime AS DATE) AS day, 'y_pred_' || model AS model, avg(y_pred) AS mean_pred
    FROM predictions GROUP BY 1, 2""",
)
def daily_model_mean(spark, d):
    long = clean.unpivot_models(merged(spark, d), "datetime", ["y_pred_rf", "y_pred_gbt"])
    return quality.daily_model_mean(long, "datetime")


@query(
    Shape("series_id ts direction"),
    f"WITH {CANDLES_SQL} FINAL SELECT *, CASE WHEN open <= close THEN 'up' ELSE 'down' END AS direction FROM candles",
)
def candle_directions(spark, d):
    return candles(spark, d).withColumn("direction", clean.candle_direction())


@query(
    Shape("event_type ts", "user_id event_id", ((4, "value"),)),
    """FINAL SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def first_event_per_user_and_type(spark, d):
    return clean.dedupe_first(events(spark, d), ["user_id", "event_type"], ["ts", "event_id"])


@query(
    Shape("event_type hour", "n_copies"),
    """FINAL SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n_copies FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicated_hours(spark, d):
    e = events(spark, d).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    return clean.dup_report(e, ["event_type", "hour"])


@query(
    Shape("day axis", "event_id"),
    """FINAL SELECT event_id, CAST(unnest(generate_series(CAST(ts AS DATE), CAST(ts + INTERVAL 30 HOUR AS DATE), INTERVAL 1 DAY)) AS DATE) AS day, axis
    FROM events, (VALUES ('BTC'), ('MACRO'), ('TECH')) v(axis)""",
)
def request_plan(spark, d):
    """Days and axes to fetch around every event."""
    e = events(spark, d).select("event_id", "ts")
    return windows.request_plan(e, "ts", F.col("ts") + F.expr("INTERVAL 30 HOUR"), AXES)


@query(
    Shape("day axis", "user_id"),
    f"""WITH {NEWS_SQL}, span AS (SELECT user_id, min(published_at) AS a, max(published_at) AS z FROM news GROUP BY 1),
    plan AS (SELECT user_id, CAST(unnest(generate_series(CAST(a AS DATE), CAST(z AS DATE), INTERVAL 1 DAY)) AS DATE) AS day, axis
      FROM span, (VALUES ('BTC'), ('MACRO'), ('TECH')) v(axis))
    FINAL SELECT * FROM plan p WHERE NOT EXISTS (SELECT 1 FROM news n WHERE n.axis = p.axis AND CAST(n.published_at AS DATE) = p.day
      AND n.user_id = p.user_id)""",
)
def missing_requests(spark, d):
    n = news(spark, d)
    span = n.groupBy("user_id").agg(F.min("published_at").alias("a"), F.max("published_at").alias("z"))
    plan = windows.request_plan(span, "a", "z", AXES)
    return windows.missing_requests(plan, n, by=["user_id"])


@query(
    Shape("series_id ts", "", ((4, "close"),)),
    f"""WITH {CANDLES_SQL} FINAL SELECT * FROM candles
    WHERE ts BETWEEN TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 168 HOUR AND TIMESTAMP '2024-01-20 12:00:00'""",
)
def candle_window_4h(spark, d):
    """The bound is set on the points, so that it reaches the scan."""
    points = windows.candle_window(prices(spark, d), "ts", "4h", now="2024-01-20 12:00:00", bars="1 hour")
    return buckets.ohlc_resample(points, ["series_id"], "ts", "price", "1 hour", "event_id").withColumnRenamed("bucket", "ts")


E0, E1 = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
RULES = (
    AxisRule("BTC", ("license", "worthless", "that"), ("orneth",)),
    AxisRule("TECH", ("copyright", "thouou")),
    AxisRule("MACRO", ("and", "que")),
)


@query(
    Shape("lang axis", "doc_id"),
    rf"""WITH t AS (SELECT doc_id, lang, unnest(list_filter([
      CASE WHEN regexp_matches(lower(text), '{E0}(license|worthless|that){E1}') AND NOT regexp_matches(lower(text), '{E0}(orneth){E1}') THEN 'BTC' END,
      CASE WHEN regexp_matches(lower(text), '{E0}(copyright|thouou){E1}') THEN 'TECH' END,
      CASE WHEN regexp_matches(lower(text), '{E0}(and|que){E1}') THEN 'MACRO' END], lambda x: x IS NOT NULL)) AS axis FROM documents)
    FINAL SELECT * FROM t""",
)
def tagged_documents(spark, d):
    return windows.tag_axis(table(spark, d, "documents").select("doc_id", "lang", "text"), "text", RULES)


@query(
    Shape("day", "n", ()),
    """WITH days AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
    spine AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM days)
    FINAL SELECT day, coalesce(n, 0) AS n FROM spine LEFT JOIN days USING (day)""",
)
def articles_per_day(spark, d):
    return buckets.volume_per_day(events(spark, d), [], "ts")


@query(
    Shape("day", "user_id n"),
    """WITH days AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
    spine AS (SELECT user_id, CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM days GROUP BY 1)
    FINAL SELECT user_id, day, coalesce(n, 0) AS n FROM spine LEFT JOIN days USING (user_id, day)""",
)
def articles_per_day_and_user(spark, d):
    return buckets.volume_per_day(events(spark, d), ["user_id"], "ts")


RESAMPLE_SQL = """labels_of AS (
  SELECT series_id, price, '1 hour' AS freq, date_trunc('hour', ts) AS bucket FROM prices UNION ALL
  SELECT series_id, price, '4 hours', time_bucket(INTERVAL '4 hours', ts) FROM prices UNION ALL
  SELECT series_id, price, '1 day', date_trunc('day', ts) FROM prices UNION ALL
  SELECT series_id, price, 'month', date_trunc('month', ts) + INTERVAL 1 MONTH - INTERVAL 1 DAY FROM prices UNION ALL
  SELECT series_id, price, 'quarter', date_trunc('quarter', ts) + INTERVAL 3 MONTH - INTERVAL 1 DAY FROM prices UNION ALL
  SELECT series_id, price, 'year', date_trunc('year', ts) + INTERVAL 1 YEAR - INTERVAL 1 DAY FROM prices)"""


@query(
    Shape("series_id freq bucket", "", ((6, "price"),)),
    f"WITH {PRICES_SQL}, {RESAMPLE_SQL} FINAL SELECT series_id, freq, bucket, avg(price) AS price FROM labels_of GROUP BY 1, 2, 3",
)
def resampled_means(spark, d):
    freqs = ["1 hour", "4 hours", "1 day", "month", "quarter", "year"]
    return buckets.resample_mean(prices(spark, d), ["series_id"], "ts", freqs, ["price"])


@query(
    Shape("series_id ts", "", ((4, "price"),)),
    f"""WITH {DAILY_SQL}, spine AS (SELECT series_id, unnest(generate_series(min(ts), max(ts), INTERVAL 1 DAY)) AS ts FROM daily GROUP BY 1)
    FINAL SELECT spine.*, price FROM spine LEFT JOIN daily USING (series_id, ts)""",
)
def regular_daily_spine(spark, d):
    return buckets.regular_spine(daily(spark, d), ["series_id"], "ts", "1 DAY")


@query(
    Shape("axis label", "pos_hits neg_hits", ((7, "score"),)),
    f"""WITH {NEWS_SQL} FINAL SELECT axis, coalesce(avg(sentiment_score), 0) AS score,
    count(*) FILTER (sentiment_score > 0.05) AS pos_hits, count(*) FILTER (sentiment_score < -0.05) AS neg_hits,
    CASE WHEN coalesce(avg(sentiment_score), 0) > 0.05 THEN 'POSITIVE' WHEN coalesce(avg(sentiment_score), 0) < -0.05 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS label
    FROM news GROUP BY 1""",
)
def sentiment_summary(spark, d):
    return quality.sentiment_summary(news(spark, d), ["axis"], "sentiment_score")


@query(
    Shape("axis", "n_positive n_negative n_neutral", ((7, "mean std"), (6, "pct_positive pct_negative pct_neutral"))),
    f"""WITH {NEWS_SQL} FINAL SELECT axis, avg(sentiment_score) AS mean, stddev_samp(sentiment_score) AS std,
    count(*) FILTER (sentiment_score > 0) AS n_positive, count(*) FILTER (sentiment_score < 0) AS n_negative,
    count(*) FILTER (sentiment_score = 0) AS n_neutral, 100.0 * count(*) FILTER (sentiment_score > 0) / count(*) AS pct_positive,
    100.0 * count(*) FILTER (sentiment_score < 0) / count(*) AS pct_negative, 100.0 * count(*) FILTER (sentiment_score = 0) / count(*) AS pct_neutral
    FROM news GROUP BY 1""",
)
def score_stats(spark, d):
    return quality.score_stats(news(spark, d), ["axis"], "sentiment_score")


@query(
    Shape("event_type first_ts last_ts", "n_rows n_sources", ((3, "duration_s"),)),
    """FINAL SELECT event_type, min(ts) AS first_ts, max(ts) AS last_ts, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_s,
    count(*) AS n_rows, count(DISTINCT user_id) AS n_sources FROM events GROUP BY 1""",
)
def coverage_by_type(spark, d):
    return quality.coverage(events(spark, d), ["event_type"], "ts", "user_id")


def keyword_sql(words, column="text", whole=False):
    test = lambda w: rf"regexp_matches(lower({column}), '{E0}{w}{E1}')" if whole else f"contains(lower({column}), '{w}')"
    return " + ".join(f"CAST({test(w)} AS INT)" for w in words)


def keyword_query(words_pos, words_neg, whole):
    return f"""WITH h AS (SELECT lang, source, sum({keyword_sql(words_pos, whole=whole)}) AS pos_hits, sum({keyword_sql(words_neg, whole=whole)}) AS neg_hits
      FROM documents GROUP BY 1, 2), s AS (SELECT *, (pos_hits - neg_hits) / greatest(pos_hits + neg_hits, 1) AS score FROM h)
      FINAL SELECT *, CASE WHEN score > 0.15 THEN 'POSITIVE' WHEN score < -0.15 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS label FROM s"""


KEYWORDS = Shape("lang source label", "pos_hits neg_hits", ((7, "score"),))
GOOD, BAD = ("the", "and", "del", "que", "up"), ("that", "for", "est", "ban", "down")


@query(KEYWORDS, keyword_query(signals.POSITIVE_WORDS, signals.NEGATIVE_WORDS, False))
def keyword_sentiment(spark, d):
    return signals.keyword_sentiment(table(spark, d, "documents"), ["lang", "source"], "text")


@query(KEYWORDS, keyword_query(GOOD, BAD, False))
def keyword_sentiment_own_words(spark, d):
    docs = table(spark, d, "documents")
    return signals.keyword_sentiment(docs, ["lang", "source"], "text", positive=GOOD, negative=BAD)


@query(KEYWORDS, keyword_query(GOOD, BAD, True))
def keyword_sentiment_whole_words(spark, d):
    docs = table(spark, d, "documents")
    return signals.keyword_sentiment(docs, ["lang", "source"], "text", whole_word=True, positive=GOOD, negative=BAD)


@query(
    Shape("", "event_id", ((7, "sentiment_score"),)),
    """FINAL SELECT event_id, greatest(-1, least(1, 0.7 * ((value - 50) / 60) + 0.3 * ((user_id % 21 - 10) / 10))) AS sentiment_score FROM events""",
)
def ensemble_scores(spark, d):
    e = events(spark, d)
    a, b = (F.col("value") - 50) / 60, (F.col("user_id") % 21 - 10) / 10
    return e.select("event_id", blend(a, b).alias("sentiment_score"))


@query(
    Shape("series_id ts direction", "", ((6, "move"),)),
    f"""WITH {CANDLES_SQL}, m AS (SELECT *, (close - open) / nullif(open, 0) AS move FROM candles)
    FINAL SELECT *, CASE WHEN move > 0.002 THEN 'UP' WHEN move < -0.002 THEN 'DOWN' ELSE 'NEUTRAL' END AS direction FROM m""",
)
def direction_from_price(spark, d):
    return candles(spark, d).withColumns(signals.direction_from_price("open", "close"))


@query(
    Shape("datetime final_label label", "event_id sentiment_percent confidence_percent"),
    f"""WITH {NEWS_SQL}, {PREDICTIONS_SQL}, s AS (SELECT n.event_id, n.published_at AS datetime, p.y_pred,
      greatest(p.proba_up, 1 - p.proba_up) AS confidence, sentiment_score AS score,
      CASE WHEN sentiment_score > 0.05 THEN 'POSITIVE' WHEN sentiment_score < -0.05 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS label
      FROM news n LEFT JOIN predictions p ON n.event_id = p.event_id AND p.model = 'rf'),
    c AS (SELECT *, CASE label WHEN 'POSITIVE' THEN 1 WHEN 'NEGATIVE' THEN 0 END AS mood FROM s)
    FINAL SELECT event_id, datetime, label, CASE WHEN y_pred IS NOT NULL AND (mood IS NULL OR mood = y_pred) THEN CASE y_pred WHEN 1 THEN 'UP' ELSE 'DOWN' END
      WHEN y_pred IS NOT NULL THEN 'MIXED' WHEN mood IS NOT NULL THEN CASE mood WHEN 1 THEN 'UP' ELSE 'DOWN' END ELSE 'NEUTRAL' END AS final_label,
      greatest(0, least(100, CAST(trunc((score + 1) * 50) AS INT))) AS sentiment_percent,
      CASE WHEN confidence IS NULL THEN 50 ELSE greatest(0, least(100, CAST(trunc(confidence * 100) AS INT))) END AS confidence_percent FROM c""",
)
def final_signals(spark, d):
    rf = predictions(spark, d).where("model = 'rf'").select("event_id", "y_pred", "proba_up")
    p = F.col("proba_up")
    both = news(spark, d).join(rf, "event_id", "left").select(
        "event_id",
        F.col("published_at").alias("datetime"),
        "y_pred",
        F.greatest(p, 1 - p).alias("confidence"),
        F.col("sentiment_score").alias("score"),
        signals.label_by("sentiment_score", 0.05).alias("label"),
    )
    return signals.final_signal(both, "y_pred", "confidence", "score", "label")


@query(
    Shape("granularity freq", "event_id lag_cap"),
    """WITH g AS (SELECT event_id, CASE WHEN value * 600 BETWEEN 3500 AND 3700 THEN '1-hour' WHEN value * 600 BETWEEN 12600 AND 16200 THEN '4-hour'
      WHEN value * 600 BETWEEN 82800 AND 90000 THEN '1-day' ELSE 'other' END AS granularity, user_id FROM events)
    FINAL SELECT event_id, granularity, CASE granularity WHEN '1-hour' THEN '1 hour' WHEN '4-hour' THEN '4 hours' WHEN '1-day' THEN '1 day' END AS freq,
      greatest(10, least(168, 300, user_id - 2)) AS lag_cap FROM g""",
)
def granularities(spark, d):
    e = events(spark, d)
    g = granularity_of(F.col("value") * 600)
    return e.select("event_id", g.alias("granularity"), freq_of_granularity(g).alias("freq"), safe_lag("1-hour", 24, F.col("user_id")).alias("lag_cap"))


@query(
    Shape("", "event_id us", ((6, "there back clipped"),)),
    """FINAL SELECT event_id, epoch_us(ts) AS us, (pow(value + 1, 0.5) - 1) / 0.5 AS there, value + 1 AS back, greatest(10, least(90, value)) AS clipped FROM events""",
)
def scalar_transforms(spark, d):
    x = F.col("value") + 1
    return events(spark, d).select(
        "event_id",
        epoch_us("ts").alias("us"),
        box_cox(x, 0.5).alias("there"),
        inv_box_cox(box_cox(x, 0.5), 0.5).alias("back"),
        clip("value", 10, 90).alias("clipped"),
    )


@query(
    Shape("", "event_id a b"),
    """FINAL SELECT event_id, greatest(0, least(100, CAST(trunc(((value - 50) / 100 + 1) * 50) AS INT))) AS a,
    greatest(0, least(100, CAST(trunc(value / 100 * 100) AS INT))) AS b FROM events""",
)
def whole_percentages(spark, d):
    return events(spark, d).select(
        "event_id", score_percent((F.col("value") - 50) / 100).alias("a"), confidence_percent(F.col("value") / 100).alias("b")
    )
