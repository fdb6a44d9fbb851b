"""Text scoring, direction models, routing and fused predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftline.catalog.base import AXES, BARS, NEWS_SQL, PRICES_SQL, Shape, candles, events, news, prices, query
from driftline.catalog.features import price_sql, wide_sql
from driftline.functions.temporal import freq_of
from driftline.operators import buckets, rolling
from driftline.operators.backtest import classification_metrics, time_split
from driftline.plans import score
from driftline.plans.price import PROFILES, price_features
from driftline.session import settle, table
from driftline.sources.windows import candle_window, live_days, newest


def _word_scorer():
    """A stand-in for a text model: the label follows which of two words is the more frequent."""

    def run(texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for t in texts:
            a, b = t.count("the"), t.count("que")
            out.append(("positive", 0.75) if a > b else ("negative", 0.5) if b > a else ("neutral", 0.9))
        return out

    return run


@query(
    Shape("lang", "doc_id", ((6, "score blended"),)),
    """WITH c AS (SELECT doc_id, lang, (length(text) - length(replace(text, 'the', ''))) // 3 AS a, (length(text) - length(replace(text, 'que', ''))) // 3 AS b FROM documents),
    s AS (SELECT *, CASE WHEN a > b THEN 0.75::DOUBLE WHEN b > a THEN -0.5::DOUBLE ELSE 0.0::DOUBLE END AS score FROM c)
    FINAL SELECT *, greatest(-1, least(1, 0.7::DOUBLE * score + 0.3::DOUBLE * sign(a - b))) AS blended FROM s""",
)
def scored_documents(spark, d):
    """Batched text scoring in Python workers, then the blend with a native score."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    got = score.score_text(docs, "text", _word_scorer)
    count = lambda w: (F.length("text") - F.length(F.replace("text", F.lit(w), F.lit("")))) / len(w)
    native = got.withColumn("native", F.signum(count("the") - count("que")))
    return score.ensemble(native, "score", "native", "blended").drop("text")


@query(
    Shape("task model resolution"),
    """WITH f AS (SELECT DISTINCT event_type || CASE WHEN value > 100 THEN '_price' WHEN value > 50 THEN '_clf' ELSE '' END ||
      CASE WHEN user_id > 100 THEN '_1h' WHEN user_id > 50 THEN '_4h' ELSE '_2h' END || '.joblib' AS file FROM events)
    FINAL SELECT DISTINCT CASE WHEN contains(file, 'price') THEN 'price' ELSE 'sentiment' END AS task, regexp_extract(file, '^(.+)_(1h|4h|24h)', 1) AS model,
      regexp_extract(file, '^(.+)_(1h|4h|24h)', 2) AS resolution FROM f WHERE regexp_matches(file, '^(.+)_(1h|4h|24h)[.]')""",
)
def model_inventory(spark, d):
    return score.model_inventory(model_files(spark, d))


def model_files(spark, d):
    e = events(spark, d)
    kind = F.when(F.col("value") > 100, "_price").when(F.col("value") > 50, "_clf").otherwise("")
    res = F.when(F.col("user_id") > 100, "_1h").when(F.col("user_id") > 50, "_4h").otherwise("_2h")
    return e.select(F.concat("event_type", kind, res, F.lit(".joblib")).alias("file")).distinct()


@query(
    Shape("task resolution model msg", "event_id"),
    """WITH f AS (SELECT DISTINCT event_type || CASE WHEN value > 100 THEN '_price' WHEN value > 50 THEN '_clf' ELSE '' END AS model,
      CASE WHEN user_id > 100 THEN '1h' WHEN user_id > 50 THEN '4h' END AS resolution FROM events WHERE user_id > 50),
    inv AS (SELECT CASE WHEN contains(model, 'price') THEN 'price' ELSE 'sentiment' END AS task, * FROM f),
    r AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'volume' WHEN 'view' THEN 'price' ELSE 'sentiment' END AS task,
      CASE WHEN value > 60 THEN '24h' WHEN value > 20 THEN '4h' ELSE '1h' END AS resolution,
      CASE event_type WHEN 'view' THEN 'view_price' WHEN 'click' THEN 'click_clf' WHEN 'error' THEN NULL ELSE 'xgb_clf' END AS model FROM events)
    FINAL SELECT *, CASE WHEN task = 'volume' THEN 'task must be sentiment or price' WHEN task NOT IN (SELECT task FROM inv) THEN 'no models for task' WHEN resolution NOT IN (SELECT resolution FROM inv WHERE inv.task = r.task) THEN 'resolution not available'
      WHEN model NOT IN (SELECT model FROM inv WHERE inv.task = r.task) THEN 'model not available' END AS msg FROM r""",
)
def validated_requests(spark, d):
    asked = events(spark, d).select(
        "event_id",
        F.when(F.col("event_type") == "error", "Volume").when(F.col("event_type") == "view", "price").otherwise(" Sentiment ").alias("task"),
        F.when(F.col("value") > 60, "24h").when(F.col("value") > 20, "4H").otherwise("1h").alias("resolution"),
        F.when(F.col("event_type") == "view", "view_price").when(F.col("event_type") == "click", "click_clf").alias("model"),
    )
    return score.validate_requests(asked, score.model_inventory(model_files(spark, d)))


REQUEST_SQL = """asked AS (SELECT event_id AS request_id, CASE WHEN event_type IN ('view', 'click') THEN 'price' ELSE 'sentiment' END AS task,
    CASE WHEN value > 60 THEN '24h' WHEN value > 30 THEN '4h' WHEN value > 2 THEN '1h' ELSE '15m' END AS resolution,
    CASE event_type WHEN 'purchase' THEN 'historical' WHEN 'error' THEN 'live' WHEN 'signup' THEN 'later' ELSE 'auto' END AS mode,
    CASE WHEN event_type IN ('view', 'click') THEN 'rf_price' ELSE 'xgb_clf' END AS model,
    CASE WHEN event_type IN ('view', 'click') THEN ['purchase', 'click', 'view', 'signup', 'error'][event_id % 5 + 1] ELSE 'market' END AS series_id,
    ts + INTERVAL 3 DAY AS target_ts FROM events)"""
KINDS = ("purchase", "click", "view", "signup", "error")
COVERAGE_SQL = """covered AS (SELECT CASE WHEN event_type IN ('view', 'click') THEN 'price' ELSE 'sentiment' END AS task, r AS resolution,
    min(ts) AS first_ts, max(ts) AS last_ts FROM events, (VALUES ('1h'), ('4h')) v(r) GROUP BY 1, 2)"""
STEP_SQL = "CASE a.resolution WHEN '1h' THEN INTERVAL 1 HOUR WHEN '4h' THEN INTERVAL 4 HOUR WHEN '24h' THEN INTERVAL 24 HOUR END"


def requests(spark, d):
    e = events(spark, d)
    price = F.col("event_type").isin("view", "click")
    return e.select(
        F.col("event_id").alias("request_id"),
        F.when(price, "price").otherwise("sentiment").alias("task"),
        F.when(F.col("value") > 60, "24h").when(F.col("value") > 30, "4h").when(F.col("value") > 2, "1h").otherwise("15m").alias("resolution"),
        F.when(F.col("event_type") == "purchase", "historical")
        .when(F.col("event_type") == "error", "live")
        .when(F.col("event_type") == "signup", "later")
        .otherwise("auto")
        .alias("mode"),
        F.when(price, "rf_price").otherwise("xgb_clf").alias("model"),
        F.when(price, F.array(*map(F.lit, KINDS))[(F.col("event_id") % 5).cast("int")]).otherwise("market").alias("series_id"),
        (F.col("ts") + F.expr("INTERVAL 3 DAY")).alias("target_ts"),
    )


@query(
    Shape("task resolution target_ts mode_used msg", "request_id"),
    f"""WITH {REQUEST_SQL}, {COVERAGE_SQL}
    FINAL SELECT a.*, CASE WHEN a.resolution = '15m' THEN 'bad_resolution' WHEN mode = 'later' THEN 'bad_mode' END AS msg,
      CASE WHEN a.resolution = '15m' OR mode = 'later' THEN NULL WHEN mode = 'live' THEN 'live' WHEN mode = 'historical' AND first_ts IS NOT NULL THEN 'historical'
      WHEN mode = 'historical' THEN 'live' WHEN target_ts >= first_ts AND target_ts <= last_ts + {STEP_SQL} THEN 'historical' ELSE 'live' END AS mode_used
    FROM asked a LEFT JOIN covered c ON a.task = c.task AND a.resolution = c.resolution""",
)
def routed_requests(spark, d):
    e = events(spark, d)
    task = F.when(F.col("event_type").isin("view", "click"), "price").otherwise("sentiment")
    spans = e.groupBy(task.alias("task")).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    coverage = spans.withColumn("resolution", F.explode(F.array(F.lit("1h"), F.lit("4h"))))
    return score.route_mode(requests(spark, d), coverage)


SENT_COLS = ["sentiment_total_mean", "sentiment_mean_BTC", "absent_feature"]
PRICE_COLS = ["ret_1", "std_8", "range_norm"]


def _logit(*weights: tuple[str, float]):
    """A direction model in closed form, so that its answers can be checked."""

    def run(rows):
        z = sum((F.col(c).cast("double") * w for c, w in weights), F.lit(0.0))
        return rows.withColumn("proba_up", 1 / (1 + F.exp(-z)))

    return run


SENT_MODEL = _logit(("sentiment_total_mean", 3.0), ("sentiment_mean_BTC", 1.0))
PRICE_MODEL = _logit(("ret_1", 0.5), ("std_8", -0.1), ("range_norm", 0.2))


KEYS = ["series_id"]


def price_store(points, resolution, now=None):
    """Price features of every series; with ``now`` from the points of the live look-back alone."""
    freq = freq_of(resolution)
    if now is not None:
        points = candle_window(points, "ts", resolution, now, reach=PROFILES[resolution].reach, bars=freq)
    bars = buckets.ohlc_resample(points, KEYS, "ts", "price", freq, "event_id").withColumnRenamed("bucket", "ts")
    # one row per series and bar: the time span bounds a series, as it does for sentiment
    return price_features(bars, BARS, resolution, split=False).withColumnRenamed("ts", "timestamp")


def sentiment_store(articles, resolution, now=None):
    if now is not None:
        articles = live_days(articles, "published_at", now)
    wide = buckets.sentiment_wide(articles, KEYS, "published_at", freq_of(resolution), AXES)
    return buckets.sentiment_null_policy(wide).withColumnRenamed("bucket", "timestamp")


def stores(spark, d):
    """History and live stores per task and resolution. Live ones see only what a request at the newest time finds."""
    now = newest(events(spark, d), "ts")
    history, live = {}, {}
    for res in ("1h", "4h"):
        history[("sentiment", res)] = sentiment_store(news(spark, d), res)
        history[("price", res)] = price_store(prices(spark, d), res)
        if now is not None:
            live[("sentiment", res)] = sentiment_store(news(spark, d), res, now)
            live[("price", res)] = price_store(prices(spark, d), res, now)
    return history, live


def answers(spark, d, asked):
    history, live = stores(spark, d)
    scorers = {("sentiment", r): (SENT_MODEL, SENT_COLS) for r in ("1h", "4h")}
    scorers |= {("price", r): (PRICE_MODEL, PRICE_COLS) for r in ("1h", "4h")}
    return score.batch_predict(asked, history, live, scorers, keys=KEYS)


SENT_Z = "3.0 * CAST(CAST(sentiment_total_mean AS FLOAT) AS DOUBLE) + CAST(CAST(sentiment_mean_BTC AS FLOAT) AS DOUBLE)"
PRICE_Z = """0.5 * CAST(CAST(coalesce(ret_1, 0) AS FLOAT) AS DOUBLE) - 0.1 * CAST(CAST(coalesce(std_8, 0) AS FLOAT) AS DOUBLE)
    + 0.2 * CAST(CAST(coalesce(range_norm, 0) AS FLOAT) AS DOUBLE)"""


def store_sql(task: str, resolution: str, mode: str) -> str:
    """One store as (task, resolution, mode_used, series_id, stamp, z)."""
    hours = 1 if resolution == "1h" else 4
    head = f"SELECT '{task}' AS task, '{resolution}' AS resolution, '{mode}' AS mode_used, series_id"
    if task == "sentiment":
        seen = "" if mode == "historical" else "WHERE published_at >= date_trunc('day', (SELECT max(ts) FROM events) - INTERVAL 24 HOUR)"
        wide = wide_sql("series_id", f"{hours} hours").replace("FROM news", "FROM seen")
        return f"(WITH seen AS (SELECT * FROM news {seen}), {wide} {head}, bucket AS stamp, {SENT_Z} AS z FROM wide)"
    # 24 rows are looked back, and one more is held: 25 hours beat the 24 of the 1h look-back, 168 hours the 100 of the 4h one
    back = {"1h": 25, "4h": 168}[resolution]
    bucket = f"time_bucket(INTERVAL '{hours} hours', ts)"
    seen = "" if mode == "historical" else f"WHERE {bucket} >= (SELECT max(ts) FROM events) - INTERVAL {back} HOUR"
    return f"""(WITH bars AS (SELECT series_id, {bucket} AS ts, arg_max(price, struct_pack(a := ts, b := event_id)) AS close,
      max(price) AS high, min(price) AS low FROM prices {seen} GROUP BY 1, 2),
      {price_sql(PROFILES[resolution], 'bars')} {head}, ts AS stamp, {PRICE_Z} AS z FROM feats)"""


ALL_STORES = " UNION ALL ".join(
    f"SELECT * FROM {store_sql(t, r, m)}" for t in ("sentiment", "price") for r in ("1h", "4h") for m in ("historical", "live")
)
STORES_SQL = f"""{NEWS_SQL}, {PRICES_SQL}, stores AS ({ALL_STORES}),
  spans AS (SELECT task, resolution, series_id, min(stamp) AS first_ts, max(stamp) AS last_ts FROM stores WHERE mode_used = 'historical' GROUP BY ALL),
  routed AS (SELECT a.*, CASE WHEN a.resolution = '15m' THEN 'bad_resolution' WHEN mode = 'later' THEN 'bad_mode' END AS msg,
    CASE WHEN a.resolution = '15m' OR mode = 'later' THEN NULL WHEN mode = 'live' THEN 'live' WHEN mode = 'historical' AND first_ts IS NOT NULL THEN 'historical'
      WHEN mode = 'historical' THEN 'live' WHEN target_ts >= first_ts AND target_ts <= last_ts + {STEP_SQL} THEN 'historical' ELSE 'live' END AS mode_used
    FROM asked a LEFT JOIN spans c ON a.task = c.task AND a.resolution = c.resolution AND a.series_id = c.series_id),
  q AS (SELECT * FROM routed WHERE msg IS NULL AND resolution IN ('1h', '4h')),
  before AS (SELECT request_id, q.task, s.stamp, s.z FROM q ASOF JOIN stores s ON q.task = s.task AND q.resolution = s.resolution
    AND q.mode_used = s.mode_used AND q.series_id = s.series_id AND q.target_ts >= s.stamp),
  after AS (SELECT request_id, q.task, s.stamp, s.z FROM q ASOF JOIN stores s ON q.task = s.task AND q.resolution = s.resolution
    AND q.mode_used = s.mode_used AND q.series_id = s.series_id AND q.target_ts <= s.stamp),
  got AS (SELECT q.*, CASE WHEN b.stamp IS NULL OR epoch_us(f.stamp) - epoch_us(q.target_ts) <= epoch_us(q.target_ts) - epoch_us(b.stamp) THEN f.z ELSE b.z END AS z
    FROM q LEFT JOIN before b ON q.request_id = b.request_id AND q.task = b.task LEFT JOIN after f ON q.request_id = f.request_id AND q.task = f.task),
  answered AS (SELECT * EXCLUDE (z, msg), 1 / (1 + exp(-z)) AS proba_up, CASE WHEN z IS NULL THEN 'no_features' ELSE 'ok' END AS msg FROM got UNION ALL
    SELECT * EXCLUDE (msg), NULL, coalesce(msg, 'no_model') FROM routed WHERE msg IS NOT NULL OR resolution = '24h'),
  final_rows AS (SELECT *, CASE WHEN proba_up IS NOT NULL THEN CAST(proba_up >= 0.5 AS INT) END AS prediction, greatest(proba_up, 1 - proba_up) AS confidence FROM answered)"""


@query(
    Shape("task resolution model series_id target_ts mode_used msg", "request_id prediction", ((5, "proba_up confidence"),)),
    f"WITH {REQUEST_SQL}, {STORES_SQL} FINAL SELECT * FROM final_rows",
)
def batch_predictions(spark, d):
    """Every event asks for a prediction; valid ones are routed, matched to a feature row and scored."""
    return answers(spark, d, requests(spark, d))


FUSED_ASK_SQL = """asked AS (SELECT event_id AS request_id, 'sentiment' AS task, CASE WHEN value > 60 THEN '4h' WHEN value > 30 THEN '4h' ELSE '1h' END AS resolution,
    'auto' AS mode, 'xgb_clf' AS model, 'market' AS series_id, ts AS target_ts FROM events UNION ALL
  SELECT event_id, 'price', CASE WHEN value > 60 THEN '24h' WHEN value > 30 THEN '4h' ELSE '1h' END, 'auto', 'rf_price', event_type, ts + INTERVAL 1 HOUR FROM events)"""
FUSED_SIDES = ", ".join(
    f"max({c}) FILTER (task = '{t}') AS {t}_{c}" for t in ("sentiment", "price") for c in ("prediction", "proba_up", "confidence", "mode_used", "msg")
)


@query(
    Shape(
        "sentiment_mode_used sentiment_msg price_mode_used price_msg msg",
        "request_id sentiment_prediction price_prediction",
        ((5, "sentiment_proba_up sentiment_confidence price_proba_up price_confidence"),),
    ),
    f"""WITH {FUSED_ASK_SQL}, {STORES_SQL}, wide_rows AS (SELECT request_id, {FUSED_SIDES} FROM final_rows GROUP BY 1)
    FINAL SELECT *, CASE WHEN sentiment_prediction IS NOT NULL OR price_prediction IS NOT NULL THEN 'ok' ELSE 'no_prediction' END AS msg FROM wide_rows""",
)
def fused_predictions(spark, d):
    asked = events(spark, d).select(
        F.col("event_id").alias("request_id"),
        "event_type",
        F.when(F.col("value") > 60, "24h").when(F.col("value") > 30, "4h").otherwise("1h").alias("resolution"),
        F.lit("auto").alias("mode"),
        F.col("ts").alias("target_sent"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("target_price"),
    )
    return score.fused_predict(answers(spark, d, score.fused_requests(asked, {"series_id": (F.lit("market"), F.col("event_type"))})))


def _trained(spark, d, algo, **params):
    """Direction model on the first 80 percent of each series' candles, metrics on the rest."""
    feats = rolling.future_target(price_features(candles(spark, d), BARS, "1h"), BARS, "close", 1)
    rows = settle(time_split(feats, BARS, 0.2).where(F.col("target_up").isNotNull()))
    cols = PROFILES["1h"].columns
    model = score.train_direction(rows.where("part = 'train'"), cols, algo, **params)
    keep = ["series_id", "ts", "y_true"]
    test = rows.where("part = 'test'").withColumn("y_true", F.col("target_up"))
    got = score.score_direction(test, score.ml_scorer(model, cols), cols, keep)
    return classification_metrics(got.withColumnRenamed("prediction", "y_pred"), ["series_id"])


@query()
def random_forest_direction(spark, d):
    return _trained(spark, d, "rf")


@query()
def boosted_trees_direction(spark, d):
    return _trained(spark, d, "gbt")
