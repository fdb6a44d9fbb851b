"""Small hand-worked cases for rules that SQL would repeat without questioning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from driftline.functions.numeric import confidence_percent, rel_diff, score_percent
from driftline.functions.temporal import granularity_of, monday_weekday, parse_ts, safe_lag
from driftline.functions.text import hits, matched_axes
from driftline.operators import backtest, buckets, clean, joins, quality, rolling
from driftline.operators.ordered import Series
from driftline.plans import score, signals
from driftline.plans.price import PROFILES, features_at, price_features
from driftline.plans.sentiment import sentiment_features
from driftline.sources import windows

T0 = dt.datetime(2026, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def ntz(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def test_day_first_never_touches_iso(spark):
    df = spark.createDataFrame([("2026-01-11 05:00:00",), ("13/01/2026 05:00:00",), ("11/01/2026 05:00",), ("2026-13-01",), ("2026-01-13T05:00:00Z",)], "t string")
    got = [r[0] for r in df.select(parse_ts("t").cast("string")).collect()]
    assert got == ["2026-01-11 05:00:00", "2026-01-13 05:00:00", "2026-01-11 05:00:00", None, "2026-01-13 05:00:00"]


def test_monday_is_zero(spark):
    assert spark.range(1).select(monday_weekday(F.lit("2026-01-05").cast("date"))).first()[0] == 0


def news(spark, rows):
    return ntz(spark.createDataFrame([("s", *r) for r in rows], "series_id string, published_at timestamp, axis string, sentiment_score double"), "published_at")


def test_null_policy_and_absent_buckets(spark):
    df = news(spark, [(at(0), "BTC", 0.5), (at(0.5), "BTC", None), (at(3), "MACRO", None), (at(4), None, 0.9), (at(5), "TECH", 0.1)])
    rows = {r["bucket"]: r for r in sentiment_features(df, ["series_id"], freq="1 hour").collect()}
    # the bucket that holds only an untagged article does not exist
    assert set(rows) == {at(0), at(3), at(5)}
    first, second = rows[at(0)], rows[at(3)]
    assert first["sentiment_mean_BTC"] == 0.5 and first["sentiment_count_BTC"] == 1 and first["sentiment_std_BTC"] is None
    assert second["sentiment_mean_MACRO"] == 0.0 and second["sentiment_count_MACRO"] is None
    assert second["sentiment_mean_BTC_lag1"] == 0.5 and second["sentiment_mean_BTC_momentum"] == -0.5
    assert second["sentiment_mean_BTC_shock"] == 0 and second["sentiment_mean_BTC_roll_mean"] is None
    assert first["fear_greed_index"] == 50.0


def test_compat_blanks_deviations(spark):
    df = news(spark, [(at(0), "BTC", 0.5), (at(0.2), "BTC", 0.1)])
    assert sentiment_features(df, ["series_id"], compat=True).first()["sentiment_std_BTC"] is None
    assert sentiment_features(df, ["series_id"]).first()["sentiment_std_BTC"] == pytest.approx(0.2828427)


def test_index_exact_misses_absent_midnight(spark):
    df = news(spark, [(at(1), "BTC", 0.1), (at(24), "BTC", 0.1), (at(30), "BTC", 0.1)])
    index = ntz(spark.createDataFrame([(at(0), 20.0), (at(24), 30.0)], "datetime timestamp, fear_greed_index double"), "datetime")
    exact = [r["fear_greed_index"] for r in sentiment_features(df, ["series_id"], index=index).orderBy("bucket").collect()]
    asof = [r["fear_greed_index"] for r in sentiment_features(df, ["series_id"], index=index, index_mode="asof").orderBy("bucket").collect()]
    assert exact == [50.0, 30.0, 30.0] and asof == [20.0, 30.0, 30.0]


def test_spine_adds_empty_buckets(spark):
    df = news(spark, [(at(0), "BTC", 0.4), (at(3), "BTC", 0.1)])
    got = sentiment_features(df, ["series_id"], spine=True).orderBy("bucket").collect()
    assert [r["bucket"] for r in got] == [at(i) for i in range(4)]
    assert [r["sentiment_mean_BTC_lag1"] for r in got] == [None, 0.4, 0.0, 0.0] and got[1]["total_count"] is None


def test_irregular_series_is_reported_or_refused(spark):
    times = [0, 1, 2, 3, 9, 10.5]
    df = ntz(spark.createDataFrame([("s", at(h)) for h in times], "k string, ts timestamp"), "ts")
    row = quality.cadence_report(df, BARS).first()
    assert (row["mode_s"], row["mode_share"], row["n_gaps"], row["verdict"]) == (3600.0, 0.6, 2, "irregular")
    assert (row["granularity"], row["freq"], row["max_gap_s"]) == ("1-hour", "1 hour", 6 * 3600.0)
    with pytest.raises(Exception, match="regular enough"):
        quality.cadence_report(df, BARS, fail=True).collect()


def test_past_only_features(spark):
    rows = [(at(i), "BTC", ((i * 37) % 11 - 5) / 10) for i in range(30)]
    cols = ["bucket", "sentiment_mean_BTC_roll_mean", "sentiment_mean_BTC_roll_std", "sentiment_mean_BTC_shock"]
    short = sentiment_features(news(spark, rows[:20]), ["series_id"]).select(cols)
    longer = sentiment_features(news(spark, rows), ["series_id"]).select(cols)
    assert short.exceptAll(longer).count() == 0


def test_density_gate_counts_empty_buckets(spark):
    rows = [("a", at(h + f), 1.0 * h) for h in (0, 1, 2, 3) for f in (0.1, 0.2)] + [("b", at(h + f), 1.0 * h) for h in (0, 9) for f in (0.1, 0.2)]
    df = ntz(spark.createDataFrame(rows, "k string, datetime timestamp, price double"), "datetime")
    dens = {r["k"]: r["density"] for r in buckets.candle_density(df, ["k"], "datetime", "price", "1 hour").collect()}
    assert dens == {"a": 1.0, "b": pytest.approx(0.2)}
    got = {(r["k"], r["mode"]): r["open"] for r in buckets.build_ohlc(df, ["k"]).collect()}
    assert ("a", "computed_ohlc") in got and got[("b", "line")] is None
    ready = ntz(spark.createDataFrame([("a", at(0), 1.0, 2.0, 0.5, None), ("a", at(1), 1.0, 2.0, 0.5, 1.5)], "k string, datetime timestamp, open double, high double, low double, close double"), "datetime")
    assert [r["mode"] for r in buckets.build_ohlc(ready, ["k"]).collect()] == ["ohlc"]
    assert buckets.build_ohlc(df.select("k", "datetime"), ["k"]).where("mode = 'line'").count() == 2


def test_nearest_tie_rules_and_tolerance(spark):
    right = ntz(spark.createDataFrame([(at(0), "old"), (at(2), "new")], "rt timestamp, v string"), "rt")
    left = ntz(spark.createDataFrame([(1, at(1)), (2, at(50))], "i int, t timestamp"), "t")
    pick = lambda **kw: {r["i"]: r["r_v"] for r in joins.asof_join(left, right, [], "t", "rt", ["v"], **kw).collect()}
    assert pick() == {1: "new", 2: "new"}
    assert pick(tie="earlier") == {1: "old", 2: "new"}
    assert pick(tolerance_s=3600) == {1: "new", 2: None}
    with pytest.raises(Exception, match="tolerance"):
        joins.asof_join(left, right, [], "t", "rt", ["v"], tolerance_s=3600, strict=True).collect()


def test_regime_edges(spark):
    df = ntz(spark.createDataFrame([(at(24 * i),) for i in range(5)], "t timestamp"), "t")
    edges = ["2020-01-01", "2026-01-03", "2030-01-01"]
    both = [r["regime_id"] for r in joins.assign_regime(df, "t", edges, inclusive=True).orderBy("t", "regime_id").collect()]
    half = [r["regime_id"] for r in joins.assign_regime(df, "t", edges).orderBy("t").collect()]
    assert both == [1, 1, 1, 2, 2, 2] and half == [1, 1, 2, 2, 2]


def test_base_price_fallbacks(spark):
    candles = ntz(spark.createDataFrame([("s", at(0), 10.0), ("s", at(3), 13.0)], "k string, ts timestamp, close double"), "ts")
    points = ntz(spark.createDataFrame([("s", at(-5), 7.0), ("s", at(-4), None)], "k string, ts timestamp, price double"), "ts")
    targets = ntz(spark.createDataFrame([("s", at(4)), ("s", at(6)), ("s", at(-1)), ("s", at(-9))], "k string, t timestamp"), "t")
    got = {r["t"]: r["base_price"] for r in joins.base_price(targets, candles, points, ["k"], "t", 4).collect()}
    assert got == {at(4): 10.0, at(6): 13.0, at(-1): 7.0, at(-9): None}


BARS = Series(("k",), "ts")


def bars(spark, closes):
    rows = [("s", at(i), c, c + 1, c - 1, c) for i, c in enumerate(closes)]
    return ntz(spark.createDataFrame(rows, "k string, ts timestamp, open double, high double, low double, close double"), "ts")


def test_price_features_edges(spark):
    closes = [float(10 + (i * 7) % 5) for i in range(30)]
    closes[3] = 0.0
    rows = price_features(bars(spark, closes), BARS, "1h").orderBy("ts").collect()
    assert rows[3]["range_norm"] is None and rows[4]["ret_1"] is None
    assert rows[22]["mom_sma24"] is None and rows[23]["mom_sma24"] is not None
    assert rows[24]["ret_24"] == pytest.approx(closes[24] / closes[0] - 1)
    assert rows[5]["close_lag_4"] == closes[1]
    # the return after a zero close is unknown, so a full deviation needs 24 known returns after it
    assert rows[27]["std_24"] is None and rows[28]["std_24"] is not None
    assert price_features(bars(spark, closes), BARS, "24h").columns[-len(PROFILES["24h"].columns) :] == PROFILES["24h"].columns
    with pytest.raises(ValueError):
        price_features(bars(spark, closes), BARS, "2h")


def test_features_at_tolerance(spark):
    candles = bars(spark, [float(10 + (i * 7) % 5) for i in range(40)])
    targets = ntz(spark.createDataFrame([("s", at(30.2)), ("s", at(60))], "k string, t timestamp"), "t")
    got = {r["t"]: r for r in features_at(targets, candles, BARS, "t", "1h").collect()}
    assert got[at(30.2)]["ts"] == at(30) and got[at(60)]["ts"] is None


def test_differences_repeat_or_lag(spark):
    df = bars(spark, [1.0, 4.0, 9.0, 16.0, 25.0])
    assert [r["diff"] for r in rolling.difference(df, BARS, "close", d=2).orderBy("ts").collect()] == [2.0, 2.0, 2.0]
    assert [r["diff"] for r in rolling.difference(df, BARS, "close", d=2, lag_d=True).orderBy("ts").collect()] == [8.0, 12.0, 16.0]
    assert rolling.difference(df, BARS, "close").count() == 5


def test_dedupe_and_reports(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z"), (None, 1, "w"), (None, 1, "v")], "k string, o int, v string")
    got = {r["k"]: r["v"] for r in clean.dedupe_first(df, ["k"], ["o", "v"]).collect()}
    assert got == {"a": "y", "b": "z", None: "v"}
    assert {r["k"]: r["n_copies"] for r in clean.dup_report(df, ["k"]).collect()} == {"a": 2, None: 2}
    with pytest.raises(ValueError):
        clean.dup_report(df, ["k"], fail=True)


def test_substring_and_whole_word_hits(spark):
    df = spark.createDataFrame([("Support the ban",), ("up, up and away",)], "t string")
    sub = [r[0] for r in df.select(hits(F.col("t"), ("up", "support", "ban"))).collect()]
    whole = [r[0] for r in df.select(hits(F.col("t"), ("up", "support", "ban"), True)).collect()]
    assert sub == [3, 1] and whole == [2, 1]


def test_axis_rules(spark):
    rows = [("Bitcoin and the FED",), ("bitcoin scam",), ("federal budget",), ("new blockchain; BTC",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(matched_axes(F.col("t"))).collect()]
    assert got == [["BTC", "MACRO"], [], [], ["BTC", "TECH"]]


def test_keyword_sentiment_balance(spark):
    df = spark.createDataFrame([("rally and gain", None), (None, "ban")], "title string, description string")
    row = signals.keyword_sentiment(df, [], "title", "description").first()
    assert (row["pos_hits"], row["neg_hits"], row["label"]) == (2, 1, "POSITIVE") and row["score"] == pytest.approx(1 / 3)


def test_signal_rules(spark):
    cases = [(1, "POSITIVE", "UP"), (1, "NEUTRAL", "UP"), (0, "NEGATIVE", "DOWN"), (1, "NEGATIVE", "MIXED"), (0, "POSITIVE", "MIXED"),
             (None, "POSITIVE", "UP"), (None, "NEGATIVE", "DOWN"), (None, "NEUTRAL", "NEUTRAL"), (None, None, "NEUTRAL"), (0, None, "DOWN")]
    df = spark.createDataFrame([(c[0], c[1], c[2]) for c in cases], "p int, s string, want string")
    assert df.where(signals.combine_signal("p", "s") != F.col("want")).count() == 0


def test_direction_and_percentages(spark):
    df = spark.createDataFrame([(100.0, 100.3), (100.0, 100.19), (100.0, 99.0), (0.0, 5.0), (None, 5.0)], "b double, p double")
    got = [r["direction"] for r in df.withColumns(signals.direction_from_price("b", "p")).collect()]
    assert got == ["UP", "NEUTRAL", "DOWN", "NEUTRAL", "NEUTRAL"]
    row = spark.createDataFrame([(0.999, None), (-3.0, 1.7)], "s double, c double").select(score_percent("s"), confidence_percent("c")).collect()
    assert [tuple(r) for r in row] == [(99, 50), (0, 100)]
    assert spark.range(1).select(rel_diff(F.lit(1.0), F.lit(0.0))).first()[0] is None


def test_recent_rows_fall_back(spark):
    df = ntz(spark.createDataFrame([(at(0),), (at(90),)], "t timestamp"), "t")
    assert [(r["t"], r["scope"]) for r in clean.recent_or_all(df, "t", "2026-01-05").collect()] == [(at(90), "recent")]
    assert {r["scope"] for r in clean.recent_or_all(df, "t", "2027-01-05").collect()} == {"all"}


def test_day_range_loses_last_subsecond(spark):
    end = dt.datetime(2026, 1, 2, 23, 59, 59)
    df = ntz(spark.createDataFrame([(end,), (end + dt.timedelta(milliseconds=500),)], "t timestamp"), "t")
    assert clean.between_days(df, "t", "2026-01-01", "2026-01-02").count() == 1


def test_granularity_and_lags(spark):
    df = spark.createDataFrame([(3600.0,), (14000.0,), (86400.0,), (60.0,)], "s double")
    assert [r[0] for r in df.select(granularity_of("s")).collect()] == ["1-hour", "4-hour", "1-day", "other"]
    got = spark.range(1).select(safe_lag("1-hour", 24, 1000), safe_lag("1-hour", 168, 1000), safe_lag("1-day", None, 15), safe_lag("other", None, 5)).first()
    assert tuple(got) == (168, 300, 13, 10)


def test_quantile_bins_with_ties(spark):
    df = spark.createDataFrame([(0.0, 1.0, 1)] * 6 + [(float(i), 2.0, 0) for i in range(1, 5)], "f double, future_return double, target_up int")
    rows = quality.conditional_analysis(df, "f", 5).orderBy("bin").collect()
    assert sum(r["count"] for r in rows) == 10 and rows[0]["count"] == 6 and rows[0]["lo"] == 0.0


def test_error_metrics_rules(spark):
    rows = [("s", float(i), float(i), 0.0) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, y_true double, y_pred double, train_scale double")
    row = backtest.forecast_metrics(df, ["k"]).first()
    assert row["mae"] == 0 and row["mase"] is None and row["smape"] == 0
    assert backtest.forecast_metrics(df.limit(9), ["k"]).count() == 0


def test_short_series_have_no_folds(spark):
    df = bars(spark, [float(i % 7) for i in range(60)])
    names = {r["name"] for r in backtest.evaluate_naive(df, BARS, "close").collect()}
    assert names == {"naive_main", "naive_second_split"}
    checks = backtest.stability_checks(backtest.evaluate_naive(df, BARS, "close"), ["k"]).first()
    assert checks["expanding_check"] == "insufficient"


def test_score_text_failing_batch(spark):
    def factory():
        def run(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError
            return [("positive", 0.5) if "good" in t else ("negative", 0.25) for t in texts]

        return run

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["good", "bad", "boom", "good"])], "i int, t string").coalesce(1)
    got = [r["score"] for r in score.score_text(df, "t", factory, batch=2).orderBy("i").collect()]
    assert got == [0.5, -0.25, 0.0, 0.0]


def test_decide_threshold(spark):
    rows = score.decide(spark.createDataFrame([(0.5,), (0.49,), (None,)], "proba_up double")).collect()
    assert [(r["prediction"], r["confidence"]) for r in rows] == [(1, 0.5), (0, 0.51), (0, 0.5)]


def test_fused_falls_back_to_4h(spark):
    df = spark.createDataFrame([(1, "24h", "auto", at(0), at(1))], "request_id int, resolution string, mode string, target_sent timestamp, target_price timestamp")
    assert {(r["task"], r["resolution"]) for r in score.fused_requests(df).collect()} == {("sentiment", "4h"), ("price", "24h")}


def test_model_names(spark, tmp_path):
    for name in ("xgb_clf_1h.joblib", "rf_price_24h.joblib", "rf_price_2h.joblib", "notes.txt"):
        (tmp_path / name).write_text("")
    got = {tuple(r) for r in score.model_inventory(score.list_models(spark, str(tmp_path))).collect()}
    assert got == {("sentiment", "xgb_clf", "1h"), ("price", "rf_price", "24h")}


def by_sum(rows):
    """Probability 0.5 + 0.1 a - 0.1 b, so that answers name the row they come from."""
    return rows.withColumn("proba_up", 0.5 + 0.1 * F.col("a").cast("double") - 0.1 * F.col("b").cast("double"))


def test_batch_predict_keeps_series_tasks_and_modes_apart(spark):
    stamp = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rows = lambda *r: spark.createDataFrame([(s, stamp(h), a, 9.0) for s, h, a in r], "series_id string, timestamp timestamp, a double, target_up double")
    history = {
        ("price", "1h"): rows(("x", 0, 1.0), ("x", 4, 2.0), ("y", 0, 3.0), (None, 1, None)),
        ("price", "4h"): rows(("x", 0, -1.0)),
        ("sentiment", "1h"): rows(("x", 0, -2.0)),
    }
    live = {("price", "1h"): rows(("x", 90, 4.0), ("y", 90, -3.0))}
    models = {("price", "1h"): (by_sum, ["a", "b"]), ("price", "4h"): (by_sum, ["a", "b"]), ("volume", "1h"): (by_sum, ["a", "b"])}
    ask = [
        (1, "x", "price", "1h", 2, "auto"),  # as near to 0 as to 4: the later one
        (2, "x", "price", "1h", 1, "historical"),
        (3, "y", "price", "1h", 3, "auto"),  # beyond the history of y, not of x
        (4, "y", "price", "1h", 3, "historical"),
        (5, None, "price", "1h", 2, "auto"),  # a null series has a history too; its null feature is 0
        (6, "x", "price", "4h", 50, "auto"),  # live without a live store
        (7, "z", "price", "1h", 0, "auto"),
        (8, "x", "sentiment", "1h", 0, "auto"),  # stored, but no model
        (9, "x", "volume", "1h", 0, "auto"),  # a model, but nothing stored
        (10, "x", "price", "2h", 0, "auto"),
        (11, "x", "price", "1h", 0, "soon"),
        (12, "x", "price", "1h", None, "auto"),
        (13, "x", None, "1h", 0, "auto"),
    ]
    asked = spark.createDataFrame(
        [(i, s, t, r, "m", m, None if h is None else stamp(h)) for i, s, t, r, h, m in ask],
        "request_id int, series_id string, task string, resolution string, model string, mode string, target_ts timestamp",
    )
    got = score.batch_predict(asked, history, live, models, keys=["series_id"])
    found = {r["request_id"]: (r["mode_used"], r["msg"], None if r["proba_up"] is None else round(r["proba_up"], 6), r["prediction"]) for r in got.collect()}
    assert found == {
        1: ("historical", "ok", 0.7, 1),
        2: ("historical", "ok", 0.6, 1),
        3: ("live", "ok", 0.2, 0),
        4: ("historical", "ok", 0.8, 1),
        5: ("historical", "ok", 0.5, 1),
        6: ("live", "no_features", None, None),
        7: ("live", "no_features", None, None),
        8: ("historical", "no_model", None, None),
        9: ("live", "no_features", None, None),
        10: (None, "bad_resolution", None, None),
        11: (None, "bad_mode", None, None),
        12: (None, "bad_target", None, None),
        13: ("live", "no_model", None, None),
    }
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_batch_predict_cuts_a_hot_series(spark):
    """One series holds nearly all rows; chunks of 50 rows give what one chunk gives."""
    stamp = F.timestamp_seconds(F.col("id") * 60)
    store = spark.range(2000).select(F.lit("hot").alias("series_id"), stamp.alias("timestamp"), F.col("id").cast("double").alias("a"), F.lit(0.0).alias("b"))
    asked = spark.range(700).select(
        F.col("id").alias("request_id"), F.lit("hot").alias("series_id"), F.lit("price").alias("task"), F.lit("1h").alias("resolution"),
        F.lit("m").alias("model"), F.lit("historical").alias("mode"), F.timestamp_seconds(F.col("id") * 171 + 10).alias("target_ts"),
    )
    model = lambda rows: rows.withColumn("proba_up", F.col("a").cast("double"))
    got = score.batch_predict(asked, {("price", "1h"): store}, {}, {("price", "1h"): (model, ["a"])}, keys=["series_id"], rows_per_chunk=50)
    want = {i: float(min(1999, round((i * 171 + 10) / 60))) for i in range(700) if ((i * 171 + 10) % 60) != 30}
    found = {r["request_id"]: r["proba_up"] for r in got.collect()}
    assert len(found) == 700 and all(found[i] == v for i, v in want.items())


def test_live_windows(spark):
    stamp = lambda h: dt.datetime(2024, 1, 10) + dt.timedelta(hours=h)
    df = spark.createDataFrame([(h, stamp(h)) for h in range(-80, 10)] + [(99, None)], "h int, ts timestamp")
    now = str(stamp(5.5))
    assert {r["h"] for r in windows.live_days(df, "ts", now).collect()} == set(range(-24, 6))
    # bars of 4 hours that open in the 24 hours before now: from -16 on (-20 opens before -18.5), the open one whole
    kept = {r["h"] for r in windows.candle_window(df, "ts", "1h", now=now, bars="4 hours").collect()}
    assert kept == set(range(-16, 8))
    assert windows.newest(df, "ts") == "2024-01-10 09:00:00"
    assert windows.newest(df.where("h > 100"), "ts") is None
