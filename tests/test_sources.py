"""Readers of landed files and payloads, writers, on small files that hold the awkward cases."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from driftline.sources import files, payloads, sinks, windows


def put(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_strict_ohlc(spark, tmp_path):
    path = put(tmp_path, "c.csv", "datetime;open;high;low;close\n13/01/2026 05:00:00;1;2;0.5;1.5\n2026-01-11 05:00:00;1;2;0.5;x\n2026-01-12;1;2;0.5;1\nbad;1;1;1;1\n")
    rows = files.read_ohlc(spark, path).orderBy("datetime").collect()
    assert [(r["datetime"], r["close"]) for r in rows] == [(dt.datetime(2026, 1, 12), 1.0), (dt.datetime(2026, 1, 13, 5), 1.5)]
    with pytest.raises(ValueError, match="missing columns"):
        files.read_ohlc(spark, put(tmp_path, "d.csv", "time;open\n2026-01-01;1\n"))
    with pytest.raises(ValueError):
        files.read_ohlc(spark, put(tmp_path, "e.csv", "datetime,open,high,low,close\n2026-01-01,1,1,1,1\n"))


def test_lenient_prices_keep_null_price(spark, tmp_path):
    path = put(tmp_path, "p.csv", "date;close\n2026-01-01;5\n2026-01-02;?\nno;7\n")
    rows = files.read_prices(spark, path).orderBy("datetime").collect()
    assert [r["price"] for r in rows] == [5.0, None]


def test_news_dedupe_and_quoting(spark, tmp_path):
    text = 'published_at,title,description,source,axis\n2026-01-01 10:00:00,"a, ""b""","line one\nline two",s,BTC\n'
    text += '2026-01-01 10:00:00,"a, ""b""",other,s,TECH\n2026-01-01 11:00:00,,d,s,BTC\n2026-01-01 11:00:00,,d2,s,BTC\nx,t,d,s,BTC\n'
    path = put(tmp_path, "n.csv", text)
    rows = files.read_news(spark, path).orderBy("published_at").collect()
    assert len(rows) == 2 and rows[0]["title"] == 'a, "b"' and rows[0]["description"] == "line one\nline two"
    loose = files.read_news_any_ts(spark, path)
    assert loose.count() == 5 and loose.where("published_at is null").count() == 1


def test_index_names_and_failures(spark, tmp_path):
    path = put(tmp_path, "i.csv", "when,Fear Value\n2026-01-01 00:20:00+00:00,29\n2026-01-02 00:00:00+00:00,n/a\n")
    rows = files.read_index(spark, path).collect()
    assert [(r["datetime"], r["fear_greed_index"]) for r in rows] == [(dt.datetime(2026, 1, 1), 29.0)]
    assert files.read_index(spark, str(tmp_path / "absent.csv")).count() == 0
    assert files.read_index(spark, put(tmp_path, "j.csv", "a,b\n1,2\n")).count() == 0


def test_predictions_aliases_keep_probability(spark, tmp_path):
    path = put(tmp_path, "a.csv", "date,prediction,y,proba_up\n2026-01-01 01:00:00+00:00,1,0,0.7\n")
    assert files.read_predictions(spark, path).first().asDict() == {"datetime": dt.datetime(2026, 1, 1, 1), "y_pred": 1.0, "y_true": 0.0, "proba_up": 0.7}
    assert files.read_predictions(spark, put(tmp_path, "b.csv", "date,other\n2026-01-01,1\n")).count() == 0
    assert files.read_predictions(spark, str(tmp_path / "none.csv")).count() == 0


def test_threshold_holds_on_shipped_like_rows(spark, tmp_path):
    path = put(tmp_path, "t.csv", "datetime,y_true,y_pred,proba_up\n2026-01-06 11:00:00+00:00,1,0,0.4037\n2026-01-06 12:00:00+00:00,0,1,0.5006\n")
    assert files.read_predictions(spark, path).where((F.col("proba_up") >= 0.5).cast("int") != F.col("y_pred")).count() == 0


def test_feature_columns(spark, tmp_path):
    assert files.read_feature_columns(spark, put(tmp_path, "f.json", '["b", "a"]')) == ["b", "a"]
    assert files.read_feature_columns(spark, put(tmp_path, "g.json", "[]")) is None
    assert files.read_feature_columns(spark, str(tmp_path / "h.json")) is None


def test_strict_dataset_fails(spark):
    df = spark.createDataFrame([("2026-13-45",)], "datetime string")
    with pytest.raises(Exception):
        files.as_strict_dataset(df).collect()
    assert files.as_old_dataset(df).first()[0] is None


def test_payloads(spark):
    fng = json.dumps({"data": [{"value": "29", "timestamp": "1769472000"}, {"value": "x", "timestamp": "y"}]})
    rows = payloads.parse_index(spark.createDataFrame([(fng,)], "payload string")).collect()
    assert [tuple(r) for r in rows] == [(dt.datetime(2026, 1, 27), 29.0), (None, None)]
    kline = json.dumps([[1769472000000, "1", "2", "0.5", "1.5", "9", 0, "0", 1, "0", "0", "0"]])
    row = payloads.parse_klines(spark.createDataFrame([(kline,)], "payload string")).first()
    assert tuple(row) == (dt.datetime(2026, 1, 27), 1.0, 2.0, 0.5, 1.5)
    ok = json.dumps({"status": "ok", "articles": [{"publishedAt": "2026-01-27T01:00:00Z", "title": None, "description": "d", "source": {"name": "n"}}]})
    bad = json.dumps({"status": "error", "articles": [{"title": "t"}]})
    got = payloads.parse_articles(spark.createDataFrame([(ok, "BTC"), (bad, "TECH")], "payload string, axis string")).collect()
    assert [tuple(r) for r in got] == [(dt.datetime(2026, 1, 27, 1), None, "d", "n", "BTC")]


def test_windows(spark):
    day = spark.createDataFrame([("2026-01-02 05:00:00",)], "now string").select(F.col("now").cast("timestamp_ntz").alias("now"))
    assert {str(r["day"]) for r in windows.live_request_plan(day, "now", 24).collect()} == {"2026-01-01", "2026-01-02"}
    with pytest.raises(ValueError):
        windows.candle_window(day, "now", "1h", start="2026-01-02", end="2026-01-01")
    with pytest.raises(ValueError):
        windows.candle_window(day, "now", "2h", now="2026-01-02")
    assert windows.candle_window(day, "now", "1h", now="2026-01-03 10:00:00").count() == 0
    assert windows.candle_window(day, "now", "1h", now="2026-01-03 10:00:00", reach=30).count() == 1


def test_sinks(spark, tmp_path):
    root = str(tmp_path / "rev")
    df = spark.createDataFrame([(1,)], "x int")
    assert [sinks.write_versioned(df, root) for _ in range(3)] == [1, 2, 3]
    store = str(tmp_path / "store")
    feats = spark.createDataFrame([(dt.datetime(2026, 1, 1), 1.0)], "timestamp timestamp, f double")
    for res in ("1h", "4h", "4h"):
        sinks.write_features(feats, store, "price", res)
    assert files.read_feature_dataset(spark, store, "price", "4h").count() == 1
    assert files.read_feature_dataset(spark, store, "sentiment", "4h").count() == 0
    assert files.read_feature_dataset(spark, str(tmp_path / "no"), "price", "1h").count() == 0
    with pytest.raises(ValueError):
        files.read_feature_dataset(spark, store, "volume", "1h")


def test_pages_of_payloads_are_bounded(spark):
    from driftline.catalog.storage import PAGE_ROWS, paged

    df = spark.range(20_000).selectExpr("id", "IF(id < 15000, NULL, id % 50) AS k")
    out = paged(df, ["k"], ["id"])
    sizes = [r["count"] for r in out.groupBy("k", "page").count().collect()]
    assert out.columns == ["id", "k", "page"]
    assert sum(sizes) == 20_000 and max(sizes) < 2 * PAGE_ROWS


def test_articles_go_in_bounded_payloads(spark, monkeypatch):
    from driftline.catalog import load, storage

    seen = []
    real = payloads.parse_articles
    monkeypatch.setattr(storage, "PAGE_ROWS", 20)
    monkeypatch.setattr(storage.payloads, "parse_articles", lambda df: seen.append(df) or real(df))
    n = load()["article_payloads"].run(spark, "/root/testdata/sf0.1").count()
    sizes = [r["n"] for r in seen[0].selectExpr("size(from_json(payload, 'struct<articles:array<struct<title:string>>>').articles) AS n").collect()]
    assert n and max(sizes) < 60  # one group has 160 articles
