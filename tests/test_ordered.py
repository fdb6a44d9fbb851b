"""Chunked series work equals unchunked work, also when one key or one short time span holds most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from driftline.operators import ordered
from driftline.operators.joins import asof_join
from driftline.operators.quantiles import exact_quantiles
from driftline.operators.ordered import Series


@pytest.fixture(scope="module")
def ticks(spark):
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n))
    # a third of the rows within one minute, many of them at equal times
    far = rng.integers(0, 40 * 86400, n)
    near = 5 * 86400 + rng.integers(0, 60, n)
    sec = np.where(rng.random(n) < 0.34, near, far)
    pdf = pd.DataFrame({"k": key, "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(sec, unit="s"), "id": range(n), "v": rng.normal(size=n)})
    pdf.loc[pdf.index % 5 == 0, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).persist()


SERIES = Series(("k",), "ts", ("id",), chunk_seconds=3 * 86400)


def same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b.select(a.columns)).count() == 0


@pytest.mark.parametrize("rows", [2, 37, 100_000])
def test_bounded_frames(ticks, rows):
    def step(w):
        frame = w.rowsBetween(-9, -1)
        return {"m": F.round(F.sum("v").over(frame), 6), "c": F.count("v").over(frame), "back": F.lag("v", 9).over(w), "on": F.lead("v", 4).over(w)}

    whole = ordered.over_series(ticks, SERIES, step, split=False)
    parts = ordered.over_series(ticks, SERIES, step, back=9, ahead=4, split=True, rows_per_chunk=rows)
    same(whole, parts)


@pytest.mark.parametrize("rows", [5, 300])
def test_carry_and_numbers(ticks, rows):
    kw = {"last": {"before": "v"}, "following": {"after": "v"}}
    same(ordered.carry(ticks, SERIES, **kw, split=False), ordered.carry(ticks, SERIES, **kw, split=True, rows_per_chunk=rows))
    same(ordered.number_rows(ticks, SERIES, split=False), ordered.number_rows(ticks, SERIES, split=True, rows_per_chunk=rows))


def test_chunks_respect_the_row_limit(ticks):
    spread = ticks.where("id % 1 = 0").dropDuplicates(["k", "ts"])
    sizes = ordered.assign_chunks(spread, SERIES, rows_per_chunk=50).groupBy("k", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 60


def test_running_total(ticks):
    rows = ticks.select("k", F.col("id").alias("o"), F.lit(1).alias("one")).withColumn("part", F.floor(F.col("o") / 100))
    got = ordered.running_total(rows, ["k"], "part", "o", "one", "n").toPandas().sort_values(["k", "o"])
    assert (got["n"] == got.groupby("k").cumcount() + 1).all()


@pytest.mark.parametrize("direction,tie", [("nearest", "later"), ("nearest", "earlier"), ("backward", "later"), ("forward", "later")])
@pytest.mark.parametrize("split", [False, True])
def test_asof_against_brute_force(ticks, direction, tie, split):
    left = ticks.where("id < 700").select("k", "ts", "id")
    right = ticks.where("id >= 700 and id < 1500").select("k", F.col("ts").alias("rt"), F.col("id").alias("rid"))
    got = asof_join(left, right, ["k"], "ts", "rt", ["rid"], direction, tie, right_tie=["rid"], split=split, rows_per_chunk=60, chunk_seconds=86400)
    found = {r["id"]: r["r_rid"] for r in got.collect()}
    lp, rp = left.toPandas(), right.toPandas()
    for key, rows in lp.groupby("k"):
        pool = rp[rp.k == key]
        for _, row in rows.iterrows():
            back, fwd = pool[pool.rt <= row.ts], pool[pool.rt >= row.ts]
            b = back.sort_values(["rt", "rid"]).iloc[-1] if len(back) else None
            f = fwd.sort_values(["rt", "rid"]).iloc[0] if len(fwd) else None
            if direction == "backward":
                want = b
            elif direction == "forward":
                want = f
            elif b is None or f is None:
                want = f if b is None else b
            else:
                db, df = row.ts - b.rt, f.rt - row.ts
                want = f if (df <= db if tie == "later" else df < db) else b
            assert found[row.id] == (None if want is None else want.rid)


def test_exact_quantiles_bracketed(ticks):
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r["k"]: r["q"] for r in exact_quantiles(ticks, ["k"], "v", probs, accuracy=100).collect()}
    pdf = ticks.toPandas()
    for key, part in pdf.groupby("k"):
        assert np.allclose(got[key], part.v.dropna().quantile(probs))


def test_quantiles_of_heavily_repeated_values(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 15_000, 1.0).otherwise(F.col("id") * 1.0).alias("x"))
    got = exact_quantiles(df, [], "x", [0.5, 0.74, 0.76, 1.0], accuracy=200).first()
    want = df.toPandas().x.quantile([0.5, 0.74, 0.76, 1.0]).tolist()
    assert np.allclose(got["q"], want)


def test_bursts_and_null_keys_are_cut(spark):
    """A burst inside a second, and a series without a key, in chunks of at most twice the limit."""
    burst = spark.range(4000).selectExpr("IF(id % 2 = 0, 'a', NULL) AS k", "timestamp_ntz'2026-01-01' + make_dt_interval(0, 0, 0, id / 1e5) AS ts", "id", "id * 1.0D AS v")
    series = ordered.Series(("k",), "ts", ("id",))
    chunks = ordered.assign_chunks(burst, series, rows_per_chunk=100).groupBy("k", "_chunk").count()
    assert chunks.agg({"count": "max"}).first()[0] <= 200
    got = ordered.number_rows(burst.withColumn("row_no", F.lit(0)), series, rows_per_chunk=100)
    assert got.where("row_no <> floor(id / 2) + 1 OR n_rows <> 2000").count() == 0


def test_quantiles_and_joins_keep_null_keys(spark):
    from driftline.operators.quality import describe

    rows = spark.range(60).selectExpr("IF(id < 30, NULL, 'b') AS k", "CAST(id % 30 AS DOUBLE) AS v")
    got = {r["k"]: r["p50"] for r in describe(rows, ["k"], ["v"]).collect()}
    assert got == {None: 14.5, "b": 14.5}


def test_no_private_folder_off_a_local_master():
    from driftline.session import is_local

    assert is_local("local") and is_local("local[8]") and is_local("local[*]")
    assert not is_local("yarn") and not is_local("local-cluster[3,2,3000]") and not is_local("spark://host:7077")
