"""Splits, naive forecasts, error metrics and stability verdicts, for every scope in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.functions.numeric import rel_diff
from driftline.operators.ordered import Series, number_rows, over_series, running_total
from driftline.operators.quantiles import one_quantile
from driftline.session import join_same, settle

METRICS = ("mae", "rmse", "mase", "smape")
# Sizes below which a scope is not evaluated, fold layout, fall-back thresholds.
MIN_REGIME_ROWS = 50
MIN_TEST_ROWS = 10
FOLDS = 3
MIN_TRAIN_RATIO = 0.6
MIN_FOLD_SERIES = 200
STABILITY_DEFAULT = 0.20
EXPANDING_DEFAULT = 0.30
AUC_PARTS = 4096


def error_metrics(
    y: Column | str = "y_true",
    yhat: Column | str = "y_pred",
    train_scale: Column | str = "train_scale",
    mask_zero: bool = True,
) -> list[Column]:
    """Aggregates for MAE, RMSE, MASE (null for a missing or zero scale) and sMAPE in percent."""
    y, yhat = (F.col(c) if isinstance(c, str) else c for c in (y, yhat))
    scale = F.col(train_scale) if isinstance(train_scale, str) else train_scale
    err = F.abs(y - yhat)
    size = F.abs(y) + F.abs(yhat)
    share = F.try_divide(2 * err, F.when(size != 0, size)) if mask_zero else F.try_divide(2 * err, size)
    return [
        F.count("*").alias("n"),
        F.avg(err).alias("mae"),
        F.sqrt(F.avg((y - yhat) * (y - yhat))).alias("rmse"),
        F.try_divide(F.avg(err), F.nullif(F.max(scale), F.lit(0.0))).alias("mase"),
        (100 * F.avg(share)).alias("smape"),
    ]


def forecast_metrics(pairs: DataFrame, keys: Sequence[str], min_points: int = MIN_TEST_ROWS, mask_zero: bool = True):
    """Metrics per key of a table with y_true, y_pred and train_scale; nothing for keys with too few points."""
    known = pairs.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    return known.groupBy(*keys).agg(*error_metrics(mask_zero=mask_zero)).where(F.col("n") >= min_points)


def test_scaled_metrics(pairs: DataFrame, series: Series, keys: Sequence[str], split: bool | None = None):
    """Variant whose MASE is scaled by the steps of the evaluated values themselves, without a zero mask."""
    stepped = over_series(pairs, series, lambda w: {"_step": F.abs(F.col("y_true") - F.lag("y_true", 1).over(w))}, back=1, split=split)
    return stepped.groupBy(*keys).agg(*error_metrics(train_scale=F.lit(None).cast("double"), mask_zero=False)[:3],
        F.try_divide(F.avg(F.abs(F.col("y_true") - F.col("y_pred"))), F.nullif(F.avg("_step"), F.lit(0.0))).alias("mase"),
        error_metrics(mask_zero=False)[4],
    )


def naive_forecast(df: DataFrame, series: Series, value: str, split: bool | None = None) -> DataFrame:
    """Previous value as forecast; the first row of any later test part thus uses the last training value."""
    return over_series(
        df,
        series,
        lambda w: {"y_pred": F.lag(value, 1).over(w), "_step": F.abs(F.col(value) - F.lag(value, 1).over(w))},
        back=1,
        split=split,
    ).withColumn("y_true", F.col(value))


def time_split(df: DataFrame, series: Series, test_size: float = 0.2, min_rows: int = 0, split: bool | None = None):
    """First floor(n*(1-test_size)) rows are ``train``, the rest ``test``; short series are left out."""
    numbered = number_rows(df, series, split=split)
    cut = F.floor(F.col("n_rows") * F.lit(1.0 - test_size))
    return numbered.where(F.col("n_rows") >= min_rows).withColumns(
        {"split_at": cut, "part": F.when(F.col("row_no") <= cut, "train").otherwise("test")}
    )


def evaluation_folds(test_size: float = 0.2) -> Column:
    """Array of (name, train_end, test_end) for a series of ``n_rows`` rows; row numbers from 1, ends included.

    Holds the main split, the equally long window just before it and the expanding folds the length allows.
    """
    n = F.col("n_rows")
    cut = F.floor(n * F.lit(1.0 - test_size))
    test_len = n - cut
    main = F.struct(F.lit("naive_main").alias("name"), cut.alias("train_end"), n.alias("test_end"))
    second = F.when(
        (test_len >= MIN_TEST_ROWS) & (n >= 2 * test_len + 10),
        F.struct(F.lit("naive_second_split").alias("name"), (cut - test_len).alias("train_end"), cut.alias("test_end")),
    )
    least = F.floor(n * F.lit(MIN_TRAIN_RATIO))
    size = F.floor((n - least) / F.lit(FOLDS + 1))
    folds = [
        F.when(
            (n >= MIN_FOLD_SERIES) & (size >= MIN_TEST_ROWS),
            F.struct(
                F.lit(f"rolling_fold_{i + 1}").alias("name"),
                (least + i * size).alias("train_end"),
                F.least(least + (i + 1) * size, n).alias("test_end"),
            ),
        )
        for i in range(FOLDS)
    ]
    return F.array_compact(F.array(main, second, *folds))


def evaluate_naive(
    df: DataFrame,
    series: Series,
    value: str,
    test_size: float = 0.2,
    min_rows: int = MIN_REGIME_ROWS,
    split: bool | None = None,
) -> DataFrame:
    """Metrics of the naive forecast per series for the main split, the second split and every expanding fold.

    Each row fans out to the few folds it belongs to, as training or test row; train scale and test errors then
    come from a single aggregate.
    """
    stepped = naive_forecast(df, series, value, split)
    numbered = number_rows(stepped, series, split=split).where(F.col("n_rows") >= min_rows)
    fanned = numbered.withColumn("_f", F.explode(evaluation_folds(test_size))).where(F.col("row_no") <= F.col("_f.test_end"))
    train = F.col("row_no") <= F.col("_f.train_end")
    test = ~train & F.col("y_true").isNotNull() & F.col("y_pred").isNotNull()
    err = F.when(test, F.abs(F.col("y_true") - F.col("y_pred")))
    size = F.abs(F.col("y_true")) + F.abs(F.col("y_pred"))
    return (
        fanned.groupBy(*series.keys, F.col("_f.name").alias("name"))
        .agg(
            F.count(err).alias("n"),
            F.avg(err).alias("mae"),
            F.sqrt(F.avg(err * err)).alias("rmse"),
            F.try_divide(F.avg(err), F.nullif(F.avg(F.when(train, F.col("_step"))), F.lit(0.0))).alias("mase"),
            (100 * F.avg(F.try_divide(2 * err, F.when(size != 0, size)))).alias("smape"),
        )
        .where(F.col("n") >= MIN_TEST_ROWS)
    )


def cv_of_folds(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Population deviation over mean of the fold errors; null below two folds or for a zero mean."""
    folds = metrics.where(F.col("name").startswith("rolling_fold_"))

    def cv(c: str) -> Column:
        return F.when(F.count(c) >= 2, F.try_divide(F.stddev_pop(c), F.avg(c)))

    return folds.groupBy(*keys).agg(F.count("*").alias("n_folds"), cv("mae").alias("mae_cv"), cv("rmse").alias("rmse_cv"))


def split_differences(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Relative difference of the second split against the main one, per metric."""
    def of(name: str, m: str) -> Column:
        return F.max(F.when(F.col("name") == name, F.col(m)))

    pair = metrics.groupBy(*keys).agg(
        *[of("naive_main", m).alias(f"main_{m}") for m in METRICS[:3]],
        *[of("naive_second_split", m).alias(f"second_{m}") for m in METRICS[:3]],
    )
    return pair.select(*keys, *[rel_diff(f"second_{m}", f"main_{m}").alias(f"{m}_diff") for m in METRICS[:3]])


def p75_thresholds(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: 75th percentile of all split differences and of all fold variations, with fixed fall-backs."""
    metrics = settle(metrics)
    diffs = split_differences(metrics, keys).select(F.explode(F.array("mae_diff", "rmse_diff", "mase_diff")).alias("x"))
    cvs = cv_of_folds(metrics, keys).select(F.explode(F.array("mae_cv", "rmse_cv")).alias("x"))
    a = one_quantile(diffs, "x", 0.75, STABILITY_DEFAULT).select(F.col("q").alias("stability_threshold"))
    b = one_quantile(cvs, "x", 0.75, EXPANDING_DEFAULT).select(F.col("q").alias("expanding_threshold"))
    return a.join(F.broadcast(b), F.lit(True))  # one row each


def stability_checks(metrics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ok / unstable / insufficient per scope, for the second split and for the expanding folds."""
    metrics = settle(metrics)
    limits = p75_thresholds(metrics, keys)
    scopes = metrics.where(F.col("name") == "naive_main").select(*keys)
    joined = join_same(join_same(scopes, split_differences(metrics, keys), keys, "left"), cv_of_folds(metrics, keys), keys, "left")
    joined = joined.join(F.broadcast(limits), F.lit(True))  # one row
    worst = F.greatest("mae_diff", "rmse_diff", "mase_diff")
    unknown = F.col("mae_diff").isNull() | F.col("rmse_diff").isNull() | F.col("mase_diff").isNull()
    return joined.select(
        *keys,
        F.when(unknown, "insufficient")
        .when(worst <= F.col("stability_threshold"), "ok")
        .otherwise("unstable")
        .alias("stability_check"),
        F.when(F.col("mae_cv").isNull() | F.col("rmse_cv").isNull(), "insufficient")
        .when(F.greatest("mae_cv", "rmse_cv") <= F.col("expanding_threshold"), "ok")
        .otherwise("unstable")
        .alias("expanding_check"),
    )


def top_n_by(df: DataFrame, keys: Sequence[str], metrics: Sequence[str], n: int, tie: Sequence[str]) -> DataFrame:
    """Union of the best ``n`` rows by each metric, without repeats."""
    best = None
    for m in metrics:
        w = Window.partitionBy(*keys).orderBy(F.col(m).asc_nulls_last(), *tie)
        top = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
        best = top if best is None else best.unionByName(top)
    return best.distinct()


def best_model(metrics: DataFrame, keys: Sequence[str], name: str = "name", prefix: str = "") -> DataFrame:
    """Row with the smallest (mase, smape, mae) per scope among names with the prefix."""
    pool = metrics.where(F.col(name).startswith(prefix)) if prefix else metrics
    far = F.lit(float("inf"))
    order = F.struct(*[F.coalesce(F.col(c), far).alias(c) for c in ("mase", "smape", "mae")], F.col(name).alias("_name"))
    row = F.min_by(F.struct(*[c for c in pool.columns if c not in keys]), order)
    return pool.groupBy(*keys).agg(row.alias("_b")).select(*keys, "_b.*")


def classification_metrics(df: DataFrame, keys: Sequence[str], y="y_true", pred="y_pred", proba: str | None = "proba_up"):
    """Counts, accuracy, precision, recall, F1, majority-class rate, and rank AUC when a probability is given.

    AUC is taken over the tallies of distinct probabilities, so equal scores share their rank exactly.
    """
    t, p = F.col(y) == 1, F.col(pred) == 1
    known = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull())
    tp, fp, fn = F.count_if(t & p), F.count_if(~t & p), F.count_if(t & ~p)
    base = known.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.greatest(F.avg(t.cast("double")), F.avg((~t).cast("double"))).alias("majority_rate"),
    )
    if not proba:
        return base
    tallies = (
        known.where(F.col(proba).isNotNull())
        .groupBy(*keys, proba)
        .agg(F.count_if(t).alias("_p"), F.count_if(~t).alias("_n"))
        .withColumn("_part", F.floor(F.col(proba) * AUC_PARTS))
    )
    auc = (
        running_total(tallies, list(keys), "_part", proba, "_n", "_upto")
        .groupBy(*keys)
        .agg(
            F.try_divide(
                F.sum(F.col("_p") * (F.col("_upto") - 0.5 * F.col("_n"))),
                F.sum("_p").cast("double") * F.sum("_n").cast("double"),
            ).alias("auc")
        )
    )
    if keys:
        return join_same(base, auc, keys, "left")
    return base.join(F.broadcast(auc), F.lit(True), "left")  # one row


def tail_n(df: DataFrame, series: Series, n: int) -> DataFrame:
    """Last ``n`` rows of every series; the rank limit runs before the shuffle."""
    w = series.window(descending=True)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
