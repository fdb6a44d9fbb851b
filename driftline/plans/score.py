"""Batch scoring: text models, direction models, request routing and fused predictions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from driftline.functions.numeric import blend
from driftline.functions.temporal import RESOLUTION_SECONDS
from driftline.operators.clean import align_features, drop_leakage, fill_and_cast
from driftline.operators.joins import asof_join
from driftline.session import broadcast_if_small, join_same, settle

THRESHOLD = 0.5
# Default model per task, text batch size.
DEFAULT_MODEL = {"sentiment": "xgb_clf", "price": "rf_price"}
TEXT_BATCH = 32

# loads a model once per worker and returns a function from texts to (label, score) pairs
ScorerFactory = Callable[[], Callable[[list[str]], list[tuple[str, float]]]]
# adds proba_up to aligned feature rows
DirectionScorer = Callable[[DataFrame], DataFrame]


def score_text(
    df: DataFrame,
    text: str,
    factory: ScorerFactory,
    out: str = "score",
    batch: int = TEXT_BATCH,
    failed: str | None = None,
) -> DataFrame:
    """Signed model score per text: +s positive, -s negative, 0 neutral; a failing batch scores 0.

    Whole texts are passed on. ``failed`` names a further column that flags the rows of failing batches.
    """
    flags = [StructField(failed, BooleanType())] if failed else []
    schema = StructType([*df.schema.fields, StructField(out, DoubleType()), *flags])
    signs = {"positive": 1.0, "negative": -1.0}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for pdf in frames:
            texts = ["" if t is None else str(t) for t in pdf[text]]
            scores: list[float] = []
            bad: list[bool] = []
            for i in range(0, len(texts), batch):
                part = texts[i : i + batch]
                try:
                    scores += [signs.get(label, 0.0) * float(s) for label, s in model(part)]
                    bad += [False] * len(part)
                except Exception:
                    scores += [0.0] * len(part)
                    bad += [True] * len(part)
            yield pdf.assign(**{out: scores}, **({failed: bad} if failed else {}))

    return df.mapInPandas(run, schema)


def ensemble(df: DataFrame, a: str, b: str, out: str = "sentiment_score", wa: float = 0.7, wb: float = 0.3) -> DataFrame:
    return df.withColumn(out, blend(a, b, wa, wb))


def decide(df: DataFrame, proba: str = "proba_up") -> DataFrame:
    """Class at the threshold and confidence; an unknown probability counts as even."""
    p = F.coalesce(F.col(proba), F.lit(0.5))
    known = F.col(proba).isNotNull()
    return df.withColumns(
        {
            "prediction": F.when(known & (p >= THRESHOLD), 1).otherwise(0),
            "confidence": F.greatest(p, 1 - p),
            proba: p,
        }
    )


def train_direction(train: DataFrame, columns: Sequence[str], algo: str = "rf", label: str = "target_up", **params) -> Model:
    """Random forest (``rf``) or gradient-boosted trees (``gbt``) on aligned features; rows without a label are left out."""
    algos = {"rf": RandomForestClassifier, "gbt": GBTClassifier}
    if algo not in algos:
        raise ValueError(f"algo is one of {sorted(algos)}")
    rows = fill_and_cast(align_features(train.where(F.col(label).isNotNull()), columns, [label]), columns)
    rows = rows.withColumn(label, F.col(label).cast("double"))
    ready = VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows)
    return algos[algo](featuresCol="features", labelCol=label, seed=7, **params).fit(ready)


def ml_scorer(model: Model, columns: Sequence[str]) -> DirectionScorer:
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")

    def run(rows: DataFrame) -> DataFrame:
        got = model.transform(assembler.transform(rows))
        return got.withColumn("proba_up", vector_to_array("probability")[1]).drop(
            "features", "rawPrediction", "probability", "prediction"
        )

    return run


def score_direction(df: DataFrame, scorer: DirectionScorer, columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Align to the model's columns, fill, score and decide; keeps ``keep`` and the three result columns."""
    aligned = fill_and_cast(align_features(drop_leakage(df), columns, list(keep)), columns)
    return decide(scorer(aligned)).select(*keep, "prediction", "proba_up", "confidence")


def list_models(spark: SparkSession, root: str) -> DataFrame:
    """Names of the entries of a model folder on any file system Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [(s.getPath().getName(),) for s in fs.listStatus(path)] if fs.exists(path) else []
    return spark.createDataFrame(names, "file string")


def parse_model_name(file: Column | str) -> dict[str, Column]:
    f = F.col(file) if isinstance(file, str) else file
    pattern = r"^(.+)_(1h|4h|24h)(\.[a-z]+)?$"
    model = F.regexp_extract(f, pattern, 1)
    known = model != ""
    return {
        "model": F.when(known, model),
        "resolution": F.when(known, F.regexp_extract(f, pattern, 2)),
        "task": F.when(known, F.when(F.lower(model).contains("price"), "price").otherwise("sentiment")),
    }


def model_inventory(files: DataFrame, file: str = "file") -> DataFrame:
    """(task, model, resolution) found among file names; other names are ignored."""
    return (
        files.withColumns(parse_model_name(file))
        .where(F.col("model").isNotNull())
        .select("task", "model", "resolution")
        .distinct()
    )


def validate_requests(requests: DataFrame, inventory: DataFrame) -> DataFrame:
    """Fill in the default model per task and add ``msg``: null for a valid request, else what is wrong."""
    default = F.coalesce(*[F.when(F.col("task") == t, F.lit(m)) for t, m in DEFAULT_MODEL.items()])
    asked = requests.withColumns(
        {
            "task": F.lower(F.trim("task")),
            "resolution": F.lower(F.trim("resolution")),
        }
    ).withColumn("model", F.coalesce(F.trim("model"), default))
    offers = inventory.groupBy("task").agg(
        F.collect_set("model").alias("_models"), F.collect_set("resolution").alias("_res")
    )
    # one row per task
    return (
        asked.join(broadcast_if_small(offers), "task", "left")
        .withColumn(
            "msg",
            F.when(~F.col("task").isin(*DEFAULT_MODEL), "task must be sentiment or price")
            .when(F.col("_models").isNull(), "no models for task")
            .when(~F.array_contains("_res", F.col("resolution")), "resolution not available")
            .when(~F.array_contains("_models", F.col("model")), "model not available"),
        )
        .drop("_models", "_res")
    )


def route_mode(requests: DataFrame, coverage: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``mode_used`` and ``msg``: history when the target lies in it or one step after, else live.

    ``coverage`` has first_ts and last_ts per (task, resolution, *keys).
    """
    step = F.coalesce(
        *[
            F.when(F.col("resolution") == r, F.expr(f"INTERVAL '{s}' SECOND"))
            for r, s in RESOLUTION_SECONDS.items()
        ]
    )
    inside = (F.col("target_ts") >= F.col("first_ts")) & (F.col("target_ts") <= F.col("last_ts") + step)
    mode = F.coalesce(F.col("mode"), F.lit("auto"))
    msg = (
        F.when(F.col("target_ts").isNull(), "bad_target")
        .when(~F.col("resolution").isin(*RESOLUTION_SECONDS), "bad_resolution")
        .when(~mode.isin("auto", "historical", "live"), "bad_mode")
    )
    routed = (
        F.when(mode == "live", "live")
        .when((mode == "historical") & F.col("first_ts").isNotNull(), "historical")
        .when(mode == "historical", "live")
        .when(F.coalesce(inside, F.lit(False)), "historical")
        .otherwise("live")
    )
    joined = join_same(requests, broadcast_if_small(coverage), ["task", "resolution", *keys], "left")
    return joined.withColumn("msg", msg).withColumn("mode_used", F.when(F.col("msg").isNull(), routed)).drop(
        "first_ts", "last_ts"
    )


Stores = Mapping[tuple[str, str], DataFrame]
Scorers = Mapping[tuple[str, str], tuple[DirectionScorer, Sequence[str]]]


def stack_stores(history: Stores, live: Stores, scorers: Scorers, keys: Sequence[str] = (), ts: str = "timestamp") -> DataFrame:
    """All stores as one frame keyed by (task, resolution, mode_used, *keys).

    ``_x`` holds the values of the model's columns, aligned, filled and cast; it is empty where no model reads them.
    """
    out = None
    for mode, stores in (("historical", history), ("live", live)):
        for (task, res), rows in stores.items():
            columns = list(scorers[(task, res)][1]) if (task, res) in scorers else []
            ready = fill_and_cast(align_features(drop_leakage(rows), columns, [*keys, ts]), columns)
            part = ready.select(
                F.lit(task).alias("task"),
                F.lit(res).alias("resolution"),
                F.lit(mode).alias("mode_used"),
                *keys,
                ts,
                F.array(*columns).cast("array<float>").alias("_x"),
            )
            out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no stores")
    return out


def batch_predict(
    requests: DataFrame,
    history: Stores,
    live: Stores,
    scorers: Scorers,
    ts: str = "timestamp",
    split: bool | None = None,
    keys: Sequence[str] = (),
    **kw,
) -> DataFrame:
    """Answer many (request_id, task, resolution, target_ts, mode, model) requests.

    ``keys`` name the series, in requests and stores alike; a null key is a series of its own. All stores and
    requests meet in one ordered pass, keyed by task, resolution, mode and series; then each model scores its rows.
    History counts as covering a target by the span of its own series. Requests without a row in their store, and
    invalid ones, come back with a message and no prediction.
    """
    base = ["request_id", *keys, "task", "resolution", "model", "target_ts", "mode_used"]
    result = [*base, "prediction", "proba_up", "confidence", "msg"]
    # read for the spans and for the matches
    stores = settle(stack_stores(history, live, scorers, keys, ts))
    spans = (
        stores.where("mode_used = 'historical'")
        .groupBy("task", "resolution", *keys)
        .agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    )
    asked = settle(route_mode(requests, spans, keys).select(*base, "msg"))
    valid = F.col("msg").isNull()
    modelled = F.lit(False)
    for task, res in scorers:
        modelled = modelled | ((F.col("task") == task) & (F.col("resolution") == res))
    modelled = F.coalesce(modelled, F.lit(False))

    near = asof_join(
        asked.where(valid & modelled).select(*base),
        stores,
        ["task", "resolution", "mode_used", *keys],
        "target_ts",
        ts,
        ["_x"],
        prefix="_hit",
        split=split,
        **kw,
    ).withColumnRenamed("_hit_x", "_x")
    # one table for all models
    near = settle(near)

    def unanswered(rows: DataFrame, msg: Column) -> DataFrame:
        none = {"prediction": F.lit(None).cast("int"), "proba_up": F.lit(None).cast("double"), "confidence": F.lit(None).cast("double")}
        return rows.withColumns({**none, "msg": msg}).select(*result)

    out = unanswered(asked.where(~valid | ~modelled), F.coalesce("msg", F.lit("no_model")))
    out = out.unionByName(unanswered(near.where(F.col("delta_s").isNull()), F.lit("no_features")))
    for (task, res), (scorer, columns) in scorers.items():
        hit = near.where((F.col("task") == task) & (F.col("resolution") == res) & F.col("delta_s").isNotNull())
        rows = hit.select(*base, *[F.col("_x")[i].alias(c) for i, c in enumerate(columns)])
        good = score_direction(rows, scorer, columns, base)
        out = out.unionByName(good.withColumn("msg", F.lit("ok")).select(*result))
    return out


def fused_requests(df: DataFrame, keys: Mapping[str, tuple[Column, Column]] | None = None) -> DataFrame:
    """One sentiment and one price request per row with request_id, resolution, target_sent, target_price, mode.

    Sentiment has no 24h models and falls back to 4h. ``keys`` gives each key column of the stores its value for the
    sentiment and for the price request.
    """
    keys = keys or {}
    sides = F.array(
        F.struct(
            F.lit("sentiment").alias("task"),
            F.when(F.col("resolution").isin("1h", "4h"), F.col("resolution")).otherwise("4h").alias("resolution"),
            F.col("target_sent").alias("target_ts"),
            *[sent.alias(k) for k, (sent, _) in keys.items()],
        ),
        F.struct(
            F.lit("price").alias("task"),
            F.col("resolution"),
            F.col("target_price").alias("target_ts"),
            *[price.alias(k) for k, (_, price) in keys.items()],
        ),
    )
    return df.select("request_id", "mode", F.explode(sides).alias("_s")).select(
        "request_id",
        "mode",
        "_s.*",
        F.coalesce(*[F.when(F.col("_s.task") == t, F.lit(m)) for t, m in DEFAULT_MODEL.items()]).alias("model"),
    )


def fused_predict(answers: DataFrame) -> DataFrame:
    """Sentiment and price answers of a request side by side; ok when either predicts."""
    def side(task: str, c: str) -> Column:
        return F.max(F.when(F.col("task") == task, F.col(c))).alias(f"{task}_{c}")

    cols = ("prediction", "proba_up", "confidence", "mode_used", "msg")
    wide = answers.groupBy("request_id").agg(*[side(t, c) for t in DEFAULT_MODEL for c in cols])
    either = F.col("sentiment_prediction").isNotNull() | F.col("price_prediction").isNotNull()
    return wide.withColumn("msg", F.when(either, "ok").otherwise("no_prediction"))
