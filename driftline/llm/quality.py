"""Quality classifier: a sparse ensemble of rules that trees over text statistics suggest and a lasso weighs.

Trees of a random forest are cut into conjunctive rules (every path from the root, whole or part), a logistic
regression with an L1 penalty keeps few of them, and the kept rules become one column expression. Scoring is a
projection: no shuffle and no Python.

Fitting reads at most ``max_train`` labelled rows, those with the smallest hash of doc_id; all else covers every row.
Defined cases: a null text counts as empty and is scored; a doc_id labelled twice takes its larger label, one that
occurs twice among the documents gives one training row; null labels and labels of unknown documents teach nothing;
without any label every score is 1, with labels of one kind only every score is that label. A null doc_id is never
held out. Columns of the input, whatever their names, never feed a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import fresh, settled

THRESHOLD = 0.7
MAX_TRAIN = 20_000
STATISTICS = (
    "log_words", "distinct_share", "repeat_share", "letter_share", "upper_share", "digit_share", "mark_share",
    "word_length", "words_per_line",
)

Rule = tuple[tuple[int, float, float], ...]  # (statistic, over, up to) for each statistic the rule looks at


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[float, Rule], ...]
    constant: float | None = None


def with_statistics(docs: DataFrame, out: str, text: str = "text") -> DataFrame:
    """Add an array of the statistics of each whole text."""
    words = fresh(docs, "_words")
    t = F.coalesce(F.col(text), F.lit(""))
    parts = docs.withColumn(words, F.filter(F.split(t, r"\s+"), lambda w: w != ""))
    n_words = F.size(words)
    n = F.greatest(n_words, F.lit(1))

    def length_without(pattern: str) -> Column:
        return F.length(F.regexp_replace(t, pattern, ""))

    spaces, letters = length_without(r"\S+"), length_without(r"\P{L}+")
    uppers, digits = length_without(r"\P{Lu}+"), length_without(r"\P{Nd}+")
    chars = F.greatest(F.length(t) - spaces, F.lit(1))
    repeats = F.size(F.filter(F.col(words), lambda w, i: (i > 0) & (w == F.get(F.col(words), i - 1))))
    shares = {
        "log_words": F.log1p(n_words.cast("double")),
        "distinct_share": F.size(F.array_distinct(words)) / n,
        "repeat_share": repeats / n,
        "letter_share": letters / chars,
        "upper_share": uppers / F.greatest(letters, F.lit(1)),
        "digit_share": digits / chars,
        "mark_share": (F.length(t) - spaces - letters - digits) / chars,
        "word_length": (F.length(t) - spaces) / n,
        "words_per_line": n_words / (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1),
    }
    values = F.array(*[shares[s].cast("double") for s in STATISTICS])
    return parts.withColumn(out, values).drop(words)


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, trees: int = 24, depth: int = 4, penalty: float = 0.002) -> RuleModel:
    """Learn rules and weights from the labelled rows that are not held out."""
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    sample = settled(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train), "quality-sample")
    rows = (
        with_statistics(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "stats")
        .groupBy("doc_id")
        .agg(F.min(F.struct(F.col("label").cast("double").alias("label"), "stats")).alias("row"))
        .select("doc_id", "row.label", "row.stats")
    )
    rows = settled(rows.repartition(8, "doc_id").sortWithinPartitions("doc_id"), "quality-rows")
    counts = {int(r["label"]): r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return RuleModel(0.0, (), float(next(iter(counts), 1)))

    forest = RandomForestClassifier(
        labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, featureSubsetStrategy="0.6",
        minInstancesPerNode=3, maxBins=64, seed=7,
    )
    features = rows.select("label", array_to_vector(F.col("stats")).alias("features"))
    found = sorted({r for tree in forest.fit(features).trees for r in paths(tree.toDebugString)})
    if not found:
        return RuleModel(0.0, (), counts[1] / sum(counts.values()))
    holds = rows.select("label", array_to_vector(F.array(*[fires(r, F.col("stats")).cast("double") for r in found])).alias("features"))
    lasso = LogisticRegression(labelCol="label", featuresCol="features", elasticNetParam=1.0, regParam=penalty, maxIter=200)
    weights = lasso.fit(holds)
    kept = tuple((float(w), r) for w, r in zip(weights.coefficients.toArray(), found) if w)
    return RuleModel(float(weights.intercept), kept)


def paths(printed: str) -> set[Rule]:
    """Conjunctions on the way from a tree's root to each of its nodes."""
    rules: set[Rule] = set()
    trail: list[tuple[int, int, float, float]] = []  # indent, statistic, over, up to
    for line in printed.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\deE]+)\)", line)
        if not m:
            continue
        indent, cut = len(m[1]), float(m[4])
        trail = [t for t in trail if t[0] < indent]
        low, high = (float("-inf"), cut) if m[3] == "<=" else (cut, float("inf"))
        trail.append((indent, int(m[2]), low, high))
        bounds: dict[int, tuple[float, float]] = {}
        for _, k, a, b in trail:
            x, y = bounds.get(k, (float("-inf"), float("inf")))
            bounds[k] = (max(a, x), min(b, y))
        rules.add(tuple((k, *bounds[k]) for k in sorted(bounds)))
    return rules


def fires(rule: Rule, stats: Column) -> Column:
    conds = []
    for k, low, high in rule:
        if low != float("-inf"):
            conds.append(stats[k] > low)
        if high != float("inf"):
            conds.append(stats[k] <= high)
    return reduce(lambda a, b: a & b, conds)


def score_of(model: RuleModel, stats: Column) -> Column:
    """The model as one expression over the array of statistics, between 0 and 1."""
    if model.constant is not None:
        return F.lit(float(model.constant))
    total = reduce(
        lambda a, b: a + b,
        [F.when(fires(r, stats), F.lit(w)).otherwise(F.lit(0.0)) for w, r in model.rules],
        F.lit(model.intercept),
    )
    return 1.0 / (1.0 + F.exp(-total))


def score_quality(docs: DataFrame, model: RuleModel, out: str = "score", text: str = "text") -> DataFrame:
    """The documents with a score each; a column of that name is replaced."""
    stats = fresh(docs, "_stats")
    return with_statistics(docs, stats, text).withColumn(out, score_of(model, F.col(stats))).drop(stats)


def keep_good(docs: DataFrame, model: RuleModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with their own columns, that score at least the threshold."""
    stats, barrier = fresh(docs, "_stats"), fresh(docs, "_barrier")
    # a filter is not pushed below a column of row numbers, so the statistics stay one column instead of being
    # written out, and computed, at each mention in a rule
    rows = with_statistics(docs, stats).withColumn(barrier, F.monotonically_increasing_id())
    good = (score_of(model, F.col(stats)) >= threshold) & (F.col(barrier) >= 0)
    return rows.where(good).drop(stats, barrier)
