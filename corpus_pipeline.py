"""The corpus pipeline: documents are filtered, de-duplicated, cut, decontaminated and encoded, stage by stage.

Each stage takes (spark, docs, folder) and works on all rows its predecessor kept; every stage but the last returns the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import decontaminate, encoding, neardup, quality, substrings
from driftline.llm.common import load, ready, settled
from driftline.llm.queries import TOKENIZER

# SQL cannot fit the classifier, draw the weighted samples or segment the words
ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the rule ensemble, learnt from the labels of the rows at hand, scores at the threshold or higher."""
    ready(spark)
    return quality.keep_good(docs, quality.fit(docs, load(spark, folder, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each near-duplicate class."""
    ready(spark)
    return neardup.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the passages that an earlier one has; untouched texts stay as they are."""
    ready(spark)
    own = "cut_"  # before the operator's own columns, so that those of the documents stay
    while any(c.lower().startswith(own) for c in docs.columns):
        own = f"_{own}"
    cut = substrings.remove_repeats(docs, prefix=own)
    touched, rest = F.col(f"{own}n_removed") > 0, F.col(f"{own}rest")
    made = {
        "text": F.when(touched, rest).otherwise(F.col("text")),
        "n_chars": F.when(touched, F.length(rest).cast("bigint")).otherwise(F.col("n_chars")),
    }
    return cut.select(*[made[c].alias(c) if c in made else F.col(c) for c in docs.columns])


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    ready(spark)
    return decontaminate.drop_contaminated(docs, load(spark, folder, "benchmark"))


def sentencepiece_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Ids and decoded text of what is left, as counts and digests."""
    ready(spark)
    return encoding.digests(encoding.encode(docs.select("doc_id", "text"), encoding.read_model(TOKENIZER)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("sentencepiece_ids", sentencepiece_ids),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, folder), f"stage-{name}")
    return STAGES[-1][1](spark, docs, folder)
