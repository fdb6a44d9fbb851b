"""Decision rules and report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.numeric import confidence_percent, label_by, score_percent
from driftline.functions.text import NEGATIVE_WORDS, POSITIVE_WORDS, article_text, hits

NEUTRAL_MOVE = 0.002
KEYWORD_CUT = 0.15


def direction_from_price(base: str, pred: str, neutral: float = NEUTRAL_MOVE) -> dict[str, Column]:
    """Relative change and its label; missing or zero base is neutral."""
    move = F.try_divide(F.col(pred) - F.col(base), F.col(base))
    label = F.when(move > neutral, "UP").when(move < -neutral, "DOWN").otherwise("NEUTRAL")
    return {"move": move, "direction": label}


def combine_signal(price_class: Column | str, sentiment_label: Column | str) -> Column:
    """Price decides unless sentiment contradicts it; without a price class sentiment decides."""
    price = F.col(price_class) if isinstance(price_class, str) else price_class
    mood = F.col(sentiment_label) if isinstance(sentiment_label, str) else sentiment_label
    mood_class = F.when(mood == "POSITIVE", 1).when(mood == "NEGATIVE", 0)
    word = lambda c: F.when(c == 1, "UP").otherwise("DOWN")
    return (
        F.when(price.isin(0, 1) & (mood_class.isNull() | (mood_class == price)), word(price))
        .when(price.isin(0, 1), "MIXED")
        .when(mood_class.isNotNull(), word(mood_class))
        .otherwise("NEUTRAL")
    )


def keyword_sentiment(
    df: DataFrame,
    keys: Sequence[str],
    title: str,
    description: str | None = None,
    whole_word: bool = False,
    positive: tuple[str, ...] = POSITIVE_WORDS,
    negative: tuple[str, ...] = NEGATIVE_WORDS,
) -> DataFrame:
    """Keyword hits summed per key, their normalised balance and its label."""
    body = F.col(description) if description else F.lit(None).cast("string")
    text = article_text(F.col(title), body)
    pos, neg = F.col("pos_hits"), F.col("neg_hits")
    return (
        df.groupBy(*keys)
        .agg(
            F.coalesce(F.sum(hits(text, positive, whole_word)), F.lit(0)).alias("pos_hits"),
            F.coalesce(F.sum(hits(text, negative, whole_word)), F.lit(0)).alias("neg_hits"),
        )
        .withColumn("score", (pos - neg) / F.greatest(pos + neg, F.lit(1)))
        .withColumn("label", label_by("score", KEYWORD_CUT))
    )


def final_signal(df: DataFrame, price_class: str, confidence: str, score: str, label: str) -> DataFrame:
    """Combined label with the two whole percentages shown next to it."""
    return df.withColumns(
        {
            "final_label": combine_signal(price_class, label),
            "sentiment_percent": score_percent(score),
            "confidence_percent": confidence_percent(confidence),
        }
    )
