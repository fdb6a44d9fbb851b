"""Text rules over article columns: relevance, keyword sentiment, axis tags."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keyword lists, relevance pattern and axis rules.
POSITIVE_WORDS = ("bull", "rally", "gain", "up", "surge", "support", "buy", "approval", "adoption")
NEGATIVE_WORDS = ("bear", "dump", "down", "selloff", "risk", "regulation", "ban", "hack", "volatility")
RELEVANT_PATTERN = "bitcoin|btc"
AXES = ("BTC", "MACRO", "TECH")
# anything but a letter, a digit or an underscore, in any script, ends a word
_EDGE = r"[^\p{L}\p{N}_]"


def word_pattern(words: tuple[str, ...]) -> str:
    return f"(^|{_EDGE})({'|'.join(words)})($|{_EDGE})"


@dataclass(frozen=True)
class AxisRule:
    axis: str
    any_of: tuple[str, ...]
    none_of: tuple[str, ...] = field(default=())


AXIS_RULES = (
    AxisRule(
        "BTC",
        ("bitcoin", "btc", "cryptocurrency", "crypto price", "digital gold"),
        ("fraud", "scam", "hack", "theft"),
    ),
    AxisRule(
        "TECH",
        (
            "ram memory", "blockchain", "web3", "metaverse", "ai investment", "defi", "mining rig",
            "semiconductor shortage",
        ),
    ),
    AxisRule(
        "MACRO",
        (
            "fed", "interest rate", "inflation", "recession", "treasury bond", "stock market crash",
            "quantitative easing",
        ),
    ),
)


def article_text(title: Column | str, description: Column | str) -> Column:
    t = F.col(title) if isinstance(title, str) else title
    d = F.col(description) if isinstance(description, str) else description
    return F.concat(F.coalesce(t, F.lit("")), F.lit(" "), F.coalesce(d, F.lit("")))


def hits(text: Column, words: tuple[str, ...], whole_word: bool = False) -> Column:
    """How many different words the text holds; substrings count unless ``whole_word``."""
    low = F.lower(text)
    total = F.lit(0)
    for word in words:
        found = low.rlike(word_pattern((word,))) if whole_word else low.contains(word)
        total = total + found.cast("int")
    return total


def is_relevant(text: Column, pattern: str = RELEVANT_PATTERN) -> Column:
    return F.lower(text).rlike(pattern)


def matched_axes(text: Column, rules: tuple[AxisRule, ...] = AXIS_RULES) -> Column:
    """Array of the axes whose rule the text meets, matching whole words."""
    low = F.lower(text)
    tags = []
    for rule in rules:
        met = low.rlike(word_pattern(rule.any_of))
        if rule.none_of:
            met = met & ~low.rlike(word_pattern(rule.none_of))
        tags.append(F.when(met, F.lit(rule.axis)))
    return F.array_compact(F.array(*tags))
