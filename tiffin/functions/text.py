"""Text repair, damage, keys and small keyword rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The damage modes, in order.
DAMAGE_MODES = ["UPPER", "LOWER", "LEADING_SPACE", "TRAILING_SPACE"]


def sentence_case(text: Column) -> Column:
    """Upper first letter and lower rest of the trimmed text; not initcap."""
    t = F.trim(text)
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30)))


def damaged(text: Column, mode: Column) -> Column:
    """Damage text by mode index; any other index leaves it as it is."""
    return (
        F.when(mode == 0, F.upper(text))
        .when(mode == 1, F.lower(text))
        .when(mode == 2, F.concat(F.lit("   "), text))
        .when(mode == 3, F.concat(text, F.lit("   ")))
        .otherwise(text)
    )


def display_clean(text: Column) -> Column:
    return F.trim(text)


def match_key(text: Column) -> Column:
    return F.lower(F.trim(text))


# Plain words of praise and blame for the keyword baseline.
POSITIVE_WORDS = ["good", "great", "nice", "best", "happy", "excellent", "thanks", "pleased"]
NEGATIVE_WORDS = ["bad", "worst", "awful", "terrible", "stupid", "trash", "worthless",
                  "disgusting", "pathetic", "idiot"]
NOT_IN_WORDS = r"[^\p{L}\p{N}]+"


def word_hits(text: Column, words: list[str]) -> Column:
    """How many whole words of the text are in the list, over the whole text."""
    return F.size(F.filter(F.split(F.lower(text), NOT_IN_WORDS), lambda w: w.isin(*words)))


def keyword_sentiment(text: Column) -> Column:
    score = word_hits(text, POSITIVE_WORDS) - word_hits(text, NEGATIVE_WORDS)
    return F.when(score > 0, "positive").when(score < 0, "negative").otherwise("neutral")


def keyword_confidence(text: Column) -> Column:
    """How one-sided the keywords are: 0 if none or as many of both, 1 if all are of one side."""
    up, down = word_hits(text, POSITIVE_WORDS), word_hits(text, NEGATIVE_WORDS)
    return F.abs(up - down) / F.greatest(up + down, F.lit(1))


# Review issue categories and the words that flag them.
ISSUE_WORDS = {
    "late": ["late", "waiting", "hour", "hours"],
    "temperature": ["cold", "temperature"],
    "quality": ["quality", "poor", "stale", "trash", "worthless"],
    "wrong_order": ["wrong", "missing"],
    "packaging": ["packaging", "leaked", "spilled"],
    "courier": ["courier", "rider", "moron", "clown"],
}


def issues(text: Column) -> Column:
    """Every category of which a whole word occurs; ``other`` when none does."""
    words = F.split(F.lower(text), NOT_IN_WORDS)
    found = F.array_compact(F.array(*[
        F.when(F.arrays_overlap(words, F.array(*map(F.lit, flags))), F.lit(name))
        for name, flags in ISSUE_WORDS.items()
    ]))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("other")))


def outcome_class(delivered: Column, late_minutes: Column, refunded: Column,
                  rating: Column) -> Column:
    """What measurably happened, from facts only."""
    bad = ~delivered | refunded | (rating <= 2) | (late_minutes >= 30)
    middling = (late_minutes >= 10) | (rating == 3)
    return F.when(bad, "negative").when(middling, "neutral").otherwise("positive")
