"""Scoring expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scores are ranked after rounding, so that values equal on paper tie on every platform.
RANK_DIGITS = 9


def fraction(count: Column, total: Column) -> Column:
    return count.cast("double") / total.cast("double")


def pair_score(count: Column, percent1: Column, percent2: Column) -> Column:
    """Pair count times the log of the smaller inverse share: common words weigh little."""
    return count.cast("double") * F.ln(F.least(1 / percent1, 1 / percent2))


def word_bound(doc_freq: Column, total: Column) -> Column:
    """No pair with this word can score higher.

    With ``d1, d2`` the posts holding each word and ``N`` all posts, a pair is in at most
    ``min(d1, d2)`` posts and weighs ``ln(N / max(d1, d2))``; replacing either by the word's
    own ``d`` only raises the product, to ``d * ln(N / d)``.
    """
    d = doc_freq.cast("double")
    return d * F.ln(total.cast("double") / d)


def rank_key(score: Column) -> Column:
    return F.round(score, RANK_DIGITS)
