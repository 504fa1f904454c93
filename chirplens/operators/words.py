"""Word branch: words of a post, posts per word, share of posts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirplens.config import WORD_STOPS
from chirplens.functions import scores, text


def token_rows(posts: DataFrame) -> DataFrame:
    """``(tid, token)``, one row per token as written."""
    return posts.select("tid", F.explode(text.tokens(F.col("text"))).alias("token"))


def distinct_word_rows(posts: DataFrame) -> DataFrame:
    """``(tid, word)``, lower case, once per post."""
    return posts.select("tid", F.explode(text.distinct_words(F.col("text"))).alias("word"))


def word_rows(posts: DataFrame, stops: Iterable[str] = WORD_STOPS) -> DataFrame:
    """``(tid, word)`` without stop words."""
    return posts.select("tid", F.explode(text.words_without(F.col("text"), stops)).alias("word"))


def word_doc_freq(posts: DataFrame, stops: Iterable[str] = WORD_STOPS) -> DataFrame:
    """``(word, count)``: the number of posts holding the word.

    Counting is combined before the shuffle, so a word found in a third of all posts costs
    one row per task.
    """
    return word_rows(posts, stops).groupBy("word").agg(F.count("*").alias("count"))


def word_percent(doc_freq: DataFrame, total: DataFrame) -> DataFrame:
    """``(word, percent)``; ``total`` is the one-value frame of ``global_count``.

    The total enters as a scalar subquery: no join, and no division when no word exists.
    """
    return doc_freq.select(
        "word", scores.fraction(F.col("count"), total.scalar()).alias("percent")
    )


def top_words(doc_freq: DataFrame, total: DataFrame, k: int = 500) -> DataFrame:
    """The ``k`` words in most posts, as ``(word, percent)``; ties in word order.

    Ranked by count, which is the same order as by share, so only ``k`` rows are divided.
    """
    return word_percent(doc_freq.orderBy(F.desc("count"), "word").limit(k), total).orderBy(
        F.desc("percent"), "word"
    )
