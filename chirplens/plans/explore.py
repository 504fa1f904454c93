"""Queries on the accumulated result tables, each a filter on ``ts`` and one aggregation.

The tables hold one ranked list per run, and the windows of runs overlap: numbers of the same
key are compared between runs (maximum), never added up.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chirplens.config import RunGrid
from chirplens.functions import scores, times


def _first(ranked: DataFrame, k: int | None) -> DataFrame:
    """All rows, or the first ``k`` if a caller asks for so many."""
    return ranked if k is None else ranked.limit(k)


def recent_interesting_pairs(
    cooccur: DataFrame, as_of: datetime, days: int = 4, k: int | None = None
) -> DataFrame:
    """Pairs of the last days by their best score, with the count of that run."""
    recent = cooccur.where(times.is_recent(F.col("ts"), as_of, days))
    best = F.max(F.struct("log_weight", "count")).alias("best")
    pairs = recent.groupBy("w1", "w2").agg(best).select("w1", "w2", "best.log_weight", "best.count")
    return _first(pairs.orderBy(F.desc(scores.rank_key(F.col("log_weight"))), "w1", "w2"), k)


def emerging_pairs(cooccur: DataFrame, as_of: datetime, days: int = 1) -> DataFrame:
    """Pairs ranked in the last day but in no earlier run.

    One pass: a pair is new if its first ranked run is recent.  No anti-join, and a pair that
    was ranked in every run is combined to one row per task before the shuffle.
    """
    seen = cooccur.groupBy("w1", "w2").agg(
        F.min("ts").alias("first_ts"), F.max("log_weight").alias("log_weight")
    )
    fresh = seen.where(F.col("first_ts") > times.ntz(as_of - timedelta(days=days)))
    return fresh.select("w1", "w2", "log_weight")


def popular_words_in_period(
    word_counts: DataFrame, start: datetime, end: datetime, k: int | None = None
) -> DataFrame:
    period = word_counts.where(F.col("ts").between(times.ntz(start), times.ntz(end)))
    best = period.groupBy("word").agg(F.max("percent").alias("percent"))
    return _first(best.orderBy(F.desc("percent"), "word"), k)


def top_urls_recent(urls: DataFrame, as_of: datetime, days: int = 4, k: int | None = None) -> DataFrame:
    recent = urls.where(times.is_recent(F.col("ts"), as_of, days))
    best = recent.groupBy("url").agg(F.max("count").alias("count"))
    return _first(best.orderBy(F.desc("count"), "url"), k)


def pair_trend(cooccur: DataFrame) -> DataFrame:
    """Count of each pair next to its count in the last run before in which it was ranked.  A pair
    has at most one row per run, so a window group is no longer than the number of runs."""
    runs = Window.partitionBy("w1", "w2").orderBy("ts")
    before = F.lag("count").over(runs)
    return cooccur.select(
        "w1",
        "w2",
        "ts",
        "count",
        before.alias("previous"),
        (F.col("count") - before).alias("change"),
    )


def pair_trend_on_grid(cooccur: DataFrame, grid: RunGrid) -> DataFrame:
    """Count of each pair next to its count one run of the grid before, with gaps as such.

    ``previous`` and ``change`` are NULL if the pair was not ranked in that run.  ``last_ts`` is
    the last run before in which it was, and ``missed`` the runs in between; both are NULL where
    a pair is ranked for the first time.  ``next_missed`` counts the runs behind it in which the
    pair is not ranked, up to its next one or the end of the grid.
    """
    runs = Window.partitionBy("w1", "w2").orderBy("run")
    numbered = cooccur.withColumn("run", times.first_run(F.col("ts"), grid))
    placed = numbered.select(
        "w1",
        "w2",
        "ts",
        "count",
        "run",
        F.lag("run").over(runs).alias("last_run"),
        F.lag("ts").over(runs).alias("last_ts"),
        F.lag("count").over(runs).alias("last_count"),
        F.coalesce(F.lead("run").over(runs), F.lit(grid.runs)).alias("next_run"),
    )
    previous = F.when(F.col("last_run") == F.col("run") - 1, F.col("last_count"))
    return placed.select(
        "w1",
        "w2",
        "ts",
        "count",
        previous.alias("previous"),
        (F.col("count") - previous).alias("change"),
        "last_ts",
        (F.col("run") - F.col("last_run") - 1).alias("missed"),
        (F.col("next_run") - F.col("run") - 1).alias("next_missed"),
    )
