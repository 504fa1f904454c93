"""The report at many times at once: a window slides over the posts, one run per time.

The rankings run their jobs at once and return small checkpointed frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirplens.config import WORD_STOPS, RunGrid
from chirplens.functions import scores, text, times
from chirplens.operators.top_pairs import top_pairs_per_run
from chirplens.operators.windows import (
    SPAN,
    count_per_run,
    most_frequent_per_run,
    with_span,
)


def _stamp(frame: DataFrame, grid: RunGrid, *columns: str) -> DataFrame:
    return frame.select(*columns, times.run_time(F.col("run"), grid).alias("ts"))


def word_counts_backfill(posts: DataFrame, grid: RunGrid, k: int = 500) -> DataFrame:
    seen = with_span(posts, grid)
    totals = count_per_run(seen.select(*SPAN), []).withColumnRenamed("count", "total")
    rows = seen.select(
        *SPAN, F.explode(text.words_without(F.col("text"), WORD_STOPS)).alias("word")
    )
    top = most_frequent_per_run(rows, "word", k)
    # ``totals`` has one row per run of the grid.
    shares = top.join(F.broadcast(totals), "run").withColumn(
        "percent", scores.fraction(F.col("count"), F.col("total"))
    )
    return _stamp(shares, grid, "word", "percent")


def urls_backfill(posts: DataFrame, grid: RunGrid, k: int = 300) -> DataFrame:
    rows = with_span(posts, grid).select(*SPAN, F.explode("urls").alias("url"))
    rows = rows.select(*SPAN, F.lower(F.coalesce("url", F.lit(""))).alias("url"))
    return _stamp(most_frequent_per_run(rows, "url", k), grid, "url", "count")


def word_cooccur_backfill(posts: DataFrame, grid: RunGrid, k: int = 300) -> DataFrame:
    top = top_pairs_per_run(with_span(posts, grid), k)
    return _stamp(top, grid, "w1", "w2", "count", "log_weight")
