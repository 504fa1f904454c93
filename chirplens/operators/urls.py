"""URL branch: mentions of URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def url_rows(posts: DataFrame) -> DataFrame:
    """``(tid, url)``, lower case, one row per mention; posts without a list have none, and a
    missing entry of a list is an empty string."""
    return posts.select("tid", F.explode("urls").alias("url")).select(
        "tid", F.lower(F.coalesce("url", F.lit(""))).alias("url")
    )


def url_counts(posts: DataFrame) -> DataFrame:
    """``(url, count)``: mentions, repeated ones within a post included."""
    return url_rows(posts).groupBy("url").agg(F.count("*").alias("count"))


def top_urls(counts: DataFrame, k: int = 300) -> DataFrame:
    return counts.orderBy(F.desc("count"), "url").limit(k)
