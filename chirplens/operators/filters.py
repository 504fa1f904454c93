"""Recency filters and listings over the post table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirplens.functions import times


def filter_recent(posts: DataFrame, as_of: datetime, days: int = 4) -> DataFrame:
    """Posts created after ``as_of - days``; a missing date drops the post."""
    return posts.where(times.is_recent(F.col("created_at"), as_of, days))


def filter_as_of(posts: DataFrame, as_of: datetime, days: int = 4) -> DataFrame:
    """As ``filter_recent``, on event times cut to whole seconds."""
    return posts.where(times.is_recent_in_seconds(F.col("created_at"), as_of, days))


def latest_first(posts: DataFrame) -> DataFrame:
    return posts.orderBy(F.desc("created_at"), "tid")


def global_count(posts: DataFrame) -> DataFrame:
    """One row, one column ``n``: every post counts, also those without text."""
    return posts.agg(F.count("*").alias("n"))
