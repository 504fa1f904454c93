"""Keyed updates and the incremental take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def high_water_mark(posts: DataFrame) -> DataFrame:
    """One row: the greatest stored id, NULL for an empty store."""
    return posts.agg(F.max("tid").alias("last_id"))


def incremental_take(
    raw: DataFrame, last_id: int | Column | None, page_size: int | None = None
) -> DataFrame:
    """The feed records with an id above the mark, all of them; an empty store has no mark.

    ``page_size`` takes the records of about so many lowest ids only: the next take starts where
    this one ended, so a backlog is drained page by page and nothing is lost.  An id that was
    sent several times is never cut in two.
    """
    mark = last_id if isinstance(last_id, Column) else F.lit(last_id).cast("long")
    fresh = raw.where(F.coalesce(F.col("id") > mark, mark.isNull()))
    if page_size is None:
        return fresh
    page = fresh.select("id").orderBy("id").limit(page_size)
    return fresh.where(F.col("id") <= page.agg(F.max("id").alias("id")).scalar())


def newest_per_id(posts: DataFrame, *newest_first: Column) -> DataFrame:
    """One row per ``tid``, the first in the given order, whole rows.

    Rows that cannot win are dropped before the shuffle (Spark's group limit), so an id that
    was landed again and again does not fill a task.
    """
    rank = F.row_number().over(Window.partitionBy("tid").orderBy(*newest_first))
    return posts.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def upsert(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """``stored`` with the rows of ``incoming`` put in by ``tid``; both unique on it."""
    return stored.join(incoming.select("tid"), "tid", "left_anti").unionByName(
        incoming.select(*stored.columns)
    )
