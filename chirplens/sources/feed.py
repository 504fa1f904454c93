"""Landed feed records, and their conversion to posts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplens.functions.times import parse_feed_date
from chirplens.schemas import RAW


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines under ``path``.  A folder that is not there is an empty batch, not an error:
    a failed fetch must not fail the run."""
    try:
        return spark.read.schema(RAW).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RAW)


def normalize(raw: DataFrame, *keep: str) -> DataFrame:
    """Feed records as posts.  A malformed date raises, it does not become NULL."""
    return raw.select(
        F.col("id").alias("tid"),
        F.col("user.screen_name").alias("user"),
        "text",
        parse_feed_date(F.col("created_at")).alias("created_at"),
        # A field of an array of structs is the array of that field.
        F.col("urls.expanded_url").alias("urls"),
        *keep,
    )
