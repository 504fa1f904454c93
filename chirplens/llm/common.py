"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplens.env import checkpointed, use_checkpoint_dir

# A frame is broadcast only if it was counted and is at most so large.
BROADCAST_BYTES = 32 << 20

# What a task keeps of the words it has seen, so that memory is bounded for any vocabulary.
CACHED_WORDS = 80_000

# Texts go to Python in batches of at most so many bytes (and one text).
BATCH_BYTES = 4 << 20

# The separators of words, as one character class.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bounds the memory of Python workers by the bytes of a batch, not by its rows.

    A session setting, lowered and never raised.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).lower().rstrip("b")
    if not (now.isdigit() and 0 < int(now) <= BATCH_BYTES):
        spark.conf.set(key, str(BATCH_BYTES))


def as_text(column: str) -> Column:
    """An id on its way through pandas, where numbers beside a NULL would turn into floats."""
    return F.col(column).cast("string")


def has_rows(frame: DataFrame) -> bool:
    return bool(frame.take(1))


def fits(frame: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``frame``, counted now, is at most ``limit`` bytes."""
    return frame.count() * row_bytes <= limit


def same(left, right):
    """Equality that treats NULL as a value."""
    return left.eqNullSafe(right)


def join_ids(
    facts: DataFrame, ids: DataFrame, how: str, id_col: str, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``facts`` semi- or anti-joined with the one-column frame ``ids``, NULL equal to NULL.

    ``ids`` is broadcast if its counted size allows; beyond that both sides are shuffled, and
    Spark splits the partitions of a hot id.
    """
    key = ids.select(F.col(id_col).alias("__id")).distinct()
    key = F.broadcast(key) if fits(key, 64, limit) else key.hint("merge")
    return facts.join(key, same(facts[id_col], key["__id"]), how)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of the undirected graph with the long columns ``a, b``: the least
    node reachable, for every node that has an edge.

    Large-star and small-star steps alternate until nothing changes, a number of rounds that
    is logarithmic in practice.  Only minima and edges are shuffled, combined first; a node
    with very many neighbours is one skewed join key, which Spark splits.  Each round is
    checkpointed.
    """
    now = checkpointed(edges.where("a <> b").select("a", "b").distinct())
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum("b")).first()
        if state == before or not state[0]:
            break
        before = state
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        )
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        now = checkpointed(small.where("a <> b").distinct())
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return ends.unionByName(roots)


def stage_folder(spark: SparkSession) -> str:
    """A new folder below the one that all executors share."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/stages-{uuid.uuid4().hex}"
