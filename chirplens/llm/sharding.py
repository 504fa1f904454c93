"""Shards from a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirplens.env import checkpointed
from chirplens.llm.common import fits, has_rows

SHARDS = 8
VIRTUAL_NODES = 128
MOST_NODES = 1 << 16
# Rows of an arc are numbered in buckets of about so many rows.
BUCKET_ROWS = 20_000


def ring(shards: int, nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Places of all virtual nodes in ring order, and the shard of each."""
    if not 0 < shards * nodes <= MOST_NODES:
        raise ValueError(f"from 1 to {MOST_NODES} virtual nodes")
    placed = sorted(
        (int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big", signed=True), s)
        for s in range(shards)
        for v in range(nodes)
    )
    return np.array([p for p, _ in placed], np.int64), np.array([s for _, s in placed])


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard: the mean and ``slack`` of it, at least what all rows need."""
    if slack > 0:
        return [math.ceil(rows * (1 + slack) / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(
    counts: dict[int, int], owners: np.ndarray, room: list[int]
) -> list[tuple[int, int, int, int, int]]:
    """``(arc, first, past, shard, slot)``: where the rows ``first <= rank < past`` of an arc go.

    Arcs fill their own shard in ring order; then the rows left over continue clockwise from
    their arc to the next shard that has room.
    """
    free, used = list(room), [0] * len(room)
    segments = []
    done = {}

    def put(arc: int, first: int, rows: int, shard: int) -> int:
        n = min(rows, free[shard])
        if n:
            segments.append((arc, first, first + n, shard, used[shard]))
            free[shard] -= n
            used[shard] += n
        return n

    for arc in sorted(counts):
        done[arc] = put(arc, 0, counts[arc], int(owners[arc]))
    for arc in sorted(counts):
        at = arc
        while done[arc] < counts[arc]:
            at = (at + 1) % len(owners)
            done[arc] += put(arc, done[arc], counts[arc] - done[arc], int(owners[at]))
    return segments


def _arc(place: Column, places: np.ndarray) -> Column:
    """Number of the first virtual node at or after a place, clockwise."""

    @F.pandas_udf("int")
    def arc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = np.searchsorted(places, batch.to_numpy(np.int64)) % len(places)
            yield pd.Series(found.astype(np.int32))

    return arc(place)


def assign(
    docs: DataFrame,
    shards: int = SHARDS,
    slack: float = 0.0,
    nodes: int = VIRTUAL_NODES,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``docs`` with ``shard`` (from 0) and ``slot`` (gapless from 0 within a shard).

    A row belongs to the virtual node that follows the hash of its id.  A shard takes at most
    ``ceil(mean * (1 + slack))`` rows, without slack the mean rounded up or down, so that counts
    differ by one at most; rows of an arc beyond that continue clockwise, the last of the arc
    first.  Ranks within an arc follow hash, id and text, so the result depends on the set of
    rows only; repeated rows are interchangeable.

    The driver sees one count per virtual node, a fixed number.  Rows are shuffled once, into
    buckets of an arc; a bucket that one repeated id has made large is split over the input
    partitions (then the rows are checkpointed first).  NULL ids and texts count as values like
    others.  An empty table gives an empty result.  Columns named like an added one are replaced.
    """
    places, owners = ring(shards, nodes)
    n = docs.count()
    buckets = 1 + n // (len(places) * bucket_rows)
    place = F.xxhash64(F.col(id_col), F.lit(1))
    rows = docs.drop("shard", "slot").withColumns(
        {
            "__place": place,
            "__bucket": F.pmod(F.xxhash64(F.col(id_col), F.lit(2)), F.lit(buckets)),
            "__part": F.lit(0),
        }
    )
    rows = rows.withColumn("__arc", _arc(F.col("__place"), places))
    keys = ["__arc", "__bucket", "__part"]
    counts = checkpointed(rows.groupBy(*keys).agg(F.count("*").alias("__rows")))
    hot = counts.where(F.col("__rows") > 8 * bucket_rows).select(*keys[:2], F.lit(True).alias("__hot"))
    if has_rows(hot):
        hot = F.broadcast(hot) if fits(hot, 64) else hot.hint("merge")
        part = F.when(F.col("__hot"), F.spark_partition_id()).otherwise(F.lit(0))
        rows = checkpointed(rows.join(hot, keys[:2], "left").withColumn("__part", part).drop("__hot"))
        counts = checkpointed(rows.groupBy(*keys).agg(F.count("*").alias("__rows")))
    # At most one row per virtual node reaches the driver.
    arcs = {r["__arc"]: r["rows"] for r in counts.groupBy("__arc").agg(F.sum("__rows").alias("rows")).collect()}
    segments = walk(arcs, owners, capacities(n, shards, slack))
    table = docs.sparkSession.createDataFrame(
        segments, "__arc int, __first long, __past long, shard int, __slot long"
    )
    order = Window.partitionBy("__arc").orderBy("__bucket", "__part")
    starts = counts.withColumn("__start", F.sum("__rows").over(order) - F.col("__rows")).drop("__rows")
    within = Window.partitionBy(*keys).orderBy("__place", id_col, F.xxhash64(F.col(text_col)))
    ranked = rows.withColumn("__n", F.row_number().over(within) - 1).join(starts.hint("merge"), keys)
    ranked = ranked.withColumn("__rank", F.col("__start") + F.col("__n"))
    t = F.broadcast(table.withColumnRenamed("__arc", "__at"))
    inside = (
        (F.col("__arc") == F.col("__at"))
        & (F.col("__rank") >= F.col("__first"))
        & (F.col("__rank") < F.col("__past"))
    )
    placed = ranked.join(t, inside).withColumn("slot", F.col("__slot") + F.col("__rank") - F.col("__first"))
    return placed.select(*[c for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")
