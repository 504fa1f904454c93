"""Exact duplicates by two-pass Bloom filtering: only rows that may repeat are shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chirplens.env import checkpointed
from chirplens.llm.common import BROADCAST_BYTES, fits, has_rows
from chirplens.llm.shingles import mixed

# Cells per row that a filter aims at, and most cells it has (2 ** 29 bits are 64 MB).  With more
# rows than that serves well, more rows than necessary are shuffled; results stay exact.
CELLS_PER_ROW = 16
MOST_CELLS_LOG2 = 29
_LEAST_CELLS_LOG2 = 16
# The cells are merged in so many segments, one group each.
_SEGMENTS_LOG2 = 8
_CHUNK = 1 << 18
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def cells_log2(rows: int) -> int:
    wanted = max(1, rows * CELLS_PER_ROW - 1).bit_length()
    return min(MOST_CELLS_LOG2, max(_LEAST_CELLS_LOG2, wanted))


def _cells(hashes: np.ndarray, log2: int) -> tuple[np.ndarray, np.ndarray]:
    """The two cells of every hash."""
    shift = np.uint64(64 - log2)
    with np.errstate(over="ignore"):
        h = hashes.view(np.uint64)
        return (mixed(h) >> shift).astype(np.uint32), (mixed(h ^ _SECOND) >> shift).astype(np.uint32)


def repeated_cells(hashes: DataFrame, log2: int) -> np.ndarray:
    """First pass: a bit for every cell of the filter that is hit twice or more.

    A task sends the cells it has hit once and those it has hit again, each cell once however
    often its hash occurs, so a hot hash costs one entry per task.  Segments of the filter are
    merged in groups; the driver puts them together, ``2 ** log2`` bits.
    """
    inner = log2 - _SEGMENTS_LOG2

    def tell(hit: list[np.ndarray]) -> pd.DataFrame:
        cells, counts = np.unique(np.concatenate(hit), return_counts=True)
        segments = cells >> np.uint32(inner)
        inside = cells & np.uint32((1 << inner) - 1)
        names, starts = np.unique(segments, return_index=True)
        rows = []
        for name, part, n in zip(
            names, np.split(inside, starts[1:]), np.split(counts, starts[1:]), strict=True
        ):
            rows.append((int(name), part[n == 1].tobytes(), part[n > 1].tobytes()))
        return pd.DataFrame(rows, columns=["segment", "once", "again"])

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hit, held = [], 0
        for batch in batches:
            hit.extend(_cells(batch["h"].to_numpy(np.int64), log2))
            held += len(batch)
            if held >= _CHUNK:
                yield tell(hit)
                hit, held = [], 0
        if held:
            yield tell(hit)

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        seen, again = np.zeros(1 << inner, bool), np.zeros(1 << inner, bool)
        for once, more in zip(group["once"], group["again"], strict=True):
            cells = np.frombuffer(once, np.uint32)
            again[cells[seen[cells]]] = True
            seen[cells] = True
            cells = np.frombuffer(more, np.uint32)
            seen[cells] = True
            again[cells] = True
        return pd.DataFrame({"segment": group["segment"].iloc[:1], "bits": [np.packbits(again).tobytes()]})

    told = hashes.select(F.col("h")).mapInPandas(collect, "segment int, once binary, again binary")
    merged = told.groupBy("segment").applyInPandas(merge, "segment int, bits binary")
    bits = np.zeros((1 << log2) // 8, np.uint8)
    width = (1 << inner) // 8
    for row in merged.toLocalIterator():
        bits[row["segment"] * width : (row["segment"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return bits


def may_repeat(h: Column, bits: np.ndarray, log2: int, frame: DataFrame) -> Column:
    """Second pass: whether both cells of a hash are hit twice; true for every repeated hash."""
    shared = frame.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def test(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bits = shared.value
        for batch in batches:
            hit = np.ones(len(batch), bool)
            for cells in _cells(batch.to_numpy(np.int64), log2):
                hit &= (bits[cells >> np.uint32(3)] >> (7 - (cells & np.uint32(7)))) & 1 == 1
            yield pd.Series(hit)

    return test(h)


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    Texts are equal when identical; NULL counts as empty.  Of equal texts the row with the
    largest id stays; of rows repeated with that id, one.  A NULL id is less than any other.
    An empty table gives an empty result.  Other columns are ignored.

    Texts are read once and left behind as hashes.  Rows whose hash cannot repeat never move;
    those that may are grouped by SHA-256.  A hash found in a third of all rows is combined
    before the shuffle, and its rows are one skewed join key, which Spark splits.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.sha2(text, 256).alias("sha")
    )
    rows = checkpointed(rows.withColumn("rid", F.monotonically_increasing_id()))
    log2 = cells_log2(rows.count())
    bits = repeated_cells(rows, log2)
    rows = rows.withColumn("maybe", may_repeat(F.col("h"), bits, log2, rows))
    once = rows.where(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    maybe = rows.where("maybe").select("id", "rid", "sha")
    groups = maybe.groupBy("sha").agg(
        F.max(F.struct("id", "rid")).alias("best"), F.count("*").alias("group_size")
    )
    several = maybe.join(groups.hint("merge"), "sha").select(
        "id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("best.rid")).alias("kept"),
        "sha",
    )
    return once.unionByName(several).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def drop_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are."""
    marks = checkpointed(exact_duplicates(docs, id_col, text_col))
    keys = marks.select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha"), "kept")
    keys = keys.groupBy("__id", "__sha").agg(F.count("*").alias("rows"), F.max("kept").alias("kept"))
    keys = checkpointed(keys.where("not kept or rows > 1"))
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)

    def meet(how: str, wanted: DataFrame) -> DataFrame:
        small = F.broadcast(wanted) if fits(wanted, 160, limit) else wanted.hint("merge")
        same = docs[id_col].eqNullSafe(small["__id"]) & (sha == small["__sha"])
        return docs.join(small, same, how)

    again = keys.where("kept").select("__id", "__sha")
    kept = meet("left_anti", keys.select("__id", "__sha"))
    if not has_rows(again):
        return kept
    return kept.unionByName(meet("left_semi", again).dropDuplicates([id_col, text_col]))
