"""Commits of several folders at once.

A commit writes its tables into folders of its own, which no reader looks at, and then one small
file into ``<target>/manifest`` that names their partitions.  That file appears as a whole or not
at all (a rename, or one put of an object store), so all tables of a commit become visible
together, and a commit that dies on its way leaves folders nobody reads.  A retry is a new
commit.  Of several commits of a partition the last one counts.

A manifest has one row per partition that was written, not per row of a table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("commit", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("part", T.StringType()),
        # Of tables clustered by an id: where the partition begins, the ids it has and its rows.
        T.StructField("low", T.LongType()),
        T.StructField("least", T.LongType()),
        T.StructField("most", T.LongType()),
        T.StructField("rows", T.LongType()),
    ]
)
COMMIT = "commit"


class Part(NamedTuple):
    """A partition of a table as a manifest names it."""

    name: str
    part: str
    commit: str
    low: int | None = None
    least: int | None = None
    most: int | None = None
    rows: int | None = None


def new_commit() -> str:
    return uuid.uuid4().hex


def _table(target: str, name: str) -> str:
    return f"{target}/tables/{name}"


def _manifest(spark: SparkSession, target: str) -> DataFrame | None:
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{target}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def is_committed(spark: SparkSession, target: str) -> bool:
    """Whether anything was ever published there."""
    return _manifest(spark, target) is not None


def stage(frame: DataFrame, target: str, name: str, commit: str, part: str) -> None:
    """Writes one table of a commit, one folder for each value of the column ``part``."""
    path = f"{_table(target, name)}/{COMMIT}={commit}"
    frame.write.mode("overwrite").partitionBy(part).parquet(path)


def staged_parts(spark: SparkSession, target: str, name: str, commit: str, part: str) -> list[str]:
    """The partitions that a commit has written of a table; folders are listed, no rows read."""
    path = f"{_table(target, name)}/{COMMIT}={commit}"
    listed = T.StructType([T.StructField(part, T.StringType())])
    return sorted(r[part] for r in spark.read.schema(listed).parquet(path).select(part).distinct().collect())


def publish(spark: SparkSession, target: str, parts: Iterable[Part]) -> None:
    """Makes partitions visible, all at once.

    Commits are numbered by what was visible; of two at the same time the greater name counts,
    for every reader and every table alike.
    """
    manifest = _manifest(spark, target)
    last = None if manifest is None else manifest.agg(F.max("seq")).first()[0]
    seq = 0 if last is None else last + 1
    rows = [(seq, p.commit, p.name, p.part, p.low, p.least, p.most, p.rows) for p in parts]
    if rows:
        spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{target}/manifest")


def visible(spark: SparkSession, target: str, name: str) -> list[Part]:
    """The partitions of a table that count, in the order of their names."""
    manifest = _manifest(spark, target)
    if manifest is None:
        return []
    own = manifest.where(F.col("name") == name).groupBy("part")
    last = own.agg(F.max(F.struct("seq", "commit", "low", "least", "most", "rows")).alias("last"))
    found = [
        Part(name, r["part"], r["commit"], r["low"], r["least"], r["most"], r["rows"])
        for r in last.select("part", "last.*").collect()
    ]
    return sorted(found, key=lambda p: p.part)


def read_parts(
    spark: SparkSession, target: str, schema: T.StructType, parts: list[Part], part: str
) -> DataFrame:
    """The given partitions of one table, with the column ``part``; no other folder is read."""
    whole = T.StructType([*schema.fields, T.StructField(part, T.StringType())])
    if not parts:
        return spark.createDataFrame([], whole)
    by_commit: dict[str, list[str]] = {}
    for p in parts:
        by_commit.setdefault(p.commit, []).append(p.part)
    base = _table(target, parts[0].name)
    paths = [f"{base}/{COMMIT}={c}" for c in sorted(by_commit)]
    listed = T.StructType([*whole.fields, T.StructField(COMMIT, T.StringType())])
    rows = spark.read.schema(listed).option("basePath", base).parquet(*paths)
    wanted = F.lit(False)
    for c, names in sorted(by_commit.items()):
        wanted = wanted | ((F.col(COMMIT) == c) & F.col(part).isin(names))
    return rows.where(F.col(part).isNotNull() & wanted).drop(COMMIT)
