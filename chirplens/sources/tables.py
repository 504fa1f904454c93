"""Post and result tables on shared storage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirplens.operators.filters import filter_recent
from chirplens.schemas import RESULT_TABLES, TWEET
from chirplens.sources.commits import Part, is_committed, new_commit, publish, read_parts, stage, visible


def spread(frame: DataFrame, partitions: int | None) -> DataFrame:
    """``frame`` dealt out evenly over so many partitions, or as it was read."""
    return frame if partitions is None else frame.repartition(partitions)


def read_posts(
    spark: SparkSession,
    path: str,
    as_of: datetime | None = None,
    days: int = 4,
    partitions: int | None = None,
) -> DataFrame:
    """The stored posts; with ``as_of`` only those of the last ``days``, filtered in the scan.

    ``partitions`` is for tables of few large files: one shuffle of what is left.  The filter
    is below it.
    """
    posts = spark.read.schema(TWEET).parquet(path)
    return spread(posts if as_of is None else filter_recent(posts, as_of, days), partitions)


# Name of the partition column of result tables, and its form: sorts like ``ts``.
RUN = "run"
_RUN_FORMAT = "yyyyMMdd'T'HHmmss'_'SSSSSS"


def run_name(ts: datetime) -> str:
    return ts.strftime("%Y%m%dT%H%M%S_%f")


def _as_declared(frame: DataFrame, name: str) -> DataFrame:
    """The columns of result table ``name`` in declared order, and the run of each row."""
    schema = RESULT_TABLES[name]
    have = {f.name: f.dataType for f in frame.schema}
    if have != {f.name: f.dataType for f in schema}:
        raise ValueError(f"{name}: {frame.schema.simpleString()} is not {schema.simpleString()}")
    return frame.select(*schema.names, F.date_format("ts", _RUN_FORMAT).alias(RUN))


def append_result(frame: DataFrame, name: str, path: str) -> None:
    """Puts runs into result table ``name`` that stands alone, and is created if absent.

    The table has one partition per run.  Runs that are in ``frame`` replace themselves, so a
    retried report leaves no rows twice; all other runs stay.  Columns must be those declared,
    in name and type; they are written in declared order.
    """
    rows = _as_declared(frame, name)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(RUN).parquet(path)


def commit_results(tables: dict[str, DataFrame], runs: list[datetime], target: str) -> None:
    """Puts ``runs`` into several result tables under ``target``, visible in all of them at once.

    A run that is done again replaces itself in all tables.  ``runs`` without rows in a table
    are there too, with no rows.  If writing fails anywhere, readers see what they saw before.
    """
    rows = {name: _as_declared(frame, name) for name, frame in tables.items()}
    commit = new_commit()
    for name, frame in rows.items():
        stage(frame, target, name, commit, RUN)
    spark = next(iter(tables.values())).sparkSession
    publish(spark, target, [Part(name, run_name(ts), commit) for name in rows for ts in runs])


def read_result(
    spark: SparkSession,
    name: str,
    path: str,
    after: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """A result table; with bounds only the runs ``after < ts <= until``, other partitions are
    not read.

    If ``path`` is a table of ``commit_results`` (its folder's name below the target), the runs
    that are visible count.
    """
    target, _, own = path.rstrip("/").rpartition("/")
    schema = RESULT_TABLES[name]
    if is_committed(spark, target):
        parts = [
            p
            for p in visible(spark, target, own)
            if (after is None or p.part > run_name(after)) and (until is None or p.part <= run_name(until))
        ]
        runs = read_parts(spark, target, schema, parts, RUN)
    else:
        runs = spark.read.schema(T.StructType([*schema.fields, T.StructField(RUN, T.StringType())])).parquet(path)
    if after is not None:
        runs = runs.where(F.col(RUN) > run_name(after))
    if until is not None:
        runs = runs.where(F.col(RUN) <= run_name(until))
    return runs.drop(RUN)
