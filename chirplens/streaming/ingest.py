"""Periodic ingest: landed feed files become batches of posts, newest row per id on read."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chirplens.operators.upsert import newest_per_id
from chirplens.schemas import RAW, TWEET
from chirplens.sources.feed import normalize

# Where a record was landed.  Later files are newer, then later blocks and lines.
_PLACE = [
    T.StructField("_file_time", T.TimestampType()),
    T.StructField("_file", T.StringType()),
    T.StructField("_block", T.LongType()),
    T.StructField("_line", T.LongType()),
]
_PLACED = T.StructType([*TWEET.fields, *_PLACE])
_FOLDERS = [T.StructField("generation", T.StringType()), T.StructField("batch", T.LongType())]
_NEWEST = [f.name for f in _PLACE]


def _generation(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives and dies with a checkpoint: batch ids start again with a new one."""
    path = f"{checkpoint}/generation"
    try:
        return spark.read.text(path).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([(uuid.uuid4().hex,)], "value string").coalesce(1).write.text(path)
    return spark.read.text(path).first()[0]


def ingest_available(
    spark: SparkSession, landing: str, store: str, checkpoint: str
) -> StreamingQuery:
    """Takes every landed file not taken before, then stops; to be started again on a schedule.

    ``store/generation=<checkpoint>/batch=<id>`` holds one micro-batch.  A batch that is replayed
    after a failure overwrites its own folder, so its rows are never stored twice; batches of
    another checkpoint have folders of their own and are never overwritten.  No run rewrites the
    posts already stored, however many there are.
    """
    folder = f"{store}/generation={_generation(spark, checkpoint)}"

    def put(batch: DataFrame, batch_id: int) -> None:
        # A block of a file is read by one task, in order.
        placed = batch.withColumn("_line", F.monotonically_increasing_id())
        posts = newest_per_id(normalize(placed, *_NEWEST), *[F.desc(c) for c in _NEWEST])
        posts.select(*_PLACED.names).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    raw = spark.readStream.schema(RAW).json(landing)
    placed = raw.select(
        "*",
        F.col("_metadata.file_modification_time").alias("_file_time"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    writer = placed.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _batches(spark: SparkSession, store: str) -> DataFrame:
    schema = T.StructType([*_PLACED.fields, *_FOLDERS])
    try:
        return spark.read.schema(schema).parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _within(marks: list[tuple[str, int]]) -> F.Column:
    """Batches up to a mark per generation, as a filter on folders."""
    inside = F.lit(False)
    for generation, batch in marks:
        inside = inside | ((F.col("generation") == generation) & (F.col("batch") <= batch))
    return inside


def _placed_posts(
    spark: SparkSession, store: str, base: str | None, until: list[tuple[str, int]] | None = None
) -> DataFrame:
    """The newest row of each id with its place."""
    batches = _batches(spark, store)
    if until is not None:
        batches = batches.where(_within(until))
    newest = [F.desc(c) for c in _NEWEST]
    if base is None:
        return newest_per_id(batches.select(*_PLACED.names), *newest)
    # One row per checkpoint that ever was.
    taken = [(r["generation"], r["batch"]) for r in spark.read.parquet(f"{base}/taken").collect()]
    newer = newest_per_id(batches.where(~_within(taken)).select(*_PLACED.names), *newest)
    old = spark.read.schema(_PLACED).parquet(f"{base}/posts")
    ids = newer.select("tid")
    # Files taken again by a new checkpoint may be older than what the base has of an id.
    again = newest_per_id(newer.unionByName(old.join(ids, "tid", "left_semi")), *newest)
    return old.join(ids, "tid", "left_anti").unionByName(again)


def read_store(spark: SparkSession, store: str, base: str | None = None) -> DataFrame:
    """Posts of all batches, the record landed last for each id, whole rows.

    With ``base``, written by ``compact``, only folders of later batches are read from the
    store, and only ids that came again are ranked; a recency filter on the result reaches the
    scan of the base.
    """
    return _placed_posts(spark, store, base).select(*TWEET.names)


def compact(spark: SparkSession, store: str, target: str, base: str | None = None) -> None:
    """Writes ``read_store`` as a new base, sorted by time within files so that recency filters
    skip row groups, with the last batch of each generation that is in it."""
    marks = _batches(spark, store).groupBy("generation").agg(F.max("batch").alias("batch"))
    until = [(r["generation"], r["batch"]) for r in marks.collect()]
    posts = _placed_posts(spark, store, base, until)
    posts.sortWithinPartitions("created_at").write.mode("errorifexists").parquet(f"{target}/posts")
    taken = dict(until)
    if base is not None:
        for r in spark.read.parquet(f"{base}/taken").collect():
            taken[r["generation"]] = max(r["batch"], taken.get(r["generation"], -1))
    rows = spark.createDataFrame(list(taken.items()), T.StructType(_FOLDERS))
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{target}/taken")
