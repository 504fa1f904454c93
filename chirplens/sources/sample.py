"""The package's tables, derived from general-purpose tables in one folder.

All rows of the source tables and whole texts are used:

* a post is a document; its time is that of the last event in its run of events (events are
  dealt out to documents in order, the last document gets those left over), its links are the
  address and the hrefs of its page (pages are dealt out in turn);
* labels add posts that stand at the edge: one without text and links, in the second that a
  window cuts, for a toxic label, and one without a date for a label of low quality;
* the feed holds two later edits of every labelled document, and every conversation turn as a
  new post.

Everything is lazy; table sizes enter as scalar subqueries.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplens.functions.times import format_feed_date
from chirplens.sources.tables import spread

NEW_ID = 10**15  # ids of conversation turns lie above all document ids
EDGE_TIME = "2024-01-26 23:59:59.9"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def version(spark: SparkSession, folder: str) -> str:
    """A name for the files that the posts come from as they are now; changes with any of them."""
    paths = [f"{folder}/{name}.parquet" for name in ("documents", "events", "labels", "pages")]
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    # The files are listed, not read.
    files = reader.load(paths).select("path", "modificationTime", "length").collect()
    return hashlib.md5(str(sorted(map(tuple, files))).encode()).hexdigest()


def _size(frame: DataFrame):
    return frame.agg(F.count("*").alias("n")).scalar()


def posts(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    turn = F.pmod("tid", _size(pages)).alias("page_id")
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))
    found = pages.select("page_id", F.concat(F.array("url"), hrefs).alias("urls"))
    plain = _dated(spark, folder)
    linked = plain.select("*", turn).join(found, "page_id", "left").drop("page_id")
    edges = _edges(spark, folder).withColumn("urls", F.lit(None).cast("array<string>"))
    return linked.unionByName(edges)


def texts(spark: SparkSession, folder: str, partitions: int | None = None) -> DataFrame:
    """Posts without their links; the pages are not read.  ``partitions`` deals the rows out."""
    rows = _dated(spark, folder).unionByName(_edges(spark, folder))
    return spread(rows, partitions)


def _dated(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    events = _table(spark, folder, "events")
    size = _size(documents)
    run = F.greatest(F.lit(1).cast("long"), F.call_function("div", _size(events), F.greatest(size, F.lit(1))))
    place = F.least(F.call_function("div", F.col("event_id"), run), size - 1)
    times = events.groupBy(place.alias("doc_id")).agg(F.max("ts").alias("created_at"))
    return documents.join(times, "doc_id", "left").select(
        F.col("doc_id").alias("tid"), F.col("source").alias("user"), "text", "created_at"
    )


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    labels = _table(spark, folder, "labels").where("toxic = 1 or quality = 0")
    toxic = F.col("toxic") == 1
    return labels.select(
        (-F.col("doc_id") - 1).alias("tid"),
        F.lit("edge").alias("user"),
        F.when(~toxic, F.lit("undated edge")).alias("text"),
        F.when(toxic, F.lit(EDGE_TIME).cast("timestamp_ntz")).alias("created_at"),
    )


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """Feed records with their landing order ``seq``."""
    labelled = posts(spark, folder).join(
        _table(spark, folder, "labels").withColumnRenamed("doc_id", "tid"), "tid"
    )
    edit = F.explode(
        F.array(
            F.struct(
                F.lit(1).alias("seq"),
                F.concat("text", F.lit(" quality "), F.col("quality")).alias("edited"),
            ),
            F.struct(
                F.lit(2).alias("seq"),
                F.concat("text", F.lit(" toxic "), F.col("toxic")).alias("edited"),
            ),
        )
    )
    edits = labelled.select("tid", "user", "created_at", "urls", edit.alias("edit")).select(
        F.col("tid").alias("id"),
        F.col("edit.edited").alias("text"),
        F.struct(F.col("user").alias("screen_name")).alias("user"),
        format_feed_date(F.col("created_at")).alias("created_at"),
        F.transform("urls", lambda u: F.struct(u.alias("expanded_url"))).alias("urls"),
        F.col("edit.seq").alias("seq"),
    )
    said = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        mins=F.col("conv_id").cast("int"), secs=F.col("turn")
    )
    turns = _table(spark, folder, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn") + NEW_ID).alias("id"),
        "text",
        F.struct(F.col("role").alias("screen_name")).alias("user"),
        format_feed_date(said).alias("created_at"),
        F.array().cast("array<struct<expanded_url:string>>").alias("urls"),
        F.lit(1).alias("seq"),
    )
    return edits.unionByName(turns)
