"""Posts in the order of a listing, newest first, so that a page opens few files.

The posts are cut into pieces that follow each other in the listing, and the manifest keeps for
each piece its times and its rows.  A page is asked for by the last row of the page before; the
pieces that hold it are known without looking at any file.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplens.env import checkpointed
from chirplens.functions.times import ntz
from chirplens.schemas import TWEET
from chirplens.sources.commits import Part, new_commit, publish, read_parts, stage, visible

TIMELINE = "timeline"
PIECE = "piece"
PIECE_ROWS = 200_000
_EPOCH = datetime(1970, 1, 1)


def _listed() -> list[Column]:
    """As ``filters.latest_first``: posts without a time come last, equal times by id."""
    return [F.desc("created_at"), F.asc("tid")]


def _micros(ts: datetime | None) -> int | None:
    return None if ts is None else (ts - _EPOCH) // timedelta(microseconds=1)


def write_timeline(spark: SparkSession, posts: DataFrame, target: str, piece_rows: int = PIECE_ROWS) -> None:
    """Writes the listing of ``posts``; readers see the one before until all of it is written."""
    posts = checkpointed(posts.select(*TWEET.names))
    pieces = max(1, math.ceil(posts.count() / piece_rows))
    ranges = posts.repartitionByRange(pieces, *_listed())
    commit = new_commit()
    name = F.lpad(F.spark_partition_id().cast("string"), 12, "0")
    stage(ranges.withColumn(PIECE, name), target, TIMELINE, commit, PIECE)
    names = [f"{i:012d}" for i in range(pieces)]
    staged = read_parts(spark, target, TWEET, [Part(TIMELINE, p, commit) for p in names], PIECE)
    told = staged.groupBy(PIECE).agg(
        F.min("created_at").alias("least"),
        F.max("created_at").alias("most"),
        F.count("*").alias("rows"),
        F.count("created_at").alias("dated"),
    )
    # ``low`` is the number of posts without a time.
    found = [
        Part(TIMELINE, r[PIECE], commit, r["rows"] - r["dated"], _micros(r["least"]), _micros(r["most"]), r["rows"])
        for r in told.collect()
    ]
    known = {p.part for p in found}
    found += [Part(TIMELINE, p, commit, 0, None, None, 0) for p in names if p not in known]
    publish(spark, target, found)


def pieces_of(spark: SparkSession, target: str) -> list[Part]:
    """The pieces of the last listing in its order."""
    found = visible(spark, target, TIMELINE)
    # Every listing has a first piece; one with fewer pieces leaves later ones of another behind.
    return [p for p in found if p.commit == found[0].commit]


def page_pieces(
    pieces: list[Part], size: int, after: tuple[datetime | None, int | None] | None
) -> list[Part]:
    """The pieces that hold the ``size`` rows after a key."""
    time = None if after is None else _micros(after[0])
    wanted, sure = [], 0
    for p in pieces:
        if sure >= size:
            break
        # Whether the piece has rows behind the key, and no others.
        if after is None:
            behind = whole = True
        elif time is None:
            behind, whole = p.low > 0, False
        else:
            behind = p.low > 0 or (p.least is not None and p.least <= time)
            whole = p.most is None or p.most < time
        if behind:
            wanted.append(p)
            sure += p.rows if whole else 0
    return wanted


def latest_page(
    spark: SparkSession, target: str, size: int, after: tuple[datetime | None, int | None] | None = None
) -> DataFrame:
    """The ``size`` posts that follow the one with the time and id ``after`` in the listing, newest
    first; the first page without it.  Posts written in between move no row to another page."""
    posts = read_parts(spark, target, TWEET, page_pieces(pieces_of(spark, target), size, after), PIECE)
    posts = posts.drop(PIECE)
    if after is not None:
        time, tid = after
        created, ids = F.col("created_at"), F.col("tid")
        later = ids.isNotNull() if tid is None else ids > tid
        if time is None:
            posts = posts.where(created.isNull() & later)
        else:
            posts = posts.where((created < ntz(time)) | ((created == ntz(time)) & later) | created.isNull())
    return posts.orderBy(*_listed()).limit(size)
