"""A post store clustered by id: updates read and write only the ranges of ids that they touch.

The ids are cut into ranges, each a folder, and the manifest keeps where a range begins and the
least and greatest id in it.  Ranges do not overlap, so an id belongs to one of them, found by
binary search among their beginnings.  An update rewrites the touched ranges under a new commit
and leaves all others as they are.  Stored rows are never shuffled: the ids that came are sent to
them, a slice of the ranges at a time if they are many.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chirplens.env import checkpointed
from chirplens.operators.lookup import BROADCAST_BYTES
from chirplens.schemas import TWEET
from chirplens.sources.commits import Part, new_commit, publish, read_parts, stage, visible

POSTS = "posts"
RANGE = "range"
# Posts in a range when it is made.
RANGE_ROWS = 500_000
# What an id costs in a broadcast.
_ID_BYTES = 64


def range_name(number: int) -> str:
    """Sorts like the number."""
    return f"{number:012d}"


def ranges(spark: SparkSession, store: str) -> list[Part]:
    """The ranges of the store, in the order of their ids; one entry for each folder."""
    found = visible(spark, store, POSTS)
    return sorted(found, key=lambda p: (p.low is not None, p.low or 0))


def read_clustered(
    spark: SparkSession, store: str, least: int | None = None, most: int | None = None
) -> DataFrame:
    """The stored posts; with bounds those with ``least <= tid <= most``, of whose ranges only
    those that may have them are read.  A post without an id is outside of any bounds."""
    wanted = ranges(spark, store)
    if least is not None:
        wanted = [p for p in wanted if p.most is not None and p.most >= least]
    if most is not None:
        wanted = [p for p in wanted if p.least is not None and p.least <= most]
    posts = read_parts(spark, store, TWEET, wanted, RANGE).drop(RANGE)
    if least is not None:
        posts = posts.where(F.col("tid") >= least)
    return posts if most is None else posts.where(F.col("tid") <= most)


def range_of(tid: Column, lows: list[int]) -> Column:
    """The place among the sorted ``lows`` of the last one that is no greater than ``tid``, from 0;
    ids below the first belong to it.  A binary search, one step for each doubling."""
    if len(lows) < 2:
        return F.lit(0)
    array = F.array(*[F.lit(x) for x in lows]).cast("array<long>")
    steps = F.sequence(F.lit(1), F.lit(max(1, math.ceil(math.log2(len(lows))))))

    def halve(at: Column, _: Column) -> Column:
        middle = F.ceil((at["a"] + at["b"]) / 2).cast("int")
        right = F.get(array, middle) <= tid
        a = F.when(right, middle).otherwise(at["a"])
        b = F.when(right, at["b"]).otherwise(F.greatest(at["a"], middle - 1))
        return F.struct(a.alias("a"), b.alias("b"))

    start = F.struct(F.lit(0).alias("a"), F.lit(len(lows) - 1).alias("b"))
    return F.aggregate(steps, start, halve, lambda at: at["a"])


def _cuts(posts: DataFrame, rows: int, range_rows: int) -> list[int]:
    """Where ranges of about ``range_rows`` posts begin, the least id first."""
    pieces = math.ceil(rows / range_rows)
    if not rows:
        return []
    shares = [i / pieces for i in range(1, pieces)]
    # Close enough for ranges of any number: an error of a tenth of a range.
    near = max(10_000, 10 * pieces)
    found = posts.agg(
        F.min("tid").alias("first"),
        F.percentile_approx("tid", F.array(*[F.lit(s) for s in [*shares, 1.0]]), F.lit(near)).alias("cuts"),
    ).first()
    cuts = {found["first"], *(found["cuts"][:-1] if found["cuts"] else [])}
    return sorted(c for c in cuts if c is not None)


def upsert_clustered(
    spark: SparkSession,
    store: str,
    incoming: DataFrame,
    range_rows: int = RANGE_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> str | None:
    """Puts the rows of ``incoming``, unique on ``tid``, into the store; a row replaces the stored
    one of its id.  Gives the name of the commit, none if there was nothing to do.

    Ids above all that are stored make new ranges, once the last one is full; all others go to
    the range they belong to.  A post without an id replaces the stored one without an id and has
    a range of its own.  Nothing is visible before everything is written.
    """
    incoming = checkpointed(incoming.select(*TWEET.names))
    now = ranges(spark, store)
    numbered = [p for p in now if p.low is not None]
    lows = [p.low for p in numbered]
    names = [p.part for p in numbered]
    rows = incoming.agg(F.count("*").alias("n"), F.count("tid").alias("ids")).first()
    if not rows["n"]:
        return None
    last = numbered[-1] if numbered else None
    above = incoming if last is None else incoming.where(F.col("tid") > last.most)
    above = above.where("tid is not null")
    fresh = above.count()
    if last is None or last.rows + fresh > range_rows:
        for low in _cuts(above, fresh, range_rows):
            lows.append(low)
            names.append(range_name(1 + max((int(p) for p in names), default=0)))
    place = F.when(F.col("tid").isNull(), range_name(0))
    if lows:
        place = place.otherwise(F.get(F.array(*[F.lit(n) for n in names]), range_of(F.col("tid"), lows)))
    # Texts are kept once, above; a place is found again where it is read.
    placed = incoming.withColumn(RANGE, place)
    sizes = {r[RANGE]: r["count"] for r in placed.groupBy(RANGE).count().collect()}

    stored = {p.part: p for p in now}
    begins = dict(zip(names, lows, strict=True))
    most_ids = broadcast_bytes // _ID_BYTES
    commit = new_commit()
    written: list[Part] = []
    for number, some in enumerate(_slices(sorted(sizes), sizes, most_ids)):
        folder = f"{commit}-{number}"
        old = read_parts(spark, store, TWEET, [stored[p] for p in some if p in stored], RANGE)
        own = placed.where(F.col(RANGE).isin(some)).repartition(RANGE)
        stage(replaced(old, own, sum(sizes[p] for p in some) <= most_ids), store, POSTS, folder, RANGE)
        staged = read_parts(spark, store, TWEET, [Part(POSTS, p, folder) for p in some], RANGE)
        told = staged.groupBy(RANGE).agg(
            F.min("tid").alias("least"), F.max("tid").alias("most"), F.count("*").alias("rows")
        )
        for r in told.collect():
            low = begins.get(r[RANGE])
            # Ids below the first range have moved its beginning.
            low = low if low is None else min(low, r["least"])
            written.append(Part(POSTS, r[RANGE], folder, low, r["least"], r["most"], r["rows"]))
    publish(spark, store, written)
    return commit


def replaced(old: DataFrame, incoming: DataFrame, fits: bool) -> DataFrame:
    """``old`` with the rows of ``incoming`` put in; stored rows stay in the tasks that read them.

    Only a range that gets more rows at once than may be broadcast is shuffled.
    """
    ids = incoming.select(F.col("tid").alias("__id"))
    ids = F.broadcast(ids) if fits else ids.hint("merge")
    return old.join(ids, F.col("tid").eqNullSafe(F.col("__id")), "left_anti").unionByName(incoming)


def _slices(parts: list[str], sizes: dict[str, int], most: int) -> list[list[str]]:
    """Whole ranges in order, of at most ``most`` incoming ids together unless one has more."""
    out: list[list[str]] = []
    held = 0
    for part in parts:
        if not out or held + sizes[part] > most:
            out.append([])
            held = 0
        out[-1].append(part)
        held += sizes[part]
    return out
