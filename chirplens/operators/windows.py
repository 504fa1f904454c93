"""Report windows: many runs of a report as one job, and top-k per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirplens.config import RunGrid
from chirplens.env import checkpointed
from chirplens.functions import times
from chirplens.operators.lookup import BROADCAST_BYTES

# A post lies in the windows of the runs ``first .. last``.  All posts with the same two
# numbers share their fate, so counting is done on them before rows are spread over the runs.
# A report that stands alone has one column instead, ``run``.
SPAN = ["first", "last"]


def with_span(posts: DataFrame, grid: RunGrid) -> DataFrame:
    """Posts that at least one run of ``grid`` sees, with the runs that see them.

    The range filter on the bare column repeats what the indexes say, for the scan.
    """
    created = F.col("created_at")
    seen = times.is_recent_in_seconds(created, grid.start, grid.days) & (
        created <= times.ntz(grid.end)
    )
    return (
        posts.where(seen)
        .withColumn("first", times.first_run(created, grid))
        .withColumn("last", times.last_run(created, grid))
        .where("first <= last")
    )


def as_one_run(posts: DataFrame) -> DataFrame:
    """All posts in the window of run 0."""
    return posts.withColumn("run", F.lit(0).cast("long"))


def span_of(frame: DataFrame) -> list[str]:
    return ["run"] if "run" in frame.columns else SPAN


def per_run(frame: DataFrame) -> DataFrame:
    """One row per run that sees the row, with column ``run`` instead of the span."""
    if "run" in frame.columns:
        return frame
    others = [c for c in frame.columns if c not in SPAN]
    return frame.select(F.explode(F.sequence("first", "last")).alias("run"), *others)


def _runs(span: list[str]) -> Column:
    return F.array("run") if span == ["run"] else F.sequence(*span)


def count_per_run(rows: DataFrame, keys: list[str], weight: str | None = None) -> DataFrame:
    """``(run, *keys, count)``; a row counts once, or ``weight`` times.

    Rows are first counted per span, then the counts are spread over the runs: a post in 20
    windows is counted once, not 20 times.
    """
    size = F.sum(weight) if weight else F.count("*")
    counts = rows.groupBy(*span_of(rows), *keys).agg(size.alias("count"))
    if "run" in rows.columns:
        return counts
    return per_run(counts).groupBy("run", *keys).agg(F.sum("count").alias("count"))


def top_per_run(frame: DataFrame, k: int, *order: Column | str, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each run, with their ``rank``.

    A run is ranked in parts first, dealt out by hash over as many tasks as a shuffle has, and
    only the first ``k`` rows of a part meet the others: no task sorts a whole run, for any
    ``k``.  (For small ``k`` Spark also limits each task's rows before the first shuffle.)
    """
    spark = frame.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(*[c for c in frame.columns if c != "run"]), F.lit(parts))
    first = F.row_number().over(Window.partitionBy("run", "_part").orderBy(*order))
    few = frame.withColumn("_part", part).withColumn("_first", first).where(F.col("_first") <= k)
    window = Window.partitionBy("run").orderBy(*order)
    ranked = few.drop("_part", "_first").withColumn(rank, F.row_number().over(window))
    return ranked.where(F.col(rank) <= k)


def most_frequent_per_run(
    rows: DataFrame, key: str, k: int, probe_keys: int | None = None
) -> DataFrame:
    """``(run, key, count, rank)``: the ``k`` most frequent keys of each run, ties in key order.

    Exact, without counting every key in every run.  A key is no more frequent in a run than
    over all rows, so the keys most frequent over all rows, a fixed number, are counted per run
    first.  If the k-th count found in every run is above the overall count of the keys left
    out, that is the answer; otherwise the keys that reach a run's k-th count are counted too.

    Runs its jobs at once and returns a checkpointed frame of ``k`` rows per run.
    """
    counts = rows.groupBy(*span_of(rows), key).agg(F.count("*").alias("count")).persist()
    try:
        return most_frequent_of_counts(counts, key, k, probe_keys)
    finally:
        counts.unpersist()


def most_frequent_of_counts(
    counts: DataFrame, key: str, k: int, probe_keys: int | None = None
) -> DataFrame:
    """As ``most_frequent_per_run``, of counts per span, which are read several times."""
    probe_keys = probe_keys or 16 * k
    span = span_of(counts)
    totals = counts.groupBy(key).agg(F.sum("count").alias("overall"))
    order = [F.desc("overall"), key]
    # One key more than is taken: its count covers all keys left out.
    probe = checkpointed(totals.orderBy(*order).limit(probe_keys + 1))
    keys = probe.agg(
        F.count("*").alias("n"),
        F.min("overall").alias("left_out"),
        F.sum(F.octet_length(key) + F.lit(64)).alias("bytes"),
    ).first()
    taken = probe.orderBy(*order).limit(probe_keys).select(key)
    small = (keys["bytes"] or 0) <= BROADCAST_BYTES
    taken = F.broadcast(taken) if small else taken.hint("merge")
    found = checkpointed(_rank_counts(per_run(counts.join(taken, key)), key, k))
    if keys["n"] <= probe_keys:
        return found
    kth = found.where(F.col("rank") == k).select("run", F.col("count").alias("floor"))
    floors = (
        per_run(counts.select(*span).distinct())
        .select("run")
        .distinct()
        .join(F.broadcast(kth), "run", "left")
        .na.fill(0, ["floor"])
    )
    lowest = floors.agg(F.min("floor")).first()[0]
    if keys["left_out"] < lowest:
        return found
    # What a key needs is set by the runs that see its rows, not by the thinnest of all.
    seen = counts.select(*span).distinct().withColumn("_run", F.explode(_runs(span)))
    needs = seen.join(F.broadcast(floors.withColumnRenamed("run", "_run")), "_run")
    needs = needs.groupBy(*span).agg(F.min("floor").alias("need"))
    # A key has at most one row per span, so no key of this join is hot.
    wanted = counts.join(totals.where(F.col("overall") >= lowest).hint("merge"), key)
    wanted = wanted.join(needs, span).where("overall >= need").drop("need")
    reach = per_run(wanted).join(F.broadcast(floors), "run").where("overall >= floor")
    return checkpointed(_rank_counts(reach, key, k))


def _rank_counts(counts: DataFrame, key: str, k: int) -> DataFrame:
    merged = counts.groupBy("run", key).agg(F.sum("count").alias("count"))
    return top_per_run(merged, k, F.desc("count"), key)
