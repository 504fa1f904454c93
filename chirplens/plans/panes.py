"""Word and URL reports from stored counts of panes.

The windows of a grid of runs cut time into panes: posts that are seen by the same runs, the
``first`` to the ``last``.  The counts of a pane are made once, when the run that sees it first
comes due, and kept.  A run is the sum of its panes, so no text is read again for the twenty runs
that see it; over many runs, only keys that can be listed are spread over the runs.

A pane is final once it is stored.  A post that is landed after a run that should have seen it is
in no pane; ``add_panes`` is to be run when the posts up to a run's time are there.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirplens.config import WORD_STOPS, RunGrid
from chirplens.functions import scores, text, times
from chirplens.operators.windows import SPAN, most_frequent_of_counts, with_span
from chirplens.sources.commits import Part, new_commit, publish, read_parts, stage, staged_parts, visible

PANE = "pane"
_COUNTS = T.StructType([T.StructField("key", T.StringType()), T.StructField("count", T.LongType())])
# Tables of panes, and one that says which runs are done.
WORDS, URLS, POSTS, DONE = "pane_words", "pane_urls", "pane_posts", "pane_runs"


def _ahead(grid: RunGrid) -> RunGrid:
    """The grid with as many runs behind its end as can see a post that it sees: a pane ends at
    the same run whenever it is made."""
    more = -(-timedelta(days=grid.days) // grid.step)
    return RunGrid(end=grid.end + grid.step * (more + 1), step=grid.step, runs=grid.runs + more + 1, days=grid.days)


def _pane_rows(posts: DataFrame, grid: RunGrid, after: int) -> DataFrame:
    """Posts that a run of ``grid`` after the given one is the first to see, with their span."""
    created = F.col("created_at")
    fresh = posts.where(created <= times.ntz(grid.end))
    if after >= 0:
        fresh = fresh.where(created > times.ntz(grid.start + grid.step * after))
    return with_span(fresh, _ahead(grid)).where(F.col("first") > after)


def add_panes(spark: SparkSession, posts: DataFrame, target: str, grid: RunGrid) -> int:
    """Counts the panes of the runs of ``grid`` that are not done yet; gives the number of runs.

    The grid must begin where it began the first time, and may end later.  Only posts later than
    the last run that is done are read.  All tables of the new panes appear at once.
    """
    done = len(visible(spark, target, DONE))
    if done >= grid.runs:
        return 0
    rows = _pane_rows(posts, grid, done - 1)
    # Sorts like the numbers.
    pane = F.concat_ws("-", *[F.lpad(F.col(c).cast("string"), 9, "0") for c in SPAN]).alias(PANE)
    words = F.explode(text.words_without(F.col("text"), WORD_STOPS))
    link = F.lower(F.coalesce("url", F.lit("")))
    tables = {
        WORDS: rows.select(pane, words.alias("key")),
        URLS: rows.select(pane, F.explode("urls").alias("url")).select(PANE, link.alias("key")),
        POSTS: rows.select(pane, F.lit("").alias("key")),
    }
    commit = new_commit()
    parts = []
    for name, frame in tables.items():
        counts = frame.groupBy(PANE, "key").agg(F.count("*").alias("count"))
        # One file for a pane; counts are far fewer than posts.
        stage(counts.repartition(PANE), target, name, commit, PANE)
        parts += [Part(name, p, commit) for p in staged_parts(spark, target, name, commit, PANE)]
    parts += [Part(DONE, f"{run:09d}", commit) for run in range(done, grid.runs)]
    publish(spark, target, parts)
    return grid.runs - done


def _panes(spark: SparkSession, target: str, name: str, first: int, last: int) -> DataFrame:
    """``(first, last, key, count)`` of the panes that any of the runs sees."""
    wanted = []
    for p in visible(spark, target, name):
        a, b = map(int, p.part.split("-"))
        if a <= last and b >= first:
            wanted.append(p)
    rows = read_parts(spark, target, _COUNTS, wanted, PANE)
    ends = F.split(PANE, "-")
    return rows.select(ends[0].cast("long").alias("first"), ends[1].cast("long").alias("last"), "key", "count")


def run_counts(spark: SparkSession, target: str, name: str, run: int) -> DataFrame:
    """``(key, count)`` of one run: the sum of its panes."""
    return _panes(spark, target, name, run, run).groupBy("key").agg(F.sum("count").alias("count"))


def sliding_counts(panes: DataFrame, runs: int) -> DataFrame:
    """``(run, key, count)`` of all runs from 0 on: what enters is added, what leaves taken off.

    A pane is two rows, however many runs see it.  A key has at most two changes for each run, so
    no group is longer than the grid; a count that stays the same is one row until it is spread.
    """
    enter = panes.select(F.col("first").alias("run"), "key", "count")
    leave = panes.select((F.col("last") + 1).alias("run"), "key", (-F.col("count")).alias("count"))
    changes = enter.unionByName(leave.where(F.col("run") < runs)).where(F.col("run") < runs)
    changes = changes.groupBy("key", "run").agg(F.sum("count").alias("change"))
    order = Window.partitionBy("key").orderBy("run")
    now = F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, 0))
    until = F.coalesce(F.lead("run").over(order), F.lit(runs)) - 1
    kept = changes.select("key", "run", now.alias("count"), until.alias("until")).where("count > 0")
    return kept.select(F.explode(F.sequence("run", "until")).alias("run"), "key", "count")


def most_frequent_of_panes(
    spark: SparkSession, target: str, name: str, runs: int, k: int, probe_keys: int | None = None
) -> DataFrame:
    """``(run, key, count, rank)``: the ``k`` most frequent keys of each of ``runs`` runs.

    Only keys that can be among the first ``k`` of a run are spread over the runs; most keys are
    in no list and stay one row per pane.
    """
    panes = _panes(spark, target, name, 0, runs - 1)
    # A pane may be seen by runs behind the last one asked for.
    panes = panes.withColumn("last", F.least("last", F.lit(runs - 1).cast("long"))).persist()
    try:
        return most_frequent_of_counts(panes, "key", k, probe_keys)
    finally:
        panes.unpersist()


def word_counts_from_panes(spark: SparkSession, target: str, grid: RunGrid, k: int = 500) -> DataFrame:
    """The word table of all runs of ``grid`` from stored panes."""
    top = most_frequent_of_panes(spark, target, WORDS, grid.runs, k)
    totals = sliding_counts(_panes(spark, target, POSTS, 0, grid.runs - 1), grid.runs)
    # One row per run.
    shares = top.join(F.broadcast(totals.select("run", F.col("count").alias("total"))), "run")
    share = scores.fraction(F.col("count"), F.col("total"))
    ts = times.run_time(F.col("run"), grid)
    return shares.select(F.col("key").alias("word"), share.alias("percent"), ts.alias("ts"))


def urls_from_panes(spark: SparkSession, target: str, grid: RunGrid, k: int = 300) -> DataFrame:
    """The URL table of all runs of ``grid`` from stored panes."""
    top = most_frequent_of_panes(spark, target, URLS, grid.runs, k)
    return top.select(F.col("key").alias("url"), "count", times.run_time(F.col("run"), grid).alias("ts"))


def word_counts_of_run(spark: SparkSession, target: str, grid: RunGrid, run: int, k: int = 500) -> DataFrame:
    """The word table of one run: some forty panes are read, no posts."""
    total = run_counts(spark, target, POSTS, run).agg(F.sum("count").alias("n"))
    top = run_counts(spark, target, WORDS, run).orderBy(F.desc("count"), "key").limit(k)
    share = scores.fraction(F.col("count"), total.scalar())
    ts = times.ntz(grid.start + grid.step * run)
    return top.select(F.col("key").alias("word"), share.alias("percent"), ts.alias("ts"))
