"""Result tables that are kept: runs are added as they come due, queries read what is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chirplens.config import RunGrid
from chirplens.plans import backfill
from chirplens.sources.commits import visible
from chirplens.sources.tables import commit_results, run_name

BACKFILLS = {
    "word_counts": backfill.word_counts_backfill,
    "urls": backfill.urls_backfill,
    "word_cooccur": backfill.word_cooccur_backfill,
}


def missing_runs(spark: SparkSession, target: str, names: list[str], grid: RunGrid) -> list[RunGrid]:
    """The runs of ``grid`` that any of the tables does not have, as grids without gaps."""
    have = set.intersection(*({p.part for p in visible(spark, target, name)} for name in names))
    times = [grid.start + grid.step * run for run in range(grid.runs)]
    absent = [run for run, ts in enumerate(times) if run_name(ts) not in have]
    stretches: list[list[int]] = []
    for run in absent:
        if stretches and stretches[-1][-1] == run - 1:
            stretches[-1].append(run)
        else:
            stretches.append([run])
    return [RunGrid(end=times[s[-1]], step=grid.step, runs=len(s), days=grid.days) for s in stretches]


def add_missing_runs(
    spark: SparkSession, posts: DataFrame, target: str, names: list[str], grid: RunGrid
) -> int:
    """Computes the runs of ``grid`` that are not stored yet and adds them to the tables; gives
    their number.

    Each stretch of runs is one backfill of the posts that its windows see, and one commit: its
    runs appear in all tables together.  Runs that are stored are not looked at, so a table must
    be made with the same parameters each time.
    """
    added = 0
    for stretch in missing_runs(spark, target, names, grid):
        tables = {name: BACKFILLS[name](posts, stretch) for name in names}
        commit_results(tables, [stretch.start + stretch.step * r for r in range(stretch.runs)], target)
        added += stretch.runs
    return added
