"""Pages of the listing, and the trend of pairs on the grid of runs."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chirplens.config import RunGrid
from chirplens.functions.times import ntz
from chirplens.operators.filters import latest_first
from chirplens.plans import explore
from chirplens.sources import timeline
from chirplens.sources.timeline import latest_page, page_pieces, pieces_of, write_timeline

NOON = datetime(2024, 5, 1, 12)


@pytest.fixture(scope="module")
def posts(make_posts):
    rng = random.Random(4)
    rows = [
        (i, f"text {i}", NOON - timedelta(microseconds=rng.randint(0, 300)) if i % 9 else None, ["u"])
        for i in rng.sample(range(-200, 2000), 900)
    ]
    return make_posts([*rows, (None, "no id", NOON, None), (None, "neither", None, None)])


@pytest.mark.parametrize("piece_rows", [33, 5000])
def test_pages_are_the_listing(spark, posts, tmp_path, piece_rows):
    """Few different times, so that pieces begin in the middle of one."""
    target = str(tmp_path / "t")
    write_timeline(spark, posts, target, piece_rows)
    pages, after = [], None
    while True:
        page = latest_page(spark, target, 150, after).collect()
        pages += page
        if len(page) < 150:
            break
        after = page[-1]["created_at"], page[-1]["tid"]
    assert pages == latest_first(posts).collect()


def test_a_page_opens_few_files(spark, posts, tmp_path):
    target = str(tmp_path / "t")
    write_timeline(spark, posts, target, 20)
    pieces = pieces_of(spark, target)
    assert len(pieces) == 46 and sum(p.rows for p in pieces) == 902
    page = latest_page(spark, target, 30).collect()
    after = page[-1]["created_at"], page[-1]["tid"]
    want = latest_page(spark, target, 30, after).collect()
    wanted = {p.part for p in page_pieces(pieces, 30, after)}
    assert len(wanted) <= 6
    # All other files are broken, and nobody notices.
    for file in (tmp_path / "t" / "tables").rglob("*.parquet"):
        if file.parent.name.removeprefix("piece=") not in wanted:
            file.write_bytes(b"broken")
    second = latest_page(spark, target, 30, after)
    assert second.collect() == want and len(want) == 30
    plan = second._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*piece#", plan)


def test_a_listing_written_again_with_fewer_pieces(spark, posts, make_posts, tmp_path):
    target = str(tmp_path / "t")
    write_timeline(spark, posts, target, 50)
    few = make_posts([(1, "a", NOON, None), (2, "b", None, None)])
    write_timeline(spark, few, target, 50)
    assert latest_page(spark, target, 10).collect() == latest_first(few).collect()
    write_timeline(spark, few.where("false"), target, 50)
    assert latest_page(spark, target, 10).count() == 0
    assert latest_page(spark, str(tmp_path / "none"), 10).count() == 0


def test_a_listing_that_is_not_finished_is_not_seen(spark, posts, make_posts, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    write_timeline(spark, posts, target, 300)
    before = latest_page(spark, target, 50).collect()
    monkeypatch.setattr(timeline, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        write_timeline(spark, make_posts([(1, "a", NOON, None)]), target)
    assert latest_page(spark, target, 50).collect() == before


def test_trend_shows_gaps(spark):
    grid = RunGrid(end=NOON, step=timedelta(hours=5), runs=8)
    ranked = {("a", "b"): {0: 5, 1: 7, 4: 6}, ("a", "c"): {3: 9}, ("b", "c"): dict.fromkeys(range(8), 2)}
    rows = [(*pair, n, grid.start + grid.step * run) for pair, own in ranked.items() for run, n in own.items()]
    frame = spark.createDataFrame(rows, "w1 string, w2 string, count long, ts timestamp_ntz")
    got = {
        (r.w1, r.w2, r.ts): (r["count"], r.previous, r.change, r.last_ts, r.missed, r.next_missed)
        for r in explore.pair_trend_on_grid(frame, grid).collect()
    }
    at = lambda run: grid.start + grid.step * run
    assert len(got) == len(rows)
    assert got["a", "b", at(0)] == (5, None, None, None, None, 0)
    assert got["a", "b", at(1)] == (7, 5, 2, at(0), 0, 2)
    # Not ranked in runs 2 and 3: the count of run 1 is not that of the run before.
    assert got["a", "b", at(4)] == (6, None, None, at(1), 2, 3)
    assert got["a", "c", at(3)] == (9, None, None, None, None, 4)
    assert got["b", "c", at(7)] == (2, 2, 0, at(6), 0, 0)
    assert explore.pair_trend_on_grid(frame.where(F.col("ts") > ntz(NOON)), grid).count() == 0
