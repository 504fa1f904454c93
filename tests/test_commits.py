"""Commits of several tables, stored runs, and the store clustered by id."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chirplens.config import ReportConfig, RunGrid
from chirplens.operators import upsert
from chirplens.plans import backfill, explore, report, stored
from chirplens.schemas import RESULT_TABLES, TWEET
from chirplens.env import checkpointed
from chirplens.sources import clustered, commits, tables
from chirplens.sources.clustered import ranges, read_clustered, replaced, upsert_clustered
from chirplens.sources.tables import commit_results, read_result
from tests.test_top_pairs import corpus

AS_OF = datetime(2024, 5, 1, 12)
NAMES = list(RESULT_TABLES)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def stored_runs(spark, target):
    return {n: {r.ts for r in read_result(spark, n, f"{target}/{n}").collect()} for n in NAMES}


# --- commits -------------------------------------------------------------------------------


@pytest.fixture
def posts(make_posts):
    return make_posts([(i, f"big data {w}", AS_OF, ["u"]) for i, w in enumerate(["fun", "fun", "news"])])


@pytest.mark.parametrize("fault", range(4))
def test_a_fault_between_any_two_writes_leaves_nothing(spark, posts, tmp_path, monkeypatch, fault):
    """Three tables and the manifest: each write in turn is the one that fails."""
    target = str(tmp_path / "results")
    first, second = (ReportConfig(as_of=AS_OF + timedelta(hours=h)) for h in (1, 2))
    report.run_report(posts, first, target)
    before = stored_runs(spark, target)
    assert all(runs == {first.as_of} for runs in before.values())
    calls = []

    def failing(plain, at):
        def write(*args):
            calls.append(at)
            if len(calls) == fault + 1:
                raise OSError("disk lost")
            return plain(*args)

        return write

    monkeypatch.setattr(tables, "stage", failing(tables.stage, "stage"))
    monkeypatch.setattr(tables, "publish", failing(tables.publish, "publish"))
    with pytest.raises(OSError):
        report.run_report(posts, second, target)
    assert stored_runs(spark, target) == before
    # The retry converges, and once more changes nothing.
    for _ in range(2):
        report.run_report(posts, second, target)
        assert all(runs == {first.as_of, second.as_of} for runs in stored_runs(spark, target).values())
        assert read_result(spark, "urls", f"{target}/urls").count() == 2
    assert calls[: fault + 1] == ["stage", "stage", "stage", "publish"][: fault + 1]


def test_a_half_written_folder_is_not_read(spark, posts, tmp_path):
    target = str(tmp_path / "results")
    cfg = ReportConfig(as_of=AS_OF)
    report.run_report(posts, cfg, target)
    want = sorted(read_result(spark, "urls", f"{target}/urls").collect())
    other = report.urls_report(posts, cfg).withColumn("run", F.lit(tables.run_name(AS_OF)))
    commits.stage(other, target, "urls", "lost", "run")
    assert sorted(read_result(spark, "urls", f"{target}/urls").collect()) == want


def test_the_last_commit_of_a_run_counts_in_all_tables(spark, make_posts, tmp_path):
    target = str(tmp_path / "results")
    cfg = ReportConfig(as_of=AS_OF)
    report.run_report(make_posts([(1, "old words", AS_OF, ["u"])]), cfg, target)
    report.run_report(make_posts([(1, "new texts", AS_OF, None)]), cfg, target)
    words = read_result(spark, "word_counts", f"{target}/word_counts").collect()
    assert {r.word for r in words} == {"new", "texts"}
    # A run without any rows replaces one that had some.
    assert read_result(spark, "urls", f"{target}/urls").count() == 0
    assert read_result(spark, "urls", f"{target}/urls").schema == RESULT_TABLES["urls"]


# --- stored runs ---------------------------------------------------------------------------


def test_only_missing_runs_are_computed(spark, make_posts, tmp_path, monkeypatch):
    rng = random.Random(3)
    rows = [
        (i, t, AS_OF - timedelta(minutes=rng.randint(0, 12 * 1440)), ["u", "v"][: i % 3])
        for i, t in enumerate(corpus(3, posts=90, vocabulary=25))
    ]
    posts = make_posts(rows)
    target = str(tmp_path / "results")
    grid = RunGrid(end=AS_OF, step=timedelta(hours=30), runs=8)
    done = []
    plain = dict(stored.BACKFILLS)
    for name in NAMES:

        def counted(posts, own, name=name):
            done.append((name, own.start, own.runs))
            return plain[name](posts, own)

        monkeypatch.setitem(stored.BACKFILLS, name, counted)

    # A run in the middle is there already, so two stretches are missing.
    middle = RunGrid(end=grid.start + grid.step * 3, step=grid.step, runs=1)
    assert stored.add_missing_runs(spark, posts, target, NAMES, middle) == 1
    assert stored.add_missing_runs(spark, posts, target, NAMES, grid) == 7
    assert [d for d in done if d[0] == "urls"] == [
        ("urls", middle.start, 1),
        ("urls", grid.start, 3),
        ("urls", grid.start + grid.step * 4, 4),
    ]
    # The second time there is nothing to do.
    done.clear()
    assert stored.add_missing_runs(spark, posts, target, NAMES, grid) == 0 and not done
    for name in NAMES:
        got = read_result(spark, name, f"{target}/{name}").collect()
        assert sorted(got) == sorted(plain[name](posts, grid).collect())
    # One step further only the newest run is computed.
    later = RunGrid(end=AS_OF + grid.step, step=grid.step, runs=9)
    assert stored.add_missing_runs(spark, posts, target, NAMES, later) == 1
    assert [d[1:] for d in done] == [(later.end, 1)] * 3
    recent = read_result(spark, "word_cooccur", f"{target}/word_cooccur", after=AS_OF - timedelta(days=4))
    best = explore.recent_interesting_pairs(recent, AS_OF)
    assert "PartitionFilters: [isnotnull(run" in plan(best)
    every = backfill.word_cooccur_backfill(posts, later)
    assert sorted(best.collect()) == sorted(explore.recent_interesting_pairs(every, AS_OF).collect())


def test_runs_without_rows_are_not_done_again(spark, make_posts, tmp_path):
    grid = RunGrid(end=AS_OF, step=timedelta(hours=5), runs=4)
    none = make_posts([(1, "of old", AS_OF - timedelta(days=90), None)])
    target = str(tmp_path / "results")
    assert stored.add_missing_runs(spark, none, target, NAMES, grid) == 4
    assert stored.add_missing_runs(spark, none, target, NAMES, grid) == 0
    assert all(not runs for runs in stored_runs(spark, target).values())


def test_tables_that_are_not_as_declared_are_not_committed(spark, tmp_path):
    bad = spark.createDataFrame([("u", 1)], "url string, count int")
    with pytest.raises(ValueError):
        commit_results({"urls": bad}, [AS_OF], str(tmp_path / "results"))
    assert not commits.is_committed(spark, str(tmp_path / "results"))


# --- the clustered store -------------------------------------------------------------------


def batch(make_posts, ids, text):
    return make_posts([(i, text, AS_OF, ["u"]) for i in ids])


def contents(spark, store, **bounds):
    return sorted((r.tid is None, r.tid or 0, r.text) for r in read_clustered(spark, store, **bounds).collect())


def test_range_of(spark):
    for lows in ([], [5], [5, 9], [-4, 0, 7, 8, 100], list(range(0, 330, 3))):
        ids = spark.range(-10, 340).withColumn("at", clustered.range_of(F.col("id"), lows))
        for r in ids.collect():
            assert r["at"] == max(0, sum(x <= r["id"] for x in lows) - 1)


@pytest.mark.parametrize("limit", [64 * 30, 0])
def test_upserts(spark, make_posts, tmp_path, limit):
    """Random batches against a dictionary; small limits force slices and the join without a broadcast."""
    rng = random.Random(limit)
    store, want = str(tmp_path / "store"), {}
    assert contents(spark, store) == []
    for step in range(3):
        ids = rng.sample(range(-50, 400 + 300 * step), 120)
        ids += [None] if step % 2 else []
        upsert_clustered(spark, store, batch(make_posts, ids, f"v{step}"), 50, limit)
        want.update(dict.fromkeys(ids, f"v{step}"))
        assert contents(spark, store) == sorted((i is None, i or 0, t) for i, t in want.items())
        numbered = [p for p in ranges(spark, store) if p.low is not None]
        for p, q in zip(numbered, numbered[1:]):
            assert p.low <= p.least <= p.most < q.low
        assert sum(p.rows for p in ranges(spark, store)) == len(want)
    part = [(False, i, t) for i, t in sorted((x for x in want.items() if x[0] is not None)) if 100 <= i <= 160]
    assert contents(spark, store, least=100, most=160) == part
    assert upsert_clustered(spark, store, batch(make_posts, [], "none")) is None


def test_untouched_ranges_are_not_read(spark, make_posts, tmp_path):
    store = str(tmp_path / "store")
    upsert_clustered(spark, store, batch(make_posts, range(1000), "old"), 100)
    before = {p.part: p for p in ranges(spark, store)}
    assert len(before) == 10
    touched = {p.part for p in before.values() if any(p.least <= i <= p.most for i in (250, 955))}
    files = [f for f in (tmp_path / "store" / "tables").rglob("*.parquet")]
    kept = {f: f.read_bytes() for f in files if f.parent.name.removeprefix("range=") not in touched}
    assert len(kept) == 8
    for file in kept:
        file.write_bytes(b"broken")
    upsert_clustered(spark, store, batch(make_posts, [250, 251, 955, 5000], "new"), 100)
    after = {p.part: p for p in ranges(spark, store)}
    changed = {p for p in after if after[p] != before.get(p)}
    held = {p.part for p in before.values() if any(p.least <= i <= p.most for i in (250, 955))}
    # The id above all others makes a range of its own.
    assert changed == held | {max(after)} and len(after) == 11
    few = read_clustered(spark, store, least=250, most=251)
    assert [r.text for r in few.collect()] == ["new", "new"]
    assert re.search(r"PartitionFilters: \[[^\]]*range#", plan(few))
    for file, data in kept.items():
        file.write_bytes(data)
    assert len(contents(spark, store)) == 1001


def test_stored_rows_are_not_shuffled(spark, make_posts, tmp_path):
    store = str(tmp_path / "store")
    upsert_clustered(spark, store, batch(make_posts, range(300), "old"), 100)
    old = commits.read_parts(spark, store, TWEET, ranges(spark, store), clustered.RANGE)
    new = batch(make_posts, [5, 250], "new").withColumn(clustered.RANGE, F.lit("x"))
    text = plan(replaced(old, new, True))
    assert "BroadcastHashJoin" in text and "Exchange hash" not in text and "Sort" not in text
    assert "SortMergeJoin" in plan(replaced(old, new, False))


def test_a_fault_leaves_the_store_as_it_was(spark, make_posts, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    upsert_clustered(spark, store, batch(make_posts, range(100), "old"), 30)
    before = contents(spark, store)
    with monkeypatch.context() as patch:
        patch.setattr(clustered, "publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            upsert_clustered(spark, store, batch(make_posts, range(50, 150), "new"), 30)
    assert contents(spark, store) == before
    upsert_clustered(spark, store, batch(make_posts, range(50, 150), "new"), 30)
    assert contents(spark, store) == [(False, i, "old" if i < 50 else "new") for i in range(150)]


def test_the_store_is_the_upsert(spark, make_posts, tmp_path):
    store = str(tmp_path / "store")
    old, new = batch(make_posts, range(0, 90, 3), "old"), batch(make_posts, range(40, 120, 2), "new")
    upsert_clustered(spark, store, old, 7)
    upsert_clustered(spark, store, new, 7)
    assert sorted(read_clustered(spark, store).collect()) == sorted(upsert.upsert(old, new).collect())


def test_an_upsert_keeps_its_rows_once(spark, make_posts, tmp_path, monkeypatch):
    """Incoming texts are written to the shared folder once, not again with their ranges."""
    kept = []
    monkeypatch.setattr(clustered, "checkpointed", lambda frame: kept.append(frame.columns) or checkpointed(frame))
    store = str(tmp_path / "store")
    for part in (range(0, 40), range(30, 60)):
        posts = make_posts([(i, f"text {i} of {part.start}", None, None) for i in part])
        clustered.upsert_clustered(spark, store, posts, 8)
    assert len(kept) == 2
    got = {r.tid: r.text for r in clustered.read_clustered(spark, store).collect()}
    assert got == {i: f"text {i} of {30 if i >= 30 else 0}" for i in range(60)}
