import json
import os
from datetime import datetime

import pytest

from chirplens.operators import filters, upsert
from chirplens.plans.report import report_from_store
from chirplens.schemas import RAW, TWEET
from chirplens.sources.feed import normalize, read_feed
from chirplens.sources.tables import read_result
from chirplens.streaming.ingest import compact, ingest_available, read_store


def record(tid, text, date="Tue Apr 04 18:05:11 +0000 2017", urls=("http://A",)):
    return {
        "id": tid,
        "text": text,
        "user": {"screen_name": f"u{tid}"},
        "created_at": date,
        "urls": [{"expanded_url": u} for u in urls],
    }


def land(folder, name, records, when):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        out.write("".join(json.dumps(r) + "\n" for r in records))
    os.utime(path, (when, when))


def test_normalize(spark, tmp_path):
    land(tmp_path / "in", "1.json", [record(7, "hi", urls=("http://A", "b")), record(8, "x", urls=())], 1)
    posts = normalize(read_feed(spark, str(tmp_path / "in")))
    assert posts.schema.simpleString() == TWEET.simpleString()
    rows = sorted(posts.collect())
    assert rows[0] == (7, "u7", "hi", datetime(2017, 4, 4, 18, 5, 11), ["http://A", "b"])
    assert rows[1].urls == []


def test_bad_date_fails(spark, tmp_path):
    land(tmp_path / "in", "1.json", [record(7, "hi", "Tue Apr 04 18:05:11 +0100 2017")], 1)
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        normalize(read_feed(spark, str(tmp_path / "in"))).collect()


def test_failed_fetch_is_an_empty_batch(spark, tmp_path):
    missing = read_feed(spark, str(tmp_path / "nothing"))
    assert missing.schema == RAW and missing.isEmpty()
    os.makedirs(tmp_path / "empty")
    assert normalize(read_feed(spark, str(tmp_path / "empty"))).isEmpty()
    assert read_store(spark, str(tmp_path / "no store")).isEmpty()


def test_take(spark, make_posts):
    raw = spark.range(1, 501)
    ids = lambda frame: sorted(r.id for r in frame.collect())
    assert ids(upsert.incremental_take(raw, None)) == list(range(1, 501))
    assert ids(upsert.incremental_take(raw, 100)) == list(range(101, 501))
    assert ids(upsert.incremental_take(raw, 500)) == []
    for stored, fresh in (([], 500), ([(497, "", None, None)], 3)):
        mark = upsert.high_water_mark(make_posts(stored)).scalar()
        assert upsert.incremental_take(raw, mark).count() == fresh
    assert upsert.high_water_mark(make_posts([])).first().last_id is None
    assert upsert.high_water_mark(make_posts([(3, "", None, None)])).first().last_id == 3


def test_backlog_is_drained_page_by_page(spark):
    """Nothing is lost, and records that share an id stay together."""
    raw = spark.range(1, 301).selectExpr("id", "1 AS seq").unionAll(spark.range(7, 300, 7).selectExpr("id", "2 AS seq"))
    mark, seen = None, []
    while page := upsert.incremental_take(raw, mark, page_size=37).collect():
        mark = max(r.id for r in page)
        seen += [tuple(r) for r in page]
    assert sorted(seen) == sorted(tuple(r) for r in raw.collect())


def test_upsert_replaces_whole_rows_and_is_idempotent(make_posts):
    day = datetime(2024, 1, 1)
    stored = make_posts([(1, "old", day, ["a"]), (2, "kept", day, None)])
    incoming = make_posts([(1, "new", None, None), (3, "added", day, [])])
    once = upsert.upsert(stored, incoming)
    assert sorted((r.tid, r.text, r.urls) for r in once.collect()) == [
        (1, "new", None),
        (2, "kept", None),
        (3, "added", []),
    ]
    twice = upsert.upsert(once, incoming)
    assert sorted(twice.collect(), key=str) == sorted(once.collect(), key=str)


def test_latest_first(make_posts):
    posts = make_posts([(1, "", datetime(2024, 1, 1), None), (2, "", datetime(2024, 1, 2), None)])
    assert [r.tid for r in filters.latest_first(posts).collect()] == [2, 1]


def test_stream(spark, tmp_path):
    landing, store, done = (str(tmp_path / n) for n in ("in", "store", "done"))

    def poll():
        ingest_available(spark, landing, store, done).awaitTermination()

    def stored(base=None):
        return sorted((r.tid, r.text) for r in read_store(spark, store, base).collect())

    land(landing, "a.json", [record(1, "one"), record(2, "two"), record(1, "one again")], 1000)
    poll()
    assert stored() == [(1, "one again"), (2, "two")]

    # Two files in one batch: the later file wins, whatever its name.
    land(landing, "z.json", [record(2, "stale"), record(3, "three")], 2000)
    land(landing, "b.json", [record(2, "TWO"), record(4, "four")], 3000)
    poll()
    want = [(1, "one again"), (2, "TWO"), (3, "three"), (4, "four")]
    assert stored() == want

    files = sorted(str(p) for p in (tmp_path / "store").rglob("*.parquet"))
    poll()  # nothing new
    assert sorted(str(p) for p in (tmp_path / "store").rglob("*.parquet")) == files
    assert stored() == want

    base = str(tmp_path / "base")
    compact(spark, store, base)
    assert stored(base) == want
    land(landing, "c.json", [record(4, "FOUR"), record(5, "five")], 4000)
    poll()
    want = [*want[:3], (4, "FOUR"), (5, "five")]
    assert stored(base) == stored() == want
    # Only the batch since the base is read from the store.
    files = read_store(spark, store, base).inputFiles()
    assert {f.rsplit("/", 2)[1] for f in files if "/store/" in f} >= {"batch=2"}
    plan = read_store(spark, store, base)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [NOT" in plan or "PartitionFilters: [((NOT" in plan or "PartitionFilters: [(NOT" in plan
    later = str(tmp_path / "later")
    compact(spark, store, later, base)
    assert stored(later) == want
    poll()
    assert stored(later) == want


@pytest.mark.parametrize("compacted", [False, True])
def test_lost_checkpoint_does_not_bring_old_rows_back(spark, tmp_path, compacted):
    landing, store = str(tmp_path / "in"), str(tmp_path / "store")

    def poll(done):
        ingest_available(spark, landing, store, str(tmp_path / done)).awaitTermination()

    for n in range(3):
        land(landing, f"{n}.json", [record(1, f"v{n}"), record(10 + n, "only here")], 1000 + n)
        poll("first")
    base = None
    if compacted:
        base = str(tmp_path / "base")
        compact(spark, store, base)
    # A new checkpoint takes what is still landed again, as its batch 0.
    os.remove(os.path.join(landing, "2.json"))
    poll("second")
    stored = lambda: sorted((r.tid, r.text) for r in read_store(spark, store, base).collect())
    want = [(1, "v2"), (10, "only here"), (11, "only here"), (12, "only here")]
    assert stored() == want
    land(landing, "3.json", [record(1, "v3")], 2000)
    poll("second")
    assert stored() == [(1, "v3"), *want[1:]]


def test_report_over_the_store(spark, tmp_path):
    landing, store, base, target = (str(tmp_path / n) for n in ("in", "store", "base", "results"))
    done = str(tmp_path / "done")
    land(landing, "a.json", [record(1, "big data"), record(2, "old", "Tue Apr 04 18:05:11 +0000 2000")], 1000)
    ingest_available(spark, landing, store, done).awaitTermination()
    compact(spark, store, base)
    land(landing, "b.json", [record(1, "small data"), record(3, "data")], 2000)
    ingest_available(spark, landing, store, done).awaitTermination()
    for _ in range(2):
        report_from_store(spark, store, base, "2017-04-05 00:00:00", target)
    got = sorted((r.word, r.percent) for r in read_result(spark, "word_counts", f"{target}/word_counts").collect())
    assert got == [("data", 1.0), ("small", 0.5)]
    recent = filters.filter_recent(read_store(spark, store, base), datetime(2017, 4, 5))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert any("/base/posts" in line and "GreaterThan(created_at" in line for line in plan.splitlines())
