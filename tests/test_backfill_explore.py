import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chirplens.config import WORD_STOPS, ReportConfig, RunGrid
from chirplens.functions import text
from chirplens.operators.windows import most_frequent_per_run, with_span
from chirplens.plans import backfill, explore, report
from tests import brute
from tests.test_top_pairs import corpus

END = datetime(2024, 5, 1, 12, 0, 0, 250000)
GRID = RunGrid(end=END, step=timedelta(hours=29), runs=7)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    texts = corpus(11, posts=140, vocabulary=40)
    links = ["http://A", "http://a", "http://b/é", "HTTP://B/É", None]
    return [
        (
            i,
            t,
            END - timedelta(microseconds=rng.randint(0, 11 * 86400 * 10**6)) if i % 20 else None,
            rng.choices(links, k=rng.randint(0, 3)) if i % 7 else None,
        )
        for i, t in enumerate(texts)
    ]


def seen(rows, ts):
    return [r for r in rows if r[2] and r[2] <= ts and brute.in_window(r[2], ts)]


def test_backfill_is_the_report_at_every_run(make_posts, rows):
    posts = make_posts(rows)
    words = backfill.word_counts_backfill(posts, GRID, 15).collect()
    urls = backfill.urls_backfill(posts, GRID, 2).collect()
    pairs = backfill.word_cooccur_backfill(posts, GRID, 10).collect()
    for run in range(GRID.runs):
        ts = GRID.start + GRID.step * run
        window = seen(rows, ts)
        texts = [r[1] for r in window]
        got = sorted(((r.word, r.percent) for r in words if r.ts == ts), key=lambda x: (-x[1], x[0]))
        assert got == brute.top_words(texts, 15)
        got = sorted(((r.url, r["count"]) for r in urls if r.ts == ts), key=lambda x: (-x[1], x[0]))
        assert got == brute.top_urls([r[3] for r in window], 2)
        got = [
            (r.w1, r.w2, r["count"], round(r.log_weight, 9)) for r in pairs if r.ts == ts
        ]
        assert sorted(got, key=lambda r: (-r[3], r[:2])) == brute.top_pairs(texts, 10)


@pytest.mark.parametrize("probe,k", [(1, 3), (4, 3), (15, 3), (15, 30), (400, 300)])
def test_frequent_words_for_any_probe(make_posts, rows, probe, k):
    """Few probed keys force the second phase, many leave it out."""
    words = with_span(make_posts(rows), GRID).select(
        "first", "last", F.explode(text.words_without(F.col("text"), WORD_STOPS)).alias("word")
    )
    got = most_frequent_per_run(words, "word", k, probe).orderBy("run", "rank").collect()
    for run in range(GRID.runs):
        texts = [r[1] for r in seen(rows, GRID.start + GRID.step * run)]
        want = [(w, round(p * len(texts))) for w, p in brute.top_words(texts, k)]
        assert [(r.word, r["count"]) for r in got if r.run == run] == want


def test_last_run_equals_the_report(make_posts, rows):
    posts = make_posts(rows)
    cfg = ReportConfig(as_of=END)
    last = lambda frame: sorted(r for r in frame.collect() if r.ts == END)
    assert last(backfill.word_counts_backfill(posts, GRID)) == sorted(
        report.word_counts_report(posts, cfg).collect()
    )
    assert last(backfill.urls_backfill(posts, GRID)) == sorted(
        report.urls_report(posts, cfg).collect()
    )
    assert last(backfill.word_cooccur_backfill(posts, GRID)) == sorted(
        report.word_cooccur_report(posts, cfg).collect()
    )


def test_order_and_partitions_do_not_matter(make_posts, rows):
    cfg = ReportConfig(as_of=END, top_words=20, top_pairs=20)
    shuffled = random.Random(1).sample(rows, len(rows))
    one = report.build_report(make_posts(rows), cfg)
    two = report.build_report(make_posts(shuffled).repartition(7), cfg)
    for name in one:
        assert one[name].collect() == two[name].collect()
    for r in one["word_counts"].collect():
        assert 0 < r.percent <= 1
    for r in one["word_cooccur"].collect():
        assert r.w1 < r.w2 and r.log_weight >= 0


@pytest.fixture(scope="module")
def cooccur(spark):
    day = lambda n: END - timedelta(days=n)
    return spark.createDataFrame(
        [
            ("a", "b", 3, 2.0, day(0)),
            ("a", "b", 9, 5.0, day(2)),
            ("a", "b", 9, 9.0, day(5)),
            ("c", "d", 4, 2.0, day(0)),
            ("e", "f", 1, 7.0, day(3)),
            ("g", "h", 1, 1.0, day(4)),
        ],
        "w1 string, w2 string, count bigint, log_weight double, ts timestamp_ntz",
    )


def test_explore_pairs(cooccur):
    got = explore.recent_interesting_pairs(cooccur, END).collect()
    assert [tuple(r) for r in got] == [("e", "f", 7.0, 1), ("a", "b", 5.0, 9), ("c", "d", 2.0, 4)]
    assert [tuple(r) for r in explore.emerging_pairs(cooccur, END).collect()] == [("c", "d", 2.0)]
    trend = explore.pair_trend(cooccur).where("w1 = 'a'").orderBy("ts").collect()
    assert [(r["count"], r.previous, r.change) for r in trend] == [
        (9, None, None),
        (9, 9, 0),
        (3, 9, -6),
    ]


def test_explore_words_and_urls(spark):
    day = lambda n: END - timedelta(days=n)
    words = spark.createDataFrame(
        [("x", 0.5, day(0)), ("x", 0.7, day(2)), ("y", 0.6, day(1)), ("z", 0.9, day(9))],
        "word string, percent double, ts timestamp_ntz",
    )
    got = explore.popular_words_in_period(words, day(2), day(0)).collect()
    assert [tuple(r) for r in got] == [("x", 0.7), ("y", 0.6)]
    urls = spark.createDataFrame(
        [("u", 3, day(0)), ("u", 4, day(1)), ("v", 4, day(3)), ("w", 99, day(4))],
        "url string, count bigint, ts timestamp_ntz",
    )
    got = explore.top_urls_recent(urls, END).collect()
    assert [tuple(r) for r in got] == [("u", 4), ("v", 4)]
