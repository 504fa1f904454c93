"""Seven posts with results worked out by hand."""

import math
from datetime import datetime

import pytest

from chirplens.config import PAIR_STOPS, WORD_STOPS, ReportConfig
from chirplens.operators import filters, pairs, words
from chirplens.plans import report

AS_OF = datetime(2017, 10, 22, 10, 18, 13, 491543)
CFG = ReportConfig(as_of=AS_OF)


@pytest.fixture(scope="module")
def posts(make_posts):
    d = lambda day, *t: datetime(2017, 10, day, *t)
    return make_posts(
        [
            (1, "Spark makes big data fun", d(22, 9), ["http://Ex.com/A"]),
            (2, "Big data big DATA!", d(21), ["http://ex.com/a", "HTTP://EX.COM/A"]),
            (3, None, d(20), None),
            (4, "your data who's who", d(18, 10, 18, 14), []),
            (5, "old news", d(18, 10, 18, 13), ["http://old"]),
            (6, "no date", None, None),
            (7, "edge", d(18, 10, 18, 13, 900000), None),
        ]
    )


def test_stop_lists():
    assert (len(WORD_STOPS), len(PAIR_STOPS)) == (74, 75)
    assert set(PAIR_STOPS) - set(WORD_STOPS) == {"your", "who"}
    assert set(WORD_STOPS) - set(PAIR_STOPS) == {"yourwho"}


def test_recency(posts):
    ids = lambda frame: sorted(r.tid for r in frame.collect())
    assert ids(filters.filter_recent(posts, AS_OF)) == [1, 2, 3, 4, 7]
    assert ids(filters.filter_as_of(posts, AS_OF)) == [1, 2, 3, 4]
    assert filters.global_count(filters.filter_as_of(posts, AS_OF)).first().n == 4


def test_words(posts):
    rows = report.word_counts_report(posts, CFG).collect()
    assert [(r.word, r.percent) for r in rows] == [
        ("data", 0.75),
        ("big", 0.5),
        *[(w, 0.25) for w in ("fun", "makes", "spark", "who", "who's", "your")],
    ]
    assert {r.ts for r in rows} == {AS_OF}


def test_urls(posts):
    rows = report.urls_report(posts, CFG).collect()
    assert [tuple(r) for r in rows] == [("http://ex.com/a", 3, AS_OF)]


def test_pairs(posts):
    rows = report.word_cooccur_report(posts, CFG).collect()
    four, two, common = math.log(4), math.log(2), math.log(4 / 3)
    want = [
        *[(p, 1, four) for p in ("fun makes", "fun spark", "makes spark")],
        *[(p, 1, two) for p in ("big fun", "big makes", "big spark")],
        ("big data", 2, 2 * common),
        *[(p, 1, common) for p in ("data fun", "data makes", "data spark", "data who's")],
    ]
    got = [(f"{r.w1} {r.w2}", r["count"], r.log_weight) for r in rows]
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_word_without_percent_has_no_pair(make_posts):
    posts = make_posts([(1, "yourwho data", AS_OF, None), (2, "other", AS_OF, None)])
    assert [r.word for r in report.word_counts_report(posts, CFG).collect()] == ["data", "other"]
    assert report.word_cooccur_report(posts, CFG).isEmpty()
    counts = pairs.pair_counts(posts)
    assert [tuple(r) for r in counts.collect()] == [("data", "yourwho", 1)]
    share = words.word_percent(words.word_doc_freq(posts), filters.global_count(posts))
    assert pairs.score_pairs(counts, share).isEmpty()


def test_empty_window(make_posts):
    old = make_posts([(1, "some old words", datetime(2000, 1, 1), ["http://x"])])
    for frame in report.build_report(old, CFG).values():
        assert frame.isEmpty()
