from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chirplens.config import PAIR_STOPS, RunGrid
from chirplens.functions import text, times
from tests import brute


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_tokens(spark):
    cases = {
        "Don't  stop!": ["Don't", "stop"],
        "'": ["'"],
        "née": ["n", "e"],
        "a\nb\tc1d": ["a", "b", "c", "d"],
        "": [],
        " 12 ": [],
        "Kelvin": ["elvin"],
    }
    for source, want in cases.items():
        assert one(spark, text.tokens(F.lit(source))) == want
        assert one(spark, text.lower_tokens(F.lit(source))) == [w.lower() for w in want]
    assert one(spark, text.tokens(F.lit(None).cast("string"))) == []


def test_words_against_python(spark):
    texts = ["The QUICK brown fox's fox", "née a b c", "who your yourwho", "RT @x: https://t.co/Ab"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    got = frame.select(text.words_without(F.col("text"), PAIR_STOPS).alias("w")).collect()
    for source, row in zip(texts, got):
        assert sorted(row.w) == sorted(brute.words(source, PAIR_STOPS))


def test_parse_as_of():
    assert times.parse_as_of("2017-10-22 10:18:13.491543").microsecond == 491543
    assert times.parse_as_of("2017-10-22 10:18:13") == datetime(2017, 10, 22, 10, 18, 13)
    with pytest.raises(ValueError):
        times.parse_as_of("yesterday")


def test_feed_date(spark):
    read = lambda s: one(spark, times.parse_feed_date(F.lit(s).cast("string")))
    assert read("Tue Apr 04 18:05:11 +0000 2017") == datetime(2017, 4, 4, 18, 5, 11)
    for bad in (
        "Tue Apr 04 18:05:11 +0100 2017",
        "Xyz Apr 04 18:05:11 +0000 2017",
        "Apr 04 18:05:11 +0000 2017",
        "Tue Apr 34 18:05:11 +0000 2017",
        None,
    ):
        with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|not a feed date"):
            read(bad)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_results_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in New York on that day.
        at = datetime(2024, 3, 10, 2, 30, 0, 123456)
        micros = one(spark, times.epoch_micros(times.ntz(at)))
        assert micros == (at - datetime(1970, 1, 1)) // timedelta(microseconds=1)
        back = one(spark, times.parse_feed_date(F.lit("Sun Mar 10 02:30:00 +0000 2024")))
        assert back == at.replace(microsecond=0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


GRID = RunGrid(end=datetime(2024, 3, 9, 12, 0, 0, 500000), step=timedelta(hours=5), runs=30)


@settings(max_examples=15, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.integers(0, 15 * 24 * 3600 * 10**6),
            # On and next to the borders of windows.
            st.builds(
                lambda run, days, off: (
                    (GRID.start + GRID.step * run - timedelta(days=days) - datetime(2024, 2, 27))
                    // timedelta(microseconds=1)
                    + off
                ),
                st.integers(0, 29),
                st.sampled_from([0, 4]),
                st.sampled_from([-1000001, -500001, -500000, -1, 0, 1, 499999, 500000, 1000000]),
            ),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_runs_of_a_post(spark, offsets):
    created = [datetime(2024, 2, 27) + timedelta(microseconds=o) for o in offsets]
    frame = spark.createDataFrame([(c,) for c in created], "c timestamp_ntz")
    rows = frame.select(
        "c", times.first_run(F.col("c"), GRID).alias("a"), times.last_run(F.col("c"), GRID).alias("b")
    ).collect()
    run_times = [GRID.start + GRID.step * i for i in range(GRID.runs)]
    for r in rows:
        want = [i for i, ts in enumerate(run_times) if r.c <= ts and brute.in_window(r.c, ts)]
        assert list(range(r.a, r.b + 1)) == want
