"""What the physical plans must and must not contain."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chirplens.config import ReportConfig, RunGrid
from chirplens.operators import filters, pairs
from chirplens.operators.windows import count_per_run, top_per_run, with_span
from chirplens.plans import report
from chirplens.sources.tables import read_posts

AS_OF = datetime(2024, 5, 1, 12, 0, 0, 250000)
CFG = ReportConfig(as_of=AS_OF)


@pytest.fixture(scope="module")
def stored(spark, make_posts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("posts") / "t")
    rows = [(i, f"word{chr(97 + i % 5)} two", AS_OF - timedelta(hours=i), ["u"]) for i in range(50)]
    make_posts(rows).write.parquet(path)
    return read_posts(spark, path)


def plan(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def scans(text):
    return set(re.findall(r"ReadSchema: (\S+)", text))


def test_recency_filters_reach_the_scan(stored):
    for frame, op in (
        (filters.filter_recent(stored, AS_OF), "GreaterThan"),
        (filters.filter_as_of(stored, AS_OF), "GreaterThanOrEqual"),
    ):
        assert re.search(rf"PushedFilters: .*{op}\(created_at", plan(frame))


def test_reports_read_only_what_they_use(stored):
    text = plan(report.word_counts_report(stored, CFG))
    assert scans(text) == {
        "struct<text:string,created_at:timestamp_ntz>",
        "struct<created_at:timestamp_ntz>",
    }
    assert scans(plan(report.urls_report(stored, CFG))) == {
        "struct<created_at:timestamp_ntz,urls:array<string>>"
    }


def test_ranking_is_a_bounded_top_k(stored):
    for frame in (report.word_counts_report(stored, CFG), report.urls_report(stored, CFG)):
        assert "TakeOrderedAndProject" in plan(frame)
    grid = RunGrid(end=AS_OF, step=timedelta(hours=5), runs=5)
    rows = with_span(stored, grid).select("first", "last", F.explode("urls").alias("url"))
    text = plan(top_per_run(count_per_run(rows, ["url"]), 10, F.desc("count"), "url"))
    # One limit before the shuffle, one after.
    assert text.count("WindowGroupLimit") >= 2
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(created_at", text)


def test_no_products_and_no_python(stored):
    grid = RunGrid(end=AS_OF, step=timedelta(hours=5), runs=5)
    for frame in (
        report.word_counts_report(stored, CFG),
        report.urls_report(stored, CFG),
        count_per_run(with_span(stored, grid), ["text"]),
        pairs.word_pairs(stored),
        pairs.pair_counts(stored),
    ):
        text = plan(frame)
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert node not in text


def test_counts_combine_before_the_shuffle(stored):
    text = plan(pairs.pair_counts(stored))
    assert "partial_sum" in text and "SortAggregate" not in text
    assert "partial_count" in plan(report.urls_report(stored, CFG))


def test_recency_can_be_asked_of_the_reader(spark, make_posts, tmp_path):
    make_posts([(1, "x", AS_OF, None), (2, "y", None, None)]).write.parquet(str(tmp_path / "t"))
    assert [r.tid for r in read_posts(spark, str(tmp_path / "t"), AS_OF).collect()] == [1]
    assert read_posts(spark, str(tmp_path / "t")).where(F.col("tid") == 2).count() == 1
