from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chirplens.config import ReportConfig
from chirplens.functions.times import ntz
from chirplens.plans import explore, report
from chirplens.schemas import RESULT_TABLES
from chirplens.sources.tables import append_result, read_result

AS_OF = datetime(2024, 5, 1, 12)


def test_run_report_appends(spark, make_posts, tmp_path):
    posts = make_posts(
        [(i, f"big data {w}", AS_OF, ["U", "u"]) for i, w in enumerate(["fun", "fun", "news"])]
    )
    target = str(tmp_path / "results")
    for runs, again in ((1, 1), (2, 1), (2, 2)):
        # A run that is done again replaces itself.
        report.run_report(posts, ReportConfig(as_of=AS_OF + timedelta(hours=runs)), target)
        for name, rows in (("word_counts", 4), ("urls", 1), ("word_cooccur", 5)):
            table = read_result(spark, name, f"{target}/{name}")
            assert table.count() == runs * rows
            assert table.schema == RESULT_TABLES[name]
            assert table.select("ts").distinct().count() == runs
    assert read_result(spark, "urls", f"{target}/urls").first()["count"] == 6
    one = AS_OF + timedelta(hours=1)
    newer = read_result(spark, "urls", f"{target}/urls", after=one)
    assert [r.ts for r in newer.collect()] == [AS_OF + timedelta(hours=2)]
    assert [r.ts for r in read_result(spark, "urls", f"{target}/urls", until=one).collect()] == [one]
    best = explore.top_urls_recent(newer, AS_OF + timedelta(hours=2))
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run" in plan
    last = ReportConfig(as_of=AS_OF + timedelta(hours=2))
    for name, frame in report.build_report(posts, last).items():
        stored = read_result(spark, name, f"{target}/{name}").where(F.col("ts") == ntz(last.as_of))
        assert sorted(stored.collect()) == sorted(frame.collect())


def test_other_schemas_are_refused(spark, tmp_path):
    bad = spark.createDataFrame([("u", 1)], "url string, count int").withColumn(
        "ts", F.lit(AS_OF).cast("timestamp_ntz")
    )
    with pytest.raises(ValueError):
        append_result(bad, "urls", str(tmp_path / "urls"))
    good = bad.select("ts", "url", F.col("count").cast("long"))
    append_result(good, "urls", str(tmp_path / "urls"))
    assert read_result(spark, "urls", str(tmp_path / "urls")).columns == ["url", "count", "ts"]
