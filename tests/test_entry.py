"""Every registered query against its SQL on the smallest tables."""

import os
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as spark_entry  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["documents", "events", "pages", "labels", "conversations"]

# The corpus queries have tests of their own.
NAMES = [n for n in spark_entry.queries() if n not in spark_entry._corpus_queries()[0]]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def canonical(frame):
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[c]):
            frame[c] = frame[c].astype("datetime64[us]")
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def test_every_query_has_sql():
    assert set(NAMES) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = canonical(spark_entry.queries()[name](spark, FOLDER).toPandas())
    want = canonical(duck.execute(spark_entry.oracle_sql()[name]).df())
    assert len(got) > 0
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=0, atol=0)


def test_recency_filters_differ(spark):
    """The sample holds a row in the second that the two filters treat differently."""
    one, other = (
        {r.tid for r in spark_entry.queries()[n](spark, FOLDER).collect()}
        for n in ("filter_recent", "filter_as_of")
    )
    assert other < one


def test_pruned_pair_runs_are_all_pair_runs(duck):
    """The SQL of all runs leaves out words that cannot rank; without that it gives the same."""
    pruned = f"WITH {spark_entry._PAIR_RUNS} SELECT w1, w2, count, round(log_weight, 9), ts FROM cooccur"
    everything = pruned.replace("WHERE bound >= coalesce(low.score, 0) - 0.000001", "")
    assert everything != pruned
    rows = duck.execute(everything).fetchall()
    assert sorted(rows) == sorted(duck.execute(pruned).fetchall()) and len(rows) == 8100


def test_entry(spark):
    frame = spark_entry.entry(spark)
    assert frame.columns == ["w1", "w2", "count", "log_weight", "ts"]
    assert frame.count() == 300
