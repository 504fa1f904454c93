"""The registered queries and the pipeline on the smallest tables."""

import os
from collections import Counter

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from chirplens.llm import decontaminate, entry, mixing, near_dedup, toxicity
from tests.llm.test_brute import brute_components, sellers

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query(spark, name):
    got = entry.QUERIES[name](spark, FOLDER).toPandas()
    table = "pages" if name == "op7_main_text" else "documents"
    rows = duckdb.connect().execute(f"SELECT count(*) FROM '{FOLDER}/{table}.parquet'").fetchone()[0]
    if name in ("op4_decontaminate", "op9_repeated_passages"):
        assert 0 < len(got) < rows
    else:
        assert len(got) == rows
    if name in entry.ORACLE_SQL:
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
        want = con.execute(entry.ORACLE_SQL[name]).df()
        columns = sorted(got.columns)
        a, b = (x[columns].sort_values(columns).reset_index(drop=True) for x in (got, want))
        pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=0, atol=0)


def test_near_duplicates_of_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    got = entry.op10_minhash_near_dedup(spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 85)


def test_stages(spark):
    """Every stage against what it should keep of the rows before it."""
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "minhash_near_dedup", "decontamination", "mixing", "sharding"
    ]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").persist()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = [f for _, f in corpus_pipeline.STAGES]

    first = stages[0](spark, docs, FOLDER).persist()
    model = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    scores = dict(zip(texts, toxicity.score_texts(texts.values(), model), strict=True))
    left = {r["doc_id"] for r in first.collect()}
    assert left == {i for i, s in scores.items() if s < 0.5}

    second = stages[1](spark, first, FOLDER).persist()
    groups = brute_components([(i, texts[i]) for i in left], 80)
    left = {r["doc_id"] for r in second.collect()}
    assert left == {c for _, c in groups.values()}

    third = stages[2](spark, second, FOLDER).persist()
    items = [decontaminate.normalized(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {r["doc_id"] for r in third.collect()}
    for i in left:
        found = any(x in decontaminate.normalized(texts[i]) for x in items)
        assert not (found and i in kept)
        if not found and i not in kept:
            assert any(sellers(x, decontaminate.normalized(texts[i])) <= decontaminate.error_budget(x) for x in items)

    fourth = stages[3](spark, third, FOLDER).persist()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(third).collect()}
    assert Counter(r["doc_id"] for r in fourth.collect()) == Counter({i: n for i, n in copies.items() if n})

    for frame in (first, second, third, fourth):
        assert frame.columns == docs.columns
    fifth = stages[4](spark, fourth, FOLDER).collect()
    counts = Counter(r["shard"] for r in fifth)
    assert len(fifth) == sum(copies.values()) and max(counts.values()) - min(counts.values()) <= 1
    for frame in (docs, first, second, third, fourth):
        frame.unpersist()


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == [*corpus_pipeline.DOCUMENTS, "shard", "slot"]
    assert 0 < out.count() and corpus_pipeline.ORACLE_SQL is None
    assert near_dedup.BANDS * near_dedup.ROWS == 100
