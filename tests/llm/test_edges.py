"""NULLs, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

from chirplens.llm import (
    decontaminate,
    exact_dedup,
    html_text,
    mixing,
    near_dedup,
    pii,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
)

LONG = "the quick brown fox jumps over a lazy dog " * 4000
RUN = "x" * 200_000
ROWS = [
    (1, "one two three four five six seven", "a"),
    (1, "one two three four five six seven", "a"),
    (2, None, None),
    (3, "", ""),
    (4, LONG, "a"),
    (5, RUN, "b"),
    (None, "one two three four five six seven", "b"),
    (None, None, None),
    (6, " \t\n ", "a"),
    (7, LONG, None),
]
CLASH = ["size", "shard", "slot", "kept", "score", "copies", "target", "id", "rid", "band", "h", "dk", "url"]
SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, SCHEMA)
    return frame.withColumns({c: F.lit("own") for c in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_mix(docs, none):
    plan = mixing.mix_plan(docs).collect()
    assert len(plan) == len(ROWS)
    assert all(0 <= r["copies"] <= 2 for r in plan)
    assert {r["size"] for r in plan if r["text"] is None} == {0}
    assert mixing.mix_plan(none).count() == 0
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in plan)
    assert {r["size"] for r in mixed.collect()} <= {"own"}


def test_shards(docs, none):
    got = sharding.assign(docs, shards=3).collect()
    sizes = [sum(r["shard"] == s for r in got) for s in range(3)]
    assert sorted(sizes) == [3, 3, 4]
    for s in range(3):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    assert sharding.assign(none).count() == 0
    assert {r["size"] for r in got} == {"own"}
    with pytest.raises(ValueError):
        sharding.ring(0)


def test_personal_data(docs, none):
    model = pii.SemiCrf({})
    got = {(r["doc_id"], r["spans"]) for r in pii.find_personal_data(docs, model).collect()}
    assert len(got) == 8 and {s for _, s in got} == {""}
    assert pii.find_personal_data(none, model).count() == 0
    assert pii.fit_on(none).weights == {}
    masked = pii.mask_personal_data(docs, model)
    assert masked.columns == docs.columns
    assert masked.where("text is null").count() == 2


def test_decontaminate(spark, docs, none):
    items = [(1, "one two three four five six seven"), (2, None), (3, ""), (None, "jumps over a lazy dog the quick brown fox")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontaminate.find_leaks(docs, bench).select("doc_id", "item_id", "distance"))
    assert sorted(got, key=str) == sorted(
        [(1, 1, 0), (1, 1, 0), (None, 1, 0), (4, None, 0), (7, None, 0)], key=str
    )
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 5
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.where("false")).count() == 0
    assert decontaminate.drop_leaks(docs, bench.where("false")).count() == len(ROWS)


def test_exact(docs, none):
    got = exact_dedup.exact_duplicates(docs).collect()
    assert len(got) == len(ROWS)
    one = [r for r in got if r["group_size"] == 3]
    # Rows 1, 1 and NULL; and NULL, NULL-id and empty texts.
    assert len(one) == 6
    assert {(r["keep_id"], r["kept"]) for r in one} == {(1, True), (1, False), (3, True), (3, False)}
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in got) == 5
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0


def test_tokens(docs, none):
    tokens = pytest.importorskip("public_tokenizers")
    path = tokens.path("byte_bpe_50k.json")
    got = {(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs, path, tokens.PATTERN).collect()}
    assert {(2, 0, 0), (3, 0, 0), (None, 0, 0)} <= got
    assert token_counts.count_tokens(none, path, tokens.PATTERN).count() == 0


def test_pages(spark):
    pages = [(1, None, None), (2, "http://h/a", ""), (2, "http://h/a", ""), (None, "http://[bad", "<p>x"), (3, "", "<p>" + RUN)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    frame = frame.withColumns({c: F.lit("own") for c in ("text", "n_chars", "id", "range", "host", "lines")})
    got = sorted(rows(html_text.extract_main_text(frame)), key=str)
    assert [(r[0], r[2][:3], r[3]) for r in got] == [
        (1, "", 0), (2, "", 0), (2, "", 0), (3, "xxx", 200_000), (None, "x", 1)
    ]
    assert html_text.extract_main_text(frame.where("false")).count() == 0


def test_toxicity(spark, docs, none):
    model = toxicity.ToxicityModel({"fox": 3.0, "4quic": 1.0}, -1.0)
    got = {r["doc_id"]: r["score"] for r in toxicity.with_score(docs.drop("score"), model).where("doc_id is not null").collect()}
    assert got[2] == got[3] == got[1] == got[6] and got[4] == got[7] > 0.9
    assert toxicity.drop_toxic(docs, model).count() == len(ROWS) - 2
    assert toxicity.with_score(none, model).count() == 0
    labels = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (None, 1, 1), (2, 1, None), (3, 1, 7)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, labels) == toxicity.ToxicityModel({}, -40.0)
    assert toxicity.fit(none, labels).weights == {}
    assert toxicity.fit(docs, labels.where("false")).weights == {}


def test_passages(docs, none):
    got = rows(substring_dedup.repeated_passages(docs))
    size = len(LONG.split())
    assert got == [(7, 0, size, 4, 0, size, 1.0)]
    cut = substring_dedup.cut_repeated_passages(docs, substring_dedup.repeated_passages(docs))
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    assert {r["text"].strip() for r in cut.where("doc_id = 7").collect()} == {""}
    assert substring_dedup.repeated_passages(none).count() == 0


def test_near_duplicates(docs, none):
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 5, True), (None, 1, False),
        (None, None, True), (6, 6, True), (7, 4, False),
    }
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 1 and 7 not in ids
    assert near_dedup.near_duplicates(none).count() == 0
    assert near_dedup.drop_near_duplicates(none).count() == 0


BIG = [2**53 + 1, None, 2**53 + 3, 2**63 - 1, -(2**63), None, 2**53 + 5]


@pytest.fixture(scope="module")
def big(spark):
    """Ids that a float does not hold, NULLs among them, in one batch."""
    words = ["same words in two of the texts here", "mail a@b.de now", None, "", "x y z"]
    rows = [(i, words[k % 5], "<p>text</p>", f"http://h/{k}") for k, i in enumerate(BIG)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, html string, url string")
    return frame.coalesce(1)


def test_ids_beside_nulls_stay_as_they_are(spark, big):
    ids = sorted(BIG, key=str)

    def same(frame, column="doc_id"):
        assert dict(frame.dtypes)[column] == "bigint"
        assert sorted((r[column] for r in frame.collect()), key=str) == ids

    same(pii.find_personal_data(big, pii.fit_on(big)))
    same(near_dedup.near_duplicates(big))
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(big.where("doc_id is not null")).collect()}
    assert found == {i: i for i in BIG if i is not None}
    same(html_text.extract_main_text(big.withColumnRenamed("doc_id", "page_id")), "page_id")
    items = spark.createDataFrame(
        [(2**53 + 1, "same words in two of the texts here"), (None, "no such words stand in any text at all")],
        "item_id long, text string",
    )
    leaks = decontaminate.find_leaks(big, items)
    assert {(r["doc_id"], r["item_id"]) for r in leaks.collect()} == {(2**53 + 1, 2**53 + 1), (None, 2**53 + 1)}


def test_token_counts_keep_ids(big):
    P = pytest.importorskip("public_tokenizers")
    counted = token_counts.count_tokens(big, P.path("byte_bpe_50k.json"), P.PATTERN)
    assert sorted((r["doc_id"] for r in counted.collect()), key=str) == sorted(BIG, key=str)
    assert dict(counted.dtypes)["doc_id"] == "bigint"
