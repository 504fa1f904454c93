"""The pruned pair search and the lookup give what ranking everything gives."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chirplens.config import RunGrid
from chirplens.operators import filters, pairs, words
from chirplens.operators.lookup import lookup
from chirplens.operators.top_pairs import _by_span, top_pairs_per_run
from chirplens.operators.windows import as_one_run, top_per_run, with_span
from tests import brute

NOON = datetime(2024, 5, 1, 12)


def corpus(seed, posts=120, vocabulary=60, skew=1.3):
    """Texts with a few common and many rare words; a third of them are copies of one text."""
    rng = random.Random(seed)
    letters = "bcdfghjklm"
    vocab = [
        letters[i // 100 % 10] + letters[i // 10 % 10] + letters[i % 10] for i in range(vocabulary)
    ]
    weights = [1 / (i + 1) ** skew for i in range(vocabulary)]
    hot = " ".join(rng.choices(vocab, weights, k=12))
    texts = []
    for _ in range(posts):
        if rng.random() < 1 / 3:
            texts.append(hot)
        elif rng.random() < 0.05:
            texts.append(None)
        else:
            texts.append(" ".join(rng.choices(vocab, weights, k=rng.randint(0, 14))))
    return texts


def found(frame):
    rows = frame.orderBy("rank").collect()
    return [(r.w1, r.w2, r["count"], round(r.log_weight, 9)) for r in rows]


# Few probe words force the second phase; a broadcast limit of zero forces the shuffle joins.
@pytest.mark.parametrize(
    "seed,vocabulary,skew,k,probe,limit",
    [
        (1, 60, 1.3, 20, 400, 1 << 20),
        (2, 60, 1.3, 20, 3, 1 << 20),
        (3, 300, 0.2, 50, 10, 0),
        (4, 300, 1.0, 300, 25, 0),
        (5, 20, 0.0, 300, 8, 1 << 20),
        (6, 900, 0.9, 30, 60, 1 << 20),
    ],
)
def test_single_run(make_posts, seed, vocabulary, skew, k, probe, limit):
    texts = corpus(seed, vocabulary=vocabulary, skew=skew)
    posts = make_posts([(i, t, NOON, None) for i, t in enumerate(texts)])
    got = top_pairs_per_run(as_one_run(posts), k, probe, limit)
    assert found(got) == brute.top_pairs(texts, k)


def test_copies_of_a_long_text(make_posts):
    """Every pair of a text that is half of all posts ties for the first place."""
    rng = random.Random(10)
    long = " ".join(f"w{chr(98 + i // 24)}{chr(97 + i % 24)}" for i in range(500))
    texts = [long] * 60 + [t for t in corpus(10, posts=60) if t]
    rng.shuffle(texts)
    posts = make_posts([(i, t, NOON, None) for i, t in enumerate(texts)])
    assert found(top_pairs_per_run(as_one_run(posts), 40, 30)) == brute.top_pairs(texts, 40)


def test_first_phase_can_suffice_and_be_partial(make_posts):
    """Words left out by the first phase, whose answer is still complete."""
    texts = corpus(7, posts=200, vocabulary=400, skew=1.2)
    posts = make_posts([(i, t, NOON, None) for i, t in enumerate(texts)])
    for probe in (5, 20, 40, 80):
        assert found(top_pairs_per_run(as_one_run(posts), 10, probe)) == brute.top_pairs(texts, 10)


@pytest.mark.parametrize("probe,limit", [(400, 1 << 20), (6, 1 << 20), (6, 0)])
def test_many_runs(make_posts, probe, limit):
    rng = random.Random(8)
    texts = corpus(8, posts=150)
    created = [NOON - timedelta(seconds=rng.randint(0, 9 * 86400)) for _ in texts]
    posts = make_posts([(i, t, c, None) for i, (t, c) in enumerate(zip(texts, created))])
    grid = RunGrid(end=NOON, step=timedelta(hours=17), runs=9)
    got = top_pairs_per_run(with_span(posts, grid), 25, probe, limit)
    for run in range(grid.runs):
        ts = grid.start + grid.step * run
        seen = [t for t, c in zip(texts, created) if c <= ts and brute.in_window(c, ts)]
        assert found(got.where(F.col("run") == run)) == brute.top_pairs(seen, 25)


def test_unranked_pairs(make_posts):
    texts = corpus(9)
    posts = make_posts([(i, t, NOON, None) for i, t in enumerate(texts)])
    counts = pairs.pair_counts(posts)
    assert {(r.w1, r.w2): r["count"] for r in counts.collect()} == brute.pair_counts(texts)
    formed = pairs.word_pairs(posts).groupBy("w1", "w2").count().collect()
    assert {(r.w1, r.w2): r["count"] for r in formed} == brute.pair_counts(texts)
    share = words.word_percent(words.word_doc_freq(posts), filters.global_count(posts))
    for limit in (1 << 20, 0):
        rows = pairs.score_pairs(counts, share, limit).collect()
        got = {(r.w1, r.w2): (r["count"], round(r.log_weight, 9)) for r in rows}
        assert len(rows) == len(got)
        want = brute.scored_pairs(texts)
        assert got == {p: (c, round(s, 9)) for p, (c, s) in want.items()}
        top = pairs.top_pairs_of(pairs.score_pairs(counts, share, limit), 30).collect()
        assert [
            (r.w1, r.w2, r["count"], round(r.log_weight, 9)) for r in top
        ] == brute.top_pairs(texts, 30)


def test_lookup_ways_agree(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 70).alias("k"), "id"
    )
    dictionary = spark.range(60).select(
        F.col("id").alias("k"), (1 / (F.col("id") + 1)).alias("weight")
    )
    want = sorted(facts.join(dictionary, "k").collect())
    for fits in (True, False):
        got = lookup(facts, dictionary, ["k"], fits)
        assert sorted(got.select("k", "id", "weight").collect()) == want


def test_lookup_reads_facts_once_and_splits_a_long_hot_key(spark, tmp_path):
    """A key of 2,000 bytes in half of all facts."""
    hot = "h" * 2000
    key = F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise((F.col("id") % 501).cast("string"))
    # Text that does not shrink, so that the hot partition is large.
    rows = spark.range(0, 40_000, 1, 8).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("pay"))
    rows.write.parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    words = facts.select("k").distinct().withColumn("weight", F.length("k"))
    words.write.parquet(str(tmp_path / "words"))
    dictionary = spark.read.parquet(str(tmp_path / "words"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = lookup(facts, dictionary, ["k"], fits=False)
        assert joined.count() == 40_000
        joined.collect()
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in text
        assert text.split("Initial Plan")[0].count(f"{tmp_path}/facts") == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_long_text_is_spread(spark, make_posts):
    """The pairs of one text of 3,000 words are formed by all tasks."""
    letters = "bcdfghjklmnpqrstvwxz"
    long = " ".join(a + b + c for a in letters for b in letters for c in letters[:8])
    posts = make_posts([(1, long, NOON, None), (2, "one two", NOON, None)])
    n = len(long.split())
    rows = pairs.word_pairs(posts).groupBy(F.spark_partition_id().alias("p")).count().collect()
    sizes = [r["count"] for r in rows]
    assert sum(sizes) == n * (n - 1) // 2 + 1
    assert len(sizes) >= 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    counts = pairs.pair_counts(posts)
    assert counts.count() == n * (n - 1) // 2 + 1 and counts.where("count > 1").isEmpty()


@pytest.mark.parametrize("part_pairs", [1, 7, 4_000_000])
def test_pairs_in_arrays(make_posts, part_pairs):
    """What is told of a second word is found out once a word; lists are cut anywhere."""
    texts = [*corpus(10), "one two", "one", "", None]
    posts = make_posts([(i, t, NOON, None) for i, t in enumerate(texts)])
    got = pairs.partners(posts, part_pairs=part_pairs)
    rows = [(r.tid, r.w1, w2) for r in got.collect() for w2 in r.seconds]
    assert len(rows) == len(set(rows))
    assert set(rows) == {tuple(r) for r in pairs.word_pairs(posts).collect()}
    told = pairs.partners(posts, F.length, part_pairs).collect()
    sums = {}
    for tid, w1, w2 in rows:
        sums[tid, w1] = sums.get((tid, w1), 0) + len(w2)
    assert {(r.tid, r.w1): sum(r.seconds) for r in told} == sums


@pytest.mark.parametrize("k", [3, 5000])
def test_rank_in_parts(spark, k):
    """More rows per run than Spark's own limit reaches: parts are cut before they meet."""
    rows = spark.range(30_000).select((F.col("id") % 2).alias("run"), F.col("id"), (F.col("id") * 7919 % 10_007).alias("v"))
    got = top_per_run(rows, k, F.desc("v"), "id")
    want = {}
    for r in rows.collect():
        want.setdefault(r.run, []).append((-r.v, r.id))
    found = {(r.run, r.rank, r.id) for r in got.collect()}
    assert found == {(run, i, x[1]) for run, all_ in want.items() for i, x in enumerate(sorted(all_)[:k], 1)}
    text = got._jdf.queryExecution().executedPlan().toString()
    assert text.count("row_number") >= 2


@pytest.mark.parametrize("pass_pairs, passes", [(5, 3), (40, 64), (2_000_000, 64)])
def test_pairs_in_blocks_and_passes(make_posts, monkeypatch, pass_pairs, passes):
    """However the pairs are cut, counts are the same, and pairs are not shuffled to get their
    words even if the dictionary is too large to broadcast."""
    monkeypatch.setattr(pairs, "PASS_PAIRS", pass_pairs)
    monkeypatch.setattr(pairs, "MOST_PASSES", passes)
    monkeypatch.setattr(pairs, "BLOCKS", 3)
    texts = [*corpus(11), "yourwho one two", "one", "", None]
    posts = make_posts([(i, t, NOON, None) for i, t in enumerate([*texts, *texts[:9]])])
    texts += texts[:9]
    counts = pairs.pair_counts(posts, 0)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    rows = counts.collect()
    assert {(r.w1, r.w2): r["count"] for r in rows} == brute.pair_counts(texts)
    assert len(rows) == len(brute.pair_counts(texts))
    share = words.word_percent(words.word_doc_freq(posts), filters.global_count(posts))
    scored = pairs.scored_pairs(posts, share, 0).collect()
    want = brute.scored_pairs(texts)
    assert {(r.w1, r.w2): (r["count"], round(r.log_weight, 9)) for r in scored} == {
        p: (c, round(s, 9)) for p, (c, s) in want.items()
    }


def test_blocks_do_not_grow_with_the_pairs():
    """What is shuffled is the lists once for each block."""
    cuts = [pairs._cut_of(n, 3_000_000, 12) for n in (10**9, 8 * 10**9)]
    assert max(blocks for blocks, _ in cuts) <= pairs.BLOCKS
    for n, (blocks, passes) in zip((10**9, 8 * 10**9), cuts):
        assert n / (blocks * (blocks + 1) / 2 * passes) <= pairs.PASS_PAIRS


def test_probe_pairs_are_formed_once_a_post(make_posts, monkeypatch):
    """A post in the windows of several runs forms its pairs once, not once for each run."""
    texts = [f"{t} only{chr(97 + i % 26)}{chr(97 + i // 26)}" for i, t in enumerate(corpus(12))]
    posts = make_posts([(i, t, NOON - timedelta(hours=i % 9), None) for i, t in enumerate(texts)])
    grid = RunGrid(end=NOON + timedelta(hours=5), step=timedelta(hours=1), runs=6)
    formed = []

    def explode(lists, *keep, **options):
        formed.append(lists.count())
        return pairs.explode_pairs(lists, *keep, **options)

    monkeypatch.setattr("chirplens.operators.top_pairs.explode_pairs", explode)
    got = top_pairs_per_run(with_span(posts, grid), 5, 2000)
    assert len(formed) == 1 and formed[0] <= len(texts)
    for run in range(grid.runs):
        assert found(got.where(F.col("run") == run)) == brute.top_pairs(texts, 5)


def test_a_task_counts_the_pairs_of_few_spans(spark):
    """Lists of 20 spans stand in 8 tasks in the order of the spans, however large one of them is."""
    rows = [((s, s + 3), [s * 100 + i, 7], 1) for s in range(20) for i in range(400 if s == 4 else 30)]
    lists = spark.createDataFrame(rows, "span struct<first: long, last: long>, words array<long>, copies long")
    dealt = _by_span(lists.repartition(8)).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in dealt.groupBy("task").count().collect()]
    assert dealt.select("task", "span").distinct().count() <= 20 + len(sizes)
    assert sum(sizes) == len(rows) and max(sizes) < 400


@pytest.mark.parametrize("least", [1, 2, 32])
def test_counts_are_told_once_a_word(make_posts, monkeypatch, least):
    """What is told of a second word and a count, whether found out beforehand or not."""
    monkeypatch.setattr(pairs, "TOLD_COUNTS", least)
    monkeypatch.setattr(pairs, "PASS_PAIRS", 50)
    texts = corpus(13)
    posts = make_posts([(i, t, NOON, None) for i, t in enumerate(texts)])
    got = pairs.pair_counts(posts, told=lambda word, n: F.concat_ws(":", word, n.cast("string"))).collect()
    assert {(r.w1, r.w2): r["count"] for r in got} == brute.pair_counts(texts)
    assert max(r["count"] for r in got) > 2
    assert all(r.told == f"{r.w2}:{r['count']}" for r in got)
