"""Exact top-k word pairs without forming all pairs.

A word in ``d`` of ``N`` posts can only be in pairs that score at most ``d * ln(N / d)``
(``scores.word_bound``).  So the search starts with the words of highest bound, a fixed number
per run, and counts all pairs among them.  If the k-th best score found is above the bound of
every word left out, the answer is complete.  Otherwise all words that reach that score are
taken and counted; every pair of the answer consists of such words.

Either way the result equals ranking all pairs, for any data.  Only the amount of work depends
on the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirplens.config import PAIR_STOPS, WORD_STOPS
from chirplens.env import checkpointed
from chirplens.functions import scores, text
from chirplens.operators.lookup import BROADCAST_BYTES, lookup, text_and_row_bytes
from chirplens.operators.pairs import explode_pairs
from chirplens.operators.windows import SPAN, count_per_run, per_run, span_of, top_per_run

# Words a first search takes per run.  A frame of at most this many words per run is broadcast,
# if its measured size allows (there may be many runs); it does not grow with the posts.
PROBE_WORDS = 400


def top_pairs_per_run(
    posts: DataFrame,
    k: int = 300,
    probe_words: int = PROBE_WORDS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(run, w1, w2, count, log_weight, rank)``, ``k`` pairs per run.

    ``posts`` carry ``tid``, ``text`` and their span of runs.  Runs its jobs at once and
    returns a checkpointed frame of ``k`` rows per run.
    """
    lists = word_lists(posts).persist()
    try:
        return top_pairs_of_lists(lists, k, probe_words, broadcast_bytes)
    finally:
        lists.unpersist()


def word_lists(posts: DataFrame) -> DataFrame:
    """``(*span, words, copies, tid)``: the different lists of counted words, how many posts have
    each, and one of those posts.

    One text may be a third of all posts.  Its copies collapse here, combined before the
    shuffle, so that its pairs are formed once; the shuffle also deals the lists out evenly,
    while recent posts sit in few files.
    """
    span = span_of(posts)
    words = F.sort_array(text.words_without(F.col("text"), WORD_STOPS))
    return (
        posts.select("tid", *span, words.alias("words"))
        .groupBy(*span, "words")
        .agg(F.count("*").alias("copies"), F.min("tid").alias("tid"))
    )


def top_pairs_of_lists(
    lists: DataFrame,
    k: int = 300,
    probe_words: int = PROBE_WORDS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """As ``top_pairs_per_run``, of the result of ``word_lists``, which is read several times and
    should be persisted.

    Words left out of the word counts have no share and thus no scored pair, so counted words
    are all that is needed.  Those that are pair stop words are never taken.
    """
    return _search(lists, k, probe_words, broadcast_bytes)


def _search(lists: DataFrame, k: int, probe_words: int, broadcast_bytes: int) -> DataFrame:
    best_first = [F.desc("bound"), "word"]
    # One word more than is taken: its bound covers all words left out.
    probe = checkpointed(
        top_per_run(_bounded_words(lists), probe_words + 1, *best_first)
    )
    taken = probe.where(F.col("rank") <= probe_words)
    small = text_and_row_bytes(taken, ["word"]) <= broadcast_bytes
    chosen = checkpointed(_taken_per_span(lists, taken)) if small else None
    if small and text_and_row_bytes(chosen, ["word"]) <= broadcast_bytes:
        counted = _probe_counts(lists, chosen)
    else:
        counted = _wanted_counts(lists, taken, small)
    found = checkpointed(_rank(counted, taken, k, small))

    floors = checkpointed(_floors(probe, found, probe_words, k))
    if not floors.where("starved").isEmpty():
        # So few words that a run lacks k pairs: take more before taking all.
        return _search(lists, k, probe_words * 8, broadcast_bytes)
    open_runs = floors.where("next_bound >= floor")
    if open_runs.isEmpty():
        return found
    # Rare: take every word that can reach the floor in the runs still open.
    wanted = checkpointed(
        _bounded_words(lists)
        .join(F.broadcast(open_runs.select("run", "floor")), "run")
        .where("bound >= floor")
        .select("run", "word", "count", "total", "bound")
    )
    fits = text_and_row_bytes(wanted, ["word"]) <= broadcast_bytes
    counted = _wanted_counts(lists, wanted, fits)
    closed = found.join(F.broadcast(open_runs.select("run")), "run", "left_anti")
    return checkpointed(closed.unionByName(_rank(counted, wanted, k, fits)))


def _bounded_words(lists: DataFrame) -> DataFrame:
    """``(run, word, count, total, bound)`` for every word of every run that can form pairs."""
    span = span_of(lists)
    words = lists.select(*span, "copies", F.explode("words").alias("word"))
    words = words.where(~F.col("word").isin(*PAIR_STOPS))
    totals = count_per_run(lists.select(*span, "copies"), [], "copies").withColumnRenamed("count", "total")
    # One row per run.
    return (
        count_per_run(words, ["word"], "copies")
        .join(F.broadcast(totals), "run")
        .withColumn("bound", scores.word_bound(F.col("count"), F.col("total")))
    )


def _taken_per_span(lists: DataFrame, taken: DataFrame) -> DataFrame:
    """``(*span, word)``: the words taken in any run of a span."""
    span = span_of(lists)
    if span == ["run"]:
        return taken.select("run", "word")
    spans = lists.select(*span).distinct().select("*", F.explode(F.sequence(*span)).alias("run"))
    return spans.join(F.broadcast(taken.select("run", "word")), "run").drop("run").distinct()


def _probe_counts(lists: DataFrame, chosen: DataFrame) -> DataFrame:
    """Pairs among the taken words.

    The few words taken in the runs of a span are matched against a post's list in place, so no
    post is shuffled.  The pairs of a post are formed once, as 64-bit keys of their words, and
    counted per span; only counts are spread over the runs.  Pairs of words that are not both
    taken in a run are left to the ranking, which drops them.
    """
    span = span_of(lists)
    seed, words = 0, chosen.select("word").distinct()
    while True:
        # No two words share a key.
        keyed = checkpointed(words.select("word", F.xxhash64("word", F.lit(seed)).alias("key")))
        if keyed.groupBy("key").count().where("count > 1").isEmpty():
            break
        seed += 1
    of_span = chosen.groupBy(*span).agg(F.collect_set("word").alias("chosen"))
    kept = F.sort_array(F.array_intersect("words", "chosen"))
    keys = F.transform(kept, lambda w: F.xxhash64(w, F.lit(seed))).alias("words")
    few = lists.join(F.broadcast(of_span), span).select(F.struct(*span).alias("span"), "copies", keys)
    few = few.where(F.size("words") > 1)
    if span == SPAN:
        few = _by_span(few)
    pairs = explode_pairs(few, "span", "copies").select("span.*", "w1", "w2", "copies")
    counts = count_per_run(pairs, ["w1", "w2"], "copies")
    for w in ("w1", "w2"):
        named = keyed.select(F.col("key").alias(w), F.col("word").alias("word_" + w))
        counts = counts.join(F.broadcast(named), w).drop(w)
    return counts.select("run", F.col("word_w1").alias("w1"), F.col("word_w2").alias("w2"), "count")


def _by_span(lists: DataFrame) -> DataFrame:
    """Lists dealt out in the order of their spans, those of a large span over several tasks.

    A task then counts the pairs of few spans; with some lists of every span in every task, pairs
    would be counted, and sent on, once for each span and task.
    """
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lists.repartitionByRange(parts, "span", F.xxhash64("words"))


def _wanted_counts(lists: DataFrame, wanted: DataFrame, fits: bool) -> DataFrame:
    """Pairs among any number of wanted words: word rows are looked up and put back into lists
    again."""
    rows = per_run(lists).select("tid", "run", "copies", F.explode("words").alias("word"))
    kept = lookup(rows, wanted.select("run", "word"), ["run", "word"], fits)
    back = kept.groupBy("tid", "run", "copies").agg(F.collect_set("word").alias("words"))
    return _pairs_per_run(back)


def _pairs_per_run(kept: DataFrame) -> DataFrame:
    lists = kept.withColumn("words", F.sort_array("words"))
    pairs = explode_pairs(lists, "run", "copies")
    return pairs.groupBy("run", "w1", "w2").agg(F.sum("copies").alias("count"))


def _rank(counts: DataFrame, words: DataFrame, k: int, fits: bool) -> DataFrame:
    """Scores and ranks counted pairs; pairs with a word that is not in ``words`` for the run
    drop out."""
    scored = counts
    for i in ("1", "2"):
        side = words.select(
            "run",
            F.col("word").alias("w" + i),
            scores.fraction(F.col("count"), F.col("total")).alias("p" + i),
        )
        scored = lookup(scored, side, ["run", "w" + i], fits)
    weight = scores.pair_score(F.col("count"), F.col("p1"), F.col("p2"))
    scored = scored.select("run", "w1", "w2", "count", weight.alias("log_weight"))
    order = [F.desc(scores.rank_key(F.col("log_weight"))), "w1", "w2"]
    return top_per_run(scored, k, *order)


def _floors(probe: DataFrame, found: DataFrame, probe_words: int, k: int) -> DataFrame:
    """``(run, next_bound, floor, starved)`` for runs that have words left out: the highest bound
    among those words, and the score that a pair must reach.  Without ``k`` pairs any score does,
    and the run is starved.

    The floor is lowered a little, so that rounding never drops a tie.
    """
    kth = found.where(F.col("rank") == k).select("run", F.col("log_weight").alias("kth"))
    floor = F.coalesce(F.col("kth") * (1 - 1e-9) - 1e-8, F.lit(0.0))
    return (
        probe.where(F.col("rank") == probe_words + 1)
        .select("run", F.col("bound").alias("next_bound"))
        .join(F.broadcast(kth), "run", "left")
        .select("run", "next_bound", floor.alias("floor"), F.col("kth").isNull().alias("starved"))
    )
