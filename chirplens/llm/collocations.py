"""Phrase collocations from sorted streams of n-gram counts.

Counts of frequent phrases are kept as streams, one row per phrase.  In prefix order (sorted by
the words from the left) the beginnings of a phrase are the last rows before it of each shorter
length, and its extensions to the right follow at once; in suffix order (sorted by the words
from the right) the same holds of its endings and its extensions to the left.  So one pass in
lockstep over each order finds all left, right and extension counts, with no table to look up.

Only phrases as frequent as a candidate are needed: the parts of a candidate are at least as
frequent as itself, and so must an extension be that takes its place.  Counting goes by length;
a phrase is counted only where its shorter parts are frequent, as far as a filter of a fixed
size can tell.  The filter saves work and decides nothing: what it lets through is counted.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirplens.env import checkpointed
from chirplens.llm.common import CACHED_WORDS, bound_batches
from chirplens.llm.shingles import mixed

MOST_WORDS = 4
# A score is this many times the count, divided by the counts of both parts.
SCORE = 2_000_000

# What ends a piece of text.
_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
# No byte of UTF-8; stands between pieces.
_MARK = b"\xff"
_TABLE = bytes.maketrans(_ENDS, _MARK * len(_ENDS))

# A task counts so many words or places of phrases before it hands on their counts.
_HELD_WORDS = 300_000
_HELD_PLACES = 3_000_000
_HELD_PAIRS = 6_000_000
# Places whose numbers for the filter are made together.
_SLICE = 1 << 18
# Bits of a filter for each frequent phrase, and most bits (32 MB).
_BITS_PER_KEY = 16
_MOST_BITS_LOG2 = 28
_LEAST_BITS_LOG2 = 16
_SECOND = np.uint64(0xD6E8FEB86659FD93)
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Rows of a stream in one task.
STREAM_ROWS = 400_000

_H = [f"h{i}" for i in range(1, MOST_WORDS + 1)]


# --- words ---------------------------------------------------------------------------------


def marked_words(text: str | None) -> list[bytes]:
    """The words of a text in order, A-Z in lower case, with a mark at the end of each piece."""
    if not text:
        return []
    data = text.encode("utf-8", "replace").lower().translate(_TABLE)
    # Only space and tab are left of what ``split`` cuts at.
    return data.replace(_MARK, b" " + _MARK + b" ").split()


class _Hashes(dict):
    """Word to 64-bit hash of a seed, emptied when it has grown too large; the mark is 0."""

    def __init__(self, seed: int):
        super().__init__({_MARK: 0})
        self.prefix = f"{seed}:".encode()

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
            self[_MARK] = 0
        # As ``word_hash``, with the seed that Spark's function has.
        value = self[word] = xxhash.xxh64_intdigest(self.prefix + word, 42) or 1
        return value


def word_hash(word: Column, seed: int) -> Column:
    value = F.xxhash64(F.concat(F.lit(f"{seed}:"), word))
    return F.when(value == 0, F.lit(1).cast("long")).otherwise(value)


def _lang_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "replace")))


def _word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, word, f)``: all words with their counts."""
    held = _HELD_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def told() -> pa.RecordBatch:
            langs = [x for lang, own in counts.items() for x in [lang] * len(own)]
            words = [w for own in counts.values() for w in own]
            columns = [
                pa.array(langs, pa.string()),
                pa.array(words, pa.binary()).cast(pa.string()),
                pa.array([n for own in counts.values() for n in own.values()], pa.int64()),
            ]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, names=["lang", "word", "f"])

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own = counts.setdefault(lang, Counter())
                own.update(marked_words(text))
                own.pop(_MARK, None)
                if len(own) > held or len(counts) > held:
                    yield told()
            if sum(map(len, counts.values())) > held:
                yield told()
        if counts:
            yield told()

    found = docs.mapInArrow(run, "lang string, word string, f long")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def _words(docs: DataFrame) -> tuple[DataFrame, int]:
    """``(lang, word, f, h)`` of all words, and the seed of their hashes.

    Seeds are tried until no two words share a hash, so a hash is as good as the word.
    """
    counts = checkpointed(_word_counts(docs))
    seed = 0
    while True:
        words = counts.withColumn("h", word_hash(F.col("word"), seed))
        twice = words.groupBy("h").agg(F.min("word").alias("a"), F.max("word").alias("b"))
        if twice.where("a <> b").isEmpty():
            return words, seed
        seed += 1


# --- the filter of frequent phrases --------------------------------------------------------


def _phrase_keys(lang: np.ndarray, hashes: list[np.ndarray]) -> np.ndarray:
    """One number of 48 bits per phrase for the filter; few phrases share one."""
    with np.errstate(over="ignore"):
        key = lang.copy()
        for h in hashes:
            key = mixed(key * _STEP + h)
        return key >> np.uint64(16)


def _cells(keys: np.ndarray, log2: int) -> list[np.ndarray]:
    shift = np.uint64(64 - log2)
    with np.errstate(over="ignore"):
        return [mixed(keys) >> shift, mixed(keys ^ _SECOND) >> shift]


def _word_keys(words: DataFrame) -> DataFrame:
    """The filter's numbers of words, as ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([_lang_hash(x) for x in batch["lang"].to_pylist()], np.uint64)
            keys = _phrase_keys(lang, [batch["h"].to_numpy().view(np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], names=["key"])

    return words.select("lang", "h").mapInArrow(run, "key long")


def _filter(keys: DataFrame) -> Broadcast:
    """The bits of the frequent phrases with these numbers, at most ``2 ** _MOST_BITS_LOG2``.

    Bits are put together by place, so the driver gets one long for each 64 bits.
    """
    wanted = max(1, keys.count() * _BITS_PER_KEY - 1).bit_length()
    log2 = min(_MOST_BITS_LOG2, max(_LEAST_BITS_LOG2, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.unique(np.concatenate(_cells(batch["key"].to_numpy().view(np.uint64), log2)))
            at, start = np.unique(cells >> np.uint64(6), return_index=True)
            bits = np.uint64(1) << (cells & np.uint64(63))
            bits = np.bitwise_or.reduceat(bits, start) if len(cells) else bits
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.view(np.int64)), pa.array(bits.view(np.int64))], names=["at", "bits"]
            )

    told = keys.select("key").mapInArrow(run, "at long, bits long")
    table = told.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (log2 - 6), np.uint64)
    bits[table["at"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast((bits, log2))


def _holds(shared: tuple[np.ndarray, int], keys: np.ndarray) -> np.ndarray:
    bits, log2 = shared
    hit = np.ones(len(keys), bool)
    for cells in _cells(keys, log2):
        hit &= (bits[cells >> np.uint64(6)] >> (cells & np.uint64(63))) & np.uint64(1) == 1
    return hit


# --- counting phrases ----------------------------------------------------------------------


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal keys get a number each: a place of each number, its count, and the number per key."""
    order = np.argsort(keys)
    ordered = keys[order]
    begins = np.ones(len(keys), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=begins[1:])
    del ordered
    number = np.empty(len(keys), np.uint32)
    number[order] = np.cumsum(begins, dtype=np.uint32) - np.uint32(1)
    first = np.flatnonzero(begins)
    return order[first], np.diff(first, append=len(keys)), number


class _Counted:
    """Counts the phrases of a stretch of words, those of two words first.

    Words get small numbers, once, and so do phrases of two; a longer phrase is the numbers of
    its parts, so no two phrases meet.  Numbers have half the size of hashes.
    """

    def __init__(self, words: np.ndarray):
        self.number = _grouped(words)[2]
        self.two = np.zeros(len(words), np.uint32)

    def counts(self, starts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """A place and the count of each different phrase of ``n`` words at ``starts``."""
        keys = (self.number if n == 2 else self.two)[starts].astype(np.uint64)
        keys <<= np.uint64(32)
        keys |= self.two[starts + 2] if n == 4 else self.number[starts + n - 1]
        at, counts, number = _grouped(keys)
        if n == 2:
            self.two[starts] = number
        return starts[at], counts


def _phrases(words: np.ndarray, lang: np.uint64, orders: tuple[int, ...], known: tuple, size: int):
    """``(n, starts)`` of all places where a phrase of ``n`` words may be frequent: all its parts
    of ``size`` words are in the filter ``known``, and no mark is in it."""
    parts = [words[k : len(words) - size + 1 + k] for k in range(size)]
    if len(words) < size:
        return
    good = np.ones(len(parts[0]), bool)
    for part in parts:
        good &= part != 0
    places = np.flatnonzero(good)
    for s in range(0, len(places), _SLICE):
        at = places[s : s + _SLICE]
        good[at] = _holds(known, _phrase_keys(np.full(len(at), lang), [p[at] for p in parts]))
    del places
    for n in orders:
        more = n - size
        if len(good) <= more:
            return
        whole = good[: len(good) - more].copy()
        for k in range(1, more + 1):
            whole &= good[k : len(good) - more + k]
        yield n, np.flatnonzero(whole)


def _texts_held(batches: Iterator[pa.RecordBatch], seed: int, held: int) -> Iterator[tuple[str, np.ndarray]]:
    """The hashes of the words of many texts of one language, about ``held`` at a time."""
    cache = _Hashes(seed)
    texts: dict[str, list[np.ndarray]] = {}
    places = 0
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            found = marked_words(text)
            found.append(_MARK)
            texts.setdefault(lang, []).append(np.fromiter(map(cache.__getitem__, found), np.uint64, len(found)))
            places += len(found)
            if places >= held:
                for name in list(texts):
                    yield name, np.concatenate(texts.pop(name))
                places = 0
    for name in list(texts):
        yield name, np.concatenate(texts.pop(name))


def _pair_keys(docs: DataFrame, known: Broadcast, seed: int, least: int) -> DataFrame:
    """The filter's numbers of all phrases of two words found ``least`` times or more, as ``key``.

    Phrases that share a number are counted together: a few numbers too many for the filter, none
    too few, for half of what whole phrases would shuffle.
    """
    held = _HELD_PAIRS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _texts_held(batches, seed, held):
            code = _lang_hash(lang)
            for _, starts in _phrases(words, code, (2,), known.value, 1):
                keys = np.empty(len(starts), np.uint64)
                for s in range(0, len(starts), _SLICE):
                    at = starts[s : s + _SLICE]
                    keys[s : s + _SLICE] = _phrase_keys(np.full(len(at), code), [words[at], words[at + 1]])
                del starts
                keys.sort()
                begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
                counts = np.diff(begins, append=len(keys))
                keys = keys[begins]
                for s in range(0, len(keys), 200_000):
                    own = keys[s : s + 200_000].view(np.int64), counts[s : s + 200_000].astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in own], names=["key", "f"])

    counts = docs.mapInArrow(run, "key long, f long").groupBy("key").agg(F.sum("f").alias("f"))
    return checkpointed(counts.where(F.col("f") >= least).select("key"))


def _gram_counts(docs: DataFrame, known: Broadcast, seed: int, least: int) -> DataFrame:
    """``(lang, n, h1 .. h4, f)``: phrases of two words or more found ``least`` times or more."""
    held = _HELD_PLACES
    names = ["lang", "n", *_H, "f"]
    orders = tuple(range(2, MOST_WORDS + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words in _texts_held(batches, seed, held):
            counted = _Counted(words)
            for n, starts in _phrases(words, _lang_hash(lang), orders, known.value, 2):
                at, counts = counted.counts(starts, n)
                for s in range(0, len(at), 100_000):
                    own = at[s : s + 100_000]
                    columns = [
                        pa.array([lang] * len(own), pa.string()),
                        pa.array(np.full(len(own), n, np.int32)),
                        *[pa.array(words[own + k].view(np.int64)) for k in range(n)],
                        *[pa.nulls(len(own), pa.int64())] * (MOST_WORDS - n),
                        pa.array(counts[s : s + 100_000].astype(np.int64)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"lang string, n int, {', '.join(f'{h} long' for h in _H)}, f long"
    counts = docs.mapInArrow(run, schema).groupBy("lang", "n", *_H).agg(F.sum("f").alias("f"))
    return checkpointed(counts.where(F.col("f") >= least))


def frequent_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """All words as ``(lang, word, h, f)``, and the phrases of up to four words found at least
    ``least`` times in pieces of texts, as ``(lang, n, h1 .. h4, f)`` with hashes for words.

    ``docs`` has ``lang, text`` without NULLs.  Texts are read three times: for the words, for
    the numbers of frequent phrases of two words, and for the counts of phrases made of those.
    """
    words, seed = _words(docs)
    often = words.where(F.col("f") >= least)
    none = [F.lit(None).cast("long").alias(h) for h in _H[1:]]
    one = often.select("lang", F.lit(1).alias("n"), F.col("h").alias("h1"), *none, "f")
    pairs = _pair_keys(docs, _filter(_word_keys(often)), seed, least)
    return words, one.unionByName(_gram_counts(docs, _filter(pairs), seed, least))


# --- streams -------------------------------------------------------------------------------


def _last(n: np.ndarray, f: np.ndarray, order: int, carried: int) -> np.ndarray:
    """For each row the count of the last row of length ``order`` up to it."""
    at = np.where(n == order, np.arange(len(n)), -1)
    np.maximum.accumulate(at, out=at)
    return np.where(at >= 0, f[at], carried)


def _largest(n: np.ndarray, f: np.ndarray, order: int) -> tuple[int, np.ndarray]:
    """The largest count of the rows of length ``order + 1`` after each row of length ``order``,
    before the next; and of those before the first."""
    at = np.cumsum(n == order)
    more = n == order + 1
    best = np.zeros(int(at[-1]) + 1 if len(n) else 1, np.int64)
    np.maximum.at(best, at[more], f[more])
    return int(best[0]), best[1:]


def _lockstep(stream: DataFrame, keys: list[str], part: str, extension: str) -> DataFrame:
    """The stream in the order of ``keys`` with the counts ``<part>1 .. <part>3`` of the phrases
    that are the first 1 to 3 of the keys' words, and ``extension``, the count of the most
    frequent phrase of one word more.

    Rows are dealt out in ranges of the order, so a task has a bounded number of them whatever
    word they begin with.  A range may begin in the middle of a word's phrases; what the ranges
    before and after it know of them are six numbers for each range, which the driver passes on.
    """
    rows = stream.count()
    tasks = max(1, math.ceil(rows / STREAM_ROWS))
    order = [F.col("lang"), *[F.col(k).asc_nulls_first() for k in keys]]
    # Every phrase is there once, so ranges are as even as the sample that sets them.
    ranges = stream.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    ranges = checkpointed(ranges)
    shorter = range(1, MOST_WORDS)

    def read(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
        whole = [b for b in batches if b.num_rows]
        return pa.Table.from_batches(whole) if whole else None

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = read(batches)
        if table is not None:
            n, f = table["n"].to_numpy(), table["f"].to_numpy()
            last = [int(_last(n, f, d, -1)[-1]) for d in shorter]
            head = [_largest(n, f, d)[0] for d in shorter]
            part_id = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (part_id, last, head)], names=["part", "last", "head"]
            )

    told = ranges.mapInArrow(ends, "part long, last array<long>, head array<long>").collect()
    before, after = _passed_on(sorted((r["part"], r["last"], r["head"]) for r in told))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = read(batches)
        if table is None:
            return
        own = TaskContext.get().partitionId()
        n, f = table["n"].to_numpy(), table["f"].to_numpy()
        most = np.zeros(len(n), np.int64)
        for d in shorter:
            table = table.append_column(f"{part}{d}", pa.array(_last(n, f, d, before[own][d - 1])))
            best = _largest(n, f, d)[1]
            if len(best):
                best[-1] = max(best[-1], after[own][d - 1])
            most[n == d] = best
        yield from table.append_column(extension, pa.array(most)).to_batches(10_000)

    added = ", ".join(f"{c} long" for c in [*[f"{part}{d}" for d in shorter], extension])
    return ranges.mapInArrow(walk, f"{_ddl(ranges)}, {added}")


def _ddl(frame: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema.fields)


def _passed_on(ranges: list[tuple[int, list[int], list[int]]]):
    """For each range what the ones before it know (the last count of each length, -1 if none),
    and the ones after it (the largest extension of its last row of each length)."""
    lengths = MOST_WORDS - 1
    before: dict[int, list[int]] = {}
    after: dict[int, list[int]] = {}
    now = [-1] * lengths
    for part, last, _ in ranges:
        before[part] = now
        now = [a if a >= 0 else b for a, b in zip(last, now, strict=True)]
    now = [0] * lengths
    for part, last, head in reversed(ranges):
        after[part] = now
        # A range without a row of that length hands on what follows it as well.
        now = [h if a >= 0 else max(h, b) for a, h, b in zip(last, head, now, strict=True)]
    return before, after


def _wide(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def collocations(
    docs: DataFrame,
    least: int = 30,
    percent: int = 80,
    most: int = 2000,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``most`` phrases of each language.

    Texts are cut at ``. , ; : ! ?`` and line ends into pieces, these at spaces and tabs into
    words, with A-Z in lower case.  A candidate has 2 to 4 words and is found ``least`` times or
    more within pieces (``a``; overlapping places count).  Cut after its first ``k`` words it
    scores ``floor(2000000 * a / (l + r))``, with the counts ``l`` and ``r`` of both parts; the
    lowest score counts, ties to the smallest ``k``.  A candidate within a longer one that is
    found in ``percent`` % of its places is left out; as a phrase is no more frequent than its
    parts, only extensions by one word have to be looked at.  ``n`` is the number of words in the
    language.  Ties of the score fall to the higher ``a``, then to the phrase in byte order.

    A NULL language counts as ``und``, a NULL text as empty; other columns are ignored.  Repeated
    rows count again, whole texts of any length are read, an empty table gives an empty result.

    Runs its counts at once.  Counts are combined before they are shuffled, so a phrase found in
    a third of all rows costs a row per task.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    words, grams = frequent_phrases(rows, least)
    total = words.groupBy("lang").agg(F.sum("f").alias("total"))

    # Prefix order, then suffix order: the words from the right come first, and are passed as such.
    forward = _lockstep(grams, _H, "l", "right")
    turned = F.reverse(F.filter(F.array(*_H), lambda h: h.isNotNull()))
    backward = forward.withColumns({f"b{i}": F.get(turned, F.lit(i - 1)) for i in range(1, MOST_WORDS + 1)})
    both = _lockstep(backward, [f"b{i}" for i in range(1, MOST_WORDS + 1)], "r", "left")

    longer = F.greatest("left", "right")
    inside = (longer >= least) & (_wide(longer) * 100 >= _wide("f") * percent)
    cuts = []
    for k in range(1, MOST_WORDS):
        # The rest after k of n words is the last n - k words.
        rest = F.get(F.array("r1", "r2", "r3"), F.col("n") - k - 1)
        parts = _wide(f"l{k}") + _wide(rest)
        score = F.call_function("div", _wide("f") * F.lit(SCORE), parts)
        cut = F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), rest.alias("r"))
        cuts.append(F.when(F.col("n") > k, cut))
    scored = both.where((F.col("n") > 1) & ~inside).withColumn("cut", F.least(*cuts))
    scored = scored.select("lang", *_H, F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
    # Ranked by numbers first, ties kept, so that few phrases get their words back.
    best = [F.desc("score"), F.desc("a")]
    near = F.rank().over(Window.partitionBy("lang").orderBy(*best))
    near = checkpointed(scored.withColumn("near", near).where(F.col("near") <= most).drop("near"))
    near = near.withColumn("key", F.concat_ws(" ", *_H))
    spelled = near.select("lang", "key", F.posexplode(F.array(*_H)).alias("at", "h")).where("h is not null")
    spelled = spelled.join(words.where(F.col("f") >= least).select("lang", "h", "word"), ["lang", "h"])
    spelled = spelled.groupBy("lang", "key").agg(
        F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words")
    )
    spelled = spelled.select("lang", "key", F.array_join("words.word", " ").alias("phrase"))
    named = near.join(spelled, ["lang", "key"]).join(total, "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best, "phrase"))
    ranked = named.withColumn("rank", rank).where(F.col("rank") <= most)
    return ranked.select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        "a",
        "l",
        "r",
        F.col("total").alias("n"),
        "score",
    )
