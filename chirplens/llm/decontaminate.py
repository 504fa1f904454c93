"""Benchmark decontamination: pigeonhole pieces, then Myers' bit-parallel edit distance."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirplens.llm.common import as_text, bound_batches

# Edits allowed per letter of an item.
ERROR_RATE = 0.05
# Shorter items are everyday words: they count only as a whole document.
MIN_CHARS = 30
# Items are searched in blocks of about so many bytes; a block is sent to every task.
BLOCK_BYTES = 1 << 20


def normalized(text: str | None) -> str:
    """Lower case, each run of white space one space, none at the ends."""
    return " ".join(text.lower().split()) if text else ""


def error_budget(item: str, rate: float = ERROR_RATE) -> int:
    return int(len(item) * rate) if len(item) >= MIN_CHARS else 0


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length with their offsets: ``budget`` edits cannot
    touch all of them, so one is found unchanged in any match."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def least_distance(item: str, text: str) -> tuple[int, int]:
    """The least edit distance between ``item`` and any substring of ``text``, and where the
    first such substring ends.  One bit per letter of the item, one step per letter of the text."""
    size = len(item)
    full, top = (1 << size) - 1, 1 << (size - 1)
    places: dict[str, int] = defaultdict(int)
    for i, letter in enumerate(item):
        places[letter] |= 1 << i
    up, down, score = full, 0, size
    best, end = size, 0
    for i, letter in enumerate(text, 1):
        equal = places.get(letter, 0)
        vertical = equal | down
        diagonal = (((equal & up) + up) ^ up) | equal
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best, end = score, i
        plus = (plus << 1) & full
        minus = (minus << 1) & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
    return best, end


class LeakFinder:
    """Searches texts for one block of items, given as ``(item_id, normalised text)``."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items, self.rate = items, rate
        self.whole: dict[str, list[int]] = defaultdict(list)
        by_piece: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (_, text) in enumerate(items):
            if len(text) < MIN_CHARS:
                self.whole[text].append(i)
                continue
            for offset, piece in pieces(text, error_budget(text, rate)):
                by_piece[piece].append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in by_piece.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()
        self.searchable = bool(by_piece)

    def find(self, raw: str | None) -> list[tuple[int, int, int]]:
        """``(item number, distance, end)`` of every item found in a text."""
        text = normalized(raw)
        found = [(i, 0, len(text)) for i in self.whole.get(text, ())] if text else []
        if not self.searchable or not text:
            return found
        windows: dict[int, list[list[int]]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for i, offset in places:
                item = self.items[i][1]
                budget = error_budget(item, self.rate)
                start = max(0, end + 1 - size - offset - budget)
                stop = end + 1 - size - offset + len(item) + budget
                own = windows.setdefault(i, [])
                if own and start <= own[-1][1]:
                    own[-1][0] = min(own[-1][0], start)
                    own[-1][1] = max(own[-1][1], stop)
                else:
                    own.append([start, stop])
        for i, own in windows.items():
            item = self.items[i][1]
            best = min((*least_distance(item, text[a:b]), a) for a, b in own)
            if best[0] <= error_budget(item, self.rate):
                found.append((i, best[0], best[1] + best[2]))
        return found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The items, block by block; one block at a time is on the driver."""
    total = benchmark.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    count = 1 + int(total) // BLOCK_BYTES
    items = benchmark.select(
        F.col(item_col).alias("item"),
        F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(item_col, text_col), F.lit(count)).alias("block"),
    )
    for block in range(count):
        rows = items.where(F.col("block") == block).distinct().collect()
        yield sorted(
            ((r["item"], t) for r in rows if (t := normalized(r["text"]))),
            key=lambda x: (x[0] is None, x[0] or 0, x[1]),
        )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = ERROR_RATE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(id, item_id, distance, end)``: every row of ``docs`` with every item it contains.

    A row contains an item if, in lower case and with white space as single spaces, some part of
    the text is within ``rate`` edits per letter of the item; ``distance`` is the least number of
    edits and ``end`` the code point of the normalised text where that part ends.  Items of
    fewer than ``MIN_CHARS`` letters must be the whole text.

    Whole texts are searched; NULL and empty texts and items are in nothing.  Repeated rows give
    repeated results, equal items under several ids are all reported.  Nothing is shuffled.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, T.StringType()),
            T.StructField("item_id", benchmark.schema[item_col].dataType),
            T.StructField("distance", T.IntegerType()),
            T.StructField("end", T.LongType()),
        ]
    )
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(as_text(id_col).alias("id"), F.col(text_col).alias("text"))
    result = None
    for items in _blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            finder = LeakFinder(shared.value, rate)
            for batch in batches:
                at, found = [], []
                for k, text in enumerate(batch["text"]):
                    for hit in finder.find(text):
                        at.append(k)
                        found.append(hit)
                frame = pd.DataFrame(
                    {
                        id_col: batch["id"].iloc[at].array,
                        "item_id": pd.array([finder.items[i][0] for i, _, _ in found], dtype="object"),
                        "distance": np.array([d for _, d, _ in found], np.int32),
                        "end": np.array([e for _, _, e in found], np.int64),
                    }
                )
                yield frame

        part = rows.mapInPandas(run, schema)
        result = part if result is None else result.unionByName(part)
    return result.withColumn(id_col, F.col(id_col).cast(docs.schema[id_col].dataType))


def _clean(text: Column, shared: Broadcast, rate: float) -> Column:
    """Whether a text contains none of a block's items."""

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = LeakFinder(shared.value, rate)
        for batch in batches:
            yield pd.Series([not finder.find(text) for text in batch], dtype=bool)

    return clean(text)


def drop_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = ERROR_RATE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` without the rows that contain an item, columns as they are.

    The texts meet the items in place, one filter per block of items, and are not shuffled.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    for items in _blocks(benchmark, "item_id", "text"):
        shared = spark.sparkContext.broadcast(items)
        docs = docs.where(_clean(F.col(text_col), shared, rate))
    return docs
