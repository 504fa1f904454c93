"""Token counts of a byte-level BPE vocabulary by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirplens.llm.common import as_text, bound_batches

# About so many bytes of unknown pre-tokens are merged together.
BATCH_BYTES = 1 << 17
# Letters of text looked at together, and words a task remembers.
TEXT_CHARS = 1 << 20
KNOWN_WORDS = 600_000
_NONE = np.iinfo(np.int32).max


def _vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable bytes stand for
    themselves, the others follow from code point 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


class Merger:
    """The merges of a vocabulary, and the number of symbols they leave of a byte string."""

    def __init__(self, path: str):
        model = _vocabulary(path)["model"]
        ids = model["vocab"]
        self.of_byte = np.array([ids[x] for x in _byte_letters()], np.int64)
        self.base = np.int64(max(ids.values()) + 1)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([ids[a] * int(self.base) + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)[order]

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, ``_NONE`` if it never merges, and the symbol it makes."""
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], _NONE), self.made[at]

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each byte string.

        All strings lie end to end in one array.  In each step every string finds the lowest
        rank among its pairs and merges all pairs of that rank, from the left, at once.  Strings
        without a pair that merges leave with their length.
        """
        result = np.zeros(len(tokens), np.int64)
        sizes = np.array([len(t) for t in tokens], np.int64)
        alive = np.flatnonzero(sizes)
        joined = np.frombuffer(b"".join(tokens), np.uint8)
        symbols, sizes = self.of_byte[joined], sizes[alive]
        owner = np.repeat(np.arange(len(alive)), sizes)
        rank, made = self._pairs(symbols, owner)
        while len(alive):
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            lowest = np.minimum.reduceat(rank, starts)
            over = lowest == _NONE
            if over.any():
                result[alive[over]] = sizes[over]
                keep = ~over
                stay = np.repeat(keep, sizes)
                symbols, rank, made = symbols[stay], rank[stay], made[stay]
                alive, sizes, lowest = alive[keep], sizes[keep], lowest[keep]
                owner = np.repeat(np.arange(len(alive)), sizes)
                if not len(alive):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, sizes))
            # Of hits in a row (as in "aaa"), each second one is used up by the one before.
            if len(hit) > 1:
                first = np.concatenate(([True], np.diff(hit) > 1))
                place = np.arange(len(hit))
                run = place - np.maximum.accumulate(np.where(first, place, 0))
                hit = hit[run % 2 == 0]
            symbols[hit] = made[hit]
            stay = np.ones(len(symbols), bool)
            stay[hit + 1] = False
            sizes = sizes - np.bincount(owner[hit], minlength=len(sizes))
            moved = np.cumsum(stay) - 1
            symbols, owner, rank, made = symbols[stay], owner[stay], rank[stay], made[stay]
            # Only the pairs on either side of a new symbol have changed.
            new = moved[hit]
            touched = np.concatenate((new, new[new > 0] - 1))
            rank[touched], made[touched] = self._pairs_at(symbols, owner, touched)
        return result

    def _pairs(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._pairs_at(symbols, owner, np.arange(len(symbols)))

    def _pairs_at(self, symbols, owner, at) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pair that starts at each place; none at a string's end."""
        after = np.minimum(at + 1, len(symbols) - 1)
        rank, made = self._rank(symbols[at], symbols[after])
        rank[(after == at) | (owner[at] != owner[after])] = _NONE
        return rank, made


class TokenCounter:
    """Counts the tokens of texts, remembering the counts of words up to a fixed number.

    The pattern must cut before every run of white space, and look no further than that run's
    end; then a text can be cut at any space that follows no white space, and the pieces counted
    alone.  A space stays with the piece behind it.
    """

    def __init__(self, path: str, pattern: str):
        vocabulary = _vocabulary(path)
        special = [t["content"] for t in vocabulary.get("added_tokens", [])]
        longest = sorted(special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest))) if special else None
        self.find = regex.compile(pattern).findall
        self.wide = regex.compile(r"\s ").search
        self.pieces = regex.compile(r"\s*\S+|\s+").findall
        self.merger = Merger(path)
        self.known: dict[str, int] = {}

    def _cut(self, text: str) -> list[str]:
        """Pieces of a text, the space in front of a piece left out: a piece that has none in
        the text is marked by a NUL in front (and one that begins with NUL likewise)."""
        if self.wide(text):
            cut = self.pieces(text)
            return [x[1:] if x[0] == " " and x[1:2] != "\0" else "\0" + x for x in cut]
        cut = text.split(" ")
        cut[0] = "\0" + cut[0]
        if "\0" in text:
            cut[1:] = [x if x[:1] != "\0" else "\0 " + x for x in cut[1:]]
        return cut

    def _learn(self, new: set[str]) -> None:
        batch, owners, held = [], [], 0
        keys = list(new)
        counts = np.zeros(len(keys), np.int64)
        for k, key in enumerate(keys):
            for token in self.find(key[1:] if key[:1] == "\0" else " " + key):
                data = token.encode("utf-8", "replace")
                batch.append(data)
                owners.append(k)
                held += len(data)
            if held >= BATCH_BYTES:
                np.add.at(counts, owners, self.merger.count(batch))
                batch, owners, held = [], [], 0
        if batch:
            np.add.at(counts, owners, self.merger.count(batch))
        self.known.update(zip(keys, counts.tolist(), strict=True))

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; the unknown words of several texts are merged together."""
        result, start, held = [0] * len(texts), 0, 0
        for k, text in enumerate(texts):
            held += len(text or "")
            if held >= TEXT_CHARS or k == len(texts) - 1:
                result[start : k + 1] = self._some(texts[start : k + 1])
                start, held = k + 1, 0
        return result

    def _some(self, texts: list[str | None]) -> list[int]:
        found, marks = [], []
        for text in texts:
            parts = self.special.split(text) if self.special is not None and text else [text]
            marks.append(len(parts) - 1)
            found.append([piece for part in parts if part for piece in self._cut(part)])
        needed = set().union(*found)
        new = needed - self.known.keys()
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, new = {}, needed
        if new:
            self._learn(new)
        known = self.known
        return [m + sum(map(known.__getitem__, own)) for m, own in zip(marks, found, strict=True)]


def count_tokens(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row.

    ``path`` is a byte-level BPE vocabulary in the tokenizers' JSON format, a file that every
    executor can read, and ``pattern`` what splits texts before merging.  Special strings inside
    texts are one token each; none are added, nothing is cut off.  NULL and empty texts have no
    tokens.  Rows stay where they are; a task keeps the counts of a fixed number of pre-tokens.
    """
    schema = T.StructType(
        [
            T.StructField(id_col, T.StringType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = TokenCounter(path, pattern)
        for batch in batches:
            n = np.array(counter.counts(list(batch["text"])), np.int64)
            yield pd.DataFrame({id_col: batch["id"], "n_bytes": batch["n_bytes"], "n_tokens": n})

    bound_batches(docs.sparkSession)
    rows = docs.select(
        as_text(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
    )
    counted = rows.mapInPandas(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
    return counted.withColumn(id_col, F.col(id_col).cast(docs.schema[id_col].dataType))
