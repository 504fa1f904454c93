"""Toxicity scores from a logistic model with a counterfactual penalty.

The model sees which words, and which beginnings of words, a text holds.  Texts that name a
group of people are also shown with another group in its place, and the difference between the
two scores is penalised, so that a mention alone does not raise the score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chirplens.env import checkpointed
from chirplens.llm.common import CACHED_WORDS, bound_batches

# Labelled rows used to fit, at most, of each label; features of the model, at most.
SAMPLE_PER_LABEL = 12_000
FEATURES = 4_096
MIN_SUPPORT = 5
MOST_COUNTED = 80_000

# Terms that name groups of people, by kind; a term is swapped for the next of its kind.
IDENTITY = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "arab", "african"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("americans", "mexicans", "europeans", "africans", "chinese", "indians"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden"),
    ("schwarze", "weiße"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs"),
    ("noirs", "blancs"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos"),
    ("negros", "blancos"),
)
SWAP = {term: kind[(i + 1) % len(kind)] for kind in IDENTITY for i, term in enumerate(kind)}
_WORD = re.compile(r"\w+")


def word_set(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


def features_of(word: str) -> tuple[str, ...]:
    return (word, "4" + word[:4], "5" + word[:5]) if len(word) > 4 else (word,)


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by feature; a text's score is the logistic of their sum over its features."""

    weights: dict[str, float]
    bias: float


class _Found(dict):
    """Word to the numbers of its features that the model has."""

    def __init__(self, numbers: dict[str, int]):
        self.numbers = numbers

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        numbers = self.numbers
        value = self[word] = tuple(numbers[f] for f in features_of(word) if f in numbers)
        return value


def _ids(words: set[str], found: _Found) -> list[int]:
    ids: set[int] = set()
    for some in filter(None, map(found.__getitem__, words)):
        ids.update(some)
    return sorted(ids)


def held_out(id_column) -> F.Column:
    """The fifth of all ids whose labels are never learnt."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def training_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, per_label: int
) -> DataFrame:
    """``(text, toxic, weight)`` of at most ``per_label`` labelled rows of each label, those of
    least hash; ``weight`` gives each label its share of all labelled rows."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    known = checkpointed(known)
    shares = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = []
    for label in (0, 1):
        order = [F.xxhash64("doc_id"), F.col("doc_id")]
        taken = known.where(F.col("toxic") == label).orderBy(*order).limit(per_label)
        weight = shares.get(label, 0) / max(1, min(per_label, shares.get(label, 0)))
        parts.append(taken.withColumn("weight", F.lit(float(weight))))
    # At most 2 * per_label rows of three numbers.
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = texts.join(chosen, "doc_id")
    # Repeated rows of an id would exceed the bound: one row of each id is enough.
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    joined = joined.withColumn("n", first).where("n = 1")
    return checkpointed(joined.select("text", "toxic", "weight"))


def select_features(sample: DataFrame, limit: int = FEATURES) -> list[str]:
    """The features that tell the labels apart best, by log-likelihood ratio; identity terms
    that occur are always among them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def told() -> pd.DataFrame:
            keys = counts[0].keys() | counts[1].keys()
            rows = [(k, counts[0][k], counts[1][k]) for k in keys]
            frame = pd.DataFrame(rows, columns=["feature", "n0", "n1"])
            counts[0].clear()
            counts[1].clear()
            return frame

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                own = {f for w in word_set(text) for f in features_of(w)}
                counts[toxic].update(own)
                if len(counts[0]) + len(counts[1]) > MOST_COUNTED:
                    yield told()
        yield told()

    totals = sample.agg(F.sum(F.lit(1) - F.col("toxic")), F.sum("toxic")).first()
    n0, n1 = (float(x or 0) for x in totals)
    if not n0 or not n1:
        return []
    counted = sample.mapInPandas(count, "feature string, n0 long, n1 long")
    counted = counted.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counted = counted.where(F.col("n0") + F.col("n1") >= MIN_SUPPORT)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)

    share = (F.col("n0") + F.col("n1")) / (n0 + n1)
    gain = (
        part(F.col("n0"), share * n0)
        + part(F.col("n1"), share * n1)
        + part(n0 - F.col("n0"), (1 - share) * n0)
        + part(n1 - F.col("n1"), (1 - share) * n1)
    )
    # Features that speak for neither label clearly only add noise.
    best = counted.where(gain >= 8).orderBy(F.desc(F.round(gain, 6)), "feature").limit(limit)
    named = [r["feature"] for r in best.select("feature").collect()]
    return list(dict.fromkeys(named + sorted(SWAP)))


def _numbered(sample: DataFrame, features: list[str]) -> pd.DataFrame:
    """The sample as feature numbers, with those of the swapped text where terms occur."""
    numbers = {f: i for i, f in enumerate(features)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = _Found(numbers)
        for batch in batches:
            ids, swapped = [], []
            for text in batch["text"]:
                own = word_set(text)
                ids.append(_ids(own, found))
                named = own & SWAP.keys()
                swapped.append(_ids({SWAP.get(w, w) for w in own}, found) if named else None)
            yield pd.DataFrame(
                {"ids": ids, "swapped": swapped, "toxic": batch["toxic"], "weight": batch["weight"]}
            )

    schema = "ids array<int>, swapped array<int>, toxic int, weight double"
    return sample.mapInPandas(run, schema).toPandas()


class _Rows:
    """Rows of present features, with products in both directions."""

    def __init__(self, lists, features: int):
        lengths = [len(x) for x in lists]
        self.row = np.repeat(np.arange(len(lengths)), lengths)
        self.col = np.concatenate([np.asarray(x, np.int64) for x in lists] or [np.empty(0, np.int64)])
        self.n, self.features = len(lengths), features

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.col], self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, values[self.row], self.features)


def fit_weights(
    data: pd.DataFrame, features: int, l2: float = 1e-4, fairness: float = 1.0, steps: int = 400
) -> tuple[np.ndarray, float]:
    """Minimises weighted log loss + ``l2`` * |w|^2 + ``fairness`` * mean squared difference of
    the scores (before the logistic) of texts and their swapped versions."""
    rows = _Rows(list(data["ids"]), features)
    y = data["toxic"].to_numpy(float)
    share = data["weight"].to_numpy(float) / data["weight"].sum()
    has = data["swapped"].notna().to_numpy()
    own = _Rows(list(data["ids"][has]), features)
    other = _Rows(list(data["swapped"][has]), features)
    w, b = np.zeros(features), float(np.log((share @ y + 1e-6) / (1 - share @ y + 1e-6)))
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(rows.times(w) + b, -40, 40)))
        error = share * (p - y)
        grad = rows.back(error) + 2 * l2 * w
        if has.any():
            gap = (own.times(w) - other.times(w)) * (2 * fairness / has.sum())
            grad = grad + own.back(gap) - other.back(gap)
        grad = np.append(grad, error.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        move = (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        rate = 0.1 * (1 - 0.9 * step / steps)
        w -= rate * move[:-1]
        b -= rate * float(move[-1])
    return w, b


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_label: int = SAMPLE_PER_LABEL,
    features: int = FEATURES,
    fairness: float = 1.0,
) -> ToxicityModel:
    """Fits on a bounded sample of the labelled rows that are not held out.

    Feature choice runs over the sample in Spark; the driver gets the sample as feature numbers,
    at most ``2 * per_label`` rows of at most ``features`` small numbers.  Labels other than 0
    and 1 are ignored, several labels of one id count as toxic if any is.  Without rows of both
    labels the model scores everything 0.
    """
    bound_batches(docs.sparkSession)
    sample = training_sample(docs, labels, id_col, text_col, per_label)
    names = select_features(sample, features)
    if not names:
        return ToxicityModel({}, -40.0)
    w, b = fit_weights(_numbered(sample, names), len(names), fairness=fairness)
    return ToxicityModel({f: float(x) for f, x in zip(names, w, strict=True) if x}, b)


def score_texts(texts, model: ToxicityModel, found: _Found | None = None) -> np.ndarray:
    names = list(model.weights)
    found = _Found({f: i for i, f in enumerate(names)}) if found is None else found
    w = np.array([model.weights[f] for f in names] or [0.0])
    sums = [model.bias + sum(w[i] for i in _ids(word_set(t), found)) for t in texts]
    return 1 / (1 + np.exp(-np.clip(np.array(sums, float), -40, 40)))


def with_score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for every row.

    NULL and empty texts get the score of a text without words; every text is read whole.  The
    model, of a bounded number of weights, is sent with the tasks.
    """
    bound_batches(docs.sparkSession)
    numbers = {f: i for i, f in enumerate(model.weights)}

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = _Found(numbers)
        for batch in batches:
            yield pd.Series(score_texts(batch, model, found))

    return docs.withColumn(name, scores(F.col(text_col)))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more, columns as they are."""
    name = "__toxicity"
    return with_score(docs, model, text_col, name).where(F.col(name) < threshold).drop(name)
