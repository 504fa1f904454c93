"""MinHash near-duplicate groups: circulant signatures, banding, exact Jaccard confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chirplens.env import checkpointed
from chirplens.llm.common import BROADCAST_BYTES, as_text, bound_batches, components, has_rows, join_ids, same
from chirplens.llm.shingles import WordHashes, mixed, set_key, shingle_set

# Bands of so many coordinates.  A pair of similarity 0.80 shares no band with probability
# (1 - 0.8 ** 4) ** 25 < 2e-6, one of 0.85 with less than 1e-8.
BANDS, ROWS = 25, 4
_CHUNK = 4096
# Members of a band that are compared with so many others at a time, and the width of a matrix.
_BLOCK_ROWS = 400
_COLUMNS = 4096


def _bijection(values: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit numbers (multiplications by odd numbers and xor-shifts
    can be undone)."""
    values = values ^ (values >> np.uint32(16))
    values = values * np.uint32(0x7FEB352D)
    values ^= values >> np.uint32(15)
    values *= np.uint32(0x846CA68B)
    values ^= values >> np.uint32(16)
    return values


def circulant_signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """``size`` min-hash coordinates from two permutations of the ring of 32-bit numbers.

    The first permutation scatters the shingles over the ring.  Coordinate ``k`` is the least
    value of the second permutation, shifted round the ring by ``k``, over those places.
    """
    places = _bijection((shingles ^ (shingles >> np.uint64(32))).astype(np.uint32))
    shifts = np.arange(1, size + 1, dtype=np.uint32)[:, None]
    least = np.full(size, np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for start in range(0, len(places), _CHUNK):
            ring = places[None, start : start + _CHUNK] + shifts
            np.minimum(least, _bijection(ring * np.uint32(0x9E3779B1)).min(axis=1), out=least)
    return least


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    with np.errstate(over="ignore"):
        keys = np.arange(1, bands + 1, dtype=np.uint64)
        for column in signature.reshape(bands, rows).T:
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + column)
    return keys.view(np.int64)


def _features(docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> DataFrame:
    """``(id, n_shingles, hi, lo, bands)`` of every row, texts left behind."""
    schema = T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("hi", T.LongType()),
            T.StructField("lo", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = shingle_set(text, cache)
                if len(found):
                    key = set_key(found)
                    signature = circulant_signature(found, bands * rows)
                    out.append((len(found), *key, band_keys(signature, bands, rows)))
                else:
                    # No NULL keys: they would turn the column into floats.
                    out.append((0, 0, 0, None))
            frame = pd.DataFrame(out, columns=["n_shingles", "hi", "lo", "bands"])
            frame.insert(0, "id", batch["id"].to_numpy())
            yield frame

    rows_in = docs.select(as_text(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType
    return rows_in.mapInPandas(run, schema).withColumn("id", F.col("id").cast(kind))


def _sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, limit: int) -> DataFrame:
    """``(cid, shingles)``: the full shingle sets of the wanted classes, from the texts of their
    representatives.  ``wanted`` has ``cid, id, hi, lo``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHashes()
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = shingle_set(text, cache)
                if len(found):
                    out.append((*set_key(found), found.tobytes()))
            yield pd.DataFrame(out, columns=["hi", "lo", "shingles"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = join_ids(texts, wanted.select("id"), "left_semi", "id", limit)
    sets = texts.mapInPandas(run, "hi long, lo long, shingles binary")
    return sets.join(wanted.select("cid", "hi", "lo"), ["hi", "lo"]).select("cid", "shingles")


def _compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b, linked, n, diff)`` for pairs of classes: whether ``100 * intersection`` is at
    least ``percent * union`` on the full sets, the size of the set of ``b``, and the shingles
    that only one of the two has."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked, sizes, diffs = [], [], []
            for left, right in zip(batch["left"], batch["right"], strict=True):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                diff = np.setxor1d(x, y, assume_unique=True)
                linked.append(_similar(len(x) + len(y), len(diff), percent))
                sizes.append(len(y))
                diffs.append(diff.tobytes())
            out = batch[["a", "b"]].assign(linked=linked, n=sizes, diff=diffs)
            yield out

    members = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("right"))
    centres = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("left"))
    both = pairs.join(members.hint("merge"), "b").join(centres.hint("merge"), "a")
    return both.mapInPandas(run, "a long, b long, linked boolean, n long, diff binary")


def _similar(total, apart, percent: int):
    """Jaccard similarity from the sum of two set sizes and the number of elements that only one
    of them has: ``(total - apart) / (total + apart)``."""
    return 100 * (total - apart) >= percent * (total + apart)


def _across(rows: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between members of a band with different labels.

    Members are dealt into blocks, and each pair of blocks is one group of bounded size.  All
    members of a band are known by their differences from its centre, and two sets differ where
    their differences differ, so a product of 0/1 matrices over those compares all pairs of a
    group exactly.  A group gives no more links than connect what is linked.
    """

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("cid")
        found = [np.frombuffer(d, np.uint64) for d in group["diff"]]
        lengths = np.array([len(d) for d in found])
        owner = np.repeat(np.arange(len(found)), lengths)
        values, column = np.unique(np.concatenate(found), return_inverse=True)
        shared = np.zeros((len(found), len(found)), np.float32)
        for start in range(0, len(values), _COLUMNS):
            inside = (column >= start) & (column < start + _COLUMNS)
            part = np.zeros((len(found), min(_COLUMNS, len(values) - start)), np.float32)
            part[owner[inside], column[inside] - start] = 1
            shared += part @ part.T
        sizes = group["n"].to_numpy()
        apart = lengths[:, None] + lengths[None, :] - 2 * shared.astype(np.int64)
        linked = _similar(sizes[:, None] + sizes[None, :], apart, percent)
        root = {label: label for label in group["label"]}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        labels, ids, links = group["label"].to_numpy(), group["cid"].to_numpy(), []
        for i, j in zip(*np.nonzero(np.triu(linked & (labels[:, None] != labels[None, :]))), strict=True):
            x, y = top(labels[i]), top(labels[j])
            if x != y:
                root[x] = y
                links.append((ids[i], ids[j]))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    own = F.pmod(F.xxhash64("cid"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = rows.withColumn("own", own).withColumn("other", other)
    dealt = dealt.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    groups = dealt.select("band", "lo", "hi", "cid", "label", "n", "diff").groupBy("band", "lo", "hi")
    return groups.applyInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    rows: int = ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``(id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Rows are linked if the Jaccard similarity of their sets of 5-word shingles is at least
    ``percent`` per cent, and a component holds all that is reachable.  ``component_id`` is its
    least id; ``kept`` marks the row that has it.

    1. Every text becomes its shingle-set key and band keys; rows of equal sets are one class.
    2. Classes sharing a band meet one class of that band, a star, so that the candidates are
       linear in the size of a group.  They are compared on their full sets, and the links are
       joined into components.
    3. In bands whose classes are still in different components, every two members are compared,
       in blocks of bounded size, by what sets them apart from the centre they have both met.
       This finds what a star cannot; pairs are never rows, only links are.

    NULL and empty texts, and texts of white space, have size 0 and are linked with nothing.
    Repeated rows share one class; rows with the same id are all kept or all dropped.  Rows
    without an id belong to a class like others; NULL is a component's id only if no member
    has an id.  An empty table gives an empty result.  Other columns are ignored.
    """
    bound_batches(docs.sparkSession)
    features = _features(docs, id_col, text_col, bands, rows)
    features = checkpointed(features.withColumn("rid", F.monotonically_increasing_id()))
    full = features.where("n_shingles > 0")
    classes = checkpointed(
        full.groupBy("hi", "lo").agg(
            F.min("rid").alias("cid"), F.min("id").alias("id")
        )
    )
    banded = (
        full.join(classes.select(F.col("cid").alias("rid")), "rid", "left_semi")
        .select(F.col("rid").alias("cid"), F.explode("bands").alias("band"))
        .distinct()
    )
    several = banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    members = checkpointed(banded.join(several, "band"))
    # The class met most often is the likeliest origin of the others, and the best centre.
    met = members.groupBy("cid").agg(F.sum("size").alias("met"))
    first = F.max(F.struct(F.col("met"), (-F.col("cid")).alias("minus")))
    centres = members.join(met, "cid").groupBy("band").agg(first.alias("first"))
    members = checkpointed(members.join(centres.select("band", (-F.col("first.minus")).alias("a")), "band"))
    star = members.where("cid <> a").select("a", F.col("cid").alias("b")).distinct()
    star = _check(docs, checkpointed(star), classes, percent, id_col, text_col, broadcast_bytes)
    links = star.where("linked").select("a", "b")

    labels = checkpointed(components(links)).select(F.col("node").alias("cid"), "component")
    labelled = members.join(labels, "cid", "left")
    labelled = checkpointed(labelled.withColumn("label", F.coalesce("component", "cid")))
    open_bands = labelled.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    open_bands = open_bands.where("least < most").select("band")
    blocks = F.ceil((F.col("size") - 1) / _BLOCK_ROWS)
    rows_left = (
        labelled.where("cid <> a and size > 2")
        .join(open_bands, "band", "left_semi")
        .select("band", "label", "a", F.col("cid").alias("b"), blocks.alias("blocks"))
        .join(star.select("a", "b", "n", "diff").hint("merge"), ["a", "b"])
        .withColumnRenamed("b", "cid")
    )
    links = links.unionByName(checkpointed(_across(rows_left, percent).distinct()))
    found = checkpointed(components(links))

    named = classes.join(found.withColumnRenamed("node", "cid"), "cid").select("cid", "id", "component")
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(least, "component").select("cid", "component_id", F.lit(True).alias("linked"))
    named = classes.join(named, "cid", "left").select(
        "hi",
        "lo",
        F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.lit(True).alias("found"),
    )
    return (
        features.select("id", "n_shingles", "hi", "lo")
        .join(named, ["hi", "lo"], "left")
        .select(
            F.col("id").alias(id_col),
            "n_shingles",
            F.when(F.col("found"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
        .withColumn("kept", same(F.col(id_col), F.col("component_id")))
    )


def _check(docs, pairs, classes, percent, id_col, text_col, broadcast_bytes) -> DataFrame:
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    wanted = checkpointed(classes.join(nodes, "cid", "left_semi").select("cid", "id", "hi", "lo"))
    sets = _sets(docs, wanted, id_col, text_col, broadcast_bytes)
    return checkpointed(_compared(pairs, sets, percent).dropDuplicates(["a", "b"]))


def drop_near_duplicates(
    docs: DataFrame,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with one row of each group: the one with the least id, all columns as they are.

    Rows that repeat an id within a group are reduced to one.  Texts without words are kept.
    """
    marks = checkpointed(near_duplicates(docs, percent, id_col, text_col, broadcast_bytes=broadcast_bytes))
    dropped = marks.where("not kept").select(id_col)
    again = marks.where("kept and n_shingles > 0").groupBy(id_col).count().where("count > 1")
    again = checkpointed(again.select(id_col))
    kept = join_ids(docs, dropped, "left_anti", id_col, broadcast_bytes)
    if not has_rows(again):
        return kept
    once = join_ids(kept, again, "left_anti", id_col, broadcast_bytes)
    repeated = join_ids(kept, again, "left_semi", id_col, broadcast_bytes)
    return once.unionByName(repeated.dropDuplicates([id_col]))
