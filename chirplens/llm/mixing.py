"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirplens.env import checkpointed
from chirplens.llm.common import BROADCAST_BYTES, SPACE, fits

# Weights given to the sources in code-point order, repeating.
CYCLE = (3, 1, 2)
SHARE = 1.5  # of all words that the mix takes
CAP = 2.0  # most that a source is repeated
SEED = "mix-1"
_RANGES = 64


def word_count(text: Column) -> Column:
    """Number of words, runs without ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def numbered(frame: DataFrame, *keys: str) -> DataFrame:
    """``frame`` with its rank ``n`` from 0 by ``keys``, NULL last.

    Rows are dealt out by ranges; a range's rows are numbered in its own task, from the number
    of rows in the ranges before it.  Keys must be unique.
    """
    order = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    ranged = frame.repartitionByRange(_RANGES, *order)
    ranged = checkpointed(ranged.withColumn("range", F.spark_partition_id()))
    # One row per range.
    sizes = ranged.groupBy("range").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("range")) - F.col("rows")
    starts = F.broadcast(sizes.select("range", before.alias("start")))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    ranked = ranged.withColumn("place", place).join(starts, "range")
    return ranked.select(*frame.columns, (F.col("start") + F.col("place")).alias("n"))


def cycled_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """``(source, weight)`` for a frame of distinct sources."""
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    chosen = F.element_at(weights, (F.col("n") % len(cycle) + 1).cast("int"))
    return numbered(sources, "source").select("source", chosen.alias("weight"))


def targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size, weight)``.

    All targets together are ``share`` times all words, dealt out by weight.  A source stops at
    ``cap`` times its own words; what it cannot take is dealt out again among the others.  In
    other words a target is ``min(cap * size, level * weight)``, and the level is raised until it
    holds: one small aggregation a round, of which the driver sees two sums.
    """
    sizes = checkpointed(sizes.withColumn("most", F.col("source_size") * cap))
    total = float(sizes.agg(F.sum("source_size")).first()[0] or 0) * share
    level = 0.0
    while True:
        full = F.col("most") < F.lit(level) * F.col("weight")
        sums = sizes.agg(
            F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("taken"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("weight"),
        ).first()
        higher = (total - sums["taken"]) / sums["weight"] if sums["weight"] else math.inf
        if higher <= level:
            break
        level = higher
        if math.isinf(level):
            break
    target = F.col("most") if math.isinf(level) else F.least("most", F.lit(level) * F.col("weight"))
    return sizes.select("source", "source_size", F.round(target, 6).alias("target"))


def _chance(id_col: str, seed: str) -> Column:
    """A number from 0 to 1 that depends on the id and the seed only."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix_plan(
    docs: DataFrame,
    weights: DataFrame | None = None,
    share: float = SHARE,
    cap: float = CAP,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies``.

    A source's rate is ``target / source_size``; a row is taken ``floor(rate)`` times and once
    more with the chance of the fraction, drawn from a hash of id and seed.  ``weights`` gives
    ``(source, weight)`` and must hold every source; without it ``CYCLE`` is used.

    NULL is a source like others, the last.  NULL and empty texts have size 0; rows of a source
    without any words are taken once.  Rows with the same id (NULL among them) share their draw.
    An empty table gives an empty result.  Columns of ``docs`` named like an added one are
    replaced.
    """
    size = word_count(F.col(text_col))
    sizes = docs.select(F.col(source_col).alias("source"), size.alias("size"))
    sizes = checkpointed(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    if weights is None:
        weights = cycled_weights(sizes.select("source"))
    w = weights.select(F.col("source").alias("__s"), F.col("weight").cast("double").alias("weight"))
    weighed = sizes.join(w, sizes["source"].eqNullSafe(w["__s"])).drop("__s")
    plan = checkpointed(targets(weighed, share, cap))
    # NULL as a value of its own, so that the key is an ordinary equality.
    plan = plan.select(
        F.col("source").isNull().alias("__none"),
        F.coalesce("source", F.lit("")).alias("__source"),
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
    )
    bytes_ = plan.agg(F.sum(F.octet_length("__source") + F.lit(96))).first()[0] or 0
    plan = F.broadcast(plan) if bytes_ <= limit else plan.hint("merge")
    rows = docs.withColumns(
        {
            "__none": F.col(source_col).isNull(),
            "__source": F.coalesce(F.col(source_col), F.lit("")),
            "__size": size,
        }
    ).join(plan, ["__none", "__source"])
    rate = F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(1.0)
    extra = _chance(id_col, seed) < rate - F.floor(rate)
    copies = (F.floor(rate) + extra.cast("long")).cast("long")
    return rows.withColumns(
        {
            "size": F.col("__size"),
            "source_size": F.col("__source_size"),
            "target": F.col("__target"),
            "copies": copies,
        }
    ).drop("__none", "__source", "__size", "__source_size", "__target")


def mix(docs: DataFrame, weights: DataFrame | None = None, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix_plan`` says, columns as they are."""
    names = {c: f"__own_{c}" for c in ("size", "source_size", "target", "copies") if c in docs.columns}
    plan = mix_plan(docs.withColumnsRenamed(names), weights, **options)
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("__copy")
    rows = plan.select(*[names.get(c, c) for c in docs.columns], copies).drop("__copy")
    return rows.withColumnsRenamed({v: k for k, v in names.items()})
