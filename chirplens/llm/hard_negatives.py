"""Hard negatives of anchors by threshold joins over an inverted index of integer vectors.

Rows are packed into chunks and anchors into blocks, and every chunk meets every block.  Within
a chunk the vectors are indexed by dimension.  A search for scores of at least ``t`` omits the
last dimensions of a vector when their norm times the anchor's norm is below ``t``: a partial
score over the dimensions left, plus the product of the norms of what was left out, is a bound
of the score.  Pairs whose bound is below the threshold are pruned, the others get their exact
score.  Thresholds start high and are lowered until the windows of an anchor are full; then they
are what a row must reach to enter one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chirplens.env import checkpointed
from chirplens.llm.common import bound_batches

# Rows in a chunk and anchors in a block; a task holds one of each and its windows.
CHUNK_ROWS = 2048
BLOCK_ANCHORS = 512
# Blocks of more bytes than this are not broadcast; chunks and groups of blocks meet by a join.
BLOCK_BYTES = 8 << 20
GROUP_BLOCKS = 64
GROUP_CHUNKS = 256
# Dimensions are indexed in steps of so many.
STEP = 8
# A threshold is lowered by this factor, at most so many times before the floor itself is tried.
LOWER = 0.8
ROUNDS = 6
# Scores below this are exact as doubles; norms from the square root of ``_MOST`` up may give
# scores that fit no long.
_EXACT = 2.0**52
_MOST = 2.0**62
# Pairs scored at a time.
_PAIRS = 1 << 16


def integer_vectors(
    vectors: DataFrame, id_col: str, label: Column, vec_col: str, scale: int = 256
) -> DataFrame:
    """``(id, label, v)``: the rows that take part, each component ``scale * x`` as a double, to be
    floored.

    Rows with a NULL id, label or vector, or a NULL or non-finite component, take no part.
    """
    vec = F.col(vec_col)
    wide = F.transform(vec, lambda x: x.cast("double") * scale)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        label.cast("long").alias("label"),
        wide.alias("v"),
        finite.alias("ok"),
    )
    return rows.where("id is not null and label is not null and v is not null and ok").drop("ok")


# --- one chunk against one block -----------------------------------------------------------


def tail_norms(vectors: np.ndarray) -> np.ndarray:
    """Row ``c`` has the norm of each vector's dimensions from ``c * STEP`` on; the last is 0."""
    n, width = vectors.shape
    cuts = -(-width // STEP)
    squares = np.zeros((n, cuts * STEP))
    squares[:, :width] = vectors * vectors
    steps = squares.reshape(n, cuts, STEP).sum(axis=2).T
    tails = np.zeros((cuts + 1, n))
    tails[:cuts] = np.cumsum(steps[::-1], axis=0)[::-1]
    return np.sqrt(tails)


class Chunk:
    """Vectors of rows, all dimensions, with the norms of their tails."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.tails = tail_norms(vectors)


def above(chunk: Chunk, anchors: np.ndarray, tails: np.ndarray, least: np.ndarray):
    """``(i, j, score)`` of all pairs of an anchor and a row with a score of at least ``least[i]``."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(anchors) or not len(chunk.ids):
        return none
    shared = min(anchors.shape[1], chunk.vectors.shape[1])
    largest = tails[0].max() * chunk.tails[0].max()
    if largest >= _EXACT:
        return _above_exact(chunk, anchors, least)
    norms = tails[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(norms > 0, least / norms, np.where(least > 0, np.inf, -np.inf)).min()
    cuts = min(len(tails), len(chunk.tails)) - 1
    # The postings of a step of dimensions hold the rows that need it.
    need = np.full(len(chunk.ids), cuts)
    if ratio > 0:
        # A little below, so that rounding omits nothing that counts.
        need = (chunk.tails[:cuts] >= ratio * (1 - 1e-9)).sum(axis=0)
    rows = np.argsort(-need, kind="stable")
    rows = rows[need[rows] > 0] if ratio > 0 else rows
    need = need[rows]
    if not len(rows):
        return none
    # What rounding may take from a bound.
    slack = 1e-9 * largest + 1e-6
    score = np.zeros((len(anchors), len(rows)))
    floor = least[:, None]
    for c in range(cuts):
        n = int(np.searchsorted(-need, -c, side="left"))
        if not n:
            break
        a, b = c * STEP, min((c + 1) * STEP, shared)
        score[:, :n] += anchors[:, a:b] @ chunk.vectors[rows[:n], a:b].T
        if c % 4 == 3 and c + 1 < cuts:
            # Rows that no anchor can reach with what remains leave the search.
            bound = score[:, :n] + tails[c + 1][:, None] * chunk.tails[c + 1][rows[:n]][None, :]
            open_rows = np.ones(len(rows), bool)
            open_rows[:n] = (bound + slack >= floor).any(axis=0)
            if not open_rows.all():
                rows, need, score = rows[open_rows], need[open_rows], score[:, open_rows]
    rest = tails[need, :].T * chunk.tails[need, rows][None, :]
    i, j = np.nonzero(score + rest + slack >= floor)
    if (need < cuts).any():
        found = np.empty(len(i))
        for s in range(0, len(i), _PAIRS):
            part = slice(s, s + _PAIRS)
            found[part] = np.einsum("pd,pd->p", anchors[i[part], :shared], chunk.vectors[rows[j[part]], :shared])
    else:
        found = score[i, j]
    kept = found >= least[i]
    return i[kept], rows[j[kept]], found[kept].astype(np.int64)


def _above_exact(chunk: Chunk, anchors: np.ndarray, least: np.ndarray):
    """The same for vectors so long that doubles would round: whole numbers of any size."""
    shared = min(anchors.shape[1], chunk.vectors.shape[1])
    rows = [[int(x) for x in v[:shared]] for v in chunk.vectors]
    out = []
    for i, anchor in enumerate(anchors):
        own = [int(x) for x in anchor[:shared]]
        for j, row in enumerate(rows):
            score = sum(x * y for x, y in zip(own, row, strict=True))
            if float(score) >= least[i]:
                out.append((i, j, score))
    i, j, score = np.array(out, np.int64).reshape(-1, 3).T
    return i, j, score


def _below(scores: np.ndarray) -> np.ndarray:
    """As doubles that are no greater."""
    return scores - np.where(np.abs(scores) >= 2**53, 1024.0, 0.0)


class Windows:
    """The best rows so far of a block's anchors, ``k`` for each window of scores.

    ``low`` and ``high`` are the bounds of the windows, anchors by windows; a window with
    ``low > high`` is none.
    """

    def __init__(self, ids, labels, vectors, low: np.ndarray, high: np.ndarray, k: int, same: bool):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.tails = tail_norms(vectors)
        self.low, self.high, self.k, self.same = low, high, k, same
        self.real = low <= high
        self.anchor = np.zeros(0, np.int64)
        self.row = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        # What a score must reach, and whether the windows are full.
        none = ~self.real.any(axis=1)
        self.floor = np.where(self.real, _below(low), np.inf).min(axis=1, initial=np.inf)
        self.top = np.where(self.real, -_below(-high), -np.inf).max(axis=1, initial=-np.inf)
        self.least = self.floor.copy()
        self.full = none

    def meet(self, chunk: Chunk) -> None:
        """Takes what a chunk has for the windows."""
        self._search(chunk, np.flatnonzero(self.full), self.least, None)
        wanting = np.flatnonzero(~self.full)
        if not len(wanting) or not len(chunk.ids):
            return
        # No score is above the product of the norms, nor of use above the highest window.
        start = np.minimum(self.top, self.tails[0] * chunk.tails[0].max() + 1)
        before = np.full(len(self.ids), np.inf)
        for step in range(1, ROUNDS + 2):
            least = np.maximum(start * LOWER**step, self.floor)
            least = np.where(start <= 0, self.floor, least)
            if step > ROUNDS:
                least = self.floor
            # An anchor whose windows have filled needs nothing below its threshold.
            least = np.maximum(least, self.least)
            wanting = wanting[before[wanting] > least[wanting]]
            if not len(wanting):
                return
            self._search(chunk, wanting, least, before)
            before = least

    def _search(self, chunk: Chunk, anchors: np.ndarray, least: np.ndarray, before) -> None:
        """Adds the rows with ``least <= score < before`` and sets the thresholds anew."""
        anchors = anchors[np.isfinite(least[anchors]) | (least[anchors] < 0)]
        if not len(anchors):
            return
        i, j, score = above(chunk, self.vectors[anchors], self.tails[:, anchors], least[anchors])
        i = anchors[i]
        fit = (chunk.labels[j] == self.labels[i]) == self.same
        fit &= (chunk.ids[j] != self.ids[i]) & (score <= self.top[i])
        if before is not None:
            fit &= score < before[i]
        if not fit.any():
            return
        self.anchor = np.concatenate([self.anchor, i[fit]])
        self.row = np.concatenate([self.row, chunk.ids[j[fit]]])
        self.score = np.concatenate([self.score, score[fit]])
        self._trim()

    def _trim(self) -> None:
        """Keeps the first ``k`` of each window."""
        order = np.lexsort((self.row, -self.score, self.anchor))
        self.anchor, self.row, self.score = self.anchor[order], self.row[order], self.score[order]
        kept = np.zeros(len(order), bool)
        need = np.full(self.low.shape, np.inf)
        for w in range(self.low.shape[1]):
            at = np.flatnonzero(
                (self.score >= self.low[self.anchor, w]) & (self.score <= self.high[self.anchor, w])
            )
            own = self.anchor[at]
            place = np.arange(len(at)) - np.searchsorted(own, own, side="left")
            kept[at[place < self.k]] = True
            real = self.real[:, w]
            need[real, w] = _below(self.low[real, w])
            last = at[place == self.k - 1]
            need[self.anchor[last], w] = _below(self.score[last])
            full = np.zeros(len(self.ids), bool)
            full[self.anchor[last]] = True
            self.full = (full | ~real) if w == 0 else self.full & (full | ~real)
        self.least = need.min(axis=1, initial=np.inf)
        self.anchor, self.row, self.score = self.anchor[kept], self.row[kept], self.score[kept]


# --- on Spark ------------------------------------------------------------------------------

_CHUNKS = "chunk string, ids binary, labels binary, vectors binary, width int"
_BLOCKS = "a_ids binary, a_labels binary, a_vectors binary, a_width int, low binary, high binary, n_windows int"


def _matrix(lists: pa.Array) -> np.ndarray:
    """Vectors as rows of a matrix; shorter ones are filled up with 0."""
    sizes = np.asarray(lists.value_lengths())
    out = np.zeros((len(sizes), int(sizes.max()) if len(sizes) else 0))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = np.asarray(lists.flatten())
    return np.floor(out)


def _row(**values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v]) for v in values.values()], names=list(values))


def _packed(rows: DataFrame) -> DataFrame:
    """Chunks of up to ``CHUNK_ROWS`` rows, as they come.  A row whose norm is so large that a
    score may not fit a long is left out."""
    size = CHUNK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, held, waiting = TaskContext.get().partitionId(), 0, 0, []

        def told() -> pa.RecordBatch:
            nonlocal count, held
            table = pa.Table.from_batches(waiting).combine_chunks()
            waiting.clear()
            held = 0
            ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
            vectors = _matrix(table.column("v").combine_chunks())
            fit = (vectors * vectors).sum(axis=1) < _MOST
            ids, labels, vectors = ids[fit], labels[fit], vectors[fit]
            count += 1
            return _row(
                chunk=f"{part}-{count}",
                ids=ids.astype(np.int64).tobytes(),
                labels=labels.astype(np.int64).tobytes(),
                vectors=vectors.tobytes(),
                width=np.int32(vectors.shape[1]),
            )

        for batch in batches:
            for start in range(0, batch.num_rows, size):
                piece = batch.slice(start, size)
                if held and held + piece.num_rows > size:
                    yield told()
                if piece.num_rows:
                    waiting.append(piece)
                    held += piece.num_rows
        if held:
            yield told()

    return rows.mapInArrow(run, _CHUNKS)


def _blocked(anchors: DataFrame, rows: int) -> DataFrame:
    """Blocks of up to ``BLOCK_ANCHORS`` anchors ``(id, label, v, low, high)`` with a number ``g``
    for each group of blocks."""
    size = BLOCK_ANCHORS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, size):
                piece = batch.slice(start, size)
                if not piece.num_rows:
                    continue
                low, high = (
                    [np.array(x, np.int64) for x in piece.column(c).to_pylist()] for c in ("low", "high")
                )
                n = max(map(len, low))
                bounds = np.zeros((2, len(low), n), np.int64)
                bounds[0] = 1
                for k, (a, b) in enumerate(zip(low, high, strict=True)):
                    bounds[0, k, : len(a)], bounds[1, k, : len(b)] = a, b
                vectors = _matrix(piece.column("v"))
                fit = (vectors * vectors).sum(axis=1) < _MOST
                yield _row(
                    a_ids=piece.column("id").to_numpy()[fit].astype(np.int64).tobytes(),
                    a_labels=piece.column("label").to_numpy()[fit].astype(np.int64).tobytes(),
                    a_vectors=vectors[fit].tobytes(),
                    a_width=np.int32(vectors.shape[1]),
                    low=bounds[0][fit].tobytes(),
                    high=bounds[1][fit].tobytes(),
                    n_windows=np.int32(n),
                )

    dealt = anchors.repartition(max(1, math.ceil(rows / size)), "id")
    return dealt.mapInArrow(run, _BLOCKS)


def _met(rows: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """``(anchor, row, score)``: what each task has found for the windows of all anchors, the first
    ``k`` of each window among it.

    Every chunk of rows meets every block of anchors.  Blocks are broadcast if their measured
    size allows.  Beyond that groups of blocks and groups of chunks are dealt out, and each two
    meet in one task: a row moves once for every ``GROUP_BLOCKS`` blocks.
    """
    bound_batches(rows.sparkSession)
    sized = anchors.agg(
        F.count("*").alias("n"), F.sum(F.size("v") * 8 + F.size("low") * 16 + F.lit(64)).alias("bytes")
    ).first()
    blocks = checkpointed(_blocked(anchors, sized["n"]))
    chunks = _packed(rows)
    if (sized["bytes"] or 0) <= BLOCK_BYTES:
        met = chunks.withColumn("g", F.lit(0)).join(F.broadcast(blocks.withColumn("g", F.lit(0))), "g")
    else:
        n_blocks = blocks.count()
        groups = math.ceil(n_blocks / GROUP_BLOCKS)
        parts = math.ceil(rows.count() / (CHUNK_ROWS * GROUP_CHUNKS))
        every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        left = chunks.withColumn("p", F.pmod(F.xxhash64("chunk"), F.lit(parts))).withColumn("g", every)
        group = F.pmod(F.xxhash64("a_ids"), F.lit(groups)).cast("int")
        copies = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
        right = blocks.withColumn("g", group).withColumn("p", copies)
        met = left.join(right.hint("merge"), ["g", "p"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[bytes, Windows] = {}
        name, chunk = None, None
        for batch in batches:

            def value(column: str, at: int, kind, batch=batch) -> np.ndarray:
                return np.frombuffer(batch.column(column)[at].as_py(), kind)

            for at in range(batch.num_rows):
                if batch.column("chunk")[at].as_py() != name:
                    name = batch.column("chunk")[at].as_py()
                    ids, width = value("ids", at, np.int64), batch.column("width")[at].as_py()
                    vectors = value("vectors", at, np.float64).reshape(len(ids), width)
                    chunk = Chunk(ids, value("labels", at, np.int64), vectors)
                key = batch.column("a_ids")[at].as_py()
                if key not in state:
                    ids = np.frombuffer(key, np.int64)
                    width, n = (batch.column(c)[at].as_py() for c in ("a_width", "n_windows"))
                    state[key] = Windows(
                        ids,
                        value("a_labels", at, np.int64),
                        value("a_vectors", at, np.float64).reshape(len(ids), width),
                        value("low", at, np.int64).reshape(len(ids), n),
                        value("high", at, np.int64).reshape(len(ids), n),
                        k,
                        same,
                    )
                state[key].meet(chunk)
        for found in state.values():
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.ids[found.anchor]), pa.array(found.row), pa.array(found.score)],
                names=["anchor", "row", "score"],
            )

    wanted = [c.split()[0] for c in f"{_CHUNKS}, {_BLOCKS}".split(", ")]
    return met.select(*wanted).mapInArrow(run, "anchor long, row long, score long")


def mine_hard_negatives(
    rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` come from ``integer_vectors``; the rows for which ``anchor`` is true are the queries,
    and all rows are searched.  A score is the integer inner product; missing dimensions count
    as 0, higher scores come first, ties by smaller id.  An anchor's positives are its first
    ``positives`` other rows of the same label, or all.  For each, the first ``negatives`` rows
    of another label, or all, with ``low * positive_score <= 100 * negative_score <= high *
    positive_score`` are returned; a positive without any is not.

    Rows repeated with an id are each a candidate; as an anchor the least of them counts, and
    rows with the anchor's own id are never its candidates.  A vector with a norm of 2**31 or
    more takes no part, for its scores may fit no long.  An empty table gives an empty result.
    """
    order = [F.desc("score"), "row"]
    few = rows.where(anchor).groupBy("id").agg(F.min(F.struct("label", "v")).alias("own"))
    few = checkpointed(few.select("id", "own.label", "own.v"))
    # One window without bounds; a norm is below 2**31, so no score reaches 2**62.
    bound = 2**62
    whole = {"low": F.array(F.lit(-bound)), "high": F.array(F.lit(bound))}
    first = F.row_number().over(Window.partitionBy("anchor").orderBy(*order))
    best = _met(rows, few.withColumns(whole), positives, same=True).withColumn("place", first)
    best = checkpointed(best.where(F.col("place") <= positives))

    def part(percent: int, more: int) -> Column:
        """So many percent of a score, rounded down, or up with ``more``; no product of 64 bits."""
        whole, rest = F.call_function("div", F.col("p"), F.lit(100)), F.pmod("p", F.lit(100))
        return whole * percent + F.call_function("div", rest * percent + more, F.lit(100))

    best = best.select("anchor", F.col("row").alias("positive"), F.col("score").alias("p")).distinct()
    # Below 0 no score can be in a window.
    best = best.where("p >= 0").withColumns({"least": part(low, 99), "most": part(high, 0)})
    # No more than ``positives`` to an anchor.
    spans = best.where("least <= most").groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("least", "most"))).alias("spans")
    )
    wanting = few.join(spans.withColumnRenamed("anchor", "id"), "id").select(
        "id", "label", "v", F.col("spans.least").alias("low"), F.col("spans.most").alias("high")
    )
    found = _met(rows, checkpointed(wanting), negatives, same=False)
    pairs = found.join(best, "anchor").where("score between least and most")
    rank = F.row_number().over(Window.partitionBy("anchor", "positive", "p").orderBy(*order))
    ranked = pairs.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return ranked.select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("row").alias("negative_id"),
        F.col("p").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
