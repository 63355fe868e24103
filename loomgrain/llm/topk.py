"""Exact top-k inner products by block-at-a-time pruning.

Vectors become integers (floor of scale times each component). They are put in an order in which neighbours are alike: a tree
of cuts along principal axes, fitted on a bounded sample (``sample_rows`` rows; it decides the order only, never the
result), gives each vector a leaf, and ranges of (leaf, id) become blocks. A block is stored as one row: its ids, its
forward index (the row-major matrix) and, per component ("term"), the largest and smallest value. For a query the sum over
terms of the best those extremes allow bounds every score of a block; blocks are visited by falling bound and each is
scored through its forward index until the bound is below the k-th score so far. A bound equal to it is still scored, for
ties go to the smaller id. Every query starts from the k-th score that it has in the sample, which no shard's own can be
below. Vectors without any structure give loose bounds, and then nearly all blocks are scored.

Queries and candidates meet in blocks: candidate shards and query groups of bounded bytes, each pair of them one task that
returns k rows a query; a window over those picks the final k. Equal rows are counted before they are dealt out, and at most
k of them are kept, as many as a result can show. Only the sample is broadcast and collected.

Defined results: a null id, a null vector, or one holding null, NaN or an infinity takes no part; vectors of
other lengths are padded with zeros; a query's own id is never its candidate; repeated candidate rows each
count; a query id that occurs several times is asked once, with its smallest vector; products beyond a long
saturate; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgrain.session import Scratch

_BLOCK = "shard int, width int, ids binary, matrix binary, tops binary, lows binary"
_EXACT = 2.0**53


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v array<long>) of the vectors that take part."""
    fine = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vec_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("id"), whole.alias("v")
    )


def _packer(rows: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        ids: list[int] = []
        vs: list[list[int]] = []

        def block(n: int) -> pa.RecordBatch:
            width = max(1, max(len(v) for v in vs[:n]))
            m = np.zeros((n, width), np.int64)
            for k, v in enumerate(vs[:n]):
                m[k, : len(v)] = v
            out = [shard, width, np.array(ids[:n], np.int64).tobytes(), m.tobytes(), m.max(0).tobytes(), m.min(0).tobytes()]
            del ids[:n], vs[:n]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip(out, kinds, strict=True)], names=["shard", "width", "ids", "matrix", "tops", "lows"]
            )

        for b in batches:
            ids += b.column(0).to_pylist()
            vs += b.column(1).to_pylist()
            while len(ids) >= rows:
                yield block(rows)
        if ids:
            yield block(len(ids))

    return pack


def _blocks(ints: DataFrame, tree: AxisTree, shards: int, rows: int) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaves = tree.leaves(_matrix(b.column(1).to_pylist(), tree.width))
            yield pa.RecordBatch.from_arrays([pa.array(leaves), *b.columns], names=["leaf", "id", "v"])

    placed = ints.mapInArrow(place, "leaf long, id long, v array<long>")
    ranged = placed.repartitionByRange(shards, "leaf", "id").sortWithinPartitions("leaf", "id")
    return ranged.select("id", "v").mapInArrow(_packer(rows), _BLOCK)


def _matrix(vs: list[list[int]], width: int, kind: type = np.float64) -> np.ndarray:
    m = np.zeros((len(vs), width), kind)
    for k, v in enumerate(vs):
        m[k, : len(v)] = v[:width]
    return m


class AxisTree:
    """Cuts along principal axes: each node halves its sample at the median of the longest axis."""

    def __init__(self, sample: np.ndarray, least: int = 8):
        self.width = sample.shape[1]
        self.axes: list[np.ndarray] = []
        self.cuts: list[float] = []
        self.next: list[list[int]] = []
        self.size = 0
        self.root = self._grow(sample.astype(np.float64), least)

    def _grow(self, x: np.ndarray, least: int) -> int:
        """The number of a node, or less than 0 for a leaf."""
        centred = x - x.mean(0) if len(x) else x
        if len(x) < 2 * least or not centred.any():
            self.size += 1
            return -self.size
        axis = np.ones(self.width)
        for _ in range(12):  # power steps; the axis need not be exact
            axis = centred.T @ (centred @ axis)
            axis /= np.linalg.norm(axis) or 1.0
        at = x @ axis
        cut = float(np.median(at))
        low = at < cut
        if not low.any() or low.all():
            self.size += 1
            return -self.size
        node = len(self.axes)
        self.axes.append(axis)
        self.cuts.append(cut)
        self.next.append([0, 0])
        self.next[node] = [self._grow(x[low], least), self._grow(x[~low], least)]
        return node

    def leaves(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        open_ = [(self.root, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            if node < 0 or not len(rows):
                out[rows] = -node
                continue
            low = x[rows] @ self.axes[node] < self.cuts[node]
            open_ += [(self.next[node][0], rows[low]), (self.next[node][1], rows[~low])]
        return out


def _padded(rows: pd.DataFrame, name: str, width: int) -> np.ndarray:
    parts = []
    for w, raw in zip(rows["width"], rows[name], strict=True):
        m = np.frombuffer(raw, np.int64).reshape(-1, w)
        parts.append(m if w == width else np.pad(m, ((0, 0), (0, width - w))))
    return np.concatenate(parts)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, exact in float64 where that can hold it, else by whole numbers, cut to a long's range."""
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1]
    if most < _EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    full = a.astype(object) @ b.astype(object).T
    return np.clip(full, -(2**63), 2**63 - 1)


def block_topk(
    qids: np.ndarray, q: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], tops: np.ndarray, lows: np.ndarray, k: int,
    floor: np.ndarray | None = None, scored: list[int] | None = None,
):
    """(row of q, id, score) of each query's k best over the blocks; blocks hold (ids, matrix).

    floor: for each query a score that k candidates reach anywhere; lower ones are left out. scored gains the pairs scored.
    """
    bound = _dot(np.maximum(q, 0), tops) + _dot(np.minimum(q, 0), lows)
    order = np.argsort(-bound, axis=1, kind="stable")
    kth = np.full(len(q), -np.inf, bound.dtype) if floor is None else floor.astype(bound.dtype)
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bound.dtype))
    active = np.arange(len(q))
    for r in range(len(blocks)):
        which = order[active, r]
        still = bound[active, which] >= kth[active]
        active, which = active[still], which[still]
        if not len(active):
            break
        found = [held]
        for b in np.unique(which):
            rows = active[which == b]
            ids, matrix = blocks[b]
            s = _dot(q[rows], matrix)
            if scored is not None:
                scored.append(s.size)
            own = ids[None, :] == qids[rows][:, None]
            if own.any():
                s = np.where(own, -np.inf, s)
            least = kth[rows]
            if s.shape[1] > k and s.dtype != object:
                least = np.maximum(least, np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k])
            i, j = np.nonzero((s >= least[:, None]) & ~own)
            found.append((rows[i], ids[j], s[i, j]))
        at, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        o = np.lexsort((ids, -scores, at))
        at, ids, scores = at[o], ids[o], scores[o]
        first = np.searchsorted(at, at, "left")
        keep = np.arange(len(at)) - first < k
        held = at, ids, scores = at[keep], ids[keep], scores[keep]
        full = (np.arange(len(at)) - np.searchsorted(at, at, "left")) == k - 1
        kth[at[full]] = np.maximum(kth[at[full]], scores[full])
    return held


def _sampled(ints: DataFrame, rows: int, most_bytes: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and matrix of a sample of bounded size, the same whatever the partitioning."""
    most = max(1, min(rows, most_bytes // (8 * max(1, width))))
    told = ints.orderBy(F.xxhash64("id", "v"), "id").limit(most).collect()
    return np.array([r.id for r in told], np.int64), _matrix([r.v for r in told], width, np.int64)


def _floors(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, matrix: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th score among the sample's rows other than its own."""
    if len(ids) < k:
        return np.full(len(q), -np.inf)
    s = _dot(q, matrix).astype(np.float64)
    s[ids[None, :] == qids[:, None]] = -np.inf
    kth = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
    # beyond 2**53 a float may have been rounded up
    return np.where(np.abs(kth) < _EXACT, kth, np.nextafter(kth, -np.inf))


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block_bytes: int = 64 << 10,
    shard_bytes: int = 64 << 20,
    group_bytes: int = 16 << 20,
    sample_rows: int = 4096,
) -> DataFrame:
    """query_id, rank (from 1), the candidate's id as ``vec_id`` and score: the k best candidates of every query."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    every = integer_vectors(vectors, id_col, vec_col, scale).groupBy("id", "v").agg(F.count(F.lit(1)).alias("n"))
    every = every.select("id", "v", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k).cast("long"))))).select("id", "v")
    every = scratch.save(every, "vectors")
    asked = integer_vectors(queries, id_col, vec_col, scale).groupBy("id").agg(F.min("v").alias("v"))
    asked = scratch.save(asked, "asked")
    size = every.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    wide = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width")).first()
    width = max(1, size.width, wide.width)
    # a query's bounds and the scores of one block take room too
    block_rows = max(8, block_bytes // (8 * width))
    shards = max(1, -(-size.n * 8 * width // shard_bytes), min(spark.sparkContext.defaultParallelism, -(-size.n // (4 * block_rows))))
    groups = max(1, -(-wide.n * 8 * max(width, -(-size.n // (shards * block_rows))) // group_bytes))
    sample = _sampled(every, sample_rows, 16 << 20, width)
    tree = AxisTree(sample[1])
    stored = scratch.save(_blocks(every, tree, shards, block_rows), "candidates")
    grouped = scratch.save(_blocks(asked, tree, groups, max(8, group_bytes // (64 * width))), "queries")
    shared = spark.sparkContext.broadcast(sample)
    scratch.keep_only(stored, grouped)

    def meet(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        blocks = [(np.frombuffer(i, np.int64), _padded(c.iloc[[b]], "matrix", width)) for b, i in enumerate(c["ids"])]
        tops, lows = _padded(c, "tops", width), _padded(c, "lows", width)
        parts = []
        for row in range(len(q)):  # stored query rows are small enough for their scores against the sample
            qids, m = np.frombuffer(q["ids"].iloc[row], np.int64), _padded(q.iloc[[row]], "matrix", width)
            at, ids, scores = block_topk(qids, m, blocks, tops, lows, k, _floors(qids, m, *shared.value, k))
            parts.append((qids[at], ids, scores.astype(np.int64)))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    left = stored.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = grouped.withColumnRenamed("shard", "part").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = (
        left.groupBy("shard", "part")
        .cogroup(right.groupBy("shard", "part"))
        .applyInPandas(meet, "query_id long, vec_id long, score long")
    )
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
