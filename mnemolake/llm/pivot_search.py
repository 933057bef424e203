"""Exact search for the largest inner products, with bounds from a table of distances to pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.llm.common import Shared, named, stage

_SAFE = 1 << 62
_FOUND = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: every component x as floor(scale * x).

    Rows without an id, without a vector or with null, NaN or infinite components are left out, and so are empty
    vectors. Components beyond 64 bits become the nearest 64-bit integer.
    """
    v = F.col("_v")
    rows = vectors.select(named(id_col).cast("long").alias("vec_id"), named(vector_col).cast("array<double>").alias("_v"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & good).select("vec_id", whole.alias("v"))


def _matrices(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, ids and matrix of each vector length in a batch."""
    lengths = np.diff(vectors.offsets.to_numpy())
    ends, flat, own = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False), ids.to_numpy()
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        yield rows, own[rows], flat[ends[rows][:, None] + np.arange(d)]


def choose_pivots(vectors: DataFrame, pivots: int, sample: int, seed: int = 5) -> tuple[np.ndarray | None, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Pivots of the most frequent length, farthest first within a bounded sample, and the sample by length."""
    rows = vectors.orderBy(F.xxhash64("vec_id", "v", F.lit(seed)), "vec_id").limit(sample).collect()
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(len(r["v"]), []).append((r["vec_id"], r["v"]))
    samples = {d: (np.array([i for i, _ in x], np.int64), np.array([v for _, v in x], np.int64)) for d, x in by.items()}
    if not samples:
        return None, {}
    x = max(samples.values(), key=lambda s: len(s[0]))[1].astype(float)
    chosen, gap = [0], np.linalg.norm(x - x[0], axis=1)
    while len(chosen) < pivots and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, np.linalg.norm(x - x[chosen[-1]], axis=1))
    return x[chosen], samples


def pivot_table(vectors: DataFrame, pivots: np.ndarray | None) -> DataFrame:
    """``vec_id, v, to_pivots``: the vectors with their distances to all pivots, staged once for all queries."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, ids, x in _matrices(batch.column(0), batch.column(1)):
                far = _distances(x, pivots)
                offsets = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * x.shape[1])
                sizes = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * far.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.ListArray.from_arrays(offsets, pa.array(x.ravel())), pa.ListArray.from_arrays(sizes, pa.array(far.ravel()))],
                    names=["vec_id", "v", "to_pivots"],
                )

    return stage(vectors.mapInArrow(measure, "vec_id long, v array<long>, to_pivots array<double>")).df


def _distances(x: np.ndarray, pivots: np.ndarray | None) -> np.ndarray:
    if pivots is None or pivots.shape[1] != x.shape[1]:
        return np.zeros((len(x), 0))
    f = x.astype(float)
    return np.stack([np.linalg.norm(f - p, axis=1) for p in pivots], axis=1)


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in 64-bit integers; exact with Python integers, then clipped, where those could overflow."""
    if not len(x):
        return np.zeros(0, np.int64)
    if int(np.abs(x.astype(float)).max() * np.abs(q.astype(float)).max()) * len(q) < _SAFE:
        return x @ q
    exact = x.astype(object) @ q.astype(object)
    return np.array([max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in exact], np.int64)


def _limit(score) -> float:
    """A k-th score below which candidates end; a clipped one ends none."""
    return int(score) if score > -(1 << 63) else -np.inf


class Queries:
    """A block of queries of one length with their pivot distances and a first lower limit of the k-th score."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, pivots: np.ndarray | None, sample: tuple[np.ndarray, np.ndarray] | None, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.far = _distances(q, pivots)
        self.norm = (q.astype(float) ** 2).sum(axis=1)
        self.least = [-np.inf] * len(ids)
        if sample is not None:
            for r in range(len(ids)):
                scores = np.sort(_products(sample[1][sample[0] != ids[r]], q[r]))
                if len(scores) >= k:
                    self.least[r] = _limit(scores[-k])

    def search(self, ids: np.ndarray, x: np.ndarray, far: np.ndarray, best: dict[int, tuple[np.ndarray, np.ndarray]], step: int = 512) -> None:
        """Evaluate candidates in the order of their bounds until none can enter any more."""
        norm = (x.astype(float) ** 2).sum(axis=1)
        for r, own in enumerate(self.ids.tolist()):
            scores, found = best.get(r, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
            limit = max(self.least[r], _limit(scores[-1]) if len(scores) == self.k else -np.inf)
            total = self.norm[r] + norm
            lower = np.abs(far - self.far[r]).max(axis=1) if far.shape[1] else np.zeros(len(x))
            bound = (total - lower**2) / 2 + 1e-9 * total + 1  # rounding never hides a candidate
            near = np.flatnonzero((bound >= limit) & (ids != own))
            near = near[np.argsort(-bound[near], kind="stable")]
            for lo in range(0, len(near), step):
                if bound[near[lo]] < limit:
                    break
                some = near[lo : lo + step]
                scores = np.concatenate((scores, _products(x[some], self.q[r])))
                found = np.concatenate((found, ids[some]))
                top = np.lexsort((found, ~scores))[: self.k]
                scores, found = scores[top], found[top]
                if len(scores) == self.k:
                    limit = max(limit, _limit(scores[-1]))
            best[r] = (scores, found)


def top_products(
    vectors: DataFrame, queries, k: int = 10, scale: int = 1024, pivots: int = 32, sample: int = 2048, block: int = 8192,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` largest integer inner products of each query row with all other rows, ties to the smaller id.

    ``queries`` is a condition on ``vec_id``. The distance of every vector to ``pivots`` pivots is computed once
    and staged. For a query q and a vector x the largest gap between their distances to a pivot bounds |q - x| from
    below, hence the product (|q|^2 + |x|^2 - |q - x|^2) / 2 from above. Each task evaluates its candidates in the
    order of that bound and stops once no bound reaches the k-th score known; scores themselves are integers.

    Queries go to all tasks in blocks of ``block``, one block on the driver at a time; each task returns ``k`` rows
    a query at most, and the final order takes the limit in every task before its shuffle.

    One row per result: ``query_id, rank, vec_id, score``. Only vectors of the query's length are its candidates.
    Rows with the query's own id aren't. Several rows of one id are several candidates, but one query, that with
    the smallest vector. Null, empty or non-finite vectors and null ids take no part. Products beyond 64 bits are
    clipped. Fewer than ``k`` candidates are all returned.
    """
    whole = integer_vectors(vectors, scale, id_col, vector_col)
    chosen, samples = choose_pivots(whole, pivots, sample)
    table = pivot_table(whole, chosen)
    asked = stage(table.where(queries).groupBy("vec_id").agg(F.min("v").alias("v")))
    parts = []
    blocks = -(-asked.rows // block)
    for b in range(blocks):
        own = asked.df if blocks == 1 else asked.df.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        found = _search_block(table, own, chosen, samples, k)
        parts.append(found if blocks == 1 else stage(found).df)
    if not parts:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search_block(table: DataFrame, asked: DataFrame, pivots, samples: dict, k: int) -> DataFrame:
    by: dict[int, list] = {}
    for r in asked.toLocalIterator():
        by.setdefault(len(r["v"]), []).append((r["vec_id"], r["v"]))
    groups = {}
    for d, rows in by.items():
        ids, q = np.array([i for i, _ in rows], np.int64), np.array([v for _, v in rows], np.int64)
        groups[d] = Queries(ids, q, pivots, samples.get(d), k)
    shared = Shared(table.sparkSession, groups)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = shared.value
        best: dict[int, dict] = {d: {} for d in groups}
        for batch in batches:
            far_ends, far = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            for rows, ids, x in _matrices(batch.column(0), batch.column(1)):
                d = x.shape[1]
                if d in groups:
                    width = int(far_ends[rows[0] + 1] - far_ends[rows[0]])
                    groups[d].search(ids, x, far[far_ends[rows][:, None] + np.arange(width)], best[d])
        for d, found in best.items():
            for r, (scores, ids) in found.items():
                own = np.full(len(ids), groups[d].ids[r], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])

    return table.mapInArrow(search, _FOUND)
