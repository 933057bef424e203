"""Nearest neighbours by cosine: exact, and approximate through hyperplane signatures.

No plan here joins every query with every vector and none sends pairs through a shuffle. Tasks hold
one block of queries and one block of vectors, multiply them, and emit the best k per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .filters import active, vector_state
from .staging import BROADCAST_BYTES, Staged, prunable, stage, top_per_query

# Rows of one group: what a task holds in memory at a time.
QUERY_BLOCK = 16384
VECTOR_BLOCK = 16384
# Rows and columns of one score matrix.
SCORE_ROWS, SCORE_COLUMNS = 512, 2048
INDEX_PARTS = 256
BUCKET_ROWS = 4096
SCORE_DIGITS = 9


def _unit(vectors) -> np.ndarray:
    x = np.empty((len(vectors), len(vectors.iloc[0])))
    for i, v in enumerate(vectors):
        x[i] = v
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x


class _Best:
    """The k best ids of every query seen so far, in arrays of fixed size; ties go to the smaller id."""

    def __init__(self, n: int, k: int, ids: np.ndarray):
        self.k = k
        self.rounded, self.scores = np.full((n, k), -np.inf), np.zeros((n, k))
        self.ids = np.zeros((n, k), ids.dtype) if ids.dtype != object else np.full((n, k), None, object)

    def add(self, q: np.ndarray, ids: np.ndarray, v: np.ndarray) -> None:
        """Score all queries with some vectors, piece by piece; only scores that reach a query's last place are looked at."""
        if not self.k:
            return
        # Single precision finds what may reach the last place, double precision scores it. Rows have length 1.
        slack = (q.shape[1] + 8) * 2.0**-23 + 2 * 10.0**-SCORE_DIGITS
        q4, v4 = q.astype("f4"), v.astype("f4")
        for at in range(0, len(q), SCORE_ROWS):
            part = slice(at, at + SCORE_ROWS)
            for start in range(0, len(v), SCORE_COLUMNS):
                scores = q4[part] @ v4[start : start + SCORE_COLUMNS].T
                floor = self.rounded[part, -1] - slack
                if scores.shape[1] > self.k and not np.isfinite(floor).all():
                    kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k]
                    floor = np.maximum(floor, kth - 2 * slack)
                rows, cols = np.nonzero(scores >= floor[:, None].astype("f4"))
                if len(rows):
                    exact = np.einsum("ij,ij->i", q[at + rows], v[start + cols])
                    self._merge(at, rows, ids[start + cols], np.clip(exact, -1.0, 1.0))

    def _merge(self, at: int, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        changed = np.unique(rows)
        held = np.isfinite(self.rounded[at + changed])
        owner = np.concatenate((np.repeat(changed, held.sum(axis=1)), rows))
        ids = np.concatenate((self.ids[at + changed][held], ids))
        scores = np.concatenate((self.scores[at + changed][held], scores))
        rounded = np.round(scores, SCORE_DIGITS)
        order = np.lexsort((ids, -rounded, owner))
        owner = owner[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        order, owner, place = (x[place < self.k] for x in (order, owner, place))
        self.rounded[at + owner, place], self.scores[at + owner, place], self.ids[at + owner, place] = rounded[order], scores[order], ids[order]

    def part(self, start: int, end: int) -> _Best:
        """The same of some of the queries."""
        out = _Best(0, self.k, self.ids)
        out.rounded, out.scores, out.ids = self.rounded[start:end], self.scores[start:end], self.ids[start:end]
        return out

    def pairs(self, qids: np.ndarray) -> pd.DataFrame:
        rows, cols = np.nonzero(np.isfinite(self.rounded))
        return pd.DataFrame({"qid": qids[rows], "id": self.ids[rows, cols], "vector_sim": self.scores[rows, cols]})


def _pairs(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, v: np.ndarray, k: int) -> pd.DataFrame:
    """Best k per query of one block pair."""
    best = _Best(len(q), k, ids)
    best.add(q, ids, v)
    return best.pairs(qids)


def searchable(m: DataFrame, dim: int, only_active: bool = True) -> DataFrame:
    """Ids and vectors that have a direction: NULL and zero vectors have no nearest neighbours."""
    rows = active(m) if only_active else m
    return rows.where(vector_state(rows, dim) == 2).select("id", F.col(f"vector_{dim}").alias("v"))


def _queries(q: DataFrame) -> DataFrame:
    usable = F.col("query_vector").isNotNull() & F.exists("query_vector", lambda x: x != 0)
    return q.where(usable).select("qid", F.col("query_vector").alias("qv"))


def _pair_schema(q: DataFrame, v: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("qid", q.schema["qid"].dataType),
            T.StructField("id", v.schema["id"].dataType),
            T.StructField("vector_sim", T.DoubleType()),
        ]
    )


def _order() -> list[Column]:
    return [F.round("vector_sim", SCORE_DIGITS).desc(), F.col("id")]


def knn_exact(q: DataFrame, m: DataFrame, dim: int, k: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The k most similar memories per query: ``(qid, id, vector_sim)``.

    A query batch measured below ``broadcast_bytes`` travels to every task, and the vectors are
    scanned once without a shuffle. A larger batch is cut into blocks that meet blocks of vectors.
    Both ways are exact; only k rows per query and task reach the final ranking.
    """
    queries = stage(_queries(q))
    vectors = searchable(m, dim)
    schema = _pair_schema(queries.df, vectors)
    if queries.bytes <= broadcast_bytes:
        pairs = _scan_topk(queries, vectors, k, schema)
    else:
        q_blocks = -(-queries.rows // QUERY_BLOCK)
        v_blocks = max(-(-vectors.count() // VECTOR_BLOCK), 1)
        bucket = F.lit(0).cast("long").alias("_bucket")
        pairs = _block_topk(
            queries.df.select("*", bucket), vectors.select("*", bucket), F.lit(q_blocks), F.lit(v_blocks), 1, k, schema
        )
    return top_per_query(pairs, _order(), k)


def _scan_topk(queries: Staged, vectors: DataFrame, k: int, schema: T.StructType) -> DataFrame:
    rows = queries.df.toPandas()
    if rows.empty:
        return vectors.sparkSession.createDataFrame([], schema)
    shared = vectors.sparkSession.sparkContext.broadcast((rows.qid.to_numpy(), _unit(rows.qv)))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qids, matrix = shared.value
        best: _Best | None = None
        for batch in batches:
            if batch.empty:
                continue
            ids = batch.id.to_numpy()
            best = _Best(len(qids), k, ids) if best is None else best
            best.add(matrix, ids, _unit(batch.v))
        for at in range(0, len(qids) if best else 0, QUERY_BLOCK):
            yield best.part(at, at + QUERY_BLOCK).pairs(qids[at : at + QUERY_BLOCK])

    return vectors.mapInPandas(scan, schema)


def _block_topk(q: DataFrame, v: DataFrame, q_blocks: Column, v_blocks: Column, packs: int, k: int, schema: T.StructType) -> DataFrame:
    """Best k per query inside equal ``_bucket`` values.

    Both sides of a bucket are cut into blocks of bounded size by a hash of the id, and every query
    block meets every vector block of its bucket. A bucket that holds a third of all rows thus
    becomes many groups. Buckets of a single block are packed, several to a group.
    """
    split = (q_blocks > 1) | (v_blocks > 1)
    pack = F.when(split, -F.col("_bucket") - 1).otherwise(F.pmod(F.xxhash64("_bucket"), F.lit(packs)))

    def places(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))

    def place(id_col: str, n: Column) -> Column:
        return F.pmod(F.xxhash64(id_col), n).cast("int")

    left = q.withColumn("_pack", pack).withColumn("_qb", place("qid", q_blocks)).withColumn("_vb", places(v_blocks))
    right = v.withColumn("_pack", pack).withColumn("_vb", place("id", v_blocks)).withColumn("_qb", places(q_blocks))
    key = ["_pack", "_qb", "_vb"]

    def block(qs: pd.DataFrame, vs: pd.DataFrame) -> pd.DataFrame:
        parts = [pd.DataFrame({"qid": qs.qid[:0], "id": vs.id[:0], "vector_sim": np.empty(0)})]
        if not qs.empty and not vs.empty:
            qx, vx = _unit(qs.qv), _unit(vs.v)
            qids, ids = qs.qid.to_numpy(), vs.id.to_numpy()
            members = vs.groupby("_bucket").indices
            for bucket, rows in qs.groupby("_bucket").indices.items():
                if bucket in members:
                    cols = members[bucket]
                    parts.append(_pairs(qids[rows], qx[rows], ids[cols], vx[cols], k))
        return pd.concat(parts, ignore_index=True)

    grouped = left.select(*key, "_bucket", "qid", "qv").groupBy(*key).cogroup(
        right.select(*key, "_bucket", "id", "v").groupBy(*key)
    )
    return grouped.applyInPandas(block, schema)


def hyperplanes(dim: int, planes: int, seed: int = 7) -> np.ndarray:
    """Deterministic +1/-1 normals, one row per plane, from a multiplicative integer hash."""
    p = np.arange(planes, dtype=np.int64)[:, None]
    d = np.arange(dim, dtype=np.int64)[None, :]
    x = (p * 7919 + d * 104729 + seed * 1299709 + 12345) % 2147483647
    for _ in range(3):
        x = (x * 48271 + 11) % 2147483647
        x = (x ^ (x >> 13)) % 2147483647
    return np.where((x >> 7) % 2 == 1, 1.0, -1.0)


def signatures(df: DataFrame, vector: str, dim: int, bands: int, bits: int, seed: int = 7) -> DataFrame:
    """One row per vector and band with ``_bucket``, the band's number and its sign bits (Charikar 2002)."""

    @F.pandas_udf("array<long>")
    def sign_bits(batch: pd.Series) -> pd.Series:
        normals = hyperplanes(dim, bands * bits, seed)
        above = (np.stack([np.asarray(v, dtype="f8") for v in batch]) @ normals.T) > 0
        weights = 1 << np.arange(bits, dtype=np.int64)
        codes = above.reshape(len(batch), bands, bits) @ weights + (np.arange(bands, dtype=np.int64) << bits)
        return pd.Series(list(codes))

    return df.withColumn("_bucket", F.explode(F.array_distinct(sign_bits(F.col(vector)))))


def signature_index(m: DataFrame, dim: int, bands: int, bits: int, seed: int = 7) -> DataFrame:
    """Signature buckets of all searchable vectors: ``(_bucket, part, id, v)``.

    Recall depends on ``bands`` and ``bits`` alone, never on the number of vectors. ``part`` is the directory that
    ``write_index`` puts a bucket in.
    """
    vectors = searchable(m, dim)
    if not 1 <= bits <= 40 or bands < 1:
        raise ValueError("bands must be positive and bits within 1..40")
    index = signatures(vectors, "v", dim, bands, bits, seed)
    return index.select("_bucket", _part(F.col("_bucket")).alias("part"), "id", "v")


def _part(bucket: Column) -> Column:
    return F.pmod(F.xxhash64(bucket), F.lit(INDEX_PARTS)).cast("int")


def write_index(index: DataFrame, path: str) -> None:
    """Persist an index, sorted by bucket; the hint lets AQE split a directory that grows too large."""
    placed = index.hint("rebalance", "part").sortWithinPartitions("part", "_bucket")
    placed.write.partitionBy("part").parquet(path)


def knn_approx(
    q: DataFrame,
    m: DataFrame,
    dim: int,
    k: int,
    bands: int,
    bits: int,
    seed: int = 7,
    index: DataFrame | None = None,
) -> DataFrame:
    """Approximate neighbours: memories that share a signature band, re-ranked by exact cosine.

    Scores are exact; a neighbour that shares no band is missed. More bands raise recall, more bits
    shrink buckets. ``index`` is a stored ``signature_index`` made with the same bands, bits and
    seed: then only the directories and buckets that the queries fall into are read. Bucket sizes
    are counted before any vector moves, so that an overfull bucket is split into blocks.
    """
    if index is None:
        index = signature_index(m, dim, bands, bits, seed)
    left = signatures(_queries(q), "qv", dim, bands, bits, seed)
    schema = _pair_schema(left, index)
    asked = stage(left.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_cq")))
    near = asked.df.withColumn("part", _part(F.col("_bucket")))
    near = F.broadcast(prunable(near, "part")) if asked.small else near
    counted = index.select("_bucket", "part").join(near, ["part", "_bucket"]).groupBy("_bucket", "part", "_cq")
    sizes = stage(
        counted.agg(F.count(F.lit(1)).alias("_cv")), total=F.coalesce(F.sum(F.greatest("_cq", "_cv")), F.lit(0))
    )
    counts = sizes.df.select(
        "_bucket", "part",
        F.ceil(F.col("_cq") / QUERY_BLOCK).alias("_nq"), F.ceil(F.col("_cv") / VECTOR_BLOCK).alias("_nv"),
    )
    side = F.broadcast(prunable(counts, "part")) if sizes.small else counts
    packs = -(-sizes.seen["total"] // BUCKET_ROWS) or 1
    pairs = _block_topk(
        left.join(side.drop("part"), "_bucket"), index.join(side, ["part", "_bucket"]).drop("part"),
        F.col("_nq"), F.col("_nv"), packs, k, schema,
    )
    best = pairs.groupBy("qid", "id").agg(F.max("vector_sim").alias("vector_sim"))
    return top_per_query(best, _order(), k)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that the approximate result holds, as one row."""
    found = exact.select("qid", "id").join(
        approximate.select("qid", "id").withColumn("_hit", F.lit(1)), ["qid", "id"], "left"
    )
    hits = F.count("_hit")
    total = F.count(F.lit(1))
    return found.agg(F.when(total == 0, 0.0).otherwise(hits / F.nullif(total, F.lit(0))).alias("recall"))
