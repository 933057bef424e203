"""Hard negatives by exact search in an inverted multi-index."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.llm.common import Shared, named, stage

#: Rows of a cell that stay together when cells are dealt to partitions.
CELL_ROWS = 4096
#: Bytes of anchors that go to every task at a time.
BLOCK_BYTES = 16 << 20
_EXACT = 1 << 53
_MOST, _LEAST = (1 << 63) - 1, -(1 << 63)
_ROWS = "vec_id long, label long, v array<long>, one int, two int"
_FOUND = "anchor_id long, place int, vec_id long, score long"


def integer_rows(vectors: DataFrame, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v``: components x as floor(scale * x); rows that take no part are left out."""
    v = F.col("_v")
    rows = vectors.select(
        named(id_col).cast("long").alias("vec_id"), named(label_col).cast("long").alias("label"), named(vector_col).cast("array<double>").alias("_v")
    )
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(v, lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    present = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
    return rows.where(present & good).select("vec_id", "label", whole.alias("v"))


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of integer rows as 64-bit integers; beyond these they are clipped."""
    if not len(x):
        return np.zeros(0, np.int64)
    if float(np.abs(x).max()) * float(np.abs(q).max()) * len(q) < _EXACT:
        return (x @ q).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in x]
    return np.array([max(_LEAST, min(_MOST, s)) for s in exact], np.int64)


@dataclass(frozen=True)
class Codebooks:
    """Centroids of the two halves of vectors of one length."""

    one: np.ndarray
    two: np.ndarray

    @property
    def dim(self) -> int:
        return self.one.shape[1] + self.two.shape[1]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.one.shape[1]], x[:, self.one.shape[1] :]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(_nearest(h, c) for h, c in zip(self.halves(x), (self.one, self.two), strict=True))


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(axis=1) - 2 * (x @ c.T)).argmin(axis=1)


def _centroids(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    c = np.unique(x, axis=0)
    c = c[rng.permutation(len(c))[:k]]
    for _ in range(rounds):
        at = _nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def fit_codebooks(rows: DataFrame, codewords: int, sample: int, rounds: int = 8, seed: int = 11) -> Codebooks | None:
    """Codebooks from at most ``sample`` rows of the most frequent length among them; any row may be in that sample."""
    drawn = rows.orderBy(F.xxhash64("vec_id", "v", F.lit(seed)), "vec_id").limit(sample).select("v").collect()
    by: dict[int, list] = {}
    for r in drawn:
        by.setdefault(len(r["v"]), []).append(r["v"])
    by.pop(1, None)
    if not by:
        return None
    x = np.array(max(by.values(), key=len), float)
    half, rng = x.shape[1] // 2, np.random.default_rng(seed)
    return Codebooks(*(_centroids(h, codewords, rounds, rng) for h in (x[:, :half], x[:, half:])))


def _matrices(b: pa.RecordBatch, at: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of each vector length in a batch."""
    column = b.column(at)
    ends, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(ends)
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[ends[rows][:, None] + np.arange(d)].astype(float)


def inverted_index(rows: DataFrame, books: Codebooks | None) -> DataFrame:
    """The rows with the codewords ``one, two`` of their halves, dealt by cell and staged in that order.

    A cell with many rows, copies of one vector included, is spread over as many parts as it needs, by row. Vectors
    of another length than the codebooks' have the cell (-1, -1).
    """

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one, two = np.full(b.num_rows, -1, np.int32), np.full(b.num_rows, -1, np.int32)
            for at, x in _matrices(b, 2):
                if books is not None and x.shape[1] == books.dim:
                    one[at], two[at] = books.nearest(x)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(one), pa.array(two)], names=["vec_id", "label", "v", "one", "two"])

    held = stage(rows.select("vec_id", "label", "v").mapInArrow(assign, _ROWS).withColumn("row", F.monotonically_increasing_id())).df
    counts = held.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n"))  # at most one row a cell
    parts = F.expr(f"(n + {CELL_ROWS - 1}) div {CELL_ROWS}")
    salted = held.join(F.broadcast(counts), ["one", "two"]).withColumn("part", F.pmod(F.xxhash64("row"), parts))
    dealt = salted.repartition("one", "two", "part").sortWithinPartitions("one", "two", "part")
    return stage(dealt.select("vec_id", "label", "v", "one", "two")).df


class Cells:
    """A batch of the index: rows by cell and label, and how far they lie from their centroids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, one: np.ndarray, two: np.ndarray, books: Codebooks | None):
        order = np.lexsort((ids, labels, two, one))
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        one, two = one[order], two[order]
        self.start = np.flatnonzero(np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1]))))
        self.end = np.append(self.start[1:], len(ids))
        self.books = books if books is not None and x.shape[1] == books.dim else None
        if self.books is None:
            return
        self.cell = np.full((len(books.one), len(books.two)), -1)
        self.cell[one[self.start], two[self.start]] = np.arange(len(self.start))
        own = books.one[one], books.two[two]
        gaps = [np.linalg.norm(h - c, axis=1) for h, c in zip(books.halves(self.x), own, strict=True)]
        self.radii = []
        for gap, code, book in zip(gaps, (one, two), (books.one, books.two), strict=True):
            far = np.full(len(book), -np.inf)
            np.maximum.at(far, code, gap)
            self.radii.append(far)

    def half_scores(self, q: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per half: codewords by the most their rows can add to a query's score, and these bounds, for all queries."""
        found = []
        for h, book, far in zip(self.books.halves(q), (self.books.one, self.books.two), self.radii, strict=True):
            reach = np.linalg.norm(h, axis=1)[:, None] * np.where(np.isfinite(far), far, 0)[None]
            bound = np.where(np.isfinite(far)[None], h @ book.T + reach, -np.inf)
            order = np.argsort(-bound, axis=1, kind="stable")
            found.append((order, np.take_along_axis(bound, order, axis=1)))
        return found

    def visits(self, halves: list[tuple[np.ndarray, np.ndarray]] | None, r: int) -> Iterator[tuple[float, int]]:
        """Cells of the batch with their bounds, largest first: a heap over the two ordered lists of codewords."""
        if halves is None:
            yield from ((np.inf, c) for c in range(len(self.start)))
            return
        (first, a), (second, b) = ((o[r].tolist(), s[r].tolist()) for o, s in halves)
        heap, last = [(-(a[0] + b[0]), 0, 0)], len(b) - 1
        while heap:
            bound, i, j = heapq.heappop(heap)
            if bound == np.inf:
                return
            c = self.cell[first[i], second[j]]
            if c >= 0:
                yield -bound, int(c)
            if j < last:
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))

    def rows(self, cell: int, label: int, same: bool) -> list[slice]:
        """Rows of a cell with the label, or with another one."""
        lo, hi = int(self.start[cell]), int(self.end[cell])
        a, z = (lo + int(np.searchsorted(self.labels[lo:hi], label, side)) for side in ("left", "right"))
        return [s for s in ([slice(a, z)] if same else [slice(lo, a), slice(z, hi)]) if s.stop > s.start]


@dataclass
class Wanted:
    """The best rows of one window of scores that an anchor has met so far."""

    low: int
    high: int
    k: int
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def limit(self) -> int:
        """No row below this score can enter any more."""
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.k else self.low

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        some = (scores <= self.high) & (scores >= self.limit)
        if some.any():
            ids, scores = np.concatenate((self.ids, ids[some])), np.concatenate((self.scores, scores[some]))
            top = np.lexsort((ids, ~scores))[: self.k]
            self.ids, self.scores = ids[top], scores[top]


@dataclass
class Anchors:
    """Anchors of one length, and the windows each of them asks for."""

    ids: np.ndarray
    labels: np.ndarray
    q: np.ndarray
    windows: list[list[tuple[int, int]]]

    def search(self, cells: Cells, best: dict[int, list[Wanted]], same: bool, k: int, step: int = 512) -> int:
        """Visit cells in the order of their bounds until every window is certain; the number of rows evaluated."""
        halves = cells.half_scores(self.q) if cells.books is not None else None
        slack = 1e-9 * (np.linalg.norm(self.q, axis=1) * float(np.linalg.norm(cells.x, axis=1).max(initial=0))) + 1
        done = 0
        for r, (own, label) in enumerate(zip(self.ids.tolist(), self.labels.tolist(), strict=True)):
            wanted = best.setdefault(r, [Wanted(lo, hi, k) for lo, hi in self.windows[r]])
            if not wanted:
                continue
            held, n, limit = [], 0, min(w.limit for w in wanted)
            for bound, cell in cells.visits(halves, r):
                if bound + slack[r] < limit:
                    break
                for s in cells.rows(cell, label, same):
                    held.append(s)
                    n += s.stop - s.start
                if n >= step:
                    done += self._offer(cells, held, r, own, wanted)
                    held, n, limit = [], 0, min(w.limit for w in wanted)
            done += self._offer(cells, held, r, own, wanted)
        return done

    def _offer(self, cells: Cells, held: list[slice], r: int, own: int, wanted: list[Wanted]) -> int:
        if not held:
            return 0
        at = np.concatenate([np.arange(s.start, s.stop) for s in held])
        at = at[cells.ids[at] != own]
        scores = products(cells.x[at], self.q[r])
        for w in wanted:
            w.offer(cells.ids[at], scores)
        return len(at)


def _search(index: DataFrame, anchors: DataFrame, blocks: int, books: Codebooks | None, same: bool, k: int) -> DataFrame:
    """``anchor_id, place, vec_id, score``: the best ``k`` rows of every window of ``anchors (vec_id, label, v, windows)``, and more."""
    spark, parts = index.sparkSession, []
    for b in range(blocks):
        own = anchors if blocks == 1 else anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        by: dict[int, list] = {}
        for a in own.toLocalIterator():
            by.setdefault(len(a["v"]), []).append(a)
        groups = {
            d: Anchors(
                np.array([a["vec_id"] for a in x], np.int64), np.array([a["label"] for a in x], np.int64),
                np.array([a["v"] for a in x], float), [[(w["low"], w["high"]) for w in a["windows"]] for a in x],
            )
            for d, x in by.items()
        }
        shared = Shared(spark, groups)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            groups = shared.value
            best: dict[int, dict[int, list[Wanted]]] = {d: {} for d in groups}
            for b in batches:
                ids, labels, one, two = (b.column(c).to_numpy() for c in (0, 1, 3, 4))
                for at, x in _matrices(b, 2):
                    d = x.shape[1]
                    if d in groups:
                        groups[d].search(Cells(ids[at], labels[at], x, one[at], two[at], books), best[d], same, k)
            for d, found in best.items():
                for r, windows in found.items():
                    for place, w in enumerate(windows, 1):
                        n = len(w.ids)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, groups[d].ids[r], np.int64)), pa.array(np.full(n, place, np.int32)),
                                pa.array(w.ids), pa.array(w.scores),
                            ],
                            names=["anchor_id", "place", "vec_id", "score"],
                        )

        found = index.mapInArrow(scan, _FOUND)
        parts.append(found if blocks == 1 else stage(found).df)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
    codewords: int = 16, sample: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of the same label, the ``negatives`` best of other labels in a window.

    ``anchors`` is a condition on ``vec_id``. Scores are integer inner products of vectors scaled by ``scale`` and
    floored; higher ones come first, ties by the smaller id. A negative's score lies between ``low`` and ``high``
    percent of the positive's, both included.

    Two codebooks, fitted on at most ``sample`` rows, cut all vectors into cells by the centroids of their halves. A
    half of a row differs from its centroid by a radius at most, which bounds what it adds to a score; the sum for
    both halves bounds a cell. Every task visits its cells from the largest bound down, with a heap over the two
    ordered lists of half bounds, and stops when no bound reaches what a window still needs, so results are exact.
    The first pass finds positives, the second one negatives for the windows that these set.

    Anchors go to all tasks in blocks of some 16 MB, one block on the driver at a time; a task keeps ``positives``
    or ``negatives`` rows a window, and the final order takes the limit in every task before its shuffle.

    One row per result: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``. Rows with a
    null id, label or vector, an empty vector or one with null or non-finite components take no part. Only vectors
    of the anchor's length are its candidates, and rows with its own id aren't. Several rows of one id are several
    candidates, but one anchor, that with the smallest label and vector; a positive found twice is asked for twice.
    Products beyond 64 bits are clipped. An empty table gives no rows.
    """
    rows = integer_rows(vectors, scale, id_col, vector_col, label_col)
    books = fit_codebooks(rows, codewords, sample)
    index = inverted_index(rows, books)
    every = F.array(F.struct(F.lit(_LEAST).cast("long").alias("low"), F.lit(_MOST).cast("long").alias("high"))).alias("windows")
    first = index.where(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a"))
    asked = stage(first.select("vec_id", "a.label", "a.v", every))
    if not asked.rows:
        return vectors.sparkSession.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    blocks = -(-asked.bytes // BLOCK_BYTES)
    found = _search(index, asked.df, blocks, books, True, positives)
    near = stage(found.select("anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))).df
    wide = F.col("positive_score").cast("decimal(20,0)")
    span = F.struct(
        "place", F.ceil(wide * low / 100).cast("long").alias("low"), F.floor(wide * high / 100).cast("long").alias("high")
    )
    windows = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(span)).alias("windows"))  # ``positives`` of them at most
    second = stage(asked.df.drop("windows").join(windows.withColumnRenamed("anchor_id", "vec_id"), "vec_id"))
    if not second.rows:
        second = asked
    far = _search(index, second.df, -(-second.bytes // BLOCK_BYTES), books, False, negatives)
    joined = far.join(near, ["anchor_id", "place"])
    return joined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
