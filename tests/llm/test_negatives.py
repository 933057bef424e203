"""Hard negatives against a comparison of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mnemolake.llm import negatives as module
from mnemolake.llm.negatives import Anchors, Cells, Codebooks, Wanted, fit_codebooks, hard_negatives, integer_rows, products

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string, v int, one string, place string"


def brute(rows, every, k=5, m=3):
    usable = []
    for r in rows:
        e = r["embedding"]
        if r["vec_id"] is None or r["label"] is None or not e or any(x is None or not math.isfinite(x) for x in e):
            continue
        usable.append((r["vec_id"], r["label"], [max(-(1 << 63), min((1 << 63) - 1, math.floor(256 * float(x)))) for x in e]))
    out = []
    for a in sorted({r[0] for r in usable if r[0] % every == 0}):
        _, label, q = min((r for r in usable if r[0] == a), key=lambda r: (r[1], r[2]))
        clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
        seen = [(-clip(sum(x * y for x, y in zip(q, v, strict=True))), i, lab) for i, lab, v in usable if i != a and len(v) == len(q)]
        for ps, p, _ in sorted(s for s in seen if s[2] == label)[:k]:
            window = sorted(s for s in seen if s[2] != label and 50 * -ps <= 100 * -s[0] <= 95 * -ps)[:m]
            out += [(a, p, rank, n, -ps, -s) for rank, (s, n, _) in enumerate(window, 1)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", "s", 1, "o", "p") for r in rows], SCHEMA).repartition(4)


def got(df, every, **more):
    rows = hard_negatives(df, F.col("vec_id") % every == 0, **more).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in rows)


@pytest.mark.parametrize("codewords", [1, 8])
def test_all_pairs(spark, codewords):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=6) / 3).round(1).tolist(), int(rng.integers(0, 3))) for k in range(300)]
    rows += [(1000 + k, rows[8][1], k % 3) for k in range(60)]  # copies of one vector
    df = table(spark, rows)
    want = brute([r.asDict() for r in df.collect()], 4)
    assert len(want) > 100
    assert got(df, 4, codewords=codewords, sample=100) == want


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0], 1), (1, [1.0, 0.5, 0.0], 1), (2, [0.75, 0.0, 0.0], 2), (2, [0.5, 0.0, 0.0], 2), (2, [0.5, 0.0, 0.0], 2),
        (3, None, 1), (4, [1.0, None, 0.0], 1), (5, [nan, 0.0, 0.0], 1), (6, [inf, 0.0, 0.0], 2), (None, [1.0, 0.0, 0.0], 1), (7, [1.0, 0.0, 0.0], None),
        (8, [], 1), (9, [1.0, 1.0], 1), (10, [1.0, 1.0], 1), (12, [0.9, 0.9], 2), (0, [1.0, 0.0, 0.0], 2), (14, [1e30, 0.0, 0.0], 1), (16, [1e30, 1e30, 0.0], 2),
        (20, [0.0, 0.0, 0.0], 3), (21, [0.0, 0.0, 0.0], 3), (22, [-1.0], 1), (24, [1.0], 1), (-2, [1.0, 0.25, 0.0], 1), (1, [1.0, 0.5, 0.0], 1),
    ]
    df = table(spark, rows)
    assert got(df, 2) == brute([r.asDict() for r in df.collect()], 2)


def test_empty_table_and_no_anchor(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    assert got(table(spark, [(1, [1.0], 1), (3, [1.0], 2)]), 2) == []
    assert got(table(spark, [(2, [1.0], 1), (3, [0.9], 2)]), 2) == []  # no positive


def test_anchor_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    df = table(spark, [(k, rng.normal(size=4).round(1).tolist(), int(rng.integers(0, 2))) for k in range(80)])
    want = got(df, 2)
    monkeypatch.setattr(module, "BLOCK_BYTES", 1024)
    monkeypatch.setattr(module, "CELL_ROWS", 8)
    assert want and got(df, 2) == want


def test_cells_come_by_falling_bounds_that_hold():
    rng = np.random.default_rng(7)
    x = np.floor(256 * rng.normal(size=(400, 8)))
    books = Codebooks(x[:6, :4], x[:6, 4:])
    one, two = books.nearest(x)
    cells = Cells(np.arange(400), rng.integers(0, 3, 400), x, one.astype(np.int32), two.astype(np.int32), books)
    q = np.floor(256 * rng.normal(size=(5, 8)))
    halves = cells.half_scores(q)
    for r in range(5):
        seen = list(cells.visits(halves, r))
        bounds = [b for b, _ in seen]
        assert bounds == sorted(bounds, reverse=True) and sorted(c for _, c in seen) == list(range(len(cells.start)))
        for bound, c in seen:
            assert (cells.x[cells.start[c] : cells.end[c]] @ q[r]).max() <= bound + 1e-6


def test_search_leaves_out_cells_that_cannot_matter():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(12, 16))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    x = np.floor(256 * (centres[rng.integers(0, 12, 6000)] + 0.02 * rng.normal(size=(6000, 16))))
    books = Codebooks(np.floor(256 * centres[:, :8]), np.floor(256 * centres[:, 8:]))
    one, two = books.nearest(x)
    cells = Cells(np.arange(6000), np.zeros(6000, int), x, one.astype(np.int32), two.astype(np.int32), books)
    anchors = Anchors(np.arange(20), np.zeros(20, int), x[:20], [[(-(1 << 63), (1 << 63) - 1)]] * 20)
    best = {}
    done = anchors.search(cells, best, True, 5)
    assert done < 0.35 * 20 * 6000
    for r in range(20):
        scores = x @ x[r]
        own = scores[np.arange(6000) != r]
        assert best[r][0].scores.tolist() == sorted(own.astype(int).tolist(), reverse=True)[:5]


def test_codebooks_on_a_bounded_sample(spark):
    rows = integer_rows(table(spark, [(k, [float(k % 7), 1.0], 1) for k in range(50)]), 256, "vec_id", "embedding", "label")
    assert fit_codebooks(rows, 4, 10).one.shape[0] <= 4
    assert fit_codebooks(rows.where("false"), 4, 10) is None


def test_products_and_windows():
    big = np.array([[2.0**40, 1.0]])
    assert products(big, np.array([2.0**40, 1.0])).tolist() == [(1 << 63) - 1]
    w = Wanted(5, 20, 2)
    w.offer(np.array([9, 8, 7, 6]), np.array([21, 20, 4, 20]))
    w.offer(np.array([5]), np.array([20]))
    assert w.ids.tolist() == [5, 6] and w.scores.tolist() == [20, 20] and w.limit == 20
