import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mnemolake.functions import vectors as V
from mnemolake.operators import knn


def one(spark, values, types, fn):
    return spark.createDataFrame([values], types).select(fn(*[F.col(c) for c in "ab"[: len(values)]])).first()[0]


TWO = "a array<float>, b array<float>"


def test_cosine(spark):
    assert one(spark, ([1.0, 2.0], [2.0, 4.0]), TWO, V.cosine) == pytest.approx(1.0)
    assert one(spark, ([1.0, 0.0], [0.0, 3.0]), TWO, V.cosine) == 0.0
    assert one(spark, ([1.0, 1.0], [-1.0, -1.0]), TWO, V.cosine) == pytest.approx(-1.0)
    assert math.isnan(one(spark, ([0.0, 0.0], [1.0, 1.0]), TWO, V.cosine))
    assert one(spark, (None, [1.0, 1.0]), TWO, V.cosine) is None


def test_zero_norm_width_and_parse(spark):
    row = spark.sql("select 1").select(
        V.zero_vector(3).alias("z"),
        V.is_zero(V.zero_vector(3)).alias("zero"),
        V.is_zero(F.array(F.lit(-0.0), F.lit(0.0))).alias("negative_zero"),
        V.is_zero(F.array().cast("array<float>")).alias("empty"),
        V.norm(F.array(F.lit(3.0), F.lit(4.0))).alias("norm"),
        V.parse_vector(F.lit("[1,2.5,3]")).alias("parsed"),
        V.parse_vector(F.lit("oops")).alias("bad"),
        V.check_width(F.lit(None).cast("array<float>"), 3).alias("none"),
    ).first()
    assert row.z == [0.0, 0.0, 0.0] and row.zero and row.negative_zero and row.empty
    assert row.norm == 5.0 and row.parsed == [1.0, 2.5, 3.0] and row.bad is None and row.none is False


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(120, 8)).round(3)
    x[20:60] = x[20]  # a third of all vectors are copies of one
    m = spark.createDataFrame(
        [(i, v.tolist(), i % 7 != 3) for i, v in enumerate(x)] + [(500, [0.0] * 8, True), (501, None, True)],
        "id long, vector_8 array<float>, is_active boolean",
    )
    y = np.vstack([rng.normal(size=(30, 8)).round(3), x[20:25]])
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(y)] + [(90, [0.0] * 8), (91, None)], "qid long, query_vector array<float>")
    keep = [i for i in range(len(x)) if i % 7 != 3]
    xs = x.astype("f4").astype("f8")
    ys = y.astype("f4").astype("f8")
    want = {}
    for j, v in enumerate(ys):
        scores = [(-round(float(v @ xs[i] / np.linalg.norm(v) / np.linalg.norm(xs[i])), 9), i) for i in keep]
        want[j] = [(i, -s) for s, i in sorted(scores)[:6]]
    return m, q, want


def as_dict(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.qid, -round(r.vector_sim, 9), r.id)):
        out.setdefault(r.qid, []).append((r.id, r.vector_sim))
    return out


def same(got, want):
    assert got.keys() == want.keys()
    for k in want:
        assert [i for i, _ in got[k]] == [i for i, _ in want[k]]
        assert [s for _, s in got[k]] == pytest.approx([s for _, s in want[k]], abs=1e-8)


def test_knn_exact(points):
    m, q, want = points
    same(as_dict(knn.knn_exact(q, m, 8, 6)), want)


def test_knn_exact_in_blocks(points, monkeypatch):
    m, q, want = points
    monkeypatch.setattr(knn, "QUERY_BLOCK", 10)
    monkeypatch.setattr(knn, "VECTOR_BLOCK", 25)
    same(as_dict(knn.knn_exact(q, m, 8, 6, broadcast_bytes=0)), want)


def test_knn_approx_is_exact_with_one_bit_and_many_bands(points, monkeypatch):
    m, q, want = points
    same(as_dict(knn.knn_approx(q, m, 8, 6, bands=40, bits=1)), want)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 5)
    monkeypatch.setattr(knn, "VECTOR_BLOCK", 9)
    same(as_dict(knn.knn_approx(q, m, 8, 6, bands=40, bits=1)), want)


def test_stored_index_gives_the_same_answer(spark, points, tmp_path):
    m, q, _ = points
    path = str(tmp_path / "index")
    knn.write_index(knn.signature_index(m, 8, 6, 4), path)
    stored_index = spark.read.parquet(path)
    stored = knn.knn_approx(q, m, 8, 6, 6, 4, index=stored_index)
    same(as_dict(stored), as_dict(knn.knn_approx(q, m, 8, 6, 6, 4)))
    one = q.where("qid = 0")
    want = as_dict(knn.knn_approx(one, m, 8, 6, 6, 4))
    asked = knn.signatures(one.select(F.col("query_vector").alias("v")), "v", 8, 6, 4).select(knn._part(F.col("_bucket")).alias("p"))
    needed = {f"part={r.p}" for r in asked.collect()}
    others = [f for f in (tmp_path / "index").glob("part=*/*.parquet") if f.parent.name not in needed]
    assert others
    for f in others:
        f.write_bytes(b"unreadable")
    same(as_dict(knn.knn_approx(one, m, 8, 6, 6, 4, index=stored_index)), want)
    with pytest.raises(TypeError):
        knn.knn_approx(q, m, 8, 6, index=stored_index)


def test_score_pieces(points, monkeypatch):
    m, q, want = points
    monkeypatch.setattr(knn, "SCORE_ROWS", 7)
    monkeypatch.setattr(knn, "SCORE_COLUMNS", 11)
    same(as_dict(knn.knn_exact(q, m, 8, 6)), want)


def test_knn_approx_scores_and_recall(points):
    m, q, _ = points
    exact = knn.knn_exact(q, m, 8, 6)
    approx = knn.knn_approx(q, m, 8, 6, bands=6, bits=4)
    everything = {(r.qid, r.id): r.vector_sim for r in knn.knn_exact(q, m, 8, 200).collect()}
    for r in approx.collect():
        assert r.vector_sim == pytest.approx(everything[(r.qid, r.id)], abs=1e-9)
    assert knn.recall(exact, exact).first().recall == 1.0
    assert 0.2 < knn.recall(approx, exact).first().recall <= 1.0


def test_knn_of_nothing(spark, points):
    m, q, _ = points
    assert knn.knn_exact(q.where("qid = 90"), m, 8, 3).count() == 0
    assert knn.knn_exact(q, m.where("id >= 500"), 8, 3).count() == 0
    assert knn.knn_approx(q, m.where("id >= 500"), 8, 3, bands=4, bits=1).count() == 0
    with pytest.raises(ValueError):
        knn.knn_approx(q, m, 8, 3, bands=4, bits=0)


def test_planes_are_balanced_and_fixed():
    a = knn.hyperplanes(64, 128)
    assert (a == knn.hyperplanes(64, 128)).all() and set(np.unique(a)) == {-1.0, 1.0}
    assert abs(a.mean()) < 0.05


def test_best_of_pieces_equals_sorting_all(monkeypatch):
    """Queries keep their best over any pieces; ties by the smaller id, and no query needs more than its k places."""
    monkeypatch.setattr(knn, "SCORE_ROWS", 3)
    monkeypatch.setattr(knn, "SCORE_COLUMNS", 4)
    rng = np.random.default_rng(5)
    unit = lambda n: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.integers(-2, 3, (n, 6)) + 0.25)
    q, v, ids = unit(8), unit(50), rng.permutation(50)
    for k in (1, 5, 60):
        best = knn._Best(len(q), k, ids)
        for at in range(0, 50, 7):
            best.add(q, ids[at : at + 7], v[at : at + 7])
        got = best.pairs(np.arange(len(q)))
        scores = np.round(q @ v.T, knn.SCORE_DIGITS)
        for i in range(len(q)):
            assert list(got[got.qid == i].id) == list(ids[np.lexsort((ids, -scores[i]))][:k])
