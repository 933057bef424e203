"""The manifest against trees built by plain Python."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mnemolake.llm import merkle
from mnemolake.llm.merkle import FIELDS, Ranks, fold, fold_path, leaf_digest, manifest, pack_lows, proof_digest, reduce_nodes, slot_paths, unpack_lows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `tree` int, `pos` string, `row` string, `digest` string"


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def shown(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([H(now[k : k + 2]) for k in range(0, len(now), 2)])
    return levels


def siblings(levels, at):
    out = []
    for nodes in levels[:-1]:
        out += nodes[at ^ 1 : (at ^ 1) + 1]
        at //= 2
    return out


def brute(rows):
    """(doc_id, leaf, subroot, root, proof) of every row, sorted."""
    trees = {}
    for r in rows:
        leaf = H([shown(r[f]) for f in FIELDS])
        trees.setdefault(r["lang"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf))
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    levels = {k: up([x[2] for x in sorted(trees[k])]) for k in order}
    top = up([levels[k][-1][0] for k in order])
    out = []
    for n, k in enumerate(order):
        for at, (known, doc, leaf) in enumerate(sorted(trees[k])):
            proof = hashlib.sha256("".join(siblings(levels[k], at) + siblings(top, n)).encode()).hexdigest()
            out.append((doc if known else None, leaf, levels[k][-1][0], top[-1][0], proof))
    return sorted(out, key=str)


def got(docs):
    rows = manifest(docs).select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")), fold_path("leaf", "path").alias("f"))
    rows = [tuple(r) for r in rows.collect()]
    assert all(r[5] == r[3] for r in rows)
    return sorted((r[:5] for r in rows), key=str)


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(merkle, "SLOT_BITS", 2)
    monkeypatch.setattr(merkle, "SLOTS", 4)
    monkeypatch.setattr(merkle, "STEP_BITS", 3)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", "r", "d") for r in rows], SCHEMA).repartition(3)


def test_hard_rows(spark):
    rows = [
        (3, "a", "en", "s", 1), (-7, "", "en", None, 0), (None, "no id", "en", "s", 3), (None, "no id", "en", "s", 3), (None, None, None, None, None),
        (1 << 62, "é漢\U0001f642", "en", "s", 2), (-(1 << 63), "x", "", "s", 1), ((1 << 63) - 1, "long " * 50_000, "de", "s", (1 << 63) - 1),
        (5, "twice", "de", "s", 5), (5, "twice", "de", "s", 5), (5, "other", "de", "s", 5), (6, "one", "de", "s", 1), (512, "n", "é", "s", 1),
    ]
    docs = table(spark, rows)
    assert got(docs) == brute([r.asDict() for r in docs.collect()])


def test_many_levels_and_a_hot_id(spark, small):
    rows = [(k * 37 % 4001, f"t{k}", "en", "s", k) for k in range(300)] + [(77, f"hot{k % 40}", "en", "s", 1) for k in range(150)]
    rows += [(k, "x", f"l{k:03d}", "s", 1) for k in range(40)]
    docs = table(spark, rows)
    assert got(docs) == brute([r.asDict() for r in docs.collect()])


def test_empty_table_and_one_row(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = table(spark, [(1, "a", None, "s", 1)])
    (row,) = manifest(docs).collect()
    assert row.path == "" and row.leaf == row.subroot == row.root and row.position == 0 and row.group_value is None


def test_other_digest_stays_out_of_the_tree(spark):
    docs = table(spark, [(k, "a", "en", "s", k) for k in range(9)])
    more = leaf_digest([F.lit("changed")])
    rows = manifest(docs, other=F.when(F.col("doc_id") == 4, more)).withColumn("f", fold_path(F.coalesce("other", "leaf"), F.col("path"))).collect()
    assert len({r.root for r in rows}) == 1
    assert {r.doc_id for r in rows if r.f != r.root} == {4}


def test_bitmaps_and_ranks():
    rng = np.random.default_rng(2)
    for n in (1, 5, 31, 32, 200, 512):
        lows = np.sort(rng.choice(512, n, replace=False))
        counts = rng.integers(1, 4, n)
        bits, extra = pack_lows(lows, counts)
        assert len(bits) <= 64
        back = unpack_lows(bits, extra)
        assert (back[0] == lows).all() and (back[1] == counts).all()
        rank = Ranks(bits, extra)
        want = [int(counts[lows < x].sum()) for x in range(512)]
        assert rank(np.arange(512)).tolist() == want


def test_slot_paths_fold_to_the_top():
    for n in (1, 2, 3, 7, 8):
        nodes = [H([str(k)]).encode() for k in range(n)]
        levels = reduce_nodes(nodes, 4)
        assert len(levels) == 5
        assert {fold(leaf, path) for leaf, path in zip(nodes, slot_paths(levels, b""), strict=True)} == {levels[-1][0]}


def test_rows_to_tamper_with(spark):
    ids = spark.range(-50, 50).select("id", F.crc32(F.col("id").cast("string").cast("binary")).alias("c")).collect()
    assert all(r.c == zlib.crc32(str(r.id).encode()) for r in ids)
