import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from mnemolake.llm.pivot_search import top_products
from mnemolake.llm.url_rules import host_and_path, judge_urls, longest_rule, mine_rules, rule_tokens

from . import brute

SF = "/root/testdata/sf0.001"


def test_top_products(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.normal(size=8)]) for k in range(300)]
    rows += [(300 + k, rows[0][1]) for k in range(40)]  # ties
    bad = [(900, None), (901, []), (902, [1.0, None] * 4), (903, [float("nan")] * 8), (904, [float("inf")] * 8), (None, rows[1][1]), (1000, [1.0, 2.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").repartition(5)
    rows = [(r.vec_id, list(r.embedding)) for r in df.where("vec_id < 900").collect()]
    got = top_products(df, F.col("vec_id") % 50 == 0, sample=50, pivots=6)
    want = brute.top(rows, [i for i, _ in rows if i % 50 == 0])
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)
    blocks = top_products(df, F.col("vec_id") % 50 == 0, sample=50, pivots=6, block=3)
    assert sorted(tuple(r) for r in blocks.select("query_id", "rank", "vec_id", "score").collect()) == sorted(want)
    assert top_products(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_huge_components(spark):
    rows = [(0, [1e30, -1.0]), (1, [1e30, 2.0]), (2, [-1e30, 1.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in top_products(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert [i for i, _ in got] == [1, 3, 2] and got[0][1] == (1 << 63) - 1 and got[2][1] == -(1 << 63)


URLS = [
    (1, "http://A.Example.com/en/x?q#f"), (2, "https://www.example.com/en/"), (3, "x.net/es/"), (4, None), (5, "ftp://net/fr/1"), (6, "http://notnet/fr/"),
    (7, "http://a.net/fr"), (8, "a://b://c.com/d"), (9, "http://h.com"), (10, "http://h.com?x=/"), (None, "http://q.net/es/\nz"), (2, "https://www.example.com/en/"),
]


def test_given_rules(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string")
    host, path = host_and_path(F.col("url"))
    text, verdict = longest_rule(F.col("h"), F.col("p"), [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")])
    got = Counter(tuple(r) for r in df.select("page_id", host.alias("h"), path.alias("p")).select("page_id", "h", "p", text, verdict).collect())
    assert got == Counter([
        (1, "a.example.com", "/en/x", "example.com/en/", "block"), (2, "www.example.com", "/en/", "www.example.com/en/", "allow"), (3, "", "", None, None),
        (4, "", "", None, None), (5, "net", "/fr/1", "net/fr/", "block"), (6, "notnet", "/fr/", None, None), (7, "a.net", "/fr", None, None),
        (8, "b:", "//c.com/d", None, None), (9, "h.com", "", None, None), (10, "h.com", "", None, None), (None, "q.net", "/es/\nz", "net/es/", "block"),
        (2, "www.example.com", "/en/", "www.example.com/en/", "allow"),
    ])
    out = judge_urls(df.withColumn("tokens", F.lit(1)).withColumn("verdict", F.lit("x")))
    assert out.count() == len(URLS) and out.where("verdict is null").count() == 0
    assert judge_urls(df.limit(0)).count() == 0


def test_mined_rules(spark):
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(400):
        t = {f"t{x}" for x in rng.integers(0, 8, 4)}
        rows.append((sorted(t), "block" if {"t1", "t2"} <= t or rng.random() < 0.05 else "allow"))
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    got = {tuple(r.tokens): r.confidence for r in mine_rules(df, 0.02, 0.7).collect()}
    want = {}
    sets = {()}
    for _ in range(4):
        sets |= {tuple(sorted({*s, f"t{k}"})) for s in sets for k in range(8)}
    base = np.mean([v == "block" for _, v in rows])
    for s in sets - {()}:
        n = [v for t, v in rows if set(s) <= set(t)]
        hit = sum(v == "block" for v in n)
        if hit >= 0.02 * len(rows) and n and hit / len(n) >= 0.7 and hit / len(n) > base:
            want[s] = hit / len(n)
    assert got == pytest.approx(want) and ("t1", "t2") in got


def test_mined_rules_do_not_repeat_the_given_ones(spark):
    urls = [f"http://h{k}.net/{p}/x" for k in range(20) for p in ("es", "fr", "en", "de")]
    urls += [f"http://h{k}.com/de/y" for k in range(20)] + [f"http://h{k}.example.com/en/y" for k in range(20)] + [f"http://h{k}.org/en/y" for k in range(20)]
    urls += [f"http://h{k}.net/{p}/spam" for k in range(20) for p in ("es", "it")]
    out = judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    got = Counter((r.host.split(".")[-1], r.path.split("/")[1], r.path.split("/")[2], r.verdict) for r in out.where("rule is null").collect())
    assert got == Counter({("net", "en", "x", "block"): 20, ("net", "de", "x", "block"): 20, ("org", "en", "y", "allow"): 20, ("net", "it", "spam", "block"): 20})
    clean = judge_urls(spark.createDataFrame([(k, u.removesuffix("/x")) for k, u in enumerate(urls) if "spam" not in u], "page_id long, url string"))
    assert clean.where("rule is null and verdict = 'block'").count() == 0
    assert rule_tokens([("block", "A-b.net", "/es/f")]) == (["host:a-b", "host:net", "name:a", "name:b", "name:net", "path:es", "tld:net"], ["path:f"])


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")
def test_pipeline_by_hand(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in cp.STAGES[:4]:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "near_duplicates":
            fps = [(r.doc_id, brute.fingerprint(r.text)) for r in before]
            assert set(after) == set(brute.components(fps).values())
        if name == "decontamination":
            assert set(after) == {r.doc_id for r in before if not brute.contamination(r.text, items)[4]}
        if name == "pii":
            assert set(after) == {r.doc_id for r in before} and not any(brute.base_spans(r.text) for r in after.values())
    packed = cp.STAGES[4][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == set(after)


def test_registered():
    names = [q for q in entry.queries() if q.startswith("op") or q == "pipeline"]
    assert len(names) == 14
