import json
import math

import pytest
from brute import hybrid
from pyspark.sql import functions as F

from mnemolake.functions.stemmer import with_stems
from mnemolake.functions.text import stop_words
from mnemolake.operators import text_index
from mnemolake.operators.text_index import build_postings
from mnemolake.plans import search
from mnemolake.schemas import NO_RESULTS
from mnemolake.sources.tables import to_json_responses

DIMS4 = {"dim": 4}
QUERIES = [
    (1, "quick", [1.0, 0.0, 0.0, 0.0]),
    (2, "Quick BROWN", [0.0, 1.0, 0.0, 0.0]),
    (3, "brown dog", [0.3, 0.3, 0.3, 0.0]),
    (4, "absent", [1.0, 0.0, 0.0, 0.0]),
    (5, "   ", [1.0, 0.0, 0.0, 0.0]),
    (6, "the quick fox", [0.0, 0.0, 0.0, 0.0]),
]
SCHEMA = "qid int, query_text string, query_vector array<float>"


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame(QUERIES, SCHEMA)


@pytest.fixture(scope="module")
def rows(memory):
    return [
        {"id": r.id, "content": r.content, "vector": r.vector_4, "is_active": r.is_active, "target": r.target, "cat": r.category_id}
        for r in memory.collect()
    ]


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.qid, r.position)):
        out.setdefault(r.qid, []).append((r.id, r.text_rank, r.vector_sim, r.rank))
    return out


def same(got, want):
    want = {k: v for k, v in want.items() if v}
    assert got.keys() == want.keys()
    for k, rows in want.items():
        assert [r[0] for r in got[k]] == [r[0] for r in rows], k
        for g, w in zip(got[k], rows):
            assert g[1:] == pytest.approx(w[1:], abs=1e-7, nan_ok=True)


def test_hybrid_search_matches_definition(queries, memory, rows):
    got = results(search.hybrid_search(queries, memory, build_postings(memory), 4))
    same(got, {q: hybrid(rows, t, v) for q, t, v in QUERIES})
    assert got[2][0][0] == 4 and math.isnan(got[2][0][2])  # zero vector: NaN, and first


def test_batch_equals_single_queries(queries, memory):
    postings = build_postings(memory)
    batch = results(search.hybrid_search(queries, memory, postings, 4))
    for q in (1, 2, 6):
        assert str(results(search.hybrid_search(queries.where(F.col("qid") == q), memory, postings, 4))[q]) == str(batch[q])


def test_without_broadcast(queries, memory, rows, monkeypatch):
    monkeypatch.setattr("mnemolake.operators.staging.BROADCAST_BYTES", -1)
    monkeypatch.setattr("mnemolake.operators.text_index.BROADCAST_BYTES", -1)
    got = results(search.hybrid_search(queries, memory, build_postings(memory), 4))
    same(got, {q: hybrid(rows, t, v) for q, t, v in QUERIES})


def test_skip_zero(queries, memory, rows):
    got = results(search.hybrid_search(queries, memory, build_postings(memory), 4, skip_zero=True))
    same(got, {q: hybrid(rows, t, v, keep=lambda r: any(r["vector"])) for q, t, v in QUERIES})


def test_filters_weights_and_limits_per_query(spark, memory, categories, rows):
    v = [0.2, 0.9, 0.1, 0.0]
    data = [
        (1, "quick", v, "user", None, 10, None),
        (2, "quick", v, "", "workflow", 10, 0.0),
        (3, "quick", v, None, "no_such", 2, 1.0),
        (4, "quick", v, None, None, 0, None),
        (5, "quick brown", v, "memory", "fact", None, 7.0),
    ]
    q = spark.createDataFrame(data, SCHEMA + ", target string, category string, top_k int, text_weight double")
    got = results(search.hybrid_search(q, memory, build_postings(memory), 4, categories=categories))
    want = {
        1: hybrid(rows, "quick", v, keep=lambda r: r["target"] == "user"),
        2: hybrid(rows, "quick", v, weight=0.0, keep=lambda r: r["cat"] == 7),
        3: hybrid(rows, "quick", v, top_k=2, weight=1.0),
        4: [],
        5: hybrid(rows, "quick brown", v, weight=1.0, keep=lambda r: r["target"] == "memory" and r["cat"] == 8),
    }
    same(got, want)
    strict = results(search.hybrid_search(q, memory, build_postings(memory), 4, categories=categories, strict=True))
    assert 3 not in strict and 1 in strict


def test_english_matches_definition(spark, memory, rows):
    data = [(1, "jumping foxes", [1.0, 0.0, 0.0, 0.0]), (2, "the dogs", [0.0, 1.0, 0.0, 0.0]), (3, "the of a", [1.0, 0.0, 0.0, 0.0])]
    q = spark.createDataFrame(data, SCHEMA)
    words = {w for r in rows for w in r["content"].lower().split()} | {"jumping", "foxes", "dogs"}
    table = with_stems(spark.createDataFrame([(w,) for w in words], "token string"))
    stems = {r.token: r.lexeme for r in table.collect()}
    stops = set(stop_words())
    analyse = lambda w: None if w in stops else stems[w]
    got = results(search.hybrid_search(q, memory, build_postings(memory, "english"), 4, config="english"))
    same(got, {i: hybrid(rows, t, v, analyse=analyse) for i, t, v in data})
    assert [r[0] for r in got[2]] == [2, 1]


def test_window_is_four_times_top_k_at_least_forty(spark):
    n = 120
    data = [(i, "word " * (1 + i % 7), [1.0 - i / n, i / n], True, "t", 1) for i in range(n)]
    m = spark.createDataFrame(data, "id int, content string, vector_2 array<float>, is_active boolean, target string, category_id smallint")
    rows = [{"id": r[0], "content": r[1], "vector": r[2], "is_active": True} for r in data]
    q = spark.createDataFrame([(1, "word", [0.0, 1.0], 3), (2, "word", [0.0, 1.0], 20)], SCHEMA + ", top_k int")
    got = results(search.hybrid_search(q, m, build_postings(m), 2, fields=[]))
    same(got, {1: hybrid(rows, "word", [0.0, 1.0], 3), 2: hybrid(rows, "word", [0.0, 1.0], 20)})


def test_arguments_are_checked(queries, memory):
    with pytest.raises(ValueError):
        search.hybrid_search(queries, memory, build_postings(memory), 512)
    with pytest.raises(ValueError):
        search.recent(memory, limit=-1)


def test_recent(memory):
    assert [r.id for r in search.recent(memory).collect()] == [4, 7, 6, 3, 2, 1]
    assert [r.id for r in search.recent(memory, "user", 2).collect()] == [7, 6]
    got = {(r.target, r.position, r.id) for r in search.recent_per_target(memory, 2).collect()}
    assert got == {("memory", 1, 4), ("memory", 2, 3), ("user", 1, 7), ("user", 2, 6)}


def test_context_blocks(spark, memory):
    q = spark.createDataFrame([(1, "quick brown dog", [1.0, 0.0, 0.0, 0.0]), (2, "cat", [1.0, 0.0, 0.0, 0.0]), (3, "zebra quick", [1.0, 0.0, 0.0, 0.0])], SCHEMA)
    got = {r.qid: r.context for r in search.context_blocks(q, memory, build_postings(memory), 4, min_len=5).collect()}
    assert got == {
        1: "## Memory Context\n- [memory] [a, b] The quick brown fox jumps over the lazy dog\n- [user] [b] A quick brown dog and a quick cat"
    }


def test_json_responses(queries, memory):
    hits = search.hybrid_search(queries.where("qid in (1, 3, 4)"), memory, build_postings(memory), 4)
    got = {r.qid: json.loads(r.response) for r in to_json_responses(queries.where("qid in (1, 3, 4)"), hits, "position").collect()}
    assert got[4] == {"results": [], "message": NO_RESULTS}
    assert got[3]["count"] == len(got[3]["results"]) == 2
    first = got[3]["results"][0]
    assert set(first) == {"id", "target", "content", "created_at", "tags", "metadata", "text_rank", "vector_sim", "rank"}
    assert first["id"] == 2  # the words are adjacent there
    assert first["metadata"] == {"n": 2, "src": "y"} and first["created_at"] == "2024-01-01T00:02:00.000000"


def test_verification_search_orders_by_similarity(queries, memory):
    batch = search.prepare_queries(queries.where("qid = 1"))
    got = [(r.position, r.id) for r in search.verification_search(batch, memory, build_postings(memory), 4, 2).collect()]
    assert sorted(got) == [(1, 4), (2, 1)]


def test_window(spark, memory):
    from mnemolake.operators.text_index import build_postings
    from mnemolake.plans.search import hybrid_search

    q = spark.createDataFrame([("a", "quick", [0.0, 1.0, 0.0, 0.0])], "qid string, query_text string, query_vector array<float>")
    found = {w: hybrid_search(q, memory, build_postings(memory), 4, fields=[], window=w).count() for w in (1, None)}
    assert found == {1: 1, None: 4}


def test_equal_queries_are_searched_once(spark, memory, rows):
    q = spark.createDataFrame([(i, ("quick brown", "Brown QUICK")[i % 2], [1.0, float(i), 0.0, 0.0]) for i in range(30)], SCHEMA)
    batch = search.prepare_queries(q)
    searches, asked = text_index.distinct_searches(batch.terms, batch.queries.df.select("qid", "target", "top_k"), ["target"])
    assert (searches.rows, asked.rows) == (1, 30)
    got = results(search.hybrid_search(q, memory, build_postings(memory), 4))
    same(got, {i: hybrid(rows, "quick brown", [1.0, float(i), 0.0, 0.0]) for i in range(30)})


def test_any_blocks_of_searches_and_memories_agree(queries, memory, rows, monkeypatch):
    for name in ("BLOCK_POSITIONS", "LEAST_POSITIONS", "BLOCK_SEARCHES", "PAIRS_AT_A_TIME"):
        monkeypatch.setattr(text_index, name, 1)
    got = results(search.hybrid_search(queries, memory, build_postings(memory), 4))
    same(got, {q: hybrid(rows, t, v) for q, t, v in QUERIES})


def test_pairs_are_not_shuffled(spark):
    """Two words that every memory has: 400 queries and 400 memories, but only the best rows leave a task."""
    text = "alpha beta"
    m = spark.range(400).select(
        "id", F.lit(text).alias("content"), F.lit(True).alias("is_active"), F.lit("memory").alias("target"),
        F.lit(1).cast("smallint").alias("category_id"), F.array(F.lit(1.0).cast("float")).alias("vector_1"),
    )
    q = spark.range(400).select(F.col("id").alias("qid"), F.lit(text).alias("query_text"))
    batch = search.prepare_queries(q)
    hits = search._candidates(batch, m, build_postings(m), 1, False, 3)
    assert {(r.qid, r.id) for r in hits.collect()} == {(i, j) for i in range(400) for j in range(3)}
