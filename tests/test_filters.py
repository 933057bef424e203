import pytest
from pyspark.sql import functions as F

from mnemolake.functions import scalars as X
from mnemolake.operators import filters as f
from mnemolake.operators import joins
from mnemolake.sources.tables import with_vector_state


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_active_target_category(memory, categories):
    assert ids(f.active(memory)) == [1, 2, 3, 4, 6, 7]
    assert ids(f.by_target(memory, "user")) == [2, 6, 7]
    assert ids(f.by_target(memory, "")) == ids(f.by_target(memory, None)) == ids(memory)
    assert ids(f.by_category(memory, categories, "workflow")) == [3]
    assert ids(f.by_category(memory, categories, "no such")) == ids(memory)
    assert ids(f.by_category(memory, categories, "no such", strict=True)) == []
    assert ids(f.by_category(memory, categories, None)) == ids(memory)


@pytest.mark.parametrize("stored", [False, True])
def test_vector_states(memory, stored):
    m = with_vector_state(memory) if stored else memory
    assert ids(f.has_vector(m, 4)) == [1, 2, 3, 4, 5, 7]
    assert ids(f.embedded(m, 4)) == [1, 2, 3, 5, 7]
    assert ids(f.needs_embedding(m, 4)) == [4, 6]
    assert ids(f.needs_embedding(m, 2)) == [4, 5, 6, 7]


def test_stored_state_saves_the_vector_scan(memory, tmp_path):
    path = str(tmp_path / "m")
    with_vector_state(memory).write.parquet(path)
    m = memory.sparkSession.read.parquet(path)
    plan = f.embedded(f.active(m), 4).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "vector_4" not in plan and "PushedFilters" in plan


def test_tags_metadata_expiry(memory, now):
    assert ids(f.with_tags(memory, ["a", "b"])) == [1]
    assert ids(f.with_tags(memory, ["b", "c"], "any")) == [1, 2, 4, 7]
    assert ids(f.with_tags(memory, [])) == ids(memory)
    with pytest.raises(ValueError):
        f.with_tags(memory, ["a"], "some")
    assert ids(f.with_metadata(memory, "$.n", 2, "int")) == [2]
    assert ids(f.with_metadata(memory, "$.src", "x")) == [1]
    assert ids(f.not_expired(memory, now)) == [1, 3, 4, 5, 6, 7]


def test_gate_and_validation(spark):
    q = spark.createDataFrame([(1, "  hi  "), (2, "\t\n "), (3, " hello there "), (4, None)], "qid int, query_text string")
    assert {tuple(r) for r in f.gate_queries(q).collect()} == {(1, "hi"), (3, "hello there")}
    assert {tuple(r) for r in f.gate_queries(q, 5, 8).collect()} == {(3, "hello th")}
    new = spark.createDataFrame(
        [(1, "x", "memory"), (2, " \n", "memory"), (3, "y", "t" * 21), (4, None, None), (5, "z", None)],
        "id int, content string, target string",
    )
    good, bad = f.validate_rows(new)
    assert ids(good) == [1, 5]
    assert {(r.id, r.reason) for r in bad.collect()} == {
        (2, "content is required"), (3, "target is too long"), (4, "content is required")
    }


def test_existing(spark, memory):
    assert ids(f.existing(memory, spark.createDataFrame([(1,), (99,)], "id long"))) == [1]


def test_category_joins(spark, memory, categories):
    new = spark.createDataFrame([(1, "workflow"), (2, "other"), (3, None)], "id int, category string")
    assert {(r.id, r.category_id) for r in joins.resolve_category(new, categories).collect()} == {(1, 7), (2, 8), (3, 8)}
    assert {(r.id, r.name) for r in joins.with_category_name(memory.where("id in (1, 3, 4)"), categories).collect()} == {
        (1, "fact"), (3, "workflow")
    }
    q = spark.createDataFrame([(1, "fact"), (2, "other"), (3, None)], "qid int, category string")
    assert {(r.qid, r.want_category) for r in joins.resolve_query_category(q, categories).collect()} == {(1, 8), (2, None), (3, None)}
    strict = joins.resolve_query_category(q, categories, strict=True).collect()
    assert {(r.qid, r.want_category) for r in strict} == {(1, 8), (2, -1), (3, None)}


def test_upsert_and_seed(spark):
    old = spark.createDataFrame([(1, "a", "b"), (2, "c", None)], "k int, x string, y string")
    new = spark.createDataFrame([(2, None, "d"), (3, "e", None)], "k int, x string, y string")
    assert {tuple(r) for r in joins.upsert(old, new, "k").collect()} == {(1, "a", "b"), (2, "c", "d"), (3, "e", None)}
    assert {tuple(r) for r in joins.seed(old, new, "k").collect()} == {(1, "a", "b"), (2, "c", None), (3, "e", None)}
    assert joins.seed(joins.seed(old, new, "k"), new, "k").count() == 3


def value(spark, column):
    return spark.sql("select 1").select(column).first()[0]


def test_scalars(spark):
    lit, v = F.lit, lambda c: value(spark, c)
    assert v(X.strip(lit("\t a b \n"))) == "a b"
    assert v(X.is_blank(lit("   \n"))) is True and v(X.is_blank(lit(None).cast("string"))) is True
    assert v(X.context_line(lit("user"), F.array(lit("a"), lit("b")), lit("xyz"), 2)) == "- [user] [a, b] xy"
    assert v(X.context_line(lit("user"), F.array().cast("array<string>"), lit("xyz"))) == "- [user] xyz"
    assert v(X.cache_key(4, "p", "m", lit("héllo"))) == __import__("hashlib").sha256("4|p|m|héllo".encode()).hexdigest()
    assert [v(X.json_int(lit(s))) for s in ("1024", '"768"', "nope", "{}")] == [1024, 768, None, None]
    assert v(X.score_or_zero(lit(None).cast("double"))) == 0.0
    assert [v(X.text_weight(lit(w).cast("double"))) for w in (-1, 0.3, 7, None)] == [0.0, 0.3, 1.0, 0.5]
    assert v(X.blend(lit(0.8), lit(0.7), lit(0.5))) == pytest.approx(0.75)
    assert v(X.blend(lit(0.5), lit(0.9), lit(0.5))) == pytest.approx(0.7)
    assert [v(X.cap(lit(n).cast("int"), 10, 50)) for n in (None, 3, 99)] == [10, 3, 50]
    assert v(X.percent(lit(0.12345))) == 12.3
    with pytest.raises(Exception, match="negative"):
        v(X.cap(lit(-1), 10, 50))


def test_json_merge_lets_given_entries_win_and_keeps_types(spark):
    merged = X.json_merge({"source": F.lit("fixed"), "action": F.lit("add")}, F.lit('{"action": "x", "n": 5, "o": {"p": [1]}}'))
    assert __import__("json").loads(value(spark, merged)) == {"source": "fixed", "action": "x", "n": 5, "o": {"p": [1]}}
    alone = X.json_merge({"source": F.lit("fixed")}, F.lit(None).cast("string"))
    assert __import__("json").loads(value(spark, alone)) == {"source": "fixed"}
