import pytest
from pyspark.sql import functions as F

from mnemolake.operators import aggregates as A
from mnemolake.operators.text_index import build_postings
from mnemolake.plans import reports, search
from mnemolake.schemas import model_seed, settings_seed
from mnemolake.sources.tables import write_snapshot


def test_counts(memory, categories):
    assert A.count_memories(memory).first().n == 6
    assert A.count_memories(memory, "user").first().n == 3
    assert {tuple(r) for r in A.count_by_target(memory).collect()} == {("memory", 3), ("user", 3)}
    assert {tuple(r) for r in A.count_by_category(memory, categories).collect()} == {("fact", 3), ("workflow", 1), ("user_preference", 1)}
    assert {tuple(r) for r in A.count_by_dim(memory, (4, 2)).collect()} == {(4, 4), (2, 3)}
    row = A.coverage(memory, 4).first()
    assert (row.total, row.embedded, row.missing_ratio) == (6, 4, pytest.approx(1 / 3))
    assert A.coverage(memory.where("id < 0"), 4).first().missing_ratio == 0.0


def test_status_and_summary(spark, memory, categories):
    got = {(r.section, r.key): r.value for r in reports.status(memory, categories, model_seed(spark), settings_seed(spark), (4, 2), 4).collect()}
    assert got == {
        ("total_memories", ""): "6", ("by_category", "fact"): "3", ("by_category", "workflow"): "1",
        ("by_category", "user_preference"): "1", ("per_dim_embedded", "4"): "4", ("per_dim_embedded", "2"): "3",
        ("default_dim", ""): "4",
    }
    line = reports.summary(memory, settings_seed(spark)).first().summary
    assert line == "Active. 6 memories stored. Default embedding dim: 1024. Vector columns: 768, 1024, 1536."


def test_preflight(spark, memory, tmp_path):
    paths = {"memory": write_snapshot(memory, str(tmp_path), 1), "models": str(tmp_path / "models"), "settings": str(tmp_path / "nothing")}
    model_seed(spark).write.parquet(paths["models"])
    report = reports.preflight(spark, paths, (4, 2, 768))
    got = {r.name: (r.status, r.detail) for r in report.collect()}
    assert got["table memory"][0] == got["table models"][0] == "ok"
    assert got["table settings"][0] == got["table categories"][0] == "missing"
    assert got["column vector_4"][0] == "ok" and got["column vector_768"][0] == "missing"
    assert got["vectors 4"] == ("ok", "4 embedded") and got["registered dims"] == ("warning", "1 of 3")
    assert {r.status: r.n for r in reports.check_counts(report).collect()}["missing"] == 3
    settings_seed(spark).createOrReplaceTempView("my_settings")
    named = {r.name: r.detail for r in reports.preflight(spark, {"settings": "my_settings"}).collect()}
    assert named["default dim"] == "1024"


def probe(spark, text):
    q = spark.createDataFrame([(1, text, [0.0, 1.0, 0.0, 0.0])], "qid int, query_text string, query_vector array<float>")
    return search.prepare_queries(q)


def verdict(spark, m, text, **kw):
    row = reports.verify(m, 4, probe(spark, text), build_postings(m), **kw).first()
    return row.ok, row.failures


def test_verify(spark, memory):
    assert verdict(spark, memory, "quick") == (True, [])
    assert verdict(spark, memory, "absent") == (True, [])
    bare = memory.withColumn("vector_4", F.lit(None).cast("array<float>"))
    assert verdict(spark, bare, "quick") == (
        False, ["no active rows have usable vectors", "the probe found nothing and no rows are embedded"]
    )
    few = memory.withColumn("vector_4", F.when(F.col("id") == 1, F.col("vector_4")))
    assert verdict(spark, few, "quick") == (
        False, ["more than half of the active rows lack a vector", "no probe hit has a positive similarity"]
    )
    stats = spark.createDataFrame([(2, 3)], "errors long, zero_fallbacks long")
    assert verdict(spark, memory, "quick", stats=stats) == (
        False, ["the embedder fell back to zero vectors", "the embedder reports errors"]
    )
