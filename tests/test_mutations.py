import json

import pytest
from pyspark.sql import functions as F

from mnemolake.functions.embedders import EmbedSpec, register_embedder
from mnemolake.operators import mutations as M
from mnemolake.operators.embedding import embed_texts
from mnemolake.schemas import model_seed, settings_seed, vector_column
from mnemolake.sources import tables

DIMS = (4, 2)
FOUR = EmbedSpec(4, "hashing", "m", dims=DIMS)
TWO = EmbedSpec(2, "hashing", "m", dims=DIMS)


def table(df):
    return {r.id: r for r in df.collect()}


def vector(spark, text, spec=FOUR):
    return embed_texts(spark.createDataFrame([(text,)], "text string"), spec).df.first().vector


def test_add(spark, memory, categories, now):
    new = spark.createDataFrame(
        [(10, "fresh text", "workflow", None), (11, "other", "nonsense", "user"), (1, "taken id", "fact", None), (12, "  ", None, None)],
        "id long, content string, category string, target string",
    )
    got = table(M.add_memories(memory, new, categories, FOUR, now))
    assert set(got) == {1, 2, 3, 4, 5, 6, 7, 10, 11, 12}
    assert got[1].content.startswith("The quick")
    row = got[10]
    assert (row.category_id, row.target, row.confidence, row.is_active, row.tags, row.metadata) == (7, "memory", 80, True, [], "{}")
    assert row.vector_4 == vector(spark, "fresh text") and row.vector_2 is None and row.source_session is None
    assert str(row.created_at) == str(row.updated_at) == "2024-06-01 00:00:00"
    assert (got[11].category_id, got[11].target) == (8, "user") and got[12].vector_4 == [0.0] * 4
    with pytest.raises(ValueError):
        M.add_memories(memory, new, categories, EmbedSpec(768, "noop"), now)


def test_update_keeps_other_widths_and_edits_inactive_rows(spark, memory, now):
    edits = spark.createDataFrame([(1, "first", 1), (1, "second", 2), (5, "edited", 1), (99, "absent", 1)], "id long, content string, n int")
    got = table(M.update_memories(memory, edits, FOUR, now, ("n",)))
    assert len(got) == 7 and got[1].content == "second" and got[1].vector_4 == vector(spark, "second")
    assert got[1].vector_2 == [1.0, 0.0] and got[5].content == "edited" and not got[5].is_active
    assert str(got[1].updated_at) == "2024-06-01 00:00:00" and str(got[2].updated_at) == "2024-01-01 00:02:00"
    cleared = table(M.update_memories(memory, edits, FOUR, now, ("n",), clear_other_dims=True))
    assert cleared[1].vector_2 is None and cleared[2].vector_2 is not None
    assert {(r.id, r.applied) for r in M.applied(memory, edits.select("id").distinct()).collect()} == {(1, True), (5, True), (99, False)}


def test_forget(spark, memory, now):
    got = table(M.forget(memory, spark.createDataFrame([(1,), (5,), (99,), (1,)], "id long"), now))
    assert len(got) == 7 and not got[1].is_active and not got[5].is_active and got[2].is_active
    assert str(got[5].updated_at) == "2024-06-01 00:00:00"


def test_large_change_sets_do_not_broadcast(spark, memory, now, monkeypatch):
    ids = spark.createDataFrame([(1,), (5,)], "id long")
    want = table(M.forget(memory, ids, now))
    monkeypatch.setattr("mnemolake.operators.staging.BROADCAST_BYTES", -1)
    assert table(M.forget(memory, ids, now)) == want


def test_model_set(spark):
    schema = "dim smallint, provider string, model string, n int"
    models = model_seed(spark)
    change = spark.createDataFrame([(768, None, "x", 1), (768, "p", None, 2), (768, None, "y", 3), (1024, None, None, 1)], schema)
    got = {r.dim: r for r in M.model_set(models, change, ("n",)).collect()}
    assert (got[768].provider, got[768].model, got[768].api_key_env) == ("p", "y", "OLLAMA_API_KEY")
    assert (got[1024].provider, got[1024].model) == ("kimi", "bge_m3_embed")
    fewer = models.where("dim <> 1536")
    inserted = M.model_set(fewer, spark.createDataFrame([(1536, "q", None, 1)], schema), ("n",))
    row = inserted.where("dim = 1536").first()
    assert (row.provider, row.model, row.api_key_env) == ("q", "embo-01", "MINIMAX_API_KEY")
    assert M.model_set(fewer, spark.createDataFrame([(1536, None, None, 1)], schema), ("n",)).count() == 2


def test_default_dim_is_only_updated(spark):
    settings = settings_seed(spark)
    changed, applied = M.set_default_dim(settings, 768, (768, 1024))
    assert changed.first().value == "768" and applied.first().applied
    changed, applied = M.set_default_dim(settings.where("key = 'x'"), 768, (768, 1024))
    assert changed.count() == 0 and not applied.first().applied
    with pytest.raises(ValueError):
        M.set_default_dim(settings, 5, (768, 1024))
    with pytest.raises(ValueError):
        vector_column(512)


def test_mirror_writes(spark):
    events = spark.createDataFrame(
        [("1", "add", "user", "a", '{"n": 1}'), ("2", "replace", "memory", "b", None), ("3", "remove", "user", "c", None), ("4", "add", "user", "", None), ("5", "add", "user", None, None)],
        "id string, action string, target string, content string, metadata string",
    )
    got = table(M.mirror_writes(events))
    assert set(got) == {"1", "2"} and got["1"].category == "user_profile" and got["2"].category == "fact"
    assert got["1"].tags == ["mirrored", "builtin"]
    assert json.loads(got["1"].metadata) == {"source": "builtin_memory_tool", "action": "add", "n": 1}


def test_backfill(spark, memory, now):
    done = M.backfill(memory, [FOUR, TWO], now)
    got = table(done.memory)
    assert len(got) == 7 and got[6].vector_4 == vector(spark, got[6].content) and got[4].vector_4 == vector(spark, got[4].content)
    assert got[7].vector_2 == vector(spark, got[7].content, TWO) and got[7].vector_4 == [0.0, 0.0, 1.0, 0.0]
    assert got[5].vector_2 is None and str(got[5].updated_at) == "2024-01-01 00:05:00"
    assert {(r.dim, r.total, r.embedded) for r in done.stats.collect()} == {(4, 2, 2), (2, 3, 3)}
    again = M.backfill(done.memory, [FOUR, TWO], now)
    assert [r.total for r in again.stats.collect()] == [0, 0]
    assert table(again.memory) == got


def test_backfill_limit_takes_oldest_and_dry_run_changes_nothing(memory, now):
    done = M.backfill(memory, [TWO], now, limit=2)
    changed = {r.id for r in done.memory.collect() if str(r.updated_at) == "2024-06-01 00:00:00"}
    assert changed == {6, 7}  # oldest first, rows without a time last
    dry = M.backfill(memory, [FOUR, TWO], now, dry_run=True)
    assert {(r.dim, r.embedded) for r in dry.stats.collect()} == {(4, 2), (2, 3)}
    assert table(dry.memory) == table(memory)


def test_backfill_tells_failures_apart(memory, now):
    def factory(dim, model):
        def embed(texts):
            raise RuntimeError("down")

        return embed

    register_embedder("down", factory)
    done = M.backfill(memory, [EmbedSpec(4, "down", dims=DIMS)], now)
    row = done.stats.first()
    assert (row.embedded, row.zero_fallbacks, row.errors) == (2, 2, 0)
    assert table(done.memory)[6].vector_4 == [0.0] * 4 and done.fresh[4].count() == 0


def test_backfill_leaves_rows_that_fail(memory, now):
    """One pending text fails and one gets a vector that is too short; with a zero vector's row the others go on."""
    bad = memory.where("id = 6").first().content

    def factory(dim, model):
        def embed(texts):
            if bad in texts:
                raise RuntimeError("down")
            return [[1.0] * (3 if len(t) % 2 else dim) for t in texts]

        return embed

    register_embedder("partly down", factory)
    done = M.backfill(memory, [EmbedSpec(4, "partly down", dims=DIMS, keep_errors=True)], now)
    row, before, after = done.stats.first(), table(memory), table(done.memory)
    due = {r.id for r in M.pending(memory, 4).collect()}
    failed = {i for i in due if before[i].content == bad or len(before[i].content) % 2}
    assert 6 in failed and (row.total, row.embedded, row.errors, row.zero_fallbacks) == (len(due), len(due) - len(failed), len(failed), 0)
    for i in before:
        if i in due - failed:
            assert after[i].vector_4 == [1.0] * 4 and str(after[i].updated_at) == "2024-06-01 00:00:00"
        else:
            assert after[i] == before[i]


EVENTS = [
    # event, id, op, content, second
    (1, 1, "update", "early", 0), (2, 1, "add", "a", 1), (3, 1, "add", "again", 2), (4, 1, "update", "b", 3),
    (5, 1, "embed", "vec", 4), (6, 2, "add", "x", 1), (7, 2, "forget", "", 2), (8, 2, "update", "y", 3),
    (9, 3, "update", "never added", 1), (10, 4, "forget", "", 1), (11, 4, "add", "z", 2), (12, 7, "forget", "", 1),
    (13, 7, "add", "taken", 2), (14, 7, "update", "new", 3),
]


@pytest.fixture
def events(spark):
    df = spark.createDataFrame(EVENTS, "event_id long, memory_id long, op string, content string, s int")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s")


def state(df):
    return {r.id: (r.content, r.vector_text, r.is_active, r.created_at.second, r.updated_at.second) for r in df.collect()}


def test_current_state(events):
    want = {1: ("b", "vec", True, 1, 4), 2: ("y", "y", False, 1, 3), 4: ("z", "z", True, 2, 2), 7: ("new", "new", True, 2, 3)}
    assert state(M.current_state(events)) == want
    assert state(M.current_state(events.orderBy(F.desc("event_id")).repartition(3))) == want


def test_current_state_over_a_base(events, memory):
    base = memory.where("id = 7").withColumn("created_at", F.timestamp_seconds(F.lit(0))).withColumn("updated_at", F.timestamp_seconds(F.lit(0)))
    got = state(M.current_state(events, base))
    assert got[7] == ("new", "new", False, 0, 3)
    assert got[1] == ("b", "vec", True, 1, 4) and 3 not in got


def test_snapshots(spark, memory, now, tmp_path):
    root = str(tmp_path / "store")
    first = tables.write_snapshot(memory, root, 1)
    m = tables.scan_memory(spark, first, DIMS, memory.schema["id"].dataType)
    assert {r.id: (r.state_4, r.state_2) for r in m.collect()} == {
        1: (2, 2), 2: (2, 2), 3: (2, 2), 4: (1, 0), 5: (2, 0), 6: (0, 0), 7: (2, 0)
    }
    tables.write_snapshot(M.backfill(m, [FOUR], now).memory, root, 2)
    assert tables.snapshot_versions(spark, root) == [1, 2]
    latest = tables.scan_memory(spark, tables.latest_snapshot(spark, root), DIMS, memory.schema["id"].dataType)
    assert {r.id: r.state_4 for r in latest.collect()}[6] == 2
    with pytest.raises(Exception):
        tables.write_snapshot(memory, root, 2)
    assert tables.latest_snapshot(spark, str(tmp_path / "none")) is None
    tables.write_append(memory.where("id = 1").withColumn("id", F.lit(50).cast("long")), first)
    assert tables.scan_memory(spark, first, DIMS, memory.schema["id"].dataType).count() == 8


def test_registry_scans(spark, tmp_path):
    from mnemolake.schemas import category_seed

    for name, df in (("c", category_seed(spark)), ("m", model_seed(spark)), ("s", settings_seed(spark))):
        df.write.parquet(str(tmp_path / name))
    assert tables.scan_categories(spark, str(tmp_path / "c")).count() == 8
    assert [r.dim for r in tables.model_list(tables.scan_models(spark, str(tmp_path / "m"))).collect()] == [768, 1024, 1536]
    assert tables.read_setting(tables.scan_settings(spark, str(tmp_path / "s")), "default_dim").first().value == "1024"


def test_backfill_counts_read_no_text_again(spark, memory, now, tmp_path):
    """The texts are read to embed them; the counts of a backfill then need neither texts nor vectors."""
    memory.write.parquet(str(tmp_path / "m"))
    stats = M.backfill(spark.read.parquet(str(tmp_path / "m")), [FOUR, TWO], now).stats
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "content:" not in plan
    assert {r.dim: (r.total, r.embedded, r.errors) for r in stats.collect()}.keys() == {2, 4}
