import os

import pytest
from pyspark.sql import functions as F

from mnemolake.functions.embedders import EmbedSpec
from mnemolake.operators.mutations import current_state
from mnemolake.schemas import category_seed
from mnemolake.streaming import rows as R

FOUR = EmbedSpec(4, "hashing", "m", dims=(4, 2))
OPS = ["add", "update", "embed", "forget", "update", "add"]


@pytest.fixture
def events(spark):
    data = [
        (i, (i % 6) if i % 13 else 0, OPS[i * 7 % 6], f"text {i}", 1_700_000_000 + i // 2, ["user_profile", None, "nonsense"][i % 3], ["user", None][i % 2],
         [f"t{i}"] if i % 2 else None, '{"n": %d}' % i if i % 3 else None)
        for i in range(60)
    ]
    df = spark.createDataFrame(data, "event_id long, memory_id long, op string, content string, s long, category string, target string, tags array<string>, metadata string")
    return df.withColumn("ts", F.timestamp_seconds("s")).drop("s")


def feed(spark, df, path, parts, key="event_id"):
    """A stream of one file per micro-batch, whose events come in no order of time."""
    for i in range(parts):
        df.where(F.abs(F.hash(key)) % parts == i).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def shown(df):
    columns = ["id", "category_id", "target", "content", "vector_4", "confidence", "is_active", "created_at", "updated_at", "tags", "metadata"]
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


def run(spark, df, categories, tmp_path, name, parts, base=None):
    out = str(tmp_path / name)
    stream = feed(spark, df, out + "-in", parts)
    R.stream_rows(stream, categories, FOUR, out, out + "-check", base=base, buckets=8).awaitTermination()
    return out


def test_batches_in_any_order_equal_one_batch_and_the_fold(spark, events, categories, tmp_path):
    many = run(spark, events.unionByName(events.where("event_id % 4 = 1")), categories, tmp_path, "many", 5)
    one = run(spark, events, categories, tmp_path, "one", 1)
    got = R.read_rows(spark, many)
    assert shown(got) == shown(R.read_rows(spark, one))
    assert len([d for d in os.listdir(many + "/rows") if d.startswith("batch=")]) > 1
    want = {r.id: r for r in current_state(events).collect()}
    seen = {r.id: r for r in got.collect()}
    assert seen.keys() == want.keys()
    first = {}
    for r in sorted(events.where("op = 'add'").collect(), key=lambda r: (r.ts, r.event_id)):
        first.setdefault(r.memory_id, r)
    ids = {r.name: r.id for r in categories.collect()}
    for i, r in seen.items():
        w, add = want[i], first[i]
        assert (r.content, r.vector_text, r.is_active, r.created_at, r.updated_at) == (w.content, w.vector_text, w.is_active, w.created_at, w.updated_at)
        assert (r.target, r.tags, r.metadata, r.confidence) == (add.target or "memory", add.tags or [], add.metadata or "{}", 80)
        assert r.category_id == ids.get(add.category, ids["fact"])


def test_vectors_are_those_of_the_newest_text(spark, events, categories, tmp_path):
    from mnemolake.operators.embedding import embed_column

    got = R.read_rows(spark, run(spark, events, categories, tmp_path, "v", 4))
    again = embed_column(got.select("id", "vector_text", "vector_4"), "vector_text", FOUR).collect()
    assert again and all(r.vector == r.vector_4 for r in again)


def test_base_and_tail_equal_the_whole(spark, events, categories, tmp_path):
    """The rows of the first half as a base, the second half as a stream over it."""
    whole = R.read_rows(spark, run(spark, events, categories, tmp_path, "whole", 3))
    early, late = events.where("event_id < 30"), events.where("event_id >= 30")
    base = R.read_rows(spark, run(spark, early, categories, tmp_path, "early", 2)).drop("vector_text")
    out = run(spark, late, categories, tmp_path, "late", 3, base)
    known = {r.id for r in base.collect()}
    assert shown(R.read_rows(spark, out, base).where(F.col("id").isin(list(known)))) == shown(whole.where(F.col("id").isin(list(known))))
    # A restart with the same checkpoint does not write the base again.
    stream = spark.readStream.schema(late.schema).option("maxFilesPerTrigger", 1).parquet(out + "-in")
    R.stream_rows(stream, categories, FOUR, out, out + "-check", base=base, buckets=8).awaitTermination()


def test_a_replayed_batch_changes_nothing(spark, events, categories, tmp_path):
    from mnemolake.operators.staging import stage
    from mnemolake.operators.stored import merge_stored

    path = str(tmp_path / "state")
    part = stage(R.event_states(events, categories))
    once = sorted(map(str, merge_stored(spark, path, part, R.fold, 4).collect()))
    twice = sorted(map(str, merge_stored(spark, path, part, R.fold, 4).collect()))
    assert once == twice and len(once) == part.rows


def test_soft_delete_keeps_the_vector_without_a_call(spark, categories, tmp_path):
    schema = "event_id long, memory_id long, op string, content string, ts timestamp"
    start = F.timestamp_seconds(F.lit(1_700_000_000)).alias("ts")
    add = spark.createDataFrame([(1, 5, "add", "some words"), (2, None, "add", "no id"), (3, 6, "walk", "unknown operation"), (4, 7, "update", "never added")], "event_id long, memory_id long, op string, content string").select("*", start)
    gone = spark.createDataFrame([(9, 5, "forget", None)], "event_id long, memory_id long, op string, content string").select("*", start)
    out, source = str(tmp_path / "out"), str(tmp_path / "in")
    for df in (add, gone):
        df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        R.stream_rows(stream, categories, FOUR, out, out + "-check", buckets=2).awaitTermination()
    (row,) = R.read_rows(spark, out).collect()
    assert row.id == 5 and not row.is_active and any(row.vector_4)
    log = spark.read.parquet(out + "/rows/batch=1").first()
    assert not log.new_text and log.vector_4 is None


def test_no_events(spark, events, categories, tmp_path):
    out = run(spark, events.where("op = 'none'").unionByName(events.where("event_id = 0")), categories, tmp_path, "few", 1)
    assert R.read_rows(spark, out).count() <= 1
    assert category_seed(spark).count() == categories.count()


def test_state_holds_only_ids_with_events(spark, events, categories, tmp_path):
    base = R.read_rows(spark, run(spark, events, categories, tmp_path, "first", 1)).drop("vector_text")
    one = base.orderBy("id").first().id
    out = run(spark, events.where(F.col("memory_id") == one), categories, tmp_path, "second", 1, base)
    assert base.count() > 1
    assert [r.id for r in spark.read.parquet(f"{out}/state").select("id").collect()] == [one]
