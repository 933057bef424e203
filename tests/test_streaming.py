import pytest
from pyspark.sql import functions as F

from mnemolake.functions.embedders import EmbedSpec
from mnemolake.operators.mutations import apply_by_id, current_state, mirror_writes
from mnemolake.operators.staging import stage
from mnemolake.streaming import streams as S

FOUR = EmbedSpec(4, "hashing", "m", dims=(4, 2))


@pytest.fixture
def feed(spark, tmp_path):
    """Write frames as separate files and read them as a stream of one file per micro-batch."""

    def make(df, parts, key):
        path = str(tmp_path / "in")
        for i in range(parts):
            df.where(F.abs(F.hash(key)) % parts == i).coalesce(1).write.mode("append").parquet(path)
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)

    return make


def ordered(df):
    return sorted(str(r) for r in df.collect())


@pytest.fixture
def events(spark):
    rows = [(i, i % 5, ["add", "update", "embed", "forget", "update", "add"][i * 7 % 6], f"c{i}", 1_700_000_000 + i // 2) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, memory_id long, op string, content string, s long")
    return df.select("memory_id", "op", "content", F.timestamp_seconds("s").alias("ts"), "event_id")


def test_mutation_stream_equals_batch(spark, events, feed, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    S.stream_mutations(feed(events, 4, "event_id"), out, check).awaitTermination()
    assert S.read_log(spark, out).count() == 40
    assert ordered(S.read_state(spark, out)) == ordered(current_state(events))
    # A restart finds nothing new.
    again = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    S.stream_mutations(again, out, check).awaitTermination()
    assert S.read_log(spark, out).count() == 40


def test_state_after_compaction(spark, events, feed, tmp_path):
    out = str(tmp_path / "out")
    S.stream_mutations(feed(events, 4, "event_id"), out, str(tmp_path / "check")).awaitTermination()
    whole = S.read_log(spark, out).count()
    tail = S.read_log(spark, out, after=1).count()
    assert 0 < tail < whole


def test_mirror_stream(spark, memory, categories, now, feed, tmp_path):
    rows = [(str(i), ["add", "replace", "noop"][i % 3], ["user", "memory"][i % 2], f"text {i % 4}", None) for i in range(20)]
    df = spark.createDataFrame(rows, "id string, action string, target string, content string, metadata string")
    layout = memory.withColumn("id", F.col("id").cast("string")).limit(0)
    out = str(tmp_path / "out")
    S.stream_mirror(feed(df, 3, "id"), layout, categories, FOUR, now, out, str(tmp_path / "check")).awaitTermination()
    got = S.read_log(spark, out)
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in mirror_writes(df).collect())
    row = got.where("id = '0'").first()
    assert (row.category_id, row.target, row.tags, row.state_4, row.state_2) == (2, "user", ["mirrored", "builtin"], 2, 0)


def test_backfill_stream_gives_changes_by_id(spark, memory, now, feed, tmp_path):
    rows = memory.where("vector_4 is null").select("id", "content")
    out = str(tmp_path / "out")
    S.stream_backfill(feed(rows, 2, "id"), FOUR, now, out, str(tmp_path / "check")).awaitTermination()
    changes = S.read_log(spark, out)
    done = apply_by_id(memory, stage(changes.drop("status")))
    assert done.where("vector_4 is null").count() == 0 and done.count() == 7


def test_dedup(spark, events, feed, tmp_path):
    doubled = events.unionByName(events)
    out = str(tmp_path / "out")
    unique = S.dedup_events(feed(doubled, 3, "op"), delay="1 hour")
    q = unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check"))
    q.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(out).count() == 40


def test_late_and_repeated_events(spark, feed, tmp_path):
    rows = [(i, 1_700_000_000 - 100_000 * (i % 5)) for i in range(12)] * 2
    df = spark.createDataFrame(rows, "event_id long, s long").select("event_id", F.timestamp_seconds("s").alias("ts"))
    out = str(tmp_path / "out")
    unique = S.dedup_events(feed(df, 3, "event_id"))
    writer = unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "check"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == list(range(12))


def _distinct(spark, df, source, out):
    df.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    S.stream_distinct(stream, out, out + "-check", buckets=4).awaitTermination()


def test_distinct_events_over_batches_late_and_repeated(spark, tmp_path):
    day, start = 86_400, 1_700_000_000
    rows = [(i, start - day * (i % 5), f"x{i}") for i in range(30)] + [(None, start, "no key"), (None, start, "no key"), (99, None, "no time")]
    df = spark.createDataFrame(rows, "event_id long, s long, note string").select("event_id", F.timestamp_seconds("s").alias("ts"), "note")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (df.where("event_id < 20"), df.where("event_id >= 10 or event_id is null"), df, df.unionByName(df)):
        _distinct(spark, part, source, out)
    got = S.read_log(spark, out)
    assert got.columns == df.columns
    seen = sorted((r.event_id if r.event_id is not None else -1, r.note) for r in got.collect())
    assert seen == sorted([(i, f"x{i}") for i in range(30)] + [(-1, "no key"), (99, "no time")])


def test_distinct_reads_only_the_days_of_its_batch(spark, tmp_path):
    day, start = 86_400, 1_700_000_000
    df = spark.range(40).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(start) - F.lit(day) * (F.col("id") % 4)).alias("ts"))
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    _distinct(spark, df, source, out)
    days = {f"event_day={r.d}" for r in df.where("event_id % 4 = 2").select(F.date_format("ts", "yyyy-MM-dd").alias("d")).distinct().collect()}
    files = [f for f in (tmp_path / "out").glob("batch=0/*/*/*.parquet")]
    kept = sorted(f for f in files if f.parent.parent.name in days)
    others = [f for f in files if f.parent.parent.name not in days]
    assert kept and others
    for f in others:
        f.write_bytes(b"unreadable")
    _distinct(spark, df.where("event_id % 4 = 2").unionByName(df.where("event_id = 2").withColumn("event_id", F.lit(77).cast("long"))), source, out)
    assert [r.event_id for r in spark.read.parquet(f"{out}/batch=1").collect()] == [77]


def test_mirror_skips_ids_of_earlier_batches(spark, memory, categories, now, tmp_path):
    layout = memory.withColumn("id", F.col("id").cast("string")).limit(0)
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "id string, action string, target string, content string, metadata string"
    for _ in range(2):
        df = spark.createDataFrame([("a", "add", "user", "one", None), ("a", "add", "user", "one", None)], schema)
        df.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        S.stream_mirror(stream, layout, categories, FOUR, now, out, str(tmp_path / "check")).awaitTermination()
    assert [r.id for r in S.read_log(spark, out).collect()] == ["a"]
