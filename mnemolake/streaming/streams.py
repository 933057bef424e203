"""Streams of writes. Every sink writes one directory per micro-batch, so a replayed batch replaces itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.embedders import EmbedSpec
from ..operators.embedding import ERROR, attach_embedding, embed_texts
from ..operators.filters import needs_embedding
from ..operators.mutations import current_state, mirror_writes, prepare_memories
from ..operators.staging import prunable, stage
from ..sources.tables import with_vector_state


#: Columns that only name directories of a written batch.
_PLACES = ("event_day", "key_bucket")


def _batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch={batch_id}"


def _start(stream: DataFrame, write, checkpoint: str, available_now: bool, **trigger) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.trigger(**trigger).start()


def dedup_events(events: DataFrame, key: str = "event_id", delay: str | None = None, time: str = "ts") -> DataFrame:
    """Drop repeated events; no distinct event is lost, however late it comes.

    The state holds every key seen. With ``delay`` the state older than that is freed, at the price that events
    behind the watermark are dropped, repeated or not.
    """
    if delay is None:
        return events.dropDuplicates([key])
    if isinstance(events.schema[time].dataType, T.TimestampNTZType):
        events = events.withColumn(time, F.col(time).cast("timestamp"))
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def _other_batches(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame | None:
    """Rows that other micro-batches have written, if there are any; directory names are read as ``schema`` says."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch=*")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob)
    if not any(s.getPath().getName() != f"batch={batch_id}" for s in found or []):
        return None
    rows = spark.read.schema(schema.add("batch", T.LongType())).option("basePath", path).parquet(f"{path.rstrip('/')}/batch=*")
    return rows.where(F.col("batch") != batch_id)


def _key_bucket(key: str, buckets: int) -> Column:
    return F.format_string("k%d", F.pmod(F.xxhash64(key), F.lit(buckets)))


def _unseen(batch: DataFrame, path: str, batch_id: int, key: str, places: dict[str, Column]) -> DataFrame:
    """Rows of a batch, one per key and place, that no other micro-batch has written; with the columns ``places``.

    ``places`` are text columns that follow from a row and name the directories it is written to. Of earlier output only
    the keys in the directories that this batch falls into are read, so the cost follows the batch, not the stream's age.
    """
    rows = batch.withColumns(places).dropDuplicates([key, *places])
    names = list(places)
    schema = T.StructType([rows.schema[key], *[T.StructField(n, T.StringType()) for n in names]])
    earlier = _other_batches(batch.sparkSession, path, batch_id, schema)
    if earlier is None:
        return rows
    touched = stage(rows.select(names).distinct())
    side = touched.df
    for name in names:
        side = prunable(side, name)
    log = earlier.join(F.broadcast(side) if touched.small else side, names, "left_semi")
    known = log.select(*[F.col(c).alias(f"_seen_{c}") for c in (key, *names)])
    same = F.col(key).eqNullSafe(F.col(f"_seen_{key}"))
    for n in names:
        same = same & (F.col(n) == F.col(f"_seen_{n}"))
    return rows.join(known, same, "left_anti")


def _write_placed(rows: DataFrame, path: str, batch_id: int, names: list[str]) -> None:
    writer = rows.hint("rebalance", *names).write.mode("overwrite").partitionBy(*names)
    writer.parquet(_batch_path(path, batch_id))


def stream_distinct(
    events: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "event_id",
    time: str = "ts",
    buckets: int = 16,
    available_now: bool = True,
    **trigger,
) -> StreamingQuery:
    """Write every event once, however late it or its repetition comes, without state in memory.

    The written log is the state. It lies in directories by day of the event and by a hash of the key, and a
    micro-batch reads the keys of its own directories only. A repeated event has the key and the time of the first one;
    a key that comes again on another day is another event. Events of one day without a key count as one.
    ``read_log`` gives the events.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        day = F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit("none"))
        places = {"event_day": day, "key_bucket": _key_bucket(key, buckets)}
        _write_placed(_unseen(batch, path, batch_id, key, places), path, batch_id, list(places))

    return _start(events, write, checkpoint, available_now, **trigger)


def stream_mirror(
    events: DataFrame,
    empty: DataFrame,
    categories: DataFrame,
    embed: EmbedSpec,
    now: Column,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    buckets: int = 16,
    **trigger,
) -> StreamingQuery:
    """Mirror events to memory rows.

    Row ids come with the events and each micro-batch owns its directory, so the at-least-once
    delivery of ``foreachBatch`` leaves no duplicates. An id that comes again, in the same batch or a
    later one, is not written again; of earlier output only the ids in this batch's directories are read.
    ``empty`` gives the memory layout.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        places = {"key_bucket": _key_bucket("id", buckets)}
        fresh = _unseen(batch, path, batch_id, "id", places).drop(*places)
        rows = prepare_memories(empty, mirror_writes(fresh), categories, embed, now)
        _write_placed(with_vector_state(rows).withColumns(places), path, batch_id, list(places))

    return _start(events, write, checkpoint, available_now, **trigger)


def stream_mutations(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = True, **trigger
) -> StreamingQuery:
    """Collect add, edit, embed and forget events ``(memory_id, op, content, ts, event_id)`` in a log.

    The state of a large table is not rewritten per micro-batch. ``read_state`` folds the log over a
    snapshot whenever it is asked for, and ``write_snapshot`` compacts both now and then.
    """
    ops = events.where(F.col("op").isin("add", "update", "embed", "forget"))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.select("memory_id", "op", "content", "ts", "event_id").write.mode("overwrite").parquet(
            _batch_path(path, batch_id)
        )

    return _start(ops, write, checkpoint, available_now, **trigger)


def read_log(spark, path: str, after: int = -1) -> DataFrame:
    """All committed batches of a stream's directory, or only those after a compacted one."""
    log = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/batch=*")
    return log.where(F.col("batch") > after).drop("batch", *_PLACES)


def read_state(spark, path: str, base: DataFrame | None = None, after: int = -1) -> DataFrame:
    """Current state: the mutation log folded over a base table; independent of batch borders.

    ``after`` is the last batch that ``base`` already contains.
    """
    return current_state(read_log(spark, path, after), base)


def stream_backfill(
    rows: DataFrame,
    embed: EmbedSpec,
    now: Column,
    path: str,
    checkpoint: str,
    cache: DataFrame | None = None,
    available_now: bool = True,
    **trigger,
) -> StreamingQuery:
    """Embed arriving rows ``(id, content)`` that lack a vector; writes ``(id, vector, status, updated_at)``.

    Rows that bring a real vector of this width are left alone; missing, empty and all-zero ones are renewed. With ``keep_errors`` texts that fail are not written.

    The written rows are changes by id for ``apply_by_id``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if f"vector_{embed.dim}" in batch.columns:
            batch = needs_embedding(batch, embed.dim)
        vectors = embed_texts(batch.select(F.col("content").alias("text")), embed, cache)
        joined = attach_embedding(batch.select("id", "content"), "content", embed, vectors)
        out = joined.where(F.col("status") != ERROR).select("id", F.col("vector").alias(f"vector_{embed.dim}"), "status", now.alias("updated_at"))
        out.write.mode("overwrite").parquet(_batch_path(path, batch_id))

    return _start(rows, write, checkpoint, available_now, **trigger)
