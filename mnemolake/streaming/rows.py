"""A stream of adds, edits and soft deletes as whole memory rows, with bounded state.

Each micro-batch is folded by id before anything is shuffled, then merged with the state of its ids, one row per id in
directories by a hash of the id; other directories are not read. The fold takes minima and maxima, so neither arrival
order, repeated events nor a replayed batch matter, and an id with very many events is one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.embedders import EmbedSpec
from ..functions.scalars import default_confidence, default_metadata, default_tags, default_target
from ..operators.embedding import ERROR, attach_embedding, embed_texts
from ..operators.joins import resolve_category
from ..operators.staging import stage
from ..operators.stored import BUCKETS, merge_stored
from ..schemas import vector_column, vector_dims
from ..sources.tables import state_columns
from .streams import _batch_path, _start

#: What an add may bring besides its content.
_GIVEN = {"target": "string", "tags": "array<string>", "metadata": "string", "confidence": "smallint", "expires_at": "timestamp", "source_session": "string"}
_EDIT = "struct<ts:timestamp,event_id:{id},content:string>"
_OPS = ("add", "update", "embed", "forget")


def _state_schema(id_type: str, event_type: str) -> T.StructType:
    edit = _EDIT.replace("{id}", event_type)
    given = ",".join(f"{c}:{t}" for c, t in _GIVEN.items())
    add = f"struct<ts:timestamp,event_id:{event_type},content:string,created_at:timestamp,updated_at:timestamp,is_active:boolean,category_id:smallint,{given}>"
    return T._parse_datatype_string(f"id {id_type}, add {add}, update {edit}, embed {edit}, forget {edit}")


def fold(rows: DataFrame) -> DataFrame:
    """One state per id: its first add and its last event of every other kind."""
    newest = [F.max(c).alias(c) for c in _OPS[1:]]
    return rows.groupBy("id").agg(F.min("add").alias("add"), *newest)


def event_states(events: DataFrame, categories: DataFrame) -> DataFrame:
    """Folded events; ``events`` has memory_id, op, content, ts and event_id, and may have category and other fields of an add.

    Events without a memory id and unknown operations touch nothing.
    """
    for c, t in {"category": "string", **_GIVEN}.items():
        if c not in events.columns:
            events = events.withColumn(c, F.lit(None).cast(t))
    schema = _state_schema(*[events.schema[c].dataType.simpleString() for c in ("memory_id", "event_id")])
    kept = resolve_category(events.where(F.col("memory_id").isNotNull() & F.col("op").isin(*_OPS)), categories)
    when = {"created_at": F.col("ts"), "updated_at": F.col("ts"), "is_active": F.lit(True)}

    def part(op: str) -> Column:
        fields = [when.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema[op].dataType.fields]
        return F.when(F.col("op") == op, F.struct(*fields)).cast(schema[op].dataType).alias(op)

    return fold(kept.select(F.col("memory_id").alias("id"), *[part(op) for op in _OPS]))


def base_states(base: DataFrame, event_type: str) -> DataFrame:
    """State of rows that were there before any event: an add without a time, which is earlier than all others."""
    schema = _state_schema(base.schema["id"].dataType.simpleString(), event_type)
    fields = [
        (F.lit(None) if f.name in ("ts", "event_id") else F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema["add"].dataType.fields
    ]
    empty = [F.lit(None).cast(schema[op].dataType).alias(op) for op in _OPS[1:]]
    return base.select("id", F.struct(*fields).alias("add"), *empty)


def _at(name: str) -> Column:
    return F.struct(F.col(f"{name}.ts").alias("ts"), F.col(f"{name}.event_id").alias("event_id"))


def _counts(name: str) -> Column:
    """An event counts after the add of its row."""
    return F.col(name).isNotNull() & F.col("add").isNotNull() & (_at(name) > _at("add"))


def state_rows(states: DataFrame) -> DataFrame:
    """Rows that the states stand for, without vectors; ids without an add have none.

    ``vector_text`` is the text whose vector the row should have and ``text_at`` the event that it came with.
    """
    counted = {op: F.when(_counts(op), F.col(op)) for op in _OPS[1:]}
    newest = F.greatest(counted["update"], counted["embed"])
    last = [F.when(_counts(op), F.col(op).getField("ts")) for op in _OPS[1:]]
    out = states.where("add is not null").select(
        "id", "add.category_id", default_target(F.col("add.target")).alias("target"),
        F.coalesce(counted["update"].getField("content"), F.col("add.content")).alias("content"),
        F.coalesce(newest.getField("content"), F.col("add.content")).alias("vector_text"),
        F.coalesce(newest.getField("event_id"), F.col("add.event_id")).alias("text_at"),
        "add.source_session", default_confidence(F.col("add.confidence")).alias("confidence"),
        (F.coalesce("add.is_active", F.lit(True)) & ~_counts("forget")).alias("is_active"),
        "add.created_at", F.greatest(F.col("add.updated_at"), *last).alias("updated_at"), "add.expires_at",
        default_tags(F.col("add.tags")).alias("tags"), default_metadata(F.col("add.metadata")).alias("metadata"),
    )
    return out


def stream_rows(
    events: DataFrame,
    categories: DataFrame,
    embed: EmbedSpec,
    path: str,
    checkpoint: str,
    base: DataFrame | None = None,
    cache: DataFrame | None = None,
    buckets: int = BUCKETS,
    available_now: bool = True,
    **trigger,
) -> StreamingQuery:
    """Fold events into whole rows; every micro-batch writes its changed rows to ``path/rows/batch=N``.

    ``base`` holds the memories that exist at the start and must stay as it is: the rows of a batch's ids are taken from
    there, and taking them again changes nothing, so the state holds only ids that had an event. A text is embedded when it becomes a row's newest one, so a soft delete costs no call; ``read_rows`` finds its older vector.
    Texts that fail under ``keep_errors`` leave the vector as it was.
    """
    states = f"{path.rstrip('/')}/state"
    event_type = events.schema["event_id"].dataType.simpleString()
    vector = vector_column(embed.dim, embed.dims)

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        part = stage(event_states(batch, categories))
        known = part
        if base is not None:
            ids = part.df.select("id")
            old = base.join(F.broadcast(ids) if part.small else ids, "id", "left_semi")
            known = stage(part.df.unionByName(base_states(old, event_type)))
        merged = stage(merge_stored(session, states, known, fold, buckets).dropDuplicates(["id"]))
        # The newest text is this batch's if one of its events brought it, or if its add made older ones count.
        mine = part.df.select("id", *[F.col(f"{op}.event_id").alias(f"_{op}") for op in _OPS[:3]])
        own_add = merged.df.select("id", F.col("add.event_id").alias("_first"))
        changed = state_rows(merged.df).join(mine, "id").join(own_add, "id")
        brought = F.greatest(*[F.coalesce(F.col("text_at") == F.col(f"_{op}"), F.lit(False)) for op in _OPS[:3]])
        fresh = brought | F.coalesce(F.col("_first") == F.col("_add"), F.lit(False))
        rows = stage(changed.withColumn("new_text", fresh).drop(*[f"_{op}" for op in _OPS[:3]], "_first", "text_at"))
        text = F.when(F.col("new_text"), F.col("vector_text"))
        vectors = embed_texts(rows.df.select(text.alias("text")), embed, cache)
        done = attach_embedding(rows.df.withColumn("_text", text), "_text", embed, vectors)
        failed = F.coalesce(F.col("status") == ERROR, F.lit(False))
        done = done.withColumn("new_text", F.col("new_text") & ~failed)
        done = done.withColumn(vector, F.when(F.col("new_text"), F.col("vector"))).drop("_text", "key", "vector", "status", "error")
        done.write.mode("overwrite").parquet(_batch_path(f"{path.rstrip('/')}/rows", batch_id))

    return _start(events, write, checkpoint, available_now, **trigger)


def read_rows(spark: SparkSession, path: str, base: DataFrame | None = None) -> DataFrame:
    """The memories after all batches: of every id the last row written, with the last vector written.

    With ``base``, its rows that no event changed pass through, and changed ones without a new text keep their vectors.
    """
    log = spark.read.option("basePath", f"{path.rstrip('/')}/rows").parquet(f"{path.rstrip('/')}/rows/batch=*")
    widths = [f"vector_{d}" for d in vector_dims(log)]
    plain = [c for c in log.columns if c not in ("id", "batch", "new_text", *widths)]
    last = [F.max_by(v, F.when(F.col("new_text"), F.col("batch"))).alias(v) for v in widths]
    found = log.groupBy("id").agg(
        F.max_by(F.struct(*plain), "batch").alias("_row"), F.max("new_text").alias("_new"), *last
    )
    rows = found.select("id", "_row.*", *widths, "_new")
    if base is None:
        return rows.drop("_new")
    old = base.drop(*state_columns(base))
    columns = [c for c in old.columns if c != "id"]
    both = old.alias("b").join(rows.withColumn("_hit", F.lit(True)).alias("r"), "id", "full_outer")
    hit = F.coalesce(F.col("r._hit"), F.lit(False))

    def pick(c: str) -> Column:
        if c in plain:
            return F.when(hit, F.col(f"r.`{c}`").cast(old.schema[c].dataType)).otherwise(F.col(f"b.`{c}`")).alias(c)
        if c in widths:
            return F.when(F.coalesce(F.col("r._new"), F.lit(False)), F.col(f"r.`{c}`")).otherwise(F.col(f"b.`{c}`")).alias(c)
        return F.col(f"b.`{c}`").alias(c)

    return both.select("id", *[pick(c) for c in columns])
