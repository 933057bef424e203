"""Memory tables stored in directories by a hash of the id: a change reads and writes only the directories it touches.

A change replaces whole directories, each by one rename when all its tasks are done (Spark's dynamic partition
overwrite). All changes here set values or reject known ids, so one that was cut off may simply be run again.
One writer at a time, as for any folder of Parquet files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.embedders import EmbedSpec
from ..sources.tables import state_columns, with_vector_state
from .mutations import backfill, forget, pending, prepare_memories, update_memories
from .staging import Staged, prunable, stage

BUCKETS = 1024
_PLACE = ("buckets", "bucket")


def id_bucket(buckets: int, key: str = "id") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, path: str, buckets: int, mode: str) -> None:
    placed = with_vector_state(rows).withColumns({"buckets": F.lit(buckets), "bucket": id_bucket(buckets)})
    # The hint gives each directory to one task, and lets AQE split one that a hot id makes too large.
    writer = placed.hint("rebalance", "bucket").write.mode(mode).option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*_PLACE).parquet(path)


def write_buckets(rows: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store a table; the number of buckets stands in the directories' names."""
    if buckets < 1:
        raise ValueError("buckets must be positive")
    _write(rows, path, buckets, "errorifexists")


def _buckets_of(spark: SparkSession, path: str) -> int | None:
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/buckets=*")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or []
    return int(found[0].getPath().getName().split("=")[1]) if len(found) == 1 else None


def stored_buckets(spark: SparkSession, path: str) -> int:
    """Number of buckets that a table was written with."""
    found = _buckets_of(spark, path)
    if found is None:
        raise ValueError(f"{path} is no table in buckets")
    return found


def read_buckets(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The stored rows with their ``bucket``; read again after a change, as files are replaced."""
    if schema is None:
        return spark.read.parquet(path).drop("buckets")
    places = T.StructType([T.StructField(c, T.IntegerType()) for c in _PLACE])
    return spark.read.schema(T.StructType([*schema.fields, *places.fields])).parquet(path).drop("buckets")


def _known(stored: DataFrame, ids: DataFrame, buckets: int) -> DataFrame:
    """``(bucket, id)`` of the given ids that are stored; reads the ids of their directories only."""
    keys = stage(ids.select("id").distinct().withColumn("bucket", id_bucket(buckets)))
    side = F.broadcast(prunable(keys.df, "bucket")) if keys.small else keys.df
    return stored.select("bucket", "id").join(side, ["bucket", "id"], "left_semi")


def rewrite(spark: SparkSession, path: str, ids: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
    """Apply ``change`` to the directories that hold any of ``ids`` and return their number.

    ``change`` gets all rows of those directories and returns all of them, in the same columns. Directories without a
    given id are neither read nor written; ids that are not stored touch none.
    """
    stored, buckets = read_buckets(spark, path), stored_buckets(spark, path)
    hit = stage(_known(stored, ids, buckets).select("bucket").distinct())
    if hit.rows:
        # One number per directory, so its size is bounded by the table's own number of buckets.
        rows = stored.join(F.broadcast(prunable(hit.df, "bucket")), "bucket", "left_semi").drop("bucket")
        _write(change(rows), path, buckets, "overwrite")
    return hit.rows


def merge_stored(
    spark: SparkSession, path: str, part: Staged, combine: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS
) -> DataFrame:
    """Combine ``part`` with the stored rows of its ids and return those rows as they are then stored.

    ``combine`` folds all rows of an id into one. Where it is a minimum, maximum or union, merging the same part twice
    changes nothing, so a cut-off merge may be repeated. The table is made on the first merge.
    """
    exists = _buckets_of(spark, path)
    buckets = exists or buckets
    if not part.rows:
        return part.df
    hit = stage(part.df.select(id_bucket(buckets).alias("bucket")).distinct())
    rows = part.df
    if exists:
        stored = read_buckets(spark, path, part.df.schema)
        near = stored.join(F.broadcast(prunable(hit.df, "bucket")), "bucket", "left_semi").drop("bucket")
        rows = near.unionByName(rows)
    _write(combine(rows), path, buckets, "overwrite")
    keys = part.df.select("id", id_bucket(buckets).alias("bucket"))
    side = F.broadcast(prunable(keys, "bucket")) if part.small else keys
    return read_buckets(spark, path, part.df.schema).join(side, ["bucket", "id"], "left_semi").drop("bucket")


def add_stored(
    spark: SparkSession, path: str, new: DataFrame, categories: DataFrame, embed: EmbedSpec, now: Column, cache: DataFrame | None = None
) -> None:
    """Append new memories; known ids are rejected. No file is rewritten, only ids of the directories concerned are read."""
    stored, buckets = read_buckets(spark, path), stored_buckets(spark, path)
    taken = stage(_known(stored, new, buckets).select("id").distinct())
    fresh = new.join(F.broadcast(taken.df) if taken.small else taken.df, "id", "left_anti")
    layout = stored.drop("bucket", *state_columns(stored))
    _write(prepare_memories(layout, fresh, categories, embed, now, cache), path, buckets, "append")


def update_stored(
    spark: SparkSession,
    path: str,
    edits: DataFrame,
    embed: EmbedSpec,
    now: Column,
    order: Sequence[str],
    clear_other_dims: bool = False,
    cache: DataFrame | None = None,
) -> int:
    """Edit memories in place; see ``update_memories``. Returns the number of directories rewritten."""
    return rewrite(spark, path, edits, lambda m: update_memories(m, edits, embed, now, order, clear_other_dims, cache))


def forget_stored(spark: SparkSession, path: str, ids: DataFrame, now: Column) -> int:
    """Soft delete in place; see ``forget``. Returns the number of directories rewritten."""
    return rewrite(spark, path, ids, lambda m: forget(m, ids, now))


def backfill_stored(
    spark: SparkSession, path: str, specs: Sequence[EmbedSpec], now: Column, limit: int = 0, cache: DataFrame | None = None
) -> DataFrame:
    """Embed what is missing in place and return the counts per width; see ``backfill``.

    What is due is found by the stored state bytes, so vectors are read in the touched directories only. The oldest
    ``limit`` rows of the whole table are also the oldest of the directories that hold them.
    """
    m = read_buckets(spark, path)
    due = [stage(pending(m, s.dim, limit).select("id")) for s in specs]
    ids = due[0].df
    for d in due[1:]:
        ids = ids.unionByName(d.df)
    counts: list[Staged] = []

    def change(rows: DataFrame) -> DataFrame:
        done = backfill(rows, specs, now, limit, cache=cache)
        counts.append(stage(done.stats))  # before the files that they are counted from are replaced
        return done.memory

    if not rewrite(spark, path, ids, change):
        counts.append(stage(backfill(m.drop("bucket").limit(0), specs, now, limit).stats))
    return counts[0].df
