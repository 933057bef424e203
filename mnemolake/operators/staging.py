"""Intermediate tables, measured sizes and joins that stay balanced under hot keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 32 * 1024 * 1024
HEAVY_KEYS = 100
HEAVY_SHARE = 0.002
HEAVY_MIN_ROWS = 100_000
SALTS = 64
#: Words of 64 hashed bits that stand for a set of keys, at most.
KEY_WORDS = 1 << 18


def staging_dir(spark: SparkSession) -> str:
    """The shared scratch folder; a temporary one only on a local master without one.

    On a cluster every machine would write to a disk of its own, so a missing setting is an error there.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(spark, "_mnemolake_staging"):
        spark._mnemolake_staging = tempfile.mkdtemp(prefix="mnemolake-")
    return spark._mnemolake_staging


def row_bytes(schema: T.StructType) -> Column:
    """Rough in-memory bytes of a row, from its values."""

    def size(c: Column, t: T.DataType) -> Column:
        if isinstance(t, T.StringType):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 24
        if isinstance(t, T.ArrayType):
            if isinstance(t.elementType, (T.StringType, T.ArrayType, T.StructType)):
                total = F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + size(x, t.elementType))
                return F.coalesce(total, F.lit(0)) + 24
            return F.coalesce(F.greatest(F.size(c), F.lit(0)), F.lit(0)) * 8 + 24
        if isinstance(t, T.StructType):
            return sum((size(c.getField(f.name), f.dataType) for f in t.fields), F.lit(16))
        return F.lit(16)

    return sum((size(F.col(f"`{f.name}`"), f.dataType) for f in schema.fields), F.lit(16)).cast("long")


@dataclass(frozen=True)
class Staged:
    """A written intermediate table with the row count and bytes seen while writing it."""

    df: DataFrame
    rows: int
    bytes: int
    seen: dict

    @property
    def small(self) -> bool:
        return self.bytes <= BROADCAST_BYTES


def _own_dir(spark: SparkSession) -> str:
    return f"{staging_dir(spark)}/mnemolake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession) -> str:
    """A new path in this application's part of the shared folder."""
    return f"{_own_dir(spark)}/{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Remove this application's staged tables; results that still read them must be saved before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, **metrics: Column) -> Staged:
    """Write once to the shared folder and read back.

    Cuts the lineage, survives lost executors, and measures the table in the same pass, so that
    later broadcasts rest on its real size. Further aggregates to take in that pass go in ``metrics``.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    seen = Observation()
    measured = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(row_bytes(df.schema)), F.lit(0)).alias("bytes"),
        *[c.alias(name) for name, c in metrics.items()],
    )
    measured.write.parquet(path)
    found = seen.get
    return Staged(spark.read.schema(df.schema).parquet(path), found["rows"], found["bytes"], found)


def prunable(side: DataFrame, column: str) -> DataFrame:
    """The small side of a join on a partition column of a stored table.

    Spark prunes directories at run time only for a side that has a filter, so it gets one that every row with a
    value passes: texts are at least empty, bucket numbers at least 0.
    """
    lowest = "" if isinstance(side.schema[column].dataType, T.StringType) else 0
    return side.where(F.col(column) >= F.lit(lowest))


def counted_heavy_keys(counts: DataFrame, key: str, n: str, total: int, share: float = HEAVY_SHARE) -> DataFrame:
    """Heavy keys from counts that are known already; fewer than ``1 / share`` rows."""
    return counts.where(F.col(n) > max(total * share, HEAVY_MIN_ROWS)).select(key)


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE, min_rows: int = HEAVY_MIN_ROWS) -> DataFrame:
    """Keys that hold more than ``share`` of all rows; at most ``HEAVY_KEYS`` rows.

    One pass with a mergeable frequent-items sketch. The result only decides how rows are spread,
    never which rows are kept, so the sketch's error cannot change an answer.
    """
    sketch = df.agg(
        F.expr(f"approx_top_k(`{key}`, {HEAVY_KEYS}, 10000)").alias("top"),
        F.count(F.lit(1)).alias("total"),
    )
    return (
        sketch.select("total", F.explode("top").alias("t"))
        .where((F.col("t.count") > F.col("total") * share) & (F.col("t.count") >= min_rows))
        .select(F.col("t.item").alias(key))
    )


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    right_small: bool = False,
    heavy: DataFrame | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Equi join (inner, left or left_semi) whose left side may have very hot keys.

    A right side known to be small is broadcast. Otherwise rows of hot keys are spread over
    ``salts`` reducers and the right rows of those keys, and only those, are repeated per salt.
    Rows without a key match nothing and are spread as well. ``heavy`` lists the hot keys where
    counts are at hand, a few hundred at most; otherwise a sketch of the left side finds them.
    """
    if right_small:
        return left.join(F.broadcast(right), key, how)
    heavy = heavy_keys(left, key) if heavy is None else heavy
    hot = F.broadcast(heavy.withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*[c for c in left.columns if _hashable(left, c)]), F.lit(salts)).cast("int")
    salt = F.when(F.col("_hot") | F.col(key).isNull(), spread).otherwise(0)
    salted_left = left.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")


def split_by_keys(rows: DataFrame, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among ``keys``, all that are and a few others, and all other rows.

    The keys are hashed to bits of a table of bounded size, small enough for a broadcast whatever their number, so
    rows are told apart where they lie. The types of both key columns must be the same.
    """
    h = F.xxhash64(F.col(key))
    word, bit = F.pmod(h, F.lit(KEY_WORDS)).cast("int"), F.pmod(F.shiftright(h, 32), F.lit(64)).cast("int")
    bits = keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    marked = rows.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bits), "_word", "left")
    held = F.expr("coalesce((shiftrightunsigned(_bits, _bit) & 1L) = 1L, false)")
    return marked.where(held).select(*rows.columns), marked.where(~held).select(*rows.columns)


def may_hold(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key may be among ``keys``; see ``split_by_keys``."""
    return split_by_keys(rows, keys, key)[0]


def missing(rows: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not exist yet.

    A small batch of keys is looked up in the existing table where it lies; only a large one makes
    both sides shuffle.
    """
    keys = stage(rows.select(key).distinct())
    if not keys.small:
        return rows.join(existing.select(key), key, "left_anti")
    taken = existing.select(key).join(F.broadcast(keys.df), key, "left_semi").distinct()
    return rows.join(F.broadcast(taken), key, "left_anti")


def _hashable(df: DataFrame, name: str) -> bool:
    return not isinstance(df.schema[name].dataType, (T.MapType, T.VariantType))


def top_per_query(
    scored: DataFrame,
    order: Sequence[Column],
    n: int | Column,
    by: str = "qid",
    bound: int | None = None,
    position: str | None = None,
) -> DataFrame:
    """First ``n`` rows per query in the given order.

    With a per-row ``n`` pass ``bound``, its largest value: the constant limit is what lets every
    task drop rows before the shuffle, so a query with many rows never gathers in one place.
    """
    limit = n if isinstance(n, int) else bound
    if limit is None:
        raise ValueError("a per-row limit needs a bound")
    if limit < 0:
        raise ValueError("row count must not be negative")
    rn = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    name = position or "_rn"
    out = scored.withColumn(name, rn).where(F.col(name) <= limit)
    if not isinstance(n, int):
        out = out.where(F.col(name) <= n)
    return out if position else out.drop(name)
