"""Scans and writers for memory snapshots and the small registry tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import iso_timestamp
from ..operators.filters import vector_state
from ..schemas import CATEGORY_SCHEMA, DIMS, MODEL_SCHEMA, NO_RESULTS, SETTING_SCHEMA, memory_schema, vector_dims

_VERSION = "version="


def state_columns(m: DataFrame) -> list[str]:
    return [c for c in m.columns if c.startswith("state_")]


def with_vector_state(m: DataFrame) -> DataFrame:
    """Add one byte per width that tells a missing, an all-zero and a real vector apart."""
    plain = m.drop(*state_columns(m))
    return plain.withColumns({f"state_{d}": vector_state(plain, d) for d in vector_dims(plain)})


def scan_memory(
    spark: SparkSession, path: str, dims: Sequence[int] = DIMS, id_type: T.DataType | None = None
) -> DataFrame:
    """Read a memory snapshot with an explicit schema; unused vector columns are never read.

    Snapshots lie in directories by activity, so a search skips the files of deleted rows.
    """
    schema = memory_schema(dims, id_type)
    for d in dims:
        schema = schema.add(f"state_{d}", T.ByteType())
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def scan_categories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATEGORY_SCHEMA).parquet(path)


def scan_models(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MODEL_SCHEMA).parquet(path)


def scan_settings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SETTING_SCHEMA).parquet(path)


def model_list(models: DataFrame) -> DataFrame:
    return models.orderBy("dim")


def read_setting(settings: DataFrame, key: str) -> DataFrame:
    return settings.where(F.col("key") == key).select("value")


def widen(df: DataFrame) -> DataFrame:
    """Spread a table that comes in fewer partitions than there are cores.

    A file of one row group is one task, whatever is computed from it. Tables that Spark reads in enough partitions
    pass unchanged; their number comes from the planned scan, whatever the size of the files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def append_memories(m: DataFrame, new: DataFrame) -> DataFrame:
    """The table with the new rows; columns the new rows lack are NULL."""
    return m.unionByName(new, allowMissingColumns=True)


def write_append(new: DataFrame, path: str) -> None:
    """Append rows to a snapshot directory in its stored layout."""
    with_vector_state(new).write.mode("append").partitionBy("is_active").parquet(path)


def write_snapshot(m: DataFrame, root: str, version: int) -> str:
    """Write a complete state as a new version next to the old ones, which stay readable."""
    path = f"{root.rstrip('/')}/{_VERSION}{version:012d}"
    with_vector_state(m).write.mode("errorifexists").partitionBy("is_active").parquet(path)
    return path


def snapshot_versions(spark: SparkSession, root: str) -> list[int]:
    """Committed versions, oldest first; a directory without Spark's success marker is ignored."""
    jvm = spark._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, f"{_VERSION}*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName()[len(_VERSION):]) for s in found)


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    versions = snapshot_versions(spark, root)
    return f"{root.rstrip('/')}/{_VERSION}{versions[-1]:012d}" if versions else None


def _document(df: DataFrame, skip: Sequence[str]) -> Column:
    fields = []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = iso_timestamp(c)
        elif f.name in ("text_rank", "rank"):
            c = F.coalesce(c, F.lit(0.0))
        elif f.name == "metadata":
            c = F.try_parse_json(c)
        fields.append(c.alias(f.name))
    return F.struct(*fields)


def to_json_results(df: DataFrame) -> DataFrame:
    """Every row as one JSON document; absent fields appear as null."""
    return df.select(F.to_json(_document(df, ()), {"ignoreNullFields": "false"}).alias("document"))


def to_json_responses(q: DataFrame, results: DataFrame, order: str, by: str = "qid") -> DataFrame:
    """One JSON response per query: its results in order and their count, or a message without any.

    Results per query are bounded by the search's own limit, so the lists stay short.
    """
    entry = F.struct(F.col(order).alias("_o"), _document(results, (by, order)).alias("d"))
    docs = F.array_sort(F.collect_list(entry), lambda a, b: a["_o"] - b["_o"])
    grouped = results.groupBy(by).agg(docs.alias("_docs"))
    body = F.when(
        F.col("_docs").isNull(), F.lit(f'{{"results":[],"message":"{NO_RESULTS}"}}')
    ).otherwise(
        F.to_json(
            F.struct(F.transform("_docs", lambda x: x["d"]).alias("results"), F.size("_docs").alias("count")),
            {"ignoreNullFields": "false"},
        )
    )
    return q.select(by).join(grouped, by, "left").select(by, body.alias("response"))
