"""Status, summary, preflight and verification reports as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import percent
from ..operators.aggregates import count_by_category, count_by_dim, count_memories, coverage, registered_dims
from ..operators.embedding import default_dim
from ..operators.filters import REAL, active, vector_state
from ..operators.staging import stage
from ..schemas import CONTEXT_TOP_K, DIMS, FALLBACK_DIM, vector_dims
from ..sources.tables import with_vector_state
from .search import Batch, verification_search


def _rows(df: DataFrame, section: str, key, value) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"), key.cast("string").alias("key"), value.cast("string").alias("value")
    )


def status(
    m: DataFrame,
    categories: DataFrame,
    models: DataFrame,
    settings: DataFrame,
    dims: Sequence[int] = DIMS,
    fallback: int = FALLBACK_DIM,
) -> DataFrame:
    """``(section, key, value)``: total, per category, per width, default width, embedder per width.

    The memory table is read once: one aggregation by category carries the counts of every width.
    """
    rows = active(m)
    wide = stage(
        rows.groupBy("category_id").agg(
            F.count(F.lit(1)).alias("n"), *[F.count_if(vector_state(rows, d) == REAL).alias(f"n_{d}") for d in dims]
        )
    ).df
    sums = wide.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                    *[F.coalesce(F.sum(f"n_{d}"), F.lit(0)).alias(f"n_{d}") for d in dims])
    totals = F.array(
        F.struct(F.lit("total_memories").alias("s"), F.lit("").alias("k"), F.col("n").alias("v")),
        *[F.struct(F.lit("per_dim_embedded").alias("s"), F.lit(str(d)).alias("k"), F.col(f"n_{d}").alias("v")) for d in dims],
    )
    counted = sums.select(F.inline(totals)).select(
        F.col("s").alias("section"), F.col("k").alias("key"), F.col("v").cast("string").alias("value")
    )
    names = categories.select(F.col("id").alias("category_id"), "name")
    per_category = _rows(wide.join(names, "category_id"), "by_category", F.col("name"), F.col("n"))
    chosen = _rows(default_dim(settings, dims, fallback), "default_dim", F.lit(""), F.col("default_dim"))
    embedders = _rows(
        models.where(F.col("dim").isin(list(dims))), "embedders", F.col("dim"), F.concat_ws("/", "provider", "model")
    )
    return counted.unionByName(per_category).unionByName(chosen).unionByName(embedders)


def summary(m: DataFrame, settings: DataFrame, dims: Sequence[int] = DIMS, fallback: int = FALLBACK_DIM) -> DataFrame:
    """One line of text with the number of active memories and the default width."""
    chosen = default_dim(settings, dims, fallback).scalar()
    text = F.format_string(
        "Active. %d memories stored. Default embedding dim: %d. Vector columns: %s.",
        F.col("n"), chosen, F.lit(", ".join(str(d) for d in dims)),
    )
    return count_memories(m).select(text.alias("summary"))


def _columns(spark: SparkSession, table: str) -> DataFrame | None:
    """The table at a path or catalog name, or None when there is none."""
    try:
        if "/" in table:
            return spark.read.parquet(table)
        return spark.table(table) if spark.catalog.tableExists(table) else None
    except AnalysisException:
        return None


def preflight(
    spark: SparkSession,
    tables: dict[str, str],
    dims: Sequence[int] = DIMS,
    fallback: int = FALLBACK_DIM,
) -> DataFrame:
    """Readiness checks ``(name, status, detail)`` for memory, categories, models and settings.

    ``tables`` maps those names to paths or catalog names. Data checks only: is the table there, has
    it a column per width, how many usable vectors, which widths are registered, which is default.
    """
    found = {name: _columns(spark, tables[name]) if name in tables else None
             for name in ("memory", "categories", "models", "settings")}
    checks = [(f"table {n}", "ok" if df is not None else "missing", "") for n, df in found.items()]
    m = found["memory"]
    if m is not None and "is_active" in m.columns:
        m = m.withColumn("is_active", F.col("is_active").cast("boolean"))
    present = [] if m is None else [d for d in dims if d in vector_dims(m)]
    for d in dims:
        checks.append((f"column vector_{d}", "ok" if d in present else "missing", ""))
    report = spark.createDataFrame(checks, "name string, status string, detail string")
    if m is not None and present:
        rows = m if all(f"state_{d}" in m.columns for d in present) else with_vector_state(m)
        counts = count_by_dim(rows, present)
        report = report.unionByName(
            counts.select(F.format_string("vectors %d", "dim").alias("name"),
                          F.when(F.col("n") > 0, "ok").otherwise("warning").alias("status"),
                          F.format_string("%d embedded", "n").alias("detail"))
        )
    if found["models"] is not None:
        report = report.unionByName(
            registered_dims(found["models"], dims).select(
                F.lit("registered dims").alias("name"),
                F.when(F.col("n") == len(dims), "ok").otherwise("warning").alias("status"),
                F.format_string(f"%d of {len(dims)}", "n").alias("detail"),
            )
        )
    if found["settings"] is not None:
        report = report.unionByName(
            default_dim(found["settings"], dims, fallback).select(
                F.lit("default dim").alias("name"), F.lit("ok").alias("status"),
                F.col("default_dim").cast("string").alias("detail"),
            )
        )
    return report


def check_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def verify(
    m: DataFrame,
    dim: int,
    probe: Batch,
    postings: DataFrame,
    stats: DataFrame | None = None,
    top_k: int = CONTEXT_TOP_K,
) -> DataFrame:
    """One row: coverage, probe result and the list of failures.

    ``probe`` is a prepared batch, usually of one query; ``stats`` are the embedder's counters.
    """
    hits = verification_search(probe, m, postings, dim, top_k).agg(
        F.count(F.lit(1)).alias("probe_hits"),
        F.coalesce(F.max(F.when(~F.isnan("vector_sim"), F.col("vector_sim"))), F.lit(0.0)).alias("best_similarity"),
        F.count_if(F.isnan("vector_sim")).alias("undefined_similarities"),
    )
    counted = coverage(m, dim)
    row = counted.withColumn("missing_percent", percent(F.col("missing_ratio")))
    # Reports of one row each, put side by side by a constant key.
    row = row.withColumn("_one", F.lit(1)).join(hits.withColumn("_one", F.lit(1)), "_one")
    if stats is None:
        row = row.withColumns({"errors": F.lit(0), "zero_fallbacks": F.lit(0)})
    else:
        row = row.join(stats.select("errors", "zero_fallbacks").withColumn("_one", F.lit(1)), "_one")
    none_embedded = (F.col("total") > 0) & (F.col("embedded") == 0)
    rules = [
        (none_embedded, "no active rows have usable vectors"),
        (~none_embedded & (F.col("missing_ratio") > 0.5), "more than half of the active rows lack a vector"),
        ((F.col("probe_hits") == 0) & (F.col("embedded") == 0), "the probe found nothing and no rows are embedded"),
        ((F.col("probe_hits") > 0) & (F.col("best_similarity") <= 0), "no probe hit has a positive similarity"),
        (F.col("zero_fallbacks") > 0, "the embedder fell back to zero vectors"),
        (F.col("errors") > 0, "the embedder reports errors"),
    ]
    failures = F.array_compact(F.array(*[F.when(c, F.lit(text)) for c, text in rules]))
    return row.drop("_one").withColumn("failures", failures).withColumn("ok", F.size("failures") == 0)
