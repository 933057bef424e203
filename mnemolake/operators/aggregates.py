"""Counts and coverage. Each is one pass with map-side partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import REAL, active, by_target, vector_state
from .joins import with_category_name


def count_memories(m: DataFrame, target: str | None = None) -> DataFrame:
    return by_target(active(m), target).agg(F.count(F.lit(1)).alias("n"))


def count_by_target(m: DataFrame) -> DataFrame:
    return active(m).groupBy("target").agg(F.count(F.lit(1)).alias("n"))


def count_by_category(m: DataFrame, categories: DataFrame) -> DataFrame:
    """Active memories per category name. Counts by id first, so only totals meet the names."""
    per_id = active(m).groupBy("category_id").agg(F.count(F.lit(1)).alias("n"))
    return with_category_name(per_id, categories).groupBy("name").agg(F.sum("n").alias("n"))


def count_by_dim(m: DataFrame, dims: Sequence[int]) -> DataFrame:
    """Usable vectors per width, all widths in one pass."""
    rows = active(m)
    counts = rows.agg(*[F.count_if(vector_state(rows, d) == REAL).alias(f"n_{d}") for d in dims])
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(f"n_{d}").alias("n")) for d in dims])
    return counts.select(F.inline(pairs))


def coverage(m: DataFrame, dim: int) -> DataFrame:
    """Active and embedded memories with the missing share, 0 for an empty table."""
    rows = active(m)
    counts = rows.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(vector_state(rows, dim) == REAL).alias("embedded")
    )
    ratio = (F.col("total") - F.col("embedded")) / F.nullif(F.col("total"), F.lit(0))
    return counts.withColumn("missing_ratio", F.when(F.col("total") == 0, 0.0).otherwise(ratio))


def registered_dims(models: DataFrame, dims: Sequence[int]) -> DataFrame:
    return models.where(F.col("dim").isin(list(dims))).agg(F.count(F.lit(1)).alias("n"))
