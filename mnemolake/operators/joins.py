"""Joins between memories, categories, candidates and key tables.

Small dimension tables carry no hint: Spark knows their size and broadcasts them by its own check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FALLBACK_CATEGORY
from .staging import Staged, balanced_join


def resolve_category(new: DataFrame, categories: DataFrame, name: str = "category", fallback: str = FALLBACK_CATEGORY) -> DataFrame:
    """Category name to id on write; an absent or unknown name becomes the fallback."""
    named = categories.select(F.col("name").alias("_name"), F.col("id").alias("_id"))
    default = categories.where(F.col("name") == fallback).agg(F.max("id")).scalar()
    joined = new.join(named, F.col(name) == F.col("_name"), "left")
    return joined.withColumn("category_id", F.coalesce(F.col("_id"), default)).drop("_name", "_id", name)


def with_category_name(m: DataFrame, categories: DataFrame) -> DataFrame:
    """Inner join to the category name; rows without a category drop out."""
    return m.join(categories.select(F.col("id").alias("category_id"), "name"), "category_id")


def resolve_query_category(q: DataFrame, categories: DataFrame, strict: bool = False) -> DataFrame:
    """Category name to id on search; an unknown name means no filter, or no match when strict."""
    named = categories.select(F.col("name").alias("category"), F.col("id").alias("want_category"))
    joined = q.join(named, "category", "left")
    if strict:
        unknown = F.col("category").isNotNull() & (F.col("category") != "") & F.col("want_category").isNull()
        joined = joined.withColumn("want_category", F.when(unknown, F.lit(-1)).otherwise(F.col("want_category")))
    return joined


def attach_vectors(candidates: Staged, m: DataFrame, dim: int) -> DataFrame:
    """Vectors of the surviving candidates.

    Runs after the candidate top-n. A candidate set measured as small prunes the vectors at the
    scan; beyond that both sides shuffle by id, with memories that many queries share spread out.
    """
    vectors = m.select("id", F.col(f"vector_{dim}").alias("vector"))
    return balanced_join(candidates.df, vectors, "id") if not candidates.small else vectors.join(
        F.broadcast(candidates.df), "id"
    )


def upsert(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Insert new keys and update known ones; a NULL in the new row keeps the old value.

    ``rows`` holds at most one row per key, see ``latest_per_key``.
    """
    old, new = table.alias("old"), rows.alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    columns = []
    for c in table.columns:
        source = F.col(f"old.{c}")
        if c in rows.columns:
            source = F.coalesce(F.col(f"new.{c}"), source)
        columns.append(source.cast(table.schema[c].dataType).alias(c))
    return joined.select(*columns)


def seed(existing: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Insert rows whose key is new and leave existing rows alone."""
    return existing.unionByName(rows.join(existing.select(key), key, "left_anti"), allowMissingColumns=True)
