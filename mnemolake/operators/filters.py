"""Row filters over the memory table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_sets import json_holds, path_values_of
from ..functions.scalars import is_blank, strip
from ..functions.vectors import is_zero
from ..schemas import MAX_TARGET_CHARS
from .staging import balanced_join, counted_heavy_keys, stage

MISSING, ZERO, REAL = 0, 1, 2


def vector_state(m: DataFrame, dim: int) -> Column:
    """0 missing, 1 all zero, 2 real.

    Snapshots store this byte next to each vector (``state_<dim>``); where it is present no reader
    has to scan the vectors, by far the widest columns, to tell the three states apart.
    """
    if f"state_{dim}" in m.columns:
        return m[f"state_{dim}"]
    v = m[f"vector_{dim}"]
    return F.when(v.isNull(), MISSING).when(is_zero(v), ZERO).otherwise(REAL).cast("tinyint")


def active(m: DataFrame) -> DataFrame:
    return m.where("is_active")


def by_target(m: DataFrame, target: str | None) -> DataFrame:
    """Equality on target; no filter when it is absent or empty."""
    return m.where(F.col("target") == target) if target else m


def by_category(m: DataFrame, categories: DataFrame, name: str | None, strict: bool = False) -> DataFrame:
    """Equality on the category's id. An unknown name drops the filter, or all rows when strict."""
    if not name:
        return m
    wanted = categories.where(F.col("name") == name).agg(F.max("id").alias("_wanted"))
    found = wanted.scalar()
    keep = m.category_id == found
    return m.where(keep if strict else found.isNull() | keep)


def has_vector(m: DataFrame, dim: int) -> DataFrame:
    if f"state_{dim}" in m.columns:
        return m.where(m[f"state_{dim}"] != MISSING)
    return m.where(m[f"vector_{dim}"].isNotNull())


def embedded(m: DataFrame, dim: int) -> DataFrame:
    return m.where(vector_state(m, dim) == REAL)


def needs_embedding(m: DataFrame, dim: int) -> DataFrame:
    """Vector missing, empty or all zero (negative zero included)."""
    return m.where(vector_state(m, dim) != REAL)


def with_tags(m: DataFrame, tags: Sequence[str], mode: str = "all") -> DataFrame:
    wanted = F.array(*[F.lit(t) for t in tags]).cast("array<string>")
    if mode == "all":
        return m.where(F.forall(wanted, lambda t: F.array_contains(F.col("tags"), t)))
    if mode == "any":
        return m.where(F.arrays_overlap("tags", wanted))
    raise ValueError(f"mode must be 'all' or 'any', not {mode!r}")


def with_metadata(m: DataFrame, path: str, value, type: str = "string") -> DataFrame:
    """Metadata entry at a JSON path equals the value."""
    return m.where(F.try_variant_get(F.try_parse_json("metadata"), path, type) == F.lit(value).cast(type))


def containing_metadata(m: DataFrame, wanted: str) -> DataFrame:
    """Rows whose metadata contain a JSON document, nested objects and array elements included."""
    return m.where(json_holds(F.col("metadata"), F.lit(wanted)))


def match_metadata(q: DataFrame, m: DataFrame) -> DataFrame:
    """``(qid, id)`` where a memory's metadata contain the query's JSON document ``wanted``.

    Both sides become sets of paths with values. A query meets the memories that have its rarest pair, is compared by
    inclusion of its set, and the rest is verified document against document, as elements of arrays share a path. Only pairs that
    some query has are shuffled, and a pair that very many memories have is spread. What is no JSON matches nothing.
    """
    def hashed(text: str) -> Column:
        return F.transform(path_values_of(F.col(text)), lambda p: F.xxhash64(p)).alias("pairs")

    asked = stage(q.select("qid", "wanted", hashed("wanted")).where("pairs is not null"))
    vocabulary = asked.df.select(F.explode("pairs").alias("pair")).distinct()
    own = m.select("id", hashed("metadata")).select("id", F.explode("pairs").alias("pair"))
    found = stage(balanced_join(own, vocabulary, "pair", "left_semi", right_small=asked.small))
    counts = found.df.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    sized = asked.df.select("qid", F.explode("pairs").alias("pair")).join(counts, "pair", "left")
    rarest = sized.groupBy("qid").agg(F.min_by("pair", F.struct(F.coalesce("n", F.lit(0)), "pair")).alias("pair"))
    heavy = counted_heavy_keys(counts, "pair", "n", found.rows)
    candidates = balanced_join(found.df, rarest, "pair", right_small=asked.small, heavy=heavy).select("qid", "id")
    sets = found.df.groupBy("id").agg(F.collect_set("pair").alias("_own"))
    questions = F.broadcast(asked.df) if asked.small else asked.df
    met = candidates.join(sets, "id").join(questions, "qid").where(F.size(F.array_except("pairs", "_own")) == 0)
    texts = met.select("qid", "id", "wanted").join(m.select("id", "metadata"), "id")
    return texts.where(json_holds(F.col("metadata"), F.col("wanted"))).select("qid", "id")


def not_expired(m: DataFrame, now: Column) -> DataFrame:
    return m.where(F.col("expires_at").isNull() | (F.col("expires_at") > now))


def gate_queries(q: DataFrame, min_len: int = 1, max_len: int | None = None, col: str = "query_text") -> DataFrame:
    """Strip query texts, drop those shorter than ``min_len`` and cut the rest at ``max_len``."""
    out = q.withColumn(col, strip(F.col(col))).where(F.length(col) >= max(min_len, 1))
    return out.withColumn(col, F.substring(col, 1, max_len)) if max_len else out


def validate_rows(new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split new rows into accepted and rejected; rejected rows carry a ``reason``."""
    reason = F.when(is_blank(F.col("content")), "content is required").when(
        F.length("target") > MAX_TARGET_CHARS, "target is too long"
    )
    checked = new.withColumn("reason", reason)
    return checked.where("reason is null").drop("reason"), checked.where("reason is not null")


def existing(m: DataFrame, ids: DataFrame) -> DataFrame:
    """The given ids that exist in the table, each once; a small batch is looked up without a shuffle."""
    wanted = stage(ids.select("id").distinct())
    side = F.broadcast(wanted.df) if wanted.small else wanted.df
    return m.select("id").join(side, "id", "left_semi")
