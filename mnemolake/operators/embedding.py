"""Embedding a column: one call per distinct text, a content-addressed cache, width and failure rules."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.embedders import EmbeddingError, EmbedSpec, Factory, embedder_factory
from ..functions.scalars import cache_key, is_blank, json_int
from ..functions.vectors import check_width, zero_vector
from ..schemas import CACHE_SCHEMA, DIMS, FALLBACK_DIM
from .staging import Staged, balanced_join, counted_heavy_keys, missing, prunable, stage

# Status of an embedded row.
BLANK, HIT, OK, FALLBACK, ERROR = "blank", "hit", "ok", "zero_fallback", "error"

#: Bytes of text and texts that one call gets at a time, if no single text has more.
CALL_BYTES, CALL_TEXTS = 1 << 21, 1024

_VECTORS = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)


def _place(key: Column) -> Column:
    """Directory of a stored entry."""
    return F.substring(key, 1, 2)


def cached(wanted: Staged, cache: DataFrame, dim: int) -> Staged:
    """One valid entry ``(key, vector)`` per requested key that has one; the cache is read once.

    Of a cache from ``read_cache`` only the directories of the requested keys are read.
    """
    stored = "prefix" in cache.columns
    on = ["prefix", "key"] if stored else ["key"]
    keys = wanted.df.select("key").distinct()
    if stored:
        keys = prunable(keys.withColumn("prefix", _place(F.col("key"))), "prefix")
    valid = cache.where(check_width(F.col("vector"), dim)).select(*on, "vector")
    found = valid.join(F.broadcast(keys) if wanted.small else keys, on)
    return stage(found.select("key", F.col("vector").cast("array<float>").alias("vector")).dropDuplicates(["key"]))


def cache_lookup(reqs: DataFrame, cache: DataFrame, dim: int) -> DataFrame:
    """Cached vector per requested key, NULL on a miss. An entry of another width is a miss."""
    found = cached(stage(reqs.select("key")), cache, dim)
    return reqs.join(F.broadcast(found.df) if found.small else found.df, "key", "left")


def cache_append(cache: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """The cache with new entries; existing keys keep their entry."""
    if cache is None:
        return fresh
    known = cache.drop("prefix")
    return known.unionByName(missing(fresh, known, "key"))


def write_cache(fresh: DataFrame, path: str) -> None:
    """Append entries in directories by the first two characters of the key."""
    entries = fresh.withColumn("prefix", _place(F.col("key"))).hint("rebalance", "prefix")
    entries.write.mode("append").partitionBy("prefix").parquet(path)


def read_cache(spark, path: str) -> DataFrame:
    """The stored entries with their directory ``prefix``, by which look-ups leave out what they don't need."""
    schema = T.StructType([*CACHE_SCHEMA.fields, T.StructField("prefix", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def _embed_batches(factory: Factory, spec: EmbedSpec):
    dim, model, fail_open = spec.dim, spec.model, spec.fail_open

    def checked(vector) -> list[float]:
        if len(vector) != dim:
            raise EmbeddingError(f"embedding width mismatch: got {len(vector)}, expected {dim}")
        return vector

    def one(embed, text: str):
        try:
            return checked(embed([text])[0]), OK, None
        except Exception as exc:
            if spec.keep_errors:
                return None, ERROR, str(exc)
            if not fail_open:
                raise EmbeddingError(f"embedding failed: {exc}") from exc
            return [0.0] * dim, FALLBACK, str(exc)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed = factory(dim, model)
        for part in (part for batch in batches for part in _calls(batch)):
            texts = part.column("text").to_pylist()
            try:
                vectors = [checked(v) for v in embed(texts)]
                if len(vectors) != len(texts):
                    raise EmbeddingError(f"got {len(vectors)} vectors for {len(texts)} texts")
                rows = [(v, OK, None) for v in vectors]
            except Exception:
                # One bad text must not fail its whole batch: ask again text by text.
                rows = [one(embed, t) for t in texts]
            vectors = pa.array([v.astype("f4") if isinstance(v, np.ndarray) else v for v, _, _ in rows], pa.list_(pa.float32()))
            status, error = (pa.array([r[i] for r in rows], pa.string()) for i in (1, 2))
            yield pa.RecordBatch.from_arrays([part.column("key"), part.column("n"), vectors, status, error], names=_VECTORS.names)

    return run


def _calls(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of bounded text, so that a task never holds many long texts as objects."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(ends):
        before = int(ends[lo - 1]) if lo else 0
        hi = min(max(lo + 1, int(np.searchsorted(ends, before + CALL_BYTES, "right"))), lo + CALL_TEXTS)
        yield batch.slice(lo, hi - lo)
        lo = hi


def embed_texts(texts: DataFrame, spec: EmbedSpec, cache: DataFrame | None = None, col: str = "text") -> Staged:
    """Vector and status per distinct non-blank text, keyed by content address.

    Known keys come from the cache; only the rest reaches the embedder, in Arrow batches. The result
    is staged because a call may be slow, costly or not repeatable.
    """
    text = F.col(col)
    reqs = (
        texts.where(~is_blank(text))
        .select(cache_key(spec.dim, spec.provider, spec.model, text).alias("key"), text.alias("text"))
        .groupBy("key", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    if cache is None:
        return stage(_embedded(reqs, spec), total=total)
    wanted = stage(reqs, total=total)
    found = cached(wanted, cache, spec.dim)
    known = F.broadcast(found.df) if found.small else found.df
    hits = wanted.df.select("key", "n").join(known, "key").select(
        "key", "n", "vector", F.lit(HIT).alias("status"), F.lit(None).cast("string").alias("error")
    )
    names = F.broadcast(found.df.select("key")) if found.small else found.df.select("key")
    fresh = stage(_embedded(wanted.df.join(names, "key", "left_anti"), spec))
    both = hits.unionByName(fresh.df)
    return Staged(both, wanted.rows, found.bytes + fresh.bytes, {**wanted.seen})


def _embedded(reqs: DataFrame, spec: EmbedSpec) -> DataFrame:
    if spec.parallelism:
        reqs = reqs.repartition(spec.parallelism, "key")
    return reqs.mapInArrow(_embed_batches(embedder_factory(spec.provider), spec), _VECTORS)


def cache_entries(vectors: DataFrame, spec: EmbedSpec, ts: Column) -> DataFrame:
    """Cache rows for fresh vectors. Zero vectors of failed calls are never cached."""
    return vectors.where(F.col("status") == OK).select(
        "key", F.lit(spec.dim).alias("dim"), F.lit(spec.provider).alias("provider"),
        F.lit(spec.model).alias("model"), "vector", ts.cast("long").alias("ts"),
    )


def attach_embedding(df: DataFrame, text_col: str, spec: EmbedSpec, vectors: Staged) -> DataFrame:
    """Add ``key``, ``vector``, ``status`` and ``error``; blank texts get the zero vector.

    A text repeated in a third of all rows is one hot key; the join spreads it.
    """
    text = F.col(text_col)
    key = F.when(~is_blank(text), cache_key(spec.dim, spec.provider, spec.model, text))
    heavy = counted_heavy_keys(vectors.df, "key", "n", vectors.seen["total"])
    found = vectors.df.drop("n")
    joined = balanced_join(df.withColumn("key", key), found, "key", "left", right_small=vectors.small, heavy=heavy)
    blank = F.col("key").isNull()
    return joined.withColumns(
        {
            "vector": F.when(blank, zero_vector(spec.dim)).otherwise(F.col("vector")),
            "status": F.when(blank, BLANK).otherwise(F.col("status")),
        }
    )


def embed_column(df: DataFrame, text_col: str, spec: EmbedSpec, cache: DataFrame | None = None) -> DataFrame:
    """Embed a text column; see ``embed_texts`` and ``attach_embedding``."""
    return attach_embedding(df, text_col, spec, embed_texts(df.select(F.col(text_col).alias("text")), spec, cache))


def embed_stats(result: DataFrame) -> DataFrame:
    """Counters of an embedded column as one row.

    A miss is a live call, so repeated texts of one batch count one miss and hits for the others.
    """
    live = F.col("status").isin(OK, FALLBACK, ERROR)
    per_key = result.groupBy("key", "status").agg(F.count(F.lit(1)).alias("_n"))
    hits = F.when(F.col("status") == HIT, F.col("_n")).when(live, F.col("_n") - 1).otherwise(0)
    return per_key.agg(
        F.coalesce(F.sum(hits), F.lit(0)).alias("hits"),
        F.count_if(live).alias("misses"),
        F.count_if(F.col("status").isin(FALLBACK, ERROR)).alias("errors"),
        F.count_if(F.col("status") == FALLBACK).alias("zero_fallbacks"),
    )


def default_dim(settings: DataFrame, dims: Sequence[int] = DIMS, fallback: int = FALLBACK_DIM) -> DataFrame:
    """One row with the configured default width, or the fallback when it is absent or not allowed."""
    value = json_int(F.col("value"))
    allowed = F.when(value.isin(list(dims)), value)
    configured = settings.where(F.col("key") == "default_dim")
    return configured.agg(F.coalesce(F.max(allowed), F.lit(fallback)).alias("default_dim"))


def default_dim_value(settings: DataFrame, dims: Sequence[int] = DIMS, fallback: int = FALLBACK_DIM) -> int:
    """The default width as a number, for choosing columns while a plan is built."""
    return default_dim(settings, dims, fallback).first()[0]


def spec_for(models: DataFrame, dim: int, dims: Sequence[int] = DIMS, **options) -> EmbedSpec:
    """Embedder choice of one width from the model registry."""
    row = models.where(F.col("dim") == dim).select("provider", "model").first()
    if row is None:
        raise ValueError(f"no model registered for dim {dim}")
    return EmbedSpec(dim, row.provider, row.model, dims=tuple(dims), **options)
