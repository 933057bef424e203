"""Quality by importance resampling with hashed n-gram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemolake.llm.common import ascii_words, byte_texts, id_text, named, stage

_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_buckets(text: bytes, buckets: int) -> np.ndarray:
    """Buckets of all words and word pairs of a text; ``buckets`` is a power of two."""
    words = ascii_words(text)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    pairs = (h[:-1] * _MIX) ^ h[1:]
    pairs ^= pairs >> np.uint64(29)
    return (np.concatenate((h, pairs * _MIX >> np.uint64(7))) & np.uint64(buckets - 1)).astype(np.int64)


def gram_counts(rows: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket counts of all texts and of the target's, of ``rows (text, target)``; sums of ``buckets`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for text, own in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                c = np.bincount(gram_buckets(text, buckets), minlength=buckets)
                raw += c
                if own:
                    target += c
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"])

    sums = rows.select("text", "target").mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in sums.collect():
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return raw, target


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = 4096, few: int = 10_000) -> float:
    """The exact ``k``-th largest value, by histograms of ever smaller ranges; at most ``few`` values are collected."""
    ends = rows.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    lo, hi = ends["lo"], ends["hi"]
    while lo < hi:
        inside = rows.where(F.col(column).between(lo, hi))
        width = (hi - lo) / bins
        slot = F.least(F.lit(bins - 1), F.floor((F.col(column) - lo) / width)) if width > 0 else F.lit(0)
        slots = inside.groupBy(slot.cast("int").alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
        for s in sorted(slots.collect(), key=lambda s: -s["slot"]):
            if s["n"] >= k:
                break
            k -= s["n"]
        lo, hi = s["lo"], s["hi"]
        if s["n"] <= few:
            own = rows.where(F.col(column).between(lo, hi)).select(column).collect()
            return sorted((r[0] for r in own), reverse=True)[k - 1]
    return lo


def resample(
    docs: DataFrame, labels: DataFrame, share: float | None = None, buckets: int = 1 << 14, sample: int = 20_000, temperature: float = 0.05,
    seed: int = 11, folds: int = 5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> DataFrame:
    """Documents kept by Gumbel top-k on the log ratio of a target to the raw text model.

    Both models are bags of hashed words and word pairs. The raw model counts all documents, the target model the
    documents labelled 1, of which at most ``sample`` are used, those with the smallest hash of the id; labels of
    documents whose crc32 of the id is divisible by ``folds`` are never read. A document's weight is its mean log
    ratio per n-gram over ``temperature``, to which a Gumbel number drawn from a hash of id, text and seed is
    added. The ``share`` of rows with the largest sums is kept; without a share, that of label 1 among the labels.

    One row per document: ``doc_id, log_ratio, gumbel_key, kept``. Null and empty texts have ratio 0. Rows equal in
    id and text share their fate, so ties at the limit are all kept. Null ids are drawn by their text. Without
    labels of 1 all ratios are 0.
    """
    usable = labels.where(named(id_col).isNotNull() & named(label_col).isin(0, 1) & (F.crc32(named(id_col).cast("string").cast("binary")) % folds != 0))
    marks = usable.groupBy(named(id_col).cast("long").alias("_id")).agg(F.max(named(label_col).cast("int")).alias("_one"))
    if share is None:
        seen = marks.agg(F.avg("_one").alias("a")).first()["a"]
        share = 0.5 if seen is None else seen
    chosen = marks.where("_one = 1").orderBy(F.xxhash64("_id"), "_id").limit(sample).select("_id")
    plain = id_text(docs, id_col, text_col)
    marked = plain.join(F.broadcast(chosen.withColumn("target", F.lit(True))), F.col("doc_id") == F.col("_id"), "left")
    raw, target = gram_counts(marked.select("text", F.coalesce("target", F.lit(False)).alias("target")), buckets)
    ratio = np.zeros(buckets)
    if target.sum():
        ratio = np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [gram_buckets(t, buckets) for t in byte_texts(batch.column(1))]
            values = [float(ratio[b].mean()) if len(b) else 0.0 for b in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(values, pa.float64())], names=["doc_id", "h", "log_ratio"])

    hashed = plain.select("doc_id", "text", F.xxhash64("doc_id", "text", F.lit(seed)).alias("h"))
    weighed = hashed.mapInArrow(weigh, "doc_id long, h long, log_ratio double")
    uniform = (F.shiftrightunsigned("h", 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    keyed = stage(weighed.select("doc_id", "log_ratio", (F.col("log_ratio") / temperature - F.log(-F.log(uniform))).alias("gumbel_key")))
    k = round(share * keyed.rows)
    limit = float("inf") if k < 1 else kth_largest(keyed.df, "gumbel_key", k)
    return keyed.df.withColumn("kept", F.col("gumbel_key") >= limit)
