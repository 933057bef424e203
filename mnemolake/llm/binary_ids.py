"""Token ids in files of word-aligned Simple-8b blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mnemolake.llm.common import id_text, text_parts
from mnemolake.llm.token_ids import encoder

#: Fixed values of the format: ids per word and bits per id of the selectors 1 to 14. Selector 15 marks an escape,
#: whose payload is a position in the block's list of escaped ids. Selector 0 isn't used.
SELECTORS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
ESCAPE = 15
STRIDE = 1024
_U = np.uint64

BLOCKS = (
    "shard int, block int, before long, n_ids long, doc_ids array<long>, doc_sizes array<long>, "
    "words binary, word_starts binary, escapes binary"
)
_BLOCK_SCHEMA = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_sizes", pa.list_(pa.int64())), ("words", pa.binary()), ("word_starts", pa.binary()), ("escapes", pa.binary()),
])


#: Window sizes, each made of two smaller ones.
_WINDOWS = ((2, 1), (3, 2), (4, 2), (5, 4), (6, 4), (7, 4), (8, 4), (10, 8), (12, 8), (15, 8), (20, 10), (30, 15), (60, 30))


def _needs(v: np.ndarray) -> np.ndarray:
    """Number of selector widths that are too narrow for each id."""
    return sum(((v >> _U(bits) != 0) for _, bits in SELECTORS), np.zeros(len(v), np.uint8)).astype(np.uint8)


_SMALL = _needs(np.arange(1 << 16, dtype=_U))


def _need(v: np.ndarray) -> np.ndarray:
    """The same, from a table for ids of up to 16 bits."""
    need = _SMALL[v.astype(np.uint16)]
    large = np.flatnonzero(v >> _U(16))
    need[large] = _needs(v[large])
    return need


def encode_block(ids: np.ndarray, stride: int = STRIDE) -> tuple[bytes, bytes, bytes]:
    """Words, position of each stride's first word, and escaped ids of one block.

    Each word takes as many of the next ids as fit; no word reaches into the next stride of ``stride`` ids, so
    strides can be decoded on their own. All strides are walked in step, so encoding is vectorised too.
    """
    v = np.ascontiguousarray(ids, _U)
    n = len(v)
    if not n:
        return b"", b"", b""
    need = _need(v)  # the position in SELECTORS of the narrowest width that holds each id
    at = np.arange(n, dtype=np.int32)
    left = np.minimum(stride - at % stride, n - at)
    take = np.ones(n, np.uint8)
    pick = np.full(n, len(SELECTORS), np.uint8)
    widest = {1: need}  # the largest need among the next so many ids
    for count, a in _WINDOWS:
        b = count - a
        widest[count] = np.maximum(widest[a][: n - count + 1], widest[b][a : a + n - count + 1]) if n >= count else need[:0]
    for k, (count, _) in reversed(list(enumerate(SELECTORS, 1))):
        if count > 1 and n >= count:
            ok = (widest[count] < k) & (left[: n - count + 1] >= count)
            np.putmask(take[: n - count + 1], ok, count)
            np.putmask(pick[: n - count + 1], ok, k)
    pick[need == len(SELECTORS)] = ESCAPE
    first = np.zeros(n, bool)
    pos, ends = np.arange(0, n, stride), np.minimum(np.arange(0, n, stride) + stride, n)
    while len(pos):
        first[pos] = True
        pos = pos + take[pos]
        go = pos < ends
        pos, ends = pos[go], ends[go]
    starts = np.flatnonzero(first)
    chosen = pick[starts]
    words = chosen.astype(_U) << _U(60)
    for k, (count, bits) in enumerate(SELECTORS, 1):
        own = np.flatnonzero(chosen == k)
        if len(own):
            word = words[own]
            for j in range(count):
                word |= v[starts[own] + j] << _U(j * bits)
            words[own] = word
    own = np.flatnonzero(chosen == ESCAPE)
    words[own] |= np.arange(len(own), dtype=_U)
    offsets = np.searchsorted(starts, np.arange(0, n, stride)).astype("<u4")
    return words.astype("<u8").tobytes(), offsets.tobytes(), v[starts[own]].astype("<u8").tobytes()


def decode_words(words: bytes, escapes: bytes) -> np.ndarray:
    """All ids of the given words, in order, as unsigned 64-bit integers."""
    w = np.frombuffer(words, "<u8").astype(_U, copy=False)
    chosen = (w >> _U(60)).astype(np.int64)
    counts = np.array([0, *[c for c, _ in SELECTORS], 1])[chosen]
    to = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), _U)
    for k, (count, bits) in enumerate(SELECTORS, 1):
        own = np.flatnonzero(chosen == k)
        if len(own):
            mask = _U((1 << bits) - 1)
            for j in range(count):
                out[to[own] + j] = (w[own] >> _U(j * bits)) & mask
    own = np.flatnonzero(chosen == ESCAPE)
    if len(own):
        out[to[own]] = np.frombuffer(escapes, "<u8")[(w[own] & _U((1 << 60) - 1)).astype(np.int64)]
    return out


def decode_stride(words: bytes, word_starts: bytes, escapes: bytes, stride: int) -> np.ndarray:
    """Ids of one stride alone, found by the block's offsets."""
    starts = [*np.frombuffer(word_starts, "<u4").tolist(), len(words) // 8]
    return decode_words(words[8 * starts[stride] : 8 * starts[stride + 1]], escapes)


def write_ids(
    docs: DataFrame, path: str, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2, block_ids: int = 1 << 18,
    known_words: int = 300_000, keep_words: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> None:
    """Encode whole texts and write their ids to ``path`` in ascending order of the document id.

    One range shuffle by id, text hash and place in the input, so that equal rows are split like others; each range is one file and a row of it one block of about ``block_ids`` ids: whole
    documents' ids as Simple-8b words, the offsets of its strides, its escapes, ids and sizes of its documents, and
    the ids before it in the file. Blocks lie in Parquet, so that Spark's committer handles lost executors and any
    store works. ``known_words`` and ``keep_words`` as in ``pack``. An empty table gives no blocks. Null ids come first, null and empty texts are the end id alone, ties of an id are ordered by text
    hash, repeated rows are written once each.
    """
    end = np.array([end_id], "<u4").tobytes()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, shard = encoder(vocabulary, known_words, keep_words), TaskContext.get().partitionId()
        block, before, held, keys, parts = 0, 0, 0, [], []

        def close() -> pa.RecordBatch:
            flat = np.frombuffer(b"".join(parts), "<u4")
            row = [shard, block, before, held, keys, [len(p) // 4 for p in parts], *encode_block(flat)]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _BLOCK_SCHEMA, strict=True)], schema=_BLOCK_SCHEMA)

        for batch in batches:
            for part, own in text_parts(batch, 1, 1 << 17):
                for doc, data in zip(part.column(0).to_pylist(), map(ids.encode, own), strict=True):
                    keys.append(doc)
                    parts.append(data + end)
                    held += len(parts[-1]) // 4
                    if held >= block_ids:
                        yield close()
                        block, before, held, keys, parts = block + 1, before + held, 0, [], []
        if keys:
            yield close()

    rows = id_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("row")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select("doc_id", "text").mapInArrow(blocks, BLOCKS).write.option("compression", "zstd").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files.

    ``start`` counts the ids of all documents before it. It needs one sum per file; those few rows alone are
    ordered in one place.
    """
    files = spark.read.schema(BLOCKS).parquet(path)
    sums = files.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("shard", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, before, keys, sizes, words, escapes = (c[row].as_py() for c in batch.columns)
                data = memoryview(decode_words(words, escapes).astype("<u4").tobytes())
                ends = np.cumsum(np.asarray(sizes, np.int64))
                crcs = [zlib.crc32(data[4 * (e - s) : 4 * e]) for s, e in zip(sizes, ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(keys), pa.int32()), pa.array(keys, pa.int64()),
                        pa.array(ends - np.asarray(sizes) + before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64()),
                    ],
                    names=["shard", "doc_id", "_in_file", "n_tokens", "ids_crc32"],
                )

    docs = files.select("shard", "before", "doc_ids", "doc_sizes", "words", "escapes").mapInArrow(
        decode, "shard int, doc_id long, _in_file long, n_tokens long, ids_crc32 long"
    )
    start = (F.col("_base") + F.col("_in_file")).alias("start")
    return docs.join(bases, "shard").select("doc_id", start, "n_tokens", "ids_crc32")
