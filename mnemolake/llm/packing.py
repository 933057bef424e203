"""Packing of documents into token sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemolake.llm.common import id_text, stage, text_parts
from mnemolake.llm.token_ids import encoder

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of every item; ``lengths`` come in falling order and fit a bin.

    A tournament tree keeps the largest free room below each node, so the leftmost bin with room is found in one
    walk from the root.
    """
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - room[node])
        room[node] -= length
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def cut_documents(
    docs: DataFrame, capacity: int = 2048, vocabulary: str = "byte_bpe_50k.json", end_id: int = 1,
    known_words: int = 300_000, keep_words: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of every document, which ends with ``end_id``."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(vocabulary, known_words, keep_words)
        for batch in batches:
            rows = []
            for part, own in text_parts(batch, 1, 1 << 17):
                for doc, data in zip(part.column(0).to_pylist(), map(ids.encode, own), strict=True):
                    view = memoryview(data + end)
                    n = len(view) // 4
                    for s in range(0, n, capacity):
                        piece = view[4 * s : 4 * (s + capacity)]
                        rows.append((doc, s, len(piece) // 4, zlib.crc32(piece), n))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f"c{i}" for i in range(5)])

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in cut(batches):
            yield b.rename_columns(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return id_text(docs, id_col, text_col).mapInArrow(renamed, PIECES)


def pack(
    docs: DataFrame, capacity: int = 2048, vocabulary: str = "byte_bpe_50k.json", end_id: int = 1,
    group_pieces: int = 16384, seed: int = 17, known_words: int = 300_000, keep_words: bool = False, id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """First-fit decreasing of all pieces, in randomised groups of about ``group_pieces`` each.

    Texts are tokenised once, where they lie; only narrow piece rows are staged and shuffled. A piece's group is a
    hash of its place among the staged rows, so neither one very long document nor equal rows fill a group, and the
    number of groups follows the number of pieces. Each group packs on its own. A tokenising task remembers twice
    ``known_words`` words at most, some 200 bytes each; with ``keep_words`` its Python worker keeps them for later tasks.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. Null and empty texts
    are the end id alone. Repeated rows are packed once each. A null id stays null. An empty table gives no rows.
    """
    if capacity < 1 or group_pieces < 1:
        raise ValueError("capacity and group_pieces must be positive")
    cut = cut_documents(docs, capacity, vocabulary, end_id, known_words, keep_words, id_col, text_col)
    pieces = stage(cut.withColumn("_row", F.monotonically_increasing_id()))
    groups = max(1, -(-pieces.rows // group_pieces))
    group = F.pmod(F.xxhash64("_row", F.lit(seed)), F.lit(groups))

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        number = table.column("_group")[0].as_py()
        bins, offsets = first_fit_decreasing(table.column("length").to_pylist(), capacity)
        ids = pa.array(np.asarray(bins, np.int64) + (number << 32))
        table = table.drop_columns(["_group", "_row"])
        return table.append_column("sequence_id", ids).append_column("offset", pa.array(offsets, pa.int64()))

    return pieces.df.withColumn("_group", group).groupBy("_group").applyInArrow(fill, PACKED)
