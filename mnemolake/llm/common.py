"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemolake.operators.staging import Staged, stage

__all__ = [
    "Shared", "Staged", "ascii_words", "byte_texts", "each_text", "id_text", "named", "parts", "read", "space_words", "stage", "text_parts", "texts",
    "tokenizer_path",
]
#: Bytes of text that a task turns into Python values at a time; a longer text is a part of its own.
PART_BYTES = 1 << 20

#: Bytes that are no word characters become blanks, A-Z become a-z; bytes of 0x80 and above stay.
_WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def named(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col(f"`{name.replace('`', '``')}`")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text; other columns, whatever their names, stay out of the way."""
    return docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))


def ascii_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text after lower-casing A-Z."""
    return text.translate(_WORD_TABLE).split()


def space_words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text after lower-casing A-Z."""
    return text.lower().split()


class Shared:
    """A value sent to every executor once, not with every task; pickled by value like the library's functions."""

    def __init__(self, spark: SparkSession, value):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return cloudpickle.loads(self.sent.value)


def texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def each_text(column: pa.Array) -> Iterator[str]:
    """The texts of a column, null as empty; only a part of bounded bytes is turned into Python values at a time."""
    for lo, n in parts(column):
        yield from texts(column.slice(lo, n))


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """The same as UTF-8 bytes."""
    for lo, n in parts(column):
        yield from (t or b"" for t in column.slice(lo, n).cast(pa.binary()).to_pylist())


def parts(column: pa.Array, size: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """First row and number of rows of each part of a text column, about ``size`` bytes each."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    lo = total = 0
    for k, n in enumerate(lengths.tolist()):
        if k > lo and total + n > size:
            yield lo, k - lo
            lo, total = k, 0
        total += n
    if lo < len(lengths):
        yield lo, len(lengths) - lo


def text_parts(batch: pa.RecordBatch, text: int, size: int = PART_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch with the texts of column number ``text``, about ``size`` bytes each."""
    for lo, n in parts(batch.column(text), size):
        part = batch.slice(lo, n)
        yield part, texts(part.column(text))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public vocabulary file on this machine; looked up again on each executor."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
