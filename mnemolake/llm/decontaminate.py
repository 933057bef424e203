"""Finding passages of benchmark items in documents."""

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mnemolake.llm.common import Shared, ascii_words, byte_texts, id_text, named

HITS = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_RANGES = "doc_id long, text_hash long, n_words long, starts array<long>, ends array<long>, items array<string>"


class Windows:
    """Item windows of one block of the benchmark, with the shingle that stands for each.

    Words are numbers in the block's vocabulary, and a shingle of up to three words is one integer: exact up to
    2**21 words, folded into 63 bits beyond, where shingles that share a number cost a comparison of words and no more.
    Windows are grouped by length; a window of one or two words is its own shingle.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], window: int, shingle: int = 3):
        words = [(item, ascii_words(text)) for item, text in items]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in words for w in ws}), 1)}
        self.base = len(self.vocabulary) + 1
        self.items = sorted({item for item, ws in words if ws and item is not None})
        number = {item: k for k, item in enumerate(self.items)}
        found: dict[int, dict[tuple, set]] = {}
        for item, ws in words:
            ids = [self.vocabulary[w] for w in ws]
            size = min(window, len(ids))
            for s in range(len(ids) - size + 1 if size else 0):
                owners = found.setdefault(size, {}).setdefault(tuple(ids[s : s + size]), set())
                if item is not None:
                    owners.add(number[item])
        self.groups = []
        for size, owners in sorted(found.items()):
            rows = np.array(list(owners), np.int64).reshape(-1, size)
            self.groups.append({"size": size, "shingle": min(shingle, size), "rows": rows, "owners": [sorted(o) for o in owners.values()]})

    def keys(self, ids: np.ndarray, shingle: int) -> np.ndarray:
        """Shingle numbers at every position along the last axis; 0 where a word isn't in the vocabulary."""
        n = ids.shape[-1] - shingle + 1
        if n <= 0:
            return np.zeros((*ids.shape[:-1], 0), np.int64)
        key, known = ids[..., :n].copy(), ids[..., :n] > 0
        for j in range(1, shingle):
            part = ids[..., j : j + n]
            key = key * self.base + part
            known &= part > 0
        return np.where(known, np.maximum(key & np.int64((1 << 63) - 1), 1), 0)

    def numbers(self, text: bytes) -> np.ndarray:
        words = ascii_words(text)
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))

    def shingles(self) -> dict[int, np.ndarray]:
        """All shingles by their length, sorted."""
        out: dict[int, list] = {}
        for g in self.groups:
            out.setdefault(g["shingle"], []).append(np.unique(self.keys(g["rows"], g["shingle"])))
        return {k: np.unique(np.concatenate(v)) for k, v in out.items()}

    def order(self, counts: dict[int, np.ndarray]) -> None:
        """Choose every window's prefix: for whole containment one shingle is enough, the rarest in the corpus."""
        all_shingles = self.shingles()
        for g in self.groups:
            keys = self.keys(g["rows"], g["shingle"])
            rarity = counts[g["shingle"]][np.searchsorted(all_shingles[g["shingle"]], keys)]
            at = np.argmin(rarity, axis=1)
            prefix = keys[np.arange(len(keys)), at]
            by = np.argsort(prefix, kind="stable")
            g["prefix"], g["at"], g["rows"], g["owners"] = prefix[by], at[by], g["rows"][by], [g["owners"][k] for k in by]

    def search(self, ids: np.ndarray, room: int = 1 << 20) -> tuple[list[int], list[int], set[int]]:
        """Starts and ends of all occurring windows, and their items."""
        starts, ends, items = [], [], set()
        for g in self.groups:
            size = g["size"]
            keys = self.keys(ids, g["shingle"])
            lo, hi = np.searchsorted(g["prefix"], keys), np.searchsorted(g["prefix"], keys, "right")
            pos = np.flatnonzero((hi > lo) & (keys > 0))
            reach = np.concatenate(([0], np.cumsum((hi - lo)[pos])))
            for a in range(0, int(reach[-1]), room):
                c = np.arange(a, min(a + room, int(reach[-1])))
                k = np.searchsorted(reach, c, "right") - 1
                window = lo[pos[k]] + c - reach[k]
                start = pos[k] - g["at"][window]
                fits = (start >= 0) & (start + size <= len(ids))  # position and length bounds
                start, window = start[fits], window[fits]
                same = np.ones(len(start), bool)
                for j in range(size):
                    same[same] = ids[start[same] + j] == g["rows"][window[same], j]
                starts += start[same].tolist()
                ends += (start[same] + size).tolist()
                for w in np.unique(window[same]).tolist():
                    items.update(g["owners"][w])
        return starts, ends, items


def _covered(starts: list[int], ends: list[int]) -> int:
    """Words inside at least one range."""
    total, reach = 0, 0
    for s, e in sorted(zip(starts, ends, strict=True)):
        total += max(0, e - max(s, reach))
        reach = max(reach, e)
    return total


def _verdict(n_words: int, starts: list[int], ends: list[int], items: list[str]) -> tuple:
    names = sorted(set(items))
    hit = _covered(starts, ends)
    return n_words, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """Distinct items as text in blocks of about ``block_bytes``, one block at a time on the driver."""
    rows = benchmark.select(named(id_col).cast("string").alias("i"), named(text_col).cast("string").alias("t")).distinct()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first()["n"]
    n = -(-total // block_bytes)
    for k in range(n):
        block = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r["i"], (r["t"] or "").encode()) for r in block.toLocalIterator()]


def _prepared(docs: DataFrame, items: list[tuple[str | None, bytes]], window: int) -> Windows:
    """Windows of a block with prefixes chosen by the shingles' counts over all documents."""
    windows = Windows(items, window)
    shared = Shared(docs.sparkSession, windows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        sorted_keys = w.shingles()
        sums = {s: np.zeros(len(k), np.int64) for s, k in sorted_keys.items()}
        for batch in batches:
            for text in byte_texts(batch.column(0)):
                ids = w.numbers(text)
                for s, known in sorted_keys.items():
                    keys = w.keys(ids, s)
                    keys = keys[keys > 0]
                    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                    sums[s] += np.bincount(at[known[at] == keys], minlength=len(known))
        for s, total in sums.items():
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), s), pa.int32()), pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["size", "shingle", "n"])

    counts = {s: np.zeros(len(k), np.int64) for s, k in windows.shingles().items()}
    if counts:
        counted = docs.select("text").mapInArrow(count, "size int, shingle long, n long").groupBy("size", "shingle").agg(F.sum("n").alias("n"))
        for row in counted.toLocalIterator():
            counts[row["size"]][row["shingle"]] = row["n"]
    windows.order(counts)
    return windows


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 4 << 20,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """Which words of each document lie in an occurrence of ``window`` consecutive words of a benchmark item.

    Prefix-filtered containment: item windows are sets of word shingles, ordered by rarity over all documents. An
    occurrence must hold every shingle of its window, so the rarest one is a sufficient prefix; where it stands in
    the document fixes the only possible start, which must lie within the document (position and length bounds),
    and there all words are compared. The benchmark is processed in blocks of at most about ``block_bytes``, sent
    to all tasks; documents are never shuffled (with several blocks only ranges of hits are).

    One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``. Null texts have no words.
    Items without words are left out; those without an id count in ``n_hit`` and ``contaminated`` only. Repeated documents get a row each. Equal item ids count once.
    """
    rows = id_text(docs, id_col, text_col)
    shared = []
    for items in benchmark_blocks(benchmark, item_col, item_text_col, block_bytes):
        windows = _prepared(rows, items, window)
        if windows.groups:
            shared.append(Shared(docs.sparkSession, windows))
    if len(shared) <= 1:
        return rows.mapInArrow(_scan(shared, True), f"doc_id long, {HITS}")
    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    parts = [keyed.mapInArrow(_scan([w], False), _RANGES) for w in shared]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    merged = found.groupBy("doc_id", "text_hash").agg(
        F.first("n_words").alias("n_words"), (F.count(F.lit(1)) / len(parts)).cast("int").alias("rows"),
        F.flatten(F.collect_set(F.arrays_zip("starts", "ends"))).alias("ranges"), F.flatten(F.collect_set("items")).alias("items"),
    )
    each = merged.select("doc_id", "n_words", F.col("ranges.starts").alias("starts"), F.col("ranges.ends").alias("ends"), "items", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_verdict(*r) for r in zip(*(batch.column(c).to_pylist() for c in range(1, 5)), strict=True)]
            yield _batch(batch.column(0), out)

    return each.mapInArrow(close, f"doc_id long, {HITS}")


def _batch(ids: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([ids, *map(pa.array, columns, types)], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def _scan(shared: list, final: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = [s.value for s in shared]
        for batch in batches:
            found = []
            for text in byte_texts(batch.column(1)):
                if not windows:
                    found.append((len(ascii_words(text)), [], [], []))
                for w in windows:
                    ids = w.numbers(text)
                    starts, ends, items = w.search(ids)
                    found.append((len(ids), starts, ends, [w.items[k] for k in sorted(items)]))
            if final:
                yield _batch(batch.column(0), [_verdict(*f) for f in found])
            else:
                n, starts, ends, items = zip(*found, strict=True) if found else ([], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))],
                    names=["doc_id", "text_hash", "n_words", "starts", "ends", "items"],
                )

    return scan


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 4 << 20, text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, that hold no occurrence of an item window.

    Same search as :func:`decontaminate`; a null text has no words and stays. Nothing is shuffled.
    """
    rows = docs.select(F.lit(0).cast("long").alias("doc_id"), named(text_col).cast("string").alias("text"))
    kept = docs
    for items in benchmark_blocks(benchmark, "item_id", "text", block_bytes):
        windows = _prepared(rows, items, window)
        if not windows.groups:
            continue
        shared = Shared(docs.sparkSession, windows)

        kept = kept.where(_is_clean(shared)(named(text_col)))
    return kept


def _is_clean(shared: Shared):
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w = shared.value
        for column in batches:
            yield pa.array([not w.search(w.numbers(t))[0] for t in byte_texts(column)], pa.bool_())

    return F.arrow_udf(clean, "boolean")
