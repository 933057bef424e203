"""Near-duplicate groups by SimHash fingerprints and a binary trie self-join."""

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mnemolake.llm.common import byte_texts, id_text, named, space_words, stage
from mnemolake.llm.components import connected_components

SEED = 42
#: Fingerprints that a task joins at a time, if no single bucket holds more.
RUN_ROWS = 1 << 19
_U = np.uint64


def fingerprint(text: bytes, shingle: int = 3, chunk: int = 1 << 15) -> int:
    """64-bit SimHash: a bit is set if it is in over half of the shingles' hashes; no words give zero."""
    words = space_words(text)
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[: -shingle] + 1)).tolist()
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter((hashed(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)), _U, len(starts))
    counts = np.zeros(64, np.int64)
    for lo in range(0, len(h), chunk):
        bits = np.unpackbits(h[lo : lo + chunk].astype(">u8").view(np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h)).tobytes(), "big")


def fingerprints(column, shingle: int = 3):
    """Column of signed 64-bit fingerprints of a text column."""

    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            values = [fingerprint(t, shingle) for t in byte_texts(texts)]
            yield pa.array(np.array(values, _U).view(np.int64))

    return F.arrow_udf(hashed, "long")(column.cast("string"))


class _Forest:
    """Keeps of many links only those that join two groups."""

    def __init__(self, n: int):
        self.up = array("q", range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def trie_links(values: np.ndarray, depth: int, budget: int, leaf: int = 64, step: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted distinct 64-bit values that agree in their first ``depth`` bits and differ in ``budget`` at most.

    The sorted values are a binary trie: a node is a range of them. Pairs of nodes go down together, each pair
    with the number of bits in which it differs so far; pairs beyond the budget are dropped with all below them.
    Pairs of at most ``leaf`` combinations are compared outright. Work proceeds depth first in steps of at most
    ``step`` pairs of nodes, so memory stays bounded however many pairs there are.
    """
    v = np.ascontiguousarray(values, _U)
    if len(v) < 2:
        return
    head = v >> _U(64 - depth) if depth else np.zeros(len(v), _U)
    cuts = np.concatenate(([0], np.flatnonzero(head[1:] != head[:-1]) + 1, [len(v)]))
    lo, hi = cuts[:-1], cuts[1:]
    wide = hi - lo > 1
    lo, hi = lo[wide], hi[wide]
    zero = np.zeros(len(lo), np.int64)
    todo = [(depth, lo[k : k + step], hi[k : k + step], lo[k : k + step], hi[k : k + step], zero[k : k + step]) for k in range(0, len(lo), step)]
    while todo:
        d, ul, uh, vl, vh, err = todo.pop()
        size = (uh - ul) * (vh - vl)
        small = size <= leaf if d < 64 else np.ones(len(size), bool)
        if small.any():
            a, an, b, bn = ul[small], (uh - ul)[small], vl[small], (vh - vl)[small]
            total = an * bn
            reach = np.cumsum(total)
            for k in range(0, int(reach[-1]), step * leaf):
                c = np.arange(k, min(k + step * leaf, int(reach[-1])))
                p = np.searchsorted(reach, c, "right")
                o = c - (reach[p] - total[p])
                i, j = a[p] + o // bn[p], b[p] + o % bn[p]
                near = (i < j) & (np.bitwise_count(v[i] ^ v[j]) <= budget)
                yield i[near], j[near]
        big = ~small
        if not big.any():
            continue
        ul, uh, vl, vh, err = ul[big], uh[big], vl[big], vh[big], err[big]
        bit = _U(63 - d)
        um = np.searchsorted(v, ((v[ul] >> bit) | _U(1)) << bit)
        vm = np.searchsorted(v, ((v[vl] >> bit) | _U(1)) << bit)
        um, vm = np.clip(um, ul, uh), np.clip(vm, vl, vh)
        same = ul == vl
        cross = ~same
        nexts = [
            (ul, um, vl, vm, err),
            (um, uh, vm, vh, err),
            (ul, um, vm, vh, err + 1),
            tuple(x[cross] for x in (um, uh, vl, vm, err + 1)),
        ]
        ul, uh, vl, vh, err = (np.concatenate(x) for x in zip(*nexts, strict=True))
        live = (err <= budget) & (uh > ul) & (vh > vl) & ~((ul == vl) & (uh - ul < 2))
        ul, uh, vl, vh, err = ul[live], uh[live], vl[live], vh[live], err[live]
        todo += [(d + 1, *(x[k : k + step] for x in (ul, uh, vl, vh, err))) for k in range(0, len(ul), step)]


def _rotated(v: np.ndarray, by: int) -> np.ndarray:
    return (v << _U(by)) | (v >> _U(64 - by)) if by else v


def fingerprint_links(fps: DataFrame, budget: int = 3) -> DataFrame:
    """Links ``a, b`` that connect the distinct fingerprints of ``fps (fp)`` at ``budget`` or fewer differing bits.

    The 64 bits are cut into ``budget + 1`` blocks. Two fingerprints within the budget agree in one block at least,
    so each travels once per block to the bucket of that block's bits, and a bucket is the subtree of a trie whose
    first bits are that block. Each task joins the tries of its buckets with themselves, bucket after bucket, and
    returns a spanning forest of what it found: at most one row less than it got, however many pairs there are. It
    holds some ``RUN_ROWS`` fingerprints at a time, or one bucket where that is larger: 24 bytes each, the forest
    included. Two fingerprints within the budget are always connected, directly or through others.
    """
    width = 64 // (budget + 1)
    blocks = F.explode(F.array(*[F.lit(k) for k in range(budget + 1)])).alias("block")
    key = F.expr(f"(fp << (block * {width})) | shiftrightunsigned(fp, 64 - block * {width})") if budget else F.col("fp")
    turned = F.when(F.col("block") == 0, F.col("fp")).otherwise(key)
    rows = fps.select("fp", blocks).select("block", turned.alias("turned"))
    bucket = F.shiftrightunsigned("turned", 64 - width)
    dealt = rows.withColumn("bucket", bucket).repartition("block", "bucket").sortWithinPartitions("block", "bucket")

    def linked(block: int, values: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        v = np.unique(np.concatenate(values))
        forest = _Forest(len(v))
        plain = _rotated(v, (64 - block * width) % 64).view(np.int64)
        for i, j in trie_links(v, width, budget):
            kept = [x for x, (p, q) in enumerate(zip(i.tolist(), j.tolist(), strict=True)) if forest.join(p, q)]
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(plain[i[kept]]), pa.array(plain[j[kept]])], names=["a", "b"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, n, room = -1, [], 0, RUN_ROWS
        for b in batches:
            block, turned = b.column(0).to_numpy(), b.column(1).to_numpy().view(_U)
            edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                if lo == hi:
                    continue
                if held and block[lo] != now:
                    yield from linked(now, held)
                    held, n, room = [], 0, RUN_ROWS
                now = int(block[lo])
                held.append(turned[lo:hi])
                n += hi - lo
                if n >= room:  # all buckets but the last one are whole
                    v = np.concatenate(held)
                    heads = v >> _U(64 - width)
                    cut = int(np.argmax(heads == heads[-1]))
                    if cut:
                        yield from linked(now, [v[:cut]])
                    held, n = [v[cut:]], len(v) - cut
                    room = max(RUN_ROWS, 2 * n)
        if held:
            yield from linked(now, held)

    return dealt.select("block", "turned").mapInArrow(join, "a long, b long")


def _groups(keyed: DataFrame, budget: int) -> DataFrame:
    """``fp, root, component_id`` of every distinct fingerprint of ``keyed (doc_id, fp)``."""
    distinct = keyed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = connected_components(fingerprint_links(distinct.select("fp"), budget))
    linked = roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "least")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    own = distinct.join(linked.select("fp", "root"), "fp", "left").join(smallest, "root", "left")
    return own.select("fp", F.coalesce("root", "fp").alias("root"), F.coalesce("component_id", "least").alias("component_id"))


def near_duplicates(docs: DataFrame, budget: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose SimHash fingerprints are linked by steps of ``budget`` or fewer differing bits.

    Texts are hashed where they lie and staged as two numbers each. Copies share a fingerprint and are one node
    from then on, so a group of copies of any size costs one row in the join. One row per document:
    ``doc_id, fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable. Null, empty and blank
    texts have fingerprint zero, linked like any other. Repeated rows get a row each; a null id is left out of
    the smallest id, and a group without any id has a null component. An empty table gives no rows.
    """
    plain = id_text(docs, id_col, text_col)
    keyed = stage(plain.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp"))).df
    groups = _groups(keyed, budget)
    shown = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return keyed.join(groups.drop("root"), "fp").select("doc_id", shown, "component_id")


def one_per_group(docs: DataFrame, budget: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, with one row of each near-duplicate group: that of the smallest id.

    Ties of an id go to the row with the smaller hash of all its columns; rows equal in every column stay once.
    A group without any id keeps one of its rows. Map columns don't take part in that equality. An empty table
    gives no rows. Groups are resolved on three numbers a row; texts move once, in
    the join with the rows to keep.
    """
    hashable = [named(f.name) for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    row_hash = F.xxhash64(*hashable)
    keyed = stage(
        docs.select(
            named(id_col).cast("long").alias("doc_id"), row_hash.alias("row_hash"), fingerprints(named(text_col), shingle).alias("fp")
        )
    ).df
    roots = _groups(keyed, budget).select("fp", "root")
    sized = keyed.groupBy("doc_id", "row_hash", "fp").agg(F.count(F.lit(1)).alias("n"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash", "n")).alias("first")
    first = sized.join(roots, "fp").groupBy("root").agg(least)
    keep = first.select(F.col("first.doc_id").alias("_keep_id"), F.col("first.row_hash").alias("_keep_hash"), F.col("first.n").alias("_keep_n"))
    names = [named(c) for c in docs.columns]
    own = docs.select(F.struct(*names).alias("_row"), named(id_col).cast("long").alias("_id"), row_hash.alias("_hash"))
    kept = own.join(keep, (F.col("_hash") == F.col("_keep_hash")) & F.col("_id").eqNullSafe(F.col("_keep_id")))
    once = kept.where("_keep_n = 1").select("_row")
    repeated = kept.where("_keep_n > 1").groupBy("_hash", "_id").agg(F.first("_row").alias("_row")).select("_row")
    return once.unionByName(repeated).select("_row.*")
