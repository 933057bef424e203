"""A Merkle manifest of a dataset: per-group trees whose leaf positions come from bitmap ranks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mnemolake.llm.common import Staged, named, stage
from mnemolake.operators.staging import balanced_join

#: Ids of one bitmap, and bits of a container number that one step of the directory sums up.
CHUNK_BITS, STEP_BITS = 9, 18
#: Leaves of one slot array.
SLOT_BITS = 10
SLOTS = 1 << SLOT_BITS
_CONTAINER = "tree string, chunk long, n long, bits binary, extra binary"
_BLOCK = "tree string, block long, total long, ids array<long>, digests array<binary>, others array<binary>, top binary"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(values: Sequence[Column]) -> Column:
    """Hex SHA-256 of the values: ``-`` for null, else the bytes of the value's text, a colon and that text."""

    def shown(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*[shown(c) for c in values]).cast("binary"), 256)


def _hash(nodes: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(nodes)).hexdigest().encode()


# Bitmaps and ranks


def pack_lows(lows: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """A container: its distinct ids as a list of 16-bit numbers or, where that is shorter, a bitmap; and repeated ids."""
    size = 1 << CHUNK_BITS
    if 2 * len(lows) < size // 8:
        bits = lows.astype("<u2").tobytes()
    else:
        plane = np.zeros(size, np.uint8)
        plane[lows] = 1
        bits = np.packbits(plane, bitorder="little").tobytes()
    again = counts > 1
    return bits, np.stack([lows[again], counts[again]], axis=1).astype("<i8").tobytes()


def unpack_lows(bits: bytes, extra: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a container and how often each occurs."""
    if len(bits) < (1 << CHUNK_BITS) // 8:
        lows = np.frombuffer(bits, "<u2").astype(np.int64)
    else:
        lows = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
    counts = np.ones(len(lows), np.int64)
    again = np.frombuffer(extra, "<i8").reshape(-1, 2)
    counts[np.searchsorted(lows, again[:, 0])] = again[:, 1]
    return lows, counts


class Ranks:
    """Rank queries on one container: set bits before the word of an id, by a directory, and below it in that word."""

    def __init__(self, bits: bytes, extra: bytes):
        lows, _ = unpack_lows(bits, b"")
        plane = np.zeros(1 << CHUNK_BITS, np.uint8)
        plane[lows] = 1
        self.words = np.packbits(plane, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.directory = np.cumsum(counts) - counts
        again = np.frombuffer(extra, "<i8").reshape(-1, 2)
        self.repeated = again[:, 0]
        self.more = np.concatenate(([0], np.cumsum(again[:, 1] - 1)))

    def __call__(self, lows: np.ndarray) -> np.ndarray:
        """Number of rows whose id in this container is smaller."""
        word, bit = lows >> 6, (lows & 63).astype(np.uint64)
        below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
        return self.directory[word] + below + self.more[np.searchsorted(self.repeated, lows)]


def containers(rows: DataFrame) -> Staged:
    """``tree, chunk, n, bits, extra`` of ``rows (tree, chunk, low)``: the ids of every tree as merged bitmaps.

    Tasks send bitmaps, not ids; repeated ids are counted before the shuffle. What meets in one place are the partial
    bitmaps of one chunk of ids, so neither a large tree nor an id that very many rows hold is a hot group.
    """

    def packed(tree, chunk: int, lows: np.ndarray, counts: np.ndarray) -> tuple:
        own, at = np.unique(lows, return_inverse=True)
        total = np.bincount(at, counts, len(own)).astype(np.int64)
        return tree, chunk, int(total.sum()), *pack_lows(own, total)

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
        columns = zip(*found, strict=True) if found else [[]] * 5
        names = ["tree", "chunk", "n", "bits", "extra"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            trees = b.column(0).dictionary_encode()
            code, chunk = trees.indices.to_numpy(), b.column(1).to_numpy()
            low, names = b.column(2).to_numpy(), trees.dictionary.to_pylist()
            order = np.lexsort((chunk, code))
            code, chunk, low = code[order], chunk[order], low[order]
            cut = np.flatnonzero((code[1:] != code[:-1]) | (chunk[1:] != chunk[:-1])) + 1
            ends = [0, *cut.tolist(), len(low)]
            yield batch_of([
                packed(names[code[a]], int(chunk[a]), low[a:z], np.ones(z - a)) for a, z in zip(ends, ends[1:], strict=False)
            ])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for b in batches:
                yield from zip(*(b.column(k).to_pylist() for k in (0, 1, 3, 4)), strict=True)

        found = []
        for (tree, chunk), same in groupby(each(), itemgetter(0, 1)):
            parts = [unpack_lows(x[2], x[3]) for x in same]
            found.append(packed(tree, chunk, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])))
            if len(found) == 4096:
                yield batch_of(found)
                found = []
        yield batch_of(found)

    local = rows.select("tree", "chunk", "low").mapInArrow(partial, _CONTAINER)
    dealt = local.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk")
    return stage(dealt.mapInArrow(merge, _CONTAINER), repeated=F.coalesce(F.sum((F.octet_length("extra") > 0).cast("long")), F.lit(0)))


def directory(found: DataFrame) -> DataFrame:
    """The containers with ``base``, the rows of their tree in chunks before them, and the tree's ``total``.

    Counts are summed over spans of chunks, and spans of spans, so that no window holds more than 2**18 rows (2**19
    of the widest spans of one tree), however large a tree is and however its ids are spread.
    """

    def running(df: DataFrame, by: Sequence[str], at: str, name: str) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.coalesce(F.sum("n").over(w), F.lit(0)))

    spans = found.select("*", F.shiftright("chunk", STEP_BITS).alias("span"))
    first = spans.groupBy("tree", "span").agg(F.sum("n").alias("n")).withColumn("wide", F.shiftright("span", STEP_BITS))
    second = first.groupBy("tree", "wide").agg(F.sum("n").alias("n"))
    totals = second.groupBy("tree").agg(F.sum("n").alias("total"))
    second = running(second, ["tree"], "wide", "_c").select("tree", "wide", "_c").join(totals, "tree")
    first = running(first, ["tree", "wide"], "span", "_b").select("tree", "span", "wide", "_b").join(second, ["tree", "wide"])
    spans = running(spans, ["tree", "span"], "chunk", "_a").join(first, ["tree", "span"])
    return spans.select("tree", "chunk", "bits", "extra", (F.col("_a") + F.col("_b") + F.col("_c")).alias("base"), "total")


def positions(rows: DataFrame, index: DataFrame) -> DataFrame:
    """``rows (tree, chunk, low, ...)`` with ``pos`` and ``total``: rank queries on the bitmaps, nothing is sorted by id.

    Rows meet the container of their chunk in the same task, right behind it.
    """
    extra = [c for c in rows.columns if c not in ("tree", "chunk", "low")]
    asked = rows.select("tree", "chunk", F.lit(1).alias("kind"), "low", *extra)
    given = index.select("tree", "chunk", F.lit(0).alias("kind"), "bits", "extra", "base", F.col("total").alias("total"))
    both = given.unionByName(asked, allowMissingColumns=True)
    dealt = both.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "kind")
    dealt = dealt.select("tree", "chunk", "kind", "bits", "extra", "base", "total", "low", *extra)
    schema = rows.select("tree", *extra, F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("total")).schema
    names = schema.names

    def query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, base, total = None, 0, 0
        for b in batches:
            heads = [*np.flatnonzero(b.column(2).to_numpy() == 0).tolist(), b.num_rows]
            low = b.column(7).fill_null(0).to_numpy()
            pos, totals = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            lo = 0
            for head in heads:
                if head > lo:
                    pos[lo:head], totals[lo:head] = base + ranks(low[lo:head]), total
                if head < b.num_rows:
                    ranks = Ranks(b.column(3)[head].as_py(), b.column(4)[head].as_py())
                    base, total = b.column(5)[head].as_py(), b.column(6)[head].as_py()
                lo = head + 1
            table = pa.RecordBatch.from_arrays([b.column(0), *b.columns[8:], pa.array(pos), pa.array(totals)], names=names)
            yield table.filter(pa.array(b.column(2).to_numpy() == 1))

    return dealt.mapInArrow(query, schema)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``number``, their place in the given order, by ranges and their counts."""
    own = F.monotonically_increasing_id()
    held = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_own", own)).df
    part = F.shiftright("_own", 33)
    counts = held.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_own").bitwiseAND((1 << 33) - 1)
    return held.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn("number", place).drop("_part", "_own", "_before")


def _repeated(leaves: DataFrame, found: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The leaves whose id their tree holds once, and the others with their positions: by digest, then row."""

    def lows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tree, chunk, extra in zip(*(c.to_pylist() for c in b.columns), strict=True):
                low = np.frombuffer(extra, "<i8").reshape(-1, 2)[:, 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree] * len(low), pa.string()), pa.array([chunk] * len(low), pa.int64()), pa.array(low, pa.int64())],
                    names=["tree", "chunk", "low"],
                )

    again = found.where(F.octet_length("extra") > 0).select("tree", "chunk", "extra")
    ids = again.mapInArrow(lows, "tree string, chunk long, low long")
    key = F.concat_ws(":", "chunk", "low", "tree").alias("key")
    starts = stage(positions(ids.withColumn("key", key), index).select("key", "total", F.col("pos").alias("start")))
    keyed = leaves.withColumn("key", key)
    marked = balanced_join(keyed, starts.df, "key", "left", right_small=starts.small)
    once = marked.where(F.col("start").isNull()).select(leaves.columns)
    rows = numbered(marked.where(F.col("start").isNotNull()), ["tree", "chunk", "low", "digest", "row"])
    least = stage(rows.groupBy("key").agg(F.min("number").alias("_first")))
    placed = balanced_join(rows, least.df, "key", right_small=least.small)
    place = (F.col("start") + F.col("number") - F.col("_first")).alias("pos")
    return once, placed.select("tree", "id", "digest", "other", place, "total")


# Trees


def reduce_nodes(nodes: Sequence[bytes], levels: int | None) -> list[list[bytes]]:
    """All levels above and including ``nodes``: that many, or up to a single node."""
    found = [list(nodes)]
    while len(found) - 1 != levels and (levels is not None or len(found[-1]) > 1):
        now = found[-1]
        found.append([_hash(now[k : k + 2]) for k in range(0, len(now), 2)])
    return found


def slot_paths(levels: list[list[bytes]], tail: bytes) -> list[bytes]:
    """Path of every lowest node: per level ``L`` or ``R`` and the sibling on that side, or ``N``; then the tail."""
    paths = [tail]
    for nodes in reversed(levels[:-1]):
        tokens = [b"L" + nodes[k - 1] if k & 1 else b"R" + nodes[k + 1] if k + 1 < len(nodes) else b"N" for k in range(len(nodes))]
        paths = [token + paths[k >> 1] for k, token in enumerate(tokens)]
    return paths


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    at = 0
    while at < len(path):
        side, sibling = path[at : at + 1], path[at + 1 : at + 65]
        if side == b"N":
            leaf, at = _hash([leaf]), at + 1
        else:
            leaf, at = _hash([sibling, leaf] if side == b"L" else [leaf, sibling]), at + 65
    return leaf


def _height(total: int) -> int | None:
    return SLOT_BITS if total > SLOTS else None


def slot_arrays(nodes: DataFrame) -> Staged:
    """One row per block of nodes (``tree, pos, total, id, digest, other``): the nodes in their slots, and what they reduce to."""

    def fill(table: pa.Table) -> pa.Table:
        slots = table.column("pos").to_numpy() & (SLOTS - 1)
        at = np.empty(len(slots), np.int64)
        at[slots] = np.arange(len(slots))
        table = table.take(pa.array(at))
        total, pos = table.column("total")[0].as_py(), table.column("pos")[0].as_py()
        digests = table.column("digest").to_pylist()
        top = reduce_nodes([d.hex().encode() for d in digests], _height(total))[-1][0]
        row = [
            table.column("tree")[0].as_py(), pos >> SLOT_BITS, total, table.column("id").to_pylist(), digests,
            table.column("other").to_pylist(), bytes.fromhex(top.decode()),
        ]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.binary()]
        names = ["tree", "block", "total", "ids", "digests", "others", "top"]
        return pa.table([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=names)

    blocked = nodes.select("tree", F.shiftright("pos", SLOT_BITS).alias("block"), "pos", "total", "id", "digest", "other")
    widest = F.coalesce(F.max("total"), F.lit(0))
    return stage(blocked.groupBy("tree", "block").applyInArrow(fill, _BLOCK), widest=widest)


def grow(nodes: DataFrame) -> tuple[list[Staged], Staged]:
    """The slot arrays of every level of all trees, lowest first, and ``tree, top`` of the trees."""
    levels = [slot_arrays(nodes)]
    tops = levels[0].df.where(F.col("total") <= SLOTS)
    while levels[-1].seen["widest"] > SLOTS:
        below = levels[-1].df.where(F.col("total") > SLOTS)
        none = F.lit(None)
        up = below.select(
            "tree", F.col("block").alias("pos"), F.expr(f"(total + {SLOTS - 1}) div {SLOTS}").alias("total"),
            none.cast("long").alias("id"), F.col("top").alias("digest"), none.cast("binary").alias("other"),
        )
        levels.append(slot_arrays(up))
        tops = tops.unionByName(levels[-1].df.where(F.col("total") <= SLOTS))
    return levels, stage(tops.select("tree", "top"))


def descend(levels: list[Staged], tails: Staged) -> DataFrame:
    """``tree, pos, id, digest, other, path`` of all lowest nodes; ``tails (tree, path)`` continue the paths of each tree.

    From the top level down every slot array meets the path of the node it reduces to, and hands paths to its slots.
    """

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                tree, block, total, ids, digests, others, tail = (c[k].as_py() for c in b.columns)
                found = reduce_nodes([d.hex().encode() for d in digests], _height(total))
                paths = slot_paths(found, tail)
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tree] * n, pa.string()), pa.array(np.arange(n) + (block << SLOT_BITS)), pa.array(ids, pa.int64()),
                        pa.array(digests, pa.binary()), pa.array(others, pa.binary()), pa.array(paths, pa.binary()),
                    ],
                    names=["tree", "pos", "id", "digest", "other", "path"],
                )

    out = None
    for number, level in reversed(list(enumerate(levels))):
        single = level.df.where(F.col("total") <= SLOTS)
        fed = balanced_join(single, tails.df, "tree", right_small=tails.small)
        if out is not None:
            above = stage(out.select(F.concat_ws(":", "pos", "tree").alias("_key"), "path"))
            wide = level.df.where(F.col("total") > SLOTS).withColumn("_key", F.concat_ws(":", "block", "tree"))
            hint = F.broadcast(above.df) if above.small else above.df
            fed = fed.unionByName(wide.join(hint, "_key").drop("_key"))
        fed = fed.select("tree", "block", "total", "ids", "digests", "others", "path")
        out = fed.mapInArrow(expand, "tree string, pos long, id long, digest binary, other binary, path binary")
    return out


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, group_col: str = "lang", id_col: str = "doc_id", other: Column | None = None) -> DataFrame:
    """A Merkle manifest: one tree per value of ``group_col`` over its rows by id, and one over the groups' roots.

    Leaves are hex SHA-256 digests of ``fields``. Two consecutive nodes (the last one of a level maybe alone) become
    the digest of their hex texts until one is left. Positions are not found by sorting: tasks merge compressed
    bitmaps of each group's ids, directories of counts make rank queries out of them, and every leaf asks for its
    rank. Leaves then lie in slot arrays of 1,024, which reduce ten levels at a time, upwards for the roots and
    downwards for the paths. Only ids, digests and paths move; texts are hashed where they lie.

    One row per document: ``doc_id, group_value, position, leaf, other, path, subroot, root``. ``other`` is a second
    digest per row, if given, that takes no part in the tree. ``path`` goes from the leaf to the root: ``L`` or ``R``
    with the sibling on that side, ``N`` for a node without one; ``fold_path`` folds it. Groups are ordered null first, then by
    the bytes of their text. Within a group null ids come first; rows of one id are ordered by digest, equal rows get
    a leaf each. Nulls, empty and very long texts are digested like any other. An empty table gives no rows; other
    columns are left out.
    """
    spark = docs.sparkSession
    digest = leaf_digest([named(f) for f in fields])
    group = named(group_col).cast("string")
    hashed = docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("tree"),
        named(id_col).cast("long").alias("id"),
        F.unhex(digest).alias("digest"),
        (F.unhex(other) if other is not None else F.lit(None).cast("binary")).alias("other"),
        F.monotonically_increasing_id().alias("row"),
    )
    chunk = F.coalesce(F.shiftright("id", CHUNK_BITS), F.lit(-(1 << (63 - CHUNK_BITS)) - 1)).alias("chunk")
    low = F.coalesce(F.col("id").bitwiseAND((1 << CHUNK_BITS) - 1), F.lit(0).cast("long")).alias("low")
    leaves = stage(hashed).df.select("*", chunk, low)
    found = containers(leaves)
    index = stage(directory(found.df)).df
    if found.seen["repeated"]:
        once, placed = _repeated(leaves, found.df, index)
    else:
        once, placed = leaves, None
    nodes = positions(once.select("tree", "chunk", "low", "id", "digest", "other"), index)
    nodes = nodes if placed is None else nodes.unionByName(placed)
    levels, tops = grow(nodes)
    total = F.lit(tops.rows).cast("long").alias("total")
    ranked = numbered(tops.df, ["tree"]).select(
        F.lit("").alias("tree"), F.col("number").alias("pos"), total, F.col("number").alias("id"),
        F.col("top").alias("digest"), F.encode("tree", "utf-8").alias("other"),
    )
    upper, root = grow(ranked)
    start = stage(spark.createDataFrame([("", bytearray())], "tree string, path binary"))
    groups = descend(upper, start).join(F.broadcast(root.df), "tree")  # one row, the root of all
    tails = stage(groups.select(F.decode("other", "utf-8").alias("tree"), "path", F.col("digest").alias("subroot"), F.col("top").alias("root")))
    named_tails = Staged(tails.df.select("tree", "path"), tails.rows, tails.bytes, tails.seen)
    out = balanced_join(descend(levels, named_tails), tails.df.select("tree", "subroot", "root"), "tree", right_small=tails.small)
    value = F.when(F.col("tree") != "", F.substring("tree", 2, 1 << 30)).alias("group_value")
    shown = [F.lower(F.hex(c)).alias(n) for c, n in (("digest", "leaf"), ("other", "other"), ("subroot", "subroot"), ("root", "root"))]
    return out.select(F.col("id").alias("doc_id"), value, F.col("pos").alias("position"), *shown, F.decode("path", "utf-8").alias("path"))


def proof_digest(path: Column) -> Column:
    """Hex SHA-256 of a path's siblings, from the leaf to the root."""
    return F.sha2(F.translate(path, "LRN", "").cast("binary"), 256)


def fold_path(leaf: Column, path: Column) -> Column:
    """Column of the roots that leaves and their paths lead to; null where one of them is."""

    def folded(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for leaves, paths in batches:
            pairs = zip(leaves.cast(pa.binary()).to_pylist(), paths.cast(pa.binary()).to_pylist(), strict=True)
            yield pa.array([None if a is None or b is None else fold(a, b).decode() for a, b in pairs], pa.string())

    return F.arrow_udf(folded, "string")(leaf, path)
