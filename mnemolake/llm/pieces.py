"""SentencePiece BPE: texts to ids by vectorised merge rounds, and ids back to texts."""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemolake.llm.common import id_text, text_parts, tokenizer_path

_SPACE = "▁"
_WORDS = re.compile(f"{_SPACE}+[^{_SPACE}]*")
#: Fixed values of the model format: kinds of pieces, and the model kind of BPE.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE, _BPE = 1, 2, 3, 6, 2
#: Ranks of pairs that no piece holds side by side, and of pairs that stand in a piece without being one.
_APART, _NEVER = np.int32(2**31 - 1), np.int32(2**31 - 2)
_UNSEEN, _GONE = -1, -2
_LONG = 4096

codecs.register_error("one_each", lambda e: ("�" * (e.end - e.start), e.end))


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        if tag & 7 == 0:
            value, at = _varint(data, at)
        else:
            size, at = _varint(data, at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class PieceModel:
    """A BPE model with byte fallback and without normalisation, as arrays."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            parts = list(_fields(f.read()))
        rows = [dict(_fields(v)) for n, v in parts if n == 1]
        trainer = dict(x for n, v in parts if n == 2 for x in _fields(v))
        rules = dict(x for n, v in parts if n == 3 for x in _fields(v))
        self.pieces = [r[1].decode() for r in rows]
        self.kinds = [r.get(3, _NORMAL) for r in rows]
        scores = [struct.unpack("<f", r[2])[0] if 2 in r else 0.0 for r in rows]
        plain = not rules.get(2) and not rules.get(4, 1) and rules.get(5, 1) and rules.get(3, 1) and not trainer.get(24, 0)
        if trainer.get(3) != _BPE or not trainer.get(35) or not plain or not set(self.kinds) <= {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only BPE models with byte fallback, a leading space mark and no other normalisation are supported")
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self._merges(scores)
        self._bytes()

    def _merges(self, scores: list[float]) -> None:
        normal = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == _NORMAL}
        self.inner_space = any(_SPACE in p.lstrip(_SPACE) for p in normal)
        symbols = dict(normal)
        for c in sorted(set(chain.from_iterable(normal)) - set(normal)):
            symbols[c] = len(self.pieces) + len(symbols) - len(normal)
        self.width = max(symbols.values(), default=0) + 1
        order = {s: k for k, s in enumerate(sorted({scores[i] for i in normal.values()}, reverse=True))}
        rank = {p: order[scores[i]] for p, i in normal.items()}
        pairs: dict[int, tuple[int, int]] = {}
        early = np.zeros(self.width, bool)
        for p in normal:
            for a, b in zip(p, p[1:], strict=False):
                pairs.setdefault(symbols[a] * self.width + symbols[b], (_NEVER, 0))
        for p, i in normal.items():
            for k in range(1, len(p)):
                a, b = p[:k], p[k:]
                if a in symbols and b in symbols:
                    pairs[symbols[a] * self.width + symbols[b]] = (rank[p], i)
                    for part in (a, b):  # a merge of this part can make room for one that has to come before its equals
                        if rank.get(part, -1) >= rank[p]:
                            early[symbols[part]] = True
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()] + [_APART], np.int32)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()] + [0], np.int32)
        self.early = early
        self.of_char = np.full(0x110000, _UNSEEN, np.int32)
        for p, i in symbols.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i

    def _bytes(self) -> None:
        self.byte_ids = np.zeros(256, np.uint32)
        data = []
        for i, (p, kind) in enumerate(zip(self.pieces, self.kinds, strict=True)):
            if kind == _BYTE:
                value = int(p[3:5], 16)
                self.byte_ids[value] = i
                data.append(bytes([value]))
            else:
                data.append({_CONTROL: "", _UNKNOWN: " ⁇ "}.get(kind, p.replace(_SPACE, " ")).encode())
        self.sizes = np.array([len(d) for d in data], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(data), np.uint8)
        self.leads = np.array([k == _NORMAL and p.startswith(_SPACE) for p, k in zip(self.pieces, self.kinds, strict=True)])
        self.silent = np.array([k == _CONTROL for k in self.kinds])

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of neighbouring symbols."""
        key = left.astype(np.int64) * self.width + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        at = np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), at, len(self.keys)) if len(self.keys) else at
        return self.ranks[at], self.merged[at]

    def _one_by_one(self, symbols: list[int]) -> list[int]:
        """The merges of one very long run, with a heap: the same result at a cost that hardly grows with its length."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks, merged = self._pairs(np.array(symbols[:-1]), np.array(symbols[1:]))
        heap = [(r, k, symbols[k], symbols[k + 1], m) for k, (r, m) in enumerate(zip(ranks.tolist(), merged.tolist(), strict=True)) if r < _NEVER]
        heapq.heapify(heap)
        known: dict[tuple[int, int], tuple[int, int]] = {}

        def offer(k: int) -> None:
            pair = symbols[k], symbols[after[k]]
            if pair not in known:
                r, m = self._pairs(np.array(pair[:1]), np.array(pair[1:]))
                known[pair] = int(r[0]), int(m[0])
            if known[pair][0] < _NEVER:
                heapq.heappush(heap, (known[pair][0], k, *pair, known[pair][1]))

        while heap:
            _, k, a, b, m = heapq.heappop(heap)
            j = after[k]
            if symbols[k] != a or j >= n or symbols[j] != b:
                continue
            symbols[k], symbols[j] = m, _GONE
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                offer(k)
            if before[k] >= 0:
                offer(before[k])
        return symbols

    def merge(self, symbols: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Symbols after all merges; ``apart`` marks those before which a word begins.

        Words fall into runs wherever two neighbours stand side by side in no piece, as no merge can bridge such a
        place. In every round each run finds its smallest rank, and its leftmost pair of that rank is merged, in all
        runs at once; where no merge that follows can come before an equal one, all leftmost pairs of that rank are.
        Finished runs leave the arrays, until none is left. A symbol that went into its left neighbour becomes -2.
        """
        out = symbols.copy()
        if not len(out):
            return out
        rank = np.full(len(out), _APART, np.int32)
        into = np.zeros(len(out), np.int32)
        rank[:-1], into[:-1] = self._pairs(symbols[:-1], symbols[1:])
        rank[:-1][apart[1:]] = _APART
        run = np.cumsum(np.concatenate(([True], rank[:-1] == _APART))) - 1
        sizes = np.bincount(run)
        for k in np.flatnonzero(sizes > _LONG).tolist():
            lo = int(np.searchsorted(run, k))
            out[lo : lo + sizes[k]] = self._one_by_one(symbols[lo : lo + sizes[k]].tolist())
        at = np.flatnonzero(((sizes > 1) & (sizes <= _LONG))[run])
        sym, rank, into, run = symbols[at], rank[at], into[at], run[at]
        while len(sym):
            first = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
            sizes = np.diff(first, append=len(run))
            best = np.repeat(np.minimum.reduceat(rank, first), sizes)
            hits = np.flatnonzero((rank == best) & (best < _NEVER))
            if not len(hits):
                break
            leftmost = np.concatenate(([True], run[hits[1:]] != run[hits[:-1]]))
            streak = np.concatenate(([True], (hits[1:] != hits[:-1] + 1) | leftmost[1:]))
            place = np.arange(len(hits)) - np.maximum.accumulate(np.where(streak, np.arange(len(hits)), 0))
            calm = np.bitwise_and.reduceat(~self.early[into[hits]], np.flatnonzero(leftmost))[np.cumsum(leftmost) - 1]
            hits = hits[leftmost | (calm & (place % 2 == 0))]
            sym[hits] = into[hits]
            out[at[hits]] = into[hits]
            out[at[hits + 1]] = _GONE
            stay = best < _NEVER
            stay[hits + 1] = False
            fresh = np.zeros(len(sym), bool)
            fresh[hits] = True
            sym, rank, into, run, at, fresh = (x[stay] for x in (sym, rank, into, run, at, fresh))
            fresh[:-1] |= fresh[1:]
            changed = np.flatnonzero(fresh)
            inner = changed[changed + 1 < len(sym)]
            inner = inner[run[inner] == run[inner + 1]]
            rank[changed] = _APART
            rank[inner], into[inner] = self._pairs(sym[inner], sym[inner + 1])
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of every word as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        apart = np.zeros(len(points) + 1, bool)
        apart[ends] = True
        merged = self.merge(self.of_char[points], apart[:-1])
        spelt = (merged == _UNSEEN) | (merged >= len(self.pieces))
        counts = (merged != _GONE).astype(np.int64)
        own = points[spelt]
        counts[spelt] = 1 + (own >= 0x80) + (own >= 0x800) + (own >= 0x10000)
        reach = np.cumsum(counts)
        ids = np.empty(int(reach[-1]), np.uint32)
        kept = ~spelt & (merged != _GONE)
        ids[reach[kept] - 1] = merged[kept]
        last = reach[spelt] - 1
        for size in range(1, 5):
            some = counts[spelt] == size
            p, e = own[some], last[some]
            for k in range(size - 1):  # continuation bytes, last one first
                ids[e - k] = self.byte_ids[0x80 | ((p >> (6 * k)) & 0x3F)]
            lead = p >> (6 * (size - 1))
            ids[e - size + 1] = self.byte_ids[lead | {1: 0, 2: 0xC0, 3: 0xE0, 4: 0xF0}[size]]
        data = ids.astype("<u4").tobytes()
        cuts = [0, *(4 * reach[ends - 1]).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        line = _SPACE + text.replace(" ", _SPACE)
        return [line] if self.inner_space else _WORDS.findall(line)

    def decode(self, data: bytes) -> str:
        """The text of ids; bytes that are no UTF-8 become one replacement sign each."""
        ids = np.frombuffer(data, "<u4").astype(np.int64)
        if len(ids) and ids.max() >= len(self.pieces):
            raise ValueError(f"{ids.max()} is no id of this vocabulary")
        heard = np.flatnonzero(~self.silent[ids])
        if not len(heard):
            return ""
        skip = int(self.leads[ids[heard[0]]])
        gaps = np.flatnonzero(np.diff(heard) > 1) + 1  # begin and end ids part the bytes of a character, too
        ids = ids[heard]
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        text = self.flat[np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + sizes, sizes)].tobytes()
        cuts = [skip, *ends[gaps - 1].tolist(), len(text)]
        return "".join(text[a:b].decode("utf-8", "one_each") for a, b in zip(cuts, cuts[1:], strict=False))


class PieceEncoder:
    """A model with a memory of words, in two generations of at most ``known_words`` each."""

    def __init__(self, vocabulary: str, known_words: int, longest: int = 48):
        self.model = PieceModel(tokenizer_path(vocabulary))
        self.known_words, self.longest = known_words, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.model.words(t) for t in texts]
        found: dict[str, bytes] = {}
        new = []
        for w in set(chain.from_iterable(split)):
            ids = self.young.get(w) or self.old.get(w)
            if ids:
                found[w] = ids
            else:
                new.append(w)
        found.update(zip(new, self.model.encode_words(new), strict=True))
        if len(self.young) + len(found) > self.known_words:
            self.old, self.young = self.young, {}
        self.young.update((w, ids) for w, ids in found.items() if len(w) <= self.longest)
        return [b"".join(map(found.__getitem__, ws)) for ws in split]


def encode_pieces(
    docs: DataFrame, vocabulary: str = "piece_bpe_32k.model", begin: bool = True, end: bool = True,
    known_words: int = 200_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, ids``: whole texts as the sentencepiece library encodes them, little-endian unsigned 32-bit ids.

    The texts of a batch fall into words, and the distinct words a task does not remember are merged together: flat
    arrays of symbols, per round the smallest pair rank of every word, and one step for all of them. Nothing is
    shuffled. A task keeps twice ``known_words`` words at most, for its own duration, and works on about a megabyte
    of texts at a time; a longer text is a step of its own.

    Null and empty texts are the begin and end ids alone. One row per input row, repeated ones too; a null id stays
    null. An empty table gives no rows. Other columns are left out, whatever their names.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(vocabulary, known_words)
        head = np.array([encoder.model.begin] if begin else [], "<u4").tobytes()
        tail = np.array([encoder.model.end] if end else [], "<u4").tobytes()
        for batch in batches:
            for part, texts in text_parts(batch, 1):
                ids = [head + x + tail for x in encoder.encode(texts)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(encode, "doc_id long, ids binary")


def decode_pieces(ids: Column, vocabulary: str = "piece_bpe_32k.model") -> Column:
    """Column of the texts of little-endian unsigned 32-bit ids; null stays null.

    Begin and end ids and the leading space mark leave nothing, bytes that are no UTF-8 one replacement sign each.
    """

    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = PieceModel(tokenizer_path(vocabulary))
        for column in batches:
            yield pa.array([None if x is None else model.decode(x.as_buffer()) if x.is_valid else None for x in column], pa.string())

    return F.arrow_udf(decode, "string")(ids)
