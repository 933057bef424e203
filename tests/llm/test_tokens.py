import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mnemolake.llm.binary_ids import STRIDE, decode_stride, decode_words, encode_block, read_ids, write_ids
from mnemolake.llm.licenses import scan_licenses
from mnemolake.llm.packing import first_fit_decreasing, pack
from mnemolake.llm.token_ids import Encoder
from mnemolake.operators.staging import scratch_path

from . import brute


@pytest.mark.parametrize("text", ["", " ", "a  b   c", "x \n y\n\n z ", "tab\t end", "\u00a0 odd\u2003 blanks \u00a0x", "it's 12 o'clock", "é漢 字", "<|endoftext|> x"])
def test_words_in_a_row_are_the_text(text):
    e, t = Encoder("byte_bpe_50k.json"), brute.tokenizer()
    assert e.encode(text) == e.encode(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=1500, deadline=None)
@given(st.text(st.sampled_from("ab '1._|\n\t \u00a0\u2003éßĞ漢\x1c\x85"), max_size=30))
def test_any_text(text):
    e, t = _encoders()
    assert e.encode(text) == np.array(t.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _encoders(kept=[]):  # noqa: B006
    if not kept:
        kept += [Encoder("byte_bpe_50k.json", words=20), brute.tokenizer()]
    return kept


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_first_fit_decreasing(lengths):
    lengths = sorted(lengths, reverse=True)
    room, want = [], []
    for n in lengths:
        b = next((k for k, r in enumerate(room) if r >= n), len(room))
        if b == len(room):
            room.append(100)
        want.append((b, 100 - room[b]))
        room[b] -= n
    bins, offsets = first_fit_decreasing(lengths, 100)
    assert list(zip(bins, offsets, strict=True)) == want


def check_packed(rows, docs, capacity):
    t = brute.tokenizer()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    want = sorted(((d.doc_id, len(brute.ids(t, d.text, 1))) for d in docs), key=str)
    assert sorted(((r.doc_id, r.doc_tokens) for r in rows if r.start == 0), key=str) == want
    for d in docs:
        a = brute.ids(t, d.text, 1)
        for r in by_doc[(d.doc_id, len(a))]:
            assert r.ids_crc32 == brute.crc(a[r.start : r.start + r.length]) or d.doc_id in (None, 5)
    assert sum(r.length for r in rows) == sum(n for _, n in want)
    for s in by_sequence.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return 1 - sum(r.length for r in rows) / (capacity * len(by_sequence))


def test_pack(hard):
    rows = pack(hard, capacity=64, group_pieces=50).collect()
    assert check_packed(rows, hard.collect(), 64) < 0.05


def test_equal_rows_are_spread(spark):
    docs = spark.range(400).selectExpr("cast(null as long) AS doc_id", "'cc by' AS text").repartition(4)
    rows = pack(docs, capacity=64, group_pieces=50).collect()
    assert len(rows) == 400 and len({r.sequence_id >> 32 for r in rows}) == 8
    plan = scan_licenses(docs)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    first = max(k for k, line in enumerate(plan) if "RepartitionByExpression" in line)
    assert any("Aggregate" in line and "bit_or" in line for line in plan[first:])
    assert scan_licenses(docs).count() == 400


def test_pack_empty(nothing):
    assert pack(nothing).count() == 0


def test_blocks():
    rng = np.random.default_rng(3)
    for v in (
        rng.integers(0, 50_000, 5000), np.zeros(300), np.array([]), np.array([1 << 63, 3, (1 << 60) - 1, 1 << 60], np.uint64),
        np.concatenate([rng.integers(0, 2, 2000), rng.integers(0, 1 << 40, 100), rng.integers(0, 9, STRIDE * 3 + 1)]),
    ):
        v = v.astype(np.uint64)
        words, starts, escapes = encode_block(v)
        assert (decode_words(words, escapes) == v).all()
        for k in range(len(starts) // 4):
            assert (decode_stride(words, starts, escapes, k) == v[k * STRIDE : (k + 1) * STRIDE]).all()


def test_files(spark, hard):
    path, t = scratch_path(spark), brute.tokenizer()
    write_ids(hard, path, block_ids=1000)
    got = sorted((r.start, r.n_tokens, r.ids_crc32, r.doc_id) for r in read_ids(spark, path).collect())
    rows = hard.collect()
    assert [g[3] for g in got] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d))
    at = 0
    left = [(r.doc_id, brute.ids(t, r.text, 2)) for r in rows]
    for start, n, crc, doc in got:
        assert start == at
        at += n
        k = next(k for k, (d, a) in enumerate(left) if d == doc and len(a) == n and brute.crc(a) == crc)
        left.pop(k)
    assert not left


def test_files_empty(spark, nothing):
    path = scratch_path(spark)
    write_ids(nothing, path)
    assert read_ids(spark, path).count() == 0
