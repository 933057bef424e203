"""SentencePiece ids against the library itself."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mnemolake.llm import queries
from mnemolake.llm.common import read, tokenizer_path
from mnemolake.llm.pieces import PieceEncoder, PieceModel, decode_pieces, encode_pieces

sentencepiece = pytest.importorskip("sentencepiece")
MODEL = "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(MODEL))


@pytest.fixture(scope="module")
def model():
    return PieceModel(tokenizer_path(MODEL))


def data(ids):
    return np.array(ids, "<u4").tobytes()


def hard_texts():
    rng = random.Random(3)
    texts = [
        "", " ", "   ", "  a  b ", "\x00", "▁▁ ▁a", "<s></s><unk> <0x41>", "a\tb\r\n", "﻿x​", "x" * 6000, "ab" * 3000,
        "漢字" * 400, "\U0001f642éß", "=" * 300 + " " * 300,
    ]
    for letters, longest in (("aeiounrst  \n.,AB01é漢\U0001f642▁=", 90), ("aeionrst ", 300), ("a =-*_", 200)):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, longest))) for _ in range(300)]
    return texts + ["".join(rng.choice("aeionrstlmd") for _ in range(n)) for n in (900, 4097, 5000)]


def test_same_ids_as_the_library(library):
    encoder = PieceEncoder(MODEL, known_words=50)
    texts = hard_texts()
    got = [x for k in range(0, len(texts), 40) for x in encoder.encode(texts[k : k + 40])]
    assert got == [data(library.encode(t)) for t in texts]


def test_decodes_any_ids_like_the_library(library, model):
    rng = random.Random(4)
    some = [0, 1, 2, 5, 230, 259, 260, 264, 28705, 29031, *range(3, 259)]
    cases = [[rng.choice(some) for _ in range(rng.randint(0, 12))] for _ in range(2000)]
    cases += [[rng.randrange(32000) for _ in range(20)] for _ in range(500)] + [[], [1], [1, 2], [1] * 3000 + [264]]
    assert [model.decode(data(c)) for c in cases] == [library.decode(c) for c in cases]
    with pytest.raises(ValueError):
        model.decode(data([32000]))


def test_other_models_are_refused(tmp_path):
    (tmp_path / "unigram.model").write_bytes(b"\x12\x02\x18\x01")
    with pytest.raises(ValueError):
        PieceModel(str(tmp_path / "unigram.model"))


def test_hard_rows(hard, nothing, library):
    rows = encode_pieces(hard).withColumn("text", decode_pieces(F.col("ids"))).collect()
    want = sorted((str(r.doc_id), data(library.encode(r.text or "", add_bos=True, add_eos=True))) for r in hard.collect())
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in rows) == want
    back = {r.doc_id: r.text for r in rows}
    assert all(back[r.doc_id] == (r.text or "") for r in hard.collect())
    assert encode_pieces(nothing).count() == 0
    bare = encode_pieces(hard.where("doc_id = 2"), begin=False, end=False).collect()
    assert bytes(bare[0].ids) == b""


def test_null_ids_decode_to_null(spark):
    df = spark.createDataFrame([(None,), (b"",)], "ids binary").select(decode_pieces(F.col("ids")).alias("t"))
    assert {r.t for r in df.collect()} == {None, ""}


def test_query_over_a_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_pieces(spark, sf).collect()}
    want = {}
    for r in read(spark, sf, "documents").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        text = library.decode(ids)
        want[r.doc_id] = (len(ids), hashlib.sha256(data(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert got == want
