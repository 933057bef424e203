import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from mnemolake.functions.embedders import EmbedSpec, embedder_factory, register_embedder
from mnemolake.functions.scalars import cache_key
from mnemolake.operators import embedding as E

DIMS = (4, 8)


def spec(provider, dim=4, **kw):
    return EmbedSpec(dim, provider, "m", dims=DIMS, **kw)


def counting(log, bad=(), width=None):
    """Embedder that appends every text it is asked for to a file, and fails for some."""

    def factory(dim, model):
        def embed(texts):
            with open(log, "a") as f:
                f.writelines(t + "\n" for t in texts)
            if any(t in bad for t in texts):
                raise RuntimeError("provider down")
            return [[float(len(t))] + [1.0] * ((width or dim) - 1) for t in texts]

        return embed

    return factory


def calls(log):
    return open(log).read().splitlines() if __import__("os").path.exists(log) else []


def key_of(spark, s, text):
    return spark.range(1).select(cache_key(s.dim, s.provider, s.model, F.lit(text)).alias("k")).first().k


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(1, "hello"), (2, ""), (3, "   "), (4, "hello"), (5, "bad one"), (6, None), (7, "other")], "id int, text string")


def by_id(df):
    return {r.id: (r.vector, r.status) for r in df.collect()}


def test_blank_texts_never_reach_the_embedder_and_repeats_are_one_call(texts, tmp_path):
    log = str(tmp_path / "log")
    register_embedder("counting", counting(log))
    got = by_id(E.embed_column(texts, "text", spec("counting")))
    assert got[2] == got[3] == got[6] == ([0.0] * 4, "blank")
    assert got[1] == got[4] == ([5.0, 1.0, 1.0, 1.0], "ok")
    assert sorted(calls(log)) == ["bad one", "hello", "other"]


def test_fail_open_gives_zeros_for_the_failing_text_only(texts, tmp_path):
    register_embedder("failing", counting(str(tmp_path / "log"), bad=("bad one",)))
    result = E.embed_column(texts, "text", spec("failing"))
    got = by_id(result)
    assert got[5] == ([0.0] * 4, "zero_fallback") and got[1][1] == got[7][1] == "ok"
    stats = E.embed_stats(result).first()
    assert (stats.hits, stats.misses, stats.errors, stats.zero_fallbacks) == (1, 3, 1, 1)
    vectors = E.embed_texts(texts.select("text"), spec("failing"))
    cached = E.cache_entries(vectors.df, spec("failing"), F.lit(0)).collect()
    assert len(cached) == 2 and all(any(r.vector) for r in cached)


def test_fail_closed_raises(texts, tmp_path):
    register_embedder("closed", counting(str(tmp_path / "log"), bad=("bad one",)))
    with pytest.raises(Exception, match="embedding failed"):
        E.embed_column(texts, "text", spec("closed", fail_open=False)).collect()


def test_wrong_width(texts, tmp_path):
    register_embedder("wide", counting(str(tmp_path / "log"), width=9))
    assert by_id(E.embed_column(texts, "text", spec("wide")))[1] == ([0.0] * 4, "zero_fallback")
    with pytest.raises(Exception, match="width mismatch"):
        E.embed_column(texts, "text", spec("wide", fail_open=False)).collect()


def test_noop_is_cached_unlike_a_failure(texts):
    result = E.embed_texts(texts.select("text"), spec("noop"))
    assert E.cache_entries(result.df, spec("noop"), F.lit(0)).count() == 3


def test_cache_saves_calls_and_ignores_wrong_widths(spark, texts, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "cache")
    register_embedder("cached", counting(log))
    s = spec("cached")
    first = E.embed_texts(texts.where("id < 5").select("text"), s)
    E.write_cache(E.cache_entries(first.df, s, F.lit(7)), path)
    cache = E.read_cache(spark, path)
    row = cache.first()
    assert (row.dim, row.provider, row.model, row.ts) == (4, "cached", "m", 7)
    result = E.embed_column(texts, "text", s, cache)
    got = by_id(result)
    assert got[1] == ([5.0, 1.0, 1.0, 1.0], "hit") and got[7][1] == "ok"
    assert sorted(calls(log)) == ["bad one", "hello", "other"]
    assert E.embed_stats(result).first().hits == 2
    uncached = by_id(E.embed_column(texts, "text", s))
    assert {k: v for k, (v, _) in uncached.items()} == {k: v for k, (v, _) in got.items()}
    broken = cache.withColumn("vector", F.slice("vector", 1, 2))
    assert by_id(E.embed_column(texts, "text", s, broken))[1][1] == "ok"


def test_lookup_reads_only_the_directories_of_its_keys(spark, tmp_path):
    """The files of all other directories are made unreadable; the answer stays."""
    s, path = spec("hashing"), tmp_path / "cache"
    words = spark.range(300).select(F.format_string("word %d", "id").alias("text"))
    E.write_cache(E.cache_entries(E.embed_texts(words, s).df, s, F.lit(1)), str(path))
    asked = words.limit(3).unionByName(spark.createDataFrame([("unknown",)], "text string"))
    want = {r.text: key_of(spark, s, r.text) for r in asked.collect()}
    needed = {f"prefix={k[:2]}" for k in want.values()}
    spoiled = [f for f in path.glob("prefix=*/*.parquet") if f.parent.name not in needed]
    assert len(spoiled) > 100
    for f in spoiled:
        f.write_bytes(b"unreadable")
    found = E.embed_texts(asked, s, E.read_cache(spark, str(path)))
    got = {r.key: r.status for r in found.df.collect()}
    assert got == {k: "ok" if t == "unknown" else "hit" for t, k in want.items()}
    reqs = spark.createDataFrame([(k,) for k in want.values()] + [(None,)], "key string")
    rows = E.cache_lookup(reqs, E.read_cache(spark, str(path)), 4).collect()
    assert len(rows) == 5 and sum(r.vector is not None for r in rows) == 3


def test_a_key_stored_twice_is_one_hit(spark, texts, tmp_path):
    s, path = spec("hashing"), str(tmp_path / "cache")
    entries = E.cache_entries(E.embed_texts(texts.select("text"), s).df, s, F.lit(1))
    E.write_cache(entries, path)
    E.write_cache(entries, path)
    got = by_id(E.embed_column(texts, "text", s, E.read_cache(spark, path)))
    assert len(got) == 7 and {got[i][1] for i in (1, 4, 5, 7)} == {"hit"}


def test_cache_append_keeps_existing_entries(spark):
    old = spark.createDataFrame([("a", 1)], "key string, ts int")
    new = spark.createDataFrame([("a", 2), ("b", 2)], "key string, ts int")
    assert {tuple(r) for r in E.cache_append(old, new).collect()} == {("a", 1), ("b", 2)}
    assert E.cache_append(None, new).count() == 2


def test_hashing_embedder(spark):
    text = "Über der the the 42"
    want = [0.0] * 8
    for w in re.findall(r"[^\W_]+", text.lower()):
        want[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 8] += 1
    length = math.sqrt(sum(x * x for x in want))
    df = spark.createDataFrame([(1, text), (2, "?!")], "id int, text string")
    got = by_id(E.embed_column(df, "text", spec("hashing", 8)))
    assert got[1][0] == pytest.approx([x / length for x in want], abs=1e-6)
    assert got[2] == ([0.0] * 8, "ok")


def test_bad_dim_and_unknown_provider():
    with pytest.raises(ValueError):
        EmbedSpec(512, "noop")
    with pytest.raises(ValueError):
        embedder_factory("nobody")


def test_default_dim_and_registry(spark):
    def dim(value):
        rows = [] if value is None else [("default_dim", value)]
        return E.default_dim_value(spark.createDataFrame(rows, "key string, value string"))

    assert [dim(v) for v in ("768", '"1536"', "512", "nope", None)] == [768, 1536, 1024, 1024, 1024]
    from mnemolake.schemas import model_seed

    assert E.spec_for(model_seed(spark), 768).model == "nomic-embed-text"
    with pytest.raises(ValueError):
        E.spec_for(model_seed(spark).where("dim > 768"), 768)


def test_many_parallel_partitions(spark, texts):
    vectors = E.embed_texts(texts.select("text"), spec("hashing", parallelism=5))
    assert vectors.rows == 3


def test_calls_get_a_bounded_number_of_texts(spark):
    register_embedder("counting", lambda dim, model: lambda texts: [[float(len(texts)), float(sum(map(len, texts)))] + [0.0] * (dim - 2)] * len(texts))
    texts = spark.range(0, 3000, 1, 1).select(F.concat(F.col("id").cast("string"), F.repeat(F.lit("x"), 3000)).alias("text"))
    found = E.embed_texts(texts.coalesce(1), spec("counting")).df
    most = found.agg(F.max(F.col("vector")[0]).alias("n"), F.max(F.col("vector")[1]).alias("chars"), F.count("key").alias("rows")).first()
    assert most.rows == 3000 and most.n <= E.CALL_TEXTS and most.chars <= E.CALL_BYTES
