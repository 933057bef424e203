import os

import pytest
from pyspark.sql import functions as F

from mnemolake.functions.embedders import EmbedSpec
from mnemolake.operators import mutations, stored

HASH2 = EmbedSpec(2, "hashing", "m", dims=(2, 4))
HASH4 = EmbedSpec(4, "hashing", "m", dims=(2, 4))


def files(path):
    """Inode, size and time of every data file by its directory."""
    out = {}
    for root, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                st = os.stat(os.path.join(root, n))
                out.setdefault(os.path.basename(root), []).append((n, st.st_ino, st.st_size, st.st_mtime_ns))
    return {k: sorted(v) for k, v in out.items()}


def rows(df, m):
    cols = [c for c in m.columns if not c.startswith("state_")]
    return sorted((tuple(str(v) for v in r) for r in df.select(*cols).collect()))


@pytest.fixture
def wide(spark, memory):
    """Two hundred memories: copies of the small table with ids of their own."""
    copies = spark.range(30).withColumnRenamed("id", "copy")
    return memory.crossJoin(copies).withColumn("id", F.col("copy") * 100 + F.col("id")).drop("copy")


def test_an_edit_of_one_percent_leaves_other_directories_alone(spark, wide, now, tmp_path):
    path = str(tmp_path / "m")
    stored.write_buckets(wide, path, 300)
    before = files(path)
    edits = spark.createDataFrame([(101, "edited", 1), (1203, "old", 1), (1203, "new", 2), (99999, "unknown id", 1)], "id long, content string, ts int")
    want = rows(mutations.update_memories(wide, edits, HASH4, now, ("ts",)), wide)
    hit = {f"bucket={r.b}" for r in edits.where("id < 9999").select(stored.id_bucket(300).alias("b")).collect()}
    assert stored.update_stored(spark, path, edits, HASH4, now, ("ts",)) == len(hit)
    after = files(path)
    assert {k for k in after if after[k] != before.get(k)} == hit and after.keys() == before.keys()
    assert rows(stored.read_buckets(spark, path), wide) == want
    # Run again, as after a driver that died halfway: the same table.
    stored.update_stored(spark, path, edits, HASH4, now, ("ts",))
    assert rows(stored.read_buckets(spark, path), wide) == want


def test_other_directories_are_not_read(spark, wide, now, tmp_path):
    path = tmp_path / "m"
    stored.write_buckets(wide, str(path), 300)
    ids = spark.createDataFrame([(101,), (1203,)], "id long")
    hit = {f"bucket={r.b}" for r in ids.select(stored.id_bucket(300).alias("b")).collect()}
    schema = stored.read_buckets(spark, str(path)).drop("bucket").schema
    spoiled = [f for f in path.glob("buckets=300/*/*.parquet") if f.parent.name not in hit]
    assert len(spoiled) > 90
    for f in spoiled:
        f.write_bytes(b"unreadable")
    footer = stored.read_buckets
    try:  # only the schema comes from a footer, which may be any file's
        stored.read_buckets = lambda s, p, _=None: footer(s, p, schema)
        assert stored.forget_stored(spark, str(path), ids, now) == len(hit)
    finally:
        stored.read_buckets = footer
    for b in hit:
        part = spark.read.schema(schema).parquet(f"{path}/buckets=300/{b}")
        assert part.where("id in (101, 1203) and is_active").count() == 0


def test_forget_and_add(spark, wide, categories, now, tmp_path):
    path = str(tmp_path / "m")
    stored.write_buckets(wide, path, 64)
    ids = spark.createDataFrame([(7,), (7,), (305,), (None,)], "id long")
    new = spark.createDataFrame([(7, "taken"), (5000, "fresh one"), (5001, "")], "id long, content string")
    want = mutations.add_memories(mutations.forget(wide, ids, now), new, categories, HASH4, now)
    before = files(path)
    stored.forget_stored(spark, path, ids, now)
    changed = files(path)
    assert 1 <= sum(changed[k] != before[k] for k in before) <= 2
    stored.add_stored(spark, path, new, categories, HASH4, now)
    after = files(path)
    assert all(set(changed[k]) <= set(after[k]) for k in changed)  # files are added, none replaced
    assert rows(stored.read_buckets(spark, path), wide) == rows(want, wide)
    stored.add_stored(spark, path, new, categories, HASH4, now)
    assert stored.read_buckets(spark, path).count() == wide.count() + 2


@pytest.mark.parametrize("limit", [0, 5])
def test_backfill(spark, wide, now, tmp_path, limit):
    path = str(tmp_path / "m")
    stored.write_buckets(wide, path, 128)
    before = files(path)
    want = mutations.backfill(wide, [HASH4, HASH2], now, limit)
    expected, counts = rows(want.memory, wide), sorted(map(str, want.stats.collect()))
    got = stored.backfill_stored(spark, path, [HASH4, HASH2], now, limit)
    assert sorted(map(str, got.collect())) == counts
    assert rows(stored.read_buckets(spark, path), wide) == expected
    if limit:
        after = files(path)
        assert sum(after[k] != before[k] for k in before) <= 2 * limit
    else:
        again = files(path)
        assert {r.total for r in stored.backfill_stored(spark, path, [HASH4], now).collect()} <= {0, wide.where("vector_4[0] = 0").count()}
        assert again.keys() == files(path).keys()


def test_empty_tables_and_errors(spark, wide, now, tmp_path):
    path = str(tmp_path / "m")
    stored.write_buckets(wide, path, 8)
    assert stored.stored_buckets(spark, path) == 8
    assert stored.forget_stored(spark, path, spark.createDataFrame([], "id long"), now) == 0
    assert stored.forget_stored(spark, path, spark.createDataFrame([(-5,)], "id long"), now) == 0
    with pytest.raises(ValueError):
        stored.stored_buckets(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        stored.write_buckets(wide, str(tmp_path / "zero"), 0)
