import pytest
from pyspark.sql import functions as F

from mnemolake.operators import staging
from mnemolake.operators.staging import balanced_join, counted_heavy_keys, drop_staged, heavy_keys, missing, stage, top_per_query


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k"),
        F.col("id").alias("n"),
    )
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k7", 4), ("zz", 5)], "k string, v int")
    return left, right


def test_heavy_keys_finds_the_hot_key(sides):
    assert [r.k for r in heavy_keys(sides[0], "k", share=0.2, min_rows=1).collect()] == ["hot"]
    assert heavy_keys(sides[0], "k").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_balanced_join_equals_plain_join(sides, how):
    left, right = sides
    key = lambda r: tuple(str(x) for x in r)
    want = sorted((tuple(r) for r in left.join(right, "k", how).collect()), key=key)
    salted = balanced_join(left, right, "k", how, heavy=heavy_keys(left, "k", 0.2, 1), salts=7)
    assert sorted((tuple(r) for r in salted.collect()), key=key) == want
    small = balanced_join(left, right, "k", how, right_small=True)
    assert sorted((tuple(r) for r in small.collect()), key=key) == want


def test_hot_key_is_spread(spark, sides):
    left, right = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = balanced_join(left, right, "k", heavy=heavy_keys(left, "k", 0.2, 1), salts=16)
        tasks = joined.where("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert tasks > 1


def test_stage_measures_and_reads_back(spark):
    staged = stage(spark.range(10).withColumn("t", F.lit("ab")), top=F.max("id"))
    assert (staged.rows, staged.seen["top"], staged.df.count()) == (10, 9, 10)
    assert 10 * (2 + 24) <= staged.bytes < 10_000
    assert stage(spark.range(0)).bytes == 0


def test_top_per_query(spark):
    df = spark.createDataFrame([(1, 5), (1, 9), (1, 7), (2, 1)], "qid int, id int")
    assert {tuple(r) for r in top_per_query(df, [F.desc("id")], 2).collect()} == {(1, 9), (1, 7), (2, 1)}
    per_row = df.withColumn("k", F.when(F.col("qid") == 1, 1).otherwise(3))
    got = top_per_query(per_row, [F.desc("id")], F.col("k"), bound=3).select("qid", "id").collect()
    assert {tuple(r) for r in got} == {(1, 9), (2, 1)}
    with pytest.raises(ValueError):
        top_per_query(df, [F.desc("id")], -1)
    with pytest.raises(ValueError):
        top_per_query(df, [F.desc("id")], F.col("id"))


def test_top_per_query_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("qid"), "id")
    plan = top_per_query(df, [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_counted_heavy_keys_are_few(spark, monkeypatch):
    monkeypatch.setattr(staging, "HEAVY_MIN_ROWS", 1)
    counts = spark.createDataFrame([("a", 900), ("b", 2), ("c", 98)], "k string, n long")
    assert sorted(r.k for r in counted_heavy_keys(counts, "k", "n", 1000, 0.05).collect()) == ["a", "c"]


def test_missing(spark, monkeypatch):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "k int, v string")
    have = spark.createDataFrame([(2,), (2,), (9,)], "k int")
    want = [(1, "a"), (3, "d")]
    assert sorted(tuple(r) for r in missing(rows, have, "k").collect()) == want
    monkeypatch.setattr(staging, "BROADCAST_BYTES", -1)
    assert sorted(tuple(r) for r in missing(rows, have, "k").collect()) == want


def test_drop_staged(spark):
    staged = stage(spark.range(3))
    assert staged.df.count() == 3
    drop_staged(spark)
    with pytest.raises(Exception):
        spark.read.parquet(staged.df.inputFiles()[0]).count()


def test_may_hold_keeps_every_wanted_row(spark):
    rows = spark.range(20000).select("id", F.concat(F.lit("w"), "id").alias("word"))
    wanted = rows.where("id % 100 = 0")
    kept = {r.id for r in staging.may_hold(rows, wanted.select("word"), "word").collect()}
    assert kept >= set(range(0, 20000, 100)) and len(kept) < 400


def test_split_by_keys_loses_no_row(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"), F.col("id").alias("n"))
    near, far = staging.split_by_keys(rows, rows.select("id").where("id % 50 = 1"), "id")
    kept = {r.id for r in near.collect()}
    assert kept >= {i for i in range(5000) if i % 7 and i % 50 == 1}
    assert sorted(r.n for r in near.unionByName(far).collect()) == list(range(5000)) and far.count() > 4500
