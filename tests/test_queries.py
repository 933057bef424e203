"""Every registered query against its SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as entry
from check import TABLES, normal

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_sql_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(name, spark, con):
    got = entry.queries()[name](spark, SF).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) > 0
        return
    want = con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert not (normal(got) != normal(want)).any(axis=None)


def test_whole_texts(spark):
    whole = entry.queries()["query_gate_whole"](spark, SF)
    assert whole.where("chars > 500").count() > 0 and whole.count() >= entry.queries()["query_gate"](spark, SF).count()
    lines = entry.queries()["context_blocks_whole"](spark, SF).collect()
    assert max(len(line) for r in lines for line in r.context.split("\n")) > 260


def test_entry(spark):
    assert entry.entry(spark).count() > 0
