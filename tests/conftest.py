import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DIM = 4


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


ROWS = [
    # id, category_id, target, content, vector, active, minute, tags, metadata
    (1, 8, "memory", "The quick brown fox jumps over the lazy dog", [1.0, 0.0, 0.0, 0.0], True, 1, ["a", "b"], '{"n": 1, "src": "x"}'),
    (2, 8, "user", "A quick brown dog and a quick cat", [0.0, 1.0, 0.0, 0.0], True, 2, ["b"], '{"n": 2, "src": "y"}'),
    (3, 7, "memory", "quick quick quick", [0.5, 0.5, 0.0, 0.0], True, 3, [], '{"n": 3}'),
    (4, None, "memory", "brown quick", [0.0, 0.0, 0.0, 0.0], True, None, ["c"], "{}"),
    (5, 8, "memory", "quick brown inactive", [1.0, 1.0, 0.0, 0.0], False, 5, ["a"], "{}"),
    (6, 8, "user", "quick brown without vector", None, True, 6, ["a"], "{}"),
    (7, 1, "user", "nothing here", [0.0, 0.0, 1.0, 0.0], True, 7, ["a", "c"], "not json"),
]


@pytest.fixture(scope="session")
def memory(spark):
    schema = (
        "id long, category_id smallint, target string, content string, vector_4 array<float>, is_active boolean, "
        "minute int, tags array<string>, metadata string"
    )
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return (
        spark.createDataFrame(ROWS, schema)
        .withColumn("created_at", F.timestamp_add("MINUTE", "minute", start))
        .withColumn("updated_at", F.col("created_at"))
        .withColumn("vector_2", F.when(F.col("id") < 4, F.slice("vector_4", 1, 2)))
        .withColumn("confidence", F.lit(80).cast("smallint"))
        .withColumn("expires_at", F.when(F.col("id") == 2, F.lit("2024-02-01 00:00:00").cast("timestamp")))
        .withColumn("source_session", F.lit(None).cast("string"))
        .drop("minute")
    )


@pytest.fixture(scope="session")
def categories(spark):
    from mnemolake.schemas import category_seed

    return category_seed(spark)


@pytest.fixture(scope="session")
def now():
    return F.lit("2024-06-01 00:00:00").cast("timestamp")
