"""Table schemas, seed rows and the list of embedding widths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Widths, seed rows, score weights and limits every store agrees on.
DIMS: tuple[int, ...] = (768, 1024, 1536)
FALLBACK_DIM = 1024
FALLBACK_CATEGORY = "fact"
CATEGORY_SEED = [
    (1, "user_preference"),
    (2, "user_profile"),
    (3, "environment"),
    (4, "project_convention"),
    (5, "tool_quirk"),
    (6, "lesson_learned"),
    (7, "workflow"),
    (8, "fact"),
]
MODEL_SEED = [
    (768, "ollama_local", "nomic-embed-text", None, "OLLAMA_API_KEY"),
    (1024, "kimi", "bge_m3_embed", None, "KIMI_API_KEY"),
    (1536, "minimax", "embo-01", None, "MINIMAX_API_KEY"),
]
SETTINGS_SEED = [("default_dim", "1024")]
#: Fixed value: the message of a search without results.
NO_RESULTS = "No matching memories found."
DEFAULT_TARGET = "memory"
DEFAULT_CONFIDENCE = 80
MAX_TARGET_CHARS = 20
SEARCH_TOP_K = 10
RECENT_LIMIT = 20
CONTEXT_TOP_K = 5
WINDOW_FACTOR, WINDOW_MIN = 4, 40
TEXT_WEIGHT = 0.5

VECTOR = T.ArrayType(T.FloatType(), containsNull=False)

CATEGORY_SCHEMA = T.StructType(
    [T.StructField("id", T.ShortType(), False), T.StructField("name", T.StringType(), False)]
)
MODEL_SCHEMA = T.StructType(
    [
        T.StructField("dim", T.ShortType(), False),
        T.StructField("provider", T.StringType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("base_url", T.StringType()),
        T.StructField("api_key_env", T.StringType()),
    ]
)
SETTING_SCHEMA = T.StructType(
    [T.StructField("key", T.StringType(), False), T.StructField("value", T.StringType(), False)]
)
CACHE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType(), False),
        T.StructField("dim", T.IntegerType(), False),
        T.StructField("provider", T.StringType(), False),
        T.StructField("model", T.StringType(), False),
        T.StructField("vector", VECTOR, False),
        T.StructField("ts", T.LongType()),
    ]
)


def memory_schema(dims: Sequence[int] = DIMS, id_type: T.DataType | None = None) -> T.StructType:
    """Schema of the memory table with one nullable vector column per width."""
    vectors = [T.StructField(f"vector_{d}", T.ArrayType(T.FloatType())) for d in dims]
    return T.StructType(
        [
            T.StructField("id", id_type or T.StringType()),
            T.StructField("category_id", T.ShortType()),
            T.StructField("target", T.StringType()),
            T.StructField("content", T.StringType()),
            *vectors,
            T.StructField("source_session", T.StringType()),
            T.StructField("confidence", T.ShortType()),
            T.StructField("is_active", T.BooleanType()),
            T.StructField("created_at", T.TimestampType()),
            T.StructField("updated_at", T.TimestampType()),
            T.StructField("expires_at", T.TimestampType()),
            T.StructField("tags", T.ArrayType(T.StringType())),
            T.StructField("metadata", T.StringType()),
        ]
    )


def vector_column(dim: int, dims: Sequence[int] = DIMS) -> str:
    """Column that holds vectors of this width; a width outside ``dims`` is an error."""
    if dim not in dims:
        raise ValueError(f"unsupported dim {dim}; expected one of {list(dims)}")
    return f"vector_{dim}"


def vector_dims(m: DataFrame) -> list[int]:
    """Widths for which the table has a vector column, in column order."""
    return [int(c[7:]) for c in m.columns if c.startswith("vector_") and c[7:].isdigit()]


def category_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CATEGORY_SEED, CATEGORY_SCHEMA)


def model_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MODEL_SEED, MODEL_SCHEMA)


def settings_seed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SETTINGS_SEED, SETTING_SCHEMA)
