"""A corpus pipeline of five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mnemolake.llm.common import named, read
from mnemolake.llm.decontaminate import clean_documents
from mnemolake.llm.packing import pack
from mnemolake.llm.pii import redact
from mnemolake.llm.simhash import one_per_group
from mnemolake.llm.toxicity import toxicity_score, train_lexicon
from mnemolake.operators.staging import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a score of 0.5 or more; the lexicon is learnt from the labels of ``sf_dir``."""
    lexicon = train_lexicon(docs, read(spark, sf_dir, "labels"))
    return docs.where(toxicity_score(named("text"), lexicon) < 0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each near-duplicate group the document with the smallest id."""
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item, or a whole shorter item."""
    return clean_documents(docs, read(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by placeholders."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

#: Learnt scores, SimHash and a tokenizer have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_path(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
