import pytest
from pyspark.sql import Row

HARD = [
    Row(doc_id=1, text="Mail jo.doe@mail.example.com or call +1 (212) 555-7713, card 4111 1111 1111 1111, ip 10.1.2.255 and 10.1.2.256.", score="x", _row="y", spans=1),
    Row(doc_id=2, text=None, score="x", _row="y", spans=1),
    Row(doc_id=3, text="", score="x", _row="y", spans=1),
    Row(doc_id=4, text="  \t\n ", score="x", _row="y", spans=1),
    Row(doc_id=None, text="No id here, ALL RIGHTS RESERVED. cc by nc", score=None, _row=None, spans=None),
    Row(doc_id=5, text="the same row twice " * 4, score="x", _row="y", spans=1),
    Row(doc_id=5, text="the same row twice " * 4, score="x", _row="y", spans=1),
    Row(doc_id=6, text="the same row twice " * 4, score="x", _row="y", spans=1),
    Row(doc_id=7, text="long text with many words and éàü 漢字 signs " * 4000, score="x", _row="y", spans=1),
    Row(doc_id=8, text="x" * 4_000 + "@" + "1" * 4_000 + ".2.3", score="x", _row="y", spans=1),
    Row(doc_id=-9, text="General Public  License general public license; cc-by CC BY <|endoftext|> a  b   c \n\n d", score="x", _row="y", spans=1),
    Row(doc_id=10, text="alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu", score="x", _row="y", spans=1),
    Row(doc_id=11, text="one two ALPHA, beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu short item", score="x", _row="y", spans=1),
]
SCHEMA = "doc_id long, text string, score string, _row string, spans int"


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(HARD, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def items(spark):
    rows = [
        (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"), (2, "short item"), (3, None), (4, ""),
        (5, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (5, "one two"), (None, "one two"), (6, "same"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")
