import datetime

import pytest
from pyspark.sql import types as T

from equiframe.llm.shared import ship_package

SF = "/root/testdata/sf0.01"

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use inside, and a type they never read
    T.StructField("key", T.DateType()), T.StructField("size", T.StringType()), T.StructField("sig", T.StringType()),
    T.StructField("raw", T.LongType()), T.StructField("copies", T.StringType()), T.StructField("part", T.StringType())])

PROSE = " ".join(f"word{i % 97} the of and{i}" for i in range(60))
LONG = " ".join(f"w{i * i % 8191} of the x{i}" for i in range(30_000))


def make(rows):
    day = datetime.date(2020, 1, 1)
    return [(*r, len(r[1] or ""), day, "s", None, 1, "c", None) for r in rows]


EDGE = make([
    (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (2, PROSE, "en", "a"),      # copies, one of them a repeated row
    (3, PROSE + " tail", "en", None), (4, None, None, None), (5, "", "en", "b"), (6, " \t\n", "xx", "b"),
    (7, "one", "en", "b"), (8, "one", "en", "c"), (None, PROSE, "en", "c"), (None, None, "en", "c"),
    (9, LONG, "en", "d"), (10, LONG + " end", "en", "d"), (11, "a b c d e f g h i j k", "en", "d"),
    (12, "ünï çødé 　 \x1c x\x85y password=hunter2hunter2", "de", "e\U0001F600"), (13, "one two three", "en", "é"),
    (14, "THE Of\nline\nline\n\nline " + "z " * 60, "en", "b")])


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [tuple(r) for r in documents.select("doc_id", "text", "lang", "source").collect()]


@pytest.fixture(scope="session")
def edge_rows():
    return [r[:4] for r in EDGE]
