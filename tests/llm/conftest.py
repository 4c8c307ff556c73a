import re

import pytest
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    T.StructField("row", T.StringType()), T.StructField("id", T.StringType()), T.StructField("score", T.StringType()),
])


def words(text):
    return WORD.findall(text or "")


def rows(*found):
    """(doc_id, text, lang, source) tuples as rows with extra columns of clashing names."""
    return [(d, t, lang, s, None if t is None else len(t), "x", "y", None) for d, t, lang, s in found]


LONG = " ".join(f"wort{i % 997} und{i}" for i in range(30_000))

#: Nulls in any column, empty and very long texts, repeated rows, ties.
ODD = rows(
    (1, None, "en", "a"), (2, "", "en", "a"), (3, "   \n\t ", "en", None), (4, LONG, "de", "a"),
    (5, "one two three", "en", "b"), (6, "One  two\tthree", "en", "b"), (7, "one two three four five six", None, "a"),
    (7, "one two three four five six", None, "a"), (8, "!!! 123 ???", "en", "c"), (None, "a row without an id at all", "en", "a"),
    (None, None, None, None), (9, "naïve ▁ text <|endoftext|>  end", "fr", "\U0001F600"),
    (10, "line a\nline a\nline a\nline b", "en", "a"), (11, "café au lait ici", "fr", "a"),
    (12, LONG + " tail", "de", "a"),
)


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
