from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from millrace.llm._common import prepare

LONG = "lorem ipsum dolor " * 20_000


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    prepare(session)
    return session


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows and ties, and extra columns named as operators' own."""
    data = [
        (1, "a b c d", "en", "s1"), (1, "a b c d", "en", "s1"), (2, "a b c d", "en", "s1"), (3, None, "en", "s1"), (4, "", None, None),
        (None, "x y z", None, "s2"), (5, LONG, "EN-us", "s2"), (6, " \t\n", "zz", "s3"), (7, "é中\U0001f600 \x00​", "", ""), (8, "A B C D", "en", "s1"),
    ]
    return spark.createDataFrame([(*d, -1, "old", "k") for d in data], "doc_id long, text string, lang string, source string, size long, pii string, fp string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
