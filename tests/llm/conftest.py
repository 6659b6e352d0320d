import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
os.environ["PYTHONPATH"] = sys.path[0] + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    return SF


@pytest.fixture(scope="session")
def texts(spark, sf):
    """doc_id -> text of the small table."""
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}


#: Nulls, empty and very long texts, ties and repeated rows, and columns with clashing names.
ODD = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (4, "one two"), (None, "one two three four five six"), (5, "x" * 70_000),
       (6, "word " * 9_000), (7, "é ü ☃   𝔘"), (8, "one two three four five six"), (9, None)]


@pytest.fixture()
def odd(spark):
    rows = [(i, t, "en", "s", 0, "a", "b", 1.5, 7) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, ids string, spans string, score double, n_words long")


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
