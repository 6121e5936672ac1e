import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

LONG = " ".join(f"word{k % 997}x{k}" for k in range(60_000))  # about 700 kB
EDGE_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, size int, kept boolean, sig long, row long, copies int, h string, n int, pos string"
)


def edge_row(doc_id, text, lang="en", source="a"):
    """A document with extra columns named as the operators' own."""
    return (doc_id, text, lang, source, None, 0.5, 1, True, 2, 3, 4, "h", 5, "p")


EDGE = [
    edge_row(1, "Some plain words about nothing in particular, said once."),
    edge_row(2, None),
    edge_row(3, ""),
    edge_row(4, "... 123 !!!"),
    edge_row(None, "a row without an id but with these seven words"),
    edge_row(None, None, None, None),
    edge_row(5, "the SAME text, but for its case"),
    edge_row(6, "the same TEXT, but for its case", None, None),
    edge_row(7, "a row that comes twice in all its columns " * 8),
    edge_row(7, "a row that comes twice in all its columns " * 8),
    edge_row(8, "one"),
    edge_row(9, "one", "en", None),
    edge_row(10, LONG),
    edge_row(11, LONG + " and a little more"),
    edge_row(12, "été à la plage où il fait très chaud " * 3, "fr", "b"),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing column names."""
    return spark.createDataFrame(EDGE, EDGE_SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def medium(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
