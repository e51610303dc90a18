import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows and a column whose name clashes."""
    prose = " ".join(f"word{n} and thing{n}" for n in range(60))
    rows = [
        (1, prose, "en", "a", 1), (2, prose, "en", "a", 1), (2, prose, "en", "a", 1), (3, None, None, None, None),
        (None, prose + " more", "en", "a", 1), (4, "", "en", None, 0), (5, "one\ntwo\none", "en", "b", 11),
        (6, "é" * 70000, "fr", "b", 70000), (7, "aaaa " * 20000, "en", "b", 100000), (8, " \n\t ", "en", "b", 4),
    ]
    return spark.createDataFrame(rows, DOCS).selectExpr("*", "doc_id as shard", "'x' as removed_lines", "'y' as root")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)
