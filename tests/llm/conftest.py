import pytest

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000)) + ".\n"
PROSE = "The quick brown fox jumps over the lazy dog while seven wizards brew a strong potion.\n"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    and columns that clash with the operators' own names."""
    rows = [
        (1, "alpha beta gamma", "s1", 5, "x"), (2, None, "s1", 5, None), (3, "", None, 5, "x"), (4, " \t\n ", "s2", None, "x"),
        (5, LONG, "s2", 5, "x"), (6, LONG, "s3", 5, "x"), (7, "alpha beta gamma", None, 5, "x"), (7, "alpha beta gamma", None, 5, "x"),
        (None, "alpha beta gamma delta", "s1", 5, "x"), (8, PROSE * 8, "s3", 5, "x"), (9, "Ünï cödé \U0001f600 words", "Z", 5, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n long, fp string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def no_documents(odd):
    return odd.limit(0)
