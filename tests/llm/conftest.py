import pytest
from armazem.llm import runtime
from pyspark.sql import functions as F


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    """Workers find the package, wherever the tests run."""
    runtime.ship(spark)


@pytest.fixture
def odd(spark):
    """Null ids and texts, empty and long texts, ties, repeated rows, columns with clashing names."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (None, "no id here at all", 1), (1, None, 2), (2, "", 3), (3, " \t\n ", 4), (4, long, 5), (5, "one", 6), (5, "one", 6),
        (6, "One", 7), (7, "x" * 40_000, 8), (8, "tab\tline\nend  blanks   wide space \U0001f600 naïve", 9), (9, long.upper(), 10),
        (10, "\x00 zero \x1c byte", 11),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score int")
    return frame.withColumns({c: F.lit(1) for c in ("fp", "node", "label", "row", "size", "part", "matches", "tkey", "n", "kept")})


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, fp int")
