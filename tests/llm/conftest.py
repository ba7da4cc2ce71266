import pytest

from tests.conftest import DATA

SMALL, MEDIUM = f"{DATA}/sf0.001", f"{DATA}/sf0.01"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, blanks, repeated rows, a shared id, a very long text and columns with clashing names."""
    long_text = " ".join(f"w{i}" for i in range(60_000))
    run = " ".join(f"common{i}" for i in range(20))
    rows = [
        (1, "one two three four five six", "a"), (2, "One TWO three four five SIX", "a"), (3, None, None), (4, "", "a"),
        (5, " \t\n ", ""), (6, "short", "b"), (7, "short", "b"), (8, long_text, "b"), (9, long_text + " end", "b"),
        (10, f"before {run} after", "c"), (11, f"{run}\n{run} tail", "c"), (12, f"{run} é ñ ß", None), (13, "a\x00b c \x1c d", "c"),
        (14, run, "c"), (15, run, "c"),
    ]
    return spark.createDataFrame([(i, t, s, 0, 0, "x", 0, 0) for i, t, s in rows], "doc_id long, text string, source string, n_chars long, key int, f1 string, node int, label int")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def found(df, *columns):
    rows = rows_of(df.select(*columns))
    assert len(rows) == len(set(rows))
    return set(rows)
