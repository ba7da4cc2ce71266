"""Every query against its SQL counterpart in DuckDB, as multisets of rows."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from checks import ORACLES, QUERIES
from tests.conftest import DATA

FOLDER = f"{DATA}/{os.environ.get('CHECK_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, duck):
    result = QUERIES[name](spark, FOLDER)
    types = {field.name: KINDS[field.dataType.simpleString()] for field in result.schema}
    order = sorted(types)
    rows = Counter(tuple(row) for row in result.select(order).collect())
    cursor = duck.execute(ORACLES[name])
    wanted_types = {column[0]: str(column[1]) for column in cursor.description}
    places = [list(wanted_types).index(column) for column in order]
    wanted = Counter(tuple(row[i] for i in places) for row in cursor.fetchall())
    assert types == wanted_types
    assert rows == wanted
    assert sum(rows.values()) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
