"""The driver's entry points."""

import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry_points
from checks import ORACLES, QUERIES
from tests.conftest import ROOT


def test_flagship_query(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["year", "month", "avg_price"] and result.count() > 12


def test_queries_and_sql_have_the_same_names():
    queries, sql = entry_points.queries(), entry_points.oracle_sql()
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) > 80
    assert set(QUERIES) <= set(queries) and set(sql) <= set(queries)
    assert all(callable(query) for query in queries.values())
    assert entry_points.queries() is not queries


def test_queries_can_be_built_twice_before_either_is_read(spark):
    """A second build replaces the tables of the first, whose frame keeps reading its own files."""
    for name in ("csv_external_table", "table_roundtrip", "flight_period_view"):
        query = entry_points.queries()[name]
        first, second = (query(spark, "/root/testdata/sf0.001") for _ in range(2))
        assert first.count() == second.count() > 0


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_without_the_operators_for_training_data(tmp_path, pipeline):
    """All other queries stay when the subpackage is gone, whether or not the pipeline's module is still there."""
    gone = ["llm", ".git", "__pycache__", "tests"] + ([] if pipeline else ["corpus_pipeline.py"])
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(*gone))
    names = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", names], cwd=tmp_path / "copy", capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(ORACLES)), "False"]
