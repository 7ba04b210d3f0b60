"""Every registered query with an SQL counterpart, compared value by value."""

import warnings
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tests.conftest import TABLES

ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(TABLES).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def sorted_frame(table) -> pd.DataFrame:
    columns = sorted(table.column_names)
    return table.to_pandas()[columns].sort_values(columns).reset_index(drop=True)


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, database, name):
    found = entry_points.queries()[name](spark, TABLES).toArrow()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        expected = database.execute(ORACLE[name]).to_arrow_table()
    assert found.num_rows > 0
    pd.testing.assert_frame_equal(sorted_frame(found), sorted_frame(expected), check_exact=True)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 25
