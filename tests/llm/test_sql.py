"""Queries with an SQL equivalent, compared value by value."""

import os
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tideline.llm import queries as q

TABLES = os.environ.get("LLM_TABLES", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", q.ORACLE)
def test_query_equals_sql(spark, name):
    with duckdb.connect() as database:
        for path in Path(TABLES).glob("*.parquet"):
            database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
        expected = database.execute(q.ORACLE[name]).to_arrow_table().to_pandas()
    found = q.QUERIES[name](spark, TABLES).toArrow().to_pandas()
    columns = sorted(expected.columns)
    key = next(k for k in (["doc_id"], ["word"], ["lang", "rank"]) if set(k) <= set(columns))
    assert len(expected) > 0
    frames = [x[columns].sort_values(key).reset_index(drop=True) for x in (found, expected)]
    pd.testing.assert_frame_equal(*frames, check_exact=True)
