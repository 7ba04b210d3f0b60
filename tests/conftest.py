import sys
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SALES_SCHEMA = "state string, ds date, total double, category string"


@pytest.fixture
def sales_of(spark):
    """Sales table from (state, day offset from 2023-01-01, total) or full rows."""

    def build(rows):
        full = [
            (r[0], date(2023, 1, 1) + timedelta(days=r[1]), r[2], r[3] if len(r) > 3 else "c")
            for r in rows
        ]
        return spark.createDataFrame(full, SALES_SCHEMA)

    return build


@pytest.fixture
def seasonal(sales_of):
    """Three series with trend and weekly pattern, of different sizes and lengths."""

    def build(lengths=(("A", 400, 100.0), ("B", 300, 5000.0), ("C", 260, 1.0))):
        rows = []
        for state, n, unit in lengths:
            for t in range(n):
                weekly = 1.4 if t % 7 == 6 else 1.0 - 0.02 * (t % 7)
                wobble = ((t * 7919) % 101 - 50) / 1000
                rows.append((state, t, unit * (1 + t / 500) * weekly * (1 + wobble)))
        return sales_of(rows)

    return build
