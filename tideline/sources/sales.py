"""Readers for the fact table ``sales(state, ds, total, category)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.scalars import finite

# Text in the amount column has to become NULL instead of failing the read, hence STRING here.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("State", T.StringType()),
        T.StructField("Date", T.StringType()),
        T.StructField("Total", T.StringType()),
        T.StructField("Category", T.StringType()),
    ]
)
MONEY = "decimal(18,2)"


def to_sales(df: DataFrame, state: str = "State", date: str = "Date", total: str = "Total",
             category: str = "Category") -> DataFrame:
    """Rename and type the four base columns; every other column is dropped."""
    return df.select(
        F.col(state).cast("string").alias("state"),
        to_day(F.col(date)).alias("ds"),
        to_number(F.col(total)).alias("total"),
        F.col(category).cast("string").alias("category"),
    )


def to_day(date: Column) -> Column:
    """Day of a date, timestamp or ISO text; the time of day is cut off."""
    return date.try_cast("timestamp_ntz").cast("date")


def to_number(value: Column) -> Column:
    """Numeric value, NULL where the text is not a number, and for NaN and infinities."""
    return finite(value.try_cast("double"))


def read_sales(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Read sales from parquet, ORC, CSV or JSON.

    Text formats get the fixed schema, so no pass over the data is spent on inference.
    """
    reader = spark.read.options(**options)
    if fmt in ("csv", "json"):
        reader = reader.schema(RAW_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True)
    return to_sales(reader.format(fmt).load(path))


def resolve_input(spark: SparkSession, folder: str, preferred: str, pattern: str) -> str:
    """Path of ``preferred`` in ``folder``, else of the only file matching ``pattern``.

    Only file names are listed; the content column of the listing is pruned away.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path")
        .withColumn("name", F.element_at(F.split("path", "/"), -1))
        .filter(~F.col("name").startswith("~$"))
    )
    named = files.filter(F.col("name") == preferred)
    # Two names are enough to tell a unique match from an ambiguous one.
    for candidates in (named, files):
        found = [row.path for row in candidates.orderBy("path").limit(2).collect()]
        if len(found) == 1:
            return found[0]
    raise FileNotFoundError(f"no single input for {preferred!r} or {pattern!r} in {folder}")


def star_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Daily sales per nation from the order tables: state = nation, category = region.

    The customer side is joined undirected by hints: it grows with the data, so Spark picks
    broadcast or sort-merge from its size and splits skewed customers at run time. Amounts are
    summed as decimals, which makes the result independent of the order of the rows.
    """

    def table(name: str, columns: str) -> DataFrame:
        return spark.read.schema(columns).parquet(f"{folder}/{name}.parquet")

    nations = table("nation", "n_nationkey int, n_name string, n_regionkey int")
    regions = table("region", "r_regionkey int, r_name string")
    places = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("state"), F.col("r_name").alias("category")
    )
    customers = table("customer", "c_custkey bigint, c_nationkey int")
    orders = table(
        "orders", "o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
    )
    return (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.to_date("o_orderdate").alias("ds"))
        .agg(F.sum(F.col("o_totalprice").cast(MONEY)).cast("double").alias("total"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("state", "ds", "total", "category")
    )
