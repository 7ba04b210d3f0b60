"""From observed rows to one row per calendar day and series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.functions.scalars import finite
from tideline.session import materialize

KEY = "state"


def roll_up(sales: DataFrame) -> DataFrame:
    """One row per state and day: amounts summed, category the smallest.

    Raw rows are reduced by a hash aggregate before anything is shuffled, so even a series that
    holds most of them leaves one row per day, category and task. The smallest category is
    picked among those few rows: as an aggregate over raw rows, a text minimum would make Spark
    sort them. Everything after this step is bounded by the calendar, not by the input volume.
    Amounts that are no finite number count as unknown, and a day without a known one stays NULL.
    """
    known = F.sum(finite(F.col("total"))).alias("total")
    by_category = sales.groupBy(KEY, "ds", "category").agg(known)
    return by_category.groupBy(KEY, "ds").agg(
        F.sum("total").alias("total"), F.min("category").alias("category")
    )


def densify(daily: DataFrame) -> DataFrame:
    """Fill the calendar gaps of a table that has one row per state and day.

    Amounts are interpolated linearly in time between the neighbouring known amounts; before the
    first known amount they are 0, after the last one they keep it. The category is carried
    forward.
    """
    days = _filled_days(daily, first="total", last="total")
    return days.select(KEY, "ds", F.col("fill").alias("total"), "category")


def _filled_days(daily: DataFrame, first: str, last: str) -> DataFrame:
    """All days of each series with their interpolated amount.

    Every row becomes a segment that reaches to the day before the next row, so no calendar grid
    is built and joined. A segment's line starts at the day's ``last`` known amount and ends at
    the next known day's ``first`` one; ``row_ds`` is the day of the row it started from.
    """
    known_ds = f"if({last} is not null, ds, null)"
    by_day = "over (partition by state order by ds)"
    segments = daily.select(
        KEY,
        F.col("ds").alias("row_ds"),
        F.expr(f"lead(ds) {by_day}").alias("next_row"),
        F.expr(f"last({known_ds}, true) {by_day}").alias("left_ds"),
        F.expr(f"last({last}, true) {by_day}").alias("left_total"),
        F.expr(f"lead({known_ds}) ignore nulls {by_day}").alias("right_ds"),
        F.expr(f"lead({first}) ignore nulls {by_day}").alias("right_total"),
        F.expr(f"last(category, true) {by_day}").alias("category"),
    )
    last_day = F.coalesce(F.date_sub("next_row", 1), F.col("row_ds"))
    return segments.withColumn("ds", F.explode(F.sequence(F.col("row_ds"), last_day))).select(
        KEY,
        "ds",
        "row_ds",
        "category",
        interpolate(
            F.col("ds"),
            F.col("left_ds"),
            F.col("left_total"),
            F.col("right_ds"),
            F.col("right_total"),
        ).alias("fill"),
    )


def interpolate(ds: Column, left_ds: Column, left: Column, right_ds: Column,
                right: Column) -> Column:
    """Value at ``ds`` on the line between two known days, with the rules for open ends."""
    line = left + (right - left) * F.datediff(ds, left_ds) / F.datediff(right_ds, left_ds)
    return (
        F.when(left_ds.isNull(), F.lit(0.0))
        .when(right_ds.isNull() | (ds == left_ds), left)
        .otherwise(line)
    )


def densify_keeping_rows(sales: DataFrame) -> DataFrame:
    """Like ``densify``, but several rows on one day stay separate rows.

    The gap filling works on one row per day that carries the day's first and last known amount
    (in category, amount order), so it is bounded by the calendar like ``densify``. The input is
    evaluated once, into a table of the four columns; only incomplete rows are joined to what
    fills them.
    """
    sales = materialize(sales.select(KEY, "ds", "total", "category"))
    by_category = sales.groupBy(KEY, "ds", "category").agg(
        F.min("total").alias("least"), F.max("total").alias("most")
    )
    known = F.when(F.col("least").isNotNull(), F.struct("category"))
    ends = by_category.groupBy(KEY, "ds").agg(
        F.min_by("least", known).alias("first_total"),
        F.max_by("most", known).alias("last_total"),
        F.max("category").alias("category"),
    )
    days = _filled_days(ends, first="first_total", last="last_total")
    gaps = days.filter(F.col("ds") > F.col("row_ds")).select(
        KEY, "ds", F.col("fill").alias("total"), "category"
    )
    fills = days.filter(F.col("ds") == F.col("row_ds")).select(
        KEY, "ds", "fill", F.col("category").alias("fill_category")
    )
    is_complete = F.col("total").isNotNull() & F.col("category").isNotNull()
    filled = sales.filter(~is_complete).join(fills, [KEY, "ds"]).select(
        KEY,
        "ds",
        F.coalesce("total", "fill").alias("total"),
        F.coalesce("category", "fill_category").alias("category"),
    )
    complete = sales.filter(is_complete).select(KEY, "ds", "total", "category")
    return complete.unionByName(filled).unionByName(gaps)


def spine_join(daily: DataFrame) -> DataFrame:
    """The observed rows on the complete calendar grid, gaps left NULL.

    Offered for inspection of the gaps; ``densify`` gets by without this join.
    """
    grid = daily.groupBy(KEY).agg(F.min("ds").alias("lo"), F.max("ds").alias("hi")).select(
        KEY, F.explode(F.sequence("lo", "hi")).alias("ds")
    )
    return grid.join(daily, [KEY, "ds"], "left")


def forward_fill(df: DataFrame, columns: list[str], order: str = "ds") -> DataFrame:
    """Carry the last known value of each column forward within its series."""
    window = Window.partitionBy(KEY).orderBy(order)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(window) for c in columns})
