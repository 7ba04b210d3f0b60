"""Exact row numbers and look-back windows for series too long for one task.

The daily table is bounded by the calendar and uses plain windows per state. A series whose
rows are kept unsummed has no such bound; here its rows are numbered over sorted ranges and
windows run on chunks of consecutive rows, each with a copy of the rows just before it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.session import materialize

KEY = "state"
ROW_ORDER = ("ds", "category", "total")
CHUNK_ROWS = 50_000


def number_rows(df: DataFrame) -> DataFrame:
    """Add ``rn`` (1-based position within the state) and ``n_rows`` (size of the state).

    Rows are range-partitioned by state and order, so one large state spreads over many tasks;
    a row id as last sort key also spreads equal rows. The ranges are written out before they
    are counted: their numbers must not change if a task runs again.
    """
    spread = df.withColumn("row_id", F.monotonically_increasing_id())
    ranged = materialize(
        spread.repartitionByRange(KEY, *ROW_ORDER, "row_id").withColumn(
            "part", F.spark_partition_id()
        )
    )
    per_state = Window.partitionBy(KEY)
    counts = ranged.groupBy(KEY, "part").agg(F.count("*").alias("n"))
    offsets = counts.select(
        KEY,
        "part",
        (F.sum("n").over(per_state.orderBy("part")) - F.col("n")).alias("before"),
        F.sum("n").over(per_state).alias("n_rows"),
    )
    in_part = Window.partitionBy(KEY, "part").orderBy(*ROW_ORDER, "row_id")
    return (
        ranged.withColumn("in_part", F.row_number().over(in_part))
        .join(offsets, [KEY, "part"])
        .withColumn("rn", F.col("before") + F.col("in_part"))
        .drop("row_id", "part", "before", "in_part")
    )


def over_chunks(numbered: DataFrame, look_back: int,
                columns: Callable[[Window], dict], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add window columns that look at most ``look_back`` rows back.

    ``columns`` receives the window specification. A chunk's leading rows are copies of the end
    of the previous chunk and are dropped after the windows have been computed, so the result
    equals that of one window per state.
    """
    if chunk_rows <= look_back:
        raise ValueError("a chunk has to be longer than the look-back")
    position = F.col("rn") - 1
    home = F.floor(position / chunk_rows)
    is_tail = position % chunk_rows >= chunk_rows - look_back
    chunks = F.when(is_tail, F.array(home, home + 1)).otherwise(F.array(home))
    window = Window.partitionBy(KEY, "chunk").orderBy("rn")
    return (
        numbered.withColumn("chunk", F.explode(chunks))
        .withColumns(columns(window))
        .filter(F.col("chunk") == home)
        .drop("chunk")
    )
