"""Refits of grown series from stored sums and the new days alone.

A linear fit needs sums of products of a row and the rows shortly before it. ``statistics`` keeps
those sums per series, with the last rows; ``grown`` adds the days that have come since, for which it
reads these last rows and the new ones, no earlier day. What is fitted from grown sums equals a fit of
the whole series. The sums of a series take a few thousand numbers, however long it is.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tideline.config import ARIMA_ORDER
from tideline.functions.linear import summed_grams
from tideline.models import seasonal_ar as sa
from tideline.models.fold_fits import _PAST, N_LONG, N_PAST, N_SUMMED, fold_regression
from tideline.operators.features import series_window

KEY = "state"
# Rows that a new row's regressors reach back to: the oldest difference, and what it is made of.
TAIL = N_PAST + sa.SEASON + 1
SUMS = ("line", "seasonal0", "seasonal1")


def _rows(daily: DataFrame, known: DataFrame | None) -> DataFrame:
    """New rows, and the last known ones before them, numbered from the first row of the series."""
    new = daily.select(KEY, "ds", F.col("total").cast("double").alias("total"), F.lit(True).alias("is_new"))
    if known is None:
        first = daily.groupBy(KEY).agg(F.avg("total").alias("center"))
        return new.join(first, KEY).withColumn("before", F.lit(0).cast("bigint"))
    last = known.select(KEY, "last_ds", "center", (F.col("n") - F.size("tail")).alias("before"))
    old = known.select(KEY, F.explode("tail").alias("row")).select(KEY, "row.*", F.lit(False).alias("is_new"))
    # A series that was not known yet starts with its own mean.
    fresh = new.join(last, KEY, "left").filter(F.col("last_ds").isNull() | (F.col("ds") > F.col("last_ds")))
    own = F.avg("total").over(Window.partitionBy(KEY))
    fresh = fresh.withColumns({"center": F.coalesce("center", own), "before": F.coalesce("before", F.lit(0))})
    return fresh.drop("last_ds").unionByName(old.join(last.drop("last_ds"), KEY))


def _past(rows: DataFrame) -> DataFrame:
    """Differences of either degree, with those before them; only new rows remain."""
    window = series_window()
    lag = lambda name, k: F.lag(name, k).over(window)
    numbered = rows.withColumns({
        "rn": F.col("before") + F.row_number().over(window), "previous": lag("total", 1),
        "d0": F.col("total") - lag("total", sa.SEASON),
    }).withColumn("d1", F.col("d0") - lag("d0", 1))
    columns = {f"{d}_{k}": lag(d, k) for d in ("d0", "d1") for k in range(1, N_PAST)}
    return numbered.withColumns(columns).filter("is_new")


def _line_columns(batch: pd.DataFrame) -> np.ndarray:
    x = (batch["previous"] - batch["center"]).to_numpy(dtype=float)
    y = (batch["total"] - batch["center"]).to_numpy(dtype=float)
    known = ~(np.isnan(x) | np.isnan(y))
    return np.column_stack([known, np.where(known, x, 0.0), np.where(known, y, 0.0)])


def _seasonal_columns(d: str):
    names = [d, *(f"{d}_{k}" for k in range(1, len(_PAST)))]
    # Rows count from the one where the most differenced series is complete, whatever the order.
    first = sa.first_row(1)

    def build(batch: pd.DataFrame) -> np.ndarray:
        past = np.nan_to_num(batch[names].to_numpy(dtype=float), nan=0.0)
        complete = (batch["rn"] >= first).to_numpy(dtype=float)[:, None]
        return np.hstack([past * complete, past[:, :N_LONG], batch[["total"]].abs().to_numpy(dtype=float),
                          np.ones_like(complete), complete])

    return build, names


def statistics(daily: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Sums per series of ``daily(state, ds, total)``; with ``known`` statistics, of its later days only.

    Columns: state, n, last_ds, peak, center, tail (last rows), and the sums of ``SUMS``.
    """
    rows = _past(_rows(daily, known))
    found = summed_grams(rows, [KEY], ["previous", "total", "center"], _line_columns, 3).withColumnRenamed("gram", "line")
    for name, d in (("seasonal0", "d0"), ("seasonal1", "d1")):
        build, names = _seasonal_columns(d)
        sums = summed_grams(rows, [KEY], ["rn", "total", *names], build, N_SUMMED)
        found = found.join(sums.withColumnRenamed("gram", name), KEY)
    window = series_window(F.desc("ds"))
    recent = rows.withColumn("from_end", F.row_number().over(window))
    tails = recent.groupBy(KEY).agg(
        F.count("*").alias("n"), F.max("ds").alias("last_ds"), F.first("center").alias("center"),
        F.max(F.when(F.col("rn") >= sa.first_row(1), F.col("total"))).alias("peak"),
        F.array_sort(F.collect_list(F.when(F.col("from_end") <= TAIL, F.struct("ds", "total")))).alias("tail"),
    )
    return tails.join(found, KEY)


def grown(known: DataFrame, daily: DataFrame) -> DataFrame:
    """Known statistics with the days of ``daily`` that come after them; only those days are read.

    The earliest last day of all series, one date, is a filter on ``daily`` that reaches its files.
    """
    since = known.agg(F.min("last_ds")).first()[0]
    unknown = daily.join(known, KEY, "left_anti").select(*daily.columns)
    later = daily if since is None else daily.filter(F.col("ds") > F.lit(since))
    later = later.join(known, KEY, "left_semi")
    added = statistics(later, known)
    both = known.alias("k").join(added.alias("a"), KEY, "left")

    def plus(name: str):
        total = F.zip_with(f"k.{name}", f"a.{name}", lambda x, y: x + y)
        return F.coalesce(total, F.col(f"k.{name}")).alias(name)

    tail = F.concat("k.tail", "a.tail")
    merged = both.select(
        KEY, (F.col("k.n") + F.coalesce("a.n", F.lit(0))).alias("n"),
        F.coalesce("a.last_ds", "k.last_ds").alias("last_ds"), F.col("k.center").alias("center"),
        F.greatest("k.peak", "a.peak").alias("peak"),
        F.coalesce(F.slice(tail, F.greatest(F.size(tail) - TAIL + 1, F.lit(1)), TAIL), "k.tail").alias("tail"),
        *[plus(name) for name in SUMS],
    )
    return merged.unionByName(statistics(unknown).select(*merged.columns))


def line_fit(known: DataFrame) -> DataFrame:
    """The first-order line of every series, as ``closed_form.fit_ar1`` has it."""
    n, sx, sy, sxx, sxy = (F.col("line")[i] for i in range(5))
    phi = (n * sxy - sx * sy) / F.nullif(n * sxx - sx * sx, F.lit(0.0))
    fitted = known.withColumn("phi", phi)
    level = sy / n - F.col("phi") * sx / n + F.col("center") * (1 - F.col("phi"))
    last = F.element_at("tail", -1)["total"]
    return fitted.select(KEY, "phi", level.alias("intercept"), "last_ds", last.alias("last_total"))


def seasonal_fits(known: DataFrame, orders: Sequence[tuple[int, int, int]] = (ARIMA_ORDER,),
                  largest_root: float | None = None) -> DataFrame:
    """Seasonal fits of every order, as ``seasonal_ar.fit_grid`` has them over a grid with both degrees."""
    totals = F.transform("tail", lambda row: row["total"])
    solve_order = sa.order_solver(largest_root)
    fits = None
    for d in sorted({order[1] for order in orders}):
        # Differences of the last rows, oldest first.
        once = F.transform(totals, lambda x, i: x - F.get(totals, i - sa.SEASON))
        kept = known.withColumn("w", once)
        if d:
            kept = kept.withColumn("w", F.transform("w", lambda x, i: x - F.get(F.col("w"), i - 1)))
        recent = lambda name, n: F.slice(name, -n, n)
        solved = kept.filter(F.size("tail") >= TAIL - 1 + d).select(
            KEY, "last_ds", "peak", recent(totals, sa.TAIL_ROWS).alias("tail_y"),
            fold_regression(f"seasonal{d}", F.lit(1.0), recent("w", N_PAST - 1)).alias("own"),
        ).select(KEY, "last_ds", "peak", "tail_y", "own.*")
        grid = F.array(*[
            F.struct(F.lit(i).alias("grid_id"), F.lit(p).alias("p"), F.lit(d).alias("d"), F.lit(q).alias("q"))
            for i, (p, own, q) in enumerate(orders) if own == d
        ])
        found = (
            solved.filter(F.col("n") > sa.N_REGRESSORS + 1)
            .withColumn("order", F.explode(grid))
            .withColumn("fit", solve_order("gram", "n", "order.p", "order.q"))
            .select("*", "order.*", "fit.*")
            .drop("order", "fit", "gram")
        )
        fits = found if fits is None else fits.unionByName(found)
    return fits
