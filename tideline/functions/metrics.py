"""Forecast error aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mae(actual: Column, yhat: Column) -> Column:
    return F.avg(F.abs(yhat - actual))


def rmse(actual: Column, yhat: Column) -> Column:
    error = yhat - actual
    return F.sqrt(F.avg(error * error))


def mape(actual: Column, yhat: Column) -> Column:
    """Mean absolute error in percent of the non-zero actuals; infinite when there are none."""
    share = F.when(actual != 0, F.abs((actual - yhat) / actual))
    return F.coalesce(F.avg(share) * 100, F.lit(float("inf")))
