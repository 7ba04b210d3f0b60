"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_negative(value: Column) -> Column:
    """Zero for negative values; NULL stays NULL (``greatest`` alone would turn it into zero)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def finite(value: Column) -> Column:
    """NULL for NaN and infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def fit_length(values: Column, n: Column | int) -> Column:
    """Array cut or padded to ``n`` entries; padding repeats the last entry (0 if there is none)."""
    size = n if isinstance(n, Column) else F.lit(n)
    last = F.when(F.size(values) > 0, F.element_at(values, -1)).otherwise(F.lit(0.0))
    return F.slice(F.concat(values, F.array_repeat(last, size)), 1, size)


def pad_left(values: Column, length: int) -> Column:
    """Last ``length`` entries, short arrays filled on the left with their first entry."""
    filled = F.concat(F.array_repeat(F.element_at(values, 1), length), values)
    return F.when(F.size(values) > 0, F.slice(filled, -length, length))


def model_key(state: Column, model: Column) -> Column:
    """Registry name of a fitted model: state and lower-case model name, joined by ``_``."""
    return F.concat_ws("_", state, F.lower(model))
