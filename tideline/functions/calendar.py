"""Calendar columns of a date, all as built-in expressions.

The holiday test is an expression too: federal holidays follow from month, day of month and
weekday, so no dimension table has to be built, broadcast or joined.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# United States federal holidays, weekdays counted from Monday = 0.
MONDAY, THURSDAY, FRIDAY = 0, 3, 4
# month, weekday, first and last possible day of the month, first year
FLOATING_HOLIDAYS = (
    (1, MONDAY, 15, 21, 1986),  # third Monday of January
    (2, MONDAY, 15, 21, 0),  # third Monday of February
    (5, MONDAY, 25, 31, 0),  # last Monday of May
    (9, MONDAY, 1, 7, 0),  # first Monday of September
    (10, MONDAY, 8, 14, 0),  # second Monday of October
    (11, THURSDAY, 22, 28, 0),  # fourth Thursday of November
)
# month, day, first year; observed on Friday or Monday when they fall on a weekend
DATED_HOLIDAYS = (
    (1, 1, 0),
    (6, 19, 2021),
    (7, 4, 0),
    (11, 11, 0),
    (12, 25, 0),
)
# End of the fixed values.


def day_of_week(ds: Column) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(ds)


def is_holiday(ds: Column) -> Column:
    """True on a federal holiday or on the weekday that observes it."""
    floating = [
        (F.month(ds) == month)
        & (F.weekday(ds) == weekday)
        & F.dayofmonth(ds).between(first, last)
        & (F.year(ds) >= since)
        for month, weekday, first, last, since in FLOATING_HOLIDAYS
    ]
    tomorrow, yesterday = F.date_add(ds, 1), F.date_sub(ds, 1)
    observed = (_dated(tomorrow) & (F.weekday(ds) == FRIDAY)) | (
        _dated(yesterday) & (F.weekday(ds) == MONDAY)
    )
    return reduce(or_, floating) | _dated(ds) | observed


def _dated(ds: Column) -> Column:
    return reduce(
        or_,
        [
            (F.month(ds) == month) & (F.dayofmonth(ds) == day) & (F.year(ds) >= since)
            for month, day, since in DATED_HOLIDAYS
        ],
    )


def calendar_columns(ds: Column) -> dict[str, Column]:
    """The calendar features, keyed by name and in feature order."""
    weekday, month = day_of_week(ds), F.month(ds)
    return {
        "day_of_week": weekday,
        "month": month,
        "day_of_month": F.dayofmonth(ds),
        "week_of_year": F.weekofyear(ds),
        "year": F.year(ds),
        "is_weekend": (weekday >= 5).cast("int"),
        "is_holiday": is_holiday(ds).cast("int"),
        "day_of_week_sin": F.sin(2 * F.pi() * weekday / 7),
        "day_of_week_cos": F.cos(2 * F.pi() * weekday / 7),
        "month_sin": F.sin(2 * F.pi() * month / 12),
        "month_cos": F.cos(2 * F.pi() * month / 12),
    }


def with_calendar(df: DataFrame, date: str = "ds") -> DataFrame:
    return df.withColumns(calendar_columns(F.col(date)))


def iso_timestamp(ds: Column) -> Column:
    """Midnight of ``ds`` as ISO text with a T, as used in responses."""
    return F.concat(ds.cast("string"), F.lit("T00:00:00"))


def spaced_timestamp(ds: Column) -> Column:
    """Midnight of ``ds`` as text with a blank, as used in forecast documents."""
    return F.concat(ds.cast("string"), F.lit(" 00:00:00"))
