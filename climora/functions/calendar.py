"""Calendar expressions: attributes of a day, period starts and labels, day series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the southern meteorological seasons and their months.
SOUTHERN_SEASONS = {
    "Summer": (12, 1, 2),
    "Autumn": (3, 4, 5),
    "Winter": (6, 7, 8),
    "Spring": (9, 10, 11),
}

# Accepted granularity names; every other text means monthly.
_UNITS = {"weekly": "week", "monthly": "month"}
_LABELS = {"week": "MMM d, yyyy", "month": "MMM yyyy"}


def southern_season(day: Column) -> Column:
    season = F.lit(None).cast("string")
    for name, months in SOUTHERN_SEASONS.items():
        season = F.when(F.month(day).isin(*months), name).otherwise(season)
    return season


def day_of_week(day: Column) -> Column:
    """0 = Sunday to 6 = Saturday."""
    return (F.dayofweek(day) - 1).cast("long")


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def granularity_unit(granularity: str | None) -> str:
    """The truncation unit of a user's granularity; the user's text never goes further."""
    return _UNITS.get(granularity or "", "month")


def period_start(day: Column, granularity: str | None) -> Column:
    """First day of the week (Monday) or month that holds ``day``."""
    return F.trunc(day, granularity_unit(granularity))


def period_label(period: Column, granularity: str | None) -> Column:
    """Display text of a period: ``May 2024``, or ``May 6, 2024`` for weeks."""
    return F.date_format(period, _LABELS[granularity_unit(granularity)])


def day_series(bounds: DataFrame, start: str, end: str, name: str = "date_day") -> DataFrame:
    """One row per day from column ``start`` to column ``end``, ``end`` excluded.

    Other columns of ``bounds`` repeat on each of its days; an empty interval gives no rows.
    """
    first, last = F.col(start), F.date_sub(F.col(end), 1)
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
    kept = [c for c in bounds.columns if c not in (start, end)]
    return bounds.select(*kept, F.explode(days).alias(name))
