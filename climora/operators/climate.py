"""Hourly readings to one row per station and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora.functions.parsing import empty_to_null, tolerant_double

_METADATA = ("station_name", "state", "latitude", "longitude")
_KEY = ("station_code", "date")

# Numeric source fields and their names downstream.
_NUMBERS = {
    "VL_LATITUDE": "latitude",
    "VL_LONGITUDE": "longitude",
    "TEM_INS": "temp_instant",
    "TEM_MAX": "temp_max",
    "TEM_MIN": "temp_min",
    "UMD_INS": "humidity_instant",
    "CHUVA": "precipitation",
}


def normalize_readings(records: DataFrame, dropped: Observation | None = None) -> DataFrame:
    """Hourly source records to typed readings.

    Records without a date have no day to count for and are left out; pass an ``Observation`` to
    learn how many. A date that is present but malformed is an error.

    The numbers are parsed as one array: seven copies of the parser in one generated method, next
    to the exploding of the file, would be too large for the JVM to compile.
    """
    day = F.col("DT_MEDICAO")
    if not isinstance(records.schema["DT_MEDICAO"].dataType, T.DateType):
        day = empty_to_null(day).cast("date")
    carried = [c for c in ("read_order",) if c in records.columns]
    parsed = records.select(
        F.col("CD_ESTACAO").alias("station_code"),
        day.alias("date"),
        empty_to_null(F.col("DC_NOME")).alias("station_name"),
        empty_to_null(F.col("UF")).alias("state"),
        F.transform(
            F.array(*[F.col(c).cast("string") for c in _NUMBERS]),
            lambda cell: tolerant_double(cell, decimal_comma=True),
        ).alias("numbers"),
        *carried,
    )
    typed = parsed.select(
        *("station_code", "date", "station_name", "state"),
        *[F.get("numbers", F.lit(i)).alias(n) for i, n in enumerate(_NUMBERS.values())],
        *carried,
    )
    if dropped is not None:
        typed = typed.observe(dropped, F.count_if(F.col("date").isNull()).alias("no_date"))
    return typed.filter(F.col("date").isNotNull())


def _first_known(value: str, order: str) -> Column:
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias(value)


def aggregate_daily(readings: DataFrame, order: str = "read_order") -> DataFrame:
    """One row per station and day.

    Means skip missing values. The extremes come from the hourly extremes, and from the instant
    temperature only on a day that reports no hourly extreme at all. Rain is NULL only when every
    reading of the day lacks it. Each metadata column is the first known value in ``order``.

    The metadata repeat on every reading, so the first step groups by them as well: its buffers
    are then plain numbers (hash aggregation, combined before the shuffle, whatever the size of a
    group). The second step merges the one or two rows this leaves per station and day.
    """
    parts = readings.groupBy(*_KEY, *_METADATA).agg(
        F.min(order).alias("first_read"),
        F.sum("temp_instant").alias("temp_sum"),
        F.count("temp_instant").alias("temp_n"),
        F.min("temp_instant").alias("instant_min"),
        F.max("temp_instant").alias("instant_max"),
        F.min("temp_min").alias("hourly_min"),
        F.max("temp_max").alias("hourly_max"),
        F.sum("humidity_instant").alias("humidity_sum"),
        F.count("humidity_instant").alias("humidity_n"),
        F.sum("precipitation").alias("rain_sum"),
    )
    return parts.groupBy(*_KEY).agg(
        *[_first_known(name, "first_read") for name in _METADATA],
        F.try_divide(F.sum("temp_sum"), F.sum("temp_n")).alias("avg_temp"),
        F.coalesce(F.min("hourly_min"), F.min("instant_min")).alias("min_temp"),
        F.coalesce(F.max("hourly_max"), F.max("instant_max")).alias("max_temp"),
        F.try_divide(F.sum("humidity_sum"), F.sum("humidity_n")).alias("avg_relative_humidity"),
        F.sum("rain_sum").alias("total_precipitation"),
    )


def daily_measures(order: str = "read_order") -> list[Column]:
    """The same day, as a single list of aggregates for one ``groupBy``."""
    return [
        *[_first_known(name, order) for name in _METADATA],
        F.avg("temp_instant").alias("avg_temp"),
        F.coalesce(F.min("temp_min"), F.min("temp_instant")).alias("min_temp"),
        F.coalesce(F.max("temp_max"), F.max("temp_instant")).alias("max_temp"),
        F.avg("humidity_instant").alias("avg_relative_humidity"),
        F.sum("precipitation").alias("total_precipitation"),
    ]


def within_dates(rows: DataFrame, day: str, start, end) -> DataFrame:
    """Rows whose day lies in the range, both ends included; an open end is None."""
    if start is not None:
        rows = rows.filter(F.col(day) >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col(day) <= F.lit(end))
    return rows


def for_stations(readings: DataFrame, stations: tuple[str, ...] | DataFrame) -> DataFrame:
    """Readings of the wanted stations: a literal list, or a table with ``station_code``."""
    if isinstance(stations, DataFrame):
        return readings.join(stations.select("station_code").distinct(), "station_code", "left_semi")
    if not stations:
        raise ValueError("at least one station code is needed")
    return readings.filter(F.col("station_code").isin(*stations))


def readings_per_station(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Reading count of every wanted station; 0 marks a station the source does not hold."""
    counts = readings.groupBy("station_code").agg(F.count(F.lit(1)).alias("readings"))
    wanted = stations.select("station_code").distinct()
    return wanted.join(counts, "station_code", "left").select(
        "station_code", F.coalesce("readings", F.lit(0)).cast("long").alias("readings")
    )
