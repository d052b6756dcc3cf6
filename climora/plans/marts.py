"""Dimensions, facts and the climate-admissions mart.

Lookup joins carry no broadcast hint: Spark broadcasts the reference side when its known or
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climora.functions.calendar import day_of_week, day_series, month_name, southern_season
from climora.functions.geography import macro_region
from climora.operators.climate import within_dates
from climora.params import CALENDAR_START


def date_dimension(bounds: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """One row per day of the interval given by the single row of ``bounds``, end excluded."""
    day = F.col("date_day")
    return day_series(bounds.select(start, end), start, end).select(
        "date_day",
        F.year(day).cast("long").alias("year"),
        F.month(day).cast("long").alias("month"),
        F.dayofmonth(day).cast("long").alias("day"),
        day_of_week(day).alias("day_of_week"),
        month_name(day).alias("month_name"),
        southern_season(day).alias("season"),
    )


def dim_date(spark: SparkSession, as_of: date, start: date = CALENDAR_START) -> DataFrame:
    """The calendar from ``start`` up to, not including, one year after ``as_of``."""
    bounds = spark.range(1).select(
        F.lit(start).alias("start_date"), F.add_months(F.lit(as_of), 12).alias("end_date")
    )
    return date_dimension(bounds)


def dim_location(staged_admissions: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Every municipality that has admissions, with reference data where there are any."""
    seen = staged_admissions.select(
        F.col("municipality_residence_code").alias("ibge_code")
    ).distinct()
    return seen.join(municipalities, "ibge_code", "left").select(
        "ibge_code",
        F.col("municipality_name").alias("municipality"),
        "state",
        macro_region(F.col("state")).alias("region"),
        "latitude",
        "longitude",
    )


def dim_weather_station(staged_climate: DataFrame) -> DataFrame:
    """Distinct station attributes; a station whose attributes changed has several rows."""
    return staged_climate.select(
        "station_code", "station_name", "state", "latitude", "longitude"
    ).distinct()


def latest_station_attributes(staged_climate: DataFrame) -> DataFrame:
    """One row per station: the most recent known value of each attribute."""
    names = ("station_name", "state", "latitude", "longitude")
    spans = staged_climate.groupBy("station_code", *names).agg(F.max("date_day").alias("seen"))
    return spans.groupBy("station_code").agg(
        *[
            F.max_by(
                n, F.when(F.col(n).isNotNull(), F.struct("seen", F.col(n).cast("string")))
            ).alias(n)
            for n in names
        ]
    )


def fct_respiratory_admissions(enriched: DataFrame) -> DataFrame:
    """One row per admission with the additive count 1."""
    return enriched.select(
        "aih_number",
        F.col("admission_date").alias("fk_date"),
        F.col("municipality_residence_code").alias("fk_municipality"),
        F.lit(1).alias("admission_count"),
        "total_aih_value",
        "length_of_stay",
        "icd_group",
    )


def fct_daily_climate(staged_climate: DataFrame) -> DataFrame:
    return staged_climate.select(
        F.col("date_day").alias("fk_date"),
        F.col("station_code").alias("fk_station"),
        "avg_temp",
        "min_temp",
        "max_temp",
        "avg_relative_humidity",
        "total_precipitation",
    )


def daily_admissions(admissions_fact: DataFrame) -> DataFrame:
    """Admissions per day and municipality."""
    return admissions_fact.groupBy("fk_date", "fk_municipality").agg(
        F.sum("admission_count").alias("daily_admission_count"),
        F.sum("total_aih_value").alias("daily_total_aih_value"),
        F.avg("length_of_stay").alias("avg_length_of_stay"),
    )


def with_station(daily: DataFrame, mapping: DataFrame) -> DataFrame:
    """Adds the station of each municipality; NULL where none is mapped."""
    stations = mapping.select(
        F.col("municipality_ibge_code").alias("fk_municipality"), "station_code"
    )
    return daily.join(stations, "fk_municipality", "left")


def correlation_mart(
    admissions_fact: DataFrame,
    climate_fact: DataFrame,
    mapping: DataFrame,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Daily climate beside daily admissions, whichever of the two a day has.

    Grain: day, station, municipality. Municipalities that share a station repeat its climate row;
    unmapped municipalities keep a NULL station. A date range is applied to both inputs, because a
    filter on the joined day cannot be pushed below a full outer join.
    """
    admissions = with_station(
        daily_admissions(within_dates(admissions_fact, "fk_date", start, end)), mapping
    ).alias("a")
    climate = within_dates(climate_fact, "fk_date", start, end).alias("c")
    same_day = F.col("a.fk_date") == F.col("c.fk_date")
    same_station = F.col("a.station_code") == F.col("c.fk_station")
    return admissions.join(climate, same_day & same_station, "full_outer").select(
        F.coalesce("a.fk_date", "c.fk_date").alias("date_day"),
        F.coalesce("a.station_code", "c.fk_station").alias("station_code"),
        "a.fk_municipality",
        "c.avg_temp",
        "c.min_temp",
        "c.max_temp",
        "c.avg_relative_humidity",
        "c.total_precipitation",
        F.coalesce("a.daily_admission_count", F.lit(0)).cast("long").alias("daily_admission_count"),
        "a.daily_total_aih_value",
        "a.avg_length_of_stay",
    )
