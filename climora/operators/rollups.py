"""Weekly and monthly series of the mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climora.functions.calendar import period_label, period_start
from climora.functions.geography import macro_region
from climora.functions.parsing import iso_date_text


def rollup(mart: DataFrame, granularity: str | None = None) -> DataFrame:
    """Mean temperature over mart rows and admissions per period, as the mart stands.

    A station that serves several municipalities counts once per municipality here; see
    ``rollup_by_station_day`` for the unweighted climate.
    """
    return mart.groupBy(
        iso_date_text(period_start(F.col("date_day"), granularity)).alias("period")
    ).agg(
        F.avg("avg_temp").alias("avg_temp"),
        F.sum("daily_admission_count").cast("int").alias("admission_count"),
    )


def points(mart: DataFrame, granularity: str | None = None) -> DataFrame:
    """The rollup in period order, with a missing count shown as 0."""
    return (
        rollup(mart, granularity)
        .select(
            "period", "avg_temp", F.coalesce("admission_count", F.lit(0)).alias("admission_count")
        )
        .orderBy("period")
    )


def labelled_points(mart: DataFrame, granularity: str | None = None) -> DataFrame:
    """Points with their display text."""
    return points(mart, granularity).withColumn(
        "label", period_label(F.col("period").cast("date"), granularity)
    )


def last_updated(mart: DataFrame) -> DataFrame:
    """Latest day of the mart as ISO text; one row, NULL for an empty mart."""
    return mart.agg(iso_date_text(F.max("date_day")).alias("last_updated"))


def rollup_by_station_day(
    climate_fact: DataFrame, admissions_fact: DataFrame, granularity: str | None = None
) -> DataFrame:
    """The same series with every station-day counted once, whatever it is mapped to."""
    by_period = iso_date_text(period_start(F.col("fk_date"), granularity)).alias("period")
    climate = climate_fact.groupBy(by_period).agg(F.avg("avg_temp").alias("avg_temp"))
    admissions = admissions_fact.groupBy(by_period).agg(
        F.sum("admission_count").alias("admission_count")
    )
    return climate.join(admissions, "period", "full_outer").select(
        "period",
        "avg_temp",
        F.coalesce("admission_count", F.lit(0)).cast("int").alias("admission_count"),
    )


def regional_sums(
    mart: DataFrame, locations: DataFrame, stations: DataFrame, granularity: str | None, *by: str
) -> DataFrame:
    """What a regional series is made of, and can be added up from: sums and counts per period, region, state and ``by``.

    A row belongs to its municipality's state, or to its station's where it has no municipality.
    ``stations`` must hold one row per station (``latest_station_attributes``).
    """
    places = locations.select(
        F.col("ibge_code").alias("fk_municipality"), F.col("state").alias("location_state")
    )
    posts = stations.select("station_code", F.col("state").alias("station_state"))
    state = F.coalesce("location_state", "station_state")
    return (
        mart.groupBy(
            period_start(F.col("date_day"), granularity).alias("period"),
            "fk_municipality",
            "station_code",
            *by,
        )
        .agg(
            F.sum("avg_temp").alias("temp_sum"),
            F.count("avg_temp").alias("temp_n"),
            F.sum("daily_admission_count").alias("admissions"),
            F.max("date_day").alias("last_day"),
        )
        .join(places, "fk_municipality", "left")
        .join(posts, "station_code", "left")
        .groupBy("period", macro_region(state).alias("region"), state.alias("state"), *by)
        .agg(
            F.sum("temp_sum").alias("temp_sum"),
            F.sum("temp_n").alias("temp_n"),
            F.sum("admissions").alias("admissions"),
            F.max("last_day").alias("last_day"),
        )
    )


def regional_series(sums: DataFrame, *by: str) -> DataFrame:
    """The series that sums of any number of parts add up to."""
    return sums.groupBy("period", "region", "state", *by).agg(
        F.try_divide(F.sum("temp_sum"), F.sum("temp_n")).alias("avg_temp"),
        F.sum("admissions").alias("admission_count"),
        F.max("last_day").alias("last_day"),
    )


def regional_rollup(
    mart: DataFrame, locations: DataFrame, stations: DataFrame, granularity: str | None = None
) -> DataFrame:
    """The series per region and state, computed from the whole mart; ``maintained`` keeps it stored."""
    return regional_series(regional_sums(mart, locations, stations, granularity)).drop("last_day")
