"""Partitioned Parquet sinks that can be re-run for the same period."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora.functions.calendar import month_start
from climora.operators import key_index
from climora.schemas import RAW_ADMISSIONS, VERSIONED_ADMISSIONS
from climora.sources import snapshots

# Folder layouts of daily climate. One folder per day suits a few stations; a national table has
# far fewer, larger files by month, and a state's readers skip the other states' folders.
CLIMATE_BY_DATE = ("date",)
CLIMATE_BY_MONTH = ("year", "month")
CLIMATE_BY_STATE_MONTH = ("state", "year", "month")


def replace_partitions(rows: DataFrame, path: str, by: tuple[str, ...]) -> int:
    """Write ``rows``, replacing exactly the partitions they touch; returns the row count.

    No rows means no partition is touched, so earlier data stay. The rebalance groups each
    partition into few files and splits one that is too large for a single task.
    """
    counted = Observation("written")
    (
        rows.hint("rebalance", *by)
        .observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    return counted.get["rows"]


def empty_folders(spark: SparkSession, schema: T.StructType, path: str, folders: Iterable[str]) -> None:
    """Leave no rows in the given folders; a dynamic overwrite only sees folders that it fills."""
    nothing = spark.createDataFrame([], schema)
    for folder in folders:
        nothing.write.mode("overwrite").parquet(f"{path}/{folder}")


# Characters that folder names hold as %XX.
_ESCAPED = {*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"}


def folder_name(column: str, value) -> str:
    """Name of the folder that holds ``value`` (text, numbers or dates) of a partition column."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))


def with_folder_columns(daily: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Adds the year and month of ``date`` where the layout names them."""
    parts = {"year": F.year("date"), "month": F.month("date")}
    return daily.withColumns({name: part for name, part in parts.items() if name in by})


def write_daily_climate(
    daily: DataFrame, path: str, by: tuple[str, ...] = CLIMATE_BY_DATE
) -> int:
    """Daily climate rows in one of the folder layouts above."""
    return replace_partitions(with_folder_columns(daily, by), path, by)


def with_admission_month(admissions: DataFrame) -> DataFrame:
    return admissions.withColumn("admission_month", month_start(F.col("admission_date")))


# What is kept beside each month of admissions, so that a merge opens only months that can matter.
ADMISSION_SIDES = {"index": key_index.index}


def write_admissions(
    admissions: DataFrame,
    path: str,
    emptied: Iterable[str] = (),
    base: snapshots.Snapshot | None = None,
    label: str | None = None,
) -> int:
    """Publish clean admissions by admission month, replacing the months they touch; undated records share the default folder."""
    missing = {n: F.lit(None).cast("string") for n in VERSIONED_ADMISSIONS.names if n not in (*admissions.columns, "admission_month")}
    rows = with_admission_month(admissions.withColumns(missing)).select(*VERSIONED_ADMISSIONS.names)
    return snapshots.replace_folders(rows, path, ("admission_month",), emptied, ADMISSION_SIDES, base, label)


def with_mart_month(mart: DataFrame) -> DataFrame:
    return mart.withColumn("mart_month", month_start(F.col("date_day")))


def with_state(rows: DataFrame, name: str, locations: DataFrame, stations: DataFrame) -> DataFrame:
    """Adds the state that a row of a fact or the mart belongs to: its municipality's, else its station's; NULL if neither is known.

    ``locations`` holds ibge_code and state, ``stations`` station_code and state, both one row per place.
    """
    municipality, station = MODEL_PLACES[name]
    state, joined = [], rows
    for column, places, code in ((municipality, locations, "ibge_code"), (station, stations, "station_code")):
        if column is not None:
            known = places.select(F.col(code).alias(f"{code}_of"), F.col("state").alias(f"{code}_state"))
            joined = joined.join(known, F.col(column) == F.col(f"{code}_of"), "left").drop(f"{code}_of")
            state.append(f"{code}_state")
    return joined.withColumn("state", F.coalesce(*state)).drop(*state)


def write_mart(mart: DataFrame, path: str, emptied: Iterable[str] = (), base: snapshots.Snapshot | None = None) -> int:
    """Publish the mart by month of its day, or by state and month if it carries a state; replaces the folders it holds."""
    by = ("state", "mart_month") if "state" in mart.columns else ("mart_month",)
    return snapshots.replace_folders(with_mart_month(mart), path, by, emptied, base=base)


def land_admissions(records: DataFrame, path: str, order: str) -> None:
    """Land raw records by state and competence; a republished competence replaces its folder.

    ``order`` is the place of a record in its source. Range partitions number their files in that
    order, so it survives as (file, row) however many files a competence takes.
    """
    place = ("state", "competence", order)
    (
        records.repartitionByRange(*place)
        .sortWithinPartitions(*place)
        .select(*RAW_ADMISSIONS.names)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("state", "competence")
        .parquet(path)
    )


def write_table(rows: DataFrame, path: str) -> None:
    """A plain table: one full rewrite, for results that nobody reads meanwhile."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


# Models that are published in folders, one per month of the named day; the others have none.
MODEL_DAYS = {
    "fct_respiratory_admissions": ("fact_month", "fk_date"),
    "fct_daily_climate": ("fact_month", "fk_date"),
    "mart_climate_health_correlation": ("mart_month", "date_day"),
}


# Columns of these models that name a municipality and a station.
MODEL_PLACES = {
    "fct_respiratory_admissions": ("fk_municipality", None),
    "fct_daily_climate": (None, "fk_station"),
    "mart_climate_health_correlation": ("fk_municipality", "station_code"),
}


def publish_model(
    rows: DataFrame, path: str, name: str, locations: DataFrame | None = None, stations: DataFrame | None = None
) -> DataFrame:
    """Publish a whole model, and give its rows as published. With places, facts and mart lie in folders by state and month."""
    folder, day = MODEL_DAYS.get(name, (None, None))
    by = (folder,) if folder else ()
    dealt = rows.withColumn(folder, month_start(F.col(day))) if folder else rows
    if folder and locations is not None:
        dealt, by = with_state(dealt, name, locations, stations), ("state", folder)
        dealt = dealt.select(*rows.columns, *by)
    held = snapshots.replace_table(dealt, path, by)
    return snapshots.read_snapshot(rows.sparkSession, path, dealt.schema, held).select(*rows.columns)


def publish_views(models: Mapping[str, DataFrame]) -> None:
    """Make models readable by name in SQL."""
    for name, rows in models.items():
        rows.createOrReplaceTempView(name)
