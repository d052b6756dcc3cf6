"""Stored tables: landed admissions, climate and admission Parquet, reference CSVs."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora import schemas
from climora.sources.snapshots import folder_names, read_published, read_snapshot, snapshot


def read_landed_admissions(
    spark: SparkSession,
    root: str,
    competences: Iterable[str] | None = None,
    states: Iterable[str] | None = None,
) -> DataFrame:
    """Raw admission records landed as Parquet under ``root/state=…/competence=yyyy-MM/``.

    Competences and states are folder predicates. ``source_file`` and ``source_row`` keep the
    order in which a file lists its records. A competence that was never landed is simply absent.
    """
    landed = spark.read.schema(schemas.RAW_ADMISSIONS).parquet(root)
    rows = landed.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.row_index").alias("source_row"),
    )
    if competences is not None:
        rows = rows.filter(F.col("competence").isin(*competences))
    if states is not None:
        rows = rows.filter(F.col("state").isin(*states))
    return rows


def read_daily_climate(
    spark: SparkSession,
    root: str,
    start: date | None = None,
    end: date | None = None,
    by: tuple[str, ...] = ("date",),
) -> DataFrame:
    """Daily climate rows of any folder layout, published or plain; values held by folder names are typed by the schema.

    With a date range, only the folders of the layout ``by`` (of a published table: its own) that can hold its days are read. The
    days themselves are then still to be filtered, as a month is read as a whole.
    """
    held = snapshot(spark, root)
    by = held.by if held else by
    months = [T.StructField(name, T.IntegerType()) for name in ("year", "month") if name in by]
    schema = T.StructType([*schemas.DAILY_CLIMATE, *months])
    rows = read_snapshot(spark, root, schema, held) if held else spark.read.schema(schema).parquet(root)
    if months:
        day, number = F.col("year") * 100 + F.col("month"), lambda d: d.year * 100 + d.month
    else:
        day, number = F.col("date"), lambda d: d
    if start is not None:
        rows = rows.filter(day >= F.lit(number(start)))
    if end is not None:
        rows = rows.filter(day <= F.lit(number(end)))
    return rows.select(*schemas.DAILY_CLIMATE.names)


def read_admissions(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """Stored admissions: those of the current snapshot or of a numbered one, or the plain files of an unpublished table."""
    return read_published(spark, root, schemas.ADMISSIONS, number)


def read_mart(
    spark: SparkSession, root: str, number: int | None = None, states: Iterable[str] | None = None
) -> DataFrame:
    """The mart as published by month, or by state and month; ``mart_month`` stays, as filters on it skip folders.

    ``states`` needs a mart by state, of which only their folders are read.
    """
    schema = T.StructType([*schemas.MART, T.StructField("mart_month", T.DateType())])
    held = snapshot(spark, root, number)
    if held is None or "state" not in held.by:
        if states is not None:
            raise ValueError(f"{root} is not stored by state")
        return read_published(spark, root, schema, number)
    rows = read_snapshot(spark, root, T.StructType([*schemas.MART, T.StructField("state", T.StringType()), schema["mart_month"]]), held)
    if states is not None:
        rows = rows.filter(F.col("state").isin(*states))
    return rows.select(*schema.names)


def folders_below(spark: SparkSession, root: str, *columns: str) -> list[tuple[str, ...]]:
    """Values that the folders ``column=value`` below ``root`` stand for, level by level; none if there is no ``root``."""
    names = folder_names(spark, root, len(columns))
    return [tuple(part.split("=", 1)[1] for part in name.split("/")) for name in names if all(
        part.startswith(f"{column}=") for part, column in zip(name.split("/"), columns)
    )]


def read_municipalities(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(schemas.MUNICIPALITIES).csv(path)


def read_station_mapping(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(schemas.STATION_MAPPING).csv(path)


def prefer_fresh(
    history: DataFrame, fresh: DataFrame, key: tuple[str, ...] = ("station_code", "date")
) -> DataFrame:
    """Finished history plus a fresh window; a key present in both comes from the fresh side."""
    replaced = fresh.select(*key).distinct()
    return history.join(replaced, list(key), "left_anti").unionByName(fresh)
