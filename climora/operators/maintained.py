"""Regional series that are kept stored, and follow the published mart month by month.

What is stored are the parts of the series: sums, counts and the latest day of each (granularity, period, region, state) within
one month folder of the mart. Parts of different months add up to any period, weeks over the end of a month included. When
folders of the mart change, their parts are computed anew and all others stay; nothing is subtracted, so the
series is that of the whole mart however often it was maintained, and a latest day that went away is gone.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora.operators.rollups import regional_series, regional_sums
from climora.schemas import MART
from climora.sources import snapshots

GRANULARITIES = ("weekly", "monthly")
MONTH = "mart_month"
PARTS = T.StructType(
    [
        T.StructField("granularity", T.StringType()),
        T.StructField("period", T.DateType()),
        T.StructField("region", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("temp_sum", T.DoubleType()),
        T.StructField("temp_n", T.LongType()),
        T.StructField("admissions", T.LongType()),
        T.StructField("last_day", T.DateType()),
        T.StructField(MONTH, T.DateType()),
    ]
)


def monthly_parts(mart: DataFrame, locations: DataFrame, stations: DataFrame) -> DataFrame:
    """Parts of the series of all granularities, by month of the mart."""
    parts = [
        regional_sums(mart, locations, stations, g, MONTH).withColumn("granularity", F.lit(g)) for g in GRANULARITIES
    ]
    return reduce(DataFrame.unionByName, parts).select(*PARTS.names)


def _places_mark(locations: DataFrame, stations: DataFrame) -> str:
    """Checksum of which state each place belongs to: one number from two small tables."""
    rows = locations.select(F.lit("l"), F.col("ibge_code"), F.col("state")).union(stations.select(F.lit("s"), "station_code", "state"))
    return str(rows.agg(F.sum(F.xxhash64(*rows.columns).cast("decimal(20,0)")), F.count(F.lit(1))).first())


def maintain_regional(
    spark: SparkSession, mart: str, output: str, locations: DataFrame, stations: DataFrame
) -> list[str]:
    """Bring the parts stored at ``output`` up to date with the mart; returns the month folders that were computed.

    The stored parts say which snapshot of the mart they are of. Folders that differ from it are read, all of them where it has
    expired, or where a municipality or station has come into another state. A run that fails, or that another run
    overtakes, leaves the parts as they were.
    """
    current, held = snapshots.snapshot(spark, mart), snapshots.snapshot(spark, output)
    if current is None:
        return []
    places = _places_mark(locations, stations)
    done = json.loads(held.label) if held else {}
    known = done.get("mart") in snapshots.snapshot_numbers(spark, mart) and done.get("places") == places
    before = snapshots.snapshot(spark, mart, done["mart"]).folders if known else {}
    stale = (set(held.folders) if held else set()) if not known else set()
    # The last part of a folder of the mart is its month, whether or not it lies in one of a state.
    differ = {f.rsplit("/", 1)[-1] for f in {*before, *current.folders} if before.get(f) != current.folders.get(f)} | stale
    if not differ:
        return []
    changed = snapshots.narrowed(current, [f for f in current.folders if f.rsplit("/", 1)[-1] in differ])
    by_state = [T.StructField("state", T.StringType())] if "state" in current.by else []
    rows = snapshots.read_snapshot(spark, mart, T.StructType([*MART, *by_state, T.StructField(MONTH, T.DateType())]), changed).drop("state")
    parts = monthly_parts(rows, locations, stations)
    written = snapshots.write_beside(parts, output, (MONTH,))
    gone = differ - set(written.folders)
    label = json.dumps({"mart": current.number, "places": places})
    snapshots.commit(spark, output, (MONTH,), written, gone, held, label)
    return sorted(differ)


def read_regional(spark: SparkSession, output: str, granularity: str, number: int | None = None) -> DataFrame:
    """The stored series of one granularity: period, region, state, avg_temp, admission_count, last_day."""
    if granularity not in GRANULARITIES:
        raise ValueError(f"stored are {GRANULARITIES}")
    parts = snapshots.read_published(spark, output, PARTS, number).where(F.col("granularity") == granularity)
    return regional_series(parts)
