"""Correlation of temperature with admissions some days later."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def lagged_correlation(mart: DataFrame, max_lag: int = 14) -> DataFrame:
    """Pearson correlation per station of a day's temperature with the admissions k days later.

    The mart is folded to one row per station and day. The admissions k days on come from a window
    range of exactly that distance, so days without any row count 0 and need not be filled in;
    days after a station's last one are unknown.
    """
    daily = (
        mart.filter(F.col("station_code").isNotNull() & F.col("date_day").isNotNull())
        .groupBy("station_code", "date_day")
        .agg(
            F.max("avg_temp").alias("avg_temp"),
            F.sum("daily_admission_count").alias("admissions"),
        )
        .withColumn("day_no", F.unix_date("date_day"))
    )
    station = W.partitionBy("station_code")
    by_day = station.orderBy("day_no")
    last_day = F.max("day_no").over(station)
    later = [
        F.when(
            F.col("day_no") + k <= last_day,
            F.coalesce(F.sum("admissions").over(by_day.rangeBetween(k, k)), F.lit(0)),
        )
        for k in range(max_lag + 1)
    ]
    pairs = daily.select("station_code", "avg_temp", F.array(*later).alias("later")).select(
        "station_code", "avg_temp", F.posexplode("later").alias("lag_days", "admissions")
    )
    # Rows are already partitioned by station here, so this grouping needs no further shuffle.
    return pairs.groupBy("station_code", "lag_days").agg(
        F.corr("avg_temp", F.col("admissions").cast("double")).alias("correlation")
    )
