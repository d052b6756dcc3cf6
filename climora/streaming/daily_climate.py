"""Daily climate kept up to date from a stream of typed readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from climora.operators.changes import merge_daily_climate
from climora.operators.climate import daily_measures
from climora.params import LOOKBACK_DAYS
from climora.schemas import DAILY_CLIMATE


def stream_daily(readings: DataFrame, lateness_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Running station-days over a stream of readings.

    State is kept for ``lateness_days``. A reading that arrives later than that does not enter the
    stream's result any more; the batch job over the archive is the way to bring it in.
    """
    # Days as UTC midnights, computed without the session's zone.
    midnight = F.timestamp_seconds(F.unix_date("date").cast("long") * 86400)
    day = F.date_from_unix_date((F.unix_seconds("reading_day") / 86400).cast("int"))
    return (
        readings.withColumn("reading_day", midnight)
        .withWatermark("reading_day", f"{lateness_days} days")
        .groupBy("station_code", "reading_day")
        .agg(*daily_measures())
        .withColumn("date", day)
        .drop("reading_day")
    )


def maintain_daily_climate(
    readings: DataFrame, path: str, checkpoint: str, lateness_days: int = LOOKBACK_DAYS
) -> StreamingQuery:
    """Write the changed station-days of each micro-batch into the stored climate table.

    A replayed batch writes the same rows to the same folders.
    """

    def store(changed: DataFrame, batch_id: int) -> None:
        spark: SparkSession = changed.sparkSession
        rows = changed.select(*DAILY_CLIMATE.names).persist()
        try:
            merge_daily_climate(spark, rows, path)
        finally:
            rows.unpersist()

    return (
        stream_daily(readings, lateness_days)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
        .trigger(availableNow=True)
        .start()
    )
