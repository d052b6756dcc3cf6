"""Volume, schema and freshness of the stored tables."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora.sources.archive_members import open_store


def volume_anomalies(
    rows: DataFrame,
    day: str,
    group: str,
    window_days: int = 28,
    threshold: float = 3.0,
) -> DataFrame:
    """Daily row counts per group that lie far from the mean of the preceding days.

    Counts come first (combined before the shuffle). A day without rows between the first and the
    last day of its group counts as 0, so an outage is seen; the window runs over those days.
    """
    counts = rows.groupBy(F.col(group).alias("group_key"), F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    calendar = counts.groupBy("group_key").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = calendar.filter("first IS NOT NULL").select(
        F.col("group_key").alias("key"), F.explode(F.sequence("first", "last")).alias("on")
    )
    same = F.col("key").eqNullSafe(F.col("group_key")) & (F.col("on") == F.col("day"))
    counts = calendar.join(counts, same, "left").select(
        F.col("key").alias("group_key"),
        F.col("on").alias("day"),
        F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count"),
    )
    before = W.partitionBy("group_key").orderBy("day").rowsBetween(-window_days, -1)
    judged = counts.select(
        "group_key",
        "day",
        "row_count",
        F.count("row_count").over(before).alias("days_before"),
        F.avg("row_count").over(before).alias("expected"),
        F.stddev_pop("row_count").over(before).alias("spread"),
    )
    return judged.filter(
        (F.col("days_before") == window_days)
        & (F.abs(F.col("row_count") - F.col("expected")) > threshold * F.col("spread"))
    )


def _middle(values: Column) -> Column:
    """Median of a sorted array; NULL for an empty one."""
    n = F.size(values)
    low, high = F.get(values, ((n - 1) / 2).cast("int")), F.get(values, (n / 2).cast("int"))
    return (low + high) / 2


def feed_anomalies(
    rows: DataFrame,
    day: str,
    group: str,
    as_of: date,
    first: date,
    weeks: int = 8,
    limit: float = 4.0,
    silence: int = 3,
) -> DataFrame:
    """Days of a feed that do not look like the same weekday of the weeks before, or that end a silence.

    The calendar of a group runs from its first day, but not before ``first``, to the day before ``as_of``: a feed that has
    stopped is seen as long as it is watched, and stray dates before ``first`` or from ``as_of`` on do not count. A day
    is ``low`` or ``high`` when its count is further from the median of that weekday in the last ``weeks`` weeks than ``limit`` times their
    spread, so neither weekly dips nor single bad days in the past raise an alarm. The spread is the median distance from
    that median, scaled as for a normal distribution, but at least the square root of the median (what counts of
    independent records vary by) and 1. It is ``silent`` when it is the ``silence``-th day without rows, or a later one, which does not fade
    as the silence becomes usual.

    Columns: group_key, day, row_count, expected, spread, silent_days, kind. Groups, NULL included, are watched apart.
    """
    counts = rows.groupBy(F.col(group).alias("group_key"), F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("row_count")
    ).filter(F.col("day").between(first, as_of - timedelta(days=1)))
    calendar = counts.groupBy("group_key").agg(F.min("day").alias("start")).select(
        F.col("group_key").alias("key"), F.explode(F.sequence("start", F.lit(as_of - timedelta(days=1)))).alias("on")
    )
    same = F.col("key").eqNullSafe(F.col("group_key")) & (F.col("on") == F.col("day"))
    filled = calendar.join(counts, same, "left").select(
        F.col("key").alias("group_key"), F.col("on").alias("day"), F.coalesce("row_count", F.lit(0)).cast("long").alias("row_count")
    )
    history = W.partitionBy("group_key", F.weekday("day")).orderBy("day").rowsBetween(-weeks, -1)
    so_far = W.partitionBy("group_key").orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    seen = filled.withColumns({
        "before": F.sort_array(F.collect_list("row_count").over(history)),  # as many as weeks
        "heard": F.max(F.when(F.col("row_count") > 0, F.col("day"))).over(so_far),
    })
    expected = seen.withColumn("expected", F.when(F.size("before") == weeks, _middle(F.col("before"))))
    away = F.sort_array(F.transform("before", lambda n: F.abs(n - F.col("expected"))))
    judged = expected.withColumns({
        "spread": F.greatest(1.4826 * _middle(away), F.sqrt("expected"), F.when(F.col("expected").isNotNull(), 1.0)),
        "silent_days": F.datediff("day", "heard"),
    })
    kind = (
        F.when(F.col("silent_days") >= silence, "silent")
        .when(F.col("row_count") < F.col("expected") - limit * F.col("spread"), "low")
        .when(F.col("row_count") > F.col("expected") + limit * F.col("spread"), "high")
    )
    return judged.select(
        "group_key", "day", "row_count", "expected", "spread", "silent_days", kind.alias("kind")
    ).filter("kind IS NOT NULL")


def schema_drift(rows: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns that are missing, unexpected, or of another type, beside the rows they concern."""
    have = {f.name: f.dataType.simpleString() for f in rows.schema}
    want = {f.name: f.dataType.simpleString() for f in expected}
    found = [
        F.struct(F.lit(name), F.lit(want.get(name)), F.lit(have.get(name)))
        for name in sorted(have.keys() | want.keys())
        if have.get(name) != want.get(name)
    ]
    entry = "array<struct<column:string,expected_type:string,actual_type:string>>"
    return rows.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.inline(F.array(*found).cast(entry)), "row_count"
    )


def freshness(rows: DataFrame, day: str, as_of: date, limit_days: int) -> DataFrame:
    """Latest day, its age at ``as_of``, and whether that is too old; an empty table is stale."""
    latest = rows.agg(F.max(day).alias("latest"))
    age = F.datediff(F.lit(as_of), F.col("latest"))
    return latest.select(
        "latest",
        age.alias("age_days"),
        F.coalesce(age > limit_days, F.lit(True)).alias("is_stale"),
    )


# Types of Parquet columns, as Arrow names them, by Spark's names.
_TYPES = {
    "string": "string", "large_string": "string", "double": "double", "float": "float", "int32": "int", "int64": "bigint",
    "int16": "smallint", "int8": "tinyint", "bool": "boolean", "date32[day]": "date", "binary": "binary",
}


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns of each file, from its footer."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            store, inside = open_store(path)
            with store.open_input_file(inside) as file:
                found = pq.read_schema(file)
            rows = [(path, f.name, _TYPES.get(str(f.type), str(f.type))) for f in found]
            yield pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(("path", "column", "actual_type"))}, _FOOTER)


_FOOTER = pa.schema([("path", pa.string()), ("column", pa.string()), ("actual_type", pa.string())])


def file_drift(spark: SparkSession, root: str, expected: T.StructType, folders: tuple[str, ...] = ()) -> DataFrame:
    """Columns of stored Parquet files that are missing, unexpected, or of another type: column, expected_type, actual_type, folders.

    Reading a table with a stated schema hides these: a missing column is NULL, an unexpected one is not read. Every file's
    footer is read, by tasks, and nothing else of it; ``folders`` counts the folders whose files differ in that way. Columns that
    ``root`` holds as folders are named, as files do not have them. Files are opened by Arrow's file systems.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root).select("path")
    found = files.mapInArrow(_footers, "path string, column string, actual_type string")
    want = {f.name: f.dataType.simpleString() for f in expected if f.name not in folders}
    known = spark.createDataFrame(sorted(want.items()), "column string, expected_type string")
    per_file = found.withColumn("folder", F.regexp_replace("path", "/[^/]*$", ""))
    odd = per_file.join(known, "column", "left").where(~F.col("expected_type").eqNullSafe(F.col("actual_type")))
    names = per_file.groupBy("path", "folder").agg(F.collect_set("column").alias("have"))
    wanted = F.array(*[F.struct(F.lit(n).alias("column"), F.lit(t).alias("expected_type")) for n, t in sorted(want.items())])
    missing = names.select("folder", "have", F.inline(wanted)).where(~F.array_contains("have", F.col("column")))
    both = odd.select("column", "expected_type", "actual_type", "folder").unionByName(
        missing.select("column", "expected_type", F.lit(None).cast("string").alias("actual_type"), "folder")
    )
    return both.groupBy("column", "expected_type", "actual_type").agg(F.countDistinct("folder").alias("folders"))
