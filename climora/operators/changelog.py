"""What changed between two states of a table, row by row, and tables that follow such a log.

A log row holds the key, ``op`` (insert, update or delete), and ``old`` and ``new``, the other columns before and after; one of
them is null for rows that came or went. A delete is the tombstone of its key: replaying a log needs nothing else.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora.sources import snapshots

STEP = "snapshot"


def _same(left: str, right: str, key: tuple[str, ...]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in key])


def row_changes(before: DataFrame, after: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows that differ between two states with the same columns and one row per key; null is a key like any other.

    One full outer join on the key. A row whose columns are all equal, nulls included, gives no change.
    """
    values = [c for c in before.columns if c not in key]

    def side(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*key, F.struct(*values).alias(name), F.lit(True).alias("there")).alias(name)

    joined = side(before, "old").join(side(after, "new"), _same("old", "new", key), "full_outer")
    op = F.when(F.col("old.there").isNull(), "insert").when(F.col("new.there").isNull(), "delete").when(
        ~F.col("old.old").eqNullSafe(F.col("new.new")), "update"
    )
    return joined.select(
        op.alias("op"), *[F.coalesce(f"new.{k}", f"old.{k}").alias(k) for k in key],
        F.col("old.old").alias("old"), F.col("new.new").alias("new"),
    ).where("op IS NOT NULL")


def apply_changes(rows: DataFrame, log: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The table after a log with at most one change per key: ``apply_changes(before, row_changes(before, after, key), key)`` is ``after``."""
    changed = log.select(*key).alias("k")
    kept = rows.alias("r").join(changed, _same("r", "k", key), "left_anti")
    return kept.unionByName(log.where("op <> 'delete'").select(*key, "new.*"))


def table_changes(
    spark: SparkSession, path: str, schema: T.StructType, key: tuple[str, ...], since: int, until: int | None = None
) -> DataFrame:
    """Changes of a published table between two of its snapshots (0: before the first; ``until`` None: the current one).

    Only folders that differ between the two are read: a row that stayed where it is lies in a folder that did, and one
    that moved has left a folder and come into another, so both its places are read.
    """
    new = snapshots.snapshot(spark, path, until)
    old = snapshots.snapshot(spark, path, since) if since else snapshots.Snapshot(0, new.by, {}, new.sides)
    differ = {f for f in {*old.folders, *new.folders} if old.folders.get(f) != new.folders.get(f)}
    before, after = (snapshots.read_snapshot(spark, path, schema, snapshots.narrowed(s, differ)) for s in (old, new))
    return row_changes(before, after, key)


def _log_schema(schema: T.StructType, key: tuple[str, ...]) -> T.StructType:
    values = T.StructType([T.StructField(f.name, f.dataType) for f in schema if f.name not in key])
    return T.StructType([
        T.StructField("op", T.StringType()), *[schema[k] for k in key],
        T.StructField("old", values), T.StructField("new", values), T.StructField(STEP, T.LongType()),
    ])


def logged_until(spark: SparkSession, log: str) -> int:
    """Number of the snapshot up to which a stored log tells the changes; 0 for no log."""
    held = snapshots.snapshot(spark, log)
    return int(held.label) if held else 0


def append_changes(spark: SparkSession, path: str, log: str, schema: T.StructType, key: tuple[str, ...]) -> int:
    """Add what changed since the last call to the stored log, a folder for each call; returns how many rows changed.

    Several snapshots since then are told as one step. A call after a failure, or without a new snapshot, adds nothing
    twice: the log keeps the number that it has come to with its rows. If that snapshot has expired, the log cannot go on
    and a ``ValueError`` says so.
    """
    current, done = snapshots.snapshot(spark, path), logged_until(spark, log)
    if current is None or current.number == done:
        return 0
    if done and done not in snapshots.snapshot_numbers(spark, path):
        raise ValueError(f"{log} has come to snapshot {done} of {path}, which has expired: start a new log")
    rows = table_changes(spark, path, schema, key, done, current.number).withColumn(STEP, F.lit(current.number).cast("long"))
    held = snapshots.snapshot(spark, log)
    written = snapshots.write_beside(rows.select(*_log_schema(schema, key).names), log, (STEP,))
    snapshots.commit(spark, log, (STEP,), written, base=held, label=str(current.number))
    return written.rows


def read_changes(spark: SparkSession, log: str, schema: T.StructType, key: tuple[str, ...], after: int = 0) -> DataFrame:
    """The stored log, or its steps after a snapshot; filters on ``snapshot`` open only those steps."""
    return snapshots.read_published(spark, log, _log_schema(schema, key)).where(F.col(STEP) > after)


def replayed(log: DataFrame, key: tuple[str, ...], columns: list[str]) -> DataFrame:
    """The table that a whole log leads to: each key as its last change left it, without those it deleted.

    ``row_number() = 1`` lets each task keep the last change of a key before the shuffle.
    """
    last = Window.partitionBy(*key).orderBy(F.col(STEP).desc())
    kept = log.withColumn("place", F.row_number().over(last)).where("place = 1 AND op <> 'delete'")
    return kept.select(*key, "new.*").select(*columns)
