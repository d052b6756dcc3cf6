"""Care of published tables: small files packed together, and plain tables moved to another folder layout."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora import schemas
from climora.sources import sinks, snapshots, tables

logger = logging.getLogger(__name__)

TARGET_BYTES = 128 << 20


def pack_files(sizes: Mapping[str, int], target: int) -> dict[str, int]:
    """Bin of each file of a folder, by the first-fit rule on falling sizes; a file of ``target`` bytes or more is alone."""
    room: list[int] = []
    bins = {}
    for name in sorted(sizes, key=lambda n: (-sizes[n], n)):
        spot = next((i for i, left in enumerate(room) if sizes[name] <= left), len(room))
        if spot == len(room):
            room.append(target)
        room[spot] -= sizes[name]
        bins[name] = spot
    return bins


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target_bytes: int = TARGET_BYTES,
    sides: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> int:
    """Pack the files of each folder into as few as hold ``target_bytes`` each; returns how many files there are less.

    What goes together is decided from file sizes alone, and only folders that then have fewer files are rewritten, in
    one snapshot: the rows of a file go straight to the task that writes its bin. Rows, and what is kept beside them (give the
    same ``sides`` as the table's writer), stay the same; if another writer replaces one of these folders meanwhile,
    nothing is changed and ``ConcurrentChange`` is raised.
    """
    held = snapshots.snapshot(spark, path)
    if held is None:
        return 0
    plan, folders, tasks, less = [], [], 0, 0
    for folder, sizes in snapshots.files_of(spark, path, held).items():
        bins = pack_files(sizes, target_bytes)
        count = max(bins.values(), default=-1) + 1
        if count < len(bins):
            plan += [(*snapshots.folder_values(folder), name, tasks + spot) for name, spot in bins.items()]
            folders.append(folder)
            tasks, less = tasks + count, less + len(bins) - count
    if not folders:
        return 0
    named = T.StructType([T.StructField(f"folder_{c}", T.StringType()) for c in held.by] + [
        T.StructField("packed_file", T.StringType()), T.StructField("packed_task", T.IntegerType())
    ])
    # A row per file that is packed.
    files = spark.createDataFrame(plan, named).withColumns({f"folder_{c}": F.col(f"folder_{c}").cast(schema[c].dataType) for c in held.by})
    rows = snapshots.read_snapshot(spark, path, schema, snapshots.narrowed(held, folders)).select("*", F.col("_metadata.file_name").alias("file"))
    same = F.col("file") == F.col("packed_file")
    for c in held.by:
        same = same & F.col(c).eqNullSafe(F.col(f"folder_{c}"))
    dealt = rows.join(files, same).repartitionById(tasks, F.col("packed_task")).select(*schema.names)
    written = snapshots.write_beside(dealt, path, held.by, sides, dealt=True)
    snapshots.commit(spark, path, held.by, written, (), held, held.label)
    logger.info("packed %d folders of %s: %d files less", len(folders), path, less)
    return less


def compact_climate(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> int:
    """Pack the files of a published table of daily climate, in its own layout."""
    held = snapshots.snapshot(spark, path)
    if held is None:
        return 0
    parts = {"year": T.IntegerType(), "month": T.IntegerType()}
    inside = [f for f in schemas.DAILY_CLIMATE if f.name not in held.by]
    folders = [schemas.DAILY_CLIMATE[c] if c in schemas.DAILY_CLIMATE.names else T.StructField(c, parts[c]) for c in held.by]
    return compact(spark, path, T.StructType([*inside, *folders]), target_bytes)


def compact_admissions(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> int:
    """Pack the files of the stored admissions."""
    return compact(spark, path, schemas.VERSIONED_ADMISSIONS, target_bytes, sinks.ADMISSION_SIDES)


def migrate_climate(
    spark: SparkSession, source: str, target: str, by: tuple[str, ...] = sinks.CLIMATE_BY_STATE_MONTH
) -> list[str]:
    """Move daily climate from plain day folders to a published table by state and month, a month at a time.

    A month is published as a whole, so the target can be read and the move stopped at any time; called again, it goes on after
    the last month that was published. The source stays as it is. Returns the months moved by this call.
    """
    if "month" not in by:
        raise ValueError("months are moved one at a time: the layout has to name year and month")
    days = [d for (d,) in tables.folders_below(spark, source, "date")]
    held = snapshots.snapshot(spark, target)
    done = held.label if held else ""
    moved = []
    for month in sorted({d[:7] for d in days if d != "__HIVE_DEFAULT_PARTITION__"}):
        if month > done:
            inside = [d for d in days if d.startswith(month)]
            rows = tables.read_daily_climate(spark, source).where(F.col("date").isin(*[F.lit(d).cast("date") for d in inside]))
            snapshots.replace_folders(sinks.with_folder_columns(rows, by), target, by, label=month)
            moved.append(month)
    return moved
