"""Incremental work: which competences changed, and merging new rows into stored tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from climora.operators import key_index
from climora.operators.admissions import clean_admissions, is_in_municipalities, matches_diagnosis
from climora.schemas import VERSION, VERSIONED_ADMISSIONS
from climora.session import discard, observed, staged
from climora.sources import snapshots
from climora.sources.sinks import (
    CLIMATE_BY_DATE,
    empty_folders,
    folder_name,
    replace_partitions,
    with_admission_month,
    with_folder_columns,
    write_admissions,
)
from climora.sources.tables import read_daily_climate

FINGERPRINT = ("state", "competence", "row_count", "checksum")


def fingerprints(records: DataFrame) -> DataFrame:
    """Row count and checksum of each landed (state, competence).

    Keep-last depends on the order of the records of one key, so each of them is weighted by its
    distance from the first one. The order of different keys does not count. Both sums are combined
    before the shuffle, which sends one row per task and key.
    """
    measures = [c for c in records.columns if c not in ("source_file", "source_row")]
    number = F.coalesce(F.regexp_extract("source_file", r"part-(\d+)[^/]*$", 1).try_cast("bigint"), F.lit(0))
    place = (number * F.lit(1 << 40) + F.col("source_row")).cast("decimal(18,0)")
    short = F.pmod(F.xxhash64(*measures), F.lit(1 << 31)).cast("decimal(10,0)")
    per_key = (
        records.select("state", "competence", "N_AIH", F.xxhash64(*measures).alias("full"), short.alias("short"), place.alias("place"))
        .groupBy("state", "competence", "N_AIH")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.col("full").cast("decimal(20,0)")).alias("content"),
            (F.sum(F.col("short") * F.col("place")) - F.min("place") * F.sum("short")).alias("order"),
        )
    )
    return per_key.groupBy("state", "competence").agg(
        F.sum("rows").alias("row_count"),
        F.sum(F.xxhash64("N_AIH", "rows", "content", "order").cast("decimal(20,0)")).alias("checksum"),
    )


def changed_competences(current: DataFrame, manifest: DataFrame) -> DataFrame:
    """(state, competence) pairs that are new, or whose content differs from the manifest."""
    return (
        current.select(*FINGERPRINT)
        .join(manifest.select(*FINGERPRINT), list(FINGERPRINT), "left_anti")
        .select("state", "competence")
    )


def merge_daily_climate(
    spark: SparkSession, fresh: DataFrame, path: str, by: tuple[str, ...] = CLIMATE_BY_DATE
) -> int:
    """Merge fresh station-days into the stored climate table; returns how many there are.

    The fresh rows are written aside once. Only the folders of their days are read, and only those
    rewritten that get a fresh row or, where the state of a station has changed, lose its old one;
    other stations and days in them stay. A table that does not exist yet is created. A published table (``layout.migrate_climate``)
    keeps its own layout, and gets all of the merge in one snapshot.
    """
    held = snapshots.snapshot(spark, path)
    by = held.by if held else by
    rows = staged(with_folder_columns(fresh, by), "climate")
    first, last, count = rows.agg(F.min("date"), F.max("date"), F.count(F.lit(1))).first()
    if count and held:
        _publish_merged_climate(spark, rows, path, held, first, last)
    elif count:
        _merge_staged_climate(spark, rows, path, by, first, last)
    discard(rows)
    return count


def _publish_merged_climate(
    spark: SparkSession, rows: DataFrame, path: str, held: snapshots.Snapshot, first: date, last: date
) -> None:
    by, key = held.by, ["station_code", "date"]
    keys = rows.select(*key).distinct()
    stored = with_folder_columns(read_daily_climate(spark, path, first, last), by)
    # Folders between two dates: of the fresh rows, and of the old versions that they replace.
    found = rows.select(*by).union(stored.join(keys, key, "left_semi").select(*by)).distinct().collect()
    touched = {"/".join(folder_name(c, r[c]) for c in by) for r in found}
    schema = T.StructType([*[f for f in rows.schema if f.name not in by], *[rows.schema[c] for c in by]])
    old = snapshots.read_snapshot(spark, path, schema, snapshots.narrowed(held, touched))
    merged = old.join(keys, key, "left_anti").select(*schema.names).unionByName(rows)
    snapshots.replace_folders(merged, path, by, emptied=touched, base=held, label=held.label)


def _merge_staged_climate(
    spark: SparkSession, rows: DataFrame, path: str, by: tuple[str, ...], first: date, last: date
) -> None:
    try:
        stored = with_folder_columns(read_daily_climate(spark, path, first, last, by), by)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        replace_partitions(rows, path, by)
        return
    folder = F.to_json(F.struct(*by))  # equal for folders whose values are NULL too
    key = ["station_code", "date"]
    keys = rows.select(*key).distinct()
    left = stored.join(keys, key, "left_semi").select(*by, folder.alias("folder")).distinct()
    left = staged(left, "climate-folders")
    touched = left.select("folder").unionByName(rows.select(folder.alias("folder"))).distinct()
    kept = stored.withColumn("folder", folder).join(touched, "folder", "left_semi").drop("folder")
    merged = staged(kept.join(keys, key, "left_anti").unionByName(rows.select(*kept.columns)), "climate-merged")
    replace_partitions(merged, path, by)
    # Folders between two dates, of the states that stations have moved out of.
    emptied = left.join(merged.select(folder.alias("folder")).distinct(), "folder", "left_anti").collect()
    inside = T.StructType([f for f in merged.schema if f.name not in by])
    empty_folders(spark, inside, path, ["/".join(folder_name(c, row[c]) for c in by) for row in emptied])
    discard(left)
    discard(merged)


def from_folders(pairs: Iterable[tuple[str, str]]) -> Column:
    """Rows of the landed folders with these (state, competence); never NULL."""
    by_state: dict[str, list[str]] = {}
    for state, competence in pairs:
        by_state.setdefault(state, []).append(competence)
    hits = [(F.col("state") == s) & F.col("competence").isin(*months) for s, months in by_state.items()]
    return F.coalesce(reduce(Column.__or__, hits, F.lit(False)), F.lit(False))


@dataclass(frozen=True)
class AdmissionCounts:
    """Records of one run: read, of the municipalities, of these with the diagnosis, last versions kept, and in the months written.

    Should an executor be lost during the run, records that were read again count again.
    """

    raw: int
    municipality: int
    diagnosis: int
    kept: int
    written: int


def admission_counts(codes: tuple[str, ...] | list[str] | DataFrame, pattern: str) -> list[Column]:
    """Aggregates over raw records; a table of municipalities is not looked up for them, and counts as all."""
    in_scope = F.lit(True) if isinstance(codes, DataFrame) else is_in_municipalities(codes)
    return [
        F.count(F.lit(1)).alias("raw"),
        F.count_if(in_scope).alias("municipality"),
        F.count_if(in_scope & matches_diagnosis(pattern)).alias("diagnosis"),
    ]


def _month_folders(months: Iterable[date | None]) -> set[str]:
    return {folder_name("admission_month", m) for m in months}


def folders_to_open(
    spark: SparkSession, path: str, held: snapshots.Snapshot, keys: DataFrame, withdrawn: Iterable[tuple[str, str]] = ()
) -> snapshots.Snapshot:
    """The part of a snapshot of stored admissions that can hold one of the numbers, or a record of a withdrawn folder.

    Only the index beside the table is read for that.
    """
    if "index" not in held.sides:
        raise ValueError(f"{path} was published without the index of admissions")
    index = snapshots.read_side(spark, path, T.StructType.fromDDL(key_index.INDEX), held, "index")
    months = key_index.months_of_keys(keys, index)
    pairs = list(withdrawn)
    if pairs:
        months += key_index.months_of_origins(pairs, index)
    return snapshots.narrowed(held, _month_folders(months))


def merge_admissions(
    spark: SparkSession,
    updates: DataFrame,
    path: str,
    withdrawn: Iterable[tuple[str, str]] = (),
    base: snapshots.Snapshot | None = None,
    label: str | None = None,
) -> int:
    """Merge versions of admissions into the stored table, by record number.

    ``updates`` holds clean admissions, one row per record number. Where they carry ``competence``
    and ``state``, a stored record from a later (competence, state) stays: runs can come in any
    order. Updates that do not carry them win. Stored records that came from a ``withdrawn`` (state,
    competence) go, whether or not an update takes their place.

    Only months that can hold a number of the update, or a withdrawn record, are opened at all (``folders_to_open``). A
    corrected admission date can move a record to another month, so a month counts as touched when it holds an old or
    a new version. Touched months are read in full and published anew, all in one snapshot; one that loses its
    last record is emptied by it. Repeating the merge gives the same table. A table that does not exist yet is created,
    and no updates change nothing. Returns the number of records in the months written. ``base`` is the snapshot that
    the updates were computed from, if they depend on the table.
    """
    known = updates.withColumns({n: F.lit(None).cast("string") for n in VERSION if n not in updates.columns})
    fresh = staged(with_admission_month(known).select(*VERSIONED_ADMISSIONS.names), "admissions")
    pairs = list(withdrawn)
    base = base or snapshots.snapshot(spark, path)
    if base is None:
        count = 0 if fresh.isEmpty() else write_admissions(fresh, path, label=label)
        discard(fresh)
        return count
    gone = from_folders(pairs)
    same_key = F.col("s.aih_number").eqNullSafe(F.col("k.aih_number"))
    opened = folders_to_open(spark, path, base, fresh, pairs)
    old = snapshots.read_snapshot(spark, path, VERSIONED_ADMISSIONS, opened)
    key = old.select("aih_number", *VERSION, "admission_month", gone.alias("gone"))
    later = ~F.col("s.gone") & (F.struct(*[f"s.{n}" for n in VERSION]) > F.struct(*[f"k.{n}" for n in VERSION]))
    known_pair = reduce(Column.__and__, [F.col(f"{t}.{n}").isNotNull() for t in "sk" for n in VERSION])
    met = staged(
        key.alias("s")
        .join(fresh.alias("k"), same_key)
        .select("s.aih_number", F.col("s.admission_month").alias("month"), (known_pair & later).alias("later")),
        "admissions-met",
    )
    wins = fresh.alias("s").join(met.where("later").alias("k"), same_key, "left_anti")
    months = (
        met.where("NOT later").select("month")
        .union(key.where("gone").select("admission_month"))
        .union(wins.select("admission_month"))
    )
    # Calendar months: a few hundred values at most.
    touched = _month_folders(r[0] for r in months.distinct().collect())
    count = 0
    if touched:
        whole = snapshots.read_snapshot(spark, path, VERSIONED_ADMISSIONS, snapshots.narrowed(base, touched))
        kept = whole.filter(~gone).alias("s").join(wins.alias("k"), same_key, "left_anti")
        count = write_admissions(kept.unionByName(wins), path, emptied=touched, base=base, label=label)
    discard(met)
    discard(fresh)
    return count


def merge_folders(
    spark: SparkSession,
    records: DataFrame,
    pairs: Iterable[tuple[str, str]],
    path: str,
    codes: tuple[str, ...] | list[str] | DataFrame,
    pattern: str,
    label: str | None = None,
) -> AdmissionCounts:
    """Bring the stored admissions up to date with landed folders that are new, changed or gone.

    ``records`` is the whole landing. The result is that of cleaning it from scratch, but only the
    folders of ``pairs`` are read, unless a stored record came from one of them and is not found
    there any more, or in an older one only: such numbers are looked up in all folders.

    The counts come from the pass that reads the folders. That pass has to see every record then, so the diagnosis is not
    left to the Parquet reader.
    """
    pairs = list(pairs)
    base = snapshots.snapshot(spark, path)
    changed = from_folders(pairs)
    counts = admission_counts(codes, pattern)
    read, cleaned = Observation("read"), Observation("cleaned")
    seen = records.filter(changed).observe(read, *counts)
    fresh = staged(
        clean_admissions(seen, codes, pattern, *VERSION).observe(cleaned, F.count(F.lit(1)).alias("kept")), "admissions-changed"
    )
    updates, doubtful = fresh, None
    if base is not None:
        as_new = F.col("s.aih_number").eqNullSafe(F.col("k.aih_number")) & (
            F.struct(*[f"k.{n}" for n in VERSION]) >= F.struct(*[f"s.{n}" for n in VERSION])
        )
        opened = folders_to_open(spark, path, base, fresh.limit(0), pairs)
        old = snapshots.read_snapshot(spark, path, VERSIONED_ADMISSIONS, opened)
        withdrawn = old.filter(changed).select("aih_number", *VERSION).alias("s")
        doubtful = staged(withdrawn.join(fresh.alias("k"), as_new, "left_anti").select("aih_number"), "admissions-lost")
        if not doubtful.isEmpty():
            lost = doubtful.select(F.col("aih_number").alias("lost"))
            again = records.join(lost, F.col("N_AIH").eqNullSafe(F.col("lost")), "left_semi")
            found = clean_admissions(again, codes, pattern, *VERSION)
            rest = fresh.join(lost, F.col("aih_number").eqNullSafe(F.col("lost")), "left_anti")
            updates = rest.unionByName(found)
    count = merge_admissions(spark, updates, path, pairs, base, label)
    for rows in (fresh, doubtful):
        if rows is not None:
            discard(rows)
    return AdmissionCounts(**observed(read, "raw", "municipality", "diagnosis"), **observed(cleaned, "kept"), written=count)
