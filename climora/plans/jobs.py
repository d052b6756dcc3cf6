"""The jobs end to end: ingest weather, ingest admissions, build the models, check them."""

from __future__ import annotations

import logging
from calendar import monthrange
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from climora.operators import changelog, maintained, monitoring
from climora.operators.changes import (
    AdmissionCounts,
    changed_competences,
    fingerprints,
    merge_daily_climate,
    merge_folders,
)
from climora.operators.climate import aggregate_daily, normalize_readings
from climora.operators.quality import declared_checks, run_checks, store_results
from climora.params import (
    DEFAULT_MUNICIPALITIES,
    RESPIRATORY_PATTERN,
    AdmissionsRun,
    ClimateRun,
    month_range,
)
from climora.plans import marts, staging
from climora.schemas import VERSIONED_ADMISSIONS
from climora.session import discard, observed, staged
from climora.sources import sinks, snapshots, tables
from climora.sources.archive_members import scan_archive_members
from climora.sources.archives import hourly_records

logger = logging.getLogger(__name__)

ADMISSION_KEY = ("aih_number",)


@dataclass(frozen=True)
class ClimateReport:
    """What a weather run did: hourly records read, records without a date that were left out, station-days merged."""

    readings: int = 0
    undated: int = 0
    station_days: int = 0


def run_climate(
    spark: SparkSession,
    archives: str,
    output: str,
    run: ClimateRun,
    scan: Callable[..., DataFrame] = scan_archive_members,
    by: tuple[str, ...] = sinks.CLIMATE_BY_DATE,
) -> ClimateReport:
    """Yearly archives to stored daily climate.

    The run is merged on (station, date): other stations, and days outside the run, stay as they are
    in every layout. Counts come from the pass that reads the archives.

    ``scan`` may also be ``scan_station_files``, for a landing that is unpacked, or ``scan_archives``, for a store that
    Arrow does not open. Archives that were not landed mean no new data: the stored days stay as they are.
    """
    try:
        members = scan(spark, archives, run.start, run.end, run.stations)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("no archives under %s; stored days are left as they are", archives)
        return ClimateReport()
    dropped, kept = Observation("dropped"), Observation("kept")
    readings = normalize_readings(hourly_records(members, run.start, run.end), dropped)
    counted = readings.observe(kept, F.count(F.lit(1)).alias("readings"))
    written = merge_daily_climate(spark, aggregate_daily(counted), output, by)
    undated = observed(dropped, "no_date")["no_date"]
    report = ClimateReport(observed(kept, "readings")["readings"] + undated, undated, written)
    logger.info("%s for %s to %s", report, run.start, run.end)
    return report


def ingest_climate(
    spark: SparkSession,
    archives: str,
    output: str,
    run: ClimateRun,
    scan: Callable[..., DataFrame] = scan_archive_members,
    by: tuple[str, ...] = sinks.CLIMATE_BY_DATE,
) -> int:
    """``run_climate``; returns the number of station-days of the run."""
    return run_climate(spark, archives, output, run, scan, by).station_days


def run_admissions(spark: SparkSession, landing: str, output: str, run: AdmissionsRun) -> AdmissionCounts:
    """Landed records to stored clean admissions; returns the counts of the run's stages, from the pass that reads them.

    The run is merged by record number: what earlier runs stored in the months that it touches stays, and runs can come
    in any order, as the stored table keeps from which competence and state a record came. A competence that was
    republished replaces what it brought before: records that it does not hold any more leave the table, unless another
    landed competence has them. Competences that are not landed are left as they are.
    """
    landed = tables.folders_below(spark, landing, "state", "competence")
    pairs = [(s, c) for s, c in landed if c in run.competences and (run.states is None or s in run.states)]
    report = AdmissionCounts(0, 0, 0, 0, 0)
    if pairs:
        records = tables.read_landed_admissions(spark, landing)
        report = merge_folders(spark, records, pairs, output, run.municipalities, run.diagnosis_pattern, f"{run.first} to {run.last}")
    logger.info("%s for %s to %s", report, run.first, run.last)
    return report


def ingest_admissions(spark: SparkSession, landing: str, output: str, run: AdmissionsRun) -> int:
    """``run_admissions``; returns the number of records in the months written."""
    return run_admissions(spark, landing, output, run).written


def log_admissions(spark: SparkSession, stored: str, log: str) -> int:
    """Add the changes of the stored admissions since the last call to the log; returns how many records changed.

    Run it after each ingestion. Other systems then follow the log instead of reading the table again, and see records that
    were withdrawn as deletes.
    """
    changed = changelog.append_changes(spark, stored, log, VERSIONED_ADMISSIONS, ADMISSION_KEY)
    logger.info("%d admissions changed", changed)
    return changed


def read_admission_changes(spark: SparkSession, log: str, after: int = 0) -> DataFrame:
    """The log of ``log_admissions``: aih_number, op, old, new, snapshot."""
    return changelog.read_changes(spark, log, VERSIONED_ADMISSIONS, ADMISSION_KEY, after)


def update_admissions(
    spark: SparkSession,
    landing: str,
    output: str,
    manifest: str,
    municipalities: tuple[str, ...] = DEFAULT_MUNICIPALITIES,
    diagnosis_pattern: str = RESPIRATORY_PATTERN,
) -> list[tuple[str, str]]:
    """Merge the landed folders that changed since the last run; returns their (state, competence).

    ``manifest`` holds the fingerprints of the last run, and is replaced last: a run that fails
    before that is repeated in full, with the same result. Folders that are gone count as changed.
    The stored table is then what cleaning the whole landing would give.
    """
    records = tables.read_landed_admissions(spark, landing)
    current = staged(fingerprints(records), "fingerprints")
    try:
        before = spark.read.schema(current.schema).parquet(manifest)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        before = current.limit(0)
    gone = before.join(current, ["state", "competence"], "left_anti").select("state", "competence")
    # One row per folder of the landing at most.
    pairs = [tuple(r) for r in changed_competences(current, before).union(gone).collect()]
    if pairs:
        merge_folders(spark, records, pairs, output, municipalities, diagnosis_pattern)
        sinks.write_table(current, manifest)
    discard(current)
    logger.info("merged %d landed folders", len(pairs))
    return pairs


@dataclass(frozen=True)
class Sources:
    """Where the stored inputs of the models lie."""

    climate: str
    admissions: str
    municipalities: str
    station_mapping: str


class Models(Mapping[str, DataFrame]):
    """The models by name. Each is declared when first asked for, from the models it reads."""

    def __init__(
        self,
        climate: DataFrame,
        admissions: DataFrame,
        municipalities: DataFrame,
        mapping: DataFrame,
        calendar: DataFrame,
        start: date | None = None,
        end: date | None = None,
    ) -> None:
        self._makers: dict[str, Callable[[], DataFrame]] = {
            "municipalities": lambda: municipalities,
            "municipality_station_mapping": lambda: mapping,
            "stg_inmet__daily_climate": lambda: staging.stage_daily_climate(climate),
            "stg_datasus__admissions": lambda: staging.stage_admissions(admissions),
            "int_datasus__admissions_enriched": lambda: staging.enrich_admissions(
                self["stg_datasus__admissions"]
            ),
            "dim_date": lambda: calendar,
            "dim_location": lambda: marts.dim_location(
                self["stg_datasus__admissions"], municipalities
            ),
            "dim_weather_station": lambda: marts.dim_weather_station(
                self["stg_inmet__daily_climate"]
            ),
            "fct_respiratory_admissions": lambda: marts.fct_respiratory_admissions(
                self["int_datasus__admissions_enriched"]
            ),
            "fct_daily_climate": lambda: marts.fct_daily_climate(self["stg_inmet__daily_climate"]),
            "mart_climate_health_correlation": lambda: marts.correlation_mart(
                self["fct_respiratory_admissions"], self["fct_daily_climate"], mapping, start, end
            ),
        }
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def replace(self, name: str, rows: DataFrame) -> None:
        """Let later models read ``rows`` (a stored copy, say) under this name."""
        self._makers[name] = lambda: rows
        self._made[name] = rows

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


STORED = (
    "dim_date",
    "dim_location",
    "dim_weather_station",
    "fct_respiratory_admissions",
    "fct_daily_climate",
    "mart_climate_health_correlation",
)


def build_models(spark: SparkSession, sources: Sources, output: str, as_of: date, by_state: bool = False) -> Models:
    """Build all models, publish the marts under ``output``, and every one as a view.

    The stored marts come facts first, so the mart reads the stored facts and computes none twice. Facts and mart are
    stored by month, as ``refresh_mart`` wants them, or by state and month (``by_state``). Each is a published table: readers see the old model until the new one is
    complete, and the models returned stay those of this build.
    """
    built = Models(
        tables.read_daily_climate(spark, sources.climate),
        tables.read_admissions(spark, sources.admissions),
        tables.read_municipalities(spark, sources.municipalities),
        tables.read_station_mapping(spark, sources.station_mapping),
        marts.dim_date(spark, as_of),
    )
    places = state_places(built) if by_state else (None, None)
    for name in STORED:
        built.replace(name, sinks.publish_model(built[name], f"{output}/{name}", name, *places))
    sinks.publish_views(built)
    return built


def state_places(built: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Municipalities and stations with their states, one row each, as the layout by state wants them."""
    return built["dim_location"], marts.latest_station_attributes(built["stg_inmet__daily_climate"])


def refresh_mart(
    admissions_fact: DataFrame,
    climate_fact: DataFrame,
    mapping: DataFrame,
    path: str,
    first: tuple[int, int],
    last: tuple[int, int],
    places: tuple[DataFrame, DataFrame] | None = None,
) -> int:
    """Rebuild the months ``first`` to ``last`` of a published mart (``build_models``, ``write_mart``), leaving the others.

    Both facts are cut to those months before they are aggregated and joined. A month that has no
    rows any more is emptied. Readers see all months as before, or all as rebuilt; when another refresh has published
    one of these months meanwhile, nothing is changed and ``ConcurrentChange`` is raised. A mart stored by state needs
    ``places`` (``state_places``).
    """
    months = month_range(first, last)
    start = date(*months[0], 1)
    end = date(*months[-1], monthrange(*months[-1])[1])
    base = snapshots.snapshot(climate_fact.sparkSession, path)
    rows = marts.correlation_mart(admissions_fact, climate_fact, mapping, start, end)
    if base is not None and "state" in base.by:
        if places is None:
            raise ValueError("the mart is stored by state: places are needed to tell the state of its rows")
        rows = sinks.with_state(rows, "mart_climate_health_correlation", *places)
    spanned = {sinks.folder_name("mart_month", date(*m, 1)) for m in months}
    emptied = {f for f in (base.folders if base else ()) if f.rsplit("/", 1)[-1] in spanned}
    return sinks.write_mart(rows, path, emptied, base)


def maintain_rollups(spark: SparkSession, mart: str, output: str, locations: DataFrame, stations: DataFrame) -> list[str]:
    """Bring the stored regional series up to date with the published mart; returns the month folders that were added up again."""
    months = maintained.maintain_regional(spark, mart, output, locations, stations)
    logger.info("added up %d months of the regional series", len(months))
    return months


@dataclass(frozen=True)
class Feed:
    """A stored table that should get new rows all the time: its day, what its parts are told apart by, how old it may become."""

    name: str
    rows: DataFrame
    day: str
    group: str
    limit_days: int


def watch_feeds(feeds: list[Feed], output: str, as_of: date, first: date) -> DataFrame:
    """Age of each feed and its odd days, kept per run date under ``output``; returns the rows of this run.

    Columns: feed, group_key, day, kind (``stale``, or a kind of ``feed_anomalies``), row_count, expected.
    """
    parts = []
    for feed in feeds:
        days = monitoring.feed_anomalies(feed.rows, feed.day, feed.group, as_of, first)
        parts.append(days.select(
            F.lit(feed.name).alias("feed"), F.col("group_key").cast("string").alias("group_key"), "day", "kind", "row_count", "expected"
        ))
        age = monitoring.freshness(feed.rows, feed.day, as_of, feed.limit_days).where("is_stale")
        parts.append(age.select(
            F.lit(feed.name).alias("feed"), F.lit(None).cast("string").alias("group_key"), F.col("latest").alias("day"),
            F.lit("stale").alias("kind"), F.lit(None).cast("long").alias("row_count"), F.lit(None).cast("double").alias("expected"),
        ))
    found = reduce(DataFrame.unionByName, parts).withColumn("run_date", F.lit(as_of))
    snapshots.replace_folders(found, output, ("run_date",), emptied=[sinks.folder_name("run_date", as_of)])
    return snapshots.read_published(found.sparkSession, output, found.schema).where(F.col("run_date") == as_of).drop("run_date")


def check_models(built: Models, output: str, run_date: date) -> DataFrame:
    """Run the declared checks and keep their results under ``output``."""
    results = run_checks(declared_checks(), built)
    store_results(results, output, run_date)
    return results
