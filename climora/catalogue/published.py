"""Queries over published tables: snapshots, withdrawals, the change log, maintained rollups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climora.catalogue import inputs
from climora.catalogue.ingestion import CODE_LIST, DAILY_SQL
from climora.catalogue.inputs import DIAGNOSIS, MUNICIPALITIES, sql
from climora.catalogue.modelling import MART, RANGE, STATION_LATEST_SQL, all_models
from climora.operators import changelog, changes, climate, maintained
from climora.params import AdmissionsRun
from climora.plans import jobs, marts
from climora.schemas import ADMISSIONS
from climora.session import shared_folder
from climora.sources import layout, sinks, snapshots, tables


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- the mart ------------------------------------------------------------------------------------


def mart_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """The mart as built and as refreshed, each read at its snapshot, after a refresh that failed and one of other months.

    The failed one has written all its rows, and dies before it publishes them.
    """
    path = _folder(spark, "mart-snapshots")
    built = all_models(spark, sf)
    sinks.publish_model(built[MART], path, MART)
    warmer = built["fct_daily_climate"].withColumn("avg_temp", F.col("avg_temp") + 1)
    admissions, mapping = built["fct_respiratory_admissions"], built["municipality_station_mapping"]
    snapshots.write_beside(sinks.with_mart_month(built[MART].limit(1000)), path, ("mart_month",))
    first, last = ((d.year, d.month) for d in RANGE)
    jobs.refresh_mart(admissions, warmer, mapping, path, first, last)
    as_built, now = (
        tables.read_mart(spark, path, n).withColumn("snapshot", F.lit(n)) for n in snapshots.snapshot_numbers(spark, path)
    )
    return as_built.unionByName(now)


_MART_SNAPSHOT_SQL = f"""SELECT *, CAST(date_trunc('month', date_day) AS DATE) AS mart_month, 1 AS snapshot FROM {MART}
    UNION ALL BY NAME SELECT * REPLACE (
    CASE WHEN date_day BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' THEN avg_temp + 1 ELSE avg_temp END AS avg_temp),
    CAST(date_trunc('month', date_day) AS DATE) AS mart_month, 2 AS snapshot FROM {MART}"""


# --- withdrawals ---------------------------------------------------------------------------------

# Competences that are published again: some records are gone, some have another value, some are out of scope.
_AGAIN = ("1994-02", "1995-07", "1996-05")
_AGAIN_LIST = ", ".join(f"'{c}'" for c in _AGAIN)
_STAYS = "source_row % 10 <> 3"


def _again(records: DataFrame) -> DataFrame:
    return records.filter(F.col("competence").isin(*_AGAIN)).filter(_STAYS).withColumns({
        "VAL_TOT": F.expr("CASE WHEN source_row % 10 = 4 THEN concat(VAL_TOT, '0') ELSE VAL_TOT END"),
        "DIAG_PRINC": F.expr("CASE WHEN source_row % 10 = 7 THEN 'I219' ELSE DIAG_PRINC END"),
    })


def _landed(records: str) -> str:
    """Clean records of a landing; within a competence the files of a later state name come last."""
    return f"""SELECT N_AIH AS aih_number, MUNIC_RES AS municipality_residence_code,
    CAST(try_strptime(DT_INTER, '%Y%m%d') AS DATE) AS admission_date,
    DIAG_PRINC AS primary_diagnosis, TRY_CAST(trim(VAL_TOT) AS DOUBLE) AS total_aih_value,
    TRY_CAST(trim(DIAS_PERM) AS DOUBLE) AS length_of_stay, competence, state,
    CAST(date_trunc('month', try_strptime(DT_INTER, '%Y%m%d')) AS DATE) AS admission_month
    FROM ({records})
    WHERE MUNIC_RES IN ({CODE_LIST}) AND regexp_matches(DIAG_PRINC, '^J[0-9]{{2}}')
    QUALIFY row_number() OVER (PARTITION BY N_AIH ORDER BY competence DESC, state DESC, source_row DESC) = 1"""


_FIRST = "SELECT * FROM raw_admissions"
_SECOND = f"""SELECT * FROM raw_admissions WHERE competence NOT IN ({_AGAIN_LIST})
    UNION ALL SELECT * REPLACE (
        CASE WHEN source_row % 10 = 4 THEN VAL_TOT || '0' ELSE VAL_TOT END AS VAL_TOT,
        CASE WHEN source_row % 10 = 7 THEN 'I219' ELSE DIAG_PRINC END AS DIAG_PRINC)
    FROM raw_admissions WHERE competence IN ({_AGAIN_LIST}) AND {_STAYS}"""


_STORED_AGAIN_SQL = f"SELECT * EXCLUDE (competence, state) FROM ({_landed(_SECOND)})"


def _two_runs(spark: SparkSession, sf: str, log: str | None = None) -> str:
    """Stored admissions after a landing, and after some of its competences were published again with less."""
    landing, path = _folder(spark, "landing"), _folder(spark, "admissions-again")
    records = inputs.raw_admissions(spark, sf)
    for landed, first, last in ((records, (1990, 1), (2001, 12)), (_again(records), (1994, 2), (1996, 5))):
        sinks.land_admissions(landed, landing, order="source_row")
        jobs.ingest_admissions(spark, landing, path, AdmissionsRun(first, last, MUNICIPALITIES, DIAGNOSIS))
        if log is not None:
            jobs.log_admissions(spark, path, log)
    return path


def admissions_republished(spark: SparkSession, sf: str) -> DataFrame:
    """The plain job, run again over competences that lost records: these leave the table, others take their place or stay."""
    return tables.read_admissions(spark, _two_runs(spark, sf))


_LOGGED = ("admission_month", "primary_diagnosis", "total_aih_value", "length_of_stay", "competence")


def admissions_change_log(spark: SparkSession, sf: str) -> DataFrame:
    """Log of both runs: every record of the first, then what the second one changed."""
    log = _folder(spark, "log")
    _two_runs(spark, sf, log)
    return jobs.read_admission_changes(spark, log).select(
        "snapshot", "op", "aih_number", *[F.col(f"{side}.{name}").alias(f"{side}_{name}") for side in ("old", "new") for name in _LOGGED]
    )


def _sided(old: str, new: str) -> str:
    return ", ".join(f"{rows}.{n} AS {side}_{n}" for side, rows in (("old", old), ("new", new)) for n in _LOGGED)


_CHANGE_LOG_SQL = f"""SELECT * FROM (WITH a AS ({_landed(_FIRST)}), b AS ({_landed(_SECOND)}), none AS (SELECT * FROM a WHERE false)
    SELECT 1 AS snapshot, 'insert' AS op, a.aih_number, {_sided("none", "a")} FROM a LEFT JOIN none ON none.aih_number = a.aih_number
    UNION ALL
    SELECT 2, CASE WHEN a.competence IS NULL THEN 'insert' WHEN b.competence IS NULL THEN 'delete' ELSE 'update' END,
        coalesce(b.aih_number, a.aih_number), {_sided("a", "b")}
    FROM a FULL JOIN b ON a.aih_number IS NOT DISTINCT FROM b.aih_number WHERE a IS DISTINCT FROM b)"""


def admissions_replayed(spark: SparkSession, sf: str) -> DataFrame:
    """The table that the log of both runs leads to, without a look at the stored one."""
    log = _folder(spark, "log")
    _two_runs(spark, sf, log)
    return changelog.replayed(jobs.read_admission_changes(spark, log), jobs.ADMISSION_KEY, ADMISSIONS.names)


# --- layouts -------------------------------------------------------------------------------------


def climate_migrated(spark: SparkSession, sf: str) -> DataFrame:
    """Daily climate in day folders, moved to folders by state and month, corrected there, and packed into few files."""
    source, target = _folder(spark, "climate-days"), _folder(spark, "climate-states")
    # Four months of readings.
    daily = climate.aggregate_daily(inputs.readings(spark, sf).withColumn("date", F.expr("date_add(date, cast(30 * (read_order % 4) AS int))")))
    sinks.write_daily_climate(daily, source)
    layout.migrate_climate(spark, source, target)
    fixed = daily.filter("substring(station_code, -1) = '7'").withColumn("max_temp", F.col("max_temp") + 5)
    changes.merge_daily_climate(spark, fixed, target)
    layout.compact_climate(spark, target)
    return tables.read_daily_climate(spark, target)


_MIGRATED_SQL = f"""SELECT * REPLACE (CASE WHEN right(station_code, 1) = '7' THEN max_temp + 5 ELSE max_temp END AS max_temp)
    FROM ({DAILY_SQL.replace("FROM readings", "FROM (SELECT * REPLACE (date + CAST(30 * (read_order % 4) AS INTEGER) AS date) FROM readings)")})"""


# --- maintained rollups --------------------------------------------------------------------------

_COOLER, _WITHDRAWN = (1994, 5), (1997, 1)


def regional_rollup_maintained(spark: SparkSession, sf: str) -> DataFrame:
    """Stored regional series after three changes of the mart: a warmer span, a cooler month, a month whose admissions are withdrawn.

    Each step adds up the changed months only. Both granularities, with the latest day of each group.
    """
    path, output = _folder(spark, "mart-rollup"), _folder(spark, "rollup")
    built = all_models(spark, sf)
    places, stations = built["dim_location"], marts.latest_station_attributes(built["stg_inmet__daily_climate"])
    admissions, climate, mapping = (built[n] for n in ("fct_respiratory_admissions", "fct_daily_climate", "municipality_station_mapping"))
    sinks.publish_model(built[MART], path, MART)
    jobs.maintain_rollups(spark, path, output, places, stations)
    warmer = climate.withColumn("avg_temp", F.col("avg_temp") + 1)
    first, last = ((d.year, d.month) for d in RANGE)
    for facts, weather, months in (
        (admissions, warmer, (first, last)),
        (admissions, climate.withColumn("avg_temp", F.col("avg_temp") - 2), (_COOLER, _COOLER)),
        (admissions.limit(0), warmer.filter("fk_date <> DATE '1997-01-31'"), (_WITHDRAWN, _WITHDRAWN)),
    ):
        jobs.refresh_mart(facts, weather, mapping, path, *months)
        jobs.maintain_rollups(spark, path, output, places, stations)
    series = [
        maintained.read_regional(spark, output, g).withColumn("granularity", F.lit(g)) for g in maintained.GRANULARITIES
    ]
    return series[0].unionByName(series[1]).withColumn("avg_temp", F.round("avg_temp", 9))


# Without admissions a day has one row per station, as climate alone gives it.
_REFRESHED_MART = f"""SELECT date_day, station_code, fk_municipality, daily_admission_count,
        CASE WHEN date_day BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' THEN avg_temp + 1
            WHEN date_day BETWEEN DATE '1994-05-01' AND DATE '1994-05-31' THEN avg_temp - 2 ELSE avg_temp END AS avg_temp
    FROM {MART} WHERE coalesce(date_day NOT BETWEEN DATE '1997-01-01' AND DATE '1997-01-31', true)
    UNION ALL SELECT fk_date, fk_station, NULL, 0, avg_temp + 1 FROM fct_daily_climate
    WHERE fk_date BETWEEN DATE '1997-01-01' AND DATE '1997-01-30'"""


def _regional_sql(unit: str, granularity: str) -> str:
    return f"""SELECT '{granularity}' AS granularity, CAST(date_trunc('{unit}', date_day) AS DATE) AS period,
    CASE st WHEN 'PR' THEN 'Sul' WHEN 'SP' THEN 'Sudeste' WHEN 'BA' THEN 'Nordeste'
        WHEN 'GO' THEN 'Centro-Oeste' WHEN 'AM' THEN 'Norte' ELSE 'Unknown' END AS region,
    st AS state, round(avg(avg_temp), 9) AS avg_temp, CAST(sum(daily_admission_count) AS BIGINT) AS admission_count, max(date_day) AS last_day
    FROM (SELECT m.*, coalesce(l.state, s.state) AS st FROM ({_REFRESHED_MART}) m
        LEFT JOIN dim_location l ON m.fk_municipality = l.ibge_code
        LEFT JOIN ({STATION_LATEST_SQL}) s ON m.station_code = s.station_code)
    GROUP BY ALL"""


_MAINTAINED_SQL = f"{_regional_sql('week', 'weekly')} UNION ALL {_regional_sql('month', 'monthly')}"


def mart_by_state(spark: SparkSession, sf: str) -> DataFrame:
    """A mart in folders by state and month, of which a span was refreshed; two states are read."""
    path = _folder(spark, "mart-states")
    built = all_models(spark, sf)
    places = jobs.state_places(built)
    sinks.publish_model(built[MART], path, MART, *places)
    warmer = built["fct_daily_climate"].withColumn("avg_temp", F.col("avg_temp") + 1)
    first, last = ((d.year, d.month) for d in RANGE)
    jobs.refresh_mart(built["fct_respiratory_admissions"], warmer, built["municipality_station_mapping"], path, first, last, places)
    return tables.read_mart(spark, path, states=("PR", "XX"))


_MART_BY_STATE_SQL = f"""SELECT m.* REPLACE (
        CASE WHEN date_day BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' THEN avg_temp + 1 ELSE avg_temp END AS avg_temp),
        CAST(date_trunc('month', date_day) AS DATE) AS mart_month
    FROM {MART} m LEFT JOIN dim_location l ON m.fk_municipality = l.ibge_code
        LEFT JOIN ({STATION_LATEST_SQL}) s ON m.station_code = s.station_code
    WHERE coalesce(l.state, s.state) IN ('PR', 'XX')"""


QUERIES = {
    "mart_by_state": (mart_by_state, sql(_MART_BY_STATE_SQL, MART, "dim_location")),
    "mart_snapshot": (mart_snapshot, sql(_MART_SNAPSHOT_SQL, MART)),
    "admissions_republished": (admissions_republished, sql(_STORED_AGAIN_SQL, "raw_admissions")),
    "admissions_change_log": (admissions_change_log, sql(_CHANGE_LOG_SQL, "raw_admissions")),
    "admissions_replayed": (admissions_replayed, sql(_STORED_AGAIN_SQL, "raw_admissions")),
    "climate_migrated": (climate_migrated, sql(_MIGRATED_SQL, "readings")),
    "regional_rollup_maintained": (regional_rollup_maintained, sql(_MAINTAINED_SQL, MART, "dim_location", "fct_daily_climate")),
}
