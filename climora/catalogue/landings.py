"""Queries over landed files: archives of several years read by members, reference CSVs, the default run."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climora.catalogue import inputs
from climora.catalogue.ingestion import CODE_LIST, station_head
from climora.catalogue.inputs import DIAGNOSIS, MUNICIPALITIES, sql, table
from climora.operators import monitoring
from climora.params import AdmissionsRun, ClimateRun
from climora.plans import jobs
from climora.schemas import RAW_ADMISSIONS
from climora.session import shared_folder
from climora.sources import sinks, tables
from climora.sources.archive_members import open_store

# Archive years of the landing below; 2024 stays without one.
FIRST_YEAR, LAST_YEAR = 2023, 2025
STATIONS = ("click", "purchase", "view", "none")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _land_archives(lines: DataFrame, root: str) -> None:
    """Write ``root/<year>.zip`` with a member per station from rows (year, station, line), a task per year."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, archive, member, last = None, None, None, (None, None)
        for batch in batches:
            for year, station, line in zip(*(batch[n].to_pylist() for n in ("year", "station", "line"))):
                if (year, station) != last:
                    if member is not None:
                        member.close()
                    if year != last[0]:
                        if archive is not None:
                            archive.close()
                            out.close()
                        store, path = open_store(root)
                        store.create_dir(path, recursive=True)
                        out = store.open_output_stream(f"{path}/{year}.zip", compression=None)
                        archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                    name = f"INMET_S_PR_{station}_{station.upper()}_01-01-{year}_A_31-12-{year}.CSV"
                    member = archive.open(name, "w")
                    member.write(station_head(station, station.upper()).encode("latin-1"))
                    last = (year, station)
                member.write(f"{line}\n".encode("latin-1"))
        if archive is not None:
            member.close()
            archive.close()
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int32())], names=["year"])

    dealt = lines.repartition("year").sortWithinPartitions("year", "station", "line")
    dealt.mapInArrow(write, "year int").count()


def archive_years(spark: SparkSession, sf: str) -> DataFrame:
    """The weather job over archives of two years, with none for the year between them, for four stations that are not all there."""
    root, path = _folder(spark, "archives"), _folder(spark, "climate-years")
    shifted = "ts + make_interval(CASE WHEN event_id % 2 = 0 THEN -1 ELSE 1 END)"
    lines = table(spark, sf, "events").selectExpr(
        f"year({shifted}) AS year", "event_type AS station",
        f"concat_ws(';', date_format({shifted}, 'yyyy/MM/dd'), date_format(ts, 'HHmm'),"
        " concat(cast(cast(round(value * 100) AS bigint) AS string), ',0'), '',"
        " cast(cast(round(value * 100) AS bigint) + 1 AS string),"
        " cast(event_id % 101 AS string), cast(event_id % 7 AS string), '') AS line",
    )
    _land_archives(lines, root)
    run = ClimateRun(date(FIRST_YEAR, 1, 1), date(LAST_YEAR, 12, 31), STATIONS)
    jobs.ingest_climate(spark, root, path, run, by=sinks.CLIMATE_BY_MONTH)
    return tables.read_daily_climate(spark, path)


_SHIFTED = "CAST(ts + CASE WHEN event_id % 2 = 0 THEN INTERVAL '-1' YEAR ELSE INTERVAL '1' YEAR END AS DATE)"
_ARCHIVE_YEARS_SQL = f"""SELECT event_type AS station_code, {_SHIFTED} AS date,
    upper(event_type) AS station_name, 'PR' AS state, -25.5::DOUBLE AS latitude,
    -49.25::DOUBLE AS longitude, avg(round(value * 100)) AS avg_temp,
    min(round(value * 100) + 1) AS min_temp, max(round(value * 100)) AS max_temp,
    avg(CAST(event_id % 101 AS DOUBLE)) AS avg_relative_humidity,
    CAST(sum(event_id % 7) AS DOUBLE) AS total_precipitation
    FROM events WHERE event_type IN ({", ".join(f"'{s}'" for s in STATIONS)}) AND year({_SHIFTED}) IN ({FIRST_YEAR}, {LAST_YEAR})
    GROUP BY 1, 2"""


def seed_locations(spark: SparkSession, sf: str) -> DataFrame:
    """Both reference tables written as CSV and read back with their schemas: each municipality and its station."""
    folder = _folder(spark, "seeds")
    inputs.municipalities(spark, sf).write.option("header", True).csv(f"{folder}/municipalities")
    inputs.station_mapping(spark, sf).write.option("header", True).csv(f"{folder}/mapping")
    places = tables.read_municipalities(spark, f"{folder}/municipalities")
    stations = tables.read_station_mapping(spark, f"{folder}/mapping").withColumnRenamed("municipality_ibge_code", "ibge_code")
    return places.join(stations, "ibge_code", "left")


_SEEDS_SQL = """SELECT m.*, s.station_code FROM municipalities m
    LEFT JOIN municipality_station_mapping s ON s.municipality_ibge_code = m.ibge_code"""

# The default run covers the 24 months that had fully elapsed then.
AS_OF = date(1997, 3, 15)


def default_admissions_run(spark: SparkSession, sf: str) -> DataFrame:
    """The admissions job over the window of a run that states nothing but its day, from a landing of all months."""
    landing, path = _folder(spark, "landing"), _folder(spark, "admissions-default")
    sinks.land_admissions(inputs.raw_admissions(spark, sf), landing, order="source_row")
    window = AdmissionsRun.default(AS_OF)
    run = AdmissionsRun(window.first, window.last, MUNICIPALITIES, DIAGNOSIS)
    jobs.ingest_admissions(spark, landing, path, run)
    return tables.read_admissions(spark, path).groupBy("admission_month").agg(
        F.count(F.lit(1)).alias("records"), F.sum("total_aih_value").alias("value")
    )


_DEFAULT_RUN_SQL = f"""SELECT admission_month, count(*) AS records, sum(value) AS value FROM (
    SELECT CAST(date_trunc('month', try_strptime(DT_INTER, '%Y%m%d')) AS DATE) AS admission_month,
        TRY_CAST(trim(VAL_TOT) AS DOUBLE) AS value
    FROM raw_admissions
    WHERE MUNIC_RES IN ({CODE_LIST}) AND regexp_matches(DIAG_PRINC, '^J[0-9]{{2}}') AND competence BETWEEN '1995-03' AND '1997-02'
    QUALIFY row_number() OVER (PARTITION BY N_AIH ORDER BY competence DESC, state DESC, source_row DESC) = 1)
    GROUP BY 1"""


def admissions_run_report(spark: SparkSession, sf: str) -> DataFrame:
    """Counts that the job returns for the run over all months, and for one over a window of them in one state afterwards."""
    landing, path = _folder(spark, "landing"), _folder(spark, "admissions-report")
    sinks.land_admissions(inputs.raw_admissions(spark, sf), landing, order="source_row")
    runs = {
        "all": AdmissionsRun((1990, 1), (2001, 12), MUNICIPALITIES, DIAGNOSIS),
        "window": AdmissionsRun((1995, 3), (1997, 2), MUNICIPALITIES, DIAGNOSIS, states=("PR",)),
    }
    reports = [(name, jobs.run_admissions(spark, landing, path, run)) for name, run in runs.items()]
    rows = [(name, r.raw, r.municipality, r.diagnosis, r.kept) for name, r in reports]
    return spark.createDataFrame(rows, "run string, raw long, municipality long, diagnosis long, kept long")


def _report_sql(name: str, where: str) -> str:
    return f"""SELECT '{name}' AS run, count(*) AS raw, count(*) FILTER (WHERE MUNIC_RES IN ({CODE_LIST})) AS municipality,
    count(*) FILTER (WHERE MUNIC_RES IN ({CODE_LIST}) AND regexp_matches(DIAG_PRINC, '^J[0-9]{{2}}')) AS diagnosis,
    count(DISTINCT coalesce(N_AIH, 'none')) FILTER (WHERE MUNIC_RES IN ({CODE_LIST}) AND regexp_matches(DIAG_PRINC, '^J[0-9]{{2}}')) AS kept
    FROM raw_admissions WHERE {where}"""


_RUN_REPORT_SQL = f"""{_report_sql("all", "true")} UNION ALL {_report_sql("window", "state = 'PR' AND competence BETWEEN '1995-03' AND '1997-02'")}"""


# What a source might change from one month to the next.
_DOUBLE, _WITHOUT = "1995-07", "1996-05"


def landing_drift(spark: SparkSession, sf: str) -> DataFrame:
    """A landing of which two competences have files of another make, as their footers tell."""
    landing = _folder(spark, "landing-drift")
    records = inputs.raw_admissions(spark, sf)
    sinks.land_admissions(records, landing, order="source_row")
    plain = records.select(*RAW_ADMISSIONS.names)
    for rows, competence in (
        (plain.withColumn("VAL_TOT", F.expr("try_cast(VAL_TOT AS double)")), _DOUBLE),
        (plain.drop("DIAS_PERM").withColumn("SEXO", F.lit("1")), _WITHOUT),
    ):
        again = rows.filter(F.col("competence") == competence)
        again.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("state", "competence").parquet(landing)
    return monitoring.file_drift(spark, landing, RAW_ADMISSIONS, ("state", "competence"))


_DRIFT_SQL = f"""SELECT v."column", v.expected_type, v.actual_type, count(DISTINCT r.state) AS folders FROM (VALUES
    ('VAL_TOT', 'string', 'double', '{_DOUBLE}'), ('DIAS_PERM', 'string', NULL, '{_WITHOUT}'), ('SEXO', NULL, 'string', '{_WITHOUT}')
    ) AS v("column", expected_type, actual_type, competence) JOIN raw_admissions r ON r.competence = v.competence GROUP BY ALL"""


QUERIES = {
    "landing_drift": (landing_drift, sql(_DRIFT_SQL, "raw_admissions")),
    "admissions_run_report": (admissions_run_report, sql(_RUN_REPORT_SQL, "raw_admissions")),
    "archive_years": (archive_years, _ARCHIVE_YEARS_SQL),
    "seed_locations": (seed_locations, sql(_SEEDS_SQL, "municipalities", "municipality_station_mapping")),
    "default_admissions_run": (default_admissions_run, sql(_DEFAULT_RUN_SQL, "raw_admissions")),
}
