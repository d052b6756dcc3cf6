"""Queries over the ingestion operators: archives, parsing, filters, keep-last, sinks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climora.catalogue import inputs
from climora.catalogue.inputs import DIAGNOSIS, MUNICIPALITIES, sql, table
from climora.functions import parsing
from climora.operators import admissions, changes, climate
from climora.params import AdmissionsRun, ClimateRun, competence_label, month_range, trailing_days
from climora.plans import jobs
from climora.session import shared_folder
from climora.sources import sinks, tables
from climora.sources.archives import (
    DATE_HEADER,
    ENCODING,
    MEASURE_HEADERS,
    hourly_records,
    pack_archive,
    unpack,
)
from climora.streaming.daily_climate import maintain_daily_climate

FIRST_DAY, LAST_DAY = date(2024, 1, 3), date(2024, 1, 27)
CODE_LIST = ", ".join(f"'{c}'" for c in MUNICIPALITIES)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- station files -----------------------------------------------------------------------------

_HEADER = ";".join([DATE_HEADER, "Hora UTC", *MEASURE_HEADERS.values()]) + ";"


def station_head(station: str, name: str) -> str:
    return (
        f"REGIAO:;S\nUF:;PR\nESTACAO:; {name} \nCODIGO (WMO):;{station}\n"
        "LATITUDE:;-25,5\nLONGITUDE:;-49,25\nALTITUDE:;900,00\nDATA DE FUNDACAO:;01/01/03\n"
        f"{_HEADER}\n"
    )


def _zip_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One archive per batch, with one member per station that occurs in it."""
    for batch in batches:
        lines: dict[str, list[str]] = {}
        for station, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines.setdefault(station, []).append(line)
        blob = pack_archive(
            (
                f"INMET_S_PR_{station}_{station.upper()}_01-01-2024_A_31-12-2024.CSV",
                (station_head(station, station.upper()) + "\n".join(body) + "\n").encode("latin-1"),
            )
            for station, body in lines.items()
        )
        yield pa.RecordBatch.from_pydict(
            {"archive_year": pa.array([2024], pa.int32()), "content": pa.array([blob], pa.binary())}
        )


def archive_scan(spark: SparkSession, sf: str) -> DataFrame:
    """ZIP members to daily rows: every event becomes one line of its station's file."""
    lines = table(spark, sf, "events").selectExpr(
        "event_type AS station",
        "concat_ws(';', date_format(ts, 'yyyy/MM/dd'), date_format(ts, 'HHmm'),"
        " concat(cast(cast(round(value * 100) AS bigint) AS string), ',0'), '',"
        " cast(cast(round(value * 100) AS bigint) + 1 AS string),"
        " cast(event_id % 101 AS string), cast(event_id % 7 AS string), '') AS line",
    )
    archives = lines.mapInArrow(_zip_batches, "archive_year int, content binary")
    records = hourly_records(unpack(archives), FIRST_DAY, LAST_DAY)
    return climate.aggregate_daily(climate.normalize_readings(records))


_ARCHIVE_SCAN_SQL = f"""SELECT event_type AS station_code, CAST(ts AS DATE) AS date,
    upper(event_type) AS station_name, 'PR' AS state, -25.5::DOUBLE AS latitude,
    -49.25::DOUBLE AS longitude, avg(round(value * 100)) AS avg_temp,
    min(round(value * 100) + 1) AS min_temp, max(round(value * 100)) AS max_temp,
    avg(CAST(event_id % 101 AS DOUBLE)) AS avg_relative_humidity,
    CAST(sum(event_id % 7) AS DOUBLE) AS total_precipitation
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'
    GROUP BY 1, 2"""


def station_files(spark: SparkSession, sf: str) -> DataFrame:
    """Metadata header and body of a station file; every event becomes a small file of its own.

    The files vary: line ends, a short line, a quoted cell, an absent column, blank metadata.
    """
    eol = "CASE WHEN event_id % 2 = 0 THEN '\\r\\n' ELSE '\\n' END"
    measure = "cast(cast(round(value * 100) AS bigint) AS string)"
    temperature = f"CASE WHEN event_id % 5 = 0 THEN concat('\"', {measure}, ';\"') ELSE {measure} END"
    titles = ";".join([DATE_HEADER, "Hora UTC", *list(MEASURE_HEADERS.values())[:4]])
    files = table(spark, sf, "events").selectExpr(
        "2024 AS archive_year",
        "cast(event_id AS string) AS station_code",
        f"concat_ws({eol}, 'REGIAO:;S', 'UF:;PR',"
        " concat('ESTACAO:;', CASE WHEN event_id % 4 = 0 THEN '  ' ELSE event_type END),"
        " 'CODIGO (WMO):;X', 'LATITUDE:;-25,44', 'ALTITUDE:;900', 'X', 'Y',"
        f" '{titles}',"
        f" concat_ws(';', date_format(ts, 'yyyy/M/d'), '0000', {temperature}, '1'),"
        " '', 'no date;0000;1;2;3;4') AS content",
    )
    members = files.withColumn("content", F.encode("content", ENCODING)).repartition("station_code")
    return hourly_records(members, FIRST_DAY, LAST_DAY).drop("read_order")


_STATION_FILES_SQL = f"""SELECT CAST(event_id AS VARCHAR) AS "CD_ESTACAO",
    CASE WHEN event_id % 4 <> 0 THEN event_type END AS "DC_NOME", 'PR' AS "UF",
    '-25,44' AS "VL_LATITUDE", NULL::VARCHAR AS "VL_LONGITUDE", CAST(ts AS DATE) AS "DT_MEDICAO",
    CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)
        || CASE WHEN event_id % 5 = 0 THEN ';' ELSE '' END AS "TEM_INS",
    '1' AS "TEM_MAX", NULL::VARCHAR AS "TEM_MIN", NULL::VARCHAR AS "UMD_INS",
    NULL::VARCHAR AS "CHUVA"
    FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'"""


def normalize_readings(spark: SparkSession, sf: str) -> DataFrame:
    """Source fields to typed readings; records without a date are dropped."""
    cents = "cast(round(value * 100) AS bigint)"
    comma = f"concat({cents} DIV 100, ',', lpad({cents} % 100, 2, '0'))"
    records = table(spark, sf, "events").selectExpr(
        "event_type AS CD_ESTACAO",
        "CASE WHEN event_id % 3 = 0 THEN '' ELSE 'NAME' END AS DC_NOME",
        "CASE WHEN event_id % 3 = 1 THEN NULL ELSE 'PR' END AS UF",
        "'-25,4486111' AS VL_LATITUDE",
        "CASE WHEN event_id % 4 = 0 THEN ' ' ELSE ' -49.23 ' END AS VL_LONGITUDE",
        "CASE event_id % 11 WHEN 0 THEN '' WHEN 1 THEN NULL"
        " ELSE date_format(ts, 'yyyy-MM-dd') END AS DT_MEDICAO",
        f"{comma} AS TEM_INS",
        f"CASE WHEN event_id % 6 = 0 THEN 'not-a-number' ELSE {comma} END AS TEM_MAX",
        "CASE WHEN event_id % 6 = 1 THEN NULL ELSE '17.5' END AS TEM_MIN",
        "cast(event_id % 101 AS string) AS UMD_INS",
        "'0,2' AS CHUVA",
        "event_id AS read_order",
    )
    return climate.normalize_readings(records)


_NORMALIZE_SQL = """SELECT event_type AS station_code, CAST(ts AS DATE) AS date,
    CASE WHEN event_id % 3 <> 0 THEN 'NAME' END AS station_name,
    CASE WHEN event_id % 3 <> 1 THEN 'PR' END AS state, -25.4486111::DOUBLE AS latitude,
    CASE WHEN event_id % 4 <> 0 THEN -49.23::DOUBLE END AS longitude,
    round(value * 100) / 100 AS temp_instant,
    CASE WHEN event_id % 6 <> 0 THEN round(value * 100) / 100 END AS temp_max,
    CASE WHEN event_id % 6 <> 1 THEN 17.5::DOUBLE END AS temp_min,
    CAST(event_id % 101 AS DOUBLE) AS humidity_instant, 0.2::DOUBLE AS precipitation,
    event_id AS read_order
    FROM events WHERE event_id % 11 > 1"""


def tolerant_float(spark: SparkSession, sf: str) -> DataFrame:
    """Decimal commas, blanks, digit groups and spellings that are no decimal number."""
    text = (
        "CASE o_orderkey % 9 WHEN 0 THEN concat(cast(round(o_totalprice) AS bigint), ',25')"
        " WHEN 1 THEN concat('  ', cast(round(o_totalprice) AS bigint), '.5 ')"
        " WHEN 2 THEN '' WHEN 3 THEN 'n/a' WHEN 4 THEN '1.5d' WHEN 5 THEN '1_000'"
        " WHEN 6 THEN '0x1p3' WHEN 7 THEN NULL ELSE concat('-', o_orderkey, 'e2') END"
    )
    cells = table(spark, sf, "orders").selectExpr("o_orderkey", f"{text} AS cell")
    return cells.select(
        "o_orderkey", parsing.tolerant_double(F.col("cell"), decimal_comma=True).alias("number")
    )


_TOLERANT_FLOAT_SQL = """SELECT o_orderkey, CASE o_orderkey % 9
    WHEN 0 THEN round(o_totalprice) + 0.25 WHEN 1 THEN round(o_totalprice) + 0.5
    WHEN 5 THEN 1000.0::DOUBLE WHEN 8 THEN CAST(-o_orderkey * 100 AS DOUBLE) END AS number
    FROM orders"""


def compact_date_parse(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.raw_admissions(spark, sf).select(
        "source_row", parsing.compact_date(F.col("DT_INTER")).alias("admission_date")
    )


_COMPACT_DATE_SQL = """SELECT source_row,
    CAST(try_strptime(DT_INTER, '%Y%m%d') AS DATE) AS admission_date FROM raw_admissions"""


def file_date_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Dates of file lines; a malformed one drops its line."""
    text = (
        "CASE o_orderkey % 7 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd')"
        " WHEN 1 THEN '2024/02/30' WHEN 2 THEN '' WHEN 3 THEN NULL"
        " WHEN 4 THEN date_format(o_orderdate, 'yyyy/M/d')"
        " ELSE date_format(o_orderdate, 'yyyy/MM/dd') END"
    )
    lines = table(spark, sf, "orders").selectExpr("o_orderkey", f"{text} AS cell")
    day = parsing.slash_date(F.col("cell"))
    return lines.select("o_orderkey", day.alias("file_date")).filter("file_date IS NOT NULL")


_FILE_DATE_SQL = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS file_date FROM orders
    WHERE o_orderkey % 7 >= 4"""


# --- hourly to daily ---------------------------------------------------------------------------


def daily_station_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return climate.aggregate_daily(inputs.readings(spark, sf))


def daily_single_pass(spark: SparkSession, sf: str) -> DataFrame:
    """The same day as one grouping, the form the stream uses."""
    return (
        inputs.readings(spark, sf)
        .groupBy("station_code", "date")
        .agg(*climate.daily_measures())
    )


DAILY_SQL = """SELECT station_code, date,
    arg_min(station_name, read_order) FILTER (WHERE station_name IS NOT NULL) AS station_name,
    arg_min(state, read_order) FILTER (WHERE state IS NOT NULL) AS state,
    arg_min(latitude, read_order) FILTER (WHERE latitude IS NOT NULL) AS latitude,
    arg_min(longitude, read_order) FILTER (WHERE longitude IS NOT NULL) AS longitude,
    avg(temp_instant) AS avg_temp, coalesce(min(temp_min), min(temp_instant)) AS min_temp,
    coalesce(max(temp_max), max(temp_instant)) AS max_temp,
    avg(humidity_instant) AS avg_relative_humidity, sum(precipitation) AS total_precipitation
    FROM readings GROUP BY station_code, date"""


def _daily_columns(*columns: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return daily_station_metrics(spark, sf).select("station_code", "date", *columns)

    return run


def _daily_columns_sql(*columns: str) -> str:
    return sql(f"SELECT station_code, date, {', '.join(columns)} FROM ({DAILY_SQL})", "readings")


def date_range_inclusive(spark: SparkSession, sf: str) -> DataFrame:
    return climate.within_dates(inputs.readings(spark, sf), "date", FIRST_DAY, LAST_DAY)


def trailing_window(spark: SparkSession, sf: str) -> DataFrame:
    """The ten days that end the day before a given day, aggregated for replacement."""
    run = ClimateRun.default(as_of=date(2024, 1, 25))
    recent = climate.within_dates(inputs.readings(spark, sf), "date", run.start, run.end)
    return climate.aggregate_daily(recent)


def station_list_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Readings per day of a configured list of stations, one of which is named twice."""
    run = ClimateRun(FIRST_DAY, LAST_DAY, stations=("view", "click", "signup", "view", "none"))
    stations = table(spark, sf, "events").selectExpr(
        "event_type AS station_code", "cast(ts AS date) AS date"
    )
    return (
        climate.for_stations(stations, run.stations)
        .groupBy("station_code", "date")
        .agg(F.count(F.lit(1)).alias("readings"))
    )


def station_table_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Stations given as a table instead of a list."""
    buyers = table(spark, sf, "customer").filter("c_nationkey % 3 = 1").selectExpr(
        "concat('U', c_custkey) AS station_code"
    )
    return climate.for_stations(inputs.readings(spark, sf), buyers)


_CUSTOMERS_AS_STATIONS = "SELECT 'U' || c_custkey FROM customer WHERE c_nationkey % 3 = 1"


def readings_per_station(spark: SparkSession, sf: str) -> DataFrame:
    """Readings of each wanted station; stations the source lacks show 0."""
    wanted = table(spark, sf, "customer").selectExpr("concat('U', c_custkey) AS station_code")
    return climate.readings_per_station(inputs.readings(spark, sf), wanted)


_PER_STATION_SQL = """SELECT s.station_code, count(r.station_code) AS readings
    FROM (SELECT DISTINCT 'U' || c_custkey AS station_code FROM customer) s
    LEFT JOIN readings r ON s.station_code = r.station_code GROUP BY 1"""


# --- admissions --------------------------------------------------------------------------------


def filter_codes_in(spark: SparkSession, sf: str) -> DataFrame:
    return admissions.filter_by_municipality(inputs.raw_admissions(spark, sf), MUNICIPALITIES)


def filter_codes_table(spark: SparkSession, sf: str) -> DataFrame:
    return admissions.filter_by_municipality(
        inputs.raw_admissions(spark, sf), inputs.municipalities(spark, sf)
    )


def filter_code_regex(spark: SparkSession, sf: str) -> DataFrame:
    return admissions.filter_by_diagnosis(inputs.raw_admissions(spark, sf), DIAGNOSIS)


def competence_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Records per competence of an inclusive month range."""
    wanted = [competence_label(m) for m in month_range((1996, 11), (1998, 2))]
    return (
        inputs.raw_admissions(spark, sf)
        .filter(F.col("competence").isin(wanted))
        .groupBy("competence")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def keep_last_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return admissions.keep_last(inputs.raw_admissions(spark, sf), ("N_AIH",))


def select_rename_cast(spark: SparkSession, sf: str) -> DataFrame:
    return admissions.select_and_type(inputs.raw_admissions(spark, sf), "source_row")


_SELECT_RENAME_SQL = """SELECT N_AIH AS aih_number, MUNIC_RES AS municipality_residence_code,
    CAST(try_strptime(DT_INTER, '%Y%m%d') AS DATE) AS admission_date,
    DIAG_PRINC AS primary_diagnosis, TRY_CAST(trim(VAL_TOT) AS DOUBLE) AS total_aih_value,
    TRY_CAST(trim(DIAS_PERM) AS DOUBLE) AS length_of_stay, source_row FROM raw_admissions"""


def clean_admissions(spark: SparkSession, sf: str) -> DataFrame:
    return admissions.clean_admissions(inputs.raw_admissions(spark, sf), MUNICIPALITIES, DIAGNOSIS)


def stage_counters(spark: SparkSession, sf: str) -> DataFrame:
    return admissions.stage_counts(inputs.raw_admissions(spark, sf), MUNICIPALITIES, DIAGNOSIS)


_STAGE_COUNTERS_SQL = f"""SELECT r.competence, raw_rows, municipality_rows, diagnosis_rows,
    coalesce(kept_rows, 0) AS kept_rows
    FROM (SELECT competence, count(*) AS raw_rows,
        count(*) FILTER (WHERE MUNIC_RES IN ({CODE_LIST})) AS municipality_rows,
        count(*) FILTER (WHERE MUNIC_RES IN ({CODE_LIST})
            AND regexp_matches(DIAG_PRINC, '^J[0-9]{{2}}')) AS diagnosis_rows
        FROM raw_admissions GROUP BY 1) r
    LEFT JOIN (SELECT competence, count(*) AS kept_rows FROM (
        SELECT competence FROM raw_admissions
        WHERE MUNIC_RES IN ({CODE_LIST}) AND regexp_matches(DIAG_PRINC, '^J[0-9]{{2}}')
        QUALIFY row_number() OVER (PARTITION BY N_AIH
            ORDER BY competence DESC, source_row DESC) = 1) GROUP BY 1) k
    ON r.competence = k.competence"""


def union_periods(spark: SparkSession, sf: str) -> DataFrame:
    """Record counts of all yearly slices, read as one scan."""
    return inputs.raw_admissions(spark, sf).groupBy(F.substring("competence", 1, 4).alias("year")).agg(
        F.count(F.lit(1)).alias("records")
    )


# --- sinks, late data --------------------------------------------------------------------------


def climate_sink_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Write all days, write some days again, write nothing: the other days are untouched."""
    path = _folder(spark, "climate")
    daily = daily_station_metrics(spark, sf)
    sinks.write_daily_climate(daily, path)
    again = daily.filter("day(date) % 3 = 0").withColumn("avg_temp", F.col("avg_temp") + 1)
    sinks.write_daily_climate(again, path)
    sinks.write_daily_climate(daily.filter("avg_temp < -1000"), path)
    return tables.read_daily_climate(spark, path)


_CLIMATE_SINK_SQL = f"""SELECT * REPLACE (CASE WHEN day(date) % 3 = 0 THEN avg_temp + 1
    ELSE avg_temp END AS avg_temp) FROM ({DAILY_SQL})"""


def climate_sink_by_state(spark: SparkSession, sf: str) -> DataFrame:
    """The national layout: folders by state, year and month."""
    path = _folder(spark, "climate-state")
    sinks.write_daily_climate(
        inputs.daily_climate(spark, sf), path, by=sinks.CLIMATE_BY_STATE_MONTH
    )
    return tables.read_daily_climate(spark, path).filter("state IN ('PR', 'BA')")


def admissions_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Clean admissions written by admission month and read back, undated ones included."""
    path = _folder(spark, "admissions")
    sinks.write_admissions(clean_admissions(spark, sf), path)
    return tables.read_admissions(spark, path)


_ADMISSIONS_SINK_SQL = """SELECT *,
    CAST(date_trunc('month', admission_date) AS DATE) AS admission_month FROM clean"""


def landed_admissions(spark: SparkSession, sf: str) -> DataFrame:
    """Land records by state and competence, read both states back, keep the last version.

    Within a competence the files of a later state name come last.
    """
    path = _folder(spark, "landing")
    sinks.land_admissions(inputs.raw_admissions(spark, sf), path, order="source_row")
    read = tables.read_landed_admissions(spark, path, states=("PR", "SC"))
    return (
        admissions.clean_admissions(read, MUNICIPALITIES, DIAGNOSIS)
        .groupBy("municipality_residence_code")
        .agg(F.count(F.lit(1)).alias("records"), F.countDistinct("aih_number").alias("keys"))
    )


def backfill_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Finished history plus a fresh window that wins where both have a station-day."""
    daily = inputs.daily_climate(spark, sf)
    history = daily.filter("date < DATE '2000-01-01'")
    fresh = daily.filter("date >= DATE '1999-06-01'").withColumn("max_temp", F.col("max_temp") + 5)
    return tables.prefer_fresh(history, fresh)


_BACKFILL_SQL = """SELECT * REPLACE (CASE WHEN date >= DATE '1999-06-01' THEN max_temp + 5
    ELSE max_temp END AS max_temp) FROM daily_climate"""


def climate_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Merge of one station's corrected days: the other stations of those days stay."""
    path = _folder(spark, "climate-merge")
    daily = inputs.daily_climate(spark, sf)
    sinks.write_daily_climate(daily, path, by=sinks.CLIMATE_BY_MONTH)
    fixed = daily.filter("station_code = 'A2' AND year(date) = 1997")
    changes.merge_daily_climate(
        spark, fixed.withColumn("min_temp", F.lit(-1.0)), path, by=sinks.CLIMATE_BY_MONTH
    )
    return tables.read_daily_climate(spark, path)


_CLIMATE_MERGE_SQL = """SELECT * REPLACE (CASE WHEN station_code = 'A2' AND year(date) = 1997
    THEN -1.0 ELSE min_temp END AS min_temp) FROM daily_climate"""


def admissions_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Corrections that change values and move admissions by two months."""
    path = _folder(spark, "admissions-merge")
    clean = clean_admissions(spark, sf)
    sinks.write_admissions(clean, path)
    late = (
        tables.read_admissions(spark, path)
        .drop("admission_month")
        .filter("total_aih_value IS NOT NULL AND pmod(cast(total_aih_value AS bigint), 50) = 7")
        .withColumn("admission_date", F.expr("cast(add_months(admission_date, 2) AS date)"))
        .withColumn("length_of_stay", F.lit(99.0))
    )
    changes.merge_admissions(spark, late, path)
    return tables.read_admissions(spark, path)


_ADMISSIONS_MERGE_SQL = """SELECT *,
    CAST(date_trunc('month', admission_date) AS DATE) AS admission_month FROM (
    SELECT * EXCLUDE (late) REPLACE (
        CASE WHEN late THEN CAST(admission_date + INTERVAL 2 MONTH AS DATE)
            ELSE admission_date END AS admission_date,
        CASE WHEN late THEN 99.0 ELSE length_of_stay END AS length_of_stay)
    FROM (SELECT *, coalesce(CAST(total_aih_value AS BIGINT) % 50 = 7, false) AS late FROM clean))"""


def admissions_merge_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """The job over the later competences first, then over the earlier ones."""
    landing, path = _folder(spark, "landing"), _folder(spark, "admissions-order")
    sinks.land_admissions(inputs.raw_admissions(spark, sf), landing, order="source_row")
    for first, last in (((1995, 6), (2001, 12)), ((1990, 1), (1995, 5))):
        jobs.ingest_admissions(spark, landing, path, AdmissionsRun(first, last, MUNICIPALITIES, DIAGNOSIS))
    return tables.read_admissions(spark, path)


def incremental_admissions(spark: SparkSession, sf: str) -> DataFrame:
    """Two landings, each followed by the incremental job; equal to cleaning the second from scratch.

    In the first, one competence is missing, one has other values, and in one more records match
    the diagnosis, among them later versions of numbers that are in earlier competences as well.
    """
    landing, path, manifest = (_folder(spark, n) for n in ("landing", "admissions-steps", "manifest"))
    records = inputs.raw_admissions(spark, sf)
    first = records.filter("competence <> '1997-03'").withColumns(
        {
            "VAL_TOT": F.expr("CASE WHEN competence = '1995-07' THEN concat(VAL_TOT, '0') ELSE VAL_TOT END"),
            "DIAG_PRINC": F.expr("CASE WHEN competence = '1996-05' THEN 'J999' ELSE DIAG_PRINC END"),
        }
    )
    for landed in (first, records.filter("competence IN ('1995-07', '1996-05', '1997-03')")):
        sinks.land_admissions(landed, landing, order="source_row")
        jobs.update_admissions(spark, landing, path, manifest, MUNICIPALITIES, DIAGNOSIS)
    return tables.read_admissions(spark, path)


# Within a competence the files of a later state name come last.
_LANDED_CLEAN_SQL = f"""SELECT N_AIH AS aih_number, MUNIC_RES AS municipality_residence_code,
    CAST(try_strptime(DT_INTER, '%Y%m%d') AS DATE) AS admission_date,
    DIAG_PRINC AS primary_diagnosis, TRY_CAST(trim(VAL_TOT) AS DOUBLE) AS total_aih_value,
    TRY_CAST(trim(DIAS_PERM) AS DOUBLE) AS length_of_stay,
    CAST(date_trunc('month', try_strptime(DT_INTER, '%Y%m%d')) AS DATE) AS admission_month
    FROM raw_admissions
    WHERE MUNIC_RES IN ({CODE_LIST}) AND regexp_matches(DIAG_PRINC, '^J[0-9]{{2}}')
    QUALIFY row_number() OVER (PARTITION BY N_AIH
        ORDER BY competence DESC, state DESC, source_row DESC) = 1"""


def changed_competences(spark: SparkSession, sf: str) -> DataFrame:
    """Competences whose landed records differ from the fingerprint of an earlier landing."""
    records = inputs.raw_admissions(spark, sf)
    earlier = records.filter("competence <> '1997-03'").withColumn(
        "VAL_TOT",
        F.expr("CASE WHEN source_row % 500 = 0 THEN concat(VAL_TOT, '0') ELSE VAL_TOT END"),
    )
    return changes.changed_competences(
        changes.fingerprints(records), changes.fingerprints(earlier)
    )


_CHANGED_SQL = """SELECT DISTINCT state, competence FROM raw_admissions
    WHERE competence = '1997-03' OR source_row % 500 = 0"""


def daily_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The stream of readings, run until its input is used up, and the table it maintains.

    A stream keeps the number of state partitions it started with, so it gets a session of its own
    with one per core.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    source = (
        own.readStream.schema(inputs.SCHEMAS["events"])
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf)
    )
    readings = source.selectExpr(
        "event_type AS station_code",
        "cast(ts AS date) AS date",
        "event_type AS station_name",
        "'PR' AS state",
        "cast(NULL AS double) AS latitude",
        "cast(NULL AS double) AS longitude",
        "round(value * 100) AS temp_instant",
        "cast(NULL AS double) AS temp_max",
        "CASE WHEN event_id % 2 = 0 THEN round(value * 100) - 3 END AS temp_min",
        "cast(event_id % 101 AS double) AS humidity_instant",
        "cast(event_id % 3 AS double) AS precipitation",
        "event_id AS read_order",
    )
    path, log = _folder(spark, "stream"), _folder(spark, "stream-log")
    query = maintain_daily_climate(readings, path, log)
    query.awaitTermination()
    return tables.read_daily_climate(spark, path)


_DAILY_STREAM_SQL = """SELECT event_type AS station_code, CAST(ts AS DATE) AS date,
    event_type AS station_name, 'PR' AS state, NULL::DOUBLE AS latitude, NULL::DOUBLE AS longitude,
    avg(round(value * 100)) AS avg_temp,
    coalesce(min(CASE WHEN event_id % 2 = 0 THEN round(value * 100) - 3 END),
        min(round(value * 100))) AS min_temp, max(round(value * 100)) AS max_temp,
    avg(CAST(event_id % 101 AS DOUBLE)) AS avg_relative_humidity,
    CAST(sum(event_id % 3) AS DOUBLE) AS total_precipitation FROM events GROUP BY 1, 2"""


_WINDOW = trailing_days(date(2024, 1, 25))

QUERIES = {
    "archive_scan": (archive_scan, _ARCHIVE_SCAN_SQL),
    "station_files": (station_files, _STATION_FILES_SQL),
    "normalize_readings": (normalize_readings, _NORMALIZE_SQL),
    "tolerant_float": (tolerant_float, _TOLERANT_FLOAT_SQL),
    "compact_date_parse": (compact_date_parse, sql(_COMPACT_DATE_SQL, "raw_admissions")),
    "file_date_parse": (file_date_parse, _FILE_DATE_SQL),
    "daily_station_metrics": (daily_station_metrics, sql(DAILY_SQL, "readings")),
    "daily_single_pass": (daily_single_pass, sql(DAILY_SQL, "readings")),
    "daily_minmax_fallback": (
        _daily_columns("min_temp", "max_temp"),
        _daily_columns_sql("min_temp", "max_temp"),
    ),
    "daily_null_preserving_sum": (
        _daily_columns("total_precipitation"),
        _daily_columns_sql("total_precipitation"),
    ),
    "first_non_null_metadata": (
        _daily_columns("station_name", "state", "latitude", "longitude"),
        _daily_columns_sql("station_name", "state", "latitude", "longitude"),
    ),
    "date_range_inclusive": (
        date_range_inclusive,
        sql(
            "SELECT * FROM readings"
            f" WHERE date BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'",
            "readings",
        ),
    ),
    "trailing_window": (
        trailing_window,
        sql(
            DAILY_SQL.replace(
                "FROM readings",
                f"FROM readings WHERE date BETWEEN DATE '{_WINDOW[0]}' AND DATE '{_WINDOW[1]}'",
            ),
            "readings",
        ),
    ),
    "station_list_filter": (
        station_list_filter,
        "SELECT event_type AS station_code, CAST(ts AS DATE) AS date, count(*) AS readings"
        " FROM events WHERE event_type IN ('view', 'click', 'signup') GROUP BY 1, 2",
    ),
    "station_table_filter": (
        station_table_filter,
        sql(f"SELECT * FROM readings WHERE station_code IN ({_CUSTOMERS_AS_STATIONS})", "readings"),
    ),
    "readings_per_station": (readings_per_station, sql(_PER_STATION_SQL, "readings")),
    "filter_codes_in": (
        filter_codes_in,
        sql(f"SELECT * FROM raw_admissions WHERE MUNIC_RES IN ({CODE_LIST})", "raw_admissions"),
    ),
    "filter_codes_table": (
        filter_codes_table,
        sql(
            "SELECT * FROM raw_admissions WHERE MUNIC_RES IN (SELECT ibge_code FROM municipalities)",
            "raw_admissions",
            "municipalities",
        ),
    ),
    "filter_code_regex": (
        filter_code_regex,
        sql(
            "SELECT * FROM raw_admissions WHERE regexp_matches(DIAG_PRINC, '^J[0-9]{2}')",
            "raw_admissions",
        ),
    ),
    "competence_filter": (
        competence_filter,
        sql(
            "SELECT competence, count(*) AS records FROM raw_admissions"
            " WHERE competence BETWEEN '1996-11' AND '1998-02' GROUP BY 1",
            "raw_admissions",
        ),
    ),
    "keep_last_by_key": (
        keep_last_by_key,
        sql(
            "SELECT * FROM raw_admissions QUALIFY row_number() OVER"
            " (PARTITION BY N_AIH ORDER BY competence DESC, source_row DESC) = 1",
            "raw_admissions",
        ),
    ),
    "select_rename_cast": (select_rename_cast, sql(_SELECT_RENAME_SQL, "raw_admissions")),
    "clean_admissions": (clean_admissions, sql("SELECT * FROM clean", "clean")),
    "stage_counters": (stage_counters, sql(_STAGE_COUNTERS_SQL, "raw_admissions")),
    "union_periods": (
        union_periods,
        sql(
            "SELECT left(competence, 4) AS year, count(*) AS records FROM raw_admissions GROUP BY 1",
            "raw_admissions",
        ),
    ),
    "climate_sink_rerun": (climate_sink_rerun, sql(_CLIMATE_SINK_SQL, "readings")),
    "climate_sink_by_state": (
        climate_sink_by_state,
        sql("SELECT * FROM daily_climate WHERE state IN ('PR', 'BA')", "daily_climate"),
    ),
    "admissions_sink": (admissions_sink, sql(_ADMISSIONS_SINK_SQL, "clean")),
    "landed_admissions": (
        landed_admissions,
        sql(
            "SELECT MUNIC_RES AS municipality_residence_code, count(*) AS records,"
            " count(DISTINCT N_AIH) AS keys FROM (SELECT * FROM raw_admissions"
            f" WHERE MUNIC_RES IN ({CODE_LIST}) AND regexp_matches(DIAG_PRINC, '^J[0-9]{{2}}')"
            " QUALIFY row_number() OVER (PARTITION BY N_AIH"
            " ORDER BY competence DESC, state DESC, source_row DESC) = 1) GROUP BY 1",
            "raw_admissions",
        ),
    ),
    "backfill_merge": (backfill_merge, sql(_BACKFILL_SQL, "daily_climate")),
    "climate_merge": (climate_merge, sql(_CLIMATE_MERGE_SQL, "daily_climate")),
    "admissions_merge": (admissions_merge, sql(_ADMISSIONS_MERGE_SQL, "clean")),
    "admissions_merge_out_of_order": (admissions_merge_out_of_order, sql(_LANDED_CLEAN_SQL, "raw_admissions")),
    "incremental_admissions": (incremental_admissions, sql(_LANDED_CLEAN_SQL, "raw_admissions")),
    "changed_competences": (changed_competences, sql(_CHANGED_SQL, "raw_admissions")),
    "daily_stream": (daily_stream, _DAILY_STREAM_SQL),
}
