"""Queries over the models: staging, dimensions, facts, mart, series, checks, monitoring."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from climora import schemas
from climora.catalogue import inputs
from climora.catalogue.inputs import DIAGNOSIS, MUNICIPALITIES, sql, table
from climora.functions.geography import macro_region
from climora.operators import lag, monitoring, nearest, quality, rollups
from climora.operators.admissions import clean_admissions
from climora.plans import jobs, marts
from climora.session import shared_folder
from climora.sources import sinks, tables

MART = "mart_climate_health_correlation"
RANGE = (date(1996, 3, 1), date(1998, 8, 31))


def all_models(spark: SparkSession, sf: str, start=None, end=None) -> jobs.Models:
    return jobs.Models(
        climate=inputs.daily_climate(spark, sf),
        admissions=clean_admissions(inputs.raw_admissions(spark, sf), MUNICIPALITIES, DIAGNOSIS),
        municipalities=inputs.municipalities(spark, sf),
        mapping=inputs.station_mapping(spark, sf),
        calendar=marts.date_dimension(inputs.calendar_bounds(spark, sf)),
        start=start,
        end=end,
    )


def stored_models(spark: SparkSession, sf: str) -> jobs.Models:
    """The models over stored inputs, as the jobs run them: many checks, one ingestion."""
    root = f"{shared_folder(spark)}/inputs-{uuid.uuid4().hex}"
    raw = inputs.raw_admissions(spark, sf)
    sinks.write_table(clean_admissions(raw, MUNICIPALITIES, DIAGNOSIS), f"{root}/admissions")
    sinks.write_table(inputs.daily_climate(spark, sf), f"{root}/climate")
    return jobs.Models(
        climate=tables.read_daily_climate(spark, f"{root}/climate"),
        admissions=tables.read_admissions(spark, f"{root}/admissions"),
        municipalities=inputs.municipalities(spark, sf),
        mapping=inputs.station_mapping(spark, sf),
        calendar=marts.date_dimension(inputs.calendar_bounds(spark, sf)),
    )


def _model(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return all_models(spark, sf)[name]

    return run


def _model_sql(name: str) -> str:
    return sql(f"SELECT * FROM {name}", name)


def group_prefix(spark: SparkSession, sf: str) -> DataFrame:
    """Admissions per three-character diagnosis category."""
    enriched = all_models(spark, sf)["int_datasus__admissions_enriched"]
    return enriched.groupBy("icd_group").agg(F.count(F.lit(1)).alias("admissions"))


def region_map(spark: SparkSession, sf: str) -> DataFrame:
    """Customers per macro-region of a state derived from their nation."""
    states = table(spark, sf, "nation").selectExpr(
        "n_nationkey",
        "element_at(array('AC', 'AP', 'AM', 'PA', 'RO', 'RR', 'TO', 'AL', 'BA', 'CE', 'MA', 'PB',"
        " 'PE', 'PI', 'RN', 'SE', 'DF', 'GO', 'MT', 'ES', 'RJ', 'PR', 'SC', 'zz',"
        " cast(NULL AS string)), n_nationkey + 1) AS state",
    )
    return (
        table(spark, sf, "customer")
        .join(states, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("state", macro_region(F.col("state")).alias("region"))
        .agg(F.count(F.lit(1)).alias("customers"))
    )


_REGION_MAP_SQL = """SELECT state, CASE WHEN n_nationkey <= 6 THEN 'Norte'
        WHEN n_nationkey <= 15 THEN 'Nordeste' WHEN n_nationkey <= 18 THEN 'Centro-Oeste'
        WHEN n_nationkey <= 20 THEN 'Sudeste' WHEN n_nationkey <= 22 THEN 'Sul'
        ELSE 'Unknown' END AS region, count(*) AS customers
    FROM customer JOIN (SELECT n_nationkey, (['AC', 'AP', 'AM', 'PA', 'RO', 'RR', 'TO', 'AL', 'BA',
        'CE', 'MA', 'PB', 'PE', 'PI', 'RN', 'SE', 'DF', 'GO', 'MT', 'ES', 'RJ', 'PR', 'SC', 'zz',
        NULL])[n_nationkey + 1] AS state FROM nation) ON c_nationkey = n_nationkey GROUP BY 1, 2"""


def station_latest_attributes(spark: SparkSession, sf: str) -> DataFrame:
    staged = all_models(spark, sf)["stg_inmet__daily_climate"]
    return marts.latest_station_attributes(staged)


STATION_LATEST_SQL = """SELECT station_code,
    arg_max(station_name, date_day) FILTER (WHERE station_name IS NOT NULL) AS station_name,
    arg_max(state, date_day) FILTER (WHERE state IS NOT NULL) AS state,
    arg_max(latitude, date_day) FILTER (WHERE latitude IS NOT NULL) AS latitude,
    arg_max(longitude, date_day) FILTER (WHERE longitude IS NOT NULL) AS longitude
    FROM stg_inmet__daily_climate GROUP BY 1"""


def daily_admissions(spark: SparkSession, sf: str) -> DataFrame:
    return marts.daily_admissions(all_models(spark, sf)["fct_respiratory_admissions"])


def admissions_by_station(spark: SparkSession, sf: str) -> DataFrame:
    return marts.with_station(daily_admissions(spark, sf), inputs.station_mapping(spark, sf))


def correlation_mart_range(spark: SparkSession, sf: str) -> DataFrame:
    return all_models(spark, sf, *RANGE)["mart_climate_health_correlation"]


def mart_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """A mart stored by month, of which a span of months is rebuilt from corrected climate."""
    path = f"{shared_folder(spark)}/mart-{uuid.uuid4().hex}"
    built = all_models(spark, sf)
    sinks.write_mart(built[MART], path)
    corrected = built["fct_daily_climate"].withColumn("avg_temp", F.col("avg_temp") + 1)
    jobs.refresh_mart(
        built["fct_respiratory_admissions"],
        corrected,
        built["municipality_station_mapping"],
        path,
        (1996, 3),
        (1998, 8),
    )
    return tables.read_mart(spark, path)


_MART_REFRESH_SQL = f"""SELECT * REPLACE (
    CASE WHEN date_day BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}' THEN avg_temp + 1
        ELSE avg_temp END AS avg_temp),
    CAST(date_trunc('month', date_day) AS DATE) AS mart_month
    FROM mart_climate_health_correlation"""


def _series(function, granularity: str | None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return function(all_models(spark, sf)["mart_climate_health_correlation"], granularity)

    return run


# Means of means are compared after rounding: their inputs are not whole numbers.
def _rounded(query, column: str = "avg_temp", digits: int = 9):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return query(spark, sf).withColumn(column, F.round(column, digits))

    return run


def _series_sql(unit: str, extra: str = "") -> str:
    return sql(
        f"""SELECT CAST(CAST(date_trunc('{unit}', date_day) AS DATE) AS VARCHAR) AS period,
        round(avg(avg_temp), 9) AS avg_temp,
        coalesce(CAST(sum(daily_admission_count) AS INTEGER), 0) AS admission_count{extra}
        FROM mart_climate_health_correlation GROUP BY date_trunc('{unit}', date_day)""",
        "mart_climate_health_correlation",
    )


def _label_sql(unit: str, pattern: str) -> str:
    return _series_sql(unit, f", strftime(date_trunc('{unit}', date_day), '{pattern}') AS label")


def rollup_station_day(spark: SparkSession, sf: str) -> DataFrame:
    built = all_models(spark, sf)
    return rollups.rollup_by_station_day(
        built["fct_daily_climate"], built["fct_respiratory_admissions"], "weekly"
    )


_ROLLUP_STATION_DAY_SQL = """SELECT CAST(CAST(coalesce(c.p, a.p) AS DATE) AS VARCHAR) AS period,
    round(avg_temp, 9) AS avg_temp, CAST(coalesce(n, 0) AS INTEGER) AS admission_count
    FROM (SELECT date_trunc('week', fk_date) AS p, avg(avg_temp) AS avg_temp
        FROM fct_daily_climate GROUP BY 1) c
    FULL JOIN (SELECT date_trunc('week', fk_date) AS p, sum(admission_count) AS n
        FROM fct_respiratory_admissions GROUP BY 1) a ON c.p = a.p"""


def regional_rollup(spark: SparkSession, sf: str) -> DataFrame:
    built = all_models(spark, sf)
    return rollups.regional_rollup(
        built["mart_climate_health_correlation"],
        built["dim_location"],
        marts.latest_station_attributes(built["stg_inmet__daily_climate"]),
        "monthly",
    )


_REGIONAL_SQL = f"""SELECT CAST(date_trunc('month', date_day) AS DATE) AS period,
    CASE st WHEN 'PR' THEN 'Sul' WHEN 'SP' THEN 'Sudeste' WHEN 'BA' THEN 'Nordeste'
        WHEN 'GO' THEN 'Centro-Oeste' WHEN 'AM' THEN 'Norte' ELSE 'Unknown' END AS region,
    st AS state, round(avg(avg_temp), 9) AS avg_temp,
    CAST(sum(daily_admission_count) AS BIGINT) AS admission_count
    FROM (SELECT m.*, coalesce(l.state, s.state) AS st FROM mart_climate_health_correlation m
        LEFT JOIN dim_location l ON m.fk_municipality = l.ibge_code
        LEFT JOIN ({STATION_LATEST_SQL}) s ON m.station_code = s.station_code)
    GROUP BY 1, 2, 3"""


_LAT, _LON = "-33.75 + ({0} * 7919 % 39000) / 1000.0", "-73.99 + ({0} * 104729 % 39200) / 1000.0"


def nearest_station(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest station (a supplier) of each place (a customer), all given coordinates within the country by their number."""
    def located(name: str, key: str, code: str) -> DataFrame:
        lat, lon = (f"cast({c.format(key)} AS double)" for c in (_LAT, _LON))
        return table(spark, sf, name).selectExpr(f"cast({key} AS string) AS {code}", f"{lat} AS latitude", f"{lon} AS longitude")

    found = nearest.nearest_stations(located("customer", "c_custkey", "ibge_code"), located("supplier", "s_suppkey", "station_code"))
    return found.withColumn("distance_km", F.round("distance_km", 6))


_HALF = "pow(sin(radians({0} - {1}) / 2), 2)"
_NEAREST_SQL = f"""SELECT ibge_code, arg_min(station_code, (km, station_code)) AS station_code, min(km) AS distance_km FROM (
    SELECT ibge_code, station_code, round(2 * {nearest.EARTH_KM} * asin(least(1.0, sqrt({_HALF.format("s.lat", "p.lat")}
        + cos(radians(p.lat)) * cos(radians(s.lat)) * {_HALF.format("s.lon", "p.lon")}))), 6) AS km
    FROM (SELECT CAST(c_custkey AS VARCHAR) AS ibge_code, {_LAT.format("c_custkey")} AS lat, {_LON.format("c_custkey")} AS lon FROM customer) p,
        (SELECT CAST(s_suppkey AS VARCHAR) AS station_code, {_LAT.format("s_suppkey")} AS lat, {_LON.format("s_suppkey")} AS lon FROM supplier) s)
    GROUP BY 1"""


def last_updated(spark: SparkSession, sf: str) -> DataFrame:
    return rollups.last_updated(all_models(spark, sf)["mart_climate_health_correlation"])


# --- checks ------------------------------------------------------------------------------------


def _check(make):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return quality.failing_rows(make(), all_models(spark, sf))

    return run


def dq_run(spark: SparkSession, sf: str) -> DataFrame:
    return quality.run_checks(quality.declared_checks(), stored_models(spark, sf))


def dq_results_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Results kept per run date; a second run of a day replaces that day only."""
    path = f"{shared_folder(spark)}/checks-{uuid.uuid4().hex}"
    results = quality.run_checks(
        [
            quality.not_null("fct_respiratory_admissions", "fk_date"),
            quality.unique("dim_weather_station", "station_code"),
        ],
        stored_models(spark, sf),
    )
    for day in (date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 2)):
        quality.store_results(results, path, day)
    return spark.read.parquet(path).select(
        "model", "column", "test", "failures", "passed", F.col("run_date").cast("date")
    )


def _result(model: str, column: str, test: str, failures: str) -> str:
    return (
        f"SELECT '{model}' AS model, '{column}' AS \"column\", '{test}' AS test,"
        f" CAST(({failures}) AS BIGINT) AS failures"
    )


# The declared checks written out a second time, so that one that is missing or on another column shows.
_NOT_NULL = """dim_date date_day year month day day_of_week month_name season
    dim_location ibge_code region
    dim_weather_station station_code
    fct_respiratory_admissions aih_number fk_date fk_municipality admission_count icd_group
    fct_daily_climate fk_date fk_station
    mart_climate_health_correlation date_day daily_admission_count
    int_datasus__admissions_enriched aih_number icd_group
    stg_inmet__daily_climate station_code date_day
    stg_datasus__admissions aih_number municipality_residence_code admission_date primary_diagnosis
    municipalities ibge_code
    municipality_station_mapping municipality_ibge_code"""
_UNIQUE = """dim_date date_day
    dim_location ibge_code
    dim_weather_station station_code
    fct_respiratory_admissions aih_number
    int_datasus__admissions_enriched aih_number
    stg_datasus__admissions aih_number
    municipalities ibge_code
    municipality_station_mapping municipality_ibge_code"""


def _listed(text: str) -> list[tuple[str, str]]:
    return [(model, c) for model, *columns in map(str.split, text.splitlines()) for c in columns]


def _dq_run_sql() -> str:
    rows = [_result(m, c, "not_null", f"SELECT count(*) FROM {m} WHERE {c} IS NULL") for m, c in _listed(_NOT_NULL)]
    rows += [
        _result(
            m,
            c,
            "unique",
            f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL"
            " GROUP BY 1 HAVING count(*) > 1)",
        )
        for m, c in _listed(_UNIQUE)
    ]
    for m, c, values in (
        ("dim_date", "month", "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12"),
        ("dim_date", "season", "'Summer', 'Autumn', 'Winter', 'Spring'"),
        ("dim_location", "region", "'Norte', 'Nordeste', 'Centro-Oeste', 'Sudeste', 'Sul'"),
        ("fct_respiratory_admissions", "admission_count", "1"),
    ):
        bad = f"SELECT count(DISTINCT {c}) FROM {m} WHERE {c} NOT IN ({values})"
        rows.append(_result(m, c, "accepted_values", bad))
    for m, c, parent, key in (
        ("fct_respiratory_admissions", "fk_date", "dim_date", "date_day"),
        ("fct_respiratory_admissions", "fk_municipality", "dim_location", "ibge_code"),
        ("fct_daily_climate", "fk_date", "dim_date", "date_day"),
        ("fct_daily_climate", "fk_station", "dim_weather_station", "station_code"),
    ):
        orphans = (
            f"SELECT count(*) FROM {m} c WHERE {c} IS NOT NULL AND NOT EXISTS"
            f" (SELECT 1 FROM {parent} p WHERE p.{key} = c.{c})"
        )
        rows.append(_result(m, c, "relationships", orphans))
    for m, c, condition in (
        ("fct_respiratory_admissions", "length_of_stay", "length_of_stay >= 0"),
        ("fct_daily_climate", "min_temp", "min_temp <= max_temp"),
        ("stg_datasus__admissions", "primary_diagnosis", "primary_diagnosis LIKE ''J%''"),
    ):
        condition = condition.replace("''", "'")
        bad = f"SELECT count(*) FROM {m} WHERE NOT ({condition})"
        rows.append(_result(m, c, "expression_is_true", bad))
    for m, columns in (
        ("fct_daily_climate", "fk_date,fk_station"),
        ("stg_inmet__daily_climate", "station_code,date_day"),
    ):
        doubles = f"SELECT count(*) FROM (SELECT 1 FROM {m} GROUP BY {columns} HAVING count(*) > 1)"
        rows.append(_result(m, columns, "unique_combination_of_columns", doubles))
    body = "SELECT *, failures = 0 AS passed FROM (" + "\nUNION ALL ".join(rows) + ")"
    return sql(body, "dim_date", "dim_location", "dim_weather_station",
               "mart_climate_health_correlation")


_DQ_STORED_SQL = """SELECT model, "column", test, failures, failures = 0 AS passed, run_date
    FROM (SELECT 'fct_respiratory_admissions' AS model, 'fk_date' AS "column",
            'not_null' AS test, count(*) AS failures
            FROM fct_respiratory_admissions WHERE fk_date IS NULL
        UNION ALL SELECT 'dim_weather_station', 'station_code', 'unique', count(*)
            FROM (SELECT station_code FROM dim_weather_station GROUP BY 1 HAVING count(*) > 1)),
    (VALUES (DATE '2024-01-01'), (DATE '2024-01-02')) AS d(run_date)"""


# --- monitoring, questions ---------------------------------------------------------------------


def volume_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Days whose event count is far from that of the seven days before."""
    events = table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))
    found = monitoring.volume_anomalies(events, "day", "event_type", window_days=7, threshold=1.5)
    return found.withColumns({c: F.round(c, 6) for c in ("expected", "spread")})


_VOLUME_SQL = """SELECT group_key, day, row_count, days_before, round(expected, 6) AS expected,
    round(spread, 6) AS spread FROM (
    SELECT group_key, day, row_count, count(row_count) OVER w AS days_before,
        avg(row_count) OVER w AS expected, stddev_pop(row_count) OVER w AS spread
    FROM (SELECT k.group_key, k.day, coalesce(n.row_count, 0) AS row_count FROM (
        SELECT event_type AS group_key, CAST(unnest(generate_series(min(CAST(ts AS DATE)),
            max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day FROM events GROUP BY 1) k
        LEFT JOIN (SELECT event_type AS group_key, CAST(ts AS DATE) AS day, count(*) AS row_count
            FROM events GROUP BY 1, 2) n ON k.group_key = n.group_key AND k.day = n.day)
    WINDOW w AS (PARTITION BY group_key ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
    WHERE days_before = 7 AND abs(row_count - expected) > 1.5 * spread"""


WATCHED = (date(1992, 6, 1), date(1999, 1, 10))


def feed_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    """Shipments by status as feeds: most of each Sunday is missing as a rule, and one of them stops."""
    shipped = table(spark, sf, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    fed = shipped.filter("weekday(day) <> 6 OR l_linenumber = 1").filter("l_linestatus <> 'O' OR day < DATE '1998-11-01'")
    found = monitoring.feed_anomalies(fed, "day", "l_linestatus", as_of=WATCHED[1], first=WATCHED[0], weeks=6, limit=2.0, silence=3)
    return found.withColumns({c: F.round(c, 6) for c in ("expected", "spread")})


_FEED_SQL = f"""SELECT group_key, day, row_count, round(expected, 6) AS expected, round(spread, 6) AS spread, silent_days, kind FROM (
    SELECT *, CASE WHEN silent_days >= 3 THEN 'silent' WHEN row_count < expected - 2 * spread THEN 'low'
        WHEN row_count > expected + 2 * spread THEN 'high' END AS kind
    FROM (SELECT *, CASE WHEN expected IS NOT NULL THEN greatest(1.4826 * mad_before, sqrt(expected), 1.0) END AS spread
    FROM (SELECT group_key, day, row_count, CAST(date_diff('day', max(CASE WHEN row_count > 0 THEN day END) OVER (
            PARTITION BY group_key ORDER BY day), day) AS INTEGER) AS silent_days,
        CASE WHEN count(*) OVER w = 6 THEN median(row_count) OVER w END AS expected,
        CAST(mad(CAST(row_count AS DOUBLE)) OVER w AS DOUBLE) AS mad_before
    FROM (SELECT k.group_key, k.day, coalesce(n.row_count, 0) AS row_count FROM (
        SELECT l_linestatus AS group_key, CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)),
            DATE '{WATCHED[1]}' - 1, INTERVAL 1 DAY)) AS DATE) AS day
        FROM lineitem WHERE l_shipdate >= DATE '{WATCHED[0]}' AND (isodow(l_shipdate) <> 7 OR l_linenumber = 1)
            AND (l_linestatus <> 'O' OR l_shipdate < DATE '1998-11-01') GROUP BY 1) k
        LEFT JOIN (SELECT l_linestatus AS group_key, CAST(l_shipdate AS DATE) AS day, count(*) AS row_count
            FROM lineitem WHERE (isodow(l_shipdate) <> 7 OR l_linenumber = 1) AND (l_linestatus <> 'O' OR l_shipdate < DATE '1998-11-01')
            GROUP BY 1, 2) n
        ON k.group_key = n.group_key AND k.day = n.day)
    WINDOW w AS (PARTITION BY group_key, isodow(day) ORDER BY day ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))))
    WHERE kind IS NOT NULL"""


def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Landed columns that differ from the expected schema, with the rows they concern."""
    landed = inputs.daily_climate(spark, sf).withColumn(
        "avg_temp", F.col("avg_temp").cast("float")
    )
    landed = landed.withColumnRenamed("total_precipitation", "rain")
    return monitoring.schema_drift(landed, schemas.DAILY_CLIMATE)


_SCHEMA_DRIFT_SQL = """SELECT v.*, (SELECT count(*) FROM daily_climate) AS row_count FROM (VALUES
    ('avg_temp', 'double', 'float'), ('rain', NULL, 'double'),
    ('total_precipitation', 'double', NULL)) AS v("column", expected_type, actual_type)"""


def freshness(spark: SparkSession, sf: str) -> DataFrame:
    staged = all_models(spark, sf)["stg_datasus__admissions"]
    return monitoring.freshness(staged, "admission_date", date(2001, 9, 1), 62)


_FRESHNESS_SQL = """SELECT max(admission_date) AS latest,
    CAST(date_diff('day', max(admission_date), DATE '2001-09-01') AS INTEGER) AS age_days,
    date_diff('day', max(admission_date), DATE '2001-09-01') > 62 AS is_stale
    FROM stg_datasus__admissions"""


def lagged_corr(spark: SparkSession, sf: str) -> DataFrame:
    mart = all_models(spark, sf)["mart_climate_health_correlation"]
    return lag.lagged_correlation(mart, max_lag=14)


_LAGGED_SQL = """WITH daily AS MATERIALIZED (
        SELECT station_code, date_day, max(avg_temp) AS avg_temp,
            CAST(sum(daily_admission_count) AS DOUBLE) AS n
        FROM mart_climate_health_correlation
        WHERE station_code IS NOT NULL AND date_day IS NOT NULL GROUP BY 1, 2),
    filled AS MATERIALIZED (SELECT s.station_code, s.d AS date_day, avg_temp, coalesce(n, 0) AS n
        FROM (SELECT station_code, CAST(unnest(generate_series(min(date_day), max(date_day),
            INTERVAL 1 DAY)) AS DATE) AS d FROM daily GROUP BY 1) s
        LEFT JOIN daily ON daily.station_code = s.station_code AND date_day = s.d)
    SELECT a.station_code, CAST(k AS INTEGER) AS lag_days,
        round(corr(a.avg_temp, b.n), 6) AS correlation
    FROM filled a, range(15) r(k), filled b
    WHERE b.station_code = a.station_code AND b.date_day = a.date_day + CAST(k AS INTEGER)
    GROUP BY 1, 2"""


def _nest(body: str, *reads: str) -> str:
    """A body that has its own WITH list, placed over the relations it reads."""
    return sql(f"SELECT * FROM ({body})", *reads)


QUERIES = {
    "stage_climate": (_model("stg_inmet__daily_climate"), _model_sql("stg_inmet__daily_climate")),
    "stage_admissions": (
        _model("stg_datasus__admissions"),
        _model_sql("stg_datasus__admissions"),
    ),
    "enriched_admissions": (
        _model("int_datasus__admissions_enriched"),
        _model_sql("int_datasus__admissions_enriched"),
    ),
    "group_prefix": (
        group_prefix,
        sql(
            "SELECT icd_group, count(*) AS admissions FROM int_datasus__admissions_enriched"
            " GROUP BY 1",
            "int_datasus__admissions_enriched",
        ),
    ),
    "region_map": (region_map, _REGION_MAP_SQL),
    "dim_date_spine": (_model("dim_date"), _model_sql("dim_date")),
    "dim_location_left": (_model("dim_location"), _model_sql("dim_location")),
    "dim_station_distinct": (_model("dim_weather_station"), _model_sql("dim_weather_station")),
    "station_latest_attributes": (
        station_latest_attributes,
        sql(STATION_LATEST_SQL, "stg_inmet__daily_climate"),
    ),
    "fact_admissions": (
        _model("fct_respiratory_admissions"),
        _model_sql("fct_respiratory_admissions"),
    ),
    "fact_climate": (_model("fct_daily_climate"), _model_sql("fct_daily_climate")),
    "daily_admissions": (daily_admissions, _model_sql("daily_admissions")),
    "admissions_by_station": (admissions_by_station, _model_sql("admissions_by_station")),
    "correlation_mart": (_model(MART), _model_sql(MART)),
    "correlation_mart_range": (
        correlation_mart_range,
        sql(
            f"SELECT * FROM {MART} WHERE date_day BETWEEN DATE '{RANGE[0]}' AND DATE '{RANGE[1]}'",
            MART,
        ),
    ),
    "mart_refresh": (mart_refresh, sql(_MART_REFRESH_SQL, MART)),
    "rollup_weekly": (_rounded(_series(rollups.points, "weekly")), _series_sql("week")),
    "rollup_monthly": (_rounded(_series(rollups.points, "monthly")), _series_sql("month")),
    "rollup_default": (_rounded(_series(rollups.points, "yearly?")), _series_sql("month")),
    "period_label_weekly": (
        _rounded(_series(rollups.labelled_points, "weekly")),
        _label_sql("week", "%b %-d, %Y"),
    ),
    "period_label_monthly": (
        _rounded(_series(rollups.labelled_points, "monthly")),
        _label_sql("month", "%b %Y"),
    ),
    "rollup_station_day": (
        _rounded(rollup_station_day),
        sql(_ROLLUP_STATION_DAY_SQL, "fct_daily_climate", "fct_respiratory_admissions"),
    ),
    "regional_rollup": (_rounded(regional_rollup), sql(_REGIONAL_SQL, MART, "dim_location")),
    "nearest_station": (nearest_station, _NEAREST_SQL),
    "last_updated": (
        last_updated,
        sql(f"SELECT CAST(max(date_day) AS VARCHAR) AS last_updated FROM {MART}", MART),
    ),
    "dq_not_null": (
        _check(lambda: quality.not_null("fct_respiratory_admissions", "fk_date")),
        sql(
            "SELECT * FROM fct_respiratory_admissions WHERE fk_date IS NULL",
            "fct_respiratory_admissions",
        ),
    ),
    "dq_unique": (
        _check(lambda: quality.unique("dim_weather_station", "station_code")),
        sql(
            "SELECT station_code, count(*) AS n_records FROM dim_weather_station"
            " WHERE station_code IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
            "dim_weather_station",
        ),
    ),
    "dq_accepted_values": (
        _check(
            lambda: quality.accepted_values(
                "dim_location", "region", ("Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul")
            )
        ),
        sql(
            "SELECT region AS value, count(*) AS n_records FROM dim_location WHERE region NOT IN"
            " ('Norte', 'Nordeste', 'Centro-Oeste', 'Sudeste', 'Sul') GROUP BY 1",
            "dim_location",
        ),
    ),
    "dq_relationships": (
        _check(
            lambda: quality.relationships(
                "fct_respiratory_admissions",
                "fk_municipality",
                "municipality_station_mapping",
                "municipality_ibge_code",
            )
        ),
        sql(
            "SELECT fk_municipality AS key, count(*) AS n_records FROM fct_respiratory_admissions"
            " WHERE fk_municipality NOT IN (SELECT municipality_ibge_code"
            " FROM municipality_station_mapping) GROUP BY 1",
            "fct_respiratory_admissions",
            "municipality_station_mapping",
        ),
    ),
    "dq_expression": (
        _check(
            lambda: quality.expression(
                "fct_respiratory_admissions", "length_of_stay", "length_of_stay <= 25"
            )
        ),
        sql(
            "SELECT * FROM fct_respiratory_admissions WHERE NOT (length_of_stay <= 25)",
            "fct_respiratory_admissions",
        ),
    ),
    "dq_unique_combination": (
        _check(
            lambda: quality.unique_combination(
                "fct_respiratory_admissions", "fk_date", "fk_municipality"
            )
        ),
        sql(
            "SELECT fk_date, fk_municipality, count(*) AS n_records FROM fct_respiratory_admissions"
            " GROUP BY ALL HAVING count(*) > 1",
            "fct_respiratory_admissions",
        ),
    ),
    "dq_run": (dq_run, _dq_run_sql()),
    "dq_results_stored": (
        dq_results_stored,
        sql(_DQ_STORED_SQL, "fct_respiratory_admissions", "dim_weather_station"),
    ),
    "volume_anomalies": (volume_anomalies, _VOLUME_SQL),
    "feed_anomalies": (feed_anomalies, _FEED_SQL),
    "schema_drift": (schema_drift, sql(_SCHEMA_DRIFT_SQL, "daily_climate")),
    "freshness": (freshness, sql(_FRESHNESS_SQL, "stg_datasus__admissions")),
    "lagged_corr": (_rounded(lagged_corr, "correlation", 6), _nest(_LAGGED_SQL, MART)),
}
