"""The driver's tables in the shapes the engine works on, as Spark and as SQL.

Analogy: ``events`` are hourly readings; ``orders`` with ``customer`` are admission records;
``lineitem`` with ``supplier`` is daily climate; ``nation`` is the municipality reference. Measures
are whole numbers held as doubles, so that sums and means do not depend on the order of addition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MUNICIPALITIES = tuple(f"41{n:04d}" for n in range(25) if n % 3)
DIAGNOSIS = r"^J\d{2}"


# Stated, so that declaring a query reads no file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Typed hourly readings with gaps and with metadata that are not always given."""
    return table(spark, sf, "events").selectExpr(
        "concat('U', user_id) AS station_code",
        "cast(ts AS date) AS date",
        "CASE WHEN event_id % 3 = 0 THEN event_type END AS station_name",
        "CASE WHEN event_id % 5 = 1 THEN upper(substring(event_type, 1, 2)) END AS state",
        "CASE WHEN event_id % 4 = 0 THEN cast(event_id % 90 AS double) END AS latitude",
        "CASE WHEN event_id % 7 = 0 THEN cast(event_id % 180 AS double) END AS longitude",
        "CASE WHEN event_type <> 'error' THEN round(value * 100) END AS temp_instant",
        "CASE WHEN event_type = 'click' THEN round(value * 100) + 50 END AS temp_max",
        "CASE WHEN event_type = 'view' THEN round(value * 100) - 50 END AS temp_min",
        "CASE WHEN event_type <> 'signup' THEN cast(event_id % 101 AS double) END"
        " AS humidity_instant",
        "CASE WHEN event_type = 'purchase' THEN round(value * 10) END AS precipitation",
        "event_id AS read_order",
    )


def raw_admissions(spark: SparkSession, sf: str) -> DataFrame:
    """Raw admission records: repeated and missing keys, bad dates, numbers and diagnoses."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "CASE WHEN o_orderkey % 1000 <> 500 THEN"
        " cast(o_orderkey - CASE WHEN o_orderkey % 25 = 24 THEN 1 ELSE 0 END AS string)"
        " END AS N_AIH",
        "concat('41', lpad(c_nationkey, 4, '0')) AS MUNIC_RES",
        "CASE WHEN o_orderkey % 97 = 5 THEN '20240230'"
        " ELSE date_format(o_orderdate, 'yyyyMMdd') END AS DT_INTER",
        "CASE WHEN o_orderkey % 89 = 3 THEN NULL WHEN o_orderkey % 61 = 2 THEN 'JX1'"
        " ELSE concat(CASE WHEN o_orderpriority < '4' THEN 'J' ELSE 'I' END,"
        " lpad(o_orderkey % 100, 2, '0'), o_orderkey % 10) END AS DIAG_PRINC",
        "CASE WHEN o_orderkey % 53 = 1 THEN 'x'"
        " ELSE cast(cast(round(o_totalprice * 100) AS bigint) AS string) END AS VAL_TOT",
        "CASE WHEN o_orderkey % 71 = 7 THEN 'n/a'"
        " WHEN o_orderkey % 3 = 0 THEN cast(o_orderkey % 30 AS string)"
        " WHEN o_orderkey % 3 = 1 THEN concat(o_orderkey % 30, '.5')"
        " ELSE concat(' ', o_orderkey % 30, ' ') END AS DIAS_PERM",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'PR' ELSE 'SC' END AS state",
        "date_format(add_months(o_orderdate, cast(o_orderkey % 3 AS int)), 'yyyy-MM')"
        " AS competence",
        "'' AS source_file",
        "o_orderkey AS source_row",
    )


def daily_climate(spark: SparkSession, sf: str) -> DataFrame:
    """Daily climate of five stations; the latitude is missing on the 13th of each month."""
    supplier = table(spark, sf, "supplier").selectExpr(
        "s_suppkey", "s_nationkey % 5 AS station_no"
    )
    return (
        table(spark, sf, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("station_no", F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.avg("l_quantity").alias("avg_temp"),
            F.min("l_quantity").alias("min_temp"),
            F.max("l_quantity").alias("max_temp"),
            F.avg("l_linenumber").alias("avg_relative_humidity"),
            F.sum(F.round(F.col("l_extendedprice") * 100)).alias("total_precipitation"),
        )
        .selectExpr(
            "concat('A', station_no) AS station_code",
            "date",
            "concat('STATION ', station_no) AS station_name",
            "element_at(array('PR', 'SP', 'BA', 'AM', 'GO'), station_no + 1) AS state",
            "CASE WHEN day(date) <> 13 THEN -20.5 - station_no END AS latitude",
            "cast(-45.25 - station_no AS double) AS longitude",
            "avg_temp",
            "min_temp",
            "max_temp",
            "avg_relative_humidity",
            "total_precipitation",
        )
        .withColumn("latitude", F.col("latitude").cast("double"))
    )


def municipalities(spark: SparkSession, sf: str) -> DataFrame:
    """Reference data of most, not all, municipalities."""
    return table(spark, sf, "nation").filter("n_nationkey % 6 <> 0").selectExpr(
        "concat('41', lpad(n_nationkey, 4, '0')) AS ibge_code",
        "n_name AS municipality_name",
        "element_at(array('PR', 'SP', 'BA', 'XX', 'GO'), n_regionkey + 1) AS state",
        "cast(-5 - n_nationkey AS double) AS latitude",
        "cast(-40 - n_regionkey AS double) AS longitude",
    )


def station_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """Station of each municipality; every eighth has none."""
    return table(spark, sf, "nation").filter("n_nationkey % 8 <> 0").selectExpr(
        "concat('41', lpad(n_nationkey, 4, '0')) AS municipality_ibge_code",
        "concat('A', n_regionkey) AS station_code",
    )


def calendar_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """One row: first order day, and the day after the last."""
    return table(spark, sf, "orders").selectExpr("cast(o_orderdate AS date) AS d").agg(
        F.min("d").alias("start_date"), F.date_add(F.max("d"), 1).alias("end_date")
    )


_CODES = ", ".join(f"'{c}'" for c in MUNICIPALITIES)

# Each relation with the relations it reads.
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "readings": (
        (),
        """SELECT 'U' || user_id AS station_code, CAST(ts AS DATE) AS date,
        CASE WHEN event_id % 3 = 0 THEN event_type END AS station_name,
        CASE WHEN event_id % 5 = 1 THEN upper(substr(event_type, 1, 2)) END AS state,
        CASE WHEN event_id % 4 = 0 THEN CAST(event_id % 90 AS DOUBLE) END AS latitude,
        CASE WHEN event_id % 7 = 0 THEN CAST(event_id % 180 AS DOUBLE) END AS longitude,
        CASE WHEN event_type <> 'error' THEN round(value * 100) END AS temp_instant,
        CASE WHEN event_type = 'click' THEN round(value * 100) + 50 END AS temp_max,
        CASE WHEN event_type = 'view' THEN round(value * 100) - 50 END AS temp_min,
        CASE WHEN event_type <> 'signup' THEN CAST(event_id % 101 AS DOUBLE) END
            AS humidity_instant,
        CASE WHEN event_type = 'purchase' THEN round(value * 10) END AS precipitation,
        event_id AS read_order
        FROM events""",
    ),
    "raw_admissions": (
        (),
        """SELECT CASE WHEN o_orderkey % 1000 <> 500 THEN
        CAST(o_orderkey - CASE WHEN o_orderkey % 25 = 24 THEN 1 ELSE 0 END AS VARCHAR)
            END AS N_AIH,
        '41' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS MUNIC_RES,
        CASE WHEN o_orderkey % 97 = 5 THEN '20240230'
            ELSE strftime(o_orderdate, '%Y%m%d') END AS DT_INTER,
        CASE WHEN o_orderkey % 89 = 3 THEN NULL WHEN o_orderkey % 61 = 2 THEN 'JX1'
            ELSE (CASE WHEN o_orderpriority < '4' THEN 'J' ELSE 'I' END)
            || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') || (o_orderkey % 10)
            END AS DIAG_PRINC,
        CASE WHEN o_orderkey % 53 = 1 THEN 'x'
            ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) END AS VAL_TOT,
        CASE WHEN o_orderkey % 71 = 7 THEN 'n/a'
            WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 30 AS VARCHAR)
            WHEN o_orderkey % 3 = 1 THEN (o_orderkey % 30) || '.5'
            ELSE ' ' || (o_orderkey % 30) || ' ' END AS DIAS_PERM,
        CASE WHEN c_nationkey % 2 = 0 THEN 'PR' ELSE 'SC' END AS state,
        strftime(date_trunc('month', o_orderdate) + to_months(CAST(o_orderkey % 3 AS INTEGER)),
            '%Y-%m') AS competence,
        '' AS source_file, o_orderkey AS source_row
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    ),
    "daily_climate": (
        (),
        """SELECT 'A' || station_no AS station_code, date, 'STATION ' || station_no AS station_name,
        (['PR', 'SP', 'BA', 'AM', 'GO'])[station_no + 1] AS state,
        CASE WHEN day(date) <> 13 THEN CAST(-20.5 - station_no AS DOUBLE) END AS latitude,
        CAST(-45.25 - station_no AS DOUBLE) AS longitude,
        avg_temp, min_temp, max_temp, avg_relative_humidity, total_precipitation
        FROM (SELECT s_nationkey % 5 AS station_no, CAST(l_shipdate AS DATE) AS date,
            avg(l_quantity) AS avg_temp, min(l_quantity) AS min_temp, max(l_quantity) AS max_temp,
            avg(l_linenumber) AS avg_relative_humidity,
            sum(round(l_extendedprice * 100)) AS total_precipitation
            FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)""",
    ),
    "municipalities": (
        (),
        """SELECT '41' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS ibge_code,
        n_name AS municipality_name,
        (['PR', 'SP', 'BA', 'XX', 'GO'])[n_regionkey + 1] AS state,
        CAST(-5 - n_nationkey AS DOUBLE) AS latitude,
        CAST(-40 - n_regionkey AS DOUBLE) AS longitude
        FROM nation WHERE n_nationkey % 6 <> 0""",
    ),
    "municipality_station_mapping": (
        (),
        """SELECT '41' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS municipality_ibge_code,
        'A' || n_regionkey AS station_code FROM nation WHERE n_nationkey % 8 <> 0""",
    ),
    "clean": (
        ("raw_admissions",),
        f"""SELECT N_AIH AS aih_number, MUNIC_RES AS municipality_residence_code,
        CAST(try_strptime(DT_INTER, '%Y%m%d') AS DATE) AS admission_date,
        DIAG_PRINC AS primary_diagnosis,
        TRY_CAST(trim(VAL_TOT) AS DOUBLE) AS total_aih_value,
        TRY_CAST(trim(DIAS_PERM) AS DOUBLE) AS length_of_stay
        FROM raw_admissions
        WHERE MUNIC_RES IN ({_CODES}) AND regexp_matches(DIAG_PRINC, '^J[0-9]{{2}}')
        QUALIFY row_number() OVER (PARTITION BY N_AIH
            ORDER BY competence DESC, source_row DESC) = 1""",
    ),
    "stg_inmet__daily_climate": (
        ("daily_climate",),
        """SELECT station_code, date AS date_day, station_name, state, latitude, longitude,
        avg_temp, min_temp, max_temp, avg_relative_humidity, total_precipitation
        FROM daily_climate""",
    ),
    "stg_datasus__admissions": (
        ("clean",),
        """SELECT aih_number, municipality_residence_code, admission_date, primary_diagnosis,
        total_aih_value, CAST(length_of_stay AS INTEGER) AS length_of_stay FROM clean""",
    ),
    "int_datasus__admissions_enriched": (
        ("stg_datasus__admissions",),
        "SELECT *, left(primary_diagnosis, 3) AS icd_group FROM stg_datasus__admissions",
    ),
    "dim_date": (
        (),
        """SELECT date_day, year(date_day) AS year, month(date_day) AS month,
        day(date_day) AS day, dayofweek(date_day) AS day_of_week,
        strftime(date_day, '%B') AS month_name,
        CASE (month(date_day) % 12) // 3 WHEN 0 THEN 'Summer' WHEN 1 THEN 'Autumn'
            WHEN 2 THEN 'Winter' WHEN 3 THEN 'Spring' END AS season
        FROM (SELECT CAST(unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE,
            INTERVAL 1 DAY)) AS DATE) AS date_day FROM orders)""",
    ),
    "dim_location": (
        ("stg_datasus__admissions", "municipalities"),
        """SELECT m.code AS ibge_code, s.municipality_name AS municipality, s.state,
        CASE s.state WHEN 'PR' THEN 'Sul' WHEN 'SP' THEN 'Sudeste' WHEN 'BA' THEN 'Nordeste'
            WHEN 'GO' THEN 'Centro-Oeste' ELSE 'Unknown' END AS region, s.latitude, s.longitude
        FROM (SELECT DISTINCT municipality_residence_code AS code FROM stg_datasus__admissions) m
        LEFT JOIN municipalities s ON m.code = s.ibge_code""",
    ),
    "dim_weather_station": (
        ("stg_inmet__daily_climate",),
        """SELECT DISTINCT station_code, station_name, state, latitude, longitude
        FROM stg_inmet__daily_climate""",
    ),
    "fct_respiratory_admissions": (
        ("int_datasus__admissions_enriched",),
        """SELECT aih_number, admission_date AS fk_date,
        municipality_residence_code AS fk_municipality, 1 AS admission_count, total_aih_value,
        length_of_stay, icd_group FROM int_datasus__admissions_enriched""",
    ),
    "fct_daily_climate": (
        ("stg_inmet__daily_climate",),
        """SELECT date_day AS fk_date, station_code AS fk_station, avg_temp, min_temp, max_temp,
        avg_relative_humidity, total_precipitation FROM stg_inmet__daily_climate""",
    ),
    "daily_admissions": (
        ("fct_respiratory_admissions",),
        """SELECT fk_date, fk_municipality,
        CAST(sum(admission_count) AS BIGINT) AS daily_admission_count,
        sum(total_aih_value) AS daily_total_aih_value, avg(length_of_stay) AS avg_length_of_stay
        FROM fct_respiratory_admissions GROUP BY fk_date, fk_municipality""",
    ),
    "admissions_by_station": (
        ("daily_admissions", "municipality_station_mapping"),
        """SELECT d.*, m.station_code FROM daily_admissions d
        LEFT JOIN municipality_station_mapping m ON d.fk_municipality = m.municipality_ibge_code""",
    ),
    "mart_climate_health_correlation": (
        ("admissions_by_station", "fct_daily_climate"),
        """SELECT coalesce(a.fk_date, c.fk_date) AS date_day,
        coalesce(a.station_code, c.fk_station) AS station_code, a.fk_municipality, c.avg_temp,
        c.min_temp, c.max_temp, c.avg_relative_humidity, c.total_precipitation,
        coalesce(a.daily_admission_count, 0) AS daily_admission_count, a.daily_total_aih_value,
        a.avg_length_of_stay
        FROM admissions_by_station a FULL JOIN fct_daily_climate c
        ON a.fk_date = c.fk_date AND a.station_code = c.fk_station""",
    ),
}


def sql(body: str, *reads: str) -> str:
    """``body`` with the relations it reads, and all those they read, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for below in RELATIONS[name][0]:
            add(below)
        if name not in order:
            order.append(name)

    for name in reads:
        add(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({RELATIONS[n][1]})" for n in order) + "\n" + body
