import math
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from climora import schemas
from climora.operators import lag, monitoring, rollups
from climora.plans import jobs, marts, staging
from climora.sources import sinks, tables

CLIMATE = (
    "fk_date date, fk_station string, avg_temp double, min_temp double, max_temp double,"
    " avg_relative_humidity double, total_precipitation double"
)
ADMISSIONS = (
    "aih_number string, fk_date date, fk_municipality string, admission_count int,"
    " total_aih_value double, length_of_stay int, icd_group string"
)


def d(n, month=1):
    return date(2024, month, n)


def climate(spark, *rows):
    return spark.createDataFrame([(day, s, t, t, t, None, None) for day, s, t in rows], CLIMATE)


def admissions(spark, *rows):
    full = [(str(i), day, m, 1, v, s, "J18") for i, (day, m, v, s) in enumerate(rows)]
    return spark.createDataFrame(full, ADMISSIONS)


@pytest.fixture
def mart(spark):
    facts = admissions(
        spark,
        (d(1), "m1", 10.0, 2), (d(1), "m1", None, 4),  # both sides, two admissions
        (d(1), "m2", 5.0, None),  # a second municipality on the same station
        (d(3), "m1", 7.0, 1),  # no climate that day
        (d(1), "unmapped", 1.0, 1), (None, "m1", 2.0, 1),
    )
    weather = climate(spark, (d(1), "A", 20.0), (d(2), "A", 22.0), (d(1), "Z", 5.0))
    mapping = spark.createDataFrame(
        [("m1", "A"), ("m2", "A")], "municipality_ibge_code string, station_code string"
    )
    return lambda *span: marts.correlation_mart(facts, weather, mapping, *span)


def test_mart_rows(mart):
    got = sorted((tuple(r)[:4] + tuple(r)[8:] for r in mart().collect()), key=str)
    assert got == sorted(
        [
            (d(1), "A", "m1", 20.0, 2, 10.0, 3.0),
            (d(1), "A", "m2", 20.0, 1, 5.0, None),
            (d(2), "A", None, 22.0, 0, None, None),
            (d(1), "Z", None, 5.0, 0, None, None),
            (d(3), "A", "m1", None, 1, 7.0, 1.0),
            (d(1), None, "unmapped", None, 1, 1.0, 1.0),
            (None, "A", "m1", None, 1, 2.0, 1.0),
        ],
        key=str,
    )


def test_mart_range_reaches_both_inputs(spark, mart):
    whole = mart().filter(F.col("date_day").between(d(2), d(3)))
    part = mart(d(2), d(3))
    assert sorted(part.collect(), key=str) == sorted(whole.collect(), key=str)


def test_refresh_touches_its_months_only(spark, tmp_path):
    path = str(tmp_path / "mart")
    mapping = spark.createDataFrame([("m1", "A")], "municipality_ibge_code string, station_code string")
    facts = admissions(spark, (d(5), "m1", 1.0, 1), (d(5, 2), "m1", 1.0, 1), (None, "m1", 1.0, 1))
    before = climate(spark, (d(5), "A", 1.0), (d(29, 2), "A", 2.0), (d(1, 3), "A", 3.0))
    after = climate(spark, (d(5), "A", 9.0), (d(29, 2), "A", 9.0), (d(1, 3), "A", 9.0))
    whole = marts.correlation_mart(facts, before, mapping)
    assert whole.schema.simpleString() == schemas.MART.simpleString()
    sinks.write_mart(whole, path)
    for _ in range(2):
        assert jobs.refresh_mart(facts, after, mapping, path, (2024, 2), (2024, 2)) == 2
    got = tables.read_mart(spark, path).collect()
    assert sorted(((r.date_day, r.avg_temp, r.daily_admission_count) for r in got), key=str) == sorted(
        [(d(5), 1.0, 1), (d(5, 2), None, 1), (d(29, 2), 9.0, 0), (d(1, 3), 3.0, 0), (None, None, 1)],
        key=str,
    )


def test_rollups(spark, mart):
    got = [tuple(r) for r in rollups.points(mart(d(1), d(31)), "weekly").collect()]
    assert got == [("2024-01-01", pytest.approx((20 + 20 + 22 + 5) / 4), 5)]
    assert [r.label for r in rollups.labelled_points(mart(d(1), d(31)), None).collect()] == ["Jan 2024"]
    assert rollups.last_updated(mart()).first()[0] == "2024-01-03"
    assert rollups.last_updated(mart().limit(0)).first()[0] is None


def test_sunday_and_monday_fall_into_different_weeks(spark):
    rows = climate(spark, (d(7), "A", 1.0), (d(8), "A", 3.0))
    mart = marts.correlation_mart(
        admissions(spark), rows,
        spark.createDataFrame([], "municipality_ibge_code string, station_code string"),
    )
    got = [tuple(r) for r in rollups.points(mart, "weekly").collect()]
    assert got == [("2024-01-01", 1.0, 0), ("2024-01-08", 3.0, 0)]
    assert [tuple(r) for r in rollups.points(mart, "other").collect()] == [("2024-01-01", 2.0, 0)]


def test_station_days_count_once(spark):
    weather = climate(spark, (d(1), "A", 20.0), (d(1), "B", 10.0))
    facts = admissions(spark, (d(1), "m1", 1.0, 1), (d(1), "m2", 1.0, 1), (d(1, 2), "m1", 1.0, 1))
    got = rollups.rollup_by_station_day(weather, facts).orderBy("period").collect()
    assert [tuple(r) for r in got] == [("2024-01-01", 15.0, 2), ("2024-02-01", None, 1)]


def test_date_dimension(spark):
    bounds = spark.sql("SELECT DATE'2020-01-01' AS start_date, DATE'2021-01-01' AS end_date")
    rows = marts.date_dimension(bounds)
    assert rows.count() == 366
    first = rows.filter("date_day = DATE'2020-12-06'").first()
    assert tuple(first) == (date(2020, 12, 6), 2020, 12, 6, 0, "December", "Summer")
    default = marts.dim_date(spark, date(2024, 2, 29)).agg(F.min("date_day"), F.max("date_day")).first()
    assert tuple(default) == (date(2020, 1, 1), date(2025, 2, 27))


def test_location_without_reference_data(spark):
    staged = spark.createDataFrame([("410690",), ("999999",), ("410690",)], "municipality_residence_code string")
    seed = spark.createDataFrame([("410690", "Curitiba", "PR", -25.4, -49.3)], schemas.MUNICIPALITIES)
    got = sorted(tuple(r) for r in marts.dim_location(staged, seed).collect())
    assert got == [
        ("410690", "Curitiba", "PR", "Sul", -25.4, -49.3), ("999999", None, None, "Unknown", None, None),
    ]


def staged_climate(spark, *rows):
    full = [(s, day, name, "PR", lat, 1.0, None, None, None, None, None) for s, day, name, lat in rows]
    return staging.stage_daily_climate(spark.createDataFrame(full, schemas.DAILY_CLIMATE))


def test_changed_station_attributes(spark):
    staged = staged_climate(spark, ("A", d(1), "OLD", 5.0), ("A", d(2), "NEW", None), ("A", d(3), "NEW", None))
    assert marts.dim_weather_station(staged).count() == 2
    assert [tuple(r) for r in marts.latest_station_attributes(staged).collect()] == [("A", "NEW", "PR", 5.0, 1.0)]


def test_staging_is_strict_and_rounds_the_stay(spark):
    columns = [f.name for f in schemas.ADMISSIONS if f.name != "admission_month"]
    raw = spark.createDataFrame(
        [("1", "410690", "2024-01-05", "J189", "10.5", 2.5), ("2", "410690", "2024-01-05", "J189", "1", 3.5)],
        "a string, b string, c string, d string, e string, f double",
    ).toDF(*columns)
    staged = staging.enrich_admissions(staging.stage_admissions(raw))
    got = sorted(staged.collect())
    assert [(r.length_of_stay, r.total_aih_value, r.icd_group) for r in got] == [(2, 10.5, "J18"), (4, 1.0, "J18")]
    bad = raw.withColumn("admission_date", F.lit("soon"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_admissions(bad).collect()


def test_regional_rollup(spark, mart):
    locations = spark.createDataFrame([("m1", "PR"), ("m2", "SP")], "ibge_code string, state string")
    stations = spark.createDataFrame([("A", "PR"), ("Z", "BA")], "station_code string, state string")
    got = rollups.regional_rollup(mart(d(1), d(31)), locations, stations)
    assert sorted((tuple(r)[1:] for r in got.collect()), key=str) == sorted(
        [
            ("Sul", "PR", 21.0, 3), ("Sudeste", "SP", 20.0, 1), ("Nordeste", "BA", 5.0, 0),
            ("Unknown", None, None, 1),
        ],
        key=str,
    )


def correlation(xs, ys):
    n = len(xs)
    mx, my = sum(xs) / n, sum(ys) / n
    cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    return cov / math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))


def test_lagged_correlation_against_brute_force(spark):
    temps = {d(1) + timedelta(days=i): float((i * 7) % 13) for i in range(30) if i not in (4, 9)}
    counts = {d(1) + timedelta(days=i): (i * 5) % 11 for i in range(30) if i % 6}
    rows = [
        (day, "A", m, temps.get(day), n)
        for day in sorted(temps.keys() | counts.keys())
        for m, n in (("m1", counts.get(day, 0)), ("m2", 1))
    ]
    rows.append((d(5), None, "m3", None, 9))
    mart = spark.createDataFrame(
        rows, "date_day date, station_code string, fk_municipality string, avg_temp double, daily_admission_count long"
    )
    got = {r.lag_days: r.correlation for r in lag.lagged_correlation(mart, 3).collect()}
    last = max(temps.keys() | counts.keys())
    total = {r: sum(n for day, s, _, _, n in rows if day == r and s) for r in {x[0] for x in rows}}
    for k in range(4):
        pairs = [
            (t, total.get(day + timedelta(days=k), 0))
            for day, t in temps.items()
            if day + timedelta(days=k) <= last
        ]
        assert got[k] == pytest.approx(correlation(*zip(*pairs)))


def test_monitoring(spark):
    rows = spark.createDataFrame(
        [(d(i), "g") for i in range(1, 11) for _ in range(5 if i < 10 else 50)], "day date, g string"
    )
    odd = monitoring.volume_anomalies(rows, "day", "g", window_days=5).collect()
    assert [(r.day, r.row_count, r.expected) for r in odd] == [(d(10), 50, 5.0)]
    fresh = monitoring.freshness(rows, "day", d(12), 2).first()
    assert tuple(fresh) == (d(10), 2, False)
    assert tuple(monitoring.freshness(rows.limit(0), "day", d(12), 2).first()) == (None, None, True)
    assert monitoring.schema_drift(rows, rows.schema).count() == 0
    expected = spark.range(1).select(F.lit(1).alias("day"), F.lit(1.5).alias("x").cast("double")).schema
    drift = monitoring.schema_drift(rows, expected)
    assert sorted((tuple(r) for r in drift.collect()), key=str) == [
        ("day", "int", "date", 95), ("g", None, "string", 95), ("x", "double", None, 95),
    ]


def test_an_outage_is_an_anomaly(spark):
    days = [n for n in range(1, 25) if n not in (15, 16, 17)]
    rows = spark.createDataFrame([("g", date(2024, 1, n)) for n in days for _ in range(5 + n % 2)], "g string, day date")
    odd = monitoring.volume_anomalies(rows, "day", "g", window_days=5).collect()
    assert (date(2024, 1, 15), 0) in {(r.day, r.row_count) for r in odd}
