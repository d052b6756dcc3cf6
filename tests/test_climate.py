from datetime import date

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from climora.operators.climate import (
    aggregate_daily,
    daily_measures,
    for_stations,
    normalize_readings,
    readings_per_station,
    within_dates,
)
from climora.schemas import HOURLY_FIELDS

READING = (
    "station_code string, date date, station_name string, state string, latitude double,"
    " longitude double, temp_instant double, temp_max double, temp_min double,"
    " humidity_instant double, precipitation double, read_order long"
)
DAY = date(2024, 5, 1)


def reading(order, instant=None, high=None, low=None, humidity=None, rain=None, station="A807",
            name="CURITIBA", state="PR", lat=-25.42, lon=-49.26, day=DAY):
    return (station, day, name, state, lat, lon, instant, high, low, humidity, rain, order)


def daily(spark, *rows):
    frame = spark.createDataFrame(list(rows), READING)
    one = frame.groupBy("station_code", "date").agg(*daily_measures())
    two = aggregate_daily(frame)
    assert sorted(one.collect(), key=str) == sorted(two.collect(), key=str)
    return sorted((r.asDict() for r in two.collect()), key=lambda r: (r["station_code"], r["date"]))


def measures(row):
    return [row[c] for c in ("avg_temp", "min_temp", "max_temp", "avg_relative_humidity", "total_precipitation")]


def test_metrics(spark):
    rows = daily(spark, reading(1, 15.0, 20.0, 10.0, 70.0, 1.0), reading(2, 25.0, 26.0, 12.0, 90.0))
    assert [measures(r) for r in rows] == [[20.0, 10.0, 26.0, 80.0, 1.0]]


def test_extremes_fall_back_to_instant_readings(spark):
    rows = daily(spark, reading(1, 12.0), reading(2, 18.0))
    assert measures(rows[0]) == [15.0, 12.0, 18.0, None, None]


def test_fallback_only_without_any_hourly_extreme(spark):
    rows = daily(spark, reading(1, low=5.0), reading(2, 1.0), reading(3, 9.0, high=7.0))
    assert measures(rows[0])[:3] == [5.0, 5.0, 7.0]


def test_metadata_is_the_first_known_value_per_column(spark):
    blank = dict(name=None, state=None, lat=None, lon=None)
    rows = daily(
        spark,
        reading(3, 1.0, name="LATER", state="SC"),
        reading(1, 1.0, **blank),
        reading(2, 1.0, **{**blank, "name": "CURITIBA", "lat": -25.42}),
    )
    got = [rows[0][c] for c in ("station_name", "state", "latitude", "longitude")]
    assert got == ["CURITIBA", "SC", -25.42, -49.26]


def test_stations_and_days_are_apart(spark):
    rows = daily(
        spark, reading(1, 1.0), reading(2, 2.0, station="A999"), reading(3, 3.0, day=date(2024, 5, 2))
    )
    assert [(r["station_code"], r["date"].day, r["avg_temp"]) for r in rows] == [
        ("A807", 1, 1.0), ("A807", 2, 3.0), ("A999", 1, 2.0),
    ]


def test_no_readings(spark):
    assert daily(spark) == []


def hourly(spark, *changes):
    base = dict(zip(HOURLY_FIELDS, (
        "A807", "CURITIBA", "PR", "-25.42", "-49.26", "2024-05-01", "18,4", "19.0", "17.5", "80", "0.2",
    )))
    schema = ", ".join(f"{f} string" for f in HOURLY_FIELDS)
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], schema)


def test_normalized_numbers(spark):
    row = normalize_readings(hourly(spark, {})).first()
    assert tuple(row) == ("A807", DAY, "CURITIBA", "PR", -25.42, -49.26, 18.4, 19.0, 17.5, 80.0, 0.2)


def test_missing_values_become_null(spark):
    for gap in (None, ""):
        holes = {f: gap for f in HOURLY_FIELDS if f not in ("CD_ESTACAO", "DT_MEDICAO")}
        assert tuple(normalize_readings(hourly(spark, holes)).first()) == ("A807", DAY) + (None,) * 9


def test_readings_without_a_date_are_dropped_and_counted(spark):
    dropped = Observation("dropped")
    rows = normalize_readings(
        hourly(spark, {}, {"DT_MEDICAO": ""}, {"DT_MEDICAO": None}), dropped
    )
    assert len(rows.collect()) == 1
    assert dropped.get["no_date"] == 2


def test_a_malformed_date_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        normalize_readings(hourly(spark, {"DT_MEDICAO": "yesterday"})).collect()


def test_filters(spark):
    rows = spark.createDataFrame(
        [reading(i, day=date(2024, 5, i), station=f"A{i}") for i in range(1, 6)], READING
    )
    kept = within_dates(rows, "date", date(2024, 5, 2), date(2024, 5, 4))
    assert sorted(r.station_code for r in kept.collect()) == ["A2", "A3", "A4"]
    assert within_dates(rows, "date", None, date(2024, 5, 1)).count() == 1
    wanted = spark.createDataFrame([("A2",), ("A2",), ("A9",)], "station_code string")
    assert [r.station_code for r in for_stations(rows, wanted).collect()] == ["A2"]
    assert for_stations(rows, ("A1", "A9")).count() == 1
    with pytest.raises(ValueError):
        for_stations(rows, ())
    counts = {r.station_code: r.readings for r in readings_per_station(rows, wanted).collect()}
    assert counts == {"A2": 1, "A9": 0}


def test_one_station_day_with_most_readings_is_combined_before_the_shuffle(spark):
    plan = aggregate_daily(
        spark.range(10).select(
            F.lit("A").alias("station_code"), F.lit(DAY).alias("date"),
            *[F.lit(None).cast(t).alias(c) for c, t in (
                ("station_name", "string"), ("state", "string"), ("latitude", "double"),
                ("longitude", "double"), ("temp_instant", "double"), ("temp_max", "double"),
                ("temp_min", "double"), ("humidity_instant", "double"), ("precipitation", "double"))],
            F.col("id").alias("read_order"),
        )
    )._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "partial_sum" in plan
