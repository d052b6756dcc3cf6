import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import types as T

from climora.operators import monitoring
from climora.plans import jobs

FIRST, AS_OF = date(2024, 1, 1), date(2024, 6, 3)


def brute(counts, first, as_of, weeks, limit, silence):
    found = set()
    for group, days in counts.items():
        inside = {d: n for d, n in days.items() if first <= d < as_of}
        if not inside:
            continue
        day, heard = min(inside), None
        start = day
        while day < as_of:
            n = inside.get(day, 0)
            heard = day if n else heard
            past = [inside.get(day - timedelta(weeks=w), 0) for w in range(1, weeks + 1) if day - timedelta(weeks=w) >= start]
            kind = None
            if len(past) == weeks:
                middle = statistics.median(past)
                spread = max(1.4826 * statistics.median(abs(p - middle) for p in past), middle**0.5, 1)
                kind = "low" if n < middle - limit * spread else "high" if n > middle + limit * spread else None
            if (day - heard).days >= silence:
                kind = "silent"
            if kind:
                found.add((group, day, n, (day - heard).days, kind))
            day += timedelta(days=1)
    return found


def feed(spark, counts):
    rows = [(d, g) for g, days in counts.items() for d, n in days.items() for _ in range(n)]
    return spark.createDataFrame(rows, "day date, g string")


def found(frame):
    return {(r.group_key, r.day, r.row_count, r.silent_days, r.kind) for r in frame.collect()}


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    days = [date(2023, 12, 1) + timedelta(days=n) for n in range(230)]
    counts = {
        g: {d: (2 if d.weekday() == 6 else rng.choice([9, 10, 11, 12, 30])) for d in days if rng.random() < 0.97 and not (g == "b" and 100 < (d - days[0]).days < 112)}
        for g in ("a", "b", None)
    }
    got = found(monitoring.feed_anomalies(feed(spark, counts), "day", "g", AS_OF, FIRST, weeks=5, limit=3.0, silence=2))
    assert got == brute(counts, FIRST, AS_OF, 5, 3.0, 2)
    assert {k for *_, k in got} == {"low", "high", "silent"}


def test_a_feed_that_stopped_is_seen_until_today(spark):
    days = [FIRST + timedelta(days=n) for n in range(60)]
    got = found(monitoring.feed_anomalies(feed(spark, {"a": {d: 5 for d in days}}), "day", "g", AS_OF, FIRST))
    last = days[-1]
    silent = {d for _, d, _, _, kind in got if kind == "silent"}
    assert silent == {last + timedelta(days=n) for n in range(3, (AS_OF - last).days)}
    # Long after the silence has become usual for every weekday.
    assert max(silent) == AS_OF - timedelta(days=1)


def test_weekly_dips_and_steady_feeds_are_no_news(spark):
    days = [FIRST + timedelta(days=n) for n in range((AS_OF - FIRST).days)]
    dips = {"a": {d: 1 if d.weekday() == 6 else 40 for d in days}}
    assert found(monitoring.feed_anomalies(feed(spark, dips), "day", "g", AS_OF, FIRST)) == set()
    dips["a"][days[-3]] = 4  # one workday like a Sunday
    assert {k for *_, k in found(monitoring.feed_anomalies(feed(spark, dips), "day", "g", AS_OF, FIRST))} == {"low"}


def test_stray_dates_do_not_stretch_the_calendar(spark):
    days = {FIRST + timedelta(days=n): 5 for n in range((AS_OF - FIRST).days)}
    strays = {"a": {**days, date(1900, 1, 1): 1, date(2999, 1, 1): 1}}
    assert found(monitoring.feed_anomalies(feed(spark, strays), "day", "g", AS_OF, FIRST)) == set()
    assert found(monitoring.feed_anomalies(feed(spark, {"a": {date(1900, 1, 1): 1}}), "day", "g", AS_OF, FIRST)) == set()
    assert monitoring.feed_anomalies(feed(spark, {"a": days}).limit(0), "day", "g", AS_OF, FIRST).count() == 0


def test_job_keeps_what_it_sees_per_day(spark, tmp_path):
    days = {FIRST + timedelta(days=n): 5 for n in range((AS_OF - FIRST).days)}
    steady, stopped = feed(spark, {"a": days}), feed(spark, {"a": days, "b": {d: n for d, n in days.items() if d < date(2024, 5, 20)}})
    path = str(tmp_path / "w")
    found = jobs.watch_feeds([jobs.Feed("old", stopped.where("g = 'b'"), "day", "g", 5), jobs.Feed("new", steady, "day", "g", 5)], path, AS_OF, FIRST)
    assert {(r.feed, r.kind) for r in found.collect()} >= {("old", "stale"), ("old", "silent")}
    assert all(r.feed == "old" for r in found.collect()) and found.columns == ["feed", "group_key", "day", "kind", "row_count", "expected"]
    later = jobs.watch_feeds([jobs.Feed("new", steady, "day", "g", 5)], path, AS_OF + timedelta(days=1), FIRST)
    assert {r.kind for r in later.collect()} <= {"low"}
    again = jobs.watch_feeds([jobs.Feed("new", steady, "day", "g", 5)], path, AS_OF, FIRST)
    assert again.count() == 0  # the second run of a day replaces the first


def test_drift_is_read_from_every_file(spark, tmp_path):
    expected = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "part")])
    path = str(tmp_path / "t")
    spark.createDataFrame([("1", "2", "x"), ("1", "2", "y")], expected).write.partitionBy("part").parquet(path)
    assert monitoring.file_drift(spark, path, expected, ("part",)).count() == 0
    # One file of a folder among others of the right make.
    spark.createDataFrame([(1, "x")], "a int, part string").write.mode("append").partitionBy("part").parquet(path)
    spark.createDataFrame([("1", 2.0, True, "z")], "a string, b double, c boolean, part string").write.mode("append").partitionBy("part").parquet(path)
    found = {(r.column, r.expected_type, r.actual_type): r.folders for r in monitoring.file_drift(spark, path, expected, ("part",)).collect()}
    assert found == {
        ("a", "string", "int"): 1, ("b", "string", None): 1, ("b", "string", "double"): 1, ("c", None, "boolean"): 1,
    }
