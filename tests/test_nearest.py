import math
import random

import pytest

from climora.operators import nearest as N

PLACES = "ibge_code string, latitude double, longitude double"
POSTS = "station_code string, latitude double, longitude double"


def km(a, b):
    up, over = math.sin(math.radians(b[0] - a[0]) / 2), math.sin(math.radians(b[1] - a[1]) / 2)
    return 2 * N.EARTH_KM * math.asin(min(1, math.sqrt(up * up + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * over * over)))


def holds(spark, places, posts):
    got = N.nearest_stations(spark.createDataFrame(places, PLACES), spark.createDataFrame(posts, POSTS))
    assert "NestedLoop" not in (plan := got._jdf.queryExecution().executedPlan().toString()) and "Cartesian" not in plan
    found = {r.ibge_code: (r.station_code, r.distance_km) for r in got.collect()}
    assert len(found) == len(places)
    for code, lat, lon in places:
        station, distance = found[code]
        best = min(km((lat, lon), (y, x)) for _, y, x in posts)
        assert distance == pytest.approx(best, abs=1e-6)
        assert km((lat, lon), next((y, x) for s, y, x in posts if s == station)) == pytest.approx(best, abs=1e-6)


def points(rng, n, name, lat=(-34, 6), lon=(-74, -34)):
    return [(f"{name}{i}", rng.uniform(*lat), rng.uniform(*lon)) for i in range(n)]


@pytest.mark.parametrize("crowded", [1, 4, 100])
def test_equals_brute_force_over_a_country(spark, monkeypatch, crowded):
    monkeypatch.setattr(N, "CROWDED", crowded)
    rng = random.Random(1)
    holds(spark, points(rng, 80, "m"), points(rng, 25, "s"))


@pytest.mark.parametrize("crowded", [1, 100])
def test_stations_far_away_and_over_the_date_line(spark, monkeypatch, crowded):
    monkeypatch.setattr(N, "CROWDED", crowded)
    rng = random.Random(2)
    around = points(rng, 40, "m", (-89, 89), (-180, 180)) + [("west", 10.0, -179.9), ("east", 10.0, 179.9), ("pole", 89.99, 0.0)]
    holds(spark, around, [("a", 10.0, 179.5), ("b", -80.0, 20.0), ("c", 89.5, 179.0), ("d", 10.0, -180.0)])


def test_many_stations_in_one_town_far_from_most_places(spark, monkeypatch):
    monkeypatch.setattr(N, "CROWDED", 2)
    rng = random.Random(3)
    posts = points(rng, 60, "s", (-20.01, -20.0), (-50.01, -50.0))
    holds(spark, points(rng, 15, "m", (-20.02, -20.0), (-50.02, -50.0)) + points(rng, 40, "far", (-80, 80), (-180, 180)), posts)


def test_ties_gaps_and_nothing(spark):
    places = [("1", 0.0, 0.0), ("2", None, 1.0), ("3", 0.0, float("nan")), ("1", 0.0, 0.0)]
    posts = [("b", 0.0, 1.0), ("a", 0.0, 1.0), ("c", 0.0, -1.0), ("x", None, 0.0), ("y", float("nan"), 0.0)]
    got = N.nearest_stations(spark.createDataFrame(places, PLACES), spark.createDataFrame(posts, POSTS)).collect()
    assert sorted((r.ibge_code, r.station_code) for r in got if r.station_code) == [("1", "a"), ("1", "a")]
    assert sorted(r.ibge_code for r in got if r.station_code is None) == ["2", "3"]
    none = N.nearest_stations(spark.createDataFrame(places[:1], PLACES), spark.createDataFrame([], POSTS)).collect()
    assert [(r.ibge_code, r.station_code, r.distance_km) for r in none] == [("1", None, None)]
    assert N.nearest_stations(spark.createDataFrame([], PLACES), spark.createDataFrame(posts, POSTS)).count() == 0
