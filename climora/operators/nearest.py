"""Nearest station of each place, by great-circle distance, without comparing every place with every station.

Stations are put into square cells of latitude and longitude, at levels whose cells are halved from one to the next until few stations
share a cell. Going down the levels, a place keeps the cells that can hold its nearest station: those whose border is no
further than the nearest of one known station of each cell. Levels are joined on the cell, so a place meets the four parts of
the cells that it has kept, and in the end the stations of a few of the smallest, whether these lie around it or a continent away.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from climora.session import staged

EARTH_KM = 6371.0088
# Degrees of the largest cells, of which there are 18 at most, and stations that the smallest may share.
WIDEST = 64.0
CROWDED = 16
_NARROWEST = 1e-6
# What rounding may add to a distance, in kilometres.
_SLACK = 1e-6


def great_circle_km(lat: Column, lon: Column, other_lat: Column, other_lon: Column) -> Column:
    """Distance by the haversine formula, in kilometres."""
    up = F.sin(F.radians(other_lat - lat) / 2)
    over = F.sin(F.radians(other_lon - lon) / 2)
    return 2 * EARTH_KM * F.asin(F.least(F.lit(1.0), F.sqrt(up * up + F.cos(F.radians(lat)) * F.cos(F.radians(other_lat)) * over * over)))


def _cell(degrees: Column, width: float) -> Column:
    return F.floor(degrees / width).cast("long")


def _border_km(lat: Column, lon: Column, y: Column, x: Column, width: float) -> Column:
    """What everything in a cell is away at least: the distance to its nearer parallel, or to its nearer meridian."""
    south, west = y * width, x * width
    up = F.greatest(south - lat, lat - (south + width), F.lit(0.0))
    past = F.pmod(lon - west, F.lit(360.0))  # degrees east of its west side, around the earth
    over = F.when(past <= width, 0.0).otherwise(F.least(past - width, 360.0 - past, F.lit(90.0)))
    return EARTH_KM * F.greatest(F.radians(up), F.asin(F.abs(F.cos(F.radians(lat))) * F.sin(F.radians(over))))


def _cells(posts: DataFrame, width: float) -> DataFrame:
    """Cells that hold stations, with the place of one of them."""
    one = F.min(F.struct("at_lat", "at_lon"))
    return posts.groupBy(_cell(F.col("at_lat"), width).alias("y"), _cell(F.col("at_lon"), width).alias("x")).agg(
        F.count(F.lit(1)).alias("stations"), one.alias("one")
    )


def _widths(posts: DataFrame) -> list[float]:
    """Widths of the levels: halved until no cell holds more than ``CROWDED`` stations, which lie at different places."""
    widths = [WIDEST]
    while (_cells(posts, widths[-1]).agg(F.max("stations")).first()[0] or 0) > CROWDED and widths[-1] > _NARROWEST:
        widths.append(widths[-1] / 2)
    return widths


def _kept(cells: DataFrame, width: float) -> DataFrame:
    """Of the cells of each place those that can hold its nearest station."""
    here = (F.col("lat"), F.col("lon"))
    low = _border_km(*here, F.col("y"), F.col("x"), width)
    high = great_circle_km(*here, F.col("one.at_lat"), F.col("one.at_lon"))
    bound = F.min(high).over(W.partitionBy("lat", "lon"))
    return cells.withColumn("far", low > bound + _SLACK).where("NOT far").select("lat", "lon", "y", "x")


def nearest_stations(places: DataFrame, stations: DataFrame, place: str = "ibge_code") -> DataFrame:
    """Columns ``place``, station_code, distance_km: the nearest station of each place, the smaller code among equals.

    ``places`` holds ``place``, latitude and longitude (degrees, longitude from -180 to 180), ``stations`` holds station_code, latitude and
    longitude. Places without coordinates, and all if there are no stations, get NULL; stations without coordinates, or with ones that are
    no number, do not count. Repeated places get a row each.
    """
    def known(lat: str, lon: str) -> Column:
        return F.col(lat).isNotNull() & F.col(lon).isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)

    posts = staged(
        stations.select(F.col("latitude").cast("double").alias("at_lat"), F.col("longitude").cast("double").alias("at_lon"), "station_code")
        .where(known("at_lat", "at_lon")).groupBy("at_lat", "at_lon").agg(F.min("station_code").alias("station_code")),
        "stations",
    )
    plain = places.select(place, F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"))
    widths = _widths(posts)
    top = _cells(posts, widths[0]).select("y", "x", "one").collect()  # 18 cells at most
    if not top:
        return plain.select(place, F.lit(None).cast("string").alias("station_code"), F.lit(None).cast("double").alias("distance_km"))
    roots = F.array(*[
        F.struct(F.lit(c.y).alias("y"), F.lit(c.x).alias("x"), F.struct(F.lit(c.one.at_lat).alias("at_lat"), F.lit(c.one.at_lon).alias("at_lon")).alias("one"))
        for c in top
    ])
    spots = plain.where(known("lat", "lon")).select("lat", "lon").distinct()
    kept = _kept(spots.select("lat", "lon", F.inline(roots)), widths[0])
    for width in widths[1:]:
        parts = _cells(posts, width).select("y", "x", "one", F.floor(F.col("y") / 2).alias("above_y"), F.floor(F.col("x") / 2).alias("above_x"))
        inside = kept.select("lat", "lon", F.col("y").alias("above_y"), F.col("x").alias("above_x"))
        kept = _kept(inside.join(parts, ["above_y", "above_x"]), width)
    last = posts.select("*", _cell(F.col("at_lat"), widths[-1]).alias("y"), _cell(F.col("at_lon"), widths[-1]).alias("x"))
    distance = great_circle_km(F.col("lat"), F.col("lon"), F.col("at_lat"), F.col("at_lon"))
    near = kept.join(last, ["y", "x"]).groupBy("lat", "lon").agg(
        F.min(F.struct(distance.alias("distance_km"), F.col("station_code"))).alias("near")
    )
    return plain.join(near, ["lat", "lon"], "left").select(place, "near.station_code", "near.distance_km")
