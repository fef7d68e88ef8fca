"""The k nearest places of each place, by a grid whose cells widen until the answer is certain.

Places are points of the unit sphere, so neither poles nor the date line need care. A round deals them into cubes of
one width; a place looks at its own cube and the 26 around it, which hold everything nearer than the width. It is
done once its k-th neighbour is that near; the others go on with cubes twice as wide, up to the whole globe. The first
width is made small enough for the fullest cube to hold few places, and places with the same coordinates are one
point, so crowded spots are done in the early rounds and the wide cubes are looked at from empty regions only.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from math import asin

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logilake.functions import geo
from logilake.session import stage

CROWD = 256  # points in the fullest cube of the first round
FIRST_WIDTH = 0.25
DIGITS = 6  # kilometres are compared to a millimetre
_AXES = ("_x", "_y", "_z")


def _on_sphere(lat: Column, lon: Column) -> dict[str, Column]:
    phi, theta = F.radians(lat), F.radians(lon)
    return dict(zip(_AXES, (F.cos(phi) * F.cos(theta), F.cos(phi) * F.sin(theta), F.sin(phi))))


def _cell(width: float) -> list[Column]:
    return [F.floor(F.col(axis) / width).alias(f"_c{axis}") for axis in _AXES]


_CELL = [f"_c{axis}" for axis in _AXES]


def _first_width(points: DataFrame) -> float:
    """A width whose fullest cube holds at most CROWD points; one small figure per trial."""
    width = FIRST_WIDTH
    while width > 1e-9:
        fullest = points.groupBy(*_cell(width)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if fullest <= CROWD:
            break
        width /= 4
    return width


def nearest(
    places: DataFrame, among: DataFrame, k: int, key: str = "location_id", lat: str = "lat", lon: str = "lon", others_only: bool = True
) -> DataFrame:
    """(key, rank from 1, neighbour, distance_km): for each place the k nearest of ``among``, ties by their key.

    With ``others_only`` a place is no neighbour of itself. Places without coordinates have no neighbours and are
    none; fewer than k rows come back only where ``among`` has no more. Rows that repeat a key count once.
    """
    known = among.select(F.col(key).alias("neighbour"), F.col(lat).cast("double").alias("_lat"), F.col(lon).cast("double").alias("_lon"))
    by_point = Window.partitionBy("_lat", "_lon").orderBy("neighbour")
    wanted = k + 1 if others_only else k
    known = known.dropna().distinct().withColumn("_n", F.row_number().over(by_point)).where(F.col("_n") <= wanted).drop("_n")
    known = stage(known.withColumns(_on_sphere(F.col("_lat"), F.col("_lon"))), "nearest-places").rows
    asking = places.select(F.col(key), F.col(lat).cast("double").alias("_plat"), F.col(lon).cast("double").alias("_plon")).dropna().distinct()
    points = asking.select("_plat", "_plon").distinct().withColumns(_on_sphere(F.col("_plat"), F.col("_plon")))
    left = stage(points, "nearest-points").rows

    around = F.array(*[F.struct(*[F.lit(o).alias(a) for o, a in zip(offset, _AXES)]) for offset in product((-1, 0, 1), repeat=3)])
    closest = Window.partitionBy("_plat", "_plon").orderBy("distance_km", "neighbour")
    km = F.round(geo.haversine_km(F.col("_plat"), F.col("_plon"), F.col("_lat"), F.col("_lon")), DIGITS)
    width, done = _first_width(known.select(*_AXES)), []
    while not left.isEmpty():
        whole = width >= 2
        covered = float("inf") if whole else 2 * geo.EARTH_RADIUS_KM * asin(width / 2) - 1e-5
        probes = left.select("_plat", "_plon", *_cell(width), F.explode(around).alias("_o"))
        probes = probes.select("_plat", "_plon", *[(F.col(c) + F.col(f"_o.{a}")).alias(c) for c, a in zip(_CELL, _AXES)])
        near = probes.join(known.select("neighbour", "_lat", "_lon", *_cell(width)), _CELL)
        near = near.select("_plat", "_plon", "neighbour", km.alias("distance_km")).where(F.col("distance_km") <= covered)
        near = near.withColumn("_r", F.row_number().over(closest)).where(F.col("_r") <= wanted).drop("_r")
        found = stage(near, "nearest-found").rows
        if whole:
            done.append(found)
            break
        full = found.groupBy("_plat", "_plon").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= wanted)
        full = stage(full.select("_plat", "_plon"), "nearest-done").rows
        done.append(found.join(full, ["_plat", "_plon"], "left_semi"))
        left = stage(left.join(full, ["_plat", "_plon"], "left_anti"), "nearest-points").rows
        width *= 2
    if not done:
        return asking.select(key, F.lit(0).alias("rank"), F.col(key).alias("neighbour"), F.lit(0.0).alias("distance_km")).limit(0)
    pairs = asking.join(reduce(DataFrame.unionByName, done), ["_plat", "_plon"])
    if others_only:
        pairs = pairs.where(F.col(key) != F.col("neighbour"))
    rank = F.row_number().over(Window.partitionBy(key, "_plat", "_plon").orderBy("distance_km", "neighbour"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select(key, "rank", "neighbour", "distance_km")
