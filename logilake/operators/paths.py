"""Shortest ways over measured lanes, for lanes in use that nobody measured.

A distributed relaxation: ways start at the origins that lack a lane, and each round extends only the ways that the
round before improved (the frontier) by one measured lane. A way that is no better than all the wanted ones of its
origin is not extended. Rounds are staged in the shared folder; a round costs one join with the lanes and one with the
known ways of the frontier's origins. It ends when nothing improves, which takes at most as many rounds as the longest
of the shortest ways has lanes: cycles never improve anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logilake.session import stage

ORIGIN, DEST = "origin_location_id", "dest_location_id"


def _cost(duration: Column, distance: Column, hops: Column) -> Column:
    """Ways are compared by time, then by length, then by their number of lanes."""
    return F.struct(duration.alias("duration_s"), distance.alias("distance_m"), hops.alias("hops"))


def fill_lanes(lanes: DataFrame, network: DataFrame) -> DataFrame:
    """Figures of all lanes: as measured, or the quickest way over measured lanes; null where none leads there.

    ``network`` has ``duration_s`` and ``distance_m`` per lane, none below zero; measurements without a time are left
    out, and of several the quickest counts. ``hops`` is the number of lanes of the way, 1 if measured, 0 from a place
    to itself.
    """
    cost = _cost(F.col("duration_s"), F.coalesce("distance_m", F.lit(0)), F.lit(1))
    best = network.where(f"duration_s IS NOT NULL AND {ORIGIN} IS NOT NULL AND {DEST} IS NOT NULL").groupBy(ORIGIN, DEST).agg(F.min(cost).alias("cost"))
    edges = stage(best, "lanes").rows
    pairs = lanes.select(ORIGIN, DEST).distinct()
    measured = pairs.join(edges, [ORIGIN, DEST], "left")
    zero = F.when(F.col(ORIGIN) == F.col(DEST), _cost(F.lit(0).cast(_type(edges, "duration_s")), F.lit(0).cast(_type(edges, "distance_m")), F.lit(0)))
    measured = stage(measured.withColumn("cost", F.coalesce("cost", zero)), "lanes-in-use").rows
    wanted = stage(measured.where(f"cost IS NULL AND {ORIGIN} IS NOT NULL AND {DEST} IS NOT NULL").select(ORIGIN, DEST), "lanes-wanted").rows
    if wanted.isEmpty():
        return _figures(measured)
    origins = wanted.select(ORIGIN).distinct()
    known = stage(edges.join(origins, ORIGIN, "left_semi"), "ways").rows
    frontier = known
    step = edges.select(F.col(ORIGIN).alias(DEST), F.col(DEST).alias("_to"), F.col("cost").alias("_lane"))
    while not frontier.isEmpty():
        reached = wanted.join(known, [ORIGIN, DEST], "left").groupBy(ORIGIN)
        # The slowest wanted way of an origin, once all are known.
        bound = reached.agg(F.when(F.count_if(F.col("cost").isNull()) == 0, F.max("cost")).alias("bound"))
        longer = frontier.join(step, DEST).where(F.col("_to") != F.col(ORIGIN))
        longer = longer.select(ORIGIN, F.col("_to").alias(DEST), _cost(*[F.col(f"cost.{c}") + F.col(f"_lane.{c}") for c in ("duration_s", "distance_m", "hops")]).alias("cost"))
        longer = longer.join(bound, ORIGIN).where("bound IS NULL OR cost < bound").groupBy(ORIGIN, DEST).agg(F.min("cost").alias("cost"))
        before = known.withColumnRenamed("cost", "_before")
        improved = longer.join(before, [ORIGIN, DEST], "left").where("_before IS NULL OR cost < _before").select(ORIGIN, DEST, "cost")
        frontier = stage(improved, "ways-improved").rows
        known = stage(known.unionByName(frontier).groupBy(ORIGIN, DEST).agg(F.min("cost").alias("cost")), "ways").rows
    ways = wanted.join(known, [ORIGIN, DEST], "left")
    rest = measured.where(f"cost IS NOT NULL OR {ORIGIN} IS NULL OR {DEST} IS NULL")
    return _figures(rest.unionByName(ways))


def _type(edges: DataFrame, field: str) -> str:
    return edges.select(f"cost.{field}").dtypes[0][1]


def _figures(df: DataFrame) -> DataFrame:
    return df.select(ORIGIN, DEST, "cost.duration_s", "cost.distance_m", "cost.hops")
