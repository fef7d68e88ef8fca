"""Queries over places and lanes, tables stored for their joins, and documents with unknown fields."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logilake.catalog import adapters as a
from logilake.catalog.adapters import SQL_LANES, SQL_PLACES, Tables, ntz, rnd
from logilake.catalog.expressions import _documents
from logilake.catalog.registry import query
from logilake.catalog.tables import _FACT, _MOMENTS, ON_TIME_MIN
from logilake.operators import paths
from logilake.operators.nearest import nearest
from logilake.plans import dims, facts
from logilake.session import work_dir
from logilake.sources import readers, sinks
from logilake.sources.entities import ENTITIES


@query(
    "nearest_locations",
    f"""
    WITH {SQL_PLACES},
    h AS (SELECT a.location_id, b.location_id AS neighbour, least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2)) AS h
          FROM loc a JOIN loc b ON a.location_id <> b.location_id),
    k AS (SELECT location_id, neighbour, {rnd("2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h))", 6)} AS distance_km FROM h)
    SELECT location_id, CAST(row_number() OVER (PARTITION BY location_id ORDER BY distance_km, neighbour) AS INTEGER) AS rank, neighbour, distance_km FROM k QUALIFY rank <= 3
    """,
)
def nearest_locations(t: Tables) -> DataFrame:
    """The three nearest locations of every location."""
    places = a.locations(t).select("location_id", "lat", "lon")
    return nearest(places, places, 3)


def _twice(table: str) -> str:
    """Ways of up to twice as many lanes."""
    return (
        f"SELECT o, d, min(c) AS c FROM (SELECT * FROM {table} UNION ALL SELECT x.o, y.d, x.c + y.c FROM {table} x JOIN {table} y ON x.d = y.o) GROUP BY o, d"
    )


@query(
    "lanes_by_shortest_way",
    f"""
    WITH p AS (SELECT s_nationkey AS o, c_nationkey AS d, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS q
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY ALL),
    w0 AS (SELECT o, d, CAST((q % 500 + 60) * 1000000000000 + n * 100 * 1000 + 1 AS BIGINT) AS c FROM p WHERE n % 7 = 0),
    w1 AS ({_twice("w0")}), w2 AS ({_twice("w1")}), w3 AS ({_twice("w2")}), w4 AS ({_twice("w3")}), w5 AS ({_twice("w4")}),
    f AS (SELECT p.o, p.d, coalesce(w0.c, CASE WHEN p.o = p.d THEN 0 END, w5.c) AS c FROM p LEFT JOIN w0 ON w0.o = p.o AND w0.d = p.d LEFT JOIN w5 ON w5.o = p.o AND w5.d = p.d)
    SELECT 'N' || o AS origin_location_id, 'N' || d AS dest_location_id, CAST(c // 1000000000000 AS BIGINT) AS duration_s, CAST(c % 1000000000000 // 1000 AS BIGINT) AS distance_m, CAST(c % 1000 AS INTEGER) AS hops FROM f
    """,
)
def lanes_by_shortest_way(t: Tables) -> DataFrame:
    """Lanes between nations of which every seventh is measured; the others go over several."""
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity")
    lines = lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    lines = lines.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    use = lines.groupBy("s_nationkey", "c_nationkey").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("q"))
    use = use.select(
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias(paths.ORIGIN), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias(paths.DEST),
        "n", (F.col("q") % 500 + 60).alias("duration_s"), (F.col("n") * 100).alias("distance_m"),
    )
    return paths.fill_lanes(use, use.where("n % 7 = 0"))


def stored_trips(t: Tables, buckets: int | None = None) -> DataFrame:
    """The trip fact from two tables of the catalog, stored in buckets of the lane.

    A bucket is written and joined by one task, so their number follows that of the session's shuffles and of the tasks
    that read the lines, which grows with them.
    """
    if buckets is None:
        buckets = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), t.lineitem.rdd.getNumPartitions())
    trips = facts.located_trips(a.delivery_header(t), a.delivery_address(t), a.locations(t), a.warehouse_locations(t))
    for name, df in (("logi_located_trips", trips), ("logi_lanes", a.lanes(t))):
        sinks.publish_bucketed(df, name, work_dir(t.spark, name), facts.LANE_KEYS, buckets)
    located, lanes = (readers.table_or_path(t.spark, name, None) for name in ("logi_located_trips", "logi_lanes"))
    return facts.trips_on_lanes(located, lanes, ON_TIME_MIN)


@query(
    "stored_lane_join",
    f"""{_FACT} SELECT deliverydocument, addressid, addr_hash, origin_location_id, dest_location_id, picking_datetime_full, delivery_datetime_full, eta_predicted_ts,
      {rnd("eta_error_min", 6)} AS eta_error_min, {rnd("abs_eta_error_min", 6)} AS abs_eta_error_min, on_time_flag, {rnd("distance_km", 6)} AS distance_km, {rnd("network_duration_min", 6)} AS network_duration_min, record_date FROM fact""",
    ("record_date",),
)
def stored_lane_join(t: Tables) -> DataFrame:
    """The trip fact over stored tables that meet without a shuffle."""
    rounded = ("eta_error_min", "abs_eta_error_min", "distance_km", "network_duration_min")
    fact = stored_trips(t).withColumns({c: ntz(c) for c in _MOMENTS}).withColumns({c: F.round(c, 6) for c in rounded})
    return fact.drop("deliverydocument_raw")


@query(
    "origin_fanout_mode",
    f"""
    WITH {SQL_PLACES}, {SQL_LANES},
    head AS (SELECT c.addr_hash, count(*) AS deliveries FROM orders JOIN addr c ON c.side = 'c' AND c.key = o_custkey GROUP BY 1)
    SELECT d AS origin_location_id, deliveries * count(*) AS trips, count(*) AS destinations, {rnd("max(km)", 6)} AS farthest_km FROM head JOIN dist ON d = addr_hash GROUP BY d, deliveries
    """,
)
def origin_fanout_mode(t: Tables) -> DataFrame:
    """Trips of the fan-out mode over the reverse lanes, counted per origin; they are folded before the fan-out."""
    reverse = a.lane_use(t).select(
        F.col("dest_location_id").alias("origin_location_id"), F.col("origin_location_id").alias("dest_location_id")
    )
    per_lane = facts.fanout_lanes(
        a.delivery_header(t), a.delivery_address(t), a.locations(t), dims.distance_matrix(a.locations(t), reverse), a.warehouse_locations(t)
    )
    return per_lane.groupBy("origin_location_id").agg(
        F.sum("trips").alias("trips"), F.count(F.lit(1)).alias("destinations"), F.round(F.max("distance_km"), 6).alias("farthest_km")
    )


@query(
    "rescued_fields",
    """
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS SalesOrder, CAST(o_custkey AS VARCHAR) AS SoldToParty, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS drift, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS nested, o_orderkey % 2 = 0 AS rescued FROM orders
    """,
)
def rescued_fields(t: Tables) -> DataFrame:
    """Documents half of whose records have fields that the schema does not know."""
    entity, raw = replace(ENTITIES["sales_order"]), work_dir(t.spark, "raw")
    even = F.col("o_orderkey") % 2 == 0
    records = t.orders.select(
        a.padded(F.col("o_orderkey"), 10).alias("SalesOrder"), F.col("o_custkey").cast("string").alias("SoldToParty"),
        F.when(even, F.col("o_orderstatus")).alias("Drift"), F.when(even, F.struct(F.col("o_custkey").alias("key"))).alias("New"),
    )
    _documents(records, entity.name).write.text(raw)
    read = readers.read_rescued(t.spark, raw, entity)
    rest = F.col(readers.RESCUED)
    return read.select(
        "SalesOrder", "SoldToParty", F.try_variant_get(rest, "$.Drift", "string").alias("drift"), F.try_variant_get(rest, "$.New.key", "long").alias("nested"),
        rest.isNotNull().alias("rescued"),
    )
