"""Queries over the output tables: dimensions, trip fact, lane summary, dashboards and KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logilake.catalog import adapters as a
from logilake.catalog.adapters import SQL_KNOWN, SQL_KNOWN_LANES, SQL_LANES, SQL_PLACES, Tables, at, ntz, rnd, rnd_ratio, ts
from logilake.catalog.registry import query
from logilake.functions import dates
from logilake.operators.schema import temporal_columns
from logilake.plans import dims, facts, kpis
from logilake.plans.facts import LANE_KEYS
from logilake.sources import sinks

# Minutes of tolerance for "on time": the test tables ship within days, not minutes.
ON_TIME_MIN = 60.0 * 24 * 45

# ---- dimensions -------------------------------------------------------------------------------------------------


@query(
    "dim_customer",
    """
    WITH p AS (
      SELECT lower('C' || c_custkey) AS customer_id, 'sp' AS partner_function, lower('A' || c_custkey) AS address_id, TIMESTAMP '1995-01-01' AS ts FROM customer
      UNION ALL SELECT lower('C' || o_custkey), 'sh', lower('A' || o_custkey), o_orderdate FROM orders),
    l AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC, address_id, partner_function) = 1),
    n AS (SELECT lower('A' || c_custkey) AS address_id, trim(lower(c_name)) || '  ' || lower(c_mktsegment) AS nm FROM customer)
    SELECT customer_id, CASE WHEN nm <> '' THEN trim(nm) END AS customer_name, partner_function, l.address_id, ts AS ingest_timestamp
    FROM l LEFT JOIN n ON l.address_id = n.address_id
    """,
)
def dim_customer(t: Tables) -> DataFrame:
    order_partner = t.customer.select(
        F.concat(F.lit(" C"), F.col("c_custkey").cast("string")).alias("Customer"),
        F.lit("SP").alias("PartnerFunction"),
        F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("AddressID"),
        at("1995-01-01").alias("ingest_timestamp"),
    )
    delivery_partner = t.orders.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("Customer"),
        F.lit("SH").alias("PartnerFunction"),
        F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("AddressID"),
        ts("o_orderdate").alias("ingest_timestamp"),
    )
    address = t.customer.select(
        F.concat(F.lit("A"), F.col("c_custkey").cast("string")).alias("AddressID"),
        F.col("c_name").alias("BusinessPartnerName1"),
        F.lit(None).cast("string").alias("BusinessPartnerName2"),
        F.col("c_mktsegment").alias("BusinessPartnerName3"),
    )
    dim = dims.dim_customer(order_partner, delivery_partner, address)
    return dim.withColumn("ingest_timestamp", ntz("ingest_timestamp"))


@query(
    "dim_product",
    """
    WITH p AS (
      SELECT lower('P' || p_partkey) AS product_id, lower(p_name) AS product_name, lower(p_brand) AS material_group, 'ea' AS base_unit, TIMESTAMP '1995-01-01' AS creation_date FROM part
      UNION ALL SELECT lower('P' || l_partkey), '', lower(l_returnflag), '', l_shipdate FROM lineitem)
    SELECT product_id, nullif(product_name, '') AS product_name, nullif(material_group, '') AS material_group, nullif(base_unit, '') AS base_unit, creation_date
    FROM p QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY creation_date DESC, product_name, material_group, base_unit) = 1
    """,
)
def dim_product(t: Tables) -> DataFrame:
    order_item = t.part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("Material"),
        F.col("p_name").alias("SalesOrderItemText"),
        F.col("p_brand").alias("MaterialGroup"),
        F.lit("EA").alias("OrderQuantityUnit"),
        at("1995-01-01").alias("CreationDate"),
    )
    delivery_item = t.lineitem.select(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string"), F.lit(" ")).alias("Material"),
        F.col("l_returnflag").alias("MaterialGroup"),
        ts("l_shipdate").alias("CreationDate"),
    )
    dim = dims.dim_product(order_item, delivery_item)
    return dim.withColumn("creation_date", ntz("creation_date"))


@query(
    "dim_time",
    """
    WITH r AS (
      SELECT min(lo) AS lo, max(hi) AS hi FROM (
        SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders UNION ALL
        SELECT min(l_shipdate), max(l_shipdate) FROM lineitem UNION ALL SELECT min(ts), max(ts) FROM events)),
    d AS (SELECT CAST(g AS DATE) AS d FROM r, generate_series(CAST(CAST(lo AS DATE) AS TIMESTAMP), CAST(CAST(hi AS DATE) AS TIMESTAMP), INTERVAL 1 DAY) s(g))
    SELECT d AS date, CAST(d AS TIMESTAMP) AS date_ts, strftime(d, '%Y%m%d') AS date_key, strftime(d, '%Y') AS year,
      CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week, isodow(d) >= 6 AS is_weekend,
      CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(quarter(d) AS INTEGER) AS quarter, monthname(d) AS month_name
    FROM d
    """,
    ("date",),
)
def dim_time(t: Tables) -> DataFrame:
    span = dims.date_range_of([(df, temporal_columns(df)) for df in (t.orders, t.lineitem, t.events)])
    return dims.calendar_over(span, F.lit("2024-01-01").cast("date")).withColumn("date_ts", ntz("date_ts"))


@query(
    "dim_location",
    f"""
    WITH {SQL_PLACES}, known AS (SELECT * FROM loc WHERE {SQL_KNOWN})
    SELECT location_id, address_raw, addr_norm, lat, lon, addr_norm AS addr_norm_ascii FROM known
    """,
)
def dim_location(t: Tables) -> DataFrame:
    """All addresses that the gazetteer knows; it lacks every third."""
    places = a.all_places(t)
    dim = dims.dim_location(places, a.gazetteer(places.filter(a.KNOWN)), at("2024-01-01"))
    return dim.select("location_id", "address_raw", "addr_norm", "lat", "lon", "addr_norm_ascii")


@query(
    "unlocated_addresses",
    f"""
    WITH {SQL_PLACES}, known AS (SELECT DISTINCT addr_hash FROM addr WHERE side = 's')
    SELECT key AS c_custkey, addr_hash FROM addr WHERE side = 'c' AND addr_hash NOT IN (SELECT addr_hash FROM known)
    """,
)
def unlocated_addresses(t: Tables) -> DataFrame:
    """Customers whose address is not that of a supplier."""
    known = a.supplier_places(t)
    located = dims.dim_location(known, a.gazetteer(known), at("2024-01-01"), None)
    return dims.unlocated(a.customer_places(t), located).select(F.col("key").alias("c_custkey"), "addr_hash")


@query(
    "distance_matrix",
    f"""
    WITH {SQL_PLACES}, {SQL_LANES}
    SELECT o AS origin_location_id, d AS dest_location_id, {rnd("km", 6)} AS distance_km, {rnd("km / 50.0 * 60.0", 6)} AS network_duration_min, 'great_circle' AS source FROM dist
    """,
)
def distance_matrix(t: Tables) -> DataFrame:
    """Distances of all lanes that line items use."""
    return a.lanes(t).withColumns(
        {c: F.round(c, 6) for c in ("distance_km", "network_duration_min")}
    )


@query(
    "distance_matrix_network",
    f"""
    WITH {SQL_PLACES}, {SQL_LANES},
    net AS (SELECT s.addr_hash AS o, c.addr_hash AS d, min(CAST(l_quantity AS BIGINT) * 60) AS sec
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN addr s ON s.side = 's' AND s.key = l_suppkey JOIN addr c ON c.side = 'c' AND c.key = o_custkey
      WHERE l_returnflag = 'A' GROUP BY ALL)
    SELECT dist.o AS origin_location_id, dist.d AS dest_location_id,
      CASE WHEN sec IS NOT NULL THEN sec * 10 / 1000.0 ELSE {rnd("km", 6)} END AS distance_km,
      CASE WHEN sec IS NOT NULL THEN CAST(sec AS DOUBLE) / 60 ELSE {rnd("km / 50.0 * 60.0", 6)} END AS network_duration_min,
      CASE WHEN sec IS NOT NULL THEN 'network' ELSE 'great_circle' END AS source
    FROM dist LEFT JOIN net ON dist.o = net.o AND dist.d = net.d
    """.replace("sec * 10 / 1000.0", "CAST(sec * 10 AS DOUBLE) / 1000"),
)
def distance_matrix_network(t: Tables) -> DataFrame:
    """Measured lanes win over the estimate, pair by pair."""
    seconds = F.col("l_quantity").cast("bigint") * 60
    best = F.min(F.struct(seconds.alias("duration_s"), (seconds * 10).alias("distance_m")))
    # Folded per pair of addresses before the ids are attached; the matrix takes the smallest again.
    network = a.lane_figures(t, t.lineitem.filter("l_returnflag = 'A'"), best=best).select(*LANE_KEYS, "best.*")
    matrix = dims.distance_matrix(a.locations(t), a.lane_use(t), network)
    return matrix.withColumns({c: F.round(c, 6) for c in ("distance_km", "network_duration_min")})


_TASK_SQL = """
    task AS (
      SELECT 'WH' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') AS wh, l_suppkey, l_orderkey || '-' || l_linenumber AS task, l_orderkey AS ord,
        CAST(date_diff('minute', o_orderdate, l_shipdate) AS DOUBLE) AS dur, l_quantity AS w, l_linenumber / 4.0 AS v,
        l_linestatus = 'F' AS done, l_returnflag AS area, CAST(l_partkey AS VARCHAR) AS product, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS prio
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""
_FIGURES_SQL = f"""
    k AS (
      SELECT wh, l_suppkey, count(DISTINCT ord) AS total_orders, {rnd_ratio("avg(w)", 3)} AS avg_order_planned_duration_min,
        {rnd_ratio("quantile_disc(w, 0.9)", 3)} AS p90_order_planned_duration_min, count(DISTINCT task) AS total_tasks,
        count(DISTINCT ord) AS distinct_orders_for_tasks, {rnd_ratio("avg(dur)", 3)} AS avg_task_duration_min,
        {rnd_ratio("quantile_disc(dur, 0.9)", 3)} AS p90_task_duration_min, {rnd_ratio("avg(w)", 3)} AS avg_task_weight_kg,
        {rnd_ratio("avg(v)", 3)} AS avg_task_volume_m3, {rnd_ratio("CAST(count(DISTINCT task) AS DOUBLE) / count(DISTINCT ord)", 3)} AS tasks_per_order,
        {rnd_ratio("avg(prio)", 3)} AS avg_priority, {rnd("CAST(count(*) FILTER (WHERE done) AS DOUBLE) / count(*)", 6)} AS pct_tasks_completed
      FROM task GROUP BY wh, l_suppkey),
    ca AS (SELECT wh, area AS item, count(*) AS n FROM task GROUP BY ALL), cp AS (SELECT wh, product AS item, count(*) AS n FROM task GROUP BY ALL),
    ra AS (SELECT wh, item, row_number() OVER (PARTITION BY wh ORDER BY n DESC, item) AS rn FROM ca), rp AS (SELECT wh, item, row_number() OVER (PARTITION BY wh ORDER BY n DESC, item) AS rn FROM cp),
    ta AS (SELECT wh, string_agg(item, ',' ORDER BY rn) AS top_activity_areas FROM ra WHERE rn <= 5 GROUP BY wh),
    tp AS (SELECT wh, string_agg(item, ',' ORDER BY rn) AS top_products FROM rp WHERE rn <= 5 GROUP BY wh)
"""
_FIGURE_NAMES = """total_orders, avg_order_planned_duration_min, p90_order_planned_duration_min, total_tasks, distinct_orders_for_tasks,
      avg_task_duration_min, p90_task_duration_min, avg_task_weight_kg, avg_task_volume_m3, tasks_per_order, avg_priority, pct_tasks_completed,
      top_activity_areas, top_products"""


def _plain_figures(dim: DataFrame) -> DataFrame:
    """Arrays as text and the completion share rounded, so that results compare by value."""
    return dim.withColumns(
        {
            "top_activity_areas": F.array_join("top_activity_areas", ","),
            "top_products": F.array_join("top_products", ","),
            "pct_tasks_completed": F.round("pct_tasks_completed", 6),
        }
    )


@query(
    "warehouse_kpis",
    f"WITH {_TASK_SQL}, {_FIGURES_SQL} SELECT k.wh AS warehouse_id, {_FIGURE_NAMES} FROM k JOIN ta ON k.wh = ta.wh JOIN tp ON k.wh = tp.wh",
)
def warehouse_kpis(t: Tables) -> DataFrame:
    return _plain_figures(dims.warehouse_figures(a.warehouse_order(t), a.warehouse_task(t)))


def _warehouse_dim(t: Tables) -> DataFrame:
    return dims.dim_warehouse(
        a.warehouse_order(t), a.warehouse_task(t), at("2024-01-01"), a.warehouse_map(t), a.locations(t)
    )


@query(
    "dim_warehouse",
    f"""
    WITH {_TASK_SQL}, {_FIGURES_SQL}, {SQL_PLACES}
    SELECT k.wh AS warehouse_id, 'Warehouse ' || l_suppkey AS warehouse_name, address_raw, addr_hash AS location_id, lat, lon, {_FIGURE_NAMES}
    FROM k JOIN ta ON k.wh = ta.wh JOIN tp ON k.wh = tp.wh JOIN addr ON side = 's' AND key = l_suppkey
    """,
)
def dim_warehouse(t: Tables) -> DataFrame:
    return _plain_figures(_warehouse_dim(t)).drop("created_at", "last_updated_at")


@query(
    "dq_summary",
    f"""
    WITH {SQL_PLACES}, w AS (SELECT DISTINCT l_suppkey FROM lineitem),
    d AS (SELECT l_suppkey, lat FROM w LEFT JOIN addr ON side = 's' AND key = l_suppkey AND key % 7 <> 0)
    SELECT '2024-01-01' AS run_ts, count(*) AS n_warehouses, count(*) FILTER (WHERE lat IS NULL) AS missing_location_id_and_latlon, count(*) FILTER (WHERE lat IS NULL) AS missing_lat_or_lon FROM d
    """,
)
def dq_summary(t: Tables) -> DataFrame:
    """Every seventh warehouse is not on the map."""
    mapped = a.warehouse_map(t).filter(F.substring("ewmwarehouse", 3, 6).cast("int") % 7 != 0)
    dim = dims.dim_warehouse(a.warehouse_order(t), a.warehouse_task(t), at("2024-01-01"), mapped, a.locations(t))
    return dims.warehouse_summary(dim, F.lit("2024-01-01"))


@query(
    "matrix_with_gaps",
    f"""
    WITH {SQL_PLACES}, {SQL_LANES}, {SQL_KNOWN_LANES}
    SELECT o AS origin_location_id, d AS dest_location_id, {rnd("km", 6)} AS distance_km, CASE WHEN km IS NOT NULL THEN 'great_circle' END AS source, '2024-01-01' AS retrieved_at FROM kdist
    """,
)
def matrix_with_gaps(t: Tables) -> DataFrame:
    """Lanes with an end that has no place stay without a distance."""
    matrix = _matrix_with_gaps(t)
    return matrix.withColumn("distance_km", F.round("distance_km", 6)).drop("network_duration_min")


def _matrix_with_gaps(t: Tables) -> DataFrame:
    return dims.distance_matrix(a.locations(t).filter(a.KNOWN), a.lane_use(t), retrieved_at=F.lit("2024-01-01"))


@query(
    "matrix_dq_summary",
    f"WITH {SQL_PLACES}, {SQL_LANES}, {SQL_KNOWN_LANES} SELECT '2024-01-01' AS run_ts, count(*) AS pairs_total, count(km) AS pairs_with_metric FROM kdist",
)
def matrix_dq_summary(t: Tables) -> DataFrame:
    return dims.matrix_summary(_matrix_with_gaps(t), F.lit("2024-01-01"))


# ---- trip fact --------------------------------------------------------------------------------------------------

_TRIP_SQL = f"""
    ship AS (SELECT l_orderkey AS k, max(l_shipdate) AS shipped, min(l_suppkey) AS supp FROM lineitem GROUP BY l_orderkey),
    head AS (
      SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS deliverydocument, 'A' || o_custkey AS addressid, c.addr_hash, s.addr_hash AS o, c.addr_hash AS d,
        o_orderdate + to_seconds(CAST((o_orderkey % 24) * 3600 + (o_orderkey % 60) * 60 AS BIGINT)) AS pick,
        shipped + to_seconds(CAST((o_custkey % 24) * 3600 + (o_custkey % 60) * 60 AS BIGINT)) AS deliver
      FROM orders JOIN ship ON o_orderkey = k JOIN addr c ON c.side = 'c' AND c.key = o_custkey JOIN addr s ON s.side = 's' AND s.key = supp),
    lane_min AS (SELECT o, d, km, km / 50.0 * 60.0 AS mins FROM dist),
    trip0 AS (SELECT h.*, km, mins, pick + to_seconds(CAST(trunc(mins * 60.0) AS BIGINT)) AS eta FROM head h LEFT JOIN lane_min m ON h.o = m.o AND h.d = m.d),
    trip AS (SELECT *, CAST(date_diff('second', eta, deliver) AS DOUBLE) / 60 AS err FROM trip0),
    fact AS (
      SELECT deliverydocument, addressid, addr_hash, o AS origin_location_id, d AS dest_location_id, pick AS picking_datetime_full, deliver AS delivery_datetime_full,
        eta AS eta_predicted_ts, err AS eta_error_min, abs(err) AS abs_eta_error_min, abs(err) <= {ON_TIME_MIN} AS on_time_flag, km AS distance_km, mins AS network_duration_min, CAST(pick AS DATE) AS record_date
      FROM trip)
"""
_FACT = f"WITH {SQL_PLACES}, {SQL_LANES}, {_TRIP_SQL}"
_MOMENTS = ("picking_datetime_full", "delivery_datetime_full", "eta_predicted_ts")


def trip_fact(t: Tables) -> DataFrame:
    return facts.fact_trip(
        a.delivery_header(t),
        a.delivery_address(t),
        a.locations(t),
        a.lanes(t),
        a.warehouse_locations(t),
        ON_TIME_MIN,
    )


@query(
    "fact_trip",
    f"""{_FACT} SELECT deliverydocument, addressid, addr_hash, origin_location_id, dest_location_id, picking_datetime_full, delivery_datetime_full, eta_predicted_ts,
      {rnd("eta_error_min", 6)} AS eta_error_min, {rnd("abs_eta_error_min", 6)} AS abs_eta_error_min, on_time_flag, {rnd("distance_km", 6)} AS distance_km, {rnd("network_duration_min", 6)} AS network_duration_min, record_date FROM fact""",
    ("record_date",),
)
def fact_trip(t: Tables) -> DataFrame:
    rounded = ("eta_error_min", "abs_eta_error_min", "distance_km", "network_duration_min")
    fact = trip_fact(t).withColumns({c: ntz(c) for c in _MOMENTS}).withColumns({c: F.round(c, 6) for c in rounded})
    return fact.drop("deliverydocument_raw")


@query(
    "fact_trip_fanout",
    f"""
    WITH {SQL_PLACES}, {SQL_LANES},
    head AS (SELECT c.addr_hash, count(*) AS deliveries FROM orders JOIN addr c ON c.side = 'c' AND c.key = o_custkey GROUP BY 1),
    fan AS (SELECT d, count(DISTINCT o) AS destinations FROM lane GROUP BY d)
    SELECT d AS origin_location_id, deliveries * destinations AS trips, destinations, deliveries FROM head JOIN fan ON d = addr_hash
    """,
)
def fact_trip_fanout(t: Tables) -> DataFrame:
    """Deliveries of each address against all lanes that leave it, counted from the lanes' number; the lanes are the
    reverse ones."""
    reverse = a.lane_use(t).select(
        F.col("dest_location_id").alias("origin_location_id"), F.col("origin_location_id").alias("dest_location_id")
    )
    degree = facts.shortest_lanes(dims.distance_matrix(a.locations(t), reverse)).groupBy("origin_location_id").agg(
        F.count(F.lit(1)).alias("destinations")
    )
    trips = facts.located_trips(
        a.delivery_header(t), a.delivery_address(t), a.locations(t), a.warehouse_locations(t), to_warehouse=False
    )
    here = trips.groupBy(F.col("_place").alias("origin_location_id")).agg(F.count(F.lit(1)).alias("deliveries"))
    return here.join(degree, "origin_location_id").select(
        "origin_location_id", (F.col("deliveries") * F.col("destinations")).alias("trips"), "destinations", "deliveries"
    )


@query(
    "fact_trip_redelivered",
    f"{_FACT} SELECT deliverydocument, count(*) AS trips FROM fact GROUP BY 1",
)
def fact_trip_redelivered(t: Tables) -> DataFrame:
    """Every header and address twice: still one trip per delivery."""
    header, address = a.delivery_header(t), a.delivery_address(t)
    fact = facts.fact_trip(
        header.unionByName(header), address.unionByName(address), a.locations(t), a.lanes(t), a.warehouse_locations(t), ON_TIME_MIN
    )
    return fact.groupBy("deliverydocument").agg(F.count(F.lit(1)).alias("trips"))


@query(
    "trips_without_calendar_day",
    f"""{_FACT}, days AS (
      SELECT CAST(g AS DATE) AS d FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, DATE '1998-07-01' AS hi FROM orders), generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) s(g))
    SELECT count(*) AS trips FROM fact WHERE record_date IS NULL OR record_date NOT IN (SELECT d FROM days)
    """,
)
def trips_without_calendar_day(t: Tables) -> DataFrame:
    """Trips whose record date is not in the calendar, which ends at the cut."""
    span = t.orders.agg(F.to_date(F.min("o_orderdate")).alias("min_date"), F.lit(a.CUT).cast("date").alias("max_date"))
    days = dims.calendar_over(span, F.lit("2024-01-01").cast("date")).select(F.col("date").alias("record_date"))
    return trip_fact(t).join(days, "record_date", "left_anti").agg(F.count(F.lit(1)).alias("trips"))


@query("total_trips", f"{_FACT} SELECT count(*) AS total_trips FROM fact")
def total_trips(t: Tables) -> DataFrame:
    return kpis.total_trips(trip_fact(t))


@query("on_time_trips", f"{_FACT} SELECT count(*) FILTER (WHERE on_time_flag) AS on_time_trips FROM fact")
def on_time_trips(t: Tables) -> DataFrame:
    return kpis.on_time_trips(trip_fact(t))


@query("on_time_rate", f"""{_FACT} SELECT {rnd("CAST(count(*) FILTER (WHERE on_time_flag) AS DOUBLE) / count(*) * 100", 6)} AS on_time_rate FROM fact""")
def on_time_rate(t: Tables) -> DataFrame:
    return kpis.on_time_rate(trip_fact(t))


@query(
    "trips_by_dow_delivery",
    f"{_FACT} SELECT CAST(dayofweek(delivery_datetime_full) + 1 AS INTEGER) AS day_of_week, count(*) AS trips FROM fact GROUP BY 1",
)
def trips_by_dow_delivery(t: Tables) -> DataFrame:
    return kpis.trips_by_weekday(trip_fact(t), "delivery_datetime_full")


@query(
    "trips_by_dow_picking",
    f"{_FACT} SELECT CAST(dayofweek(picking_datetime_full) + 1 AS INTEGER) AS day_of_week, count(*) AS trips FROM fact GROUP BY 1",
)
def trips_by_dow_picking(t: Tables) -> DataFrame:
    return kpis.trips_by_weekday(trip_fact(t), "picking_datetime_full")


@query(
    "weekly_on_time",
    f"""{_FACT} SELECT CAST(delivery_datetime_full AS DATE) - CAST(dayofweek(delivery_datetime_full) AS INTEGER) AS week,
      count(*) FILTER (WHERE on_time_flag) AS on_time_trips, count(*) AS trips FROM fact GROUP BY 1""",
    ("week",),
)
def weekly_on_time(t: Tables) -> DataFrame:
    return kpis.weekly_on_time(trip_fact(t))


@query(
    "weekly_on_time_sql",
    f"""{_FACT} SELECT CAST(date_trunc('week', delivery_datetime_full) AS DATE) AS week,
      count(*) FILTER (WHERE on_time_flag) AS on_time_trips, count(*) AS trips FROM fact GROUP BY 1""",
    ("week",),
)
def weekly_on_time_sql(t: Tables) -> DataFrame:
    """Dashboard text over a registered view, with weeks from Monday."""
    sinks.register_view(trip_fact(t), "fact_shipment_trip")
    return t.spark.sql(
        """
        SELECT to_date(date_trunc('week', delivery_datetime_full)) AS week, count_if(on_time_flag) AS on_time_trips, count(*) AS trips
        FROM fact_shipment_trip GROUP BY 1 ORDER BY 1
        """
    )


# ---- lane summary -----------------------------------------------------------------------------------------------

_ROUTES_SQL = f"""
    arr AS (
      SELECT o_orderkey AS k, o_orderdate AS planned, deliver.shipped AS actual,
        o_orderdate + to_seconds(CAST((o_orderkey % 24) * 3600 + (o_orderkey % 60) * 60 AS BIGINT)) AS pick, o_custkey
      FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1) deliver ON l_orderkey = o_orderkey),
    tt AS (
      SELECT s.addr_hash AS o, c.addr_hash AS d, actual,
        CAST(date_diff('second', planned, actual) AS DOUBLE) / 60 AS err, CAST(date_diff('second', pick, actual) AS DOUBLE) / 60 AS trav
      FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem) JOIN arr ON l_orderkey = k JOIN addr s ON s.side = 's' AND s.key = l_suppkey JOIN addr c ON c.side = 'c' AND c.key = o_custkey),
    agg AS (
      SELECT o, d, count(*) AS total_trips, {rnd_ratio("avg(trav)", 2)} AS avg_actual_travel_time_min, {rnd_ratio("quantile_disc(trav, 0.5)", 2)} AS median_actual_travel_time_min,
        {rnd_ratio("avg(err)", 2)} AS avg_eta_error_min, {rnd_ratio("avg(abs(err))", 2)} AS avg_abs_eta_error_min,
        {rnd_ratio("CAST(count(*) FILTER (WHERE err > 15) AS DOUBLE) / count(*) * 100", 2)} AS pct_delayed, max(actual) AS last_trip_at
      FROM tt GROUP BY o, d),
    routes AS (
      SELECT agg.o AS origin_location_id, agg.d AS dest_location_id, total_trips, avg_actual_travel_time_min, median_actual_travel_time_min, avg_eta_error_min,
        avg_abs_eta_error_min, pct_delayed, {rnd("km", 3)} AS avg_distance_km, {rnd("km / 50.0 * 60.0", 2)} AS avg_network_duration_min, last_trip_at, '2024-01-01' AS last_updated
      FROM agg LEFT JOIN dist ON agg.o = dist.o AND agg.d = dist.d)
"""
_ROUTES = f"WITH {SQL_PLACES}, {SQL_LANES}, {_ROUTES_SQL}"


def lane_summary(t: Tables) -> DataFrame:
    return facts.routes_summary(
        a.warehouse_task(t),
        a.delivery_item(t),
        a.delivery_address(t),
        a.locations(t),
        a.delivery_header(t),
        a.lanes(t),
        F.lit("2024-01-01"),
        a.warehouse_locations(t),
    )


@query("routes_summary", f"{_ROUTES} SELECT * FROM routes")
def routes_summary(t: Tables) -> DataFrame:
    return lane_summary(t).withColumn("last_trip_at", ntz("last_trip_at"))


_UNMAPPED_SQL = f"""
    u AS (
      SELECT CASE WHEN l_suppkey % 5 = 0 THEN 'ewm:WH' || lpad(CAST(l_suppkey AS VARCHAR), 6, '0') ELSE s.addr_hash END AS o, c.addr_hash AS d, l_suppkey
      FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
      JOIN addr s ON s.side = 's' AND s.key = l_suppkey JOIN addr c ON c.side = 'c' AND c.key = o_custkey),
    routes AS (
      SELECT u.o AS origin_location_id, u.d AS dest_location_id, count(*) AS total_trips,
        CASE WHEN u.o LIKE 'ewm:%' THEN max(CASE WHEN l_suppkey % 10 = 0 THEN CAST(l_suppkey AS DOUBLE) END) ELSE {rnd("max(km)", 3)} END AS avg_distance_km
      FROM u LEFT JOIN dist ON dist.o = u.o AND dist.d = u.d GROUP BY u.o, u.d)
"""
_UNMAPPED = f"WITH {SQL_PLACES}, {SQL_LANES}, {_UNMAPPED_SQL}"


def _unmapped_routes(t: Tables) -> DataFrame:
    """Every fifth warehouse has no place; half of these have lanes under their bare code."""
    number = F.substring("warehouse_id", 3, 6).cast("int")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    dest = a.customer_places(t).select(F.col("key").alias("o_custkey"), F.col("addr_hash").alias("dest_location_id"))
    bare = t.lineitem.filter("l_suppkey % 10 = 0").join(orders, "l_orderkey").select("l_suppkey", "o_custkey").distinct()
    bare = bare.join(dest, "o_custkey").select(
        a.warehouse_code(F.col("l_suppkey")).alias("origin_location_id"),
        "dest_location_id",
        F.col("l_suppkey").cast("double").alias("distance_km"),
        (F.col("l_suppkey") * 2.0).alias("network_duration_min"),
        F.lit("network").alias("source"),
    )
    return facts.routes_summary(
        a.warehouse_task(t), a.delivery_item(t), a.delivery_address(t), a.locations(t), a.delivery_header(t),
        a.lanes(t).unionByName(bare), F.lit("2024-01-01"), a.warehouse_locations(t).filter(number % 5 != 0),
    )


@query("routes_unmapped_warehouses", f"{_UNMAPPED} SELECT * FROM routes")
def routes_unmapped_warehouses(t: Tables) -> DataFrame:
    """Default origins of unmapped warehouses, and lanes found without their prefix."""
    return _unmapped_routes(t).select("origin_location_id", "dest_location_id", "total_trips", "avg_distance_km")


@query(
    "routes_dq_summary",
    f"{_UNMAPPED} SELECT '2024-01-01' AS run_ts, count(*) AS routes_total, count(avg_distance_km) AS routes_with_distance FROM routes",
)
def routes_dq_summary(t: Tables) -> DataFrame:
    return facts.routes_dq(_unmapped_routes(t), F.lit("2024-01-01"))


@query(
    "routes_item_destinations",
    f"""
    WITH {SQL_PLACES},
    i AS (
      SELECT l_orderkey, l_linenumber, min(CASE WHEN l_linenumber % 2 = 0 THEN c.addr_hash ELSE s.addr_hash END) AS d
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN addr s ON s.side = 's' AND s.key = l_suppkey JOIN addr c ON c.side = 'c' AND c.key = o_custkey GROUP BY ALL)
    SELECT d AS dest_location_id, count(*) AS tasks FROM (SELECT DISTINCT l_suppkey, l_orderkey, l_linenumber FROM lineitem) JOIN i USING (l_orderkey, l_linenumber) GROUP BY 1
    """,
)
def routes_item_destinations(t: Tables) -> DataFrame:
    """Addresses per delivery item: even items go to the customer, odd ones back to the supplier."""
    fields = ("StreetName", "HouseNumber", "CityName", "PostalCode", "Country")
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "l_suppkey", "o_custkey")
    to_customer = lines.filter("l_linenumber % 2 = 0").join(a.customer_places(t), F.col("o_custkey") == F.col("key"))
    to_supplier = lines.filter("l_linenumber % 2 = 1").join(a.supplier_places(t), F.col("l_suppkey") == F.col("key"))
    address = to_customer.unionByName(to_supplier).select(
        a.padded(F.col("l_orderkey"), 10).alias("DeliveryDocument"),
        a.padded(F.col("l_linenumber"), 6).alias("DeliveryDocumentItem"),
        F.lit("SH").alias("PartnerFunction"),
        *fields,
    )
    trips = facts.task_trips(a.warehouse_task(t), a.delivery_item(t), address, a.locations(t), None, None)
    return trips.groupBy("dest_location_id").agg(F.count(F.lit(1)).alias("tasks"))


@query(
    "weekly_distance",
    f"""{_ROUTES} SELECT CAST(date_trunc('week', last_trip_at) AS DATE) AS week, {rnd_ratio("avg(CAST(avg_distance_km AS DECIMAL(24,6)))", 3)} AS avg_distance_km,
      {rnd_ratio("avg(CAST(avg_network_duration_min AS DECIMAL(24,6)))", 2)} AS avg_network_duration_min FROM routes GROUP BY 1""",
    ("week",),
)
def weekly_distance(t: Tables) -> DataFrame:
    return kpis.weekly_distance(lane_summary(t))


@query(
    "weekly_eta_error",
    f"""{_ROUTES} SELECT CAST(last_trip_at AS DATE) - CAST(dayofweek(last_trip_at) AS INTEGER) AS week,
      {rnd_ratio("avg(CAST(avg_eta_error_min AS DECIMAL(24,6)))", 4)} AS avg_eta_error_min, {rnd_ratio("avg(CAST(avg_abs_eta_error_min AS DECIMAL(24,6)))", 4)} AS avg_abs_eta_error_min FROM routes GROUP BY 1""",
    ("week",),
)
def weekly_eta_error(t: Tables) -> DataFrame:
    weekly = kpis.weekly_eta_error(lane_summary(t))
    return weekly.withColumns({c: F.round(c, 4) for c in ("avg_eta_error_min", "avg_abs_eta_error_min")})


# ---- monthly KPIs -----------------------------------------------------------------------------------------------


def _shipments(t: Tables) -> DataFrame:
    """Line items with region, carrier (the order's priority class), countries, pick time and delay."""
    days = F.datediff("l_shipdate", "o_orderdate")
    origin = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("origin"))
    dest = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dest"))
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("dest"), F.col("r_name").alias("region"))
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_shipdate")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(dest, "o_custkey")
        .join(regions, "dest")
        .join(origin, "l_suppkey")
        .select(
            "region",
            F.col("o_orderpriority").alias("carrier"),
            "origin",
            "dest",
            (F.unix_timestamp(ts("o_orderdate")) + (F.col("o_orderkey") % 24) * 3600).alias("_picked"),
            ts("l_shipdate").alias("shipped_at"),
            days.alias("days"),
            F.col("l_quantity").cast("bigint").alias("qty"),
        )
        .withColumn("picked_at", F.timestamp_seconds("_picked"))
        .drop("_picked")
    )


_SHIP_SQL = """
    sh AS (
      SELECT r_name AS region, o_orderpriority AS carrier, s_nationkey AS origin, c_nationkey AS dest, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS picked_at,
        l_shipdate AS shipped_at, date_diff('day', o_orderdate, l_shipdate) AS days, CAST(l_quantity AS BIGINT) AS qty
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


@query(
    "kpi_monthly_yoy",
    f"""
    WITH {_SHIP_SQL},
    m AS (SELECT region, carrier, CAST(date_trunc('month', shipped_at) AS DATE) AS month, CAST(count(*) AS DOUBLE) AS trips, CAST(sum(qty) AS DOUBLE) AS quantity,
      CAST(sum(days) AS DOUBLE) / count(*) AS avg_days, CAST(count(*) FILTER (WHERE days > 60) AS DOUBLE) / count(*) * 100 AS pct_delayed FROM sh GROUP BY ALL),
    u AS (SELECT region, carrier, month, 'trips' AS metric, trips AS value FROM m UNION ALL SELECT region, carrier, month, 'quantity', quantity FROM m
      UNION ALL SELECT region, carrier, month, 'avg_days', avg_days FROM m UNION ALL SELECT region, carrier, month, 'pct_delayed', pct_delayed FROM m)
    SELECT u.region, u.carrier, u.month, u.metric, u.value, CASE WHEN p.value <> 0 THEN u.value / p.value - 1 END AS yoy_change
    FROM u LEFT JOIN u p ON u.region = p.region AND u.carrier = p.carrier AND u.metric = p.metric AND u.month = CAST(p.month + INTERVAL 12 MONTH AS DATE)
    """,
    ("month",),
)
def kpi_monthly_yoy(t: Tables) -> DataFrame:
    count = F.count(F.lit(1))
    metrics = {
        "trips": count,
        "quantity": F.sum("qty"),
        "avg_days": F.sum("days") / count,
        "pct_delayed": F.count_if(F.col("days") > 60) / count * 100,
    }
    return kpis.monthly_kpis(_shipments(t), ["region", "carrier"], "shipped_at", metrics)


@query(
    "kpi_rollup",
    f"""
    WITH {_SHIP_SQL}
    SELECT region, carrier, CAST(CASE WHEN grouping(region) = 1 THEN 2 WHEN grouping(carrier) = 1 THEN 1 ELSE 0 END AS INTEGER) AS level,
      count(*) AS trips, CAST(sum(qty) AS BIGINT) AS quantity FROM sh GROUP BY ROLLUP (region, carrier)
    """,
)
def kpi_rollup(t: Tables) -> DataFrame:
    return kpis.rollup_kpis(_shipments(t), ["region", "carrier"], {"trips": F.count(F.lit(1)), "quantity": F.sum("qty")})


@query(
    "route_reliability",
    f"""
    WITH {_SHIP_SQL}, e AS (SELECT *, CAST(date_diff('second', picked_at, shipped_at) AS DOUBLE) / 60 - 43200 AS err FROM sh)
    SELECT origin, dest, CAST(isodow(picked_at) AS INTEGER) AS day_of_week, CAST(hour(picked_at) AS INTEGER) AS hour, count(*) AS trips, {rnd_ratio("avg(err)", 2)} AS avg_error_min,
      {rnd_ratio("CAST(count(*) FILTER (WHERE err > 15) AS DOUBLE) / count(*) * 100", 2)} AS pct_delayed FROM e GROUP BY ALL
    """,
)
def route_reliability(t: Tables) -> DataFrame:
    """Error against a promise of 30 days after picking."""
    trips = _shipments(t).withColumn("error_min", dates.minutes_between(F.col("shipped_at"), F.col("picked_at")) - 43200)
    return kpis.lane_reliability(trips, ["origin", "dest"], "picked_at", "error_min")


@query(
    "route_cost_per_km",
    f"""
    WITH {_SHIP_SQL}
    SELECT origin, dest, count(*) AS trips, {rnd_ratio("CASE WHEN sum(days) <> 0 THEN CAST(sum(qty) AS DOUBLE) / sum(days) END", 4)} AS cost_per_km FROM sh GROUP BY origin, dest
    """,
)
def route_cost_per_km(t: Tables) -> DataFrame:
    """Quantity stands for cost and days for kilometres."""
    trips = _shipments(t).select("origin", "dest", F.col("qty").cast("double").alias("cost"), F.col("days").cast("double").alias("km"))
    return kpis.cost_per_km(trips, ["origin", "dest"], "cost", "km")
