"""Dimensions: customer, product, time, location, distance matrix, warehouse."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logilake.functions import dates, geo, text
from logilake.operators import dedupe, joins
from logilake.operators.quality import coverage_summary
from logilake.operators.schema import column_or, lower_columns, null_of, resolve

EPOCH = "1970-01-01"


def _newest_first(ts: Column) -> Column:
    """Rows without a timestamp sort as if from 1970."""
    return F.coalesce(ts, F.lit(EPOCH).cast("timestamp")).desc()


# ---- customer and product -------------------------------------------------------------------------------------

# The parts of a business partner's name, in order.
PARTY_NAME_COLUMNS = (
    "BusinessPartnerName1",
    "BusinessPartnerName2",
    "BusinessPartnerName3",
    "BusinessPartnerName4",
    "PersonFamilyName",
    "BusinessPartnerName",
)


def _partner_rows(df: DataFrame) -> DataFrame:
    blank = F.lit("")
    return df.select(
        text.lower_trim(column_or(df, blank, "Customer", "CustomerID")).alias("customer_id"),
        text.lower_trim(column_or(df, blank, "PartnerFunction")).alias("partner_function"),
        text.lower_trim(column_or(df, blank, "AddressID")).alias("address_id"),
        column_or(df, null_of("timestamp"), "ingest_timestamp").cast("timestamp").alias("ingest_timestamp"),
    ).filter("customer_id != ''")


def dim_customer(order_partner: DataFrame, delivery_partner: DataFrame, address: DataFrame) -> DataFrame:
    """One row per customer: its latest partner row, with the latest name known for that row's address."""
    if not (resolve(order_partner, "Customer", "CustomerID") or resolve(delivery_partner, "Customer", "CustomerID")):
        raise ValueError("neither partner table has a customer column")
    name_parts = [address[c] for c in (resolve(address, n) for n in PARTY_NAME_COLUMNS) if c]
    names = address.select(
        text.lower_trim(column_or(address, F.lit(""), "AddressID")).alias("address_id"),
        F.trim(F.lower(F.concat_ws(" ", *[text.or_blank(p) for p in name_parts]))).alias("bp_name"),
        column_or(address, null_of("timestamp"), "ingest_timestamp").cast("timestamp").alias("_named_at"),
    ).filter("address_id != ''")
    names = dedupe.latest_by(names, ["address_id"], [_newest_first(F.col("_named_at")), F.asc("bp_name")])
    partners = _partner_rows(order_partner).unionByName(_partner_rows(delivery_partner))
    order = [_newest_first(F.col("ingest_timestamp")), F.asc("address_id"), F.asc("partner_function")]
    latest = dedupe.latest_by(partners, ["customer_id"], order)
    return latest.join(names.drop("_named_at"), "address_id", "left").select(
        "customer_id",
        text.blank_to_null(F.col("bp_name")).alias("customer_name"),
        text.blank_to_null(F.col("partner_function")).alias("partner_function"),
        text.blank_to_null(F.col("address_id")).alias("address_id"),
        "ingest_timestamp",
    )


def _product_rows(df: DataFrame, name: str, unit: str) -> DataFrame:
    blank = F.lit("")
    return df.select(
        text.lower_trim(column_or(df, blank, "Material", "material_id")).alias("product_id"),
        text.lower_trim(column_or(df, blank, name, "itemtext")).alias("product_name"),
        text.lower_trim(column_or(df, blank, "MaterialGroup")).alias("material_group"),
        text.lower_trim(column_or(df, blank, unit)).alias("base_unit"),
        column_or(df, null_of("timestamp"), "CreationDate", "creation_date").try_cast("timestamp").alias("creation_date"),
        column_or(df, null_of("timestamp"), "ingest_timestamp").cast("timestamp").alias("_ingested"),
    ).filter("product_id != ''")


def dim_product(order_item: DataFrame, delivery_item: DataFrame) -> DataFrame:
    """One row per product: the item created last, then ingested last."""
    if not (resolve(order_item, "Material", "material_id") or resolve(delivery_item, "Material", "material_id")):
        raise ValueError("neither item table has a material column")
    rows = _product_rows(order_item, "SalesOrderItemText", "OrderQuantityUnit").unionByName(
        _product_rows(delivery_item, "DeliveryDocumentItemText", "BaseUnit")
    )
    order = [_newest_first(F.col("creation_date")), _newest_first(F.col("_ingested"))]
    order += [F.asc(c) for c in ("product_name", "material_group", "base_unit")]
    return dedupe.latest_by(rows, ["product_id"], order).select(
        "product_id",
        text.blank_to_null(F.col("product_name")).alias("product_name"),
        text.blank_to_null(F.col("material_group")).alias("material_group"),
        text.blank_to_null(F.col("base_unit")).alias("base_unit"),
        "creation_date",
    )


# ---- time -----------------------------------------------------------------------------------------------------

def date_range_of(frames: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """One row (min_date, max_date) over the named columns of several frames; implausible years are left out.

    Each frame is reduced to one row before the union, so only those rows are shuffled.
    """
    ranges = []
    for df, columns in frames:
        stamps = [df[c].try_cast("timestamp") for c in columns]
        good = [F.when(dates.plausible(s), s) for s in stamps]
        lows, highs = [F.min(g) for g in good], [F.max(g) for g in good]
        low = F.least(*lows) if len(lows) > 1 else lows[0]
        high = F.greatest(*highs) if len(highs) > 1 else highs[0]
        ranges.append(df.agg(low.alias("lo"), high.alias("hi")))
    united = reduce(DataFrame.unionByName, ranges)
    return united.agg(F.to_date(F.min("lo")).alias("min_date"), F.to_date(F.max("hi")).alias("max_date"))


def calendar_over(date_range: DataFrame, today: Column) -> DataFrame:
    """Daily calendar of a (min_date, max_date) row. Plausible years bound it.

    Without any date it runs from three years before ``today`` to 31 days after.
    """
    last = F.coalesce(F.col("max_date"), F.date_add(today, 31))
    first = F.coalesce(F.col("min_date"), F.date_sub(today, 365 * 3))
    days = date_range.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date"))
    day = F.col("date")
    return days.select(
        "date",
        day.cast("timestamp").alias("date_ts"),
        F.date_format(day, "yyyyMMdd").alias("date_key"),
        F.date_format(day, "yyyy").alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        dates.dow_monday_first(day).alias("day_of_week"),
        (dates.dow_monday_first(day) >= 6).alias("is_weekend"),
        F.weekofyear(day).alias("week_of_year"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "MMMM").alias("month_name"),
    )


# ---- location and distance ------------------------------------------------------------------------------------

# Column spellings of an address, in the order of the assembled text.
ADDRESS_COLUMNS = (
    ("StreetName", "street_name", "street", "street_name1", "street1", "streetline1"),
    ("HouseNumber", "house_number", "houseno"),
    ("CityName", "city", "city_name"),
    ("PostalCode", "postal_code", "postcode", "zip"),
    ("Country", "country_code"),
)


def with_address_raw(df: DataFrame) -> DataFrame:
    """Add ``address_raw``, assembled from whatever address columns there are."""
    raw = text.join_words(*[column_or(df, F.lit(""), *names) for names in ADDRESS_COLUMNS])
    return df.withColumn("address_raw", raw)


def with_address_hash(df: DataFrame) -> DataFrame:
    """Add ``addr_norm`` and ``addr_hash`` of ``address_raw``."""
    with_norm = df.withColumn("addr_norm", text.normalise_address(F.col("address_raw")))
    return with_norm.withColumn("addr_hash", text.address_hash(F.col("addr_norm")))


def with_address(df: DataFrame) -> DataFrame:
    return with_address_hash(with_address_raw(df))


def dim_location(addresses: DataFrame, gazetteer: DataFrame, published_at: Column, top_n: int | None = None) -> DataFrame:
    """All addresses that the gazetteer locates; ``top_n`` makes it a report on the most frequent ones.

    Spellings with one normal form are one location, shown by its most frequent spelling.
    """
    spelled = with_address(addresses) if "addr_hash" not in addresses.columns else addresses
    spelled = spelled.filter(text.non_blank(F.col("address_raw")) & F.col("addr_hash").isNotNull())
    counted = spelled.groupBy("address_raw", "addr_norm", "addr_hash").agg(F.count(F.lit(1)).alias("_cnt"))
    if top_n is not None:
        counted = counted.orderBy(F.desc("_cnt"), F.asc("address_raw")).limit(top_n)
    places = dedupe.latest_by(counted, ["addr_hash"], [F.desc("_cnt"), F.asc("address_raw")])
    known = gazetteer.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    known = dedupe.latest_by(known, ["addr_hash"], [F.asc_nulls_last("created_at"), F.asc("lat"), F.asc("lon")])
    found = known.select("addr_hash", "lat", "lon", "display_name", "raw_json", "created_at")
    return places.join(found, "addr_hash").select(
        F.col("addr_hash").alias("location_id"),
        "address_raw",
        "addr_norm",
        "lat",
        "lon",
        "display_name",
        "raw_json",
        "created_at",
        published_at.alias("published_at"),
        F.coalesce("addr_norm", F.lit("")).alias("addr_norm_ascii"),
    )


def unlocated(addresses: DataFrame, location: DataFrame) -> DataFrame:
    """Non-blank addresses whose normal form has no location."""
    spelled = with_address(addresses) if "addr_hash" not in addresses.columns else addresses
    spelled = spelled.filter(text.non_blank(F.col("address_raw")))
    return spelled.join(location.select(F.col("location_id").alias("addr_hash")), "addr_hash", "left_anti")


def locate_addresses(df: DataFrame, location: DataFrame, out: str) -> DataFrame:
    """Location id by ``address_raw``: normal form, then plain lower case, then the form without punctuation."""
    raw = F.col("address_raw")
    stages = [
        (text.normalise_address(raw), F.col("addr_norm")),
        (text.blank_to_null(F.lower(raw)), F.lower(raw)),
        (
            text.normalise_address(raw, keep_punctuation=False),
            text.normalise_address(F.col("addr_norm_ascii"), keep_punctuation=False),
        ),
    ]
    return joins.cascade_lookup(df, location, ["address_raw"], stages, "location_id", out)


def distance_matrix(
    locations: DataFrame,
    lanes: DataFrame,
    network: DataFrame | None = None,
    speed_kph: float = 50.0,
    retrieved_at: Column | None = None,
) -> DataFrame:
    """Kilometres and minutes per (origin, destination) of the lanes in use.

    ``network`` holds measured ``distance_m`` and ``duration_s`` per pair and wins over the great-circle estimate;
    ``source`` says which one a row has; a network with ``hops``, as ``paths.fill_lanes`` gives it, tells measured lanes
    (``network``) from ways over several of them (``network_path``). A lane with an end that has no place stays, without figures, so that the
    coverage counters show it.
    """
    pairs = lanes.select("origin_location_id", "dest_location_id").distinct()
    places = locations.groupBy("location_id").agg(F.min(F.struct("lat", "lon")).alias("p"))
    origin = places.select(F.col("location_id").alias("origin_location_id"), F.col("p").alias("o"))
    dest = places.select(F.col("location_id").alias("dest_location_id"), F.col("p").alias("d"))
    located = pairs.join(origin, "origin_location_id", "left").join(dest, "dest_location_id", "left")
    km = geo.haversine_km(F.col("o.lat"), F.col("o.lon"), F.col("d.lat"), F.col("d.lon"))
    located = located.withColumn("_km", km)
    keys = ["origin_location_id", "dest_location_id"]
    if network is None:
        measured, net_km, net_min = located, null_of("double"), null_of("double")
    else:
        figures = ["duration_s", "distance_m", *(c for c in network.columns if c == "hops")]
        best = network.groupBy(*keys).agg(F.min(F.struct(*figures)).alias("n"))
        measured = located.join(best, keys, "left")
        net_km, net_min = geo.metres_to_km(F.col("n.distance_m")), geo.seconds_to_minutes(F.col("n.duration_s"))
    of_network = net_km.isNotNull() & net_min.isNotNull()
    several = F.col("n.hops") > 1 if network is not None and "hops" in network.columns else F.lit(False)
    return measured.select(
        *keys,
        F.coalesce(net_km, F.col("_km")).cast("double").alias("distance_km"),
        F.coalesce(net_min, geo.travel_minutes(F.col("_km"), speed_kph)).cast("double").alias("network_duration_min"),
        F.when(of_network & several, "network_path").when(of_network, "network").when(F.col("_km").isNotNull(), "great_circle").alias("source"),
        *([retrieved_at.alias("retrieved_at")] if retrieved_at is not None else []),
    )


def matrix_summary(matrix: DataFrame, run_ts: Column) -> DataFrame:
    return coverage_summary(matrix, run_ts, pairs_total=F.lit(True), pairs_with_metric=F.col("distance_km").isNotNull())


# ---- warehouse ------------------------------------------------------------------------------------------------

# Task states that count as completed.
DONE_STATES = ("C", "COMPLETED", "Done", "done", "completed")
# Column spellings of a task's state. The spellings of other columns below are fixed values too.
STATUS_COLUMNS = ("warehousetaskstatus", "warehousetask_status", "status")


def _order_kpis(orders: DataFrame) -> DataFrame:
    o = lower_columns(orders)
    planned = column_or(
        o, null_of("double"), "warehouseorderplannedduration", "warehouse_order_planned_duration", "planned_duration_min"
    ).try_cast("double")
    if not resolve(o, "warehouseorderplannedduration", "warehouse_order_planned_duration", "planned_duration_min"):
        created = column_or(o, null_of("timestamp"), "whseordercreationdatetime", "creationdatetime", "created_at", "creation_date")
        started = column_or(o, null_of("timestamp"), "warehouseorderstartdatetime", "startdatetime", "start_at")
        planned = dates.minutes_between(started.try_cast("timestamp"), created.try_cast("timestamp"))
    rows = o.select(
        column_or(o, null_of("string"), "ewmwarehouse", "warehouse", "warehouse_id").cast("string").alias("warehouse_id"),
        column_or(o, null_of("string"), "warehouseorder", "warehouse_order", "orderid", "order_id").alias("order_id"),
        planned.alias("planned"),
    ).filter("warehouse_id IS NOT NULL")
    figures = rows.groupBy("warehouse_id").agg(
        F.round(F.avg("planned"), 3).alias("avg_order_planned_duration_min"),
        F.round(F.percentile_approx("planned", 0.9), 3).alias("p90_order_planned_duration_min"),
    )
    return _with_distinct_counts(figures, rows, {"total_orders": "order_id"})


def _with_distinct_counts(figures: DataFrame, rows: DataFrame, counts: dict[str, str]) -> DataFrame:
    """Join distinct counts to figures per warehouse.

    They are aggregated apart: beside a distinct count, Spark would keep a percentile sketch for every distinct
    value instead of one per warehouse. The distinct values themselves are spread over all tasks.
    """
    distinct = rows.groupBy("warehouse_id").agg(*[F.countDistinct(c).alias(name) for name, c in counts.items()])
    return figures.join(distinct, "warehouse_id")


def _task_rows(tasks: DataFrame) -> DataFrame:
    t = lower_columns(tasks)
    created = column_or(t, null_of("timestamp"), "whsetaskcrtnutcdatetime", "created_at", "crt_ts")
    confirmed = column_or(t, null_of("timestamp"), "whsetaskconfutcdatetime", "confirmed_at", "conf_ts")
    return t.select(
        column_or(t, null_of("string"), "ewmwarehouse", "warehouse", "warehouse_id").cast("string").alias("warehouse_id"),
        column_or(t, null_of("string"), "warehousetask", "warehouse_task", "taskid", "task_id").alias("task_id"),
        column_or(t, null_of("string"), "warehouseorder", "warehouse_order", "orderid").alias("order_id"),
        dates.minutes_between(confirmed.try_cast("timestamp"), created.try_cast("timestamp")).alias("duration"),
        column_or(t, null_of("double"), "whsetasknetweight", "weight", "task_weight").try_cast("double").alias("weight"),
        column_or(t, null_of("double"), "whsetasknetvolume", "volume", "task_volume").try_cast("double").alias("volume"),
        column_or(t, null_of("double"), "ewmwarehousetaskpriority").try_cast("double").alias("priority"),
        column_or(t, null_of("string"), *STATUS_COLUMNS).cast("string").alias("status"),
        F.lit(resolve(t, *STATUS_COLUMNS) is not None).alias("_has_status"),
        column_or(t, null_of("string"), "activityarea", "warehouseorderactivityarea", "activity_area").cast("string").alias("area"),
        column_or(t, null_of("string"), "product", "material", "sku").cast("string").alias("product"),
    ).filter("warehouse_id IS NOT NULL")


def _task_kpis(rows: DataFrame) -> DataFrame:
    done = F.count_if(F.col("status").isin(*DONE_STATES)) / F.count(F.lit(1))
    figures = rows.groupBy("warehouse_id").agg(
        F.round(F.avg("duration"), 3).alias("avg_task_duration_min"),
        F.round(F.percentile_approx("duration", 0.9), 3).alias("p90_task_duration_min"),
        F.round(F.avg("weight"), 3).alias("avg_task_weight_kg"),
        F.round(F.avg("volume"), 3).alias("avg_task_volume_m3"),
        F.round(F.avg("priority"), 3).alias("avg_priority"),
        F.when(F.any_value("_has_status"), done).alias("pct_tasks_completed"),
    )
    return _with_distinct_counts(figures, rows, {"total_tasks": "task_id", "distinct_orders_for_tasks": "order_id"})


def _task_tops(rows: DataFrame, k: int = 5) -> DataFrame:
    """Top areas and top products in one pass: both are counted as (warehouse, kind, item)."""
    kinds = F.array(
        F.struct(F.lit("area").alias("kind"), F.col("area").alias("item")),
        F.struct(F.lit("product").alias("kind"), F.col("product").alias("item")),
    )
    items = rows.select("warehouse_id", F.explode(kinds).alias("e")).select("warehouse_id", "e.kind", "e.item")
    tops = dedupe.top_k_per_group(items, ["warehouse_id", "kind"], "item", k, "top")
    return tops.groupBy("warehouse_id").agg(
        F.max(F.when(F.col("kind") == "area", F.col("top"))).alias("top_activity_areas"),
        F.max(F.when(F.col("kind") == "product", F.col("top"))).alias("top_products"),
    )


# Output columns and types of the order and task figures.
_WAREHOUSE_FIGURES = {
    "total_orders": "bigint",
    "avg_order_planned_duration_min": "double",
    "p90_order_planned_duration_min": "double",
    "total_tasks": "bigint",
    "distinct_orders_for_tasks": "bigint",
    "avg_task_duration_min": "double",
    "p90_task_duration_min": "double",
    "avg_task_weight_kg": "double",
    "avg_task_volume_m3": "double",
    "tasks_per_order": "double",
    "avg_priority": "double",
    "pct_tasks_completed": "double",
    "top_activity_areas": "array<string>",
    "top_products": "array<string>",
}


def warehouse_figures(orders: DataFrame | None, tasks: DataFrame | None) -> DataFrame:
    """Order and task figures per warehouse; a warehouse known to one side only has nulls for the other."""
    parts = []
    if orders is not None:
        parts.append(_order_kpis(orders))
    if tasks is not None:
        rows = _task_rows(tasks)
        parts += [_task_kpis(rows), _task_tops(rows)]
    if not parts:
        raise ValueError("dim_warehouse needs warehouse orders or warehouse tasks")
    joined = reduce(lambda a, b: a.join(b, "warehouse_id", "full_outer"), parts)
    if orders is not None and tasks is not None:
        ratio = F.try_divide(F.col("total_tasks").cast("double"), F.col("total_orders").cast("double"))
        joined = joined.withColumn("tasks_per_order", F.round(ratio, 3))
    have = set(joined.columns)
    return joined.select(
        "warehouse_id",
        *[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in _WAREHOUSE_FIGURES.items()],
    )


def _locate_warehouses(known: DataFrame, location: DataFrame | None, tolerance: float) -> DataFrame:
    """Location of the mapped warehouses. Done on the map, before the figures of orders and tasks are joined, since
    each lookup reads its left side twice."""
    if location is None:
        return known.withColumn("location_id", null_of("string"))
    here = [(F.col("lat"), F.col("lat")), (F.col("lon"), F.col("lon"))]
    placed = joins.tolerance_lookup(known, location, here, tolerance, "location_id", "_by_place")
    placed = locate_addresses(placed, location, "_by_address")
    return placed.withColumn("location_id", F.coalesce("_by_place", "_by_address")).drop("_by_place", "_by_address")


def dim_warehouse(
    orders: DataFrame | None,
    tasks: DataFrame | None,
    as_of: Column,
    wh_map: DataFrame | None = None,
    location: DataFrame | None = None,
    latlon_tolerance: float = 1e-4,
) -> DataFrame:
    """Warehouse figures with name, address, coordinates and location.

    The location is found by coordinates within the tolerance, else by the address.
    """
    map_types = {"warehouse_name": "string", "address_raw": "string", "lat": "double", "lon": "double"}
    dim = warehouse_figures(orders, tasks)
    if wh_map is None:
        dim = dim.withColumns({name: null_of(kind) for name, kind in map_types.items()} | {"location_id": null_of("string")})
    else:
        known = wh_map.select(
            F.col("ewmwarehouse").cast("string").alias("warehouse_id"),
            *[column_or(wh_map, null_of(kind), name).cast(kind).alias(name) for name, kind in map_types.items()],
        )
        known = dedupe.latest_by(known, ["warehouse_id"], [F.asc_nulls_last(c) for c in map_types])
        dim = dim.join(_locate_warehouses(known, location, latlon_tolerance), "warehouse_id", "left")
    return dim.select(
        "warehouse_id", "warehouse_name", "address_raw", "location_id", "lat", "lon", *_WAREHOUSE_FIGURES,
        as_of.alias("created_at"), as_of.alias("last_updated_at"),
    )


def warehouse_summary(dim: DataFrame, run_ts: Column) -> DataFrame:
    no_place = F.col("lat").isNull() | F.col("lon").isNull()
    return coverage_summary(
        dim,
        run_ts,
        n_warehouses=F.lit(True),
        missing_location_id_and_latlon=F.col("location_id").isNull() & no_place,
        missing_lat_or_lon=no_place,
    )
