"""The trip fact and the lane summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logilake.functions import dates, text
from logilake.operators import dedupe, joins
from logilake.operators.quality import coverage_summary
from logilake.operators.schema import column_or, lower_columns, null_of, resolve
from logilake.plans.dims import locate_addresses, with_address_hash, with_address_raw

# Partner functions in order of preference for a delivery's address.
PARTNER_RANKS = [
    (("sp", "ship-to", "sold-to"), 0),
    (("sh", "ship"), 1),
    (("bp", "bill-to"), 2),
]
OTHER_PARTNER = 10
LANE_KEYS = ["origin_location_id", "dest_location_id"]


def _timestamp(df: DataFrame, *candidates: str) -> Column:
    """First of the columns that exists, as a timestamp; text may be an OData date."""
    name = resolve(df, *candidates)
    if name is None:
        return null_of("timestamp")
    if isinstance(df.schema[name].dataType, T.StringType):
        return dates.any_date(df[name])
    return df[name].cast("timestamp")


def _at_time(day: Column, time_of_day: Column) -> Column:
    return dates.add_seconds(day, dates.seconds_of_day(time_of_day))


def best_address(address: DataFrame) -> DataFrame:
    """One address per delivery: current rows first, then by partner function, then by address id.

    The address is normalised and hashed after the choice, so only chosen rows pay for it.
    """
    has_hash = resolve(address, "addr_hash") is not None
    spelled = address if has_hash else with_address_raw(address)
    shown = "addr_hash" if has_hash else "address_raw"
    rank = dedupe.code_rank(column_or(spelled, F.lit(""), "PartnerFunction"), PARTNER_RANKS, OTHER_PARTNER)
    rows = spelled.select(
        text.lower_trim(column_or(spelled, F.lit(""), "DeliveryDocument")).alias("deliverydocument"),
        column_or(spelled, null_of("string"), "AddressID").cast("string").alias("addressid"),
        F.col(shown),
        dedupe.current_first(column_or(spelled, F.lit(True), "is_current", "IsCurrent")).alias("_current"),
        rank.alias("_rank"),
    )
    order = [F.asc("_current"), F.asc("_rank"), F.asc_nulls_last("addressid"), F.asc_nulls_last(shown)]
    best = dedupe.latest_by(rows, ["deliverydocument"], order)
    best = best if has_hash else with_address_hash(best)
    return best.select("deliverydocument", "addressid", "addr_hash")


def packed_lanes(df: DataFrame) -> DataFrame:
    """The rows with their lanes in packed ids, which are half as long in shuffles."""
    return df.withColumns({k: text.packed_id(F.col(k)) for k in LANE_KEYS})


def unpacked_lanes(df: DataFrame) -> DataFrame:
    return df.withColumns({k: text.unpacked_id(F.col(k)) for k in LANE_KEYS})


def _lane_rows(lanes: DataFrame) -> DataFrame:
    return lanes.select(
        column_or(lanes, null_of("string"), "origin_location_id", "origin", "dm_origin").alias("origin_location_id"),
        column_or(lanes, null_of("string"), "dest_location_id", "dest", "dm_dest").alias("dest_location_id"),
        column_or(lanes, null_of("double"), "distance_km", "distance").alias("distance_km"),
        column_or(lanes, null_of("double"), "network_duration_min", "network_duration", "duration_min").alias("network_duration_min"),
    )


def shortest_lanes(lanes: DataFrame) -> DataFrame:
    """One row per lane: the quickest, then the shortest."""
    order = [F.asc_nulls_last("network_duration_min"), F.asc_nulls_last("distance_km")]
    return dedupe.latest_by(_lane_rows(lanes), LANE_KEYS, order)


def with_eta(trips: DataFrame, threshold_min: float) -> DataFrame:
    """Predicted arrival, its error in minutes, and the on-time flag (null where unknown)."""
    travel = (F.col("network_duration_min") * 60.0).cast("bigint")
    eta = dates.add_seconds(F.col("picking_datetime_full"), travel)
    error = dates.minutes_between(F.col("delivery_datetime_full"), F.col("eta_predicted_ts"))
    trips = trips.withColumn("eta_predicted_ts", eta).withColumn("eta_error_min", error)
    trips = trips.withColumn("abs_eta_error_min", F.abs("eta_error_min"))
    return trips.withColumn("on_time_flag", F.col("abs_eta_error_min") <= F.lit(float(threshold_min)))


def located_trips(
    header: DataFrame, address: DataFrame, location: DataFrame, warehouse: DataFrame | None, to_warehouse: bool = True
) -> DataFrame:
    """One row per delivery with the places of its warehouse (``_wh_place``) and its address (``_place``).

    With ``to_warehouse`` only deliveries with both, which are then the origin and the destination.
    """
    document = column_or(header, null_of("string"), "DeliveryDocument").cast("string")
    pick_day = _timestamp(header, "PickingDate")
    delivery_day = _timestamp(header, "DeliveryDate", "ProofOfDeliveryDate")
    blank = null_of("string")
    trips = header.select(
        text.lower_trim(document).alias("deliverydocument"),
        document.alias("deliverydocument_raw"),
        text.lower_trim(column_or(header, blank, "Warehouse", "EWMWarehouse", "WarehouseId").cast("string")).alias("_wh"),
        _at_time(pick_day, column_or(header, blank, "PickingTime")).alias("picking_datetime_full"),
        _at_time(delivery_day, column_or(header, blank, "DeliveryTime", "ProofOfDeliveryTime")).alias("delivery_datetime_full"),
    )
    newest = [F.desc_nulls_last(c) for c in ("delivery_datetime_full", "picking_datetime_full", "_wh", "deliverydocument_raw")]
    trips = dedupe.latest_by(trips, ["deliverydocument"], newest)
    trips = trips.join(best_address(address), "deliverydocument", "left")
    places = location.select(F.col("location_id").alias("addr_hash"), F.col("location_id").alias("_place")).distinct()
    trips = trips.join(places, "addr_hash", "left")
    if warehouse is None:
        trips = trips.withColumn("_wh_place", blank)
    else:
        by_code = joins.unique_lookup(
            warehouse, text.lower_trim(F.col(resolve(warehouse, "warehouse_id", "ewmwarehouse"))), "location_id", "_wh", "_wh_place"
        )
        trips = trips.join(by_code, "_wh", "left")
    if not to_warehouse:
        return trips
    trips = trips.withColumns({"origin_location_id": F.col("_wh_place"), "dest_location_id": F.col("_place")})
    return trips.filter(text.non_blank(F.col("origin_location_id")) & F.col("dest_location_id").isNotNull())


def fact_trip(
    header: DataFrame,
    address: DataFrame,
    location: DataFrame,
    lanes: DataFrame,
    warehouse: DataFrame | None = None,
    threshold_min: float = 15.0,
    lane_mode: str = "origin_dest",
    as_of: Column | None = None,
) -> DataFrame:
    """One row per delivery with an origin and a destination; of a header that came several times, the last.

    ``origin_dest`` takes the warehouse's location as origin and the address's as destination. ``origin_fanout``
    takes the address's location as origin and gives a row for every destination that has a lane from there.
    """
    if lane_mode not in ("origin_dest", "origin_fanout"):
        raise ValueError(f"unknown lane_mode: {lane_mode}")
    return trips_on_lanes(
        located_trips(header, address, location, warehouse, lane_mode == "origin_dest"), lanes, threshold_min, lane_mode, as_of
    )


def trips_on_lanes(
    trips: DataFrame, lanes: DataFrame, threshold_min: float = 15.0, lane_mode: str = "origin_dest", as_of: Column | None = None
) -> DataFrame:
    """The trip fact from ``located_trips`` and lanes; without a shuffle if both are stored in buckets of the lane."""
    best = shortest_lanes(lanes)
    if lane_mode == "origin_dest":
        trips = trips.join(best, LANE_KEYS, "left")
    else:
        fan = best.filter(F.col("dest_location_id").isNotNull() & text.non_blank(F.col("origin_location_id")))
        trips = trips.join(fan, trips["_place"] == fan["origin_location_id"])
    trips = with_eta(trips, threshold_min)
    day = F.coalesce("picking_datetime_full", "delivery_datetime_full", *([as_of] if as_of is not None else []))
    return trips.select(
        "deliverydocument", "deliverydocument_raw", "addressid", "addr_hash", *LANE_KEYS,
        "picking_datetime_full", "delivery_datetime_full", "eta_predicted_ts",
        "eta_error_min", "abs_eta_error_min", "on_time_flag", "distance_km", "network_duration_min",
        F.to_date(day).alias("record_date"),
    )


def fanout_lanes(
    header: DataFrame, address: DataFrame, location: DataFrame, lanes: DataFrame, warehouse: DataFrame | None = None
) -> DataFrame:
    """What ``origin_fanout`` trips come to per lane: their number, distance and duration.

    Deliveries are counted per place before they meet the lanes. The trips themselves are deliveries times lanes of a
    place, so their number grows with the square of the tables, this one's with the lanes.
    """
    trips = located_trips(header, address, location, warehouse, to_warehouse=False)
    here = trips.groupBy(F.col("_place").alias("origin_location_id")).agg(F.count(F.lit(1)).alias("trips"))
    fan = shortest_lanes(lanes).filter(F.col("dest_location_id").isNotNull() & text.non_blank(F.col("origin_location_id")))
    return fan.join(here, "origin_location_id").select(*LANE_KEYS, "trips", "distance_km", "network_duration_min")


# Header columns that can say when a delivery was due and when it arrived, best first, and the
# spellings of documents, items and tasks. The spellings inside the functions of this module are fixed values too.
PLANNED_COLUMNS = (
    "plannedgoodsissuedate", "plannedgoodsissuedatetime", "planned_delivery_date", "planned_delivery_datetime",
    "planned_delivery_date_time", "planned_delivery",
)
ACTUAL_COLUMNS = (
    "proofofdeliverydate", "actualgoodsmovementdate", "actualgoodsmovementdatetime", "deliverydate", "delivery_date",
    "goodsissuedate", "goods_issue_date",
)
TASK_COLUMNS = ("warehousetask", "warehouse_task", "taskid", "task_id")
DOCUMENT_COLUMNS = ("deliverydocument", "delivery_document", "document", "deliveryid")
ITEM_COLUMNS = ("deliverydocumentitem", "delivery_document_item", "deliveryitem", "item", "deliveryitemid")


def _destinations(address: DataFrame, location: DataFrame) -> DataFrame:
    """Located destination, a packed id, per document, and per item where the addresses have one."""
    a = lower_columns(address)
    a = a if "address_raw" in a.columns else with_address_raw(a)
    rank = dedupe.code_rank(column_or(a, F.lit(""), "partnerfunction"), PARTNER_RANKS, OTHER_PARTNER)
    item = resolve(a, *ITEM_COLUMNS)
    rows = a.select(
        text.document_number(column_or(a, null_of("string"), *DOCUMENT_COLUMNS).cast("string")).alias("doc"),
        *([text.item_number(a[item]).alias("item")] if item else []),
        rank.alias("_rank"),
        "address_raw",
    ).filter(F.col("doc").isNotNull() & text.non_blank(F.col("address_raw")))
    located = locate_addresses(rows, location, "dest_location_id")
    located = located.filter(F.col("dest_location_id").isNotNull()).withColumn("dest_location_id", text.packed_id(F.col("dest_location_id")))
    keys = ["doc", "item"] if item else ["doc"]
    return dedupe.latest_by(located, keys, [F.asc("_rank"), F.asc("dest_location_id")]).select(*keys, "dest_location_id")


def _arrivals(header: DataFrame) -> DataFrame:
    """Planned and actual arrival and the picking time per document; which column counts depends on the schema."""
    h = lower_columns(header)
    rows = h.select(
        text.document_number(column_or(h, null_of("string"), *DOCUMENT_COLUMNS).cast("string")).alias("doc"),
        _timestamp(h, *PLANNED_COLUMNS).alias("planned_arrival_ts"),
        _timestamp(h, *ACTUAL_COLUMNS).alias("actual_arrival_ts"),
        _at_time(_timestamp(h, "pickingdate"), column_or(h, null_of("string"), "pickingtime")).alias("picked_ts"),
    ).filter("doc IS NOT NULL")
    order = [F.desc_nulls_last(c) for c in ("actual_arrival_ts", "planned_arrival_ts", "picked_ts")]
    return dedupe.latest_by(rows, ["doc"], order)


TASK_KEYS = ["trip_task", "trip_warehouse"]


def has_task_numbers(task: DataFrame) -> bool:
    return resolve(lower_columns(task), *TASK_COLUMNS) is not None


def _task_columns(t: DataFrame) -> dict[str, Column]:
    """Delivery item and warehouse of tasks in lower case, and the tasks' keys, which are never null."""
    wh = column_or(t, null_of("string"), "ewmwarehouse", "warehouse", "warehouse_id").cast("string")
    doc = column_or(t, null_of("string"), "ewmdelivery", "ewm_delivery", *DOCUMENT_COLUMNS[:2]).cast("string")
    item = column_or(t, null_of("string"), "ewmdeliveryitem", "ewm_delivery_item", "deliveryitem", "delivery_item")
    number = column_or(t, null_of("string"), *TASK_COLUMNS).cast("string")
    keys = dict(zip(TASK_KEYS, (F.coalesce(c, F.lit("")) for c in (number, wh)), strict=True))
    return {"doc": text.document_number(doc), "item": text.item_number(item), "wh": wh} | keys


def with_task_keys(task: DataFrame) -> DataFrame:
    """The tasks with their keys and ``_doc``, the delivery that they belong to."""
    t = lower_columns(task)
    found = _task_columns(t)
    return t.withColumns({"_doc": found["doc"]} | {k: found[k] for k in TASK_KEYS})


def task_trips(
    task: DataFrame,
    item: DataFrame,
    address: DataFrame,
    location: DataFrame,
    header: DataFrame | None,
    warehouse: DataFrame | None,
    keyed: bool = False,
) -> DataFrame:
    """One row per warehouse task, however often it was delivered, that belongs to a delivery item and whose destination is known.

    Document data is gathered once per document before it meets the tasks. Items only decide whether a task counts,
    so they join as a semi-join and never multiply tasks. With ``keyed`` the rows carry ``TASK_KEYS``, which are unique
    where tasks have numbers.
    """
    return unpacked_lanes(_packed_task_trips(task, item, address, location, header, warehouse, keyed))


def _packed_task_trips(
    task: DataFrame,
    item: DataFrame,
    address: DataFrame,
    location: DataFrame,
    header: DataFrame | None,
    warehouse: DataFrame | None,
    keyed: bool = False,
) -> DataFrame:
    numbered = has_task_numbers(task)
    t = lower_columns(task)
    tasks = t.select(*[c.alias(name) for name, c in _task_columns(t).items()]).filter("doc IS NOT NULL")
    if numbered:
        tasks = dedupe.latest_by(tasks, TASK_KEYS, [F.asc("doc"), F.asc_nulls_last("item")])
    kept = TASK_KEYS if keyed else []
    tasks = tasks.drop(*[k for k in TASK_KEYS if k not in kept])
    i = lower_columns(item)
    raw_item = column_or(i, null_of("string"), *ITEM_COLUMNS).cast("string")
    items = i.select(
        text.document_number(column_or(i, null_of("string"), *DOCUMENT_COLUMNS).cast("string")).alias("idoc"),
        text.item_number(raw_item).alias("iitem"),
    )
    # A number that equals an item's text equals its number too, and blanks have none: no row matches by text alone.
    matched = joins.first_match_join(tasks, items, [[(F.col("doc"), F.col("idoc")), (F.col("item"), F.col("iitem"))]], "left_semi")

    dests = _destinations(address, location)
    if header is None:
        empty = {c: null_of("timestamp") for c in ("planned_arrival_ts", "actual_arrival_ts", "picked_ts")}
        arrivals = dests.select("doc").distinct().withColumns(empty)
    else:
        arrivals = _arrivals(header)
    if "item" in dests.columns:
        by_item = dests.withColumnsRenamed({"doc": "_ddoc", "item": "_ditem"})
        same = (matched["doc"] == by_item["_ddoc"]) & matched["item"].eqNullSafe(by_item["_ditem"])
        trips = matched.join(by_item, same).drop("_ddoc", "_ditem").join(arrivals, "doc", "left")
    else:
        trips = matched.join(dests.join(arrivals, "doc", "left"), "doc")
    if warehouse is None:
        trips = trips.withColumn("_origin", null_of("binary"))
    else:
        code = text.or_blank(F.lower(F.col(resolve(warehouse, "ewmwarehouse", "warehouse_id"))))
        origins = joins.unique_lookup(warehouse, code, "location_id", "_wh", "_origin").withColumn("_origin", text.packed_id(F.col("_origin")))
        trips = trips.withColumn("_wh", text.or_blank(F.lower("wh"))).join(origins, "_wh", "left")
    origin = F.coalesce(F.col("_origin"), text.packed_id(F.concat(F.lit("ewm:"), text.or_blank(F.col("wh")))))
    return trips.select(
        *kept,
        origin.alias("origin_location_id"),
        "dest_location_id",
        F.col("doc").alias("deliverydocument_num"),
        F.col("item").alias("deliverydocumentitem_num"),
        "planned_arrival_ts",
        "actual_arrival_ts",
        dates.minutes_between(F.col("actual_arrival_ts"), F.col("planned_arrival_ts")).alias("eta_error_min"),
        dates.minutes_between(F.col("actual_arrival_ts"), F.col("picked_ts")).alias("actual_travel_time_min"),
    )


_PREFIX = "ewm:"


def _by_bare_ids(df: DataFrame) -> DataFrame:
    """The rows with the packed ids of their lane less the prefix (``_b...``, empty for none), and ``_form``, which says whose id
    has one. Keys that are never null spare the joins a test that would spell out again what the ids are made of."""
    # A prefix makes an id text; hashes, the common case, pay for the test only.
    prefix = text.packed_text(_PREFIX)
    has = {k: F.startswith(F.col(k), F.lit(prefix)) for k in LANE_KEYS}
    rest = {k: F.substring(F.col(k), len(prefix) + 1, 2**31 - 1).cast("string") for k in LANE_KEYS}
    rows = df.withColumns({f"_r{k}": F.when(has[k], rest[k]) for k in LANE_KEYS})
    bare = {f"_b{k}": F.coalesce(text.packed_id(F.col(f"_r{k}")), F.col(k), F.lit(b"")) for k in LANE_KEYS}
    form = sum((F.when(has[k], 2**n).otherwise(0) for n, k in enumerate(LANE_KEYS)), F.lit(0))
    return rows.withColumns(bare | {"_form": form}).drop(*[f"_r{k}" for k in LANE_KEYS])


def _lane_figures(routes: DataFrame, lanes: DataFrame) -> DataFrame:
    """Attach distance and duration: the lane itself, else the lane with the same ids less their ``ewm:`` prefix.

    The ids of the routes are packed. Lanes that differ by prefixes alone are folded to one row, so that the lanes are shuffled
    once, and each route finds its own form and the best of all forms there."""
    keys = [f"_b{k}" for k in LANE_KEYS]
    figures = ["network_duration_min", "distance_km"]
    known = _lane_rows(lanes).filter(" AND ".join(f"{k} IS NOT NULL" for k in LANE_KEYS))
    rows = _by_bare_ids(packed_lanes(known))
    # The quickest, then the shortest; unknown figures come last.
    way = F.struct(*[c for f in figures for c in (F.col(f).isNull().alias(f"no_{f}"), f)])
    forms = [f"_way{i}" for i in range(2 ** len(LANE_KEYS))]
    ways = rows.groupBy(*keys).agg(*[F.min(F.when(F.col("_form") == i, way)).alias(name) for i, name in enumerate(forms)])
    joined = _by_bare_ids(routes).join(ways, keys, "left")
    best = F.array_min(F.array(*forms))
    own = F.element_at(F.array(*forms), F.col("_form") + 1)
    found = joined.withColumns({"_own": own, "_best": best})
    return found.withColumns({f: F.coalesce(F.col(f"_own.{f}"), F.col(f"_best.{f}")) for f in figures}).drop(
        "_own", "_best", "_form", *keys, *forms
    )


def summarise_routes(trips: DataFrame, lanes: DataFrame | None, delay_min: float, last_updated: Column) -> DataFrame:
    """One row per lane. The lane figures are joined after the aggregation, as they are constant within a lane."""
    return _summarise_packed(packed_lanes(trips), lanes, delay_min, last_updated)


def _summarise_packed(trips: DataFrame, lanes: DataFrame | None, delay_min: float, last_updated: Column) -> DataFrame:
    routes = trips.groupBy(*LANE_KEYS).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.round(F.avg("actual_travel_time_min"), 2).alias("avg_actual_travel_time_min"),
        F.round(F.percentile_approx("actual_travel_time_min", 0.5), 2).alias("median_actual_travel_time_min"),
        F.round(F.avg("eta_error_min"), 2).alias("avg_eta_error_min"),
        F.round(F.avg(F.abs("eta_error_min")), 2).alias("avg_abs_eta_error_min"),
        F.round(F.count_if(F.col("eta_error_min") > float(delay_min)) / F.count(F.lit(1)) * 100.0, 2).alias("pct_delayed"),
        F.max("actual_arrival_ts").alias("last_trip_at"),
    )
    return _with_distances(routes, lanes, last_updated)


def with_distances(routes: DataFrame, lanes: DataFrame | None, last_updated: Column) -> DataFrame:
    """Lane figures with distance and duration, in the columns of the lane summary."""
    return _with_distances(packed_lanes(routes), lanes, last_updated)


def _with_distances(routes: DataFrame, lanes: DataFrame | None, last_updated: Column) -> DataFrame:
    if lanes is None:
        figures = routes.withColumns({"distance_km": null_of("double"), "network_duration_min": null_of("double")})
    else:
        figures = _lane_figures(routes, lanes)
    return unpacked_lanes(figures).select(
        *routes.columns[:-1],
        F.round("distance_km", 3).alias("avg_distance_km"),
        F.round("network_duration_min", 2).alias("avg_network_duration_min"),
        "last_trip_at",
        last_updated.cast("string").alias("last_updated"),
    )


def routes_summary(
    task: DataFrame,
    item: DataFrame,
    address: DataFrame,
    location: DataFrame,
    header: DataFrame | None,
    lanes: DataFrame | None,
    last_updated: Column,
    warehouse: DataFrame | None = None,
    delay_min: float = 15.0,
) -> DataFrame:
    trips = _packed_task_trips(task, item, address, location, header, warehouse)
    return _summarise_packed(trips, lanes, delay_min, last_updated)


def routes_dq(routes: DataFrame, run_ts: Column) -> DataFrame:
    return coverage_summary(
        routes, run_ts, routes_total=F.lit(True), routes_with_distance=F.col("avg_distance_km").isNotNull()
    )
