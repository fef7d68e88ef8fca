"""Raw files to tables, batch and streaming, and the gold builders on small frames."""

import datetime as dt
import gzip
import json

import pytest
from pyspark.sql import functions as F

from logilake.catalog import adapters, all_queries
from logilake.operators.quality import coverage_summary
from logilake.plans import dims, facts, gold, kpis, silver
from logilake.sources import readers, sinks
from logilake.sources.entities import ENTITIES
from logilake.streaming import intake


def at(day):
    return F.lit(day).cast("timestamp")


def drop(folder, entity, name, records, envelope=("d", "results")):
    body = records
    for part in reversed(envelope):
        body = {part: body}
    day = folder / entity / "2024-01-01"
    day.mkdir(parents=True, exist_ok=True)
    with gzip.open(day / f"{entity}_{name}.json.gz", "wt") as f:
        f.write(json.dumps(body))


ORDERS = [
    {"SalesOrder": "1", "TotalNetAmount": "10.5", "SalesOrderDate": "/Date(0)/", "CompleteDeliveryIsDefined": True},
    {"SalesOrder": "2", "TotalNetAmount": "abc"},
    {"TotalNetAmount": "3"},
]


def test_entities_have_the_declared_width():
    widths = {n: len(e.columns) for n, e in ENTITIES.items()}
    assert widths == {
        "sales_order": 34, "sales_order_item": 45, "sales_order_partner": 11, "sales_order_scheduleline": 14,
        "sales_order_pricing_element": 44, "sales_order_subsequent_proc_flow": 17, "outbound_delivery_header": 108,
        "outbound_delivery_item": 62, "outbound_delivery_partner": 10, "outbound_delivery_address": 50,
        "warehouse_order": 22, "warehouse_task": 86,
    }
    for e in ENTITIES.values():
        assert set(e.keys) | set(e.required) | set(e.rules) | set(e.compare) | set(e.types) <= set(e.columns)


def test_documents_keep_their_file_and_bad_ones_are_set_apart(spark, tmp_path, rows):
    drop(tmp_path, "warehouse_order", "b1", [{"EWMWarehouse": "W", "WarehouseOrder": "1", "WarehouseOrderPlannedDuration": 2.5}], ("value",))
    (tmp_path / "warehouse_order" / "2024-01-01" / "warehouse_order_b2.json.gz").write_bytes(gzip.compress(b"{broken"))
    entity = ENTITIES["warehouse_order"]
    docs = readers.read_documents(spark, readers.raw_glob(str(tmp_path), entity.name), entity)
    flat = readers.flatten_documents(docs, entity)
    (valid, reject), staged = silver.stage_records(flat, entity)
    assert valid.count() == 1 and valid.first().source_file.endswith("_b1.json.gz")
    assert str(valid.first().WarehouseOrderPlannedDuration) == "2.500"
    assert rows(reject, "_corrupt_record", "reject_reason") == [("{broken", "corrupt_document")]


def test_silver_run_writes_table_rejects_and_log(spark, tmp_path, rows):
    entity = ENTITIES["sales_order"]
    drop(tmp_path / "raw", entity.name, "b1", ORDERS)
    paths = silver.SilverPaths(str(tmp_path / "silver"))
    raw = readers.raw_glob(str(tmp_path / "raw"), entity.name)
    for _ in range(2):  # a repeated batch replaces its own rows
        counts = silver.run_entity(spark, entity, raw, paths, "b1", at("2024-01-02"), table="sales_order_t")
    assert counts == {"records_processed": 1, "records_rejected": 2}
    fact = spark.read.parquet(paths.table(entity))
    assert rows(fact, "SalesOrder", "TotalNetAmount", "job_name") == [("1", 10.5, "sales_order")]
    assert rows(silver.read_rejects(spark, paths, entity), "SalesOrder", "TotalNetAmount", "reject_reason") == [
        ("2", "abc", "dq_TotalNetAmount_numeric"), (None, "3", "missing_required"),
    ]
    log = silver.read_log(spark, paths, entity)
    assert rows(log, "batch_id", "records_processed", "records_rejected", "status") == [("b1", 1, 2, "success")]
    assert spark.table("sales_order_t").count() == 1
    with pytest.raises(Exception):
        silver.run_entity(spark, entity, str(tmp_path / "nowhere"), paths, "b2", at("2024-01-02"))
    assert rows(silver.read_log(spark, paths, entity).filter("batch_id = 'b2'"), "status") == [("failed",)]


def test_facts_once_per_key_and_batch_names_as_they_are(spark, tmp_path, rows):
    entity = ENTITIES["sales_order"]
    paths = silver.SilverPaths(str(tmp_path / "silver"))
    raw = readers.raw_glob(str(tmp_path / "raw"), entity.name)
    drop(tmp_path / "raw", entity.name, "f1", ORDERS)
    drop(tmp_path / "raw", entity.name, "f2", ORDERS[:1])
    silver.run_entity(spark, entity, raw, paths, "007", at("2024-01-01"))
    drop(tmp_path / "raw", entity.name, "f3", [{**ORDERS[0], "TotalNetAmount": "11"}])
    silver.run_entity(spark, entity, readers.raw_glob(str(tmp_path / "raw"), entity.name).replace("_*", "_f3*"), paths, "8", at("2024-01-02"))
    assert rows(spark.read.parquet(paths.table(entity)), "ingest_batch_id") == [("007",), ("8",)]
    loaded = silver.load(spark, paths, [entity, ENTITIES["warehouse_task"]])
    assert set(loaded) == {"sales_order"} and rows(loaded["sales_order"], "SalesOrder", "TotalNetAmount") == [("1", 11.0)]


def test_a_state_cannot_be_lost(spark, tmp_path, rows):
    entity = ENTITIES["outbound_delivery_partner"]
    paths = silver.SilverPaths(str(tmp_path / "s"))
    only = []
    for i in range(3):
        drop(tmp_path / f"only{i}", entity.name, "w", [{**PARTNER, "AddressID": str(i)}])
        only.append(readers.raw_glob(str(tmp_path / f"only{i}"), entity.name))
    with pytest.raises(ValueError, match="first_run"):
        silver.run_entity(spark, entity, only[0], paths, "b0", at("2024-02-01"))
    silver.run_entity(spark, entity, only[0], paths, "b0", at("2024-02-01"), first_run=True)
    with pytest.raises(ValueError, match="no snapshot"):
        silver.run_entity(spark, entity, only[1], paths, "b1", at("2024-02-02"), previous_batch="b00")
    for _ in range(2):  # a repeated batch builds on the state before it
        silver.run_entity(spark, entity, only[1], paths, "b1", at("2024-02-02"))
    with pytest.raises(Exception, match="older than a stored version"):
        silver.run_entity(spark, entity, only[2], paths, "b2", at("2024-01-15"))
    silver.run_entity(spark, entity, only[2], paths, "b2", at("2024-01-15"), late="insert")
    assert rows(sinks.last_snapshot(spark, paths.table(entity)), "AddressID", "start_date", "end_date", "is_current") == [
        ("0", dt.date(2024, 2, 1), dt.date(2024, 2, 1), False),
        ("1", dt.date(2024, 2, 2), None, True),
        ("2", dt.date(2024, 1, 15), dt.date(2024, 1, 31), False),
    ]
    assert rows(silver.read_entity(spark, paths, entity), "AddressID") == [("1",)]


def test_batch_and_stream_share_paths_and_new_checkpoints_read_new_files(spark, tmp_path, rows):
    entity = ENTITIES["sales_order"]
    paths = silver.SilverPaths(str(tmp_path / "s"))
    glob = readers.raw_glob(str(tmp_path / "raw"), entity.name)
    for i, checkpoint in enumerate(("cp1", "cp2")):
        drop(tmp_path / "raw", entity.name, f"f{i}", [{**ORDERS[0], "SalesOrder": str(i)}])
        intake.run_intake(spark, entity, glob, paths, str(tmp_path / checkpoint), lambda e: at("2024-01-01"))
    silver.run_entity(spark, entity, glob, paths, "batch", at("2024-01-02"))
    assert rows(intake.read_facts(spark, paths, entity), "SalesOrder") == [("0",), ("1",)]
    assert silver.read_log(spark, paths, entity).count() == 3
    assert silver.read_rejects(spark, paths, entity).count() == 0


PARTNER = {"SDDocument": "D1", "PartnerFunction": "SH", "Customer": "C1"}


def test_silver_dimension_and_stream_give_the_same_versions(spark, tmp_path, rows):
    entity = ENTITIES["outbound_delivery_partner"]
    waves = [[{**PARTNER, "AddressID": "1"}], [{**PARTNER, "AddressID": "2"}, {"SDDocument": "D2", "PartnerFunction": "SP"}]]
    batch, stream = silver.SilverPaths(str(tmp_path / "batch")), silver.SilverPaths(str(tmp_path / "stream"))
    glob = readers.raw_glob(str(tmp_path / "raw"), entity.name)
    for i, wave in enumerate(waves):
        drop(tmp_path / "raw", entity.name, f"w{i}", wave)
        drop(tmp_path / f"only{i}", entity.name, f"w{i}", wave)
        only = readers.raw_glob(str(tmp_path / f"only{i}"), entity.name)
        silver.run_entity(spark, entity, only, batch, f"b{i}", at(f"2024-01-0{i + 1}"), f"b{i - 1}" if i else None, first_run=i == 0)
        for _ in range(2):  # the second run finds nothing new
            intake.run_intake(spark, entity, glob, stream, str(tmp_path / "cp"), lambda e: at(f"2024-01-0{e + 1}"))
    columns = ("SDDocument", "AddressID", "start_date", "end_date", "is_current")
    got = rows(intake.read_state(spark, stream, entity), *columns)
    assert got == rows(sinks.read_snapshot(spark, batch.table(entity), "b1"), *columns)
    assert got == [
        ("D1", "1", dt.date(2024, 1, 1), dt.date(2024, 1, 1), False),
        ("D1", "2", dt.date(2024, 1, 2), None, True),
        ("D2", None, dt.date(2024, 1, 2), None, True),
    ]


def test_repeated_micro_batch_has_no_effect(spark, tmp_path):
    entity = ENTITIES["sales_order"]
    drop(tmp_path / "raw", entity.name, "b1", ORDERS)
    paths = silver.SilverPaths(str(tmp_path / "s"))
    docs = readers.read_documents(spark, readers.raw_glob(str(tmp_path / "raw"), entity.name), entity)
    for _ in range(2):
        intake.process_batch(docs, 0, entity, paths, at("2024-01-01"))
    assert intake.read_facts(spark, paths, entity).count() == 1
    # Failed before the log row: the same folders are written again.
    import shutil

    shutil.rmtree(f"{paths.log}/{entity.name}")
    intake.process_batch(docs, 0, entity, paths, at("2024-01-01"))
    assert intake.read_facts(spark, paths, entity).count() == 1


def test_readers_tolerate_what_is_missing(spark, tmp_path, rows):
    assert readers.read_table_or_none(spark, str(tmp_path / "no")) is None
    assert readers.read_table_or_none(spark, None) is None
    spark.range(2).write.parquet(str(tmp_path / "a"))
    spark.range(3).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "b"))
    united = readers.read_all(spark, f"{tmp_path}/a, {tmp_path}/b,{tmp_path}/no")
    assert united.count() == 5 and united.columns == ["id", "x"]
    assert readers.table_or_path(spark, "no_such_table", str(tmp_path / "a")).count() == 2
    (tmp_path / "map.csv").write_text("Warehouse,Address,Latitude,LNG,junk\nW1,Main 1,1.5,bad,x\n")
    assert rows(readers.read_warehouse_map(spark, str(tmp_path / "map.csv"))) == [("W1", "Main 1", 1.5, None)]


def test_snapshots_switch_a_table(spark, tmp_path, rows):
    base = str(tmp_path / "dim")
    first = spark.createDataFrame([(1, "a", 1)], "k int, v string, created int")
    gold.publish_merged(spark, first, base, ["k"], "b1", table="dim_t", first_run=True)
    second = spark.createDataFrame([(1, "b", 2), (2, "c", 2)], "k int, v string, created int")
    gold.publish_merged(spark, second, base, ["k"], "b2", "b1", ("created",), table="dim_t")
    assert rows(spark.table("dim_t")) == [(1, "b", 1), (2, "c", 2)]
    assert rows(sinks.read_snapshot(spark, base, "b1")) == [(1, "a", 1)]
    for i in (3, 4):
        gold.publish_merged(spark, second, base, ["k"], f"b{i}", table="dim_t")
    assert sinks.expire_snapshots(spark, base) == ["b1", "b2"]
    with pytest.raises(ValueError, match="no snapshot"):
        sinks.read_snapshot(spark, base, "b1")
    gold.publish_merged(spark, first, base, ["k"], "b5", table="dim_t")
    assert rows(spark.table("dim_t")) == [(1, "a", 1), (2, "c", 2)]


# ---- gold builders ----------------------------------------------------------------------------------------------


def test_calendar_without_dates_and_with_a_long_range(spark):
    none = spark.createDataFrame([(None, None)], "min_date date, max_date date")
    days = dims.calendar_over(none, F.lit("2024-01-01").cast("date")).agg(F.min("date"), F.max("date")).first()
    assert days[:] == (dt.date(2021, 1, 1), dt.date(2024, 2, 1))
    long = spark.createDataFrame([(dt.date(2000, 1, 1), dt.date(2024, 1, 1))], "min_date date, max_date date")
    assert dims.calendar_over(long, F.current_date()).count() == 8767
    odd = spark.createDataFrame([(dt.date(1, 1, 1),), (dt.date(2024, 1, 1),)], "d date")
    assert dims.date_range_of([(odd, ["d"])]).first()[:] == (dt.date(2024, 1, 1),) * 2


def test_more_than_three_hundred_locations_all_get_distances(spark):
    places = spark.range(400).select(F.concat(F.lit("L"), "id").alias("location_id"), (F.col("id") / 10.0).alias("lat"), (F.col("id") / 5.0).alias("lon"))
    ids = places.select(F.col("location_id").alias("origin_location_id"), F.concat(F.lit("L"), F.pmod(F.hash("location_id"), F.lit(401)).cast("string")).alias("dest_location_id"))
    m = dims.distance_matrix(places, ids, retrieved_at=F.lit("now"))
    assert m.count() == 400 and m.columns[-1] == "retrieved_at"
    unlocated = m.filter("dest_location_id = 'L400'")
    assert m.filter("distance_km IS NULL").count() == unlocated.count()
    assert unlocated.filter("source IS NOT NULL OR network_duration_min IS NOT NULL").count() == 0


def test_warehouse_without_tasks_or_map(spark):
    orders = spark.createDataFrame([("W1", "1", 5.0), ("W1", "2", 7.0)], "EWMWarehouse string, WarehouseOrder string, WarehouseOrderPlannedDuration double")
    row = dims.dim_warehouse(orders, None, at("2024-01-01")).first()
    assert (row.warehouse_id, row.total_orders, row.avg_order_planned_duration_min, row.avg_priority, row.location_id) == ("W1", 2, 6.0, None, None)


def test_warehouse_location_by_place_then_by_address(spark, rows):
    orders = spark.createDataFrame([("W1", "1"), ("W2", "1"), ("W3", "1")], "EWMWarehouse string, WarehouseOrder string")
    wh_map = spark.createDataFrame(
        [("W1", None, 10.00001, 20.0), ("W2", "Đường A, 1", None, None), ("W3", "nowhere", 50.0, 50.0)],
        "ewmwarehouse string, address_raw string, lat double, lon double",
    )
    location = spark.createDataFrame(
        [("L1", "x", "x", "x", 10.0, 20.0), ("L2", "Duong A, 1", "duong a, 1", "duong a, 1", 1.0, 1.0)],
        "location_id string, address_raw string, addr_norm string, addr_norm_ascii string, lat double, lon double",
    )
    dim = dims.dim_warehouse(orders, None, at("2024-01-01"), wh_map, location)
    assert rows(dim, "warehouse_id", "location_id") == [("W1", "L1"), ("W2", "L2"), ("W3", None)]
    assert dims.warehouse_summary(dim, F.lit("t")).first()[:] == ("t", 3, 0, 1)


def lane_inputs(spark):
    address = dims.with_address(
        spark.createDataFrame(
            [("0080000001", "BP", "Z", "Elsewhere"), ("0080000001", "SH", "A", "Main St"), ("0080000002", "XX", "B", "Main St")],
            "DeliveryDocument string, PartnerFunction string, AddressID string, StreetName string",
        )
    )
    location = address.select(F.col("addr_hash").alias("location_id"), "address_raw", "addr_norm", F.col("addr_norm").alias("addr_norm_ascii")).distinct()
    dest = address.filter("PartnerFunction = 'SH'").first().addr_hash
    header = spark.createDataFrame(
        [("0080000001", "/Date(0)/", "PT1H", "/Date(0)/", "/Date(7200000)/", " w1 "), ("0080000002", "bad", None, "/Date(0)/", None, "W9")],
        "DeliveryDocument string, PickingDate string, PickingTime string, PlannedGoodsIssueDate string, DeliveryDate string, Warehouse string",
    )
    warehouse = spark.createDataFrame([("W1", "O1")], "warehouse_id string, location_id string")
    lanes = spark.createDataFrame([("O1", dest, 25.0, 90.0), ("O1", dest, 20.0, 50.0), (dest, "X", 1.0, 1.0), (dest, "Y", 1.0, 1.0)],
                                  "origin_location_id string, dest_location_id string, distance_km double, network_duration_min double")
    return header, address, location, lanes, warehouse, dest


def test_trip_takes_best_address_shortest_lane_and_eta(spark):
    header, address, location, lanes, warehouse, dest = lane_inputs(spark)
    trip = facts.fact_trip(header, address, location, lanes, warehouse).collect()
    assert len(trip) == 1
    row = trip[0]
    assert (row.addressid, row.origin_location_id, row.dest_location_id, row.distance_km) == ("A", "O1", dest, 20.0)
    assert (row.eta_error_min, row.abs_eta_error_min, row.on_time_flag) == (10.0, 10.0, True)  # 02:00 against 01:50
    fan = facts.fact_trip(header, address, location, lanes, warehouse, lane_mode="origin_fanout")
    assert sorted((r.deliverydocument, r.dest_location_id) for r in fan.collect()) == [
        (d, x) for d in ("0080000001", "0080000002") for x in "XY"
    ]


def test_fanout_lanes_are_the_folded_fanout_trips(spark, rows):
    header, address, location, lanes, warehouse, dest = lane_inputs(spark)
    fan = facts.fact_trip(header, address, location, lanes, warehouse, lane_mode="origin_fanout")
    folded = fan.groupBy(*facts.LANE_KEYS).agg(F.count(F.lit(1)).alias("trips"), F.max("distance_km").alias("distance_km"))
    columns = (*facts.LANE_KEYS, "trips", "distance_km")
    assert rows(facts.fanout_lanes(header, address, location, lanes, warehouse), *columns) == rows(folded, *columns)
    assert rows(folded, "trips") == [(2,), (2,)]


def test_lanes_are_paired_by_numbers_of_addresses(spark):
    """Line items and orders meet without the ids of places, each of 64 letters."""
    plan = adapters.lane_use(adapters.Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [o#" in plan
    measured = all_queries()["distance_matrix_network"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert measured.count("Aggregate [o#") == 2


def test_only_distinct_addresses_are_spelled_out(spark, rows):
    """Customers and suppliers are folded per address before the addresses are normalised, and none is lost."""
    tables = adapters.Tables(spark, "/root/testdata/sf0.001")
    located = adapters.locations(tables)
    plan = located._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [nationkey#" in plan[: plan.index("Union")]
    names = ("address_raw", "addr_norm", "lat", "lon")
    all_of_them = adapters.all_places(tables).groupBy("addr_hash").agg(*[F.min(c).alias(c) for c in names])
    assert rows(located, "location_id", *names) == rows(all_of_them, "addr_hash", *names)


def test_routes_summary_falls_back_and_counts_tasks_once(spark):
    header, address, location, lanes, warehouse, dest = lane_inputs(spark)
    task = spark.createDataFrame(
        [("W1", "0080000001", "000010"), ("W1", "80000001", "10"), ("w7", "0080000002", ""), ("W1", "0080000099", "1")],
        "EWMWarehouse string, EWMDelivery string, EWMDeliveryItem string",
    )
    item = spark.createDataFrame(
        [("0080000001", "000010"), ("0080000001", "10"), ("0080000002", None)], "DeliveryDocument string, DeliveryDocumentItem string"
    )
    lanes = lanes.unionByName(spark.createDataFrame([("w7", dest, 7.0, 8.0)], lanes.schema))
    got = {r.origin_location_id: r for r in facts.routes_summary(task, item, address, location, header, lanes, F.lit("now"), warehouse).collect()}
    assert set(got) == {"O1", "ewm:w7"}
    assert (got["O1"].total_trips, got["O1"].avg_eta_error_min, got["O1"].pct_delayed, got["O1"].avg_distance_km) == (2, 120.0, 100.0, 20.0)
    assert (got["ewm:w7"].total_trips, got["ewm:w7"].avg_eta_error_min, got["ewm:w7"].avg_distance_km) == (1, None, 7.0)


def test_gold_run_end_to_end(spark, tmp_path, rows):
    header, address, _, _, _, _ = lane_inputs(spark)
    address = address.drop("address_raw", "addr_norm", "addr_hash")
    gazetteer = dims.with_address(address).select(
        "addr_hash", F.lit(10.0).alias("lat"), F.lit(20.0).alias("lon"), F.lit("x").alias("display_name"),
        F.lit(None).cast("string").alias("raw_json"), F.lit("2024").alias("created_at"),
    ).distinct()
    wh_map = spark.createDataFrame([("W1", "main st.", None, None, "First")], "ewmwarehouse string, address_raw string, lat double, lon double, warehouse_name string")
    parts = spark.createDataFrame([("C1", "SH", "A")], "Customer string, PartnerFunction string, AddressID string")
    items = spark.createDataFrame([("P1", "000010", "0080000001", dt.datetime(2024, 1, 1))], "Material string, DeliveryDocumentItem string, DeliveryDocument string, CreationDate timestamp")
    task = spark.createDataFrame([("W1", "T1", "1", "0080000001", "10")], "EWMWarehouse string, WarehouseTask string, WarehouseOrder string, EWMDelivery string, EWMDeliveryItem string")
    silver_tables = {
        "outbound_delivery_address": address, "outbound_delivery_header": header, "warehouse_task": task,
        "sales_order_partner": parts, "outbound_delivery_partner": parts, "sales_order_item": items, "outbound_delivery_item": items,
    }
    for batch, previous in (("b1", None), ("b2", "b1"), ("b2", None)):
        day = at("2024-02-01" if batch == "b1" else "2024-02-02")
        job = gold.GoldJob(spark, silver_tables, str(tmp_path), batch, day, previous, "gold_db", first_run=batch == "b1")
        # What an earlier batch geocoded stays known.
        gold.build_dimensions(job, gazetteer if batch == "b1" else gazetteer.limit(0), wh_map)
        gold.build_distances(job)
        gold.build_facts(job)
    assert rows(spark.table("gold_db.dim_location"), "address_raw") == [("Elsewhere",), ("Main St",)]
    assert rows(spark.table("gold_db.dim_customer"), "customer_id", "is_current") == [("c1", True)]
    made = spark.table("gold_db.dim_warehouse").select("warehouse_name", F.to_date("created_at"), F.to_date("last_updated_at")).first()
    assert made[:] == ("First", dt.date(2024, 2, 1), dt.date(2024, 2, 2))
    assert spark.table("gold_db.dim_time").count() == 1 and spark.table("gold_db.dim_distance_matrix").count() == 1
    assert rows(gold.read_trips(job), "deliverydocument", "distance_km", "ingest_batch_id") == [("0080000001", 0.0, "b2")]
    assert rows(spark.table("gold_db.routes_summary"), "total_trips", "avg_distance_km") == [(1, 0.0)]
    assert rows(spark.read.parquet(job.path("routes_summary_dq")), "routes_total", "routes_with_distance") == [(1, 1), (1, 1)]


def test_trips_of_changed_deliveries_only(spark, tmp_path, rows):
    header, address, location, lanes, warehouse, _ = lane_inputs(spark)
    more = header.where("DeliveryDocument = '0080000001'").withColumn("DeliveryDocument", F.lit("0090000007"))
    header = header.unionByName(more)
    address = address.unionByName(address.where("AddressID = 'A'").withColumn("DeliveryDocument", F.lit("0090000007")))
    task = spark.createDataFrame([("W1", "0080000001", "10", "T1")], "EWMWarehouse string, EWMDelivery string, EWMDeliveryItem string, WarehouseTask string")
    item = spark.createDataFrame([("0080000001", "10")], "DeliveryDocument string, DeliveryDocumentItem string")
    tables = {"outbound_delivery_header": header, "outbound_delivery_address": address, "warehouse_task": task, "outbound_delivery_item": item}
    for batch, changed in (("b1", None), ("b2", [header.where("DeliveryDocument = '0090000007'").withColumn("DeliveryDocument", F.lit("90000007"))])):
        job = gold.GoldJob(spark, tables, str(tmp_path), batch, at("2024-02-01"), first_run=batch == "b1")
        for name, df in (("dim_location", location), ("dim_distance_matrix", lanes), ("dim_warehouse", warehouse)):
            job.replace(name, df)
        gold.build_facts(job, changed=changed)
    assert rows(gold.read_trips(job), "deliverydocument", "ingest_batch_id") == [("0080000001", "b1"), ("0090000007", "b2")]


def test_documents_with_the_same_last_digits_stay_apart(spark, rows):
    header, address, location, lanes, warehouse, dest = lane_inputs(spark)
    twin = dims.with_address(spark.createDataFrame([("0180000001", "SH", "T", "Elsewhere")], "DeliveryDocument string, PartnerFunction string, AddressID string, StreetName string"))
    task = spark.createDataFrame([("W1", "80000001", "10", "T1"), ("W1", "180000001", "10", "T2"), ("W1", "0180000001", "10", "T2")], "EWMWarehouse string, EWMDelivery string, EWMDeliveryItem string, WarehouseTask string")
    item = spark.createDataFrame([("0080000001", "10"), ("0180000001", "10")], "DeliveryDocument string, DeliveryDocumentItem string")
    trips = facts.task_trips(task, item, address.unionByName(twin), location, header, warehouse)
    assert trips.count() == 2 and trips.select("dest_location_id").distinct().count() == 2


def test_year_over_year_is_null_without_a_base(spark):
    trips = spark.createDataFrame([("r", "2023-01-05"), ("r", "2024-01-01"), ("r", "2024-01-31"), ("r", "2024-02-01")], "region string, day string")
    trips = trips.withColumn("ts", F.col("day").cast("timestamp"))
    got = kpis.monthly_kpis(trips, ["region"], "ts", {"trips": F.count(F.lit(1))}).orderBy("month").collect()
    assert [(r.value, r.yoy_change) for r in got] == [(1.0, None), (2.0, 1.0), (1.0, None)]


def test_rates_on_an_empty_fact(spark):
    empty = spark.createDataFrame([], "on_time_flag boolean")
    assert kpis.on_time_rate(empty).first()[0] is None
    assert coverage_summary(empty, F.lit("t"), n=F.lit(True)).first()[:] == ("t", 0)
