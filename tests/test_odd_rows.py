"""Queries against their SQL over rows that the test tables lack."""

import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F

from logilake.plans import facts

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def agrees(spark, tmp_path):
    """What differs between a query and its SQL over a table of some rows."""

    def check(name, table, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "rows"))
        [part] = (tmp_path / "rows").glob("*.parquet")
        part.rename(tmp_path / f"{table}.parquet")
        return differences(spark, connect(str(tmp_path)), str(tmp_path), name) is None

    return check


@pytest.mark.parametrize("name", ["cache_first_wins", "address_norm_hash"])
def test_documents_without_language_id_or_letters_stay(agrees, name):
    rows = [
        (1, "One Street", None, "s1", 10), (2, "one  street", "en", "s2", 11), (None, "Two Street", "en", "s3", 10),
        (3, "two street", "de", "s4", 10), (4, None, "en", "s5", 0), (5, "?!", "fr", "s6", 2), (6, "", None, "s7", 0),
    ]
    assert agrees(name, "documents", rows, DOCUMENTS)


def test_lanes_are_found_by_their_ids_then_without_prefixes(spark, rows):
    ids = "origin_location_id string, dest_location_id string"
    lanes = [
        ("a1", "b2", 5.0, None), ("a1", "b2", 7.0, 9.0), ("ewm:a1", "b2", 3.0, 1.0), ("c", "ewm:d", 2.0, 4.0), ("c", "ewm:d", 1.0, 4.0),
        ("ewm:c", "d", None, 2.0), ("ewm:ewm:c", "d", 8.0, 8.0), (None, "d", 6.0, 6.0), ("ewm:", "d", 6.5, None), ("n", "n", None, None),
    ]
    routes = [("a1", "b2"), ("ewm:a1", "ewm:b2"), ("c", "d"), ("ewm:c", "d"), ("ewm:ewm:c", "d"), (None, "d"), ("", "d"), ("n", "n"), ("x", "d")]
    table = spark.createDataFrame(lanes, f"{ids}, distance_km double, network_duration_min double")
    kept = spark.createDataFrame([(*r, 1) for r in routes], f"{ids}, last_trip_at int")
    found = facts.with_distances(kept, table, F.lit("now")).select("origin_location_id", "dest_location_id", "avg_distance_km", "avg_network_duration_min")
    assert rows(found) == sorted(
        [
            ("a1", "b2", 7.0, 9.0), ("ewm:a1", "ewm:b2", 3.0, 1.0), ("c", "d", None, 2.0), ("ewm:c", "d", None, 2.0), ("ewm:ewm:c", "d", 8.0, 8.0),
            (None, "d", None, None), ("", "d", 6.5, None), ("n", "n", None, None), ("x", "d", None, None),
        ],
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


def test_lane_summary_shuffles_lanes_once(spark, tmp_path):
    def stored(name, *columns):
        spark.range(3).selectExpr(*columns).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    here = "sha2('here 1', 256)"
    task = stored("task", "'1-1' WarehouseTask", "'W' EWMWarehouse", "'1' EWMDelivery", "'1' EWMDeliveryItem")
    item = stored("item", "'1' DeliveryDocument", "'1' DeliveryDocumentItem")
    address = stored("address", "'1' DeliveryDocument", "'SH' PartnerFunction", "'Here 1' address_raw")
    location = stored("location", f"{here} location_id", "'here 1' addr_norm", "'Here 1' address_raw", "'here 1' addr_norm_ascii")
    lanes = stored("lanes", "'W' origin_location_id", f"{here} dest_location_id", "1.0D distance_km", "double(id) network_duration_min")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        routes = facts.routes_summary(task, item, address, location, None, lanes, F.lit("now"))
        [row] = routes.collect()
        plan = routes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (row.origin_location_id, row.avg_distance_km, row.avg_network_duration_min) == ("ewm:W", 1.0, 0.0)
    # Of lanes: the trips by theirs, then the routes and the lanes by ids without prefixes; each once.
    shuffles = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert len([s for s in shuffles if s.count("location_id") == 2]) == 3
