"""Queries that write the test tables through the sinks and read them through the readers."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logilake.catalog import adapters as a
from logilake.catalog.adapters import Tables, at, ntz
from logilake.catalog.expressions import _documents, _part_halves
from logilake.catalog.registry import query
from logilake.operators import quality
from logilake.operators.schema import ensure_column
from logilake.plans import gold, silver
from logilake.session import work_dir
from logilake.sources import readers, sinks
from logilake.sources.entities import ENTITIES
from logilake.streaming import intake

ENTITY = replace(ENTITIES["sales_order"], partition_unit="year")


@query(
    "document_lineage",
    "SELECT count(*) AS records, CAST(3 AS BIGINT) AS files, CAST(0 AS BIGINT) AS without_file FROM orders",
)
def document_lineage(t: Tables) -> DataFrame:
    """Records of documents in three folders: each knows its file."""
    raw = work_dir(t.spark, "raw")
    for k in range(3):
        part = Tables(t.spark, t.dir)
        part.orders = t.orders.filter(F.col("o_orderkey") % 3 == k)
        _documents(a.raw_sales_orders(part), ENTITY.name).write.text(f"{raw}/third{k}")
    flat = readers.flatten_documents(readers.read_documents(t.spark, f"{raw}/*", ENTITY), ENTITY)
    return flat.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct(F.regexp_extract(readers.SOURCE_FILE, "(.*)/", 1)).alias("files"),
        F.count_if(F.col(readers.SOURCE_FILE).isNull()).alias("without_file"),
    )


@query("table_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def table_scan(t: Tables) -> DataFrame:
    """A table written and read again by the strict reader."""
    path = work_dir(t.spark, "table")
    t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment").write.parquet(path)
    return readers.read_table(t.spark, path)


@query(
    "tolerant_scan",
    """
    SELECT c_custkey AS key, c_name AS name, CAST(NULL AS INTEGER) AS nation, CAST(NULL AS VARCHAR) AS note FROM customer
    UNION ALL SELECT s_suppkey, NULL, CAST(s_nationkey AS INTEGER), NULL FROM supplier
    """,
)
def tolerant_scan(t: Tables) -> DataFrame:
    """Two tables with different columns, a missing one, and a catalog name that does not exist."""
    base = work_dir(t.spark, "tables")
    t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).write.parquet(f"{base}/c")
    suppliers = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").cast("int").alias("nation"))
    suppliers.write.parquet(f"{base}/s")
    assert readers.read_table_or_none(t.spark, f"{base}/none") is None
    by_path = readers.table_or_path(t.spark, "logi_no_such_table", f"{base}/s")
    united = readers.read_all(t.spark, f"{base}/c, {base}/none")
    return ensure_column(united.unionByName(by_path, allowMissingColumns=True), "note")


@query(
    "warehouse_map_csv",
    """
    SELECT 'WH' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS ewmwarehouse, s_name AS address_raw,
      CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey AS DOUBLE) / 4 END AS lat, CAST(s_nationkey AS DOUBLE) AS lon FROM supplier
    """,
)
def warehouse_map_csv(t: Tables) -> DataFrame:
    """A reference file with other headers, an unknown column and bad coordinates."""
    path = work_dir(t.spark, "csv")
    t.supplier.select(
        a.warehouse_code(F.col("s_suppkey")).alias("Warehouse"),
        F.col("s_name").alias("Address"),
        F.when(F.col("s_suppkey") % 4 == 0, "n/a").otherwise((F.col("s_suppkey") / 4).cast("string")).alias("Latitude"),
        F.col("s_nationkey").cast("string").alias("LNG"),
        F.lit("x").alias("junk"),
    ).write.option("header", True).csv(path)
    return readers.read_warehouse_map(t.spark, path)


_ISO_SQL = """
    WITH r AS (SELECT o_orderkey, o_orderdate, o_orderpriority = '5-LOW' AS bad, o_orderpriority = '4-NOT SPECIFIED' AS none FROM orders)
    SELECT o_orderkey, CASE WHEN NOT bad AND NOT none THEN o_orderdate END AS day, CASE WHEN bad THEN 'dq_day_iso_date' END AS reason FROM r
"""


@query("iso_date_rule", _ISO_SQL)
def iso_date_rule(t: Tables) -> DataFrame:
    """ISO dates, text that is none, and nulls, which pass; a rule that is not known is refused."""
    raw = (
        F.when(F.col("o_orderpriority") == "5-LOW", "soon")
        .when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .alias("day")
    )
    rules = {"day": ["iso_date"]}
    judged = quality.classify(t.orders.select("o_orderkey", raw), [], rules)
    try:
        quality.classify(judged, [], {"day": ["no_such_rule"]})
        raise AssertionError("an unknown rule was accepted")
    except ValueError:
        pass
    split = quality.split_classified(judged, rules)
    good = split.valid.select("o_orderkey", ntz("day").alias("day"), F.lit(None).cast("string").alias("reason"))
    bad = split.reject.select("o_orderkey", F.lit(None).cast("timestamp_ntz").alias("day"), F.col("reject_reason").alias("reason"))
    return good.unionByName(bad)


@query(
    "silver_rejects",
    """
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS SalesOrder, '042' AS reject_batch_id,
      CASE WHEN low THEN 'dq_SalesOrderDate_odata_date,dq_TotalNetAmount_non_negative' WHEN no_number THEN 'dq_TotalNetAmount_numeric' ELSE 'dq_TotalNetAmount_non_negative' END AS reject_reason
    FROM (SELECT o_orderkey, o_orderpriority = '5-LOW' AND o_orderstatus = 'F' AS low, o_orderpriority = '4-NOT SPECIFIED' AS no_number, o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AS negative FROM orders)
    WHERE low OR no_number OR negative
    """,
)
def silver_rejects(t: Tables) -> DataFrame:
    """Rejects of a batch that ran twice; its name reads back as it is."""
    raw, paths = work_dir(t.spark, "raw"), silver.SilverPaths(work_dir(t.spark, "silver"))
    _documents(a.raw_sales_orders(t), ENTITY.name).write.text(raw)
    for _ in range(2):
        silver.run_entity(t.spark, ENTITY, raw, paths, "042", at("2024-01-01"))
    return silver.read_rejects(t.spark, paths, ENTITY).select("SalesOrder", "reject_batch_id", "reject_reason")


@query(
    "stream_repeated_batch",
    """
    SELECT count(*) FILTER (WHERE NOT (low OR no_number OR negative)) AS facts, count(*) FILTER (WHERE low OR no_number OR negative) AS rejects, CAST(1 AS BIGINT) AS logged
    FROM (SELECT o_orderpriority = '5-LOW' AND o_orderstatus = 'F' AS low, o_orderpriority = '4-NOT SPECIFIED' AS no_number, o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AS negative FROM orders)
    """,
)
def stream_repeated_batch(t: Tables) -> DataFrame:
    """A micro-batch that is delivered twice counts once."""
    raw, paths = work_dir(t.spark, "raw"), silver.SilverPaths(work_dir(t.spark, "stream"))
    _documents(a.raw_sales_orders(t), ENTITY.name).write.text(raw)
    docs = readers.read_documents(t.spark, raw, ENTITY)
    for _ in range(2):
        intake.process_batch(docs, 0, ENTITY, paths, at("2024-01-01"))
    facts = t.spark.read.parquet(paths.table(ENTITY)).agg(F.count(F.lit(1)).alias("facts"))
    rejects = silver.read_rejects(t.spark, paths, ENTITY).agg(F.count(F.lit(1)).alias("rejects"))
    logged = silver.read_log(t.spark, paths, ENTITY).agg(F.count(F.lit(1)).alias("logged"))
    one = F.lit(1).alias("one")
    return facts.select("facts", one).join(rejects.select("rejects", one), "one").join(logged.select("logged", one), "one").drop("one")


@query(
    "registered_snapshot",
    f"""
    WITH p AS (SELECT l_partkey, l_shipdate < TIMESTAMP '{a.CUT}' AS early, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY ALL)
    SELECT coalesce(s.l_partkey, t.l_partkey) AS l_partkey, coalesce(s.q, t.q) AS total_qty FROM (SELECT * FROM p WHERE early) t FULL OUTER JOIN (SELECT * FROM p WHERE NOT early) s ON s.l_partkey = t.l_partkey
    """,
)
def registered_snapshot(t: Tables) -> DataFrame:
    """Two snapshots of a table, the second merged into the last one; the catalog's table shows it."""
    base, table = work_dir(t.spark, "snapshots"), "logi_part_totals"
    for batch, part in zip(("b1", "b2"), _part_halves(t), strict=True):
        gold.publish_merged(t.spark, part, base, ["l_partkey"], batch, table=table, first_run=batch == "b1")
    assert sinks.last_snapshot(t.spark, base).columns == t.spark.table(table).columns
    return t.spark.table(table).select("l_partkey", "total_qty")


@query(
    "dq_summary_sink",
    """
    SELECT b.id AS ingest_batch_id, 'day ' || b.id AS run_ts, (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FILTER (WHERE c_acctbal < 0) FROM customer) AS in_debt
    FROM (VALUES ('01'), ('02')) b(id)
    """,
)
def dq_summary_sink(t: Tables) -> DataFrame:
    """Coverage rows of two batches, the second logged twice."""
    base = work_dir(t.spark, "gold")
    for batch in ("01", "02", "02"):
        job = gold.GoldJob(t.spark, {}, base, batch, at("2024-01-01"))
        summary = quality.coverage_summary(t.customer, F.lit(f"day {batch}"), customers=F.lit(True), in_debt=F.col("c_acctbal") < 0)
        job.log("dim_customer", summary)
    return readers.read_table(t.spark, job.path("dim_customer_dq")).select("ingest_batch_id", "run_ts", "customers", "in_debt")
