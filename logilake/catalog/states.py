"""Queries over table states by partition, maintained aggregates and observed row counts."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logilake.catalog import adapters as a
from logilake.catalog.adapters import Tables, at, ntz, ts
from logilake.catalog.expressions import _SCD2_SQL, _documents, _latest_priority, _merge_sql, _part_halves
from logilake.catalog.registry import query
from logilake.functions import dates
from logilake.operators import maintained as m
from logilake.plans import gold, silver
from logilake.session import work_dir
from logilake.sources import partitions
from logilake.sources.entities import ENTITIES
from logilake.streaming import intake


@query("merge_partitions", _merge_sql("coalesce(t.lo, s.lo)"))
def merge_partitions(t: Tables) -> DataFrame:
    """Two batches of part totals in a state of 64 partitions; the first creation stays."""
    base, layout = work_dir(t.spark, "parts"), partitions.Layout(("l_partkey",), 64)
    for batch, part in zip(("b1", "b2"), _part_halves(t), strict=True):
        partitions.merge_batch(t.spark, part, base, layout, batch, first_run=batch == "b1", preserve=("created_at",))
    return partitions.read_state(t.spark, base)


@query("scd2_current_part", _SCD2_SQL, ("start_date", "end_date"))
def scd2_current_part(t: Tables) -> DataFrame:
    """The batches of ``scd2_apply`` in a state of current rows and appended history."""
    base, layout = work_dir(t.spark, "versions"), partitions.Layout(("o_custkey",), 32)
    before = t.orders.filter(F.col("o_orderdate") < F.lit(a.CUT))
    for batch, part, day in (("b1", before, a.CUT), ("b2", t.orders, "2001-12-31")):
        partitions.version_batch(
            t.spark, _latest_priority(part), base, layout, batch, at(day), ["o_orderpriority"], first_run=batch == "b1"
        )
    return partitions.read_state(t.spark, base)


def _waves(t: Tables) -> list[DataFrame]:
    """Orders in three batches: the old ones, the new ones, and all urgent ones again at a higher price."""
    early, urgent = F.col("o_orderdate") < F.lit(a.CUT), F.col("o_orderpriority") == "1-URGENT"
    dearer = t.orders.filter(urgent).withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    return [t.orders.filter(early), t.orders.filter(~early), dearer]


_WAVES_SQL = "SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1000 ELSE o_totalprice END AS o_totalprice) FROM orders"


def _kept(t: Tables, groups: dict[str, Column], measures: dict[str, m.Measure]) -> str:
    """Orders merged batch by batch, and the aggregates refreshed after each."""
    orders, base = work_dir(t.spark, "orders"), work_dir(t.spark, "aggregates")
    layout = partitions.Layout(("o_orderkey",), span=60_000)
    for n, wave in enumerate(_waves(t)):
        partitions.merge_batch(t.spark, wave, orders, layout, f"b{n}", first_run=n == 0)
        m.refresh(t.spark, orders, base, groups, measures)
    return base


@query(
    "maintained_weekly_orders",
    f"""
    SELECT date_trunc('week', o_orderdate + INTERVAL 1 DAY) - INTERVAL 1 DAY AS week, count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS finished,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avg_price, max(o_orderkey) AS last_order
    FROM ({_WAVES_SQL}) GROUP BY 1
    """,
)
def maintained_weekly_orders(t: Tables) -> DataFrame:
    """Weekly figures kept up to date over three batches, of which the last changes orders of earlier ones."""
    week = F.to_timestamp(dates.week_start_sunday(ts("o_orderdate"))).cast("timestamp_ntz")
    measures = {
        "orders": m.counted("orders"),
        "finished": m.counted("finished", F.col("o_orderstatus") == "F"),
        "price": m.summed("price", F.col("o_totalprice").cast("decimal(18,2)")),
        "last_order": m.largest("last_order", F.col("o_orderkey")),
    }
    base = _kept(t, {"week": week}, measures)
    mean = F.col("price").cast("double") / F.col("orders")
    return m.figures(t.spark, base, ["week"], measures).withColumn("avg_price", mean).drop("price")


@query(
    "maintained_price_quantiles",
    f"""
    WITH o AS ({_WAVES_SQL})
    SELECT o_custkey, quantile_disc(o_totalprice, 0.5) AS median, quantile_disc(o_totalprice, 0.9) AS p90, TRUE AS in_bound FROM o GROUP BY o_custkey
    UNION ALL SELECT NULL, NULL, NULL, count(*) > 0 FROM o
    """,
)
def maintained_price_quantiles(t: Tables) -> DataFrame:
    """Quantiles per customer, exact from sketches kept over three batches, and whether the one of all orders is within
    the stated rank error."""
    price = F.col("o_totalprice")
    measures = {"median": m.quantile("prices", price, 0.5), "p90": m.quantile("prices", price, 0.9)}
    base = _kept(t, {"o_custkey": F.col("o_custkey")}, measures)
    by_customer = m.figures(t.spark, base, ["o_custkey"], measures).withColumn("in_bound", F.lit(True))
    of_all = m.figures(t.spark, base, [], measures).select(F.col("median").alias("q50"), F.col("p90").alias("q90"))
    dearer = F.when(F.col("o_orderpriority") == "1-URGENT", price + 1000).otherwise(price)
    # One row of quantiles beside every order: the rank of each is counted.
    ranked = t.orders.select(dearer.alias("price"), F.lit(1).alias("one")).join(of_all.withColumn("one", F.lit(1)), "one")
    inside = [_in_bound(q, rank) for q, rank in (("q50", 0.5), ("q90", 0.9))]
    none = F.lit(None).cast("double")
    check = ranked.agg((inside[0] & inside[1]).alias("in_bound"))
    return by_customer.unionByName(check.select(F.lit(None).cast("long").alias("o_custkey"), none.alias("median"), none.alias("p90"), "in_bound"))


def _in_bound(quantile: str, rank: float) -> Column:
    n = F.count(F.lit(1))
    below, upto = F.count_if(F.col("price") < F.col(quantile)) / n, F.count_if(F.col("price") <= F.col(quantile)) / n
    return (below <= rank + m.QUANTILE_ERROR) & (upto >= rank - m.QUANTILE_ERROR)


@query(
    "maintained_distinct_customers",
    f"""
    WITH o AS ({_WAVES_SQL}), c AS (SELECT o_orderpriority, date_trunc('month', o_orderdate) AS month, count(DISTINCT o_custkey) AS n FROM o GROUP BY ALL)
    SELECT o_orderpriority, month, n AS customers, TRUE AS in_bound FROM c WHERE n < 2000
    UNION ALL SELECT o_orderpriority, NULL, NULL, TRUE FROM o GROUP BY o_orderpriority
    """,
)
def maintained_distinct_customers(t: Tables) -> DataFrame:
    """Distinct customers per priority and month, exact, and whether those of whole priorities are within the bound."""
    month = F.date_trunc("month", ts("o_orderdate")).cast("timestamp_ntz")
    measures = {"customers": m.distinct("customers", F.col("o_custkey"))}
    base = _kept(t, {"o_orderpriority": F.col("o_orderpriority"), "month": month}, measures)
    fine = m.figures(t.spark, base, ["o_orderpriority", "month"], measures).where("customers < 2000")
    rolled = m.figures(t.spark, base, ["o_orderpriority"], measures)
    exact = t.orders.groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("n"))
    close = F.abs(F.col("customers") - F.col("n")) <= 4 * 2.0 ** (-m.DISTINCT_BITS / 2) * F.col("n")
    coarse = rolled.join(exact, "o_orderpriority").select(
        "o_orderpriority", F.lit(None).cast("timestamp_ntz").alias("month"), F.lit(None).cast("long").alias("customers"), close.alias("in_bound")
    )
    return fine.withColumn("in_bound", F.lit(True)).unionByName(coarse)


@query(
    "stream_keyed_facts",
    """
    WITH w AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderkey % 3 = 0 AS again FROM orders)
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS SalesOrder, CASE WHEN again THEN 'new ' ELSE '' END || o_custkey AS SoldToParty,
      CASE WHEN again THEN o_orderdate + INTERVAL 10 DAY ELSE o_orderdate END AS changed, CAST(again AS INTEGER) AS late_rows FROM w
    """,
)
def stream_keyed_facts(t: Tables) -> DataFrame:
    """Orders through the streaming intake into a keyed table: all, a third of them changed, and all of the first wave
    sent again. The replay adds no row, and what it has older than the table is logged as a reject."""
    entity = replace(
        ENTITIES["sales_order"], kind="keyed", version="LastChangeDate", rules={"LastChangeDate": ["odata_date"]}, required=["SalesOrder"]
    )
    raw, checkpoint = work_dir(t.spark, "raw"), work_dir(t.spark, "checkpoint")
    paths = silver.SilverPaths(work_dir(t.spark, "stream"))
    key, day = F.col("o_orderkey"), ts("o_orderdate")
    first = t.orders.select(
        a.padded(key, 10).alias("SalesOrder"), F.col("o_custkey").cast("string").alias("SoldToParty"), a.odata(day).alias("LastChangeDate")
    )
    second = t.orders.where(key % 3 == 0).select(
        a.padded(key, 10).alias("SalesOrder"), F.concat(F.lit("new "), F.col("o_custkey").cast("string")).alias("SoldToParty"),
        a.odata(day + F.expr("INTERVAL 10 DAYS")).alias("LastChangeDate"),
    )
    for wave in (first, second, first):
        _documents(wave, entity.name).write.mode("append").text(raw)
        intake.run_intake(t.spark, entity, raw, paths, checkpoint, lambda epoch: at(f"2024-01-{epoch + 1:02d}"))
    late = silver.read_rejects(t.spark, paths, entity).where(F.col("reject_reason") == silver.LATE)
    late = late.groupBy("SalesOrder").agg(F.count(F.lit(1)).cast("int").alias("late_rows"))
    # A key per third order: too many to send to every task, whatever the mostly empty reject files say of their size.
    rows = silver.read_entity(t.spark, paths, entity).join(late.hint("merge"), "SalesOrder", "left")
    return rows.select("SalesOrder", "SoldToParty", ntz("LastChangeDate").alias("changed"), F.coalesce("late_rows", F.lit(0)).alias("late_rows"))


@query(
    "gold_row_counts",
    """
    WITH k AS (SELECT count(*) FILTER (WHERE o_orderdate < TIMESTAMP '1998-07-01') AS early, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders)
    SELECT 'orders' AS table_name, 'b1' AS batch, early AS rows_in, early AS rows_written FROM k
    UNION ALL SELECT 'orders', 'b2', n - early, n FROM k
    UNION ALL SELECT 'customers', 'b1', NULL, customers FROM k UNION ALL SELECT 'customers', 'b2', NULL, customers FROM k
    """,
)
def gold_row_counts(t: Tables) -> DataFrame:
    """Rows per table and batch as they were observed while writing; every part of the state is touched."""
    base = work_dir(t.spark, "gold")
    early = F.col("o_orderdate") < F.lit(a.CUT)
    for batch, part in (("b1", t.orders.filter(early)), ("b2", t.orders.filter(~early))):
        job = gold.GoldJob(t.spark, {}, base, batch, at("2024-01-01"), first_run=batch == "b1")
        job.merge_parts("orders", part.select("o_orderkey", "o_orderdate"), partitions.Layout(("o_orderkey",), 4))
        job.replace("customers", t.orders.select("o_custkey").distinct())
    return job.row_log().select("table_name", F.col("ingest_batch_id").alias("batch"), "rows_in", "rows_written")
