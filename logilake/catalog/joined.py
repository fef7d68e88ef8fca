"""Queries over the join operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logilake.catalog import adapters as a
from logilake.catalog.adapters import Tables
from logilake.catalog.registry import query
from logilake.functions import text
from logilake.operators import joins
from logilake.operators.schema import join_disambiguated
from logilake.plans import facts

_SPELL_SQL = """
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN n_name WHEN 'BUILDING' THEN lower(n_name)
      WHEN 'FURNITURE' THEN '  ' || replace(n_name, '_', ' ') || ' ' WHEN 'HOUSEHOLD' THEN replace(n_name, 'NATION', 'Nâtïön')
      ELSE 'unknown' END
"""


@query(
    "cascade_lookup",
    f"""
    WITH s AS (SELECT c_custkey, {_SPELL_SQL} AS spelled FROM customer JOIN nation ON c_nationkey = n_nationkey),
    n AS (SELECT c_custkey, spelled, nullif(trim(regexp_replace(regexp_replace(lower(strip_accents(spelled)), '[^a-z0-9\\s\\-,]', ' ', 'g'), '\\s+', ' ', 'g')), '') AS norm FROM s)
    SELECT n.c_custkey, coalesce(s1.n_nationkey, s2.n_nationkey, s3.n_nationkey, -1) AS nationkey,
      CASE WHEN s1.n_nationkey IS NOT NULL THEN 1 WHEN s2.n_nationkey IS NOT NULL THEN 2 WHEN s3.n_nationkey IS NOT NULL THEN 3 ELSE 0 END AS stage
    FROM n LEFT JOIN nation s1 ON spelled = s1.n_name LEFT JOIN nation s2 ON spelled = lower(s2.n_name)
    LEFT JOIN nation s3 ON norm = replace(lower(s3.n_name), '_', ' ')
    """,
)
def cascade_lookup(t: Tables) -> DataFrame:
    """Customers whose country is spelled in five ways: exactly, in lower case, spaced out, accented, or not at all."""
    name = F.col("n_name")
    spelled = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", name)
        .when(F.col("c_mktsegment") == "BUILDING", F.lower(name))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("  "), F.replace(name, F.lit("_"), F.lit(" ")), F.lit(" ")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.replace(name, F.lit("NATION"), F.lit("Nâtïön")))
        .otherwise("unknown")
    )
    left = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", spelled.alias("spelled")
    )
    raw = F.col("spelled")
    stages = [
        (raw, F.col("n_name")),
        (raw, F.lower("n_name")),
        (text.normalise_address(raw), text.normalise_address(F.col("n_name"))),
    ]
    found = joins.cascade_lookup(left, t.nation, ["spelled"], stages, "n_nationkey", "nationkey", "stage")
    return found.select("c_custkey", F.coalesce("nationkey", F.lit(-1)).alias("nationkey"), F.coalesce("stage", F.lit(0)).alias("stage"))


@query(
    "best_coverage_join",
    "SELECT l_orderkey, l_linenumber, l_suppkey, o_custkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def best_coverage_join(t: Tables) -> DataFrame:
    """Two thirds of the lines have padded numbers, which never equal plain ones as text; the rest match as text only."""
    key = F.col("l_orderkey")
    odd = key % 3 == 0
    doc = F.when(odd, F.concat(F.lit("x-"), key.cast("string"))).otherwise(a.padded(key, 10))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", doc.alias("doc"))
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("x-"), F.col("o_orderkey").cast("string")))
    orders = t.orders.select(F.coalesce(name, F.concat(F.lit(" "), F.col("o_orderkey").cast("string"))).alias("order_no"), "o_custkey", "o_orderdate")
    as_text = [(F.col("doc"), F.col("order_no"))]
    numeric = [(text.to_integer(F.col("doc")), text.to_integer(F.col("order_no")))]
    joined = joins.first_match_join(lines, orders, [as_text, numeric], "inner")
    return joined.select("l_orderkey", "l_linenumber", "l_suppkey", "o_custkey", "o_orderdate")


@query(
    "null_safe_item_join",
    """
    WITH l AS (SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS item FROM lineitem),
    m AS (SELECT l_orderkey AS k, item AS i, min(l_partkey) AS first_part FROM l GROUP BY ALL)
    SELECT l_orderkey, coalesce(item, 0) AS item, l_partkey, first_part FROM l JOIN m ON l_orderkey = k AND item IS NOT DISTINCT FROM i
    """,
)
def null_safe_item_join(t: Tables) -> DataFrame:
    """Returned lines have no item number and match the document's null item."""
    lines = t.lineitem.select("l_orderkey", F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")).alias("item"), "l_partkey")
    items = lines.groupBy("l_orderkey", "item").agg(F.min("l_partkey").alias("first_part"))
    joined = join_disambiguated(
        lines, items, lambda x, y: (x["l_orderkey"] == y["l_orderkey"]) & x["item"].eqNullSafe(y["item"]), "inner", "m"
    )
    return joined.select("l_orderkey", F.coalesce("item", F.lit(0)).alias("item"), "l_partkey", "first_part")


@query(
    "tolerance_join",
    "SELECT c_custkey, s_suppkey, c_acctbal, s_acctbal FROM customer JOIN supplier ON abs(c_acctbal - s_acctbal) < 0.5",
)
def tolerance_join(t: Tables) -> DataFrame:
    pair = [(F.col("c_acctbal"), F.col("s_acctbal"))]
    near = joins.tolerance_join(t.customer.select("c_custkey", "c_acctbal"), t.supplier.select("s_suppkey", "s_acctbal"), pair, 0.5)
    return near.select("c_custkey", "s_suppkey", "c_acctbal", "s_acctbal")


@query(
    "tolerance_lookup",
    f"""
    WITH {a.SQL_PLACES}
    SELECT c.key AS c_custkey, coalesce(min(s.key), -1) AS s_suppkey FROM (SELECT * FROM addr WHERE side = 'c') c
    LEFT JOIN (SELECT * FROM addr WHERE side = 's') s ON abs(c.lat - s.lat) < 0.035 AND abs(c.lon - s.lon) < 0.035
    GROUP BY c.key
    """,
)
def tolerance_lookup(t: Tables) -> DataFrame:
    """First supplier near each customer, by latitude and longitude."""
    suppliers = a.supplier_places(t).select(F.col("key").alias("s_suppkey"), "lat", "lon")
    here = [(F.col("lat"), F.col("lat")), (F.col("lon"), F.col("lon"))]
    found = joins.tolerance_lookup(a.customer_places(t), suppliers, here, 0.035, "s_suppkey")
    return found.select(F.col("key").alias("c_custkey"), F.coalesce("s_suppkey", F.lit(-1)).alias("s_suppkey"))


@query(
    "key_normalised_lookup",
    "SELECT l_orderkey, l_linenumber, s_name, s_nationkey FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey",
)
def key_normalised_lookup(t: Tables) -> DataFrame:
    """Codes that differ in case and blanks on the two sides."""
    code = F.concat(F.lit(" "), F.lower(a.warehouse_code(F.col("l_suppkey"))), F.lit(" "))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", text.lower_trim(code).alias("code"))
    suppliers = t.supplier.select(text.lower_trim(a.warehouse_code(F.col("s_suppkey"))).alias("code"), "s_name", "s_nationkey")
    return lines.join(suppliers, "code", "left").drop("code")


@query(
    "small_dimension_lookup",
    """
    SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def small_dimension_lookup(t: Tables) -> DataFrame:
    """Left lookups without a hint: Spark broadcasts a side when its size is below the threshold, and sorts else."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    joined = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", "n_name", "r_name")


@query(
    "anti_unmatched",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01')",
)
def anti_unmatched(t: Tables) -> DataFrame:
    recent = t.orders.filter(F.col("o_orderdate") >= F.lit("2001-01-01"))
    unmatched = t.customer.join(recent, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    return unmatched.select("c_custkey", "c_name")


@query(
    "shortest_lane",
    """
    WITH l AS (SELECT s_nationkey AS o, c_nationkey AS d, date_diff('minute', o_orderdate, l_shipdate) AS m, l_quantity AS q
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey)
    SELECT CAST(o AS VARCHAR) AS origin_location_id, CAST(d AS VARCHAR) AS dest_location_id, q AS distance_km, CAST(m AS DOUBLE) AS network_duration_min
    FROM l QUALIFY row_number() OVER (PARTITION BY o, d ORDER BY m NULLS LAST, q) = 1
    """,
)
def shortest_lane(t: Tables) -> DataFrame:
    """Quickest line item of each pair of countries."""
    minutes = (F.unix_timestamp(a.ts("l_shipdate")) - F.unix_timestamp(a.ts("o_orderdate"))) / 60.0
    lanes = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("s_nationkey").cast("string").alias("origin_location_id"),
            F.col("c_nationkey").cast("string").alias("dest_location_id"),
            F.col("l_quantity").alias("distance_km"),
            minutes.alias("network_duration_min"),
        )
    )
    return facts.shortest_lanes(lanes)
