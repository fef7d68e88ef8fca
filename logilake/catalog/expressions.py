"""Queries over scalar expressions, quality rules, intake and table states."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logilake.catalog import adapters as a
from logilake.catalog.adapters import Tables, at, ntz, ts
from logilake.catalog.registry import query
from logilake.functions import dates, text
from logilake.operators import dedupe, quality, state
from logilake.plans import silver
from logilake.session import work_dir
from logilake.sources import readers
from logilake.sources.entities import ENTITIES
from logilake.streaming import intake

# ---- dates and text ---------------------------------------------------------------------------------------------


@query(
    "odata_date_roundtrip",
    """
    SELECT o_orderkey,
      CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS odata_ts,
      o_orderdate AS any_ts
    FROM orders
    """,
)
def odata_date_roundtrip(t: Tables) -> DataFrame:
    """Orders in state P carry an ISO date, which only the fallback reads."""
    raw = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).otherwise(
        a.odata(ts("o_orderdate"))
    )
    rows = t.orders.select("o_orderkey", raw.alias("raw"))
    return rows.select(
        "o_orderkey",
        ntz(dates.odata_date(F.col("raw"))).alias("odata_ts"),
        ntz(dates.any_date(F.col("raw"))).alias("any_ts"),
    )


@query(
    "time_of_day_seconds",
    """
    WITH e AS (SELECT event_id, ts, event_type, CAST(event_id % 24 AS INTEGER) AS h, CAST(event_id % 60 AS INTEGER) AS m, CAST(user_id % 60 AS INTEGER) AS s FROM events),
    v AS (
      SELECT event_id, ts, CAST(CASE event_type
        WHEN 'click' THEN h * 3600 + m * 60 + s
        WHEN 'view' THEN h * 3600 + m * 60 + s
        WHEN 'purchase' THEN h * 3600 + m * 60
        WHEN 'signup' THEN m * 60
        ELSE 0 END AS BIGINT) AS seconds FROM e)
    SELECT event_id, seconds, CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_seconds(seconds) AS at_time FROM v
    """,
)
def time_of_day_seconds(t: Tables) -> DataFrame:
    h, m, s = (F.col("event_id") % 24), (F.col("event_id") % 60), (F.col("user_id") % 60)
    raw = (
        F.when(F.col("event_type") == "click", F.format_string("PT%dH%02dM%02dS", h, m, s))
        .when(F.col("event_type") == "view", F.format_string("%02d:%02d:%02d", h, m, s))
        .when(F.col("event_type") == "purchase", F.format_string("%d:%02d", h, m))
        .when(F.col("event_type") == "signup", F.format_string("PT%dM", m))
        .otherwise("noon")
    )
    day = F.to_date("ts").cast("timestamp")
    rows = t.events.select("event_id", day.alias("day"), dates.seconds_of_day(raw).alias("seconds"))
    return rows.select(
        "event_id", "seconds", ntz(dates.add_seconds(F.col("day"), F.col("seconds"))).alias("at_time")
    )


_NORM_SQL = "trim(regexp_replace(regexp_replace(lower(strip_accents(replace(text, 'ß', 'ss'))), '[^a-z0-9\\s\\-,]', ' ', 'g'), '\\s+', ' ', 'g'))"
_LOOSE_SQL = "trim(regexp_replace(regexp_replace(lower(strip_accents(replace(text, 'ß', 'ss'))), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def _or_empty(norm: Column, value: Column) -> Column:
    """The empty normal form of a text without letters or digits; only a missing text has none."""
    return F.coalesce(norm, F.when(value.isNotNull(), F.lit("")))


@query(
    "address_norm_hash",
    f"""
    WITH n AS (SELECT doc_id, {_NORM_SQL} AS norm, {_LOOSE_SQL} AS loose FROM documents)
    SELECT doc_id, length(norm) AS norm_length, sha256(norm) AS norm_hash, sha256(loose) AS loose_hash FROM n
    """,
)
def address_norm_hash(t: Tables) -> DataFrame:
    """The address normaliser over whole multilingual texts."""
    # The file has one row group: the rows are spread before the costly part, and both forms share the spelling.
    spelled = t.documents.select("doc_id", "text").repartition("doc_id").select("doc_id", text.to_ascii(F.lower("text")).alias("spelled"))
    norm, loose = text.normalise_ascii(F.col("spelled")), text.normalise_ascii(F.col("spelled"), keep_punctuation=False)
    rows = spelled.select("doc_id", *[_or_empty(form, F.col("spelled")).alias(name) for name, form in (("norm", norm), ("loose", loose))])
    return rows.select(
        "doc_id",
        F.length("norm").cast("bigint").alias("norm_length"),
        text.address_hash(F.col("norm")).alias("norm_hash"),
        text.address_hash(F.col("loose")).alias("loose_hash"),
    )


# Places in several scripts and their normal forms.
PLACES = [("Αθήνα", "athina"), ("Москва", "moskva"), ("上海", "上海"), ("北京", "北京"), ("Hà Nội", "ha noi"), ("Київ", "kiiv"), ("서울", "서울")]
_PLACE_ROWS = ", ".join(f"({i}, '{norm}')" for i, (_, norm) in enumerate(PLACES))


@query(
    "address_scripts",
    f"""
    WITH p(i, norm) AS (VALUES {_PLACE_ROWS})
    SELECT c_custkey, norm || ' ' || c_custkey AS addr_norm, sha256(norm || ' ' || c_custkey) AS addr_hash FROM customer JOIN p ON i = c_custkey % {len(PLACES)}
    """,
)
def address_scripts(t: Tables) -> DataFrame:
    """Greek, Cyrillic, Chinese and Korean places: different ones keep different hashes."""
    city = F.element_at(F.array(*[F.lit(raw) for raw, _ in PLACES]), (F.col("c_custkey") % len(PLACES) + 1).cast("int"))
    norm = text.normalise_address(F.concat(city, F.lit("  #"), F.col("c_custkey").cast("string")))
    rows = t.customer.select("c_custkey", norm.alias("addr_norm"))
    return rows.withColumn("addr_hash", text.address_hash(F.col("addr_norm")))


@query(
    "party_and_key_cleanup",
    """
    SELECT c_custkey, trim(lower(c_name)) || ' ' || lower(c_mktsegment) AS party,
      '99' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS doc_number, CAST(c_nationkey AS INTEGER) AS item_no,
      CAST(c_custkey AS VARCHAR) AS bare_key,
      CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS segment
    FROM customer
    """,
)
def party_and_key_cleanup(t: Tables) -> DataFrame:
    c = F.col
    return t.customer.select(
        "c_custkey",
        F.lower(text.join_words(c("c_name"), c("c_mktsegment"))).alias("party"),
        text.document_number(F.concat(F.lit("0099"), a.padded(c("c_custkey"), 8))).alias("doc_number"),
        text.item_number(a.padded(c("c_nationkey"), 6)).alias("item_no"),
        text.strip_prefix(F.concat(F.lit("ewm:"), c("c_custkey").cast("string")), "ewm:").alias("bare_key"),
        text.blank_to_null(F.when(c("c_mktsegment") == "BUILDING", "").otherwise(c("c_mktsegment"))).alias("segment"),
    )


# ---- quality ----------------------------------------------------------------------------------------------------

_RAW_SQL = """
    raw AS (
      SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS SalesOrder, o_custkey, o_orderdate,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
        o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' AS no_party,
        o_orderpriority = '5-LOW' AND o_orderstatus = 'F' AS low,
        o_orderpriority = '4-NOT SPECIFIED' AS no_number,
        o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AS negative
      FROM orders),
    judged AS (
      SELECT *, CASE WHEN no_party THEN 'missing_required'
        WHEN low THEN 'dq_SalesOrderDate_odata_date,dq_TotalNetAmount_non_negative'
        WHEN no_number THEN 'dq_TotalNetAmount_numeric'
        WHEN negative THEN 'dq_TotalNetAmount_non_negative' END AS reject_reason
      FROM raw)
"""
_VALID_SQL = f"""
    WITH {_RAW_SQL}
    SELECT SalesOrder, CAST(o_custkey AS VARCHAR) AS SoldToParty, o_orderdate AS SalesOrderDate,
      CAST(amount AS DOUBLE) AS TotalNetAmount
    FROM judged WHERE reject_reason IS NULL
"""
# The entity itself requires its key only, so a blank party is no reason to reject.
_FACT_SQL = f"""
    WITH {_RAW_SQL}
    SELECT SalesOrder, CASE WHEN no_party THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS SoldToParty,
      o_orderdate AS SalesOrderDate, CAST(amount AS DOUBLE) AS TotalNetAmount
    FROM judged WHERE reject_reason IS NULL OR reject_reason = 'missing_required'
"""
_REJECT_SQL = f"""
    WITH {_RAW_SQL}
    SELECT SalesOrder,
      CASE WHEN no_party THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS SoldToParty,
      CASE WHEN low THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '/Date(' || epoch_ms(o_orderdate) || ')/' END AS SalesOrderDate,
      CASE WHEN no_number THEN 'n/a' WHEN negative OR low THEN '-' || amount ELSE amount END AS TotalNetAmount,
      reject_reason
    FROM judged WHERE reject_reason IS NOT NULL
"""


def _judge(t: Tables) -> quality.Split:
    records = a.raw_sales_orders(t)
    present = quality.validate_required(records, ["SoldToParty"])
    ruled = quality.apply_quality(present.valid, a.SALES_ORDER_RULES)
    return quality.Split(ruled.valid, present.reject.unionByName(ruled.reject))


@query("dq_valid", _VALID_SQL)
def dq_valid(t: Tables) -> DataFrame:
    return _judge(t).valid.withColumn("SalesOrderDate", ntz("SalesOrderDate"))


@query("dq_reject_reasons", _REJECT_SQL)
def dq_reject_reasons(t: Tables) -> DataFrame:
    return _judge(t).reject


@query(
    "dq_batch_log",
    f"""
    WITH {_RAW_SQL}
    SELECT 'b1' AS batch_id, TIMESTAMP '2024-01-01 00:00:00' AS timestamp,
      CAST(count(*) FILTER (WHERE reject_reason IS NULL) AS INTEGER) AS records_processed,
      CAST(count(*) FILTER (WHERE reject_reason IS NOT NULL) AS INTEGER) AS records_rejected,
      'success' AS status, 'sales_order' AS job_name
    FROM judged
    """,
)
def dq_batch_log(t: Tables) -> DataFrame:
    judged = quality.classify(a.raw_sales_orders(t), ["SoldToParty"], a.SALES_ORDER_RULES)
    counts = judged.agg(*quality.batch_counts(judged))
    log = quality.batch_log_row(counts, "b1", "sales_order", "success", at("2024-01-01"))
    return log.withColumn("timestamp", ntz("timestamp"))


# ---- raw documents ----------------------------------------------------------------------------------------------


RECORDS_PER_DOCUMENT = 7


def _documents(records: DataFrame, entity: str) -> DataFrame:
    """JSON response documents of several records each, in the entity's envelope."""
    page = F.pmod(F.xxhash64(*records.columns), F.lit(1 << 40)) % F.greatest(F.lit(1), F.lit(records.count() // RECORDS_PER_DOCUMENT))
    body = F.col("records")
    for part in reversed(ENTITIES[entity].envelope.split(".")):
        body = F.struct(body.alias(part))
    pages = records.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*records.columns)).alias("records"))
    return pages.select(F.to_json(body).alias("value"))


@query(
    "envelope_flatten",
    """
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS DeliveryDocument,
      '/Date(' || epoch_ms(o_orderdate) || ')/' AS CreationDate FROM orders
    """,
)
def envelope_flatten(t: Tables) -> DataFrame:
    entity = ENTITIES["outbound_delivery_header"]
    records = t.orders.select(
        a.padded(F.col("o_orderkey"), 10).alias("DeliveryDocument"), a.odata(ts("o_orderdate")).alias("CreationDate")
    )
    docs = _documents(records, entity.name).select(readers.parse_documents(F.col("value"), entity).alias("doc"))
    return readers.flatten_documents(docs.select("doc.*"), entity).select("DeliveryDocument", "CreationDate")


@query("silver_fact", _FACT_SQL)
def silver_fact(t: Tables) -> DataFrame:
    """Documents written as files, then one batch run of the sales order entity (which requires its key only)."""
    entity = replace(ENTITIES["sales_order"], partition_unit="year")
    raw = work_dir(t.spark, "raw")
    _documents(a.raw_sales_orders(t), entity.name).write.option("compression", "gzip").text(raw)
    paths = silver.SilverPaths(work_dir(t.spark, "silver"))
    silver.run_entity(t.spark, entity, raw, paths, "b1", at("2024-01-01"))
    rows = silver.read_entity(t.spark, paths, entity)
    return rows.select("SalesOrder", "SoldToParty", ntz("SalesOrderDate").alias("SalesOrderDate"), "TotalNetAmount")


def _order_columns(rows: DataFrame) -> DataFrame:
    return rows.select("SalesOrder", "SoldToParty", ntz("SalesOrderDate").alias("SalesOrderDate"), "TotalNetAmount")


@query("silver_fact_redelivered", _FACT_SQL)
def silver_fact_redelivered(t: Tables) -> DataFrame:
    """Every order in two files and in two batches, the second of them run twice."""
    entity = replace(ENTITIES["sales_order"], partition_unit="year")
    raw, paths = work_dir(t.spark, "raw"), silver.SilverPaths(work_dir(t.spark, "silver"))
    for _ in range(2):
        _documents(a.raw_sales_orders(t), entity.name).write.mode("append").text(raw)
    for batch in ("007", "8", "8"):
        silver.run_entity(t.spark, entity, raw, paths, batch, at("2024-01-01"))
    return _order_columns(silver.load(t.spark, paths, [entity])[entity.name])


def _run_stream(t: Tables) -> tuple:
    """Orders before the cut arrive first, the others next; a third run finds nothing new. A new checkpoint then
    reads everything again, and a batch run uses the same paths."""
    entity = replace(ENTITIES["sales_order"], partition_unit="year")
    raw = work_dir(t.spark, "raw")
    paths = silver.SilverPaths(work_dir(t.spark, "stream"))
    early = F.col("o_orderdate") < F.lit(a.CUT)
    first, second = work_dir(t.spark, "checkpoint"), work_dir(t.spark, "checkpoint")
    for part, checkpoint in ((t.orders.filter(early), first), (None, first), (t.orders.filter(~early), second)):
        if part is not None:
            wave = Tables(t.spark, t.dir)
            wave.orders = part
            _documents(a.raw_sales_orders(wave), entity.name).write.mode("append").text(raw)
        intake.run_intake(t.spark, entity, raw, paths, checkpoint, lambda epoch: at("2024-01-01"))
    silver.run_entity(t.spark, entity, raw, paths, "batch", at("2024-01-01"))
    return entity, paths


@query("stream_intake", _FACT_SQL)
def stream_intake(t: Tables) -> DataFrame:
    entity, paths = _run_stream(t)
    return _order_columns(intake.read_facts(t.spark, paths, entity))


@query(
    "stream_rejects_and_log",
    f"""
    WITH {_RAW_SQL},
    j AS (SELECT *, (reject_reason IS NULL OR reject_reason = 'missing_required') AS ok, o_orderdate < TIMESTAMP '{a.CUT}' AS early FROM judged)
    SELECT 'log' AS kind, CAST(count(*) FILTER (WHERE ok AND early) + 2 * count(*) FILTER (WHERE ok) AS BIGINT) AS good, CAST(count(*) FILTER (WHERE NOT ok AND early) + 2 * count(*) FILTER (WHERE NOT ok) AS BIGINT) AS bad FROM j
    UNION ALL SELECT 'rejects', CAST(0 AS BIGINT), CAST(count(*) FILTER (WHERE NOT ok AND early) + 2 * count(*) FILTER (WHERE NOT ok) AS BIGINT) FROM j
    """,
)
def stream_rejects_and_log(t: Tables) -> DataFrame:
    """Log and rejects of two checkpoints and a batch on the same paths: the first wave once, and all orders twice."""
    entity, paths = _run_stream(t)
    log = silver.read_log(t.spark, paths, entity).agg(
        F.lit("log").alias("kind"), F.sum("records_processed").alias("good"), F.sum("records_rejected").alias("bad")
    )
    rejects = silver.read_rejects(t.spark, paths, entity).agg(
        F.lit("rejects").alias("kind"), F.lit(0).cast("bigint").alias("good"), F.count(F.lit(1)).alias("bad")
    )
    return log.unionByName(rejects)


# ---- one row per group ------------------------------------------------------------------------------------------

_LINE_ORDER_SQL = """l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"""


@query(
    "dedupe_latest",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER_SQL}) = 1
    """,
)
def dedupe_latest(t: Tables) -> DataFrame:
    tiebreak = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    order = [F.desc("l_shipdate"), *[F.asc(c) for c in tiebreak]]
    latest = dedupe.latest_by(t.lineitem, ["l_orderkey", "l_linenumber"], order)
    return latest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


@query(
    "best_by_priority",
    """
    SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY
      CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0 WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 10 END,
      o_orderkey) = 1
    """,
)
def best_by_priority(t: Tables) -> DataFrame:
    rank = dedupe.code_rank(F.col("o_orderpriority"), [(("1-urgent", "2-high"), 0), (("3-medium",), 1)], 10)
    current = dedupe.current_first(F.col("o_orderstatus") == "O")
    best = dedupe.best_by_priority(t.orders, ["o_custkey"], current, [rank.asc(), F.asc("o_orderkey")])
    return best.select("o_custkey", "o_orderkey", "o_orderpriority")


@query(
    "top_activity_areas",
    """
    WITH c AS (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS rn FROM c)
    SELECT l_suppkey, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY rn) AS top_parts FROM r WHERE rn <= 5 GROUP BY l_suppkey
    """,
)
def top_activity_areas(t: Tables) -> DataFrame:
    tops = dedupe.top_k_per_group(t.lineitem, ["l_suppkey"], "l_partkey", 5, "top")
    joined = F.array_join(F.transform("top", lambda p: p.cast("string")), ",")
    return tops.select("l_suppkey", joined.alias("top_parts"))


@query(
    "top_addresses",
    """
    SELECT p_name, count(*) AS count FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE p_name IS NOT NULL AND length(p_name) > 0 GROUP BY p_name ORDER BY count(*) DESC, p_name LIMIT 20
    """,
)
def top_addresses(t: Tables) -> DataFrame:
    """Top-n report: the most shipped product names."""
    shipped = t.lineitem.select("l_partkey").join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return dedupe.top_n_values(shipped, "p_name", 20)


# ---- table states -----------------------------------------------------------------------------------------------


def _latest_priority(orders: DataFrame) -> DataFrame:
    latest = dedupe.latest_by(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return latest.select("o_custkey", "o_orderpriority", "o_orderstatus")


_SCD2_SQL = f"""
    WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{a.CUT}' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    new AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    b AS (SELECT n.o_custkey, o.o_custkey IS NULL AS fresh, o.o_orderpriority AS op, o.o_orderstatus AS os, n.o_orderpriority AS np, n.o_orderstatus AS ns,
            o.o_orderpriority IS NOT DISTINCT FROM n.o_orderpriority AS same
          FROM new n LEFT JOIN old o ON n.o_custkey = o.o_custkey)
    SELECT o_custkey, op AS o_orderpriority, os AS o_orderstatus, DATE '{a.CUT}' AS start_date, CAST(NULL AS DATE) AS end_date, TRUE AS is_current FROM b WHERE NOT fresh AND same
    UNION ALL SELECT o_custkey, op, os, DATE '{a.CUT}', DATE '2001-12-30', FALSE FROM b WHERE NOT fresh AND NOT same
    UNION ALL SELECT o_custkey, np, ns, DATE '2001-12-31', NULL, TRUE FROM b WHERE fresh OR NOT same
"""


@query("scd2_apply", _SCD2_SQL, ("start_date", "end_date"))
def scd2_apply(t: Tables) -> DataFrame:
    """Customers with the priority of their latest order: as of the cut, then over all orders."""
    before = t.orders.filter(F.col("o_orderdate") < F.lit(a.CUT))
    first = state.scd2_apply(None, _latest_priority(before), ["o_custkey"], at(a.CUT), ["o_orderpriority"])
    return state.scd2_apply(first, _latest_priority(t.orders), ["o_custkey"], at("2001-12-31"), ["o_orderpriority"])


@query("scd2_late_batch", _SCD2_SQL, ("start_date", "end_date"))
def scd2_late_batch(t: Tables) -> DataFrame:
    """The two batches of ``scd2_apply`` in the wrong order, from an empty start: the late one takes its place."""
    before = t.orders.filter(F.col("o_orderdate") < F.lit(a.CUT))
    late = state.scd2_apply(None, _latest_priority(t.orders), ["o_custkey"], at("2001-12-31"), ["o_orderpriority"])
    state_now = state.scd2_apply(late, _latest_priority(before), ["o_custkey"], at(a.CUT), ["o_orderpriority"], late="insert")
    # Applied in order, a value that stays the same is one version; here the later row tells it again.
    again = F.lag("o_orderpriority").over(Window.partitionBy("o_custkey").orderBy("start_date"))
    told = state_now.withColumn("_again", again.eqNullSafe(F.col("o_orderpriority")) & F.col("is_current"))
    following = F.lead("_again").over(Window.partitionBy("o_custkey").orderBy("start_date"))
    merged = told.withColumn("_open", F.coalesce(following, F.lit(False))).filter("NOT _again")
    return merged.select(
        "o_custkey", "o_orderpriority", "o_orderstatus", "start_date",
        F.when(~F.col("_open"), F.col("end_date")).alias("end_date"), (F.col("is_current") | F.col("_open")).alias("is_current"),
    )


@query(
    "stream_scd2",
    """
    WITH v AS (SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority FROM orders),
    old AS (SELECT * FROM v WHERE o_orderdate < TIMESTAMP '1998-07-01' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    new AS (SELECT * FROM v WHERE o_orderdate >= TIMESTAMP '1998-07-01' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    b AS (SELECT coalesce(n.o_custkey, o.o_custkey) AS k, o.o_custkey AS ok, n.o_custkey AS nk, o.o_orderpriority AS op, n.o_orderpriority AS np
          FROM new n FULL OUTER JOIN old o ON n.o_custkey = o.o_custkey)
    SELECT 'A' || k AS AddressID, op AS Supplier, DATE '2024-01-01' AS start_date, CASE WHEN nk IS NOT NULL AND op <> np THEN DATE '2024-01-01' END AS end_date, nk IS NULL OR op = np AS is_current FROM b WHERE ok IS NOT NULL
    UNION ALL SELECT 'A' || k, np, DATE '2024-01-02', NULL, TRUE FROM b WHERE nk IS NOT NULL AND (ok IS NULL OR op <> np)
    """,
    ("start_date", "end_date"),
)
def stream_scd2(t: Tables) -> DataFrame:
    """Partner documents in two waves through the streaming intake into a versioned table."""
    # One compared column, so that the sequence number alone starts no version.
    entity = replace(ENTITIES["outbound_delivery_partner"], compare=["Supplier"])
    raw, checkpoint = work_dir(t.spark, "raw"), work_dir(t.spark, "checkpoint")
    paths = silver.SilverPaths(work_dir(t.spark, "stream"))
    early = F.col("o_orderdate") < F.lit(a.CUT)
    for part in (t.orders.filter(early), t.orders.filter(~early)):
        records = part.select(
            F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("SDDocument"),
            F.lit("SH").alias("PartnerFunction"),
            F.col("o_orderpriority").alias("Supplier"),
            F.concat(F.lit("A"), F.col("o_custkey").cast("string")).alias("AddressID"),
            # Carries the order of changes within a batch.
            F.concat_ws("/", F.date_format("o_orderdate", "yyyyMMdd"), a.padded(F.col("o_orderkey"), 12)).alias("ContactPerson"),
        )
        _documents(records, entity.name).write.mode("append").text(raw)
        intake.run_intake(
            t.spark,
            entity,
            raw,
            paths,
            checkpoint,
            lambda epoch: at(f"2024-01-{epoch + 1:02d}"),
            [F.desc("ContactPerson")],
        )
    rows = intake.read_state(t.spark, paths, entity)
    return rows.select("AddressID", "Supplier", "start_date", "end_date", "is_current")


def _part_totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("l_partkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total_qty"),
        F.max("l_shipdate").alias("last_ship"),
        F.min("l_shipdate").alias("created_at"),
    )


def _part_halves(t: Tables) -> tuple[DataFrame, DataFrame]:
    early = F.col("l_shipdate") < F.lit(a.CUT)
    return _part_totals(t.lineitem.filter(early)), _part_totals(t.lineitem.filter(~early))


def _merge_sql(created: str) -> str:
    return f"""
    WITH p AS (SELECT l_partkey, l_shipdate < TIMESTAMP '{a.CUT}' AS early, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q, max(l_shipdate) AS hi, min(l_shipdate) AS lo FROM lineitem GROUP BY ALL)
    SELECT coalesce(s.l_partkey, t.l_partkey) AS l_partkey, coalesce(s.q, t.q) AS total_qty, coalesce(s.hi, t.hi) AS last_ship, {created} AS created_at
    FROM (SELECT * FROM p WHERE early) t FULL OUTER JOIN (SELECT * FROM p WHERE NOT early) s ON s.l_partkey = t.l_partkey
    """


@query("merge_upsert", _merge_sql("coalesce(s.lo, t.lo)"))
def merge_upsert(t: Tables) -> DataFrame:
    target, source = _part_halves(t)
    return state.merge_upsert(target, source, ["l_partkey"])


@query("merge_preserve_created", _merge_sql("coalesce(t.lo, s.lo)"))
def merge_preserve_created(t: Tables) -> DataFrame:
    target, source = _part_halves(t)
    return state.merge_upsert(target, source, ["l_partkey"], preserve=("created_at",))


@query(
    "cache_first_wins",
    f"""
    WITH h AS (SELECT doc_id, source, sha256({_NORM_SQL}) AS addr_hash FROM documents)
    SELECT addr_hash, doc_id, source FROM h QUALIFY row_number() OVER (PARTITION BY addr_hash ORDER BY doc_id) = 1
    """,
)
def cache_first_wins(t: Tables) -> DataFrame:
    """English texts are in the cache, the others come new; the earliest text of each normal form stays."""
    norm = _or_empty(text.normalise_address(F.col("text")), F.col("text"))
    rows = t.documents.select("doc_id", "source", "lang", text.address_hash(norm).alias("addr_hash"))
    english = F.col("lang").eqNullSafe("en")
    order = [F.asc_nulls_last("doc_id"), F.asc_nulls_last("source")]
    merged = state.first_wins_upsert(rows.filter(english), rows.filter(~english), "addr_hash", order)
    return merged.select("addr_hash", "doc_id", "source")


@query(
    "retention_split",
    """
    SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'purge' WHEN ts < TIMESTAMP '2024-01-24' THEN 'archive' ELSE 'active' END AS retention
    FROM events
    """,
)
def retention_split(t: Tables) -> DataFrame:
    parts = state.retention_split(t.events, "ts", F.lit("2024-01-31").cast("timestamp_ntz"), 7, 21)
    labelled = [df.select("event_id", F.lit(name).alias("retention")) for name, df in parts._asdict().items()]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])
