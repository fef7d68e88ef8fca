"""Filter interaction audit: what each filter removes, alone and in every order of application.

The states of a pipeline of n filters are the subsets of filters applied so far; an edge adds one filter to a state.
What an edge removes depends on the state alone: the documents that fail the new filter and none of the state's. So

- documents are folded by Spark into counts per part and set of failed filters, at most 2^n rows per part;
- two passes over the lattice count the orders that reach a state (forward) and that leave it (backward);
- an edge lies on ``reaching[from] * leaving[to]`` orders: its removals, so weighted and summed per filter, are the
  filter's removals over all n! orders (n! times its Shapley value);
- the steps of every order are read from the same edges. No order is ever replayed over documents.

Filters here: A under 100 words; B 100 * distinct words < 80 * words; C 100 * capital letters A-Z > 10 * characters;
D any of ``#$%&*|``; E the text of a smaller doc_id, anywhere in the table. E finds the smallest id of each text by
its SHA-256, and rows find themselves there by (digest, id), so a text that fills a third of the table meets in no
task.

Defined cases: a null text is empty (no words, so B does not fail); a null or empty part is the empty string. A null
doc_id is neither smaller than another nor fails E, has no label, and counts. Rows that repeat id and text each count
and do not fail E by each other; a document is good or toxic if any of its rows in ``labels`` says 1. Words are
case-sensitive. Very long texts are read whole. An empty table has no parts and no rows. Further columns are not read.
"""

from __future__ import annotations

from itertools import permutations
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logilake.llm.common import query, table, whole_text

FILTERS = "ABCDE"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SIGNS = "[#$%&*|]"
BREAKS = "[\\x20\\x09-\\x0D]+"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _bit(name: str) -> int:
    return 1 << FILTERS.index(name)


class Lattice(NamedTuple):
    """Orders that reach and leave each state; states are bit sets."""

    reaching: list[int]
    leaving: list[int]

    def weight(self, state: int, added: int) -> int:
        """Orders that pass the edge which adds a filter to a state."""
        return self.reaching[state] * self.leaving[state | added]


def lattice(n: int) -> Lattice:
    full = (1 << n) - 1
    reaching, leaving = [0] * (full + 1), [0] * (full + 1)
    reaching[0] = leaving[full] = 1
    for state in range(full + 1):
        for i in range(n):
            if not state >> i & 1:
                reaching[state | 1 << i] += reaching[state]
    for state in range(full, -1, -1):
        for i in range(n):
            if state >> i & 1:
                leaving[state ^ 1 << i] += leaving[state]
    return Lattice(reaching, leaving)


def failures(docs: DataFrame, part: str = "lang") -> DataFrame:
    """doc_id, part and the bits of all filters that each row fails."""
    text = whole_text()
    rows = (
        docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text.alias("text"))
        .withColumn("words", F.array_remove(F.split("text", BREAKS), ""))
        .select(
            "doc_id",
            "part",
            F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
            F.size("words").cast("long").alias("n_words"),
            F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
            F.length("text").cast("long").alias("n_chars"),
            F.length(F.translate("text", CAPITALS, "")).cast("long").alias("n_others"),
            F.col("text").rlike(SIGNS).alias("signs"),
        )
    )
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    fails = {
        "A": F.col("n_words") < 100,
        "B": 100 * F.col("n_distinct") < 80 * F.col("n_words"),
        "C": 100 * (F.col("n_chars") - F.col("n_others")) > 10 * F.col("n_chars"),
        "D": F.col("signs"),
        "E": F.col("doc_id").isNotNull() & F.col("is_first").isNull(),
    }
    bits = sum((F.when(fails[f], _bit(f)).otherwise(0) for f in FILTERS), F.lit(0))
    return rows.join(first, ["digest", "doc_id"], "left").select("doc_id", "part", bits.alias("fails"))


def folded(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and set of failed filters: documents, good ones and toxic ones."""
    marks = (
        labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
        .groupBy("doc_id")
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    )
    return (
        rows.join(marks, "doc_id", "left")
        .groupBy("part", "fails")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    )


def _edges(parts: DataFrame) -> DataFrame:
    """Each part's edges of the lattice, n * 2^(n-1) of them, with the orders that pass them."""
    n, paths = len(FILTERS), lattice(len(FILTERS))
    reaching, leaving = (F.array(*map(F.lit, numbers)) for numbers in paths)
    states = parts.select("*", F.explode(F.sequence(F.lit(0), F.lit((1 << n) - 1))).alias("state"))
    added = states.select("*", F.posexplode(F.array(*map(F.lit, FILTERS))).alias("at", "filter"))
    edges = added.withColumn("bit", F.expr("shiftleft(1, at)")).where("state & bit = 0")
    orders = reaching[F.col("state")].cast("long") * leaving[F.col("state").bitwiseOR(F.col("bit"))]
    return edges.withColumn("orders", orders)


def _steps(spark: SparkSession) -> DataFrame:
    """Each order's steps as edges: n * n! fixed rows."""
    rows = [
        (order, k + 1, sum(map(_bit, order[:k])), f)
        for order in map("".join, permutations(FILTERS))
        for k, f in enumerate(order)
    ]
    return spark.createDataFrame(rows, "filter_order string, step int, state int, filter string")


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order and step."""
    masks = folded(failures(docs, part), labels)
    # A part has at most 2^n sets of failed filters, so it fits one row.
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("masks"))
    state, bit = F.col("state"), F.col("bit")

    def total(what: str, where) -> Column:
        hits = F.transform(F.filter("masks", where), lambda m: m[what])
        return F.aggregate(hits, F.lit(0).cast("long"), lambda a, b: a + b)

    def failing(m: Column) -> Column:
        return m["fails"].bitwiseAND(bit) != 0

    def removed(m: Column) -> Column:
        return failing(m) & (m["fails"].bitwiseAND(state) == 0)

    edges = _edges(parts).select(
        "part",
        "state",
        "filter",
        "orders",
        total("n", lambda m: m["fails"].bitwiseAND(state.bitwiseOR(bit)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda m: failing(m) & (m["fails"].bitwiseAND(state) != 0)).alias("redundant"),
        total("n", lambda m: m["fails"] == bit).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
    )
    shapley = F.sum(F.col("orders") * F.col("removed")).over(Window.partitionBy("part", "filter"))
    return (
        edges.withColumn("shapley", shapley)
        .join(F.broadcast(_steps(docs.sparkSession)), ["state", "filter"])  # 600 rows, whatever the data
        .select("part", "filter_order", "step", *COUNTS)
    )


SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), failing AS (
  SELECT doc_id, part, len(words) < 100 AS a,
         100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM texts
), marks AS (
  SELECT doc_id, coalesce(max(CASE WHEN quality = 1 THEN 1 END), 0) AS good, coalesce(max(CASE WHEN toxic = 1 THEN 1 END), 0) AS toxic
  FROM labels GROUP BY doc_id
), counted AS (
  SELECT part, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails, a::INT + b::INT + c::INT + d::INT + e::INT AS n_fails,
         count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failing LEFT JOIN marks USING (doc_id)
  GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT v.x || w.x || x.x || y.x || z.x AS filter_order
  FROM letters v JOIN letters w ON w.x <> v.x JOIN letters x ON x.x NOT IN (v.x, w.x)
  JOIN letters y ON y.x NOT IN (v.x, w.x, x.x) JOIN letters z ON z.x NOT IN (v.x, w.x, x.x, y.x)
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, string_split(substr(filter_order, 1, step - 1), '') AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), replayed AS (
  SELECT part, filter_order, step, f, n, good, toxic, n_fails, fails[f] AS failed,
         len(list_filter(before, lambda b: b <> '' AND fails[b])) > 0 AS removed_before
  FROM counted, steps
), summed AS (
  SELECT part, filter_order, step, f,
         coalesce(sum(n) FILTER (NOT removed_before AND NOT failed), 0) AS kept,
         coalesce(sum(n) FILTER (NOT removed_before AND failed), 0) AS removed,
         coalesce(sum(n) FILTER (removed_before AND failed), 0) AS redundant,
         coalesce(sum(n) FILTER (failed AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (NOT removed_before AND failed), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT removed_before AND failed), 0) AS toxic_lost
  FROM replayed GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM summed
"""


@query("op13_filter_audit", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters, in all orders, per language."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
