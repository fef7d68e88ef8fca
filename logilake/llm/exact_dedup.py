"""Exact deduplication of whole texts by skew-safe combining.

1. Locally: rows of a task with the same digest and the same full text fold into one (map-side aggregation).
2. Salted: the survivors meet by (digest, salt, full text); the salt is the task they come from, so the copies of
   a text that fills a third of the table are spread over ``SALTS`` groups.
3. Globally: the winners of the salts meet by (digest, full text), at most ``SALTS`` rows for each text.

Equality is always that of the full text; the digest only serves to find the place. Documents find their winner by
digest alone where a digest has a single text, and by digest and full text where it has several.

Defined cases: a null text equals the empty text. A null ``doc_id`` never stays while its group has another. Flags
speak of ids: if all ids of a group are null, ``keep_id`` is null and no row is flagged, and rows that repeat both id
and text are flagged alike. ``drop_copies`` speaks of rows: one row of every text stays, also if its ids are all null
or repeat; of rows that repeat both id and text it is the one whose other columns are largest as JSON. An empty table
gives an empty result. Only ``doc_id`` and ``text`` decide, so further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logilake.llm.common import query, staged, table, whole_text

SALTS = 16


def _rows(docs: DataFrame) -> DataFrame:
    text = whole_text()
    return docs.select("doc_id", text.alias("text"), F.sha2(text.cast("binary"), 256).alias("digest"))


def winners(rows: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per distinct text: digest, text, keep_id (largest id), group_size; partitioned by digest."""
    salted = (
        rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy("digest", "salt", "text")
        .agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))
    )
    return (
        salted.repartition("digest")
        .groupBy("digest", "text")
        .agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))
    )


def flag_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row per document with the document that stays for its text."""
    rows = _rows(docs)
    # How many texts a digest has: nearly always one. Its text then need not travel with the documents.
    groups = staged(
        winners(rows, salts)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")),
        "dedup-groups",
    )
    columns = ["doc_id", "keep_id", "group_size", "digest"]
    flagged = rows.drop("text").join(groups.where("texts = 1"), "digest").select(*columns)
    shared = groups.where("texts > 1").select("digest")
    if not shared.isEmpty():
        apart = rows.join(shared, "digest", "left_semi")
        flagged = flagged.unionByName(apart.join(winners(apart, salts), ["digest", "text"]).select(*columns))
    return flagged.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """Exactly one row of each full text, all its columns as they were: that of the largest id, null ids last.

    The winning row travels with its text, so nothing is matched by id afterwards.
    """
    text = whole_text()
    others = [c for c in docs.columns if c != "text"]
    row = F.struct(F.col("text").isNull().alias("none"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)))
    # Rows that repeat both id and text are told apart by their other columns, so that the same one always wins.
    rank = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), F.to_json(row).alias("rest"))
    best = [F.max_by("row", "rank").alias("row"), F.max("rank").alias("rank")]
    won = (
        docs.select(
            text.alias("text"), F.sha2(text.cast("binary"), 256).alias("digest"),
            F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"), row.alias("row"), rank.alias("rank"),
        )
        .groupBy("digest", "salt", "text").agg(*best)
        .repartition("digest")
        .groupBy("digest", "text").agg(*best)
    )
    own = {c: F.col(f"row.c{i}") for i, c in enumerate(others)}
    own["text"] = F.when(~F.col("row.none"), F.col("text"))
    return won.select(*(own[c].alias(c) for c in docs.columns))


SQL = """
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
  SELECT doc_id,
         max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
         count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
         sha256(coalesce(text, '')) AS text_sha256
  FROM documents)
"""


@query("op6_exact_dedup", SQL)
def op6(spark, sf_dir):
    """Every document with the one that stays among those of equal text."""
    return flag_copies(table(spark, sf_dir, "documents"))
