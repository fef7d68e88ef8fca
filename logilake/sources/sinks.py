"""Sinks: batches, reject and log tables, and snapshots that replace a table as a whole."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logilake.session import delete, observed
from logilake.sources import partitions


def append_facts(df: DataFrame, path: str, batch_id: str, source: str | None, unit: str = "day") -> None:
    """Append a batch of facts, partitioned by the day of a timestamp column if one is named."""
    if source is None:
        append_batch(df, path, batch_id)
    else:
        append_batch(with_partition_day(df, source, unit), path, batch_id, [PARTITION_DAY])


BATCH, FOLDER = "ingest_batch_id", "batch_folder"


def append_batch(df: DataFrame, path: str, batch_id: str, partition_by: list[str] | None = None) -> None:
    """Append one batch under its own folder, so that writing the same batch again replaces it.

    The batch's name stays in the rows as text. The folder's name starts with a letter, so that ``007`` is not read
    back as a number.
    """
    target = f"{path.rstrip('/')}/{FOLDER}=b-{batch_id}"
    named = df.withColumn(BATCH, F.lit(batch_id))
    named.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(target)


PARTITION_DAY = "partition_day"


def with_partition_day(df: DataFrame, source: str, unit: str = "day") -> DataFrame:
    """Date column to partition by; a raw timestamp would give one partition per instant.

    Rows of one day are brought together, so that a day gives few files. AQE splits a hot day and joins small ones.
    """
    day = F.to_date(F.date_trunc(unit, F.col(source)))
    return df.withColumn(PARTITION_DAY, day).hint("rebalance", PARTITION_DAY)


def register_table(spark: SparkSession, table: str, path: str) -> None:
    """Create the table over a path, or point an existing one at it and drop what was cached of it."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    else:
        spark.sql(f"CREATE TABLE {table} USING PARQUET LOCATION '{path}'")
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    spark.sql(f"REFRESH TABLE {table}")


def publish_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a table of the catalog in buckets of its keys, sorted by them.

    Tables that have the same number of buckets by the keys they are joined on meet without a shuffle, and an aggregate
    by the keys needs none either. Spark reads the buckets through the catalog's table only, not from the path.
    """
    if "." in table:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    # One task per bucket, so that a bucket is one file.
    dealt = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def snapshot_path(base: str, batch_id: str) -> str:
    return f"{base.rstrip('/')}/snapshot={batch_id}"


def publish_snapshot(
    df: DataFrame,
    base: str,
    batch_id: str,
    table: str | None = None,
    partition_by: list[str] | None = None,
    counts: dict[str, int] | None = None,
) -> DataFrame:
    """Write a new table state beside the old one, then switch the table to it.

    ``df`` may be computed from the previous snapshot, since that is left alone. Readers see the old state or the
    new one, and repeating the batch rewrites the same folder. The commit is written last. ``counts`` takes the number
    of rows written, which is observed on the way.
    """
    path = snapshot_path(base, batch_id)
    df, seen = observed(df, [F.count(F.lit(1)).alias("rows_written")] if counts is not None else ())
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    if counts is not None:
        counts.update(seen())
    _commit(df.sparkSession, base, batch_id)
    if table:
        register_table(df.sparkSession, table, path)
    return df.sparkSession.read.parquet(path)


def read_snapshot(spark: SparkSession, base: str, batch_id: str) -> DataFrame:
    """The state after a batch, whole or by partition; a batch that was never committed fails."""
    if partitions.exists(spark, base):
        return partitions.read_state(spark, base, batch_id)
    if batch_id not in _sequence(spark, base):
        raise ValueError(f"no snapshot of batch {batch_id} was committed below {base}")
    return spark.read.parquet(snapshot_path(base, batch_id))


def previous_snapshot(
    spark: SparkSession, base: str, batch_id: str, named: str | None = None, first_run: bool = False
) -> DataFrame | None:
    """The state that a batch builds on: the named one, else the last that was committed before this batch.

    ``None`` only if nothing was committed before and ``first_run`` allows it, so that a wrong path or name can
    never stand for an empty table.
    """
    if named is not None:
        return read_snapshot(spark, base, named)
    done = _sequence(spark, base)
    own = done.get(batch_id, max(done.values(), default=0) + 1)
    before = {b: n for b, n in done.items() if n < own}
    if before:
        return read_snapshot(spark, base, max(before, key=before.get))
    if first_run:
        return None
    raise ValueError(f"nothing was committed below {base}; say so with first_run if this is its first batch")


def last_snapshot(spark: SparkSession, base: str) -> DataFrame | None:
    """The latest committed state, ``None`` if there is none."""
    if partitions.exists(spark, base):
        return partitions.read_state(spark, base)
    done = _sequence(spark, base)
    return read_snapshot(spark, base, max(done, key=done.get)) if done else None


def expire_snapshots(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` committed states of a table, and give their batches.

    The commit goes first, so that no batch can build on a state that is half deleted.
    """
    if keep < 1:
        raise ValueError("the last state must stay")
    if partitions.exists(spark, base):
        return partitions.expire(spark, base, keep)
    done = _sequence(spark, base)
    expired = sorted(done, key=done.get)[:-keep]
    for batch_id in expired:
        delete(spark, f"{_commits_path(base)}/{FOLDER}=b-{batch_id}")
        delete(spark, snapshot_path(base, batch_id))
    return expired


def _commits_path(base: str) -> str:
    return f"{base.rstrip('/')}_commits"


def _sequence(spark: SparkSession, base: str) -> dict[str, int]:
    """Committed batches and their order; one short row for each batch."""
    try:
        rows = spark.read.parquet(_commits_path(base)).select(BATCH, "sequence").collect()
    except AnalysisException:
        return {}
    return {r[0]: r[1] for r in rows}


def _commit(spark: SparkSession, base: str, batch_id: str) -> None:
    done = _sequence(spark, base)
    if batch_id not in done:
        row = spark.range(1).select(F.lit(max(done.values(), default=0) + 1).cast("long").alias("sequence"))
        append_batch(row.coalesce(1), _commits_path(base), batch_id)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
