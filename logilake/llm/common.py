"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logilake import session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Rows and bytes that a Python worker holds at once; whole texts may be long.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with its SQL if SQL can express it."""

    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def configure(spark: SparkSession) -> SparkSession:
    session.configure(spark)
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage."""
    return session.stage(df, purpose).rows


def whole_text(column: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """All rows if there are at most ``bound``, else a sample by the key's hash of slightly fewer than ``bound``.

    The same rows are drawn each time and nothing is sorted. The bound is for fitting models only.
    """
    total = df.count()
    if total <= bound:
        return df
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int((1 << 20) * 0.95 * bound / total))


# The package's functions travel to executors by value, so they run where the package is not installed.
def ship_by_value(package) -> None:
    cloudpickle.register_pickle_by_value(package)
