"""The registered queries over the test tables, and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logilake.catalog.adapters import Tables
from logilake.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, day_columns: tuple[str, ...] = ()):
    """Register ``fn(tables) -> DataFrame`` under a name, with its SQL if SQL can express it.

    ``day_columns`` are dates; both sides give them as text, since clients differ in how they represent a date.
    """

    def add(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(Tables(configure(spark), sf_dir))
            return df.withColumns({c: df[c].cast("string") for c in day_columns}) if day_columns else df

        run.__name__, run.__doc__ = name, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = run
        if sql is not None:
            text_days = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in day_columns)
            ORACLE[name] = f"SELECT * REPLACE ({text_days}) FROM ({sql})" if day_columns else sql
        return fn

    return add
