"""One row, or k items, per group.

Every operator here ends in ``row_number() <= k``, which Spark plans as a group limit on both sides of the
shuffle: each map task forwards at most k rows of a group, so a hot group never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """First row of each group in the given order. Give a total order for a repeatable result."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def best_by_priority(df: DataFrame, keys: list[str | Column], rank: Column, tiebreak: list[Column]) -> DataFrame:
    return latest_by(df, keys, [rank.asc(), *tiebreak])


def code_rank(code: Column, ranks: list[tuple[tuple[str, ...], int]], other: int) -> Column:
    """Rank of a case-insensitive code; the first list that holds it decides."""
    lowered = F.lower(F.coalesce(code, F.lit("")))
    rank = F.lit(other)
    for codes, value in reversed(ranks):
        rank = F.when(lowered.isin(*codes), F.lit(value)).otherwise(rank)
    return rank


def current_first(flag: Column) -> Column:
    return F.when(flag, 0).otherwise(1)


def top_k_per_group(df: DataFrame, group: list[str], item: str, k: int = 5, out: str = "top_items") -> DataFrame:
    """The k most frequent non-null items per group as an ordered array; ties go to the smaller item."""
    counts = df.filter(F.col(item).isNotNull()).groupBy(*group, item).agg(F.count(F.lit(1)).alias("_cnt"))
    window = Window.partitionBy(*group).orderBy(F.desc("_cnt"), F.asc(item))
    ranked = counts.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= k)
    ordered = F.array_sort(F.collect_list(F.struct("_rn", item)))
    return ranked.groupBy(*group).agg(F.transform(ordered, lambda e: e[item]).alias(out))


def top_n_values(df: DataFrame, value: str, n: int) -> DataFrame:
    """The n most frequent non-blank values with their ``count``."""
    counted = df.filter(F.col(value).isNotNull() & (F.length(value) > 0)).groupBy(value).count()
    return counted.orderBy(F.desc("count"), F.asc(value)).limit(n)
