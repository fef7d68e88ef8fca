"""Dashboard figures over the trip fact and the lane summary, and the monthly KPI table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logilake.functions import dates


def total_trips(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("total_trips"))


def on_time_trips(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_if("on_time_flag").alias("on_time_trips"))


def on_time_rate(fact: DataFrame) -> DataFrame:
    """Percent of all trips that were on time; a trip of unknown outcome counts as not on time."""
    share = F.try_divide(F.count_if("on_time_flag"), F.count(F.lit(1))) * 100.0
    return fact.agg(F.round(share, 6).alias("on_time_rate"))


def trips_by_weekday(fact: DataFrame, ts: str, out: str = "day_of_week") -> DataFrame:
    """Trips per weekday, Sunday = 1, in weekday order."""
    day = dates.dow_sunday_first(F.col(ts)).alias(out)
    return fact.groupBy(day).agg(F.count(F.lit(1)).alias("trips")).orderBy(out)


def weekly_on_time(fact: DataFrame) -> DataFrame:
    week = dates.week_start_sunday(F.col("delivery_datetime_full")).alias("week")
    return (
        fact.groupBy(week)
        .agg(F.count_if("on_time_flag").alias("on_time_trips"), F.count(F.lit(1)).alias("trips"))
        .orderBy("week")
    )


def _exact_avg(column: str) -> Column:
    """Average of rounded figures in decimals: the same whatever the order in which they are added."""
    return F.avg(F.col(column).cast("decimal(24,6)")).cast("double")


def weekly_distance(routes: DataFrame) -> DataFrame:
    week = dates.week_start_monday(F.col("last_trip_at")).alias("week")
    return (
        routes.groupBy(week)
        .agg(
            F.round(_exact_avg("avg_distance_km"), 3).alias("avg_distance_km"),
            F.round(_exact_avg("avg_network_duration_min"), 2).alias("avg_network_duration_min"),
        )
        .orderBy("week")
    )


def weekly_eta_error(routes: DataFrame) -> DataFrame:
    week = dates.week_start_sunday(F.col("last_trip_at")).alias("week")
    return (
        routes.groupBy(week)
        .agg(
            _exact_avg("avg_eta_error_min").alias("avg_eta_error_min"),
            _exact_avg("avg_abs_eta_error_min").alias("avg_abs_eta_error_min"),
        )
        .orderBy("week")
    )


def monthly_kpis(trips: DataFrame, dims: list[str], ts: str, metrics: dict[str, Column]) -> DataFrame:
    """Long table (dims, month, metric, value, yoy_change) of monthly aggregates.

    The change compares with the same month a year before, and is null where that month is absent or zero. The
    trips are aggregated once; the comparison joins the small monthly result with itself.
    """
    month = F.trunc(F.col(ts), "month").alias("month")
    wide = trips.groupBy(*dims, month).agg(*[expr.cast("double").alias(name) for name, expr in metrics.items()])
    long = wide.unpivot([*dims, "month"], list(metrics), "metric", "value")
    keys = [*dims, "month", "metric"]
    before = long.select(
        *[F.col(d).alias(f"_p{d}") for d in dims],
        F.add_months("month", 12).alias("_pmonth"),
        F.col("metric").alias("_pmetric"),
        F.col("value").alias("_pvalue"),
    )
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k).eqNullSafe(F.col(f"_p{k}")) if k in dims else F.col(k) == F.col(f"_p{k}"))
    change = F.try_divide(F.col("value"), F.col("_pvalue")) - 1
    return long.join(before, same, "left").select(*keys, "value", change.alias("yoy_change"))


def rollup_kpis(trips: DataFrame, dims: list[str], metrics: dict[str, Column]) -> DataFrame:
    """Drill-down totals: every prefix of ``dims``, with ``level`` = number of dimensions summed away."""
    return trips.rollup(*dims).agg(
        F.grouping_id().alias("_gid"), *[e.alias(n) for n, e in metrics.items()]
    ).select(*dims, F.bit_count("_gid").cast("int").alias("level"), *metrics)


def lane_reliability(trips: DataFrame, lane: list[str], ts: str, error: str, delay_min: float = 15.0) -> DataFrame:
    """Trips, mean error and share delayed per lane, weekday and hour."""
    stamp = F.col(ts)
    late = F.count_if(F.col(error) > float(delay_min)) / F.count(F.lit(1)) * 100.0
    return trips.groupBy(*lane, dates.dow_monday_first(stamp).alias("day_of_week"), F.hour(stamp).alias("hour")).agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.avg(error), 2).alias("avg_error_min"), F.round(late, 2).alias("pct_delayed")
    )


def cost_per_km(trips: DataFrame, lane: list[str], cost: str, km: str) -> DataFrame:
    """Cost per kilometre of a lane: sum over sum; null where no distance was driven."""
    ratio = F.try_divide(F.sum(F.when(F.col(km).isNotNull(), F.col(cost))), F.nullif(F.sum(km), F.lit(0.0)))
    return trips.groupBy(*lane).agg(F.count(F.lit(1)).alias("trips"), F.round(ratio, 4).alias("cost_per_km"))
