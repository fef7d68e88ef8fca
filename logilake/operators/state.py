"""New table states as pure transforms: versioned dimensions, keyed merges, caches, retention."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logilake.operators.dedupe import latest_by

VERSION_COLUMNS = ("start_date", "end_date", "is_current")
# Columns that say where a row came from; a change in them alone is not a new version.
INGEST_COLUMNS = ("ingest_batch_id", "ingest_timestamp", "record_date", "job_name", "source_file")


def _all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def with_ingest_meta(df: DataFrame, batch_id: str, job: str, as_of: Column) -> DataFrame:
    return df.withColumns(
        {
            "ingest_batch_id": F.lit(batch_id),
            "ingest_timestamp": as_of,
            "record_date": F.to_date(as_of),
            "job_name": F.lit(job),
        }
    )


def _as_first_version(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumns(
        {"start_date": F.to_date(as_of), "end_date": F.lit(None).cast("date"), "is_current": F.lit(True)}
    )


def scd2_apply(
    current: DataFrame | None,
    incoming: DataFrame,
    keys: list[str],
    as_of: Column,
    compare: list[str] | None = None,
    order: list[Column] | None = None,
    late: str = "fail",
) -> DataFrame:
    """State of a versioned dimension after a batch.

    New key: insert. Same values: keep the stored row. Changed: close the stored row the day before ``as_of`` and
    insert the new one; a change on the stored row's own start day replaces it in place. History, and keys the
    batch lacks, pass through; a batch applied twice changes nothing. ``compare`` defaults to all non-key columns
    outside the ingest metadata, and ``order`` picks one row where the batch repeats a key. Columns of either side
    stay: a new version keeps the stored value of a column that the batch lacks.

    A batch that is older than a stored row fails the job, or with ``late="insert"`` takes its place in the history.
    By default history is not shuffled; the current rows meet the batch in one full outer join on the keys.
    """
    if late not in ("fail", "insert"):
        raise ValueError(f"unknown way with late rows: {late}")
    fields = incoming.columns
    if order is None:
        order = [F.col(c).desc_nulls_last() for c in fields if c not in keys]
    batch = _as_first_version(latest_by(incoming, keys, order) if order else incoming.distinct(), as_of)
    if current is None:
        return batch
    compare = compare or [c for c in fields if c not in keys and c not in INGEST_COLUMNS]
    lacking = [c for c in current.columns if c not in batch.columns]
    columns = [*fields, *lacking, *VERSION_COLUMNS]
    state = _with_columns(current, incoming).select(*columns)
    batch = _with_columns(batch, current).select(*columns)
    if late == "insert":
        return _insert_versions(state, batch, keys, compare, lacking)

    old = state.filter("is_current").select(
        F.struct(*columns).alias("old"), *[F.col(k).alias(f"_ok{i}") for i, k in enumerate(keys)]
    )
    new = batch.select(F.struct(*columns).alias("new"), *[F.col(k).alias(f"_nk{i}") for i, k in enumerate(keys)])
    on = _all_of([old[f"_ok{i}"].eqNullSafe(new[f"_nk{i}"]) for i in range(len(keys))])
    same = _all_of([F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in compare])

    has_old, has_new = F.col("_ho").isNotNull(), F.col("_hn").isNotNull()
    day = F.to_date(as_of)
    keep = has_old & (~has_new | same)
    changed = has_old & has_new & ~same
    close = changed & (F.col("old.start_date") < day)
    insert = has_new & (~has_old | ~same)
    closed = F.col("old").withField("end_date", F.date_sub(day, 1)).withField("is_current", F.lit(False))
    added = F.col("new")
    for c in lacking:
        added = added.withField(c, F.col(f"old.{c}"))
    older = F.raise_error(F.lit("the batch is older than a stored version; apply it with late='insert'"))
    added = F.when(changed & (F.col("old.start_date") > day), older).otherwise(added)
    rows = F.array_compact(F.array(F.when(keep, F.col("old")).when(close, closed), F.when(insert, added)))
    merged = (
        old.withColumn("_ho", F.lit(1))
        .join(new.withColumn("_hn", F.lit(1)), on, "full_outer")
        .select(F.explode(rows).alias("r"))
        .select("r.*")
    )
    return state.filter(~F.col("is_current")).unionByName(merged)


def _with_columns(df: DataFrame, other: DataFrame) -> DataFrame:
    """The frame with null columns for those that only the other has."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in other.dtypes if c not in df.columns})


def _insert_versions(state: DataFrame, batch: DataFrame, keys: list[str], compare: list[str], lacking: list[str]) -> DataFrame:
    """Batch rows at their place among the versions of their key, whose intervals follow one another.

    A row that says what its predecessor says is left out, and one with the start day of a stored row replaces it.
    """
    rows = state.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    by_start = Window.partitionBy(*keys).orderBy("start_date", "_new")
    before = {c: F.lag(c).over(by_start) for c in compare}
    repeats = (F.col("_new") == 1) & (F.lag("_new").over(by_start) == 0) & _all_of([F.col(c).eqNullSafe(b) for c, b in before.items()])
    known = {c: F.when(F.col("_new") == 1, F.lag(c).over(by_start)).otherwise(F.col(c)) for c in lacking}
    rows = rows.withColumns({"_repeats": repeats} | {f"_known_{c}": v for c, v in known.items()})
    rows = rows.withColumns({c: F.col(f"_known_{c}") for c in lacking}).filter("NOT coalesce(_repeats, false)")
    following = F.lead("start_date").over(by_start)
    replaced = (F.col("_new") == 0) & (following == F.col("start_date"))
    rows = rows.withColumn("_replaced", F.coalesce(replaced, F.lit(False))).filter("NOT _replaced")
    rows = rows.withColumn("_following", following)
    end = F.when(F.col("_following").isNull(), F.col("end_date")).otherwise(
        F.least(F.col("end_date"), F.date_sub("_following", 1))
    )
    return rows.select(*[c for c in state.columns if c not in ("end_date", "is_current")], end.alias("end_date"),
                       end.isNull().alias("is_current")).select(*state.columns)


def merge_upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: list[str],
    update: list[str] | None = None,
    preserve: tuple[str, ...] = (),
) -> DataFrame:
    """State after a keyed merge: update the listed columns of matches, insert the rest.

    ``update`` defaults to all non-key columns; columns in ``preserve`` keep the target's value where it has one.
    Columns that only the source has are added, null for rows that the source lacks.
    A key the source repeats fails the job. The source is reduced per key on the map side and joined on the same
    partitioning, so the merge costs one shuffle of each side.
    """
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        keyed = source.select(*keys).distinct()
        return keyed if target is None else target.unionByName(keyed.join(target, keys, "left_anti"), allowMissingColumns=True)
    folded = source.groupBy(*keys).agg(F.any_value(F.struct(*rest)).alias("s"), F.count(F.lit(1)).alias("_n"))
    checked = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"merge source repeats a key of {keys}"))).otherwise(F.col("s"))
    folded = folded.select(*keys, checked.alias("s"))
    if target is None:
        return folded.select(*keys, *[F.col(f"s.{c}").alias(c) for c in rest])
    updated = set(rest if update is None else update) - set(preserve)

    t = target.withColumn("_t", F.lit(True))
    s = folded.withColumnsRenamed({k: f"_s_{k}" for k in keys}).withColumn("_s", F.lit(True))
    on = _all_of([t[k] == s[f"_s_{k}"] for k in keys])

    def merged(name: str) -> Column:
        if name in keys:
            return F.coalesce(t[name], s[f"_s_{name}"])
        if name not in rest:
            return t[name]
        ours, theirs = t[name], F.col(f"s.{name}")
        if name in preserve:
            return F.coalesce(ours, theirs)
        take_source = F.col("_s") & (F.lit(name in updated) | F.col("_t").isNull())
        return F.when(take_source, theirs).otherwise(ours)

    added = [F.col(f"s.{c}").alias(c) for c in rest if c not in target.columns]
    return t.join(s, on, "full_outer").select(*[merged(c).alias(c) for c in target.columns], *added)


def first_wins_upsert(cache: DataFrame | None, new: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Cache state after adding rows: of all rows with one key the first in ``order`` stays."""
    rows = new if cache is None else cache.unionByName(new, allowMissingColumns=True)
    return latest_by(rows, [key], order)


class Retention(NamedTuple):
    active: DataFrame
    archive: DataFrame
    purge: DataFrame


def retention_split(
    df: DataFrame, ts: str, as_of: Column, archive_days: int = 7, purge_days: int = 90
) -> Retention:
    """Each part is a plain comparison on ``ts``, so partitions and row groups of other ages are skipped."""
    column = F.col(ts)
    archive_at = as_of - F.make_dt_interval(F.lit(archive_days))
    purge_at = as_of - F.make_dt_interval(F.lit(purge_days))
    return Retention(
        df.filter((column >= archive_at) | column.isNull()),
        df.filter((column < archive_at) & (column >= purge_at)),
        df.filter(column < purge_at),
    )
