"""Table states by partition: a batch reads, joins and writes the partitions of its own keys, and no other.

A state is a list of folders per partition. A batch writes the partitions that it touches into folders of its own
(copy-on-write) and then one commit, which lists the folders of every partition: new ones for what it touched, the
old ones for the rest. Nothing is overwritten, so readers of an earlier state are not disturbed, and a batch that
fails leaves only folders that no commit names (``expire`` deletes them). Batches of one table run one at a time.

Keyed tables have one kind of partition, ``current``. Versioned tables have two: ``current`` rows, and closed versions
in ``history``, to which a batch only appends. So a batch reads no history, except, with ``late="insert"``, that of
the partitions in which a row is older than a stored version.

Partitions follow the hash of the keys, or ranges of a whole number: documents are numbered in order of time, so a
batch then touches the newest ranges only.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logilake.operators import state as states
from logilake.session import Staged, delete, discard, observed, stage

PART, KIND, RUN = "state_part", "state_kind", "state_run"
CURRENT, HISTORY = "current", "history"
PARTS = 64
# A history partition of more folders is written together by ``compact``.
MOST_FOLDERS = 32

Folders = dict[str, dict[int, list[str]]]
# A commit's rows: a kind's schema without a partition, or one folder of a partition.
COMMIT = "kind string, part long, value string"


class Layout(NamedTuple):
    """How rows are dealt: by the hash of their keys, or with ``span`` by ranges of so many numbers of the one key."""

    keys: tuple[str, ...]
    parts: int = PARTS
    span: int | None = None

    def part(self) -> Column:
        hashed = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.parts))
        if self.span is None:
            return hashed
        number = F.col(self.keys[0]).cast("string").try_cast("bigint")
        # What is no number is dealt by hash, below zero.
        return F.when(number >= 0, F.floor(number / self.span)).otherwise(-1 - hashed)

    def dealt(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, self.part().cast("long"))


class State(NamedTuple):
    sequence: int
    batch: str
    folders: Folders
    schemas: dict[str, T.StructType]
    counts: dict[str, int] = {}  # rows that the batch brought and wrote, known to the batch itself only


def _commits(base: str) -> str:
    return f"{base.rstrip('/')}_states"


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder, in whatever file system it is; none if it is absent."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def committed(spark: SparkSession, base: str) -> dict[str, int]:
    """Batches and their order, from the names of the commits alone."""
    done = {}
    for name in sorted(_children(spark, _commits(base))):
        sequence, _, batch = name.partition(".")
        if "_SUCCESS" in _children(spark, f"{_commits(base)}/{name}"):
            done[unquote(batch)] = int(sequence)
    return done


def _commit_path(base: str, sequence: int, batch: str) -> str:
    return f"{_commits(base)}/{sequence:012d}.{quote(batch, safe='')}"


def exists(spark: SparkSession, base: str) -> bool:
    return bool(_children(spark, _commits(base)))


def read_commit(spark: SparkSession, base: str, batch: str) -> State:
    """The state that a batch left: one row per partition and folder, a bounded list."""
    done = committed(spark, base)
    if batch not in done:
        raise ValueError(f"no snapshot of batch {batch} was committed below {base}")
    folders: Folders = {}
    schemas = {}
    for row in spark.read.schema(COMMIT).parquet(_commit_path(base, done[batch], batch)).collect():
        if row.part is None:
            schemas[row.kind] = T.StructType.fromJson(json.loads(row.value))
        else:
            folders.setdefault(row.kind, {}).setdefault(row.part, []).append(row.value)
    return State(done[batch], batch, folders, schemas)


def last_state(spark: SparkSession, base: str) -> State | None:
    done = committed(spark, base)
    return read_commit(spark, base, max(done, key=done.get)) if done else None


def state_before(
    spark: SparkSession, base: str, batch: str, named: str | None = None, first_run: bool = False
) -> tuple[State | None, int]:
    """The state that a batch builds on, and the batch's own place in the order.

    It is the named one, else the last that was committed before this batch; none only if ``first_run`` allows it.
    """
    done = committed(spark, base)
    own = done.get(batch, max(done.values(), default=0) + 1)
    if named is not None:
        return read_commit(spark, base, named), own
    before = {b: n for b, n in done.items() if n < own}
    if before:
        return read_commit(spark, base, max(before, key=before.get)), own
    if first_run:
        return None, own
    raise ValueError(f"nothing was committed below {base}; say so with first_run if this is its first batch")


def commit(spark: SparkSession, base: str, new: State) -> None:
    rows = [(kind, None, schema.json()) for kind, schema in new.schemas.items()]
    rows += [(k, part, folder) for k, parts in new.folders.items() for part, held in parts.items() for folder in held]
    # A literal: a frame of Python rows would be a job of as many tasks as there are cores.
    listed = F.from_json(F.lit(json.dumps([dict(zip(("kind", "part", "value"), row)) for row in rows])), f"array<struct<{COMMIT}>>")
    df = spark.range(0, 1, 1, 1).select(F.inline(listed))
    df.write.mode("overwrite").parquet(_commit_path(base, new.sequence, new.batch))


def read_parts(spark: SparkSession, state: State | None, kind: str = CURRENT, parts: Iterable[int] | None = None) -> DataFrame | None:
    """Rows of a state's partitions, all or those listed; none if the state has no such kind of partition."""
    if state is None or kind not in state.schemas:
        return None
    held = state.folders.get(kind, {})
    folders = [f for p in (held if parts is None else parts) for f in held.get(p, ())]
    schema = state.schemas[kind]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def with_parts(df: DataFrame) -> DataFrame:
    """The rows of ``read_parts`` with the partition that each stands in."""
    return df.withColumn(PART, F.regexp_extract("_metadata.file_path", f"/{PART}=(-?[0-9]+)/", 1).cast("long"))


def read_state(spark: SparkSession, base: str, batch: str | None = None) -> DataFrame | None:
    """The whole table, closed versions included, as of a batch or the last one; none before any batch."""
    state = last_state(spark, base) if batch is None else read_commit(spark, base, batch)
    if state is None:
        return None
    current, history = read_parts(spark, state), read_parts(spark, state, HISTORY)
    return current if history is None else current.unionByName(history, allowMissingColumns=True)


def read_current(spark: SparkSession, base: str) -> DataFrame | None:
    """The table's current rows only."""
    return read_parts(spark, last_state(spark, base))


def _rows(name: str) -> list[Column]:
    return [F.count(F.lit(1)).alias(name)]


def write_parts(df: DataFrame, base: str, batch: str, counts: dict[str, int] | None = None, name: str = "") -> dict[int, str]:
    """Write rows by partition into a folder of its own, and give the partitions' folders."""
    run = f"{base.rstrip('/')}/{quote(batch, safe='')}-{uuid.uuid4().hex[:8]}"
    df, seen = observed(df, _rows(name) if counts is not None else ())
    df.hint("rebalance", PART).write.partitionBy(PART).parquet(run)
    if counts is not None:
        counts.update(seen())
    found = [name for name in _children(df.sparkSession, run) if name.startswith(f"{PART}=")]
    return {int(name.partition("=")[2]): f"{run}/{name}" for name in found}


def _touched(rows: DataFrame) -> list[int]:
    """The partitions of a batch: at most as many as the table has."""
    return [r[0] for r in rows.select(PART).distinct().collect()]


def schema_of(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema if f.name != PART])


def stage_batch(source: DataFrame, layout: Layout) -> Staged:
    """A batch's rows by partition, staged as ``merge_batch`` reads them, for who reads them too and discards them."""
    return stage(layout.dealt(source), "merge-source", counted=_rows("rows_in"))


def merge_batch(
    spark: SparkSession,
    source: DataFrame | Staged,
    base: str,
    layout: Layout,
    batch: str,
    previous: str | None = None,
    first_run: bool = False,
    update: list[str] | None = None,
    preserve: tuple[str, ...] = (),
    newer: str | None = None,
    take_late: Callable[[DataFrame], None] | None = None,
    keep: Column | None = None,
) -> State:
    """Keyed merge of a batch, a frame or what ``stage_batch`` gave, into the partitions that hold its keys.

    ``keep`` tells which rows of the merged partitions stay; a batch deletes keys by rows for which it does not hold.
    With ``newer`` a row whose value of that column is below the stored row's comes late: it changes nothing, and
    ``take_late`` gets it. A null is below any value.
    """
    before, sequence = state_before(spark, base, batch, previous, first_run)
    staged = source if isinstance(source, Staged) else stage_batch(source, layout)
    counts = dict(staged.counts)
    try:
        parts = _touched(staged.rows)
        target = read_parts(spark, before, CURRENT, parts)
        if target is not None:
            target = layout.dealt(target)
        keys = [PART, *layout.keys]
        rows = staged.rows
        if newer is not None and target is not None:
            rows, late = _split_late(rows, target, keys, newer)
            if take_late is not None:
                take_late(late.drop(PART))
        merged = states.merge_upsert(target, rows, keys, update, preserve)
        if keep is not None:
            merged = merged.where(keep)
        new = {p: [f] for p, f in write_parts(merged, base, batch, counts, "rows_written").items()}
        old = {} if before is None else before.folders.get(CURRENT, {})
        folders = {CURRENT: {p: f for p, f in old.items() if p not in parts} | new}
        state = State(sequence, batch, folders, {CURRENT: _widened(before, CURRENT, schema_of(merged))}, counts)
        commit(spark, base, state)
        return state
    finally:
        if staged is not source:
            discard(spark, staged)


def _split_late(rows: DataFrame, stored: DataFrame, keys: list[str], newer: str) -> tuple[DataFrame, DataFrame]:
    """Rows that are not older than the stored row of their key, and those that are.

    Sort-merge joins only: most columns of stored tables are null, so their files say far too little of their rows, and
    Spark would send all of a batch, or all stored keys, through the driver.
    """
    known = stored.groupBy(*keys).agg(F.max(newer).alias("_stored"))
    told = rows.hint("merge").join(known.hint("merge"), keys, "left")
    late = F.col("_stored").isNotNull() & (F.col(newer).isNull() | (F.col(newer) < F.col("_stored")))
    return told.where(~late).select(*rows.columns), told.where(late).select(*rows.columns)


def _widened(before: State | None, kind: str, new: T.StructType) -> T.StructType:
    """All columns of the old and the new partitions; those that a partition lacks are read as null."""
    if before is None or kind not in before.schemas:
        return new
    fields = {f.name: f for f in before.schemas[kind]} | {f.name: f for f in new}
    return T.StructType(list(fields.values()))


def version_batch(
    spark: SparkSession,
    incoming: DataFrame,
    base: str,
    layout: Layout,
    batch: str,
    as_of: Column,
    compare: list[str] | None = None,
    order: list[Column] | None = None,
    late: str = "fail",
    previous: str | None = None,
    first_run: bool = False,
) -> State:
    """Apply a batch to a versioned table: current rows of its partitions are rewritten, closed versions appended."""
    before, sequence = state_before(spark, base, batch, previous, first_run)
    source = stage(layout.dealt(incoming), "version-source", counted=_rows("rows_in"))
    counts = dict(source.counts)
    changed = None
    try:
        parts = _touched(source.rows)
        stored = read_parts(spark, before, CURRENT, parts)
        rows = source.rows.drop(PART)
        rewritten: list[int] = []
        if stored is not None and late == "insert":
            rewritten = _parts_with_late_rows(stored, source.rows, layout, as_of)
            history = read_parts(spark, before, HISTORY, rewritten) if rewritten else None
            if history is not None:
                stored = stored.unionByName(history, allowMissingColumns=True)
        applied = states.scd2_apply(stored, rows, list(layout.keys), as_of, compare, order, late)
        changed = stage(layout.dealt(applied), "versions")
        current = write_parts(changed.rows.where("is_current"), base, batch, counts, "rows_written")
        closed = write_parts(changed.rows.where("NOT is_current"), base, batch, counts, "rows_closed")
        old = {} if before is None else before.folders
        history_folders = {p: f for p, f in old.get(HISTORY, {}).items() if p not in rewritten}
        folders = {
            CURRENT: old.get(CURRENT, {}) | {p: [f] for p, f in current.items()},
            HISTORY: history_folders | {p: [*history_folders.get(p, ()), f] for p, f in closed.items()},
        }
        schema = _widened(before, CURRENT, schema_of(applied))
        state = State(sequence, batch, folders, {CURRENT: schema, HISTORY: schema}, counts)
        commit(spark, base, state)
        return state
    finally:
        discard(spark, source)
        if changed is not None:
            discard(spark, changed)


def _parts_with_late_rows(stored: DataFrame, incoming: DataFrame, layout: Layout, as_of: Column) -> list[int]:
    """Partitions in which a key of the batch has a version that starts after it."""
    younger = stored.where(F.col("start_date") > F.to_date(as_of)).select(*layout.keys)
    return _touched(incoming.hint("merge").join(younger.hint("merge"), list(layout.keys), "left_semi"))


def compact(spark: SparkSession, base: str, batch: str, most: int = MOST_FOLDERS) -> State:
    """Write history partitions of more than ``most`` folders together, as a batch of its own."""
    before, sequence = state_before(spark, base, batch)
    many = [p for p, held in before.folders.get(HISTORY, {}).items() if len(held) > most]
    folders = dict(before.folders)
    for part in many:
        rows = read_parts(spark, before, HISTORY, [part]).withColumn(PART, F.lit(part))
        folders[HISTORY] = folders[HISTORY] | {p: [f] for p, f in write_parts(rows, base, batch).items()}
    state = State(sequence, batch, folders, before.schemas)
    commit(spark, base, state)
    return state


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Forget all but the last ``keep`` states, delete the folders that none of these names, give the batches."""
    if keep < 1:
        raise ValueError("the last state must stay")
    done = committed(spark, base)
    ordered = sorted(done, key=done.get)
    expired, kept = ordered[:-keep], ordered[-keep:]
    named = {
        "/".join(f.rsplit("/", 2)[1:])
        for b in kept
        for parts in read_commit(spark, base, b).folders.values()
        for held in parts.values()
        for f in held
    }
    for b in expired:
        delete(spark, _commit_path(base, done[b], b))
    for run in _children(spark, base):
        parts = [p for p in _children(spark, f"{base}/{run}") if p.startswith(f"{PART}=")]
        gone = [p for p in parts if f"{run}/{p}" not in named]
        for p in [""] if len(gone) == len(parts) else gone:
            delete(spark, f"{base}/{run}/{p}".rstrip("/"))
    return expired


def register(spark: SparkSession, table: str, base: str, state: State) -> None:
    """Make the catalog's table show a state. Partitions that stay are not touched.

    The partitions of a table are switched one after the other; who needs exactly one state reads it by its batch.
    """
    wanted = {
        (kind, part, folder.rsplit("/", 2)[1]): folder
        for kind, parts in state.folders.items()
        for part, held in parts.items()
        for folder in held
    }
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.split('.')[0]}")
    schema = next(iter(state.schemas.values()))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    layout = f"({columns}, {KIND} STRING, {PART} BIGINT, {RUN} STRING) USING PARQUET PARTITIONED BY ({KIND}, {PART}, {RUN})"
    if not spark.catalog.tableExists(table):
        # With a location the table is external: a partition that it drops keeps its files for earlier states.
        spark.sql(f"CREATE TABLE {table} {layout} LOCATION '{base}'")
    else:
        have = set(spark.table(table).columns)
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in have)
        if added:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    shown = set()
    for (text,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        kind, part, run = (unquote(x.partition("=")[2]) for x in text.split("/"))
        shown.add((kind, int(part), run))

    def spec(key: tuple[str, int, str]) -> str:
        return f"PARTITION ({KIND} = '{key[0]}', {PART} = {key[1]}, {RUN} = '{key[2]}')"

    new = [f"{spec(key)} LOCATION '{folder}'" for key, folder in wanted.items() if key not in shown]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD " + " ".join(new))
    if old := shown - wanted.keys():
        spark.sql(f"ALTER TABLE {table} DROP " + ", ".join(map(spec, old)))
    spark.sql(f"REFRESH TABLE {table}")
