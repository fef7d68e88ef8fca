"""Raw documents of one entity to its typed table, reject table and batch log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logilake.operators import quality, state
from logilake.operators.dedupe import latest_by
from logilake.session import Staged, discard, stage
from logilake.sources import partitions, readers, sinks
from logilake.sources.entities import Entity


@dataclass(frozen=True)
class SilverPaths:
    base: str

    def table(self, entity: Entity) -> str:
        return f"{self.base}/{entity.name}"

    @property
    def rejects(self) -> str:
        return f"{self.base}/rejects"

    @property
    def log(self) -> str:
        return f"{self.base}/logs"


def classify_records(records: DataFrame, entity: Entity) -> DataFrame:
    """Reject reason per record; the text of a document that is not JSON is itself a reject."""
    judged = quality.classify(records, entity.required, entity.rules)
    if readers.CORRUPT not in records.columns:
        return judged
    broken = F.when(F.col(readers.CORRUPT).isNotNull(), F.lit("corrupt_document"))
    return judged.withColumn(quality.REJECT_REASON, broken.otherwise(F.col(quality.REJECT_REASON)))


def stage_records(records: DataFrame, entity: Entity) -> tuple[quality.Split, Staged]:
    """Classify once into a staged table split by outcome; gives the typed valid rows and the raw rejects, each of
    which reads its own partition only, and the staged table, which the caller discards. The batch's counters are
    observed while it is written."""
    classified = classify_records(records, entity)
    classified = classified.withColumn("outcome", quality.outcome())
    staged = stage(classified, f"silver-{entity.name}", ("outcome",), quality.batch_counts(classified))
    good = staged.rows.filter("outcome = 'valid'").drop("outcome", quality.REJECT_REASON, readers.CORRUPT)
    rejects = staged.rows.filter("outcome = 'reject'").drop("outcome")
    return quality.Split(quality.parsed_columns(good, entity.rules), rejects), staged


def next_state(
    current: DataFrame | None, valid: DataFrame, entity: Entity, as_of: Column, order: list[Column] | None = None, late: str = "fail"
) -> DataFrame:
    """New state of a versioned entity."""
    return state.scd2_apply(current, valid, entity.keys, as_of, entity.compare or None, order, late)


def newest_per_key(facts: DataFrame, entity: Entity) -> DataFrame:
    """One row per key of the entity: the newest version if it has one, then the last that was ingested, then the last
    by file and content."""
    if not entity.keys:
        return facts
    versions = (entity.version,) if entity.version else ()
    first = [c for c in (*versions, "ingest_timestamp", sinks.BATCH, readers.SOURCE_FILE) if c in facts.columns]
    rest = [c for c in facts.columns if c not in first and c not in entity.keys]
    return latest_by(facts, entity.keys, [F.col(c).desc_nulls_last() for c in [*first, *rest]])


LATE = "older_than_stored"


def keyed_layout(entity: Entity) -> partitions.Layout:
    """Documents are numbered in order of time: one key is dealt by ranges of numbers, several by hash."""
    return partitions.Layout(tuple(entity.keys), span=1_000_000 if len(entity.keys) == 1 else None)


def _as_rejects(late: DataFrame, rejects: DataFrame) -> DataFrame:
    """Rows that came late, in the columns of the reject table: parsed values as text."""
    own = {quality.REJECT_REASON: F.lit(LATE)}
    kinds = dict(rejects.dtypes)
    columns = [own.get(c, F.col(c) if c in late.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in rejects.columns]
    return late.select(*columns)


def write_entity(
    staged: Staged,
    split: quality.Split,
    entity: Entity,
    paths: SilverPaths,
    batch_id: str,
    as_of: Column,
    previous_batch: str | None = None,
    first_run: bool = False,
    order: list[Column] | None = None,
    late: str = "fail",
) -> dict:
    """Write a staged batch: table or new state, rejects, and the log row last. Gives the counters.

    Every part has a folder of the batch's name, so a repeated batch replaces its own rows.
    """
    spark = staged.rows.sparkSession
    valid = state.with_ingest_meta(split.valid, batch_id, entity.name, as_of)
    rejected = split.reject
    if entity.kind == "keyed":
        late: list[Staged] = []
        partitions.merge_batch(
            spark, newest_per_key(valid, entity), paths.table(entity), keyed_layout(entity), batch_id, previous_batch, first_run,
            newer=entity.version, take_late=lambda df: late.append(stage(_as_rejects(df, split.reject), f"late-{entity.name}")),
        )
        for part in late:
            rejected = rejected.unionByName(part.rows)
    elif entity.kind == "fact":
        facts = newest_per_key(valid, entity)
        sinks.append_facts(facts, paths.table(entity), batch_id, entity.partition_date, entity.partition_unit)
    else:
        partitions.version_batch(
            spark, valid, paths.table(entity), partitions.Layout(tuple(entity.keys)), batch_id, as_of,
            entity.compare or None, order, late, previous_batch, first_run,
        )
    rejects = quality.with_reject_meta(rejected, batch_id, entity.name, as_of)
    sinks.append_batch(rejects, f"{paths.rejects}/{entity.name}", batch_id)
    for part in late if entity.kind == "keyed" else ():
        discard(spark, part)
    counts = staged.counts
    write_log(spark, counts, entity, paths, batch_id, "success", as_of)
    return counts


def write_log(
    spark: SparkSession, counts: dict, entity: Entity, paths: SilverPaths, batch_id: str, status: str, as_of: Column
) -> None:
    row = spark.range(1).select(*[F.lit(counts.get(c, 0)).alias(c) for c in ("records_processed", "records_rejected")])
    log = quality.batch_log_row(row, batch_id, entity.name, status, as_of)
    sinks.append_batch(log, f"{paths.log}/{entity.name}", batch_id)


def run_entity(
    spark: SparkSession,
    entity: Entity,
    raw_path: str,
    paths: SilverPaths,
    batch_id: str,
    as_of: Column,
    previous_batch: str | None = None,
    table: str | None = None,
    first_run: bool = False,
    late: str = "fail",
) -> dict:
    """Run one batch and return its counters.

    A versioned entity builds on ``previous_batch``, or on its last committed state; its very first batch needs
    ``first_run``. The documents are parsed once, into the staged table, and counted on the way.
    """
    staged = None
    try:
        records = readers.flatten_documents(readers.read_documents(spark, raw_path, entity), entity)
        split, staged = stage_records(records, entity)
        counts = write_entity(staged, split, entity, paths, batch_id, as_of, previous_batch, first_run, None, late)
        if table:
            if entity.kind == "fact":
                sinks.register_table(spark, table, paths.table(entity))
            else:
                partitions.register(spark, table, paths.table(entity), partitions.read_commit(spark, paths.table(entity), batch_id))
        return counts
    except Exception:
        write_log(spark, {}, entity, paths, batch_id, "failed", as_of)
        raise
    finally:
        if staged is not None:
            discard(spark, staged)


def read_log(spark: SparkSession, paths: SilverPaths, entity: Entity) -> DataFrame | None:
    return readers.read_table_or_none(spark, f"{paths.log}/{entity.name}")


def read_rejects(spark: SparkSession, paths: SilverPaths, entity: Entity) -> DataFrame | None:
    return readers.read_table_or_none(spark, f"{paths.rejects}/{entity.name}")


def read_entity(spark: SparkSession, paths: SilverPaths, entity: Entity) -> DataFrame | None:
    """What an entity says now: facts once per key, current rows of a versioned entity; ``None`` before any batch.

    Appended facts (kind ``fact``) are deduplicated here, over their whole history. Keyed ones (``keyed``) are merged
    when they are written, partition by partition, and read by a plain scan.
    """
    if entity.kind == "fact":
        facts = readers.table_or_path(spark, None, paths.table(entity))
        return None if facts is None else newest_per_key(facts.drop(sinks.FOLDER), entity)
    return partitions.read_current(spark, paths.table(entity))


def load(spark: SparkSession, paths: SilverPaths, entities: list[Entity]) -> dict[str, DataFrame]:
    """The tables that the gold job reads, by entity; those without any batch are left out."""
    found = {e.name: read_entity(spark, paths, e) for e in entities}
    return {name: df for name, df in found.items() if df is not None}
