"""Incremental intake: every raw file once, through the same quality rules and table states as a batch run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from logilake.plans import silver
from logilake.session import configure, discard
from logilake.sources import readers, sinks
from logilake.sources.entities import Entity


def batch_name(epoch: int, run: str) -> str:
    """``run`` is the checkpoint's own id: a new checkpoint counts its epochs from 0 again."""
    return f"stream_{run}_{epoch:010d}"


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that the query keeps in its checkpoint."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def is_committed(spark: SparkSession, paths: silver.SilverPaths, entity: Entity, batch: str) -> bool:
    """Whether the batch is complete: its log row is written last."""
    log = silver.read_log(spark, paths, entity)
    return log is not None and not log.filter((F.col("batch_id") == batch) & (F.col("status") == "success")).isEmpty()


def process_batch(
    docs: DataFrame,
    epoch: int,
    entity: Entity,
    paths: silver.SilverPaths,
    as_of: Column,
    order: list[Column] | None = None,
    run: str = "manual",
    late: str = "fail",
) -> None:
    """Apply one micro-batch. Repeating it has no effect: a logged batch is skipped, and one that failed half-way
    rewrites its own folders, starting again from the last committed state."""
    spark = configure(docs.sparkSession)
    batch = batch_name(epoch, run)
    if is_committed(spark, paths, entity, batch):
        return
    split, staged = silver.stage_records(readers.flatten_documents(docs, entity), entity)
    try:
        silver.write_entity(staged, split, entity, paths, batch, as_of, first_run=True, order=order, late=late)
    finally:
        discard(spark, staged)


OBSERVED = "intake"


class IntakeProgress(StreamingQueryListener):
    """Documents per micro-batch, as the stream observes them while it reads: no action of their own.

    Add it with ``spark.streams.addListener`` before the intake starts; ``take`` gets one dict per micro-batch.
    """

    def __init__(self, take: Callable[[dict], None]):
        self.take = take

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(OBSERVED)
        if seen is not None:
            self.take({"query": str(event.progress.id), "epoch": event.progress.batchId, **seen.asDict()})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def start_intake(
    spark: SparkSession,
    entity: Entity,
    raw_path: str,
    paths: silver.SilverPaths,
    checkpoint: str,
    as_of: Callable[[int], Column] = lambda epoch: F.current_timestamp(),
    order: list[Column] | None = None,
    max_files: int | None = None,
    late: str = "fail",
) -> StreamingQuery:
    """Process the files that are new since the last run, then stop. The checkpoint remembers the files seen."""
    reader = spark.readStream.schema(readers.document_schema(entity)).option(
        "columnNameOfCorruptRecord", readers.CORRUPT
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    docs = reader.json(raw_path).withColumn(readers.SOURCE_FILE, F.col("_metadata.file_path"))
    broken = F.count_if(F.col(readers.CORRUPT).isNotNull())
    docs = docs.observe(OBSERVED, F.count(F.lit(1)).alias("documents"), broken.alias("corrupt_documents"))

    def apply(df: DataFrame, epoch: int) -> None:
        process_batch(df, epoch, entity, paths, as_of(epoch), order, run_id(df.sparkSession, checkpoint), late)

    return (
        docs.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(apply)
        .start()
    )


def run_intake(*args, **kwargs) -> None:
    start_intake(*args, **kwargs).awaitTermination()


def read_facts(spark: SparkSession, paths: silver.SilverPaths, entity: Entity) -> DataFrame:
    return silver.read_entity(spark, paths, entity)


def read_state(spark: SparkSession, paths: silver.SilverPaths, entity: Entity) -> DataFrame | None:
    """The dimension, with its history, as of its last complete batch."""
    return sinks.last_snapshot(spark, paths.table(entity))
