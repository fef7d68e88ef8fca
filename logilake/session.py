"""Session settings the library relies on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Data maths is pinned to UTC. The skew settings let AQE split a hot join key over many tasks even when a
# further shuffle follows; partition counts are left to AQE coalescing. Java never compiles methods of over 8000 bytes:
# stages whose code is larger run by operator, in methods that are compiled, instead of being interpreted row by row.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Set unless the session says otherwise. Keys and codes shrink to a tenth in shuffles and files, so that a task of Spark's
# usual size would sort and hash over a gigabyte of them; what a task holds follows these sizes, not that of the tables.
TASK_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key, value in TASK_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "logilake") -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.ui.enabled", "false")
        # Test tables are small; without this AQE would merge their shuffles into a single task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the work folders that are made in this block when it ends.

    Frames are lazy: what they give must have been written or collected inside. Blocks may be nested; a folder belongs
    to the innermost one that is open in the driver, whatever thread makes it.
    """
    made: list[str] = []
    _SCRATCH.append(made)
    try:
        yield
    finally:
        _SCRATCH.remove(made)
        for path in made:
            delete(spark, path)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can see. It is deleted by ``discard`` or at the end of a ``scratch`` block.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and executors are one
    process, may fall back to a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="spark-")
    path = f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


class Staged(NamedTuple):
    rows: DataFrame
    path: str
    counts: dict[str, int] = {}


def stage(df: DataFrame, purpose: str, partition_by: tuple[str, ...] = (), counted: Iterable[Column] = ()) -> Staged:
    """Write a frame that several sinks will read, and read it back.

    Unlike an executor-local cache it survives the loss of executors, and its reads prune columns and partitions.
    ``counted`` are aggregates that are observed on the way.
    """
    path = work_dir(df.sparkSession, purpose)
    df, counts = observed(df, counted)
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return Staged(df.sparkSession.read.parquet(path), path, counts())


def observed(df: DataFrame, aggregates: Iterable[Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The frame, and what gives its counters once an action has run over all of it, without an action of its own."""
    aggregates = list(aggregates)
    if not aggregates:
        return df, dict
    seen = Observation()
    frame = df.observe(seen, *aggregates)
    names = df.select(*aggregates).columns

    def counts() -> dict[str, int]:
        try:
            found = dict(seen.get)
        except Py4JJavaError:  # the plan turned out to be empty while it ran, and the observation went with it
            found = {}
        return {name: found.get(name, 0) for name in names}

    return frame, counts


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def discard(spark: SparkSession, staged: Staged) -> None:
    """Delete a staged table once every sink has been written."""
    delete(spark, staged.path)
