"""Readers for raw documents, tables, reference files and caches."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logilake.operators.schema import rename_by_candidates
from logilake.sources.entities import Entity

CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"


def raw_glob(base: str, entity: str) -> str:
    """Files of one entity below dated folders: ``<base>/<entity>/<date>/<entity>_*.json.gz``."""
    return f"{base.rstrip('/')}/{entity}/*/{entity}_*.json.gz"


def document_schema(entity: Entity) -> T.StructType:
    """Envelope schema plus the column that takes documents which are not JSON."""
    return T.StructType([*entity.document_schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_documents(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    """Raw documents with a declared schema, the path of their file, and bad documents kept as text."""
    docs = (
        spark.read.schema(document_schema(entity))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    return docs.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def flatten_documents(docs: DataFrame, entity: Entity) -> DataFrame:
    """One row per record of the envelope's array; the source file stays with the record.

    A document that is not JSON gives one row without a record, which carries its text.
    """
    carried = [c for c in (SOURCE_FILE, CORRUPT) if c in docs.columns]
    exploded = docs.select(F.explode_outer(F.col(entity.envelope)).alias("record"), *carried)
    kept = F.col("record").isNotNull()
    if CORRUPT in carried:
        kept = kept | F.col(CORRUPT).isNotNull()
    return exploded.filter(kept).select("record.*", *carried)


RESCUED = "rescued"


def _loose_schema(entity: Entity) -> T.StructType:
    """The envelope with records of any fields."""
    schema: T.DataType = T.ArrayType(T.MapType(T.StringType(), T.VariantType()))
    for part in reversed(entity.envelope.split(".")):
        schema = T.StructType([T.StructField(part, schema)])
    return schema


def read_rescued(spark: SparkSession, path: str, entity: Entity) -> DataFrame:
    """Flat records as ``flatten_documents(read_documents(...))`` gives them, and a VARIANT of the fields that the
    declared schema lacks; null where a record has no other fields, or is none.

    A document is parsed twice, so this is for sources whose schema drifts.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    typed = F.from_json("value", document_schema(entity), options)
    loose = F.from_json("value", _loose_schema(entity))
    docs = spark.read.text(path).where(F.trim("value") != "").select(typed.alias("t"), loose.alias("l"), F.col("_metadata.file_path").alias(SOURCE_FILE))
    known = entity.record_schema.names
    pairs = F.arrays_zip(F.col(f"t.{entity.envelope}").alias("record"), F.col(f"l.{entity.envelope}").alias("fields"))
    exploded = docs.select(F.explode_outer(pairs).alias("p"), SOURCE_FILE, f"t.{CORRUPT}")
    others = F.map_filter("p.fields", lambda name, _: ~name.isin(known))
    kept = exploded.filter(F.col("p.record").isNotNull() | F.col(CORRUPT).isNotNull())
    return kept.select("p.record.*", SOURCE_FILE, CORRUPT, F.when(F.size(others) > 0, F.to_variant_object(others)).alias(RESCUED))


def parse_documents(text: Column, entity: Entity) -> Column:
    """Envelope struct of a JSON text column, for documents that come in a table rather than in files."""
    return F.from_json(text, entity.document_schema)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Strict scan: a missing table raises."""
    return spark.read.format(fmt).load(path)


def read_table_or_none(spark: SparkSession, path: str | None, fmt: str = "parquet") -> DataFrame | None:
    """Tolerant scan: ``None`` when the path is absent or holds no table."""
    if not path:
        return None
    try:
        return read_table(spark, path, fmt)
    except AnalysisException:
        return None


def table_or_path(
    spark: SparkSession, table: str | None, path: str | None, path_only: bool = False
) -> DataFrame | None:
    """The catalog's table if it is there, else the path, else ``None``."""
    if table and not path_only and spark.catalog.tableExists(table):
        return spark.table(table)
    return read_table_or_none(spark, path)


def read_all(spark: SparkSession, paths: str | list[str]) -> DataFrame | None:
    """Union by name of the tables that exist among the paths (a list, or text with commas)."""
    listed = paths.split(",") if isinstance(paths, str) else paths
    frames = [read_table_or_none(spark, p.strip()) for p in listed if p.strip()]
    present = [f for f in frames if f is not None]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present) if present else None


# Header spellings accepted in the warehouse reference file.
WAREHOUSE_MAP_COLUMNS = {
    "ewmwarehouse": ("string", ("ewmwarehouse", "warehouse_id", "warehouse", "warehouseid")),
    "address_raw": ("string", ("address_raw", "address", "addr", "warehouse_address")),
    "lat": ("double", ("lat", "latitude")),
    "lon": ("double", ("lon", "longitude", "lng")),
    "warehouse_name": ("string", ("warehouse_name", "name")),
}


def read_warehouse_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Warehouse reference CSV with a header; unknown columns are dropped, bad coordinates become null."""
    return rename_by_candidates(spark.read.option("header", True).csv(path), WAREHOUSE_MAP_COLUMNS)
