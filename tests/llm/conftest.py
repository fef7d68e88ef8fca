import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.IntegerType()),
    ]
)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs."""

    def make(*pairs):
        rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def write_tables(spark, tmp_path):
    """Write frames as the tables of a folder, and give the folder."""

    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


@pytest.fixture
def tiny():
    return "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def settings(spark):
    from logilake.llm import common

    common.configure(spark)
