"""A training corpus from raw documents: good, distinct, clean of test items, and tokenised.

Each stage takes the documents that the one before kept and returns those that it keeps, with the same columns; the
last returns the tokens' digests. Stages are written as Parquet in the shared folder and read again, so a lost
executor costs a part of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logilake import session
from logilake.llm import bpe, common, decontaminate, exact_dedup, minhash_join, quality_qda


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_qda.keep_good(docs, common.table(common.configure(spark), sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    common.configure(spark)
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-equal texts (shingles of five words, similarity of 0.8 or more) the document with the smallest id."""
    common.configure(spark)
    return minhash_join.drop_near_copies(docs, minhash_join.NEAR)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.drop_leaks(docs, common.table(common.configure(spark), sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    common.configure(spark)
    return bpe.round_trip(docs, bpe.default_path())


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("minhash near-dedup", near),
    ("benchmark decontamination", decontaminated),
    ("bpe", tokens),
]

# The classifier, the near duplicates and the tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = common.table(common.configure(spark), sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        path = session.work_dir(spark, name.replace(" ", "-"))
        # What a stage writes for itself goes when its output is there, and so does the output before.
        with session.scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            session.delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
