import zlib

import pytest
from pyspark.sql import functions as F

from logilake.llm import histogram_shards as hs


def check(df, placed, shards, slack):
    got = placed.select("doc_id", "shard", "slot", hs.size().alias("bytes")).toPandas()
    assert len(got) == df.count()
    assert got.shard.between(0, shards - 1).all()
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    if len(got):
        sums = got.groupby("shard").bytes.sum().reindex(range(shards), fill_value=0)
        assert sums.max() - sums.min() <= 2 * slack * sums.mean() + 2 * got.bytes.max()


def test_bytes_are_near_equal_on_the_test_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    check(docs, hs.place(docs), hs.SHARDS, hs.TOLERANCE)


@pytest.mark.parametrize("hot_share", [3, 2])
def test_a_hot_text_is_split_and_others_stay_whole(spark, hot_share):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % hot_share == 0, "hot " * 20).otherwise(F.concat(F.lit("t"), (F.col("id") / 2).cast("int").cast("string"), F.lit("x" * 40))).alias("text"),
    )
    placed = hs.place(docs, shards=8).persist()
    check(docs, placed, 8, hs.TOLERANCE)
    spread = placed.where(~F.col("text").startswith("hot")).groupBy("text").agg(F.countDistinct("shard").alias("n"))
    assert spread.where("n > 1").count() <= 7


def test_nulls_and_clashing_columns(documents, write_tables, spark):
    docs = documents((1, None), (None, "é"), (3, ""), (3, ""), (4, "x" * 5000)).withColumn("Xshard", F.lit(1))
    got = hs.op8(spark, write_tables(documents=docs)).collect()
    assert len(got) == 5
    by = {(r.doc_id, r.size): r for r in got}
    assert by[1, 1].text_crc32 == 0 and by[None, 3].text_crc32 == zlib.crc32("é".encode()) and (4, 5001) in by
    assert {r.law for r in got} == {"bytes"} and all(r.grown_shard is None for r in got)


def test_empty_table(documents):
    assert hs.place(documents()).count() == 0


def test_no_python_in_the_plan(spark, tiny):
    plan = hs.op8(spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("copies", [0, 700])
def test_splitters_lie_where_the_prefix_sums_say(spark, copies):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < copies, F.lit("hot " * 9)).otherwise(F.repeat(F.concat(F.lit("w"), F.col("id").cast("string")), (F.col("id") % 13).cast("int"))).alias("text"),
    )
    keys = docs.select(hs.text_key().alias("text_key"), hs.id_key().alias("id_key"), hs.size().alias("size")).persist()
    shards, tolerance = 7, 0.01
    cuts = hs.splitters(keys, shards, tolerance)
    rows = sorted(tuple(r) for r in keys.collect())
    total = sum(size for _, _, size in rows)
    assert len(cuts) == shards - 1 and cuts == sorted(cuts)
    for i, cut in enumerate(cuts, 1):
        target = total * i // shards
        below = sum(size for text, id_, size in rows if (text, id_) < tuple(cut))
        # Every boundary between two keys, by running sums over all rows in order.
        sums, reached = [0], 0
        for _, _, size in rows:
            reached += size
            sums.append(reached)
        nearest = min(abs(s - target) for s in sums)
        assert abs(below - target) <= max(tolerance * total / shards, nearest)
        assert below in sums
    keys.unpersist()
