from pathlib import Path

import pytest
from pyspark.sql import functions as F

from logilake.catalog import network, storage
from logilake.catalog.adapters import Tables
from logilake.session import configure, discard, scratch, stage
from logilake.sources import readers
from logilake.sources.entities import ENTITIES


def test_thirds_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "work_dir", lambda _, purpose: f"{tmp_path}/{purpose}")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = storage.document_lineage(Tables(spark, "/root/testdata/sf0.001")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert got.files == 3 and got.without_file == 0 and got.records > 0
    assert all(len(list(Path(tmp_path, "raw", f"third{k}").glob("part-*"))) > 1 for k in range(3))


def test_stored_tables_meet_without_an_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = network.stored_trips(Tables(spark, "/root/testdata/sf0.001"))
        plan = fact._jdf.queryExecution().executedPlan().toString()
        assert "Join" in plan and "Exchange" not in plan
        assert fact.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("logi_located_trips", "logi_lanes"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_buckets_follow_the_session(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        network.stored_trips(Tables(spark, "/root/testdata/sf0.001"))
        shown = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED logi_located_trips").collect()}
        assert shown["Num Buckets"] == "20"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        for name in ("logi_located_trips", "logi_lanes"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_what_a_task_reads_is_bounded_unless_the_session_says_otherwise(spark):
    advisory, split = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"
    other = spark.newSession()
    other.conf.set(split, "1m")
    configure(other)
    assert (other.conf.get(advisory), other.conf.get(split)) == ("16m", "1m")


def test_rescued_fields_and_broken_documents(spark, tmp_path):
    entity = ENTITIES["sales_order"]
    (tmp_path / "a.json").write_text(
        '{"d": {"results": [{"SalesOrder": "1", "X": {"y": [1, 2]}, "salesorder": "z"}, {"SalesOrder": "2"}, null]}}\n'
        "not json\n\n" '{"d": {"results": []}}\n{"d": {"results": [{"Only": true}]}}\n'
    )
    rows = readers.read_rescued(spark, str(tmp_path), entity).withColumn("rescued", F.to_json("rescued")).collect()
    got = sorted(((r.SalesOrder, r.rescued, r[readers.CORRUPT]) for r in rows), key=str)
    assert got == [
        ("1", '{"X":{"y":[1,2]},"salesorder":"z"}', None), ("2", None, None), (None, '{"Only":true}', None), (None, None, "not json"),
    ]
    typed = readers.flatten_documents(readers.read_documents(spark, str(tmp_path), entity), entity)
    assert sorted(str(r.SalesOrder) for r in typed.collect()) == sorted(str(r.SalesOrder) for r in rows)
    assert all(r.source_file.endswith("a.json") for r in rows)


def test_work_folders_go_with_their_block(spark):
    def there(staged):
        return Path(staged.path.removeprefix("file://").removeprefix("file:")).exists()

    kept = stage(spark.range(3), "kept")
    with scratch(spark):
        outer, early = stage(spark.range(4), "outer"), stage(spark.range(4), "early")
        with scratch(spark):
            inner = stage(spark.range(5), "inner")
            assert inner.rows.count() == 5
        assert there(outer) and not there(inner)
        discard(spark, early)
        assert not there(early)
    with pytest.raises(ZeroDivisionError), scratch(spark):
        failed = stage(spark.range(6), "failed")
        raise ZeroDivisionError
    assert there(kept) and not there(outer) and not there(failed)
    discard(spark, kept)
    assert not there(kept)
