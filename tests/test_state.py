import datetime as dt

import pytest
from pyspark.sql import functions as F

from logilake.operators import state

D = dt.date
S = "k string, v string"


def at(day):
    return F.lit(day).cast("timestamp")


def frame(spark, *data):
    return spark.createDataFrame(list(data), S)


def view(rows, df):
    return rows(df, "k", "v", "start_date", "end_date", "is_current")


def test_scd2_closes_and_inserts(spark, rows):
    one = state.scd2_apply(None, frame(spark, ("a", "1"), ("b", "1"), ("c", None)), ["k"], at("2024-01-01"))
    two = state.scd2_apply(one, frame(spark, ("a", "2"), ("b", "1"), ("c", None), ("d", "9")), ["k"], at("2024-01-10"))
    assert view(rows, two) == [
        ("a", "1", D(2024, 1, 1), D(2024, 1, 9), False),
        ("a", "2", D(2024, 1, 10), None, True),
        ("b", "1", D(2024, 1, 1), None, True),
        ("c", None, D(2024, 1, 1), None, True),
        ("d", "9", D(2024, 1, 10), None, True),
    ]
    again = state.scd2_apply(two, frame(spark, ("a", "2"), ("b", "1"), ("c", None), ("d", "9")), ["k"], at("2024-01-10"))
    assert view(rows, again) == view(rows, two)


def test_scd2_same_day_change_replaces_and_reappearing_value_opens_a_version(spark, rows):
    one = state.scd2_apply(None, frame(spark, ("a", "1")), ["k"], at("2024-01-01"))
    same_day = state.scd2_apply(one, frame(spark, ("a", "2")), ["k"], at("2024-01-01"))
    assert view(rows, same_day) == [("a", "2", D(2024, 1, 1), None, True)]
    back = state.scd2_apply(state.scd2_apply(one, frame(spark, ("a", "2")), ["k"], at("2024-01-05")), frame(spark, ("a", "1")), ["k"], at("2024-01-09"))
    assert [r[1] for r in view(rows, back)] == ["1", "1", "2"]
    assert back.filter("is_current").count() == 1


def test_scd2_repeated_key_in_a_batch_and_compare_columns(spark, rows):
    batch = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], "k string, v string, n int")
    one = state.scd2_apply(None, batch, ["k"], at("2024-01-01"), order=[F.desc("n")])
    assert rows(one, "v") == [("y",)]
    other = spark.createDataFrame([("a", "y", 3)], "k string, v string, n int")
    two = state.scd2_apply(one, other, ["k"], at("2024-01-02"), compare=["v"])
    assert rows(two, "v", "n", "is_current") == [("y", 2, True)]


def test_merge_updates_inserts_and_preserves(spark, rows):
    schema = "k int, v string, created int"
    target = spark.createDataFrame([(1, "old", 10), (2, "keep", 20), (None, "null", 1)], schema)
    source = spark.createDataFrame([(1, "new", 99), (3, "add", 30)], schema)
    merged = state.merge_upsert(target, source, ["k"], preserve=("created",))
    assert rows(merged) == [(1, "new", 10), (2, "keep", 20), (3, "add", 30), (None, "null", 1)]
    assert rows(state.merge_upsert(merged, source, ["k"], preserve=("created",))) == rows(merged)
    only_created = state.merge_upsert(target, source, ["k"], update=["created"])
    assert rows(only_created)[0] == (1, "old", 99)
    assert rows(state.merge_upsert(None, source, ["k"])) == [(1, "new", 99), (3, "add", 30)]


def test_merge_with_a_repeated_source_key_fails(spark):
    source = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="repeats a key"):
        state.merge_upsert(source.limit(0), source, ["k"]).collect()


def test_cache_keeps_the_first_row(spark, rows):
    cache = spark.createDataFrame([("h1", 5, "old")], "h string, at int, src string")
    new = spark.createDataFrame([("h1", 6, "new"), ("h2", 7, "new"), ("h2", 8, "later")], "h string, at int, src string")
    assert rows(state.first_wins_upsert(cache, new, "h", [F.asc("at")])) == [("h1", 5, "old"), ("h2", 7, "new")]


def test_retention_parts_cover_all_rows(spark):
    days = spark.range(120).select(F.timestamp_seconds(F.col("id") * 86400).alias("ts")).unionByName(
        spark.range(1).select(F.lit(None).cast("timestamp").alias("ts"))
    )
    as_of = F.timestamp_seconds(F.lit(119 * 86400))
    parts = state.retention_split(days, "ts", as_of)
    assert [p.count() for p in parts] == [9, 83, 29]


def test_scd2_late_batch(spark, rows):
    one = state.scd2_apply(None, frame(spark, ("a", "2"), ("b", "1")), ["k"], at("2024-02-01"))
    with pytest.raises(Exception, match="older than a stored version"):
        state.scd2_apply(one, frame(spark, ("a", "1")), ["k"], at("2024-01-01")).collect()
    assert rows(state.scd2_apply(one, frame(spark, ("b", "1")), ["k"], at("2024-01-01"))) == rows(one)
    late = state.scd2_apply(one, frame(spark, ("a", "1"), ("c", "9")), ["k"], at("2024-01-01"), late="insert")
    assert view(rows, late) == [
        ("a", "1", D(2024, 1, 1), D(2024, 1, 31), False), ("a", "2", D(2024, 2, 1), None, True),
        ("b", "1", D(2024, 2, 1), None, True), ("c", "9", D(2024, 1, 1), None, True),
    ]
    between = state.scd2_apply(late, frame(spark, ("a", "x")), ["k"], at("2024-01-10"), late="insert")
    assert [r[1:4] for r in view(rows, between) if r[0] == "a"] == [
        ("1", D(2024, 1, 1), D(2024, 1, 9)), ("2", D(2024, 2, 1), None), ("x", D(2024, 1, 10), D(2024, 1, 31)),
    ]
    same = state.scd2_apply(between, frame(spark, ("a", "x")), ["k"], at("2024-01-20"), late="insert")
    assert view(rows, same) == view(rows, between)
    replaced = state.scd2_apply(between, frame(spark, ("a", "y")), ["k"], at("2024-01-10"), late="insert")
    assert [r[1] for r in view(rows, replaced) if r[0] == "a"] == ["1", "2", "y"]


def test_scd2_keeps_the_columns_of_both_sides(spark, rows):
    one = state.scd2_apply(None, spark.createDataFrame([("a", "1", "old")], "k string, v string, gone string"), ["k"], at("2024-01-01"))
    two = state.scd2_apply(one, spark.createDataFrame([("a", "2", 5)], "k string, v string, fresh int"), ["k"], at("2024-01-02"))
    assert rows(two, "v", "gone", "fresh", "is_current") == [("1", "old", None, False), ("2", "old", 5, True)]
    ins = state.scd2_apply(one, spark.createDataFrame([("a", "2", 5)], "k string, v string, fresh int"), ["k"], at("2024-01-02"), late="insert")
    assert rows(ins, "v", "gone", "fresh", "is_current") == [("1", "old", None, False), ("2", "old", 5, True)]


def test_key_only_dimension(spark, rows):
    one = state.scd2_apply(None, spark.createDataFrame([("a",)], "k string"), ["k"], at("2024-01-01"))
    two = state.scd2_apply(one, spark.createDataFrame([("a",), ("b",)], "k string"), ["k"], at("2024-01-02"))
    assert rows(two, "k", "start_date", "is_current") == [("a", D(2024, 1, 1), True), ("b", D(2024, 1, 2), True)]


def test_merge_adds_new_columns_and_keys_alone(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(1, "x", True), (3, "y", False)], "k int, v string, more boolean")
    assert rows(state.merge_upsert(target, source, ["k"])) == [(1, "x", True), (2, "b", None), (3, "y", False)]
    keys = spark.createDataFrame([(2,), (9,)], "k int")
    assert rows(state.merge_upsert(target, keys, ["k"])) == [(1, "a"), (2, "b"), (9, None)]
