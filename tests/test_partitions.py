import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from logilake.operators import state as states
from logilake.sources import partitions as ps

KEYED = "k long, v string, created int"


def files(base):
    """Data files below a folder and when they were written."""
    found = {}
    for folder, _, names in os.walk(base):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                found[path] = os.stat(path).st_mtime_ns
    return found


def batches(spark, *parts):
    return [spark.createDataFrame(rows, KEYED) for rows in parts]


@pytest.mark.parametrize("layout", [ps.Layout(("k",), 16), ps.Layout(("k",), 8, span=100)])
def test_merge_equals_the_full_merge(spark, tmp_path, rows, layout):
    base = str(tmp_path / "t")
    parts = batches(
        spark,
        [(i, f"a{i}", 1) for i in range(0, 800)],
        [(i, f"b{i}", 2) for i in range(750, 900)] + [(None, "null key", 2), (-5, "below", 2)],
        [(3, "c", 3)],
    )
    whole = None
    for n, part in enumerate(parts):
        ps.merge_batch(spark, part, base, layout, f"b{n}", first_run=n == 0, preserve=("created",))
        whole = states.merge_upsert(whole, part, ["k"], None, ("created",))
        assert rows(ps.read_state(spark, base)) == rows(whole)
    assert rows(ps.read_state(spark, base, "b0")) == rows(parts[0])


def test_untouched_partitions_keep_their_files(spark, tmp_path):
    base = str(tmp_path / "t")
    first, second = batches(spark, [(i, "a", 1) for i in range(1000)], [(k, "b", 2) for k in (990, 991, 1005)])
    layout = ps.Layout(("k",), span=100)
    one = ps.merge_batch(spark, first, base, layout, "b1", first_run=True)
    before = files(base)
    two = ps.merge_batch(spark, second, base, layout, "b2")
    after = files(base)
    assert before.items() <= after.items()
    new = {p.rsplit("/", 2)[1] for p in after.keys() - before.keys()}
    assert new == {"state_part=9", "state_part=10"}
    assert all(two.folders["current"][p] == one.folders["current"][p] for p in range(9))


def test_reruns_and_named_states(spark, tmp_path, rows):
    base, layout = str(tmp_path / "t"), ps.Layout(("k",), 4)
    first, second = batches(spark, [(1, "a", 1), (2, "a", 1)], [(2, "b", 2)])
    with pytest.raises(ValueError, match="first_run"):
        ps.merge_batch(spark, first, base, layout, "b1")
    ps.merge_batch(spark, first, base, layout, "b1", first_run=True)
    for _ in range(2):
        ps.merge_batch(spark, second, base, layout, "b/2 x")
        assert rows(ps.read_state(spark, base)) == [(1, "a", 1), (2, "b", 2)]
    assert list(ps.committed(spark, base)) == ["b1", "b/2 x"]
    ps.merge_batch(spark, second.withColumn("v", F.lit("c")), base, layout, "b3", previous="b1")
    assert rows(ps.read_state(spark, base)) == [(1, "a", 1), (2, "c", 2)]
    with pytest.raises(ValueError, match="no snapshot"):
        ps.read_state(spark, base, "none")
    assert ps.expire(spark, base, 1) == ["b1", "b/2 x"]
    assert rows(ps.read_state(spark, base)) == [(1, "a", 1), (2, "c", 2)]


def test_a_repeated_key_fails_and_changes_nothing(spark, tmp_path, rows):
    base, layout = str(tmp_path / "t"), ps.Layout(("k",), 4)
    first, twice = batches(spark, [(1, "a", 1)], [(2, "b", 2), (2, "c", 2)])
    ps.merge_batch(spark, first, base, layout, "b1", first_run=True)
    with pytest.raises(Exception, match="repeats a key"):
        ps.merge_batch(spark, twice, base, layout, "b2")
    assert rows(ps.read_state(spark, base)) == [(1, "a", 1)]


def test_columns_that_come_later(spark, tmp_path, rows):
    base, layout = str(tmp_path / "t"), ps.Layout(("k",), span=10)
    ps.merge_batch(spark, spark.createDataFrame([(1, "a"), (11, "b")], "k long, v string"), base, layout, "b1", first_run=True)
    ps.merge_batch(spark, spark.createDataFrame([(12, "c", 5)], "k long, v string, w int"), base, layout, "b2")
    assert rows(ps.read_state(spark, base), "k", "v", "w") == [(1, "a", None), (11, "b", None), (12, "c", 5)]


def test_catalog_table_follows_the_state(spark, tmp_path, rows):
    base, layout = str(tmp_path / "t"), ps.Layout(("k",), 4)
    spark.sql("DROP TABLE IF EXISTS logi_parts_test")
    for n, part in enumerate(batches(spark, [(i, "a", 1) for i in range(20)], [(3, "b", 2), (77, "b", 2)])):
        ps.register(spark, "logi_parts_test", base, ps.merge_batch(spark, part, base, layout, f"b{n}", first_run=n == 0))
        assert rows(spark.table("logi_parts_test"), "k", "v", "created") == rows(ps.read_state(spark, base))
    assert ps.read_state(spark, base, "b0").count() == 20
    spark.sql("DROP TABLE logi_parts_test")
    assert ps.read_state(spark, base).count() == 21


DIM = "k string, v string"


def at(day):
    return F.lit(day).cast("timestamp")


def versions(df):
    return sorted((r.k, r.v, str(r.start_date), str(r.end_date), r.is_current) for r in df.collect())


@pytest.mark.parametrize("late", ["fail", "insert"])
def test_versions_in_two_parts_equal_the_whole_state(spark, tmp_path, late):
    base, layout = str(tmp_path / "d"), ps.Layout(("k",), 8)
    days = [("2024-01-01", "x"), ("2024-01-05", "y"), ("2024-01-05", "z"), ("2024-02-01", "w")]
    if late == "insert":
        days += [("2024-01-03", "l"), ("2023-12-01", "m"), ("2024-03-01", "n")]
    whole = None
    for n, (day, v) in enumerate(days):
        part = spark.createDataFrame([(f"k{i}", v if i % (n + 1) == 0 else "x") for i in range(0, 30, n + 1)], DIM)
        state = ps.version_batch(spark, part, base, layout, f"b{n}", at(day), late=late, first_run=n == 0)
        new = states.scd2_apply(whole, part, ["k"], at(day), late=late)
        whole = spark.createDataFrame(new.collect(), new.schema)
        assert versions(ps.read_state(spark, base)) == versions(whole)
        assert versions(ps.read_current(spark, base)) == versions(whole.where("is_current"))
    ps.compact(spark, base, "c", 1)
    assert versions(ps.read_state(spark, base)) == versions(whole)
    assert max(len(f) for f in ps.last_state(spark, base).folders["history"].values()) == 1
    assert state.folders["history"]


def test_a_batch_reads_no_history_and_late_rows_fail(spark, tmp_path):
    base, layout = str(tmp_path / "d"), ps.Layout(("k",), 4)
    for n, day in enumerate(("2024-01-01", "2024-01-05", "2024-01-09")):
        state = ps.version_batch(spark, spark.createDataFrame([("a", str(n)), ("b", str(n))], DIM), base, layout, f"b{n}", at(day), first_run=n == 0)
    # History that cannot be read any more does no harm to a batch.
    for held in state.folders["history"].values():
        for folder in held:
            os.rename(folder.removeprefix("file:"), folder.removeprefix("file:") + ".away")
    ps.version_batch(spark, spark.createDataFrame([("a", "new")], DIM), base, layout, "b9", at("2024-01-20"))
    assert ("a", "new", "2024-01-20", "None", True) in versions(ps.read_current(spark, base))
    with pytest.raises(Exception, match="older than a stored version"):
        ps.version_batch(spark, spark.createDataFrame([("a", "old")], DIM), base, layout, "b10", at("2024-01-02"))
    assert dt.date(2024, 1, 20) in {r.start_date for r in ps.read_current(spark, base).collect()}


def test_expire_deletes_what_no_state_names(spark, tmp_path, rows):
    base, layout = str(tmp_path / "t"), ps.Layout(("k",), span=10)
    for n in range(4):
        ps.merge_batch(spark, spark.createDataFrame([(1, f"v{n}", n), (n * 10, "x", n)] if n else [(1, "v", 0)], KEYED), base, layout, f"b{n}", first_run=n == 0)
    kept = rows(ps.read_state(spark, base))
    assert ps.expire(spark, base, 1) == ["b0", "b1", "b2"]
    assert rows(ps.read_state(spark, base)) == kept
    named = {f for held in ps.last_state(spark, base).folders["current"].values() for f in held}
    assert {p.rsplit("/", 1)[0] for p in files(base)} == {f.removeprefix("file:") for f in named}


def test_rows_that_are_not_to_stay_go_and_emptied_parts_with_them(spark, tmp_path, rows):
    base, layout = str(tmp_path / "t"), ps.Layout(("k",), span=10)

    def put(batch, data):
        df = spark.createDataFrame(data, "k long, v string")
        return ps.merge_batch(spark, df, base, layout, batch, first_run=batch == "b1", keep=F.col("v").isNotNull())

    put("b1", [(1, "a"), (2, "b"), (11, "c"), (21, None)])
    assert rows(ps.read_state(spark, base)) == [(1, "a"), (11, "c"), (2, "b")]
    after = put("b2", [(1, None), (11, None), (12, None)])
    assert rows(ps.read_state(spark, base)) == [(2, "b")] and set(after.folders[ps.CURRENT]) == {0}
    put("b3", [(2, None)])
    assert rows(ps.read_state(spark, base)) == []
    put("b4", [(5, "z")])
    assert rows(ps.read_state(spark, base)) == [(5, "z")]


def test_late_rows_are_told_without_a_broadcast(spark, tmp_path, rows):
    """Files of mostly null columns look small: neither the batch nor the stored keys may go through the driver."""
    base, layout = str(tmp_path / "t"), ps.Layout(("k",), 4)
    first, second = batches(spark, [(i, "a", 5) for i in range(50)], [(3, "late", 1), (4, "new", 9), (99, "more", 1)])
    state = ps.merge_batch(spark, first, base, layout, "b1", first_run=True)
    stored = layout.dealt(ps.read_parts(spark, state))
    fresh, late = ps._split_late(layout.dealt(second), stored, [ps.PART, "k"], "created")
    for df in (fresh, late):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(fresh, "k") == [(4,), (99,)]
    assert rows(late, "k") == [(3,)]


def test_a_staged_batch_is_read_as_it_is_and_commits_take_one_task(spark, tmp_path, rows, monkeypatch):
    layout, base = ps.Layout(("k",), 4), str(tmp_path / "t")
    first, second = batches(spark, [(1, "a", 1), (2, "b", 1)], [(2, "c", 2), (3, "d", 2)])
    ps.merge_batch(spark, first, base, layout, "b1", first_run=True)
    staged = ps.stage_batch(second, layout)

    def refused(*_):
        raise AssertionError("made a second time, or from Python rows")

    with monkeypatch.context() as patched:
        patched.setattr(ps, "stage", refused)
        patched.setattr(type(spark), "createDataFrame", refused)
        assert ps.merge_batch(spark, staged, base, layout, "b2").counts["rows_in"] == 2
    assert rows(ps.read_state(spark, base), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]
    # Who staged it still reads it, and discards it.
    assert staged.rows.count() == 2
    ps.discard(spark, staged)
