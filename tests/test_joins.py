import itertools
import random

import pytest
from pyspark.sql import functions as F

from logilake.operators import dedupe, joins
from logilake.operators.schema import join_disambiguated, lower_columns, resolve, temporal_columns


def points(seed, n, dims):
    rng = random.Random(seed)
    grid = [rng.choice([None, 0.0, -0.0, 0.1, 0.25, 0.3, -0.1]) for _ in range(n * dims)]
    free = [round(rng.uniform(-1, 1), 2) for _ in range(n * dims)]
    mixed = [g if rng.random() < 0.5 else f for g, f in zip(grid, free)]
    return [(i, *mixed[i * dims : (i + 1) * dims]) for i in range(n)]


@pytest.mark.parametrize("dims", [1, 2])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_tolerance_join_equals_brute_force(spark, rows, dims, how):
    names = ["x", "y"][:dims]
    left, right = points(1, 60, dims), points(2, 50, dims)
    schema = "id int, " + ", ".join(f"{n} double" for n in names)
    got = joins.tolerance_join(
        spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), [(F.col(n), F.col(n)) for n in names], 0.1, how
    )

    def near(a, b):
        return all(p is not None and q is not None and abs(p - q) < 0.1 for p, q in zip(a[1:], b[1:]))

    pairs = [(a[0], b[0]) for a, b in itertools.product(left, right) if near(a, b)]
    if how == "left":
        pairs += [(a[0], None) for a in left if not any(near(a, b) for b in right)]
    assert rows(got, "id", "right_id") == sorted(pairs, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_tolerance_lookup_keeps_every_row_once(spark, rows):
    left, right = points(3, 40, 2), points(4, 40, 2)
    got = joins.tolerance_lookup(
        spark.createDataFrame(left, "id int, x double, y double"),
        spark.createDataFrame([(f"L{i:02d}", x, y) for i, x, y in right], "loc string, x double, y double"),
        [(F.col("x"), F.col("x")), (F.col("y"), F.col("y"))],
        0.2,
        "loc",
    )
    def best(a):
        hits = [f"L{b[0]:02d}" for b in right if None not in a and None not in b and all(abs(p - q) < 0.2 for p, q in zip(a[1:], b[1:]))]
        return min(hits, default=None)

    assert dict(rows(got, "id", "loc")) == {a[0]: best(a) for a in left}


def test_cascade_takes_the_first_stage_and_keeps_the_row_count(spark, rows):
    left = spark.createDataFrame([(1, "A"), (2, "b"), (3, "zz"), (4, None), (5, "A")], "id int, k string")
    look = spark.createDataFrame([("A", "v2"), ("A", "v1"), ("B", "w"), (None, "n")], "k string, v string")
    stages = [(F.col("k"), F.col("k")), (F.upper("k"), F.col("k"))]
    got = joins.cascade_lookup(left, look, ["k"], stages, "v", stage_col="stage")
    assert rows(got) == [(1, "A", "v1", 1), (2, "b", "w", 2), (3, "zz", None, None), (4, None, None, None), (5, "A", "v1", 1)]


def test_first_match_is_chosen_row_by_row(spark, rows):
    left = spark.createDataFrame([("01", 1), ("02", 2), ("03", 3), ("x", None), ("02", 2), (None, 9)], "t string, n int")
    right = spark.createDataFrame([("1", 1), ("02", 20), ("3", 3), ("y", 2), (None, 9)], "t string, n int")
    as_text, numeric = [(F.col("t"), F.col("t"))], [(F.col("n"), F.col("n"))]
    both = joins.first_match_join(left, right, [as_text, numeric])
    assert rows(both, "t", "right_n") == [("01", 1), ("02", 20), ("02", 20), ("03", 3), (None, 9)]
    assert rows(joins.first_match_join(left, right, [numeric, as_text]), "t", "right_t") == [
        ("01", "1"), ("02", "y"), ("02", "y"), ("03", "3"), (None, None),
    ]
    assert joins.first_match_join(left, right, [as_text, numeric], "left_semi").count() == 5
    many = joins.first_match_join(left, right.union(right), [as_text])
    assert many.count() == 4 and many.columns == ["t", "n", "right_t", "right_n"]


def test_composite_key_is_null_safe_after_its_first_part(spark, rows):
    left = spark.createDataFrame([(1, None), (1, 5), (None, 5)], "doc int, item int")
    right = spark.createDataFrame([(1, None), (None, 5)], "doc int, item int")
    keys = [(F.col("doc"), F.col("doc")), (F.col("item"), F.col("item"))]
    assert rows(joins.first_match_join(left, right, [keys], "left_semi")) == [(1, None)]


def test_disambiguated_join_keeps_both_columns(spark):
    a, b = spark.createDataFrame([(1, "l")], "id int, v string"), spark.createDataFrame([(1, "r", 9)], "id int, v string, w int")
    joined = join_disambiguated(a, b, lambda x, y: x["id"] == y["id"], "inner", "odi")
    assert joined.columns == ["id", "v", "odi_id", "odi_v", "w"] and joined.first()[:] == (1, "l", 1, "r", 9)


def test_schema_helpers(spark):
    df = spark.createDataFrame([("a", 1)], "Delivery string, deliveryDATE int").withColumn("At", F.current_date())
    assert resolve(df, "x", "DELIVERYDATE") == "deliveryDATE"
    assert lower_columns(df).columns == ["delivery", "deliverydate", "at"]
    assert temporal_columns(df) == ["At"]  # by type: a name with "date" or "delivery" in it is no date


def test_top_k_is_ordered_and_breaks_ties_by_value(spark, rows):
    data = [("g", x) for x in "aabbbccd"] + [("h", None), ("h", "z")]
    got = dedupe.top_k_per_group(spark.createDataFrame(data, "g string, x string"), ["g"], "x", 3, "top")
    assert rows(got) == [("g", ["b", "a", "c"]), ("h", ["z"])]


def test_hot_group_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), "id").repartition(4)
    plan = dedupe.latest_by(df, ["k"], [F.desc("id")])
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()
    assert {r.id for r in plan.collect()} == {998, 999}


def test_semi_join_on_any_key_form_moves_the_left_side_once_per_form(spark, rows):
    left = spark.createDataFrame([(1, "7", 7), (2, "x", None), (3, "y", 9), (4, None, None)], "id int, t string, n int")
    right = spark.createDataFrame([("x", 1), ("x", 1), ("z", 9), (None, 7)], "rt string, rn int")
    forms = [[(F.col("t"), F.col("rt"))], [(F.col("n"), F.col("rn"))]]
    out = joins.first_match_join(left, right, forms, "left_semi")
    assert rows(out, "id") == [(1,), (2,), (3,)]
    assert out.columns == left.columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = out._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Join") == 2
