import datetime as dt

import pytest
from pyspark.sql import functions as F

from logilake.operators import quality
from logilake.plans import silver
from logilake.sources import readers
from logilake.sources.entities import ENTITIES

SCHEMA = "k string, d string, n string, v double"
DATA = [
    ("1", "/Date(0)/", "12.5", 1.0),
    ("2", "bad", "abc", 1.0),
    ("3", None, "-3", 1.0),
    ("4", None, None, 1.0),
    ("", None, "1", 1.0),
    ("6", None, "1", float("nan")),
    (None, "bad", "1", 1.0),
    ("8", "", "1", None),
]
RULES = {"d": ["odata_date"], "n": ["numeric", "non_negative"]}


def test_required_splits_all_rows(spark, rows):
    df = spark.createDataFrame(DATA, SCHEMA)
    split = quality.validate_required(df, ["k", "v", "absent"])
    assert [r[0] for r in rows(split.valid, "k")] == ["1", "2", "3", "4"]
    assert split.valid.count() + split.reject.count() == df.count()
    assert {r.reject_reason for r in split.reject.collect()} == {"missing_required"}


def test_no_required_columns_keeps_the_reject_schema(spark):
    split = quality.validate_required(spark.createDataFrame(DATA, SCHEMA), [])
    assert split.reject.columns[-1] == "reject_reason" and split.reject.isEmpty()


def test_rules_type_valid_rows_and_keep_raw_rejects(spark, rows):
    df = spark.createDataFrame([r for r in DATA if r[0]], SCHEMA)
    valid, reject = quality.apply_quality(df, RULES)
    assert dict(valid.dtypes) == {"k": "string", "d": "timestamp", "n": "double", "v": "double"}
    assert rows(reject, "k", "d", "n", "reject_reason") == [
        ("2", "bad", "abc", "dq_d_odata_date,dq_n_numeric"),
        ("3", None, "-3", "dq_n_non_negative"),
        ("8", "", "1", "dq_d_odata_date"),
    ]
    assert [r[0] for r in rows(valid, "k")] == ["1", "4", "6"]


def test_undecidable_rule_rejects_instead_of_losing_the_row(spark, rows):
    df = spark.createDataFrame([("abc",), ("1",), (None,)], "n string")
    valid, reject = quality.apply_quality(df, {"n": ["non_negative"]})
    assert rows(reject) == [("abc", "dq_n_non_negative")] and valid.count() == 2


def test_iso_date(spark, rows):
    df = spark.createDataFrame([("2024-05-01T10:20:30Z",), ("2024-13-01",)], "t string")
    valid, reject = quality.apply_quality(df, {"t": ["iso_date"]})
    assert valid.select(F.col("t").cast("timestamp_ntz")).first()[0] == dt.datetime(2024, 5, 1, 10, 20, 30)
    assert rows(reject) == [("2024-13-01", "dq_t_iso_date")]


def test_unknown_rule_and_column_fail_at_once(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    with pytest.raises(ValueError, match="unknown quality rule"):
        quality.apply_quality(df, {"k": ["odd"]})
    with pytest.raises(ValueError, match="missing column"):
        quality.apply_quality(df, {"zz": ["numeric"]})


def test_classify_agrees_with_the_two_steps(spark, rows):
    df = spark.createDataFrame(DATA, SCHEMA)
    judged = quality.classify(df, ["k"], RULES)
    one = quality.split_classified(judged, RULES)
    first = quality.validate_required(df, ["k"])
    two = quality.apply_quality(first.valid, RULES)
    shown = ("k", "d", "n")
    assert rows(one.valid, *shown) == rows(two.valid, *shown)
    shown = (*shown, "reject_reason")
    assert rows(one.reject, *shown) == rows(first.reject.unionByName(two.reject), *shown)
    assert judged.agg(*quality.batch_counts(judged)).first()[:] == (one.valid.count(), one.reject.count())


def test_code_that_java_never_compiles_is_not_run(spark, tmp_path):
    """The rules of a wide entity come to methods of over 8000 bytes, which Java would interpret row by row."""
    (tmp_path / "a.json").write_text("")
    entity = ENTITIES["sales_order"]
    judged = silver.classify_records(readers.flatten_documents(readers.read_documents(spark, str(tmp_path), entity), entity), entity)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(judged._jdf.queryExecution().executedPlan())
    largest = max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size()))
    assert largest > 8000 >= int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
