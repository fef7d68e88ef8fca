import datetime as dt

import pytest
from pyspark.sql import functions as F

from logilake.functions import dates, geo, text


def value(spark, column, data, schema):
    return spark.createDataFrame(data, schema).select(column).first()[0]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("/Date(1471392000000)/", dt.datetime(2016, 8, 17)),
        ("/Date(-1)/", None),
        ("/Date(1+0000)/", None),
        ("", None),
        (None, None),
        ("/Date(99999999999999999999)/", None),
        ("/Date(9999999999999999)/", None),
    ],
)
def test_odata_date(spark, raw, expected):
    got = value(spark, dates.odata_date(F.col("x")).cast("timestamp_ntz"), [(raw,)], "x string")
    assert got == expected


@pytest.mark.parametrize(
    "raw, seconds",
    [
        ("PT11H05M09S", 39909), ("PT7M", 420), ("PT3H", 10800), ("PT5S", 5), ("PT", 0), ("PTxx", 0), ("PT5X7M", 0),
        ("11:05:09", 39909), ("9:30", 34200), ("9:3", 0), ("noon", 0), ("", 0), (None, 0),
    ],
)
def test_seconds_of_day(spark, raw, seconds):
    assert value(spark, dates.seconds_of_day(F.col("x")), [(raw,)], "x string") == seconds


def test_weeks_and_weekdays(spark):
    sunday = [(dt.date(2024, 1, 7),)]
    assert value(spark, dates.dow_sunday_first(F.col("d")), sunday, "d date") == 1
    assert value(spark, dates.dow_monday_first(F.col("d")), sunday, "d date") == 7
    assert value(spark, dates.week_start_sunday(F.col("d")), sunday, "d date") == dt.date(2024, 1, 7)
    assert value(spark, dates.week_start_monday(F.col("d")), sunday, "d date") == dt.date(2024, 1, 1)


@pytest.mark.parametrize(
    "raw, norm",
    [
        ("Main Street 5", "main street 5"),
        ("Hà Nội, Đường Lê-Lợi", "ha noi, duong le-loi"),
        ("Königstraße  7", "konigstrasse 7"),
        ("Hộ Chí Minh", "ho chi minh"),
        ("Łódź Ærø", "lodz aero"),
        ("a_b#c", "a b c"),
        ("東京 1", "東京 1"),
        ("上海 12", "上海 12"),
        ("Москва, 5", "moskva, 5"),
        ("Київ", "kiiv"),
        ("Щёлково", "shchelkovo"),
        ("Αθήνα Ψυχικό", "athina psychiko"),
        ("दिल्ली", "दिल्ली"),
        ("  ", None),
        ("", None),
        (None, None),
    ],
)
def test_normalise_address(spark, raw, norm):
    assert value(spark, text.normalise_address(F.col("x")), [(raw,)], "x string") == norm


def test_normalise_address_without_punctuation(spark):
    assert value(spark, text.normalise_address(F.col("x"), keep_punctuation=False), [("A-b, c",)], "x string") == "a b c"


@pytest.mark.parametrize(
    "raw, number",
    [("0080000123", "80000123"), (" 123 ", "123"), ("", None), ("00", "0"), ("AB-1", "ab-1"), (None, None), ("0180000001", "180000001")],
)
def test_document_number(spark, raw, number):
    assert value(spark, text.document_number(F.col("x")), [(raw,)], "x string") == number


def test_prefix_is_taken_literally(spark):
    assert value(spark, text.strip_prefix(F.col("x"), "e.m:"), [("ewm:1",)], "x string") == "ewm:1"
    assert value(spark, text.strip_prefix(F.col("x"), "ewm:"), [("ewm:1",)], "x string") == "1"


@pytest.mark.parametrize("raw, number", [("000010", 10), ("", None), ("x", None), ("99999999999", None)])
def test_item_number(spark, raw, number):
    assert value(spark, text.item_number(F.col("x")), [(raw,)], "x string") == number


def test_haversine(spark):
    km = value(
        spark, geo.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")), [(0.0, 0.0, 0.0, 180.0)],
        "a double, b double, c double, d double",
    )
    none = value(spark, geo.haversine_km(F.col("a"), F.col("a"), F.col("a"), F.col("a")), [(None,)], "a double")
    assert none is None
    assert km == pytest.approx(3.141592653589793 * 6371.0)
    assert value(spark, geo.travel_minutes(F.col("a")), [(25.0,)], "a double") == 30.0


def test_packed_ids(spark):
    ids = ["", "a", "ab", "0AB1", "ewm:wh1", "é", "ff" * 32, "0g", "00", "a" * 10_001, None]
    rows = spark.createDataFrame([(i,) for i in ids], "id string").withColumn("packed", text.packed_id(F.col("id")))
    got = rows.select("id", "packed", text.unpacked_id(F.col("packed")).alias("back")).collect()
    assert [r.back for r in got] == ids
    assert len({bytes(r.packed) for r in got if r.packed is not None}) == len(ids) - 1
    assert len(got[6].packed) == 33
