"""Date, time and calendar expressions. All are native columns and give null, never an error, on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logilake.functions.text import to_integer

# Text forms of the source system's dates and times of day.
ODATA_DATE = r"/Date\((\d+)\)/"
ISO_DURATION = r"^PT(?:([0-9]+)H)?(?:([0-9]+)M)?(?:([0-9]+)S)?.*$"
CLOCK = r"^[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$"


def odata_date(raw: Column) -> Column:
    """``/Date(1471392000000)/`` to a timestamp; a value beyond the range of timestamps gives null."""
    millis = to_integer(F.regexp_extract(raw, ODATA_DATE, 1))
    return F.timestamp_micros(F.try_multiply(millis, F.lit(1000)))


def iso_timestamp(raw: Column) -> Column:
    return raw.try_cast("timestamp")


def any_date(raw: Column) -> Column:
    """OData date, else any timestamp text."""
    return F.coalesce(odata_date(raw), iso_timestamp(raw))


def seconds_of_day(raw: Column) -> Column:
    """``PT11H05M09S``, ``11:05:09`` or ``11:05`` to seconds; anything else, and null, is 0.

    Both forms are brought to hours:minutes:seconds by one regular expression each.
    """
    clock = (
        F.when(raw.startswith("PT"), F.regexp_replace(raw, ISO_DURATION, "$1:$2:$3"))
        .when(raw.rlike(CLOCK), raw)
        .otherwise("")
    )
    parts = F.split(clock, ":")

    def part(index: int) -> Column:
        return F.coalesce(to_integer(F.get(parts, F.lit(index))), F.lit(0))

    return part(0) * 3600 + part(1) * 60 + part(2)


def add_seconds(ts: Column, seconds: Column) -> Column:
    """Timestamp plus a whole number of seconds; fractions of a second are dropped."""
    return F.timestamp_seconds(F.unix_timestamp(ts) + seconds)


def minutes_between(later: Column, earlier: Column) -> Column:
    return (F.unix_timestamp(later) - F.unix_timestamp(earlier)) / F.lit(60.0)


def week_start_monday(ts: Column) -> Column:
    return F.to_date(F.date_trunc("week", ts))


def week_start_sunday(ts: Column) -> Column:
    return F.date_sub(F.to_date(ts), F.dayofweek(ts) - 1)


def dow_sunday_first(ts: Column) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(ts)


def dow_monday_first(ts: Column) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return F.weekday(ts) + 1


def plausible(ts: Column) -> Column:
    """Guards against placeholder dates such as year 0."""
    return ts.isNotNull() & (F.year(ts) >= 1900)
