"""Rule-driven data quality: required columns, typed rules, reject reasons, counters."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logilake.functions import dates, text

REJECT_REASON = "reject_reason"


class Split(NamedTuple):
    valid: DataFrame
    reject: DataFrame


PARSERS: dict[str, Callable[[Column], Column]] = {
    "odata_date": dates.odata_date,
    "iso_date": dates.iso_timestamp,
    "numeric": lambda raw: raw.try_cast("double"),
}
RULES = (*PARSERS, "non_negative")


def _check_rules(df: DataFrame, rules: dict[str, list[str]]) -> None:
    for name, checks in rules.items():
        if name not in df.columns:
            raise ValueError(f"quality rule on a missing column: {name}")
        unknown = [c for c in checks if c not in RULES]
        if unknown:
            raise ValueError(f"unknown quality rule on {name}: {unknown}; known rules are {RULES}")


def _is_present(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return df[name].isNotNull() & ~F.isnan(df[name])
    if isinstance(kind, T.StringType):
        return text.non_blank(df[name])
    return df[name].isNotNull()


def _required_ok(df: DataFrame, required: list[str]) -> Column:
    checks = [_is_present(df, c) for c in required if c in df.columns]
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def _rule_ok(raw: Column, rule: str, checks: list[str]) -> Column:
    """Null passes every rule; a rule that can't be decided fails."""
    if rule == "non_negative":
        number = raw.try_cast("double")
        ok = number >= 0
        if "numeric" in checks[: checks.index(rule)]:
            ok = ok | number.isNull()  # unparseable: reported by the numeric rule alone
    else:
        ok = PARSERS[rule](raw).isNotNull()
    return raw.isNull() | F.coalesce(ok, F.lit(False))


def _rule_reasons(df: DataFrame, rules: dict[str, list[str]], prefix: str) -> Column:
    """Failed rules joined by commas, in rule order; null when none failed."""
    failed = [
        F.when(~_rule_ok(df[name], rule, checks), F.lit(f"{prefix}_{name}_{rule}"))
        for name, checks in rules.items()
        for rule in checks
    ]
    return text.blank_to_null(F.concat_ws(",", *failed)) if failed else F.lit(None).cast("string")


def parsed_columns(df: DataFrame, rules: dict[str, list[str]]) -> DataFrame:
    """Replace ruled columns by their parsed value; the last parsing rule of a column decides its type."""
    typed = {}
    for name, checks in rules.items():
        for rule in checks:
            if rule in PARSERS:
                typed[name] = PARSERS[rule](df[name])
    return df.withColumns(typed) if typed else df


def classify(
    df: DataFrame, required: list[str] = (), rules: dict[str, list[str]] | None = None, prefix: str = "dq"
) -> DataFrame:
    """Add ``reject_reason`` (null for good rows) and keep the raw values, in one pass.

    A row without its required columns gets that reason alone, as its rules are not looked at.
    """
    rules = rules or {}
    _check_rules(df, rules)
    reason = F.when(~_required_ok(df, list(required)), F.lit("missing_required")).otherwise(
        _rule_reasons(df, rules, prefix)
    )
    return df.withColumn(REJECT_REASON, reason)


def split_classified(classified: DataFrame, rules: dict[str, list[str]] | None = None) -> Split:
    """Typed valid rows without the reason, raw rejected rows with it."""
    reason = F.col(REJECT_REASON)
    valid = parsed_columns(classified.filter(reason.isNull()).drop(REJECT_REASON), rules or {})
    return Split(valid, classified.filter(reason.isNotNull()))


def outcome() -> Column:
    """``valid`` or ``reject``; staged rows are partitioned by it."""
    return F.when(F.col(REJECT_REASON).isNull(), "valid").otherwise("reject")


def validate_required(df: DataFrame, required: list[str], reason: str = "missing_required") -> Split:
    ok = _required_ok(df, required)
    return Split(df.filter(ok), df.filter(~ok).withColumn(REJECT_REASON, F.lit(reason)))


def apply_quality(df: DataFrame, rules: dict[str, list[str]], prefix: str = "dq") -> Split:
    return split_classified(classify(df, (), rules, prefix), rules)


def with_reject_meta(df: DataFrame, batch_id: str, job: str, as_of: Column) -> DataFrame:
    return df.withColumns(
        {
            "reject_batch_id": F.lit(batch_id),
            "reject_job_name": F.lit(job),
            "reject_timestamp": as_of,
            "reject_date": F.to_date(as_of),
        }
    )


def batch_counts(classified: DataFrame) -> list[Column]:
    """Aggregates for ``observe`` or ``agg``: one pass gives both counters of the batch log."""
    rejected = F.count_if(F.col(REJECT_REASON).isNotNull())
    return [
        (F.count(F.lit(1)) - rejected).alias("records_processed"),
        rejected.alias("records_rejected"),
    ]


def batch_log_row(counts: DataFrame, batch_id: str, job: str, status: str, as_of: Column) -> DataFrame:
    """Batch-log row from a one-row frame of counters."""
    return counts.select(
        F.lit(batch_id).alias("batch_id"),
        as_of.alias("timestamp"),
        F.col("records_processed").cast("int").alias("records_processed"),
        F.col("records_rejected").cast("int").alias("records_rejected"),
        F.lit(status).alias("status"),
        F.lit(job).alias("job_name"),
    )


def coverage_summary(df: DataFrame, run_ts: Column, **conditions: Column) -> DataFrame:
    """One-row table of counters: the run time, and the rows that meet each named condition."""
    return df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()]).select(
        run_ts.alias("run_ts"), *conditions
    )
