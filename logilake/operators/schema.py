"""Column lookup and schema shaping. Everything here is decided from the schema; no job runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve(df: DataFrame, *candidates: str) -> str | None:
    """First candidate the frame has, ignoring case, in the frame's own spelling."""
    present = {name.lower(): name for name in df.columns}
    return next((present[c.lower()] for c in candidates if c.lower() in present), None)


def column_or(df: DataFrame, default: Column, *candidates: str) -> Column:
    name = resolve(df, *candidates)
    return df[name] if name else default


def null_of(dtype: str | T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def ensure_column(df: DataFrame, name: str, dtype: str | T.DataType = "string") -> DataFrame:
    return df if resolve(df, name) else df.withColumn(name, null_of(dtype))


def rename_by_candidates(df: DataFrame, wanted: dict[str, tuple[str, tuple[str, ...]]]) -> DataFrame:
    """Keep the known columns only: ``{name: (type, candidates)}``, cast with null on failure."""
    found = {name: (resolve(df, *cands), dtype) for name, (dtype, cands) in wanted.items()}
    return df.select(*[df[src].try_cast(dtype).alias(name) for name, (src, dtype) in found.items() if src])


def temporal_columns(df: DataFrame, extra: tuple[str, ...] = ()) -> list[str]:
    """Date and timestamp columns, and the text columns named in ``extra``."""
    kinds = (T.DateType, T.TimestampType, T.TimestampNTZType)
    named = {e.lower() for e in extra}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) or f.name.lower() in named]


def join_disambiguated(
    left: DataFrame, right: DataFrame, condition, how: str = "inner", right_prefix: str = "right"
) -> DataFrame:
    """Join on ``condition(left, right)``; a right column whose name the left has becomes ``<prefix>_<name>``."""
    taken = set(left.columns)
    tagged = right.toDF(*[f"{right_prefix}_{c}" if c in taken else c for c in right.columns])
    renamed = {c: t for c, t in zip(right.columns, tagged.columns)}

    class _Right:
        def __getitem__(self, name: str) -> Column:
            return tagged[renamed[name]]

    return left.join(tagged, condition(left, _Right()), how)
