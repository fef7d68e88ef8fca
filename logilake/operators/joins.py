"""Composite joins. Lookup sides are reduced to one row per key first, so a lookup never multiplies rows."""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logilake.operators.schema import join_disambiguated

KeyPairs = list[tuple[Column, Column]]


def unique_lookup(lookup: DataFrame, key: Column, value: str, key_name: str, value_name: str) -> DataFrame:
    """One row per non-null key with its smallest value."""
    rows = lookup.select(key.alias(key_name), F.col(value).alias(value_name))
    return rows.filter(F.col(key_name).isNotNull()).groupBy(key_name).agg(F.min(value_name).alias(value_name))


def cascade_lookup(
    left: DataFrame,
    lookup: DataFrame,
    on: list[str],
    stages: KeyPairs,
    value: str,
    out: str | None = None,
    stage_col: str | None = None,
) -> DataFrame:
    """Look ``value`` up by the first stage whose key matches; unmatched rows stay, with null.

    Each stage is (left key, lookup key), and the left keys are computed from the columns in ``on``. The distinct
    values of those columns meet the lookup in one join on (stage, key), whatever the number of stages, so keys
    that are costly to compute are computed once per value. The large side is then joined once.
    """
    out = out or value

    def keyed(keys: list[Column]) -> Column:
        """One row per stage."""
        return F.explode(F.array(*[F.struct(F.lit(i + 1).alias("_stage"), k.alias("_key")) for i, k in enumerate(keys)]))

    probes = left.select(*on).distinct().select(*on, keyed([key for key, _ in stages]).alias("_p"))
    known = lookup.select(F.col(value).alias("_value"), keyed([key for _, key in stages]).alias("_p"))
    known = known.select("_p._stage", "_p._key", "_value").filter("_key IS NOT NULL AND _value IS NOT NULL")
    known = known.groupBy("_stage", "_key").agg(F.min("_value").alias("_value"))
    found = probes.select(*on, "_p._stage", "_p._key").join(known, ["_stage", "_key"])
    hits = found.groupBy(*on).agg(F.min(F.struct("_stage", "_value")).alias("_hit"))
    hits = hits.select(*[F.col(c).alias(f"_on{i}") for i, c in enumerate(on)], "_hit")
    same = reduce(lambda x, y: x & y, [left[c].eqNullSafe(hits[f"_on{i}"]) for i, c in enumerate(on)])
    extra = [F.col("_hit._stage").alias(stage_col)] if stage_col else []
    return left.join(hits, same, "left").select(
        *[left[c] for c in left.columns], F.col("_hit._value").alias(out), *extra
    )


def _stage_key(parts: list[Column]) -> Column:
    """A composite key as text: null where its first part is null; an absent further part equals an absent one."""
    rest = [F.coalesce(p.cast("string"), F.lit("\0")) for p in parts[1:]]
    return F.when(parts[0].isNotNull(), F.concat_ws("\x01", parts[0].cast("string"), *rest))


def first_match_join(
    left: DataFrame,
    right: DataFrame,
    candidates: list[list[tuple[Column, Column]]],
    how: str = "inner",
    right_prefix: str = "right",
) -> DataFrame:
    """Join each row on the first of several composite keys that has a match; ``how`` is inner or left_semi.

    The choice is made row by row, so rows that only another key form can match are not lost. The distinct keys of
    the left side meet those of the right in one join on (stage, key), and nothing runs while the plan is built.
    A semi-join needs no choice: the left rows meet the distinct keys of each form in turn.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError("first_match_join supports inner and left_semi")
    if how == "left_semi":
        return _any_match(left, right, candidates)
    names = [f"_l{i}" for i in range(len(candidates))]
    lefts = left.withColumns({n: _stage_key([k for k, _ in keys]) for n, keys in zip(names, candidates)})

    def staged(keys: list[Column]) -> Column:
        return F.explode(F.array(*[F.struct(F.lit(i).alias("_stage"), k.alias("_key")) for i, k in enumerate(keys)]))

    right_keys = [_stage_key([k for _, k in keys]) for keys in candidates]
    rights = right.select(*right.columns, staged(right_keys).alias("_p")).filter("_p._key IS NOT NULL")
    known = rights.select("_p._stage", "_p._key").distinct()
    probes = lefts.select(*names).distinct()
    found = probes.select(*names, staged([F.col(n) for n in names]).alias("_p")).select(*names, "_p._stage", "_p._key")
    hits = found.join(known, ["_stage", "_key"]).groupBy(*names).agg(F.min(F.struct("_stage", "_key")).alias("_hit"))
    hits = hits.withColumnsRenamed({n: f"{n}_h" for n in names})
    same = reduce(lambda x, y: x & y, [lefts[n].eqNullSafe(hits[f"{n}_h"]) for n in names])
    chosen = lefts.join(hits, same).select(*left.columns, F.col("_hit._stage").alias("_ls"), F.col("_hit._key").alias("_lk"))
    keyed = rights.select(*right.columns, F.col("_p._stage").alias("_rs"), F.col("_p._key").alias("_rk"))
    joined = join_disambiguated(
        chosen, keyed, lambda x, y: (x["_ls"] == y["_rs"]) & (x["_lk"] == y["_rk"]), "inner", right_prefix
    )
    return joined.drop("_ls", "_lk", "_rs", "_rk")


def _any_match(left: DataFrame, right: DataFrame, candidates: list[list[tuple[Column, Column]]]) -> DataFrame:
    """Left rows that match by any of the key forms. Keys are computed where they are compared, so only the columns of
    the left side travel, once per form."""
    out = left
    for i, keys in enumerate(candidates):
        known = right.select(_stage_key([k for _, k in keys]).alias(f"_k{i}")).filter(f"_k{i} IS NOT NULL").distinct()
        out = out.join(known, _stage_key([k for k, _ in keys]) == known[f"_k{i}"], "left")
        out = out.withColumn(f"_m{i}", F.col(f"_k{i}").isNotNull()).drop(f"_k{i}")
    matched = reduce(lambda x, y: x | y, [F.col(f"_m{i}") for i in range(len(candidates))])
    return out.filter(matched).select(*left.columns)


def _matching_points(lefts: DataFrame, rights: DataFrame, dims: int, tol: float) -> DataFrame:
    """Distinct point pairs closer than ``tol`` in each dimension, by an equi-join on grid cells.

    A right point is copied to its cell and all neighbours, a left point looks at its own cell only. Cells are a
    shade wider than ``tol`` so that rounding in the division cannot hide a neighbour.
    """
    width = tol * (1 + 1e-6)
    cells = [f"_c{d}" for d in range(dims)]
    for d in range(dims):
        lefts = lefts.withColumn(cells[d], F.floor(F.col(f"_lx{d}") / F.lit(width)))
    around = product((-1, 0, 1), repeat=dims)
    offsets = F.array(*[F.struct(*[F.lit(o).alias(f"o{d}") for d, o in enumerate(cell)]) for cell in around])
    rights = rights.withColumn("_o", F.explode(offsets))
    for d in range(dims):
        rights = rights.withColumn(cells[d], F.floor(F.col(f"_rx{d}") / F.lit(width)) + F.col(f"_o.o{d}"))
    near = F.lit(True)
    for d in range(dims):
        near = near & (F.abs(F.col(f"_lx{d}") - F.col(f"_rx{d}")) < F.lit(tol))
    return lefts.join(rights.drop("_o"), cells).filter(near).drop(*cells)


def _points(df: DataFrame, coords: list[Column], prefix: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """The frame with named coordinates, and its distinct complete points."""
    names = [f"{prefix}{d}" for d in range(len(coords))]
    # Adding 0.0 turns -0.0 into 0.0, so equal coordinates are one point.
    tagged = df.withColumns({n: c.cast("double") + F.lit(0.0) for n, c in zip(names, coords)})
    return tagged, tagged.select(*names).dropna().distinct(), names


def tolerance_join(
    left: DataFrame, right: DataFrame, pairs: KeyPairs, tol: float, how: str = "inner", right_prefix: str = "right"
) -> DataFrame:
    """Rows whose coordinates all differ by less than ``tol``; a null coordinate never matches.

    Only distinct points are compared, so many rows at one place cost no more than one. Each side is then joined
    back by equality. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError("tolerance_join supports inner and left")
    lefts, left_points, lnames = _points(left, [a for a, _ in pairs], "_lx")
    rights, right_points, rnames = _points(right, [b for _, b in pairs], "_rx")
    points = _matching_points(left_points, right_points, len(pairs), tol)
    expanded = points.join(rights, rnames).drop(*rnames)
    expanded = expanded.withColumnsRenamed({n: f"{n}_p" for n in lnames})

    def same_point(a, b) -> Column:
        out = a[lnames[0]] == b[f"{lnames[0]}_p"]
        for n in lnames[1:]:
            out = out & (a[n] == b[f"{n}_p"])
        return out

    joined = join_disambiguated(lefts, expanded, same_point, how, right_prefix)
    return joined.drop(*lnames, *[f"{n}_p" for n in lnames])


def tolerance_lookup(
    left: DataFrame, right: DataFrame, pairs: KeyPairs, tol: float, value: str, out: str | None = None
) -> DataFrame:
    """Smallest ``value`` of the right rows within ``tol``, one row per left row; null where none is near."""
    out = out or value
    lefts, left_points, lnames = _points(left, [a for a, _ in pairs], "_lx")
    names = [f"_rx{d}" for d in range(len(pairs))]
    rights = right.select(
        *[(b.cast("double") + F.lit(0.0)).alias(n) for n, (_, b) in zip(names, pairs)], F.col(value).alias("_value")
    )
    rights = rights.dropna(subset=names).groupBy(*names).agg(F.min("_value").alias("_value"))
    near = _matching_points(left_points, rights, len(pairs), tol).groupBy(*lnames).agg(F.min("_value").alias(out))
    return lefts.join(near, lnames, "left").select(*[lefts[c] for c in left.columns], near[out])
