"""Sharding by histogram sort: shards of nearly equal bytes, found by counting bytes below candidate boundaries.

The sort key is (hash of the text, hash of the id), so equal texts are neighbours. Rounds of exact byte counts narrow
a bracket around each of the ``shards - 1`` targets: every round splits the open brackets into ``PROBES`` equal
ranges and reads only the rows inside them. A splitter is done when the bytes below it are within ``tolerance`` of
its target (a share of a shard), or when its bracket is a single key. A text whose copies alone exceed the tolerance
is split inside by the hash of the id. Then each row gets its shard in one exchange.

Law: ``bytes``. Sizes of shards differ by at most twice the tolerance plus the largest single row. A group of equal
texts stays in one shard unless that would break the law.

Slots run from 0 without gaps. A shard's rows are numbered in ``cells`` of some ten thousand rows each, so that no
task sorts a whole shard: cell first, then key.

Defined cases: a null text has size 1 and the crc of the empty text. A null ``doc_id`` hashes like any value. Rows
that repeat both id and text share one key and stay together. With an empty table the result is empty; shards may
be empty if there are fewer keys than shards. Only ``doc_id`` and ``text`` are read for the placement, and the
placing columns have the names that ``place`` is told, so clashing further columns are not touched by the query.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logilake.llm.common import query, staged, table, whole_text

SHARDS = 16
TOLERANCE = 0.002
PROBES = 64
ROWS_PER_CELL = 50_000
KEY_SPACE = 1 << 62


class Splitter(NamedTuple):
    """Rows from (text key, id key) on lie above it."""

    text_key: int
    id_key: int


def _key(*columns: str | Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def text_key() -> Column:
    return _key(whole_text())


def id_key() -> Column:
    return _key(F.col("doc_id"))


def size() -> Column:
    return F.octet_length(whole_text()).cast("long") + 1


class _Bracket(NamedTuple):
    """Keys in [low, high) hold the target; ``below`` is the exact measure of all rows before ``low``."""

    low: int
    high: int
    below: int


class _Range(NamedTuple):
    bytes: int
    rows: int
    first: int
    last: int


def _count(keys: DataFrame, key: str, brackets: list[_Bracket]) -> dict[tuple[_Bracket, int], _Range]:
    """What each probe range of each bracket holds, from the rows inside the brackets only."""
    inside = [(F.col(key) >= b.low) & (F.col(key) < b.high) for b in brackets]
    place = F.coalesce(
        *[
            F.when(held, F.lit(i * PROBES) + F.shiftright(F.col(key) - b.low, _step(b).bit_length() - 1))
            for i, (b, held) in enumerate(zip(brackets, inside, strict=True))
        ]
    )
    found = (
        keys.where(reduce(lambda a, b: a | b, inside))
        .groupBy(place.alias("place"))
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min(key).alias("first"), F.max(key).alias("last"))
        .collect()
    )
    return {(brackets[r.place // PROBES], r.place % PROBES): _Range(r.bytes, r.n, r.first, r.last) for r in found}


def _step(b: _Bracket) -> int:
    """Width of a probe range: a power of two, as the key space and PROBES are."""
    return max(1, (b.high - b.low) // PROBES)


def _search(keys: DataFrame, key: str, targets: list[int], slack: float, below: int = 0):
    """For each target the boundary that comes nearest, and a bracket if copies of one key hide a nearer one."""
    open_ = {t: _Bracket(0, KEY_SPACE, below) for t in targets}
    done: dict[int, tuple[int, _Bracket | None]] = {}
    while open_:
        counts = _count(keys, key, sorted(set(open_.values())))
        for target, b in list(open_.items()):
            before, step = b.below, _step(b)
            filled = sorted((i, r) for (owner, i), r in counts.items() if owner == b)
            for i, held in filled:
                if before + held.bytes >= target or i == filled[-1][0]:
                    break
                before += held.bytes
            at = b.low + i * step
            one = held.first == held.last
            low, high = target - before, before + held.bytes - target
            if min(low, high) <= slack or one and held.rows == 1:
                edge = held.last + 1 if one else at + step
                done[target] = (at if low <= high else edge, None)
            elif one:
                done[target] = (held.first, _Bracket(held.first, held.first + 1, before))
            else:
                open_[target] = _Bracket(at, at + step, before)
                continue
            del open_[target]
    return done


def splitters(keys: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE) -> list[Splitter]:
    """``shards - 1`` boundaries over a staged frame of (text_key, id_key, size)."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [Splitter(KEY_SPACE, 0)] * (shards - 1)
    targets = [total * i // shards for i in range(1, shards)]
    slack = tolerance * total / shards
    by_text = _search(keys, "text_key", targets, slack)
    cuts = [Splitter(at, 0) for at, bracket in by_text.values() if bracket is None]
    hot: dict[_Bracket, list[int]] = {}
    for target, (_, bracket) in by_text.items():
        if bracket is not None:
            hot.setdefault(bracket, []).append(target)
    for bracket, inside in hot.items():
        copies = keys.where(F.col("text_key") == bracket.low)
        cuts += [Splitter(bracket.low, at) for at, _ in _search(copies, "id_key", inside, slack, bracket.below).values()]
    return sorted(cuts)


def shard_of(cuts: list[Splitter], text: str = "text_key", id_: str = "id_key") -> Column:
    """Number of splitters at or below a row's key."""
    above = [
        ((F.col(text) > c.text_key) | ((F.col(text) == c.text_key) & (F.col(id_) >= c.id_key))).cast("int") for c in cuts
    ]
    return reduce(lambda a, b: a + b, above, F.lit(0))


def place(
    docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, shard: str = "shard", slot: str = "slot"
) -> DataFrame:
    """The documents with their shard and slot; the one exchange moves each row to its shard's cell."""
    keyed = docs.withColumns({"text_key": text_key(), "id_key": id_key()})
    keys = staged(keyed.select("text_key", "id_key", size().alias("size")), "shard-keys")
    cuts = splitters(keys, shards, tolerance)
    # Cells follow the id's hash, which spreads the copies of a text too. Their number follows the rows.
    cells = max(1, keys.count() // shards // ROWS_PER_CELL)
    cell = F.pmod(F.col("id_key"), F.lit(cells))
    sizes = keys.select(shard_of(cuts).alias(shard), cell.alias("cell")).groupBy(shard, "cell").agg(F.count(F.lit(1)).alias("n"))
    before = f"coalesce(sum(n) OVER (PARTITION BY {shard} ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    starts = sizes.select(shard, "cell", F.expr(before).alias("start"))
    rank = F.expr(f"row_number() OVER (PARTITION BY {shard}, cell ORDER BY text_key, id_key) - 1")
    placed = keyed.withColumns({shard: shard_of(cuts), "cell": cell}).join(starts, [shard, "cell"])
    return placed.withColumn(slot, (F.col("start") + rank).cast("long")).drop("text_key", "id_key", "cell", "start")


@query("op8_histogram_shards")
def op8(spark, sf_dir):
    """All documents in 16 shards of nearly equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = place(docs.withColumns({"size": size(), "text_crc32": F.crc32(whole_text().cast("binary"))}))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
