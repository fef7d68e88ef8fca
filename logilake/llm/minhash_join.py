"""Near-duplicate documents by an inverted join of MinHash signature coordinates.

1. Each whole text becomes its set of word shingles (as 64-bit hashes) and a signature of ``coordinates`` minima.
   Texts with the same set form a class; only one of a class goes on.
2. Two sets of similarity ``percent`` agree in at least ``matches`` coordinates but for a chance of ``MISS``. Sets
   that agree in that many of n coordinates agree in one of the first n - matches + 1: only these are posted.
3. Posting lists are read in sorted order. Within a list, collisions are counted over the whole signature, skipping
   pairs whose set sizes rule the similarity out and pairs that met in an earlier list. Documents that have a
   partner go on. A list of more than ``LIST_BLOCK`` documents is dealt out as pairs of blocks, so no task holds it.
4. Those documents' full sets meet in the same lists, again in pairs of blocks, and each pair is confirmed on them
   exactly, unless the two are already known to be connected. Pairs are not emitted: a block pair gives at most one
   row per document, naming the smallest one it is connected with.
5. Connected components of these rows, over classes, give every document's component.

Defined cases: a null or blank text has no shingles and is linked with nothing. A text of fewer words than a shingle
has one shingle, the whole sequence. A null ``doc_id`` is linked with nothing, has no component and is kept. Rows
that repeat an id with another text are documents of their own that share a component; the filter judges each such row
by its own text, and keeps one of rows that repeat both id and text. An empty table gives an empty result. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logilake.llm.common import query, staged, table
from logilake.llm.components import components

COORDINATES = 32
MISS = 1e-5
LIST_BLOCK = 2048
SET_BLOCK = 256
KNOWN_WORDS = 500_000
SEED = 20240229


class Rule(NamedTuple):
    """What counts as near: shingles of ``words`` words, 100 * intersection >= percent * union."""

    words: int
    percent: int
    coordinates: int = COORDINATES

    @property
    def matches(self) -> int:
        """Coordinates that sets of the least similarity share but for a chance of MISS."""
        n, p = self.coordinates, self.percent / 100
        below, k = 0.0, 0
        while k < n:
            below += math.comb(n, k) * p**k * (1 - p) ** (n - k)
            if below > MISS:
                break
            k += 1
        return max(1, k)

    @property
    def posted(self) -> int:
        return self.coordinates - self.matches + 1


_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_S = np.uint64(33)


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> _S
    h *= _B
    h ^= h >> np.uint64(29)
    h *= _C
    h ^= h >> np.uint64(32)
    return h


class Shingler:
    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingles; A-Z lower-cased, words parted by ASCII white space."""
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        each = self._hashes(words)
        k = min(self.words, len(words))
        n = len(words) - k + 1
        h = np.full(n, np.uint64(k))
        for i in range(k):
            h = h * _A + each[i : i + n]
            h ^= h >> _S
        return np.unique(_mix(h))


def signer(coordinates: int):
    factors = np.random.RandomState(SEED).randint(0, 2**62, coordinates).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(shingles: np.ndarray) -> np.ndarray:
        low = np.full(coordinates, np.uint64(2**64 - 1))
        for start in range(0, len(shingles), 1 << 15):
            part = shingles[start : start + (1 << 15)]
            low = np.minimum(low, (part[None, :] * factors[:, None]).min(axis=1))
        return (low >> np.uint64(32)).astype(np.uint32)

    return sign


def signatures(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, a 128-bit print of the set, and the signature's coordinates."""

    def run(batches):
        shingle, sign = Shingler(rule.words), signer(rule.coordinates)
        for batch in batches:
            sizes, prints, signed = [], [], []
            for text in batch.column(1).to_pylist():
                own = shingle(text)
                sizes.append(len(own))
                prints.append(xxhash.xxh3_128_hexdigest(own.tobytes()))
                signed.append(sign(own).view(np.int32) if len(own) else np.empty(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints), pa.array(signed, pa.list_(pa.int32()))],
                ["doc_id", "n_shingles", "print", "signature"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_shingles long, print string, signature array<int>"
    )


def _dealt(rows: DataFrame, block: int) -> DataFrame:
    """Rows of the lists (at, value), each of ``m`` rows, as pairs of blocks in sorted order."""
    blocks = F.ceil(F.col("m") / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .drop("blocks", "other", "m")
        .repartition("at", "value", "low", "high")
        .sortWithinPartitions("at", "value", "low", "high")
    )


KEYS = ["at", "value", "low", "high"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal keys in sorted batches; a run may span batches."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in KEYS])
        edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        bounds = [0, *edges.tolist(), batch.num_rows]
        for start, end in zip(bounds, bounds[1:], strict=False):
            key = tuple(keys[:, start].tolist())
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


class _Block(NamedTuple):
    """Two sides of a block pair (the same one twice if low = high), sorted by set size."""

    at: int
    reps: np.ndarray
    sizes: np.ndarray
    signs: np.ndarray
    own: np.ndarray
    crossed: bool


def _block(rows: pa.Table) -> _Block:
    low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
    flat = rows.column("signature").combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return _Block(
        rows.column("at")[0].as_py(),
        rows.column("rep").to_numpy(),
        rows.column("n_shingles").to_numpy(),
        flat.to_numpy().reshape(rows.num_rows, -1),
        rows.column("own").to_numpy(),
        low != high,
    )


def _partners(block: _Block, i: int, rule: Rule) -> np.ndarray:
    """Places behind i that collide with it often enough, for the first time here, and are of a size that can do."""
    sizes, signs, n = block.sizes, block.signs, block.sizes[i]
    rest = slice(i + 1, None)
    fit = (100 * np.minimum(sizes[rest], n) >= rule.percent * np.maximum(sizes[rest], n)).nonzero()[0] + i + 1
    if block.crossed:
        fit = fit[block.own[fit] != block.own[i]]
    if not fit.size:
        return fit
    # The coordinates before this list's own must differ; they are compared first, and most pairs of a later list
    # end there.
    if block.at:
        fit = fit[(signs[fit, : block.at] != signs[i, : block.at]).all(axis=1)]
        if not fit.size:
            return fit
    return fit[(signs[fit] == signs[i]).sum(axis=1) >= rule.matches]


def _with_partner(batches, rule: Rule):
    """(at, value, rep) of the documents that have a partner in a list."""
    for rows in _groups(batches):
        block = _block(rows)
        found = np.zeros(len(block.reps), bool)
        for i in range(len(block.reps) - 1):
            partners = _partners(block, i, rule)
            if partners.size:
                found[i] = True
                found[partners] = True
        if found.any():
            kept = rows.filter(pa.array(found)).select(["at", "value", "rep"])
            yield from kept.to_batches()


def _connections(batches, rule: Rule):
    """(a, b): a is connected with the smaller b by confirmed links of this block pair."""
    for rows in _groups(batches):
        block = _block(rows)
        count = len(block.reps)
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
        _, dense = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum([len(s) for s in sets])
        local = np.split(dense, ends[:-1])
        mark = np.zeros(int(dense.max()) + 1, bool)
        parent = list(range(count))

        def root(x: int, parent=parent) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        roots = np.arange(count)
        for i in range(count - 1):
            partners = _partners(block, i, rule)
            partners = partners[roots[partners] != roots[i]]
            if not partners.size:
                continue
            mark[local[i]] = True
            starts = np.cumsum([0] + [len(local[j]) for j in partners[:-1]])
            common = np.add.reduceat(mark[np.concatenate([local[j] for j in partners])], starts, dtype=np.int64)
            mark[local[i]] = False
            union = block.sizes[i] + block.sizes[partners] - common
            linked = partners[100 * common >= rule.percent * union]
            for j in linked:
                parent[root(int(j))] = root(i)
            if linked.size:
                roots = np.array([root(x) for x in range(count)])
        smallest: dict[int, int] = {}
        for r, rep in zip(roots.tolist(), block.reps.tolist(), strict=True):
            smallest[r] = min(rep, smallest.get(r, rep))
        pairs = [(rep, smallest[r]) for r, rep in zip(roots.tolist(), block.reps.tolist(), strict=True) if smallest[r] < rep]
        if pairs:
            a, b = zip(*pairs, strict=True)
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _shingle_sets(docs: DataFrame, rule: Rule) -> DataFrame:
    def run(batches):
        shingle = Shingler(rule.words)
        for batch in batches:
            sets = [shingle(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(xxhash.xxh3_128_hexdigest, sets), pa.string()), pa.array(sets, pa.binary())],
                ["rep", "print", "shingles"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "rep long, print string, shingles binary")


def _listed(rows: DataFrame) -> DataFrame:
    """Rows (at, value, rep) of lists of two or more, with the list's length m."""
    long = rows.groupBy("at", "value").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    return rows.join(long, ["at", "value"])


def near_components(docs: DataFrame, rule: Rule) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document. Ids are integers."""
    signed = staged(signatures(docs, rule), "signatures")
    able = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = staged(
        able.groupBy("print", "n_shingles").agg(
            F.min("doc_id").cast("long").alias("rep"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    postings = classes.select("rep", F.posexplode(F.slice("signature", 1, rule.posted)).alias("at", "value"))
    signs = classes.select("rep", "print", "n_shingles", "signature")
    lists = _dealt(_listed(postings).join(signs.drop("print"), "rep"), LIST_BLOCK)
    kept = staged(
        lists.mapInArrow(lambda b: _with_partner(b, rule), "at int, value int, rep long").distinct(), "candidates"
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = texts.join(kept.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = _shingle_sets(texts, rule)
    full = _dealt(_listed(kept).join(signs.join(sets, ["rep", "print"]).drop("print"), "rep"), SET_BLOCK)
    merged = components(full.mapInArrow(lambda b: _connections(b, rule), "a long, b long"))
    named = (
        classes.select("print", "n_shingles", "rep")
        .join(merged.withColumnRenamed("node", "rep"), "rep", "left")
        .select("print", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    )
    out = signed.select("doc_id", "print", "n_shingles").join(named, ["print", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def drop_near_copies(docs: DataFrame, rule: Rule) -> DataFrame:
    """Documents of the smallest id of each group, all columns as they were."""
    again = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    if again.isEmpty():
        dropped = near_components(docs, rule).where("NOT kept").select("doc_id")
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    # Ids do not tell rows apart: a key does, in the order of the ids.
    key = "row_key"
    while key in docs.columns:
        key += "_"
    once = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id IS NULL"))
    ordered = once.orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text"))
    rows = staged(ordered.withColumn(key, F.monotonically_increasing_id()), "keyed-rows")
    known = F.when(F.col("doc_id").isNotNull(), F.col(key))
    lost = near_components(rows.select(known.alias("doc_id"), "text"), rule).where("NOT kept")
    lost = lost.select(F.col("doc_id").alias("lost"), "component_id")
    # Rows with the winner's own id stay, as that id's other documents.
    ids = rows.select(F.col(key).alias("lost"), F.col("doc_id").alias("id"))
    winners = rows.select(F.col(key).alias("component_id"), F.col("doc_id").alias("winner"))
    dropped = lost.join(ids, "lost").join(winners, "component_id").where("id <> winner").select(F.col("lost").alias(key))
    return rows.join(dropped, key, "left_anti").select(*docs.columns)


OP1 = Rule(words=3, percent=85)
NEAR = Rule(words=5, percent=80)


@query("op1_minhash_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-equal documents."""
    return near_components(table(spark, sf_dir, "documents"), OP1)
