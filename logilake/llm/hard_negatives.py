"""Hard-negative mining by L2AP-style threshold joins over integer vectors.

Per anchor two searches: the best rows of its label (positives), and per positive the best rows of other labels whose
score lies between ``LEAST`` of the positive's score and that score (negatives). Both are windows of ``k`` places with
a floor and a ceiling, and both are filled in the same way, task by task over blocks of rows:

- Components are put in one order, strongest first over the anchors. A row stands in the inverted index under its
  leading components only: those from the point on where the norm of its rest, times any anchor's norm, stays under the
  threshold are omitted.
- Posting lists are walked component by component (in strips, as products of matrices) and add up partial scores. After
  each strip a row and anchor are given up if partial score plus the product of both remaining norms stays under the
  anchor's threshold. What survives gets the omitted components' exact share.
- A threshold starts high and is lowered, from one step of a schedule to the next, until the anchor's windows are full
  or it has reached their floors. A full window's last score is a threshold that later blocks of the task start from.

So nothing is approximate: a row is only given up when it cannot enter a window. Each task sends at most ``k`` rows
per window, and Spark keeps the best ``k`` of them. Anchors are dealt by a hash of their id into batches of about
``ANCHORS`` (the stated query set, in blocks), which alone are sent to the tasks; rows never move.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part. Of scores
that tie the smaller id comes first. Rows that repeat an id are rows of their own, but never positives of an anchor
with that id; an anchor that repeats exactly is one anchor. A shorter vector ends in zeros. Numbers are exact; a score
beyond 64 bits fails the job. Empty tables, and anchors without positives or negatives, give no rows. Only the three
columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logilake.llm.common import query, staged, table

POSITIVES = NEGATIVES = 5
LEAST = (80, 100)  # 80 * positive <= 100 * negative
ANCHOR_IDS = 100
SCALE = 256
ANCHORS = 8192  # anchors that are sent at once
BLOCK = 4096  # rows of one index
GROUP = 256  # anchors that walk it together
STRIP = 8  # components between two prunings
LOWEST = -(1 << 62)

# Thresholds by step, as shares: of the largest possible score, and of the highest ceiling.
POSITIVE_STEPS = (0.5, 0.25, 0.1, 0.0)
NEGATIVE_STEPS = (0.95, 0.9, 0.85, 0.8)


def taking_part(vectors: DataFrame) -> DataFrame:
    """vec_id, the label that counts, and the vector."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), shifted.cast("long").alias("label"), "embedding"
    )


def integers(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of floor(256 x) as whole doubles, with zeros after a vector's end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    sizes = np.asarray(column.value_lengths())
    if width is None:
        width = int(sizes.max(initial=0))
    if len(sizes) and sizes.min() == sizes.max() == width:
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    for i, (end, n) in enumerate(zip(np.cumsum(sizes), sizes, strict=True)):
        out[i, : min(n, width)] = flat[end - n : end][:width]
    return out


class Rows(NamedTuple):
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray

    def pick(self, where) -> Rows:
        return Rows(self.ids[where], self.labels[where], self.x[where])


def tails(x: np.ndarray) -> np.ndarray:
    """Norm of each row's components from each place on, an empty rest included."""
    squares = np.zeros((x.shape[0], x.shape[1] + 1))
    squares[:, :-1] = np.cumsum(np.square(x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(squares)


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of paired rows: in doubles while they hold whole numbers, else in Python's integers."""
    if not x.size or np.abs(x).max() * np.abs(q).max() * x.shape[1] < 2**53:
        return np.einsum("ij,ij->i", x, q).astype(np.int64)
    whole = [sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for u, v in zip(x, q, strict=True)]
    return np.array(whole, dtype=np.int64)


class Index:
    """Inverted index of a block's rows, whose components and norms are in the anchors' order."""

    def __init__(self, x: np.ndarray):
        self.x, self.tails = x, tails(x)

    def search(self, q: np.ndarray, q_tails: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) of all pairs that may score ``least`` of the anchor or more."""
        width = self.x.shape[1]
        norms = np.maximum(q_tails[:, 0], 1e-12)
        share = (least / norms).min()
        # Where a row's indexed part ends; rows that end at once stand in no posting list.
        cut = (self.tails >= _safe(share)).sum(axis=1) if share > 0 else np.full(len(self.x), width + 1)
        rows = np.argsort(-cut, kind="stable")
        rows = rows[: int((cut > 0).sum())]
        cut = np.minimum(cut[rows], width)
        partial = np.zeros((len(rows), len(q)))
        alive = np.ones(partial.shape, bool)
        for at in range(0, width, STRIP):
            to = min(at + STRIP, width)
            held = int(np.searchsorted(-cut, -at, side="left"))  # posting lists of this strip are leading rows
            if held:
                partial[:held] += self.x[rows[:held], at:to] @ q[:, at:to].T
                known = np.maximum(to, 0)
                bound = partial[:held] + self.tails[rows[:held], known, None] * q_tails[None, :, known]
                alive[:held] &= bound >= _safe(least)
            else:
                break
            # Rows without a living anchor leave the posting lists.
            keep = alive.any(axis=1)
            if not keep.all():
                rows, cut, partial, alive = rows[keep], cut[keep], partial[keep], alive[keep]
            if not len(rows):
                break
        found = np.nonzero(alive)
        return rows[found[0]], found[1]


def _safe(bound):
    """Slightly less, for the rounding of norms."""
    return bound - np.abs(bound) * 1e-9 - 1e-6


class Best:
    """The best ``k`` rows of each window of each anchor that one task has seen."""

    def __init__(self, anchors: int, windows: int, k: int):
        self.scores = np.full((anchors, windows, k), LOWEST, np.int64)
        self.ids = np.zeros((anchors, windows, k), np.int64)

    def add(self, anchor: np.ndarray, ids: np.ndarray, scores: np.ndarray, window: int) -> None:
        if not len(anchor):
            return
        k = self.scores.shape[2]
        some = np.unique(anchor)
        a = np.concatenate([np.repeat(some, k), anchor])
        s = np.concatenate([self.scores[some, window].ravel(), scores])
        i = np.concatenate([self.ids[some, window].ravel(), ids])
        order = np.lexsort((i, -s, a))
        a, s, i = a[order], s[order], i[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        first = place < k
        self.scores[a[first], window, place[first]] = s[first]
        self.ids[a[first], window, place[first]] = i[first]

    def floors(self, floors: np.ndarray) -> np.ndarray:
        """Per anchor and window the score under which no row can enter."""
        return np.maximum(self.scores[:, :, -1], floors)


class Search(NamedTuple):
    """What one pass looks for: per anchor and window a floor and a ceiling, and which labels count."""

    anchors: Rows
    order: np.ndarray  # of the components
    floors: np.ndarray
    ceilings: np.ndarray
    same_label: bool
    steps: tuple[float, ...]
    k: int

    def blocks(self, batches) -> Iterator[Rows]:
        held: list[Rows] = []
        for batch in batches:
            if batch.num_rows:
                x = integers(batch.column(2), self.anchors.x.shape[1])
                held.append(Rows(np.asarray(batch.column(0)), np.asarray(batch.column(1)), x[:, self.order]))
            if sum(len(h.ids) for h in held) >= BLOCK:
                yield Rows(*map(np.concatenate, zip(*held, strict=True)))
                held = []
        if held:
            yield Rows(*map(np.concatenate, zip(*held, strict=True)))

    def run(self, batches) -> Best:
        best = Best(len(self.anchors.ids), self.floors.shape[1], self.k)
        q = self.anchors.x[:, self.order]
        q_tails = tails(q)
        for block in self.blocks(batches):
            if self.same_label:
                for label in np.intersect1d(block.labels, self.anchors.labels):
                    own = block.pick(block.labels == label)
                    self._groups(own, np.flatnonzero(self.anchors.labels == label), q, q_tails, best)
            else:
                self._groups(block, np.arange(len(q)), q, q_tails, best)
        return best

    def _groups(self, rows: Rows, anchors: np.ndarray, q: np.ndarray, q_tails: np.ndarray, best: Best) -> None:
        index = Index(rows.x)
        for at in range(0, len(anchors), GROUP):
            self._fill(rows, index, anchors[at : at + GROUP], q, q_tails, best)

    def _fill(self, rows: Rows, index: Index, own: np.ndarray, q: np.ndarray, q_tails: np.ndarray, best: Best) -> None:
        """Lower the anchors' thresholds until their windows are full."""
        wanted = self.floors[own] <= self.ceilings[own]
        own = own[wanted.any(axis=1)]
        above = np.full(len(own), -LOWEST)  # scores from here on have been seen
        for step in (*self.steps, None):
            if not len(own):
                return
            floors = best.floors(self.floors)[own]
            floors = np.where(self.floors[own] <= self.ceilings[own], floors, -LOWEST).min(axis=1)
            if step is None:
                least = floors
            else:
                top = self.ceilings[own].max(axis=1)
                free = top >= -LOWEST
                top = np.where(free, q_tails[own, 0] * index.tails[:, 0].max(), top)
                least = np.maximum(floors, np.floor(step * top).astype(np.int64))
            r, a = index.search(q[own], q_tails[own], least.astype(float))
            self._take(rows, r, own, a, q, least, above, best)
            left = least > np.where(self.floors[own] <= self.ceilings[own], best.floors(self.floors)[own], -LOWEST).min(axis=1)
            own, above = own[left], least[left]

    def _take(self, rows: Rows, r, own, a, q, least, above, best: Best, at_once: int = 1 << 16) -> None:
        for at in range(0, len(r), at_once):
            ri, ai = r[at : at + at_once], a[at : at + at_once]
            anchor = own[ai]
            if self.same_label:
                use = rows.ids[ri] != self.anchors.ids[anchor]
            else:
                use = rows.labels[ri] != self.anchors.labels[anchor]
            ri, ai, anchor = ri[use], ai[use], anchor[use]
            scores = _products(rows.x[ri], q[anchor])
            new = (scores >= least[ai]) & (scores < above[ai])
            ri, anchor, scores = ri[new], anchor[new], scores[new]
            for w in range(self.floors.shape[1]):
                inside = (scores >= self.floors[anchor, w]) & (scores <= self.ceilings[anchor, w])
                best.add(anchor[inside], rows.ids[ri[inside]], scores[inside], w)


FOUND = "anchor int, window int, id long, score long"


def _search(rows: DataFrame, search: Search) -> DataFrame:
    """The best rows of each window over all tasks, with their rank from 1."""
    # Plain values, as executors need not have this package.
    a, others = search.anchors, search[1:]
    sent = rows.sparkSession.sparkContext.broadcast((a.ids, a.labels, a.x, others))

    def run(batches):
        ids, labels, x, others = sent.value
        best = Search(Rows(ids, labels, x), *others).run(batches)
        anchor, window, place = np.nonzero(best.scores > LOWEST)
        scores, ids = best.scores[anchor, window, place], best.ids[anchor, window, place]
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int32()), pa.array(window, pa.int32()), pa.array(ids), pa.array(scores)],
            ["anchor", "window", "id", "score"],
        )

    first = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    found = rows.select("vec_id", "label", "embedding").mapInArrow(run, FOUND)
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= search.k)


def _batch(rows: DataFrame, picked: DataFrame) -> DataFrame | None:
    """Hard negatives of one batch of anchors."""
    kept = picked.distinct().toArrow()
    if not kept.num_rows:
        return None
    x = integers(kept.column("embedding"))
    anchors = Rows(np.asarray(kept.column("vec_id")), np.asarray(kept.column("label")), x)
    order = np.argsort(-np.square(x).sum(axis=0), kind="stable")
    n = len(x)
    open_ends = Search(anchors, order, np.full((n, 1), LOWEST), np.full((n, 1), -LOWEST), True, POSITIVE_STEPS, POSITIVES)
    # At most POSITIVES rows for each anchor of the batch.
    positives = _search(rows, open_ends).toArrow()
    at, place = np.asarray(positives.column("anchor")), np.asarray(positives.column("rank")) - 1
    scores, ids = np.asarray(positives.column("score")), np.asarray(positives.column("id"))
    ceilings, floors = np.full((n, POSITIVES), LOWEST), np.full((n, POSITIVES), -LOWEST)
    ceilings[at, place] = scores
    floors[at, place] = [-(-LEAST[0] * int(s) // LEAST[1]) for s in scores]
    of_anchor, of_positive = np.zeros((n, POSITIVES), np.int64), np.zeros((n, POSITIVES), np.int64)
    of_anchor[:], of_positive[at, place] = anchors.ids[:, None], ids
    found = _search(rows, Search(anchors, order, floors, ceilings, False, NEGATIVE_STEPS, NEGATIVES))
    names = rows.sparkSession.sparkContext.broadcast((of_anchor, of_positive, ceilings))

    def named(batches):
        anchor_id, positive_id, positive_score = names.value
        for b in batches:
            where = np.asarray(b.column(0)), np.asarray(b.column(1))
            columns = [anchor_id[where], positive_id[where], np.asarray(b.column(2)), np.asarray(b.column(3)), np.asarray(b.column(4)), positive_score[where]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "positive_id", "negative_id", "negative_score", "rank", "positive_score"])

    shown = found.select("anchor", "window", "id", "score", "rank").mapInArrow(
        named, "anchor_id long, positive_id long, negative_id long, negative_score long, rank int, positive_score long"
    )
    return shown.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    vectors: DataFrame, is_anchor: Callable[[Column], Column] = lambda i: i % ANCHOR_IDS == 0, anchors_at_once: int = ANCHORS
) -> DataFrame:
    """For each anchor and positive its hard negatives, best first."""
    rows = taking_part(vectors)
    anchors = rows.where(is_anchor(F.col("vec_id")))
    batches = max(1, -(-anchors.count() // anchors_at_once))
    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(batches))
    parts = []
    for b in range(batches):
        found = _batch(rows, anchors.where(dealt == b))
        if found is not None:
            parts.append(found if batches == 1 else staged(found, "hard-negatives"))
    if not parts:
        return vectors.sparkSession.createDataFrame([], RESULT)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, o.vec_id, o.label, list_inner_product(a.v, o.v)::BIGINT AS score
  FROM rows a JOIN rows o ON a.vec_id <> o.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id))::INT AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND n.label <> p.anchor_label
 AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""


@query("op11_hard_negatives", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, among all vectors."""
    return mine(table(spark, sf_dir, "embeddings"))
