"""Toxicity: cumulative-link ordinal regression over sparse text features.

Features are words and word beginnings of 4 to 6 letters, lower-cased, hashed into ``BUCKETS`` places; a text has a
feature or has it not. Of the places, the ``SELECTED`` with the largest likelihood ratio between toxic and other
labelled texts are used, whichever of the two has them more often; signed, regularised weights decide what each says.
Severity has ``GRADES`` grades: 0 for texts that are not labelled toxic; labelled toxic texts are
graded by their different insults, at the terciles of the number of selected features that they have and that are
more frequent in toxic texts.
One weight vector is shared by all thresholds: P(grade > k) = logistic(w x - t_k) with t_0 <= t_1 <= ... Results are the expected severity (0 to GRADES - 1), the most likely grade, and ``score``, P(grade > 0).

The model is fitted on the driver, on at most ``LABELLED`` labelled rows (all of them, if there are fewer), drawn by
the hash of the id; every document is scored as a whole. Rows of the held-out fold are never learned from.

Defined cases: a null or empty text has no feature and gets the base rate. Null labels and ids are not learned from.
Without labels of both kinds every score is the share of toxic labels, or 0. Rows that repeat are scored alike. Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logilake.llm.common import bounded_sample, fold, query, staged, table

BUCKETS = 1 << 18
SELECTED = 4096
GRADES = 4
LABELLED = 20_000
FOLDS, HELD_OUT = 5, 0
KNOWN_WORDS = 200_000
L2, ROUNDS, RATE = 1e-5, 600, 0.1

_WORD = re.compile(r"[^\W\d_]+")


class Features:
    """Places of a text's features; a word's places are kept while a task lasts."""

    def __init__(self, places: np.ndarray | None = None):
        # With ``places``, only these count, and are numbered in their order.
        self.number = None if places is None else {int(p): i for i, p in enumerate(places)}
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= KNOWN_WORDS:
                self.known.clear()
            keys = [word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) >= n)]
            found = tuple(xxhash.xxh64_intdigest(k) % BUCKETS for k in keys)
            if self.number is not None:
                found = tuple(self.number[p] for p in found if p in self.number)
            self.known[word] = found
        return found

    def words(self, text: str | None) -> list[str]:
        return _WORD.findall((text or "").lower())

    def __call__(self, text: str | None) -> list[int]:
        return sorted({p for w in set(self.words(text)) for p in self.of_word(w)})


class Ordinal(NamedTuple):
    places: np.ndarray  # of the selected features
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, sums: np.ndarray) -> np.ndarray:
        """P(grade > k) by row and threshold, from the sum of a text's weights."""
        return 1 / (1 + np.exp(-np.clip(sums[:, None] - self.thresholds[None, :], -50, 50)))


def _sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    flat = np.fromiter((p for r in rows for p in r), np.int64, sum(map(len, rows)))
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), flat


def _constant(rate: float) -> Ordinal:
    base = np.log(max(rate, 1e-9) / max(1 - rate, 1e-9))
    return Ordinal(np.empty(0, np.int64), np.empty(0), np.full(GRADES - 1, -base))


def choose(places: np.ndarray, in_toxic: np.ndarray, in_other: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Places that toxic texts have more or less often than others beyond chance, from the numbers of texts that have
    them: by the likelihood ratio, against a bound that chance alone seldom passes at so many places."""
    both, rate = in_toxic + in_other, n1 / (n1 + n0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 2 * (
            np.where(in_toxic > 0, in_toxic * np.log(in_toxic / (both * rate)), 0)
            + np.where(in_other > 0, in_other * np.log(in_other / (both * (1 - rate))), 0)
        )
    good = np.flatnonzero(gain >= 2 * np.log(max(2, len(places))))
    return np.sort(places[good[np.lexsort((places[good], -gain[good]))][:SELECTED]])


def fit(chosen: np.ndarray, features: list[list[int]], toxic: np.ndarray) -> Ordinal:
    """From the chosen places, the numbers of those that each text has, and whether it is toxic."""
    if not len(features) or toxic.all() or not toxic.any():
        return _constant(float(toxic.mean()) if len(features) else 0.0)
    rows, own = _sparse(features)
    share = [np.bincount(own[toxic[rows] == side], minlength=len(chosen)) / (toxic == side).sum() for side in (True, False)]
    insults = np.bincount(rows[(share[0] > share[1])[own]], minlength=len(features))
    cuts = np.quantile(insults[toxic], np.arange(1, GRADES - 1) / (GRADES - 1))
    grades = np.where(toxic, 1 + np.searchsorted(cuts, insults, side="left"), 0)
    return _descend(chosen, features, grades)


def _descend(chosen: np.ndarray, features: list[list[int]], grades: np.ndarray) -> Ordinal:
    """Maximum likelihood of the cumulative-link model by gradient steps on all rows."""
    rows, places = _sparse(features)
    n, k = len(grades), GRADES - 1
    weights = np.zeros(len(chosen))
    # Thresholds are a first one and positive gaps, so they stay in order.
    rates = np.clip([(grades > j).mean() for j in range(k)], 1e-6, 1 - 1e-6)
    start = np.log((1 - rates) / rates)
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    moments = [np.zeros(len(weights) + k) for _ in range(2)]
    for step in range(1, ROUNDS + 1):
        thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        sums = np.bincount(rows, weights[places], n)
        above = Ordinal(chosen, weights, thresholds).above(sums)
        full = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        upper, lower = full[np.arange(n), grades], full[np.arange(n), grades + 1]
        p = np.maximum(upper - lower, 1e-12)
        up, low = upper * (1 - upper), lower * (1 - lower)
        by_sum = (up - low) / p
        by_threshold = np.zeros(k + 2)
        np.add.at(by_threshold, grades, -up / p)
        np.add.at(by_threshold, grades + 1, low / p)
        inner = by_threshold[1 : k + 1]
        tails = np.cumsum(inner[::-1])[::-1]
        grad = np.concatenate(
            [
                np.bincount(places, by_sum[rows], len(weights)) / n - L2 * weights,
                tails[:1] / n,
                tails[1:] * np.exp(free[1:]) / n,
            ]
        )
        moments[0] += 0.1 * (grad - moments[0])
        moments[1] += 0.01 * (grad * grad - moments[1])
        change = RATE * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights, free = weights + change[: len(weights)], free + change[len(weights) :]
    return Ordinal(chosen, weights, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])))


def learn(docs: DataFrame, labels: DataFrame) -> Ordinal:
    """The features of the sampled texts are found and counted by Spark. The driver gets one count for each place, and
    of each text only the chosen features that it has."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1)")
    sample = bounded_sample(known.where(fold("doc_id", FOLDS) != HELD_OUT), "doc_id", LABELLED)

    def run(batches):
        features = Features()
        for batch in batches:
            found = [features(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["toxic", "places"])

    # At most LABELLED narrow rows are broadcast, so the documents need not be shuffled.
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text")
    rows = staged(rows.mapInArrow(run, "toxic int, places array<int>"), "toxicity-sample")
    size = rows.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("other")).first()
    if not size.toxic or not size.other:
        return _constant(size.toxic / max(1, size.toxic + size.other))
    counts = (
        rows.select("toxic", F.explode("places").alias("place"))
        .groupBy("place")
        .agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("other"))
        .toArrow()
    )
    place, in_toxic, in_other = (counts.column(c).to_numpy() for c in ("place", "toxic", "other"))
    chosen = choose(place, in_toxic.astype(float), in_other.astype(float), size.toxic, size.other)
    number = {int(p): i for i, p in enumerate(chosen)}
    picked = F.array_intersect("places", F.lit(chosen.tolist()) if len(chosen) else F.array().cast("array<int>"))
    texts = rows.select("toxic", picked.alias("picked")).toArrow()
    features = [sorted(number[p] for p in own) for own in texts.column("picked").to_pylist()]
    order = sorted(range(len(features)), key=lambda i: features[i])
    return fit(chosen, [features[i] for i in order], texts.column("toxic").to_numpy()[order] == 1)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, grade and expected severity of every document."""
    model = learn(docs, labels)

    def run(batches):
        features = Features(model.places)
        for batch in batches:
            rows, places = _sparse([features(t) for t in batch.column(2).to_pylist()])
            sums = np.bincount(rows, model.weights[places], batch.num_rows) if batch.num_rows else np.empty(0)
            above = model.above(sums)
            ends = np.zeros((len(sums), 1))
            each = np.hstack([ends + 1, above]) - np.hstack([above, ends])
            grade = each.argmax(axis=1) if len(sums) else np.empty(0, int)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(above[:, 0]), pa.array((above[:, 0] >= 0.5).astype(np.int32)),
                    pa.array(grade.astype(np.int32)), pa.array(above.sum(axis=1)),
                ],
                ["doc_id", "held_out", "score", "predicted", "grade", "severity"],
            )

    rows = docs.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    return rows.mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int, grade int, severity double"
    )


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document."""
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
