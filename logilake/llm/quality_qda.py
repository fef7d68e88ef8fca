"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each whole text becomes a short vector of statistics, each transformed (logarithm, or logit of a share) so that a
normal distribution fits it better. Per class, the count, sums and sums of products of the vectors give mean and
covariance exactly, over all labelled rows of the training folds, in one distributed aggregation. Covariances are
shrunk: first toward the pooled one (``TO_POOLED``), then toward its diagonal (``TO_DIAGONAL``), so they can be
factored even when a statistic does not vary in a class. A filter (``keep_good``) is fitted on at most ``LABELLED`` rows. A score is the logistic function of the difference of the
two classes' log densities and log priors, from Mahalanobis distances by Cholesky factors that are computed once.

Defined cases: a null text is empty and gets a score like any text. Labels other than 0 and 1, null labels and null
ids in ``labels`` are not learned from; a document with several labels counts once for each. With fewer than two
labelled rows of a class the score is the share of label 1, or 0.5 without any label. Labels, lang, source and
doc_id are never inputs. Rows that repeat are scored alike.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logilake.llm.common import bounded_sample, fold, query, staged, table

TO_POOLED = 0.1
TO_DIAGONAL = 0.1
FLOOR = 1e-3  # least variance of a statistic
FOLDS, HELD_OUT = 3, 1
LABELLED = 20_000  # labelled rows that a filter is fitted on at most; more do not move 15 means and covariances
WORDS, BYTES = 20.0, 120.0  # weight of ordinary prose in a text's shares

FEATURES = (
    "log_words", "log_word_length", "letters", "upper", "digits", "spaces", "symbols", "sentence_ends", "commas",
    "distinct_words", "most_common_word", "repeated_neighbours", "words_with_symbols", "lines_per_word",
    "compression",
)

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = b"0123456789"
_SPACES = b" \t\n\r\x0b\x0c"
_SYMBOLS = bytes(c for c in range(33, 127) if chr(c) in "#$%&*+/<=>@[\\]^_`{|}~!")


def _share(part: float, whole: float, typical: float, weight: float) -> float:
    """Logit of a share, drawn toward that of ordinary prose as a text of ``weight`` words or bytes would: short
    texts tell little, and should not stand out for it."""
    p = (part + typical * weight) / (whole + weight)
    return math.log(p / (1.0 - p))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text, in the order of FEATURES."""
    raw = (text or "").encode()
    size = len(raw)
    words = raw.split()
    n = len(words)
    times = Counter(words)

    def count(kinds: bytes) -> int:
        return size - len(raw.translate(None, kinds))

    letters = count(_LETTERS)
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    marked = sum(1 for w in words if w[-1] in _SYMBOLS) if count(_SYMBOLS) else 0
    return [
        math.log1p(n),
        math.log((size + 6 * WORDS) / (n + WORDS)),
        _share(letters, size, 0.8, BYTES),
        _share(count(_UPPER), letters, 0.03, BYTES),
        _share(count(_DIGITS), size, 0.002, BYTES),
        _share(count(_SPACES), size, 0.17, BYTES),
        _share(count(_SYMBOLS), size, 0.002, BYTES),
        _share(count(b".?"), size, 0.02, BYTES),
        _share(count(b",;:"), size, 0.01, BYTES),
        _share(len(times), n, 0.7, WORDS),
        _share(max(times.values(), default=0), n, 0.05, WORDS),
        _share(repeated, n, 0.005, WORDS),
        _share(marked, n, 0.005, WORDS),
        _share(raw.count(b"\n"), n, 0.01, WORDS),
        math.log((size + BYTES) / (len(zlib.compress(raw, 1)) + BYTES)),
    ]


def vectors(docs: DataFrame) -> DataFrame:
    """doc_id and the vector of its text, as float32 bytes."""

    def run(batches):
        for batch in batches:
            found = [np.array(statistics(t), np.float32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["doc_id", "vector"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, vector binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(len(column), -1).astype(float)


class Model(NamedTuple):
    prior: float  # log odds of class 1
    means: np.ndarray | None
    whiten: np.ndarray | None  # inverse of each class's Cholesky factor
    log_root: np.ndarray | None  # sum of the logs of its diagonal

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), 1 / (1 + math.exp(-self.prior)))
        log_density = [
            -0.5 * np.square((x - m) @ w.T).sum(axis=1) - d
            for m, w, d in zip(self.means, self.whiten, self.log_root, strict=True)
        ]
        odds = np.clip(log_density[1] - log_density[0] + self.prior, -500, 500)
        return 1 / (1 + np.exp(-odds))


def fit(labelled: DataFrame) -> Model:
    """From (vector, label); tasks send their sums, which Spark adds up: some hundred rows in all."""

    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x, y = _matrix(batch.column(0)), np.array(batch.column(1).to_pylist())
            x = np.hstack([np.ones((len(x), 1)), x])
            for label in (0, 1):
                own = x[y == label]
                total[label] = total.get(label, 0) + own.T @ own
        for label, t in total.items():
            flat = t.ravel()
            yield pa.RecordBatch.from_pydict({"label": [label] * flat.size, "at": range(flat.size), "value": flat.tolist()},
                schema=pa.schema([("label", pa.int32()), ("at", pa.int32()), ("value", pa.float64())]))

    rows = (
        labelled.select("vector", "label")
        .mapInArrow(sums, "label int, at int, value double")
        .groupBy("label", "at")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    size = len(FEATURES) + 1
    products = np.zeros((2, size * size))
    for r in rows:
        products[r.label, r.at] = r.value
    return from_sums(products.reshape(2, size, size))


def from_sums(products: np.ndarray) -> Model:
    """Per class the sums of products of (1, vector)."""
    n = products[:, 0, 0]
    if n.min() < 2:
        return Model(math.log((n[1] + 0.5) / (n[0] + 0.5)), None, None, None)
    means = products[:, 0, 1:] / n[:, None]
    cov = products[:, 1:, 1:] / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = np.tensordot(n, cov, 1) / n.sum()
    cov = (1 - TO_POOLED) * cov + TO_POOLED * pooled
    diagonal = np.stack([np.diag(np.diag(c)) for c in cov])
    cov = (1 - TO_DIAGONAL) * cov + TO_DIAGONAL * diagonal + FLOOR * np.eye(cov.shape[1])
    roots = np.linalg.cholesky(cov)
    return Model(
        float(math.log(n[1] / n[0])),
        means,
        np.stack([np.linalg.inv(r) for r in roots]),
        np.array([np.log(np.diag(r)).sum() for r in roots]),
    )


def learned(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """Vectors of all documents, and the model that their labels outside the held-out fold give."""
    found = staged(vectors(docs), "quality-vectors").withColumn("held_out", fold("doc_id", FOLDS) == HELD_OUT)
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("label IN (0, 1)")
    return found, fit(found.where(~F.col("held_out")).join(known, "doc_id"))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every document, learned outside the held-out fold."""
    found, model = learned(docs, labels)

    def run(batches):
        for batch in batches:
            score = model.scores(_matrix(batch.column(2))) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return found.select("doc_id", "held_out", "vector").mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double, predicted int"
    )


def model_of_sample(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> Model:
    """The model from at most ``bound`` labelled rows outside the held-out fold; other texts are not looked at."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    sample = bounded_sample(known.where(fold("doc_id", FOLDS) != HELD_OUT), "doc_id", bound)
    # Both are bounded by the sample's size, some hundred kilobytes.
    own = docs.join(F.broadcast(sample.select("doc_id").distinct()), "doc_id", "left_semi")
    return fit(vectors(own).join(F.broadcast(sample), "doc_id"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, all their columns as they were.

    The model is fitted first, from the statistics of a bounded sample; then each text is scored where it is.
    """
    model = model_of_sample(docs, labels)
    text_at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.array([statistics(t) for t in batch.column(text_at).to_pylist()], np.float32).astype(float)
                yield batch.filter(pa.array(model.scores(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)


@query("op2_quality_qda")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
