import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logilake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """All pairs, sorted."""
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, label, v in {(i, lab, tuple(v)) for i, lab, v in kept if i % 100 == 0}:
        def best(rows, k):
            return sorted(rows, key=lambda r: (-r[0], r[1]))[:k]

        scored = [(sum(map(int.__mul__, v, w)), i, lab) for i, lab, w in kept]
        for p, positive, _ in best([r for r in scored if r[2] == label and r[1] != a], 5):
            near = [r for r in scored if r[2] != label and 80 * p <= 100 * r[0] <= 100 * p]
            out += [(a, positive, k + 1, i, p, n) for k, (n, i, _) in enumerate(best(near, 5))]
    return sorted(out)


def made(n, dims, seed, labels=3, spread=1.0):
    rng = random.Random(seed)
    centre = [rng.gauss(0, 1) for _ in range(dims)]
    return [(i, [c + spread * rng.gauss(0, 1) for c in centre], rng.randrange(labels)) for i in range(n)]


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("n", "dims", "spread"), [(600, 5, 0.3), (900, 33, 1.0), (400, 8, 3.0)])
def test_against_brute_force(spark, n, dims, spread):
    rows = made(n, dims, n, spread=spread)
    found = got(hn.mine(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert found == brute(rows)
    assert found


def test_batches_of_anchors_give_the_same(spark):
    rows = made(900, 6, 1, spread=0.4)
    assert got(hn.mine(spark.createDataFrame(rows, SCHEMA), anchors_at_once=2)) == brute(rows)


def test_nulls_ties_repeats_lengths_and_clashing_columns(spark):
    nan, inf = float("nan"), float("inf")
    same = [(i, [0.5, 0.25], i % 3) for i in range(1, 260)]
    odd = [(100, [0.5], 1), (100, [0.5], 1), (200, [0.5, 0.2, 0.1], 2), (300, [], 0), (400, [-0.5, -0.5], 1), (500, None, 1),
           (None, [1.0, 1.0], 1), (600, [nan, 1.0], 1), (701, [inf, 1.0], 2), (702, [None, 1.0], 2), (703, [1.0, 1.0], None),
           (800, [0.0, 0.0], 1), (-100, [0.4, 0.4], 2), (9, [0.5, 0.25], 2), (9, [0.5, 0.25], 2)]
    df = spark.createDataFrame(same + odd, SCHEMA).withColumns({"score": F.lit(1), "rank": F.lit(2), "anchor": F.lit("x")})
    assert got(hn.mine(df)) == brute(same + odd)


def test_a_hot_vector_and_large_numbers(spark):
    rows = [(i, [1e12, 3.0] if i % 3 else [float(i), 1.0], i % 2) for i in range(300)]
    with pytest.raises(Exception, match="too large|out of bounds|OverflowError"):
        hn.mine(spark.createDataFrame(rows, SCHEMA)).collect()
    rows = [(i, [3e5, 2.9e5, float(i)] if i % 3 else [float(i), 1.0, 2.0], i % 2) for i in range(300)]
    assert got(hn.mine(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hn.mine(empty).count() == 0
    assert hn.mine(spark.createDataFrame([(1, [1.0], 1)], SCHEMA)).columns == hn.mine(empty).columns


def test_index_omits_what_the_bound_covers():
    x = np.array([[8.0, 1.0], [1.0, 0.0], [0.0, 7.0]])
    rows, anchors = hn.Index(x).search(np.array([[2.0, 0.0]]), hn.tails(np.array([[2.0, 0.0]])), np.array([15.0]))
    assert list(rows) == [0] and list(anchors) == [0]
