import math
import random

from pyspark.sql import functions as F

from logilake.operators import nearest as near
from logilake.operators import paths

R = 6371.0


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    h = min(1.0, h)
    return round(2 * R * math.atan2(math.sqrt(h), math.sqrt(1 - h)), 6)


def brute(places, among, k, others_only=True):
    out = []
    for i, *p in set(places):
        if None in p:
            continue
        best = sorted((km(p, q), j) for j, *q in set(among) if None not in q and not (others_only and i == j))[:k]
        out += [(i, n + 1, j, d) for n, (d, j) in enumerate(best)]
    return sorted(out)


def got(df):
    return sorted((r.location_id, r.rank, r.neighbour, round(r.distance_km, 6)) for r in df.collect())


def test_nearest_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(near, "CROWD", 20)
    rng = random.Random(4)
    # A crowded city with one hot point, a sparse rest, both poles, and the date line.
    rows = [(f"c{i}", 48 + rng.random() / 50, 2 + rng.random() / 50) for i in range(60)] + [(f"h{i}", 48.0, 2.0) for i in range(12)]
    rows += [(f"s{i}", rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(15)]
    rows += [("n", 90.0, 10.0), ("n2", 89.9, -170.0), ("p", -90.0, 0.0), ("e", 0.0, 179.99), ("w", 0.0, -179.99), ("x", None, 1.0)]
    df = spark.createDataFrame(rows, "location_id string, lat double, lon double")
    expected = {(i, n): (d, j) for i, n, j, d in brute(rows, rows, 3)}
    found = got(near.nearest(df, df, 3))
    assert {(i, n) for i, n, _, _ in found} == expected.keys()
    where = {i: p for i, *p in rows}
    for i, n, j, d in found:
        # The last digit may differ between the two, and with it the order of places that are equally far.
        assert abs(d - expected[i, n][0]) < 2e-6 and abs(km(where[i], where[j]) - d) < 2e-6
    exact = [(i, n, j) for i, n, j, _ in found if i.startswith("h")]
    assert exact == [(i, n, j) for (i, n), (_, j) in sorted(expected.items()) if i.startswith("h")]


def test_fewer_places_than_asked_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0), ("b", 0.0, 90.0), ("b", 0.0, 90.0)], "location_id string, lat double, lon double")
    assert [r[:3] for r in got(near.nearest(df, df, 5))] == [("a", 1, "b"), ("b", 1, "a")]
    assert [r[:3] for r in got(near.nearest(df, df, 1, others_only=False))] == [("a", 1, "a"), ("b", 1, "b")]
    assert near.nearest(df.limit(0), df, 2).count() == 0 and near.nearest(df, df.limit(0), 2).count() == 0


def shortest(edges, lanes):
    best = {}
    for a, b, t, d in edges:
        if t is not None:
            best[a, b] = min(best.get((a, b), (math.inf,)), (t, d or 0, 1))
    nodes = {x for pair in best for x in pair}
    ways = dict(best)
    for m in nodes:
        for a in nodes:
            for b in nodes:
                if (a, m) in ways and (m, b) in ways and a != b:
                    new = tuple(map(sum, zip(ways[a, m], ways[m, b])))
                    ways[a, b] = min(ways.get((a, b), (math.inf,)), new)
    out = {}
    for a, b in lanes:
        out[a, b] = best.get((a, b)) or ((0, 0, 0) if a == b else ways.get((a, b), (None,) * 3))
    return out


def test_ways_equal_shortest_sums_with_cycles_and_unreachable_ends(spark):
    rng = random.Random(9)
    nodes = [f"n{i}" for i in range(14)] + ["island"]
    edges = [(rng.choice(nodes[:14]), rng.choice(nodes[:14]), rng.randrange(1, 50), rng.randrange(1, 9)) for _ in range(30)]
    edges += [("n0", "n1", None, 5), ("n0", "n1", 900, 5), ("n0", "n1", 3, None)]
    lanes = [(a, b) for a in nodes for b in nodes if rng.random() < 0.5] + [("n0", "n1"), ("n3", "island"), ("island", "n3")]
    lanes = sorted(set(lanes))
    network = spark.createDataFrame(edges, f"{paths.ORIGIN} string, {paths.DEST} string, duration_s long, distance_m long")
    wanted = spark.createDataFrame(lanes + lanes[:3], f"{paths.ORIGIN} string, {paths.DEST} string").withColumn("x", F.lit(1))
    found = {(r[0], r[1]): (r.duration_s, r.distance_m, r.hops) for r in paths.fill_lanes(wanted, network).collect()}
    assert found == shortest(edges, lanes)
    assert found["n3", "island"] == (None, None, None)


def test_nothing_to_fill(spark):
    schema = f"{paths.ORIGIN} string, {paths.DEST} string, duration_s long, distance_m long"
    network = spark.createDataFrame([("a", "b", 5, 7)], schema)
    lanes = network.select(paths.ORIGIN, paths.DEST)
    assert [r[:] for r in paths.fill_lanes(lanes, network).collect()] == [("a", "b", 5, 7, 1)]
    assert paths.fill_lanes(lanes.limit(0), network.limit(0)).count() == 0
