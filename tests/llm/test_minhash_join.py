import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logilake.llm import minhash_join as mh
from logilake.llm.components import components


def shingles(text, k):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def exact(texts, rule):
    """Components by a prefix filter on the sets themselves, checked pair by pair."""
    sets = {i: shingles(t, rule.words) for i, t in texts.items()}
    common = Counter(x for s in sets.values() for x in s)
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    posted = defaultdict(list)
    for i in sorted(texts, key=lambda i: len(sets[i])):
        own = sets[i]
        if not own:
            continue
        prefix = sorted(own, key=lambda x: (common[x], x))[: len(own) - math.ceil(rule.percent / 100 * len(own)) + 1]
        for j in {j for x in prefix for j in posted[x]}:
            shared = len(own & sets[j])
            if 100 * shared >= rule.percent * (len(own) + len(sets[j]) - shared):
                a, b = sorted((find(i), find(j)))
                root[b] = a
        for x in prefix:
            posted[x].append(i)
    return {i: (len(sets[i]), find(i)) for i in texts}


def answers(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("rule", [mh.OP1, mh.NEAR])
def test_test_table_agrees_with_exact_components(spark, tiny, rule):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    expected = exact({r.doc_id: r.text for r in docs.collect()}, rule)
    got = mh.near_components(docs, rule)
    assert answers(got) == expected
    assert got.where(F.col("kept") != (F.col("doc_id") == F.col("component_id"))).count() == 0


def test_hot_group_of_near_copies_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(mh, "LIST_BLOCK", 16)
    monkeypatch.setattr(mh, "SET_BLOCK", 8)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 7)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(words)
    texts |= {200 + i: " ".join(rng.choice("abcdefgh") for _ in range(40)) for i in range(60)}
    docs = documents(*texts.items())
    assert answers(mh.near_components(docs, mh.OP1)) == exact(texts, mh.OP1)


def test_defined_cases(documents):
    docs = documents(
        (9, None), (8, " \n"), (7, "one Two"), (3, "ONE two"), (6, "one"), (None, "one two"), (5, "x " * 50_000), (4, "x " * 60_000), (3, "one two")
    ).withColumns({"rep": F.lit(1), "print": F.lit("p"), "signature": F.lit(0)})
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in mh.near_components(docs, mh.OP1).collect())
    assert got == [
        (0, 1, None, True), (3, 1, 3, True), (3, 1, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
        (7, 1, 3, False), (8, 0, 8, True), (9, 0, 9, True),
    ]
    kept = mh.drop_near_copies(docs, mh.OP1)
    assert kept.columns == docs.columns and kept.count() == 7
    assert mh.near_components(documents(), mh.OP1).count() == 0


def test_threshold_is_exact_at_its_edge(documents):
    # 85 of 100 shingles shared is a link, 84 of 99 (84.8) is none.
    base = [f"w{i}" for i in range(102)]
    docs = documents((1, " ".join(base)), (2, " ".join(base[:87])), (3, " ".join(base[:86])))
    assert {i: c for i, (_, c) in answers(mh.near_components(docs, mh.OP1)).items()} == {1: 1, 2: 1, 3: 1}
    docs = documents((1, " ".join(base)), (3, " ".join(base[:86])))
    assert {i: c for i, (_, c) in answers(mh.near_components(docs, mh.OP1)).items()} == {1: 1, 3: 3}


def test_chance_of_a_miss():
    for rule in (mh.OP1, mh.NEAR):
        p = rule.percent / 100
        missed = sum(math.comb(32, k) * p**k * (1 - p) ** (32 - k) for k in range(rule.matches))
        assert missed <= mh.MISS


def test_components_of_chains_hubs_and_rings(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(500, 501), (501, 502), (502, 500), (7, 7)]
    rng.shuffle(edges)
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(80)} | {i: 500 for i in (500, 501, 502)}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_filter_judges_rows_not_ids(documents):
    base = [f"w{i}" for i in range(60)]
    near, other = " ".join([*base, "end"]), " ".join(f"v{i}" for i in range(60))
    docs = documents((7, " ".join(base)), (8, near), (8, other), (9, other + " end"), (10, "a b c d"), (10, "a b c d"), (None, near)).withColumn("row_key", F.lit("k"))
    kept = mh.drop_near_copies(docs, mh.NEAR)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, near), (7, " ".join(base)), (8, other), (10, "a b c d")]
