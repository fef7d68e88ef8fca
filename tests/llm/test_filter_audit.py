import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from logilake.llm import filter_audit as fa


def brute(docs, labels):
    """Every order replayed over all documents."""
    facts = []
    for doc, text, part in docs:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc is not None and any((t or "") == text and i is not None and i < doc for i, t, _ in docs),
        }
        good = any(i == doc is not None and q == 1 for i, q, _ in labels)
        toxic = any(i == doc is not None and t == 1 for i, _, t in labels)
        facts.append((part or "", {f for f in fails if fails[f]}, good, toxic))
    out = {}
    for part in {p for p, *_ in facts}:
        own = [f for f in facts if f[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                failing = sum(f in x[1] for x in own)
                out[part, order, k + 1] = [
                    len(left), len(gone), failing - len(gone), sum(x[1] == {f} for x in own),
                    sum(x[2] for x in gone), sum(x[3] for x in gone),
                ]
        for f in "ABCDE":
            places = [(part, o, o.index(f) + 1) for o in map("".join, permutations("ABCDE"))]
            total = sum(out[p][1] for p in places)
            for p in places:
                out[p].append(total)
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in fa.COUNTS) for r in df.collect()}


def texts(rng, n):
    kinds = [lambda: " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([5, 150]))), lambda: "Same text " * 60,
             lambda: "LOUD WORDS " * 3, lambda: "a # b", lambda: "", lambda: None, lambda: "\x0b a\x1cb  İ é  \n"]
    return [rng.choice(kinds)() for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_replayed_orders(spark, seed):
    rng = random.Random(seed)
    docs = [(i % 190 or None, t, rng.choice(["en", "de", "", None])) for i, t in enumerate(texts(rng, 200))]
    docs += docs[:7]
    labels = [(rng.randrange(200), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(150)] + [(None, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"words": F.lit(1), "part": F.lit("x"), "n": F.lit(2), "fails": F.lit(3)})
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("y"))
    found = got(fa.audit(frame.repartition(4), marks))
    assert found == brute(docs, labels)
    assert len(found) == 600 * len({p or "" for _, _, p in docs})


def test_paths_of_the_lattice():
    paths = fa.lattice(5)
    assert paths.reaching[31] == paths.leaving[0] == 120
    for f in range(5):
        assert sum(paths.weight(s, 1 << f) for s in range(32) if not s >> f & 1) == 120


def test_empty_tables_and_long_texts(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.audit(docs, labels).count() == 0
    long = spark.createDataFrame([(1, "word " * 400_000, "en")], docs.schema)
    assert got(fa.audit(long, labels))["en", "ABCDE", 2] == (0, 1, 0, 1, 0, 0, 120)
