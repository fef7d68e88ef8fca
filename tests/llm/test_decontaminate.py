import random

from pyspark.sql import functions as F

from logilake.llm import decontaminate as dc


def items(seed=1, n=60):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "to"] + [f"word{i}" for i in range(400)]
    return [(i, " ".join(rng.choice(vocabulary[: 4 if rng.random() < 0.3 else 404]) for _ in range(rng.randint(8, 50))) + ".") for i in range(n)]


def brute(index, texts, threshold):
    """Scores of all windows with all items, without an index."""
    found = []
    for words in texts:
        hits = {}
        count = max(1, -(-len(words) // index.longest) - 1)
        for k in range(count):
            passage = words[k * index.longest : (k + 2) * index.longest]
            terms = {index.terms[w] for w in set(passage) if w in index.terms}
            for item in range(len(index.ids)):
                score = sum(impact for t in terms for i, impact in index.postings[t] if i == item)
                if score >= threshold and min(index.verify(item, passage)) >= dc.OVERLAP:
                    hits[index.ids[item]] = max(score, hits.get(index.ids[item], 0))
        found.append(hits)
    return found


def test_search_agrees_with_brute_force():
    known = items()
    index = dc.Index(known)
    rng = random.Random(2)
    texts = []
    for k in range(60):
        words = [f"word{rng.randrange(600)}" for _ in range(rng.randint(0, 400))]
        if k % 2:
            at = rng.randint(0, len(words))
            item = dc.words_of(known[k % len(known)][1])
            item = item[: len(item) - rng.randint(0, 12)] if k % 4 == 1 else item
            words[at:at] = [w.decode() for w in item]
        texts.append([w.encode() for w in words])
    for threshold in (0.3, 0.6):
        got = [{h.item_id: h.score for h in hits} for hits in index.search(texts, threshold)]
        expected = brute(index, texts, threshold)
        assert [set(g) for g in got] == [set(e) for e in expected]
        assert all(abs(g[i] - e[i]) < 1e-5 for g, e in zip(got, expected, strict=True) for i in g)
    assert sum(map(len, got)) >= 25


def test_question_and_answer():
    assert dc.question_and_answer("Who is it? It is me.") == ([b"who", b"is", b"it"], [b"it", b"is", b"me"])
    assert dc.question_and_answer("One two. Three four.") == ([b"one", b"two"], [b"three", b"four"])
    assert dc.question_and_answer("just one") == ([b"just", b"one"],) * 2


def test_question_without_answer_is_no_hit():
    known = [(1, "What is the capital of that distant green land over there? Its capital city is lovely Quibblestone upon Marsh.")]
    index = dc.Index([*known, (2, "other words entirely that no one else uses here")])
    question, answer = "what is the capital of that distant green land over there", "its capital city is lovely quibblestone upon marsh"
    hits = index.search([dc.words_of(question), dc.words_of(question + " " + answer), dc.words_of("x " * 500 + question + " " + answer)], 0.4)
    assert [len(h) for h in hits] == [0, 1, 1]


def test_test_table_agrees_with_containment(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    bench = spark.read.parquet(f"{tiny}/benchmark.parquet")
    texts = {r.doc_id: b" " + b" ".join(dc.words_of(r.text)) + b" " for r in docs.collect()}
    parts = {r.item_id: b" " + b" ".join(dc.words_of(r.text)) + b" " for r in bench.collect()}
    expected = {(d, i) for d, t in texts.items() for i, p in parts.items() if p in t}
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, bench).collect()} == expected
    clean = {r.doc_id for r in dc.drop_leaks(docs, bench).collect()}
    assert clean == set(texts) - {d for d, _ in expected}


def test_defined_cases(spark, documents, monkeypatch):
    monkeypatch.setattr(dc, "PART_ITEMS", 2)
    monkeypatch.setattr(dc, "PARTS", 2)
    bench = spark.createDataFrame(
        [(i, f"item{i} alpha{i} beta{i} gamma{i} delta{i} epsilon{i} zeta{i}") for i in range(11)] + [(90, None), (91, "..."), (None, "x"), (3, "item3 alpha3 beta3 gamma3 delta3 epsilon3 zeta3")],
        "item_id long, text string",
    )
    text = "so ITEM3, alpha3 beta3 gamma3 delta3 epsilon3 zeta3!"
    docs = documents((1, None), (2, ""), (3, text), (3, text), (None, text), (4, "y " * 100_000 + text)).withColumn("score", F.lit("s"))
    found = sorted((r.doc_id or 0, r.item_id) for r in dc.find_leaks(docs, bench).collect())
    assert set(found) == {(0, 3), (3, 3), (4, 3)} and len(found) >= 4
    kept = dc.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert dc.find_leaks(docs, bench.limit(0)).count() == 0 and dc.drop_leaks(documents(), bench).count() == 0


def test_parts_share_the_statistics_of_all_items(spark, documents, monkeypatch):
    known = items(n=40)
    partial = [(i, " ".join(t.split()[: len(t.split()) * 3 // 4])) for i, t in known]
    docs = documents(*partial)
    bench = spark.createDataFrame(known, "item_id long, text string")

    def found():
        return {(r.doc_id, r.item_id, round(r.score, 4)) for r in dc.find_leaks(docs, bench).collect()}

    whole = found()
    assert 5 < len(whole)
    monkeypatch.setattr(dc, "PART_ITEMS", 3)
    assert found() == whole
    monkeypatch.setattr(dc, "PARTS", 4)
    assert found() == whole
    monkeypatch.setattr(dc, "PART_BYTES", 300)
    parts = [p for r in dc._rounds(bench) for p in r]
    assert all(len(p.items) == 1 or sum(len(t) for _, t in p.items) < 450 for p in parts)
    assert found() == whole


def test_long_item_does_not_widen_the_passages_of_others(spark, documents):
    known = items(n=20)
    long = (99, " ".join(f"long{i}" for i in range(5000)))
    # Each item's words in pieces of four, far apart: no passage of a short item's length holds it.
    texts = []
    for i, t in known:
        words = t.split()
        texts.append((i, (" filler" * 200 + " ").join(" ".join(words[k : k + 4]) for k in range(0, len(words), 4))))
    clean = [(i, t) for (i, t), (_, own) in zip(texts, known, strict=True) if len(own.split()) > 12]
    bench = spark.createDataFrame([*known, long], "item_id long, text string")
    assert {p.whole.longest for r in dc._rounds(bench) for p in r} == {max(len(dc.words_of(t)) for _, t in known), 5000}
    assert dc.drop_leaks(documents(*clean), bench).count() == len(clean) > 5
    assert dc.drop_leaks(documents((1, "x " * 7000 + long[1])), bench).count() == 0


def test_item_without_id_is_searched(spark, documents):
    text = "alpha beta gamma delta epsilon zeta eta theta. One two three four five six."
    bench = spark.createDataFrame([(None, text), (None, text)], "item_id long, text string")
    docs = documents((1, text), (2, "nothing of it"))
    assert [(r.doc_id, r.item_id) for r in dc.find_leaks(docs, bench).collect()] == [(1, None)] * 2
    assert [r.doc_id for r in dc.drop_leaks(docs, bench).collect()] == [2]
