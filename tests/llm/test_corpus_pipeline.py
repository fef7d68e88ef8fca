import hashlib
import os

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from logilake import session
from logilake.llm import bpe, decontaminate, minhash_join, quality_qda
from test_minhash_join import exact


def test_stages_against_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = spark.read.parquet(f"{tiny}/labels.parquet")
    good = {r.doc_id for r in quality_qda.scored(docs, labels).collect() if r.predicted == 1}
    last = {}
    for i in sorted(good):
        last[texts[i]] = i
    distinct = {i: t for t, i in last.items()}
    near = exact(distinct, minhash_join.NEAR)
    one = [i for i in distinct if near[i][1] == i]
    items = [b" ".join(decontaminate.words_of(r.text)) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    clean = [i for i in one if not any(b" " + p + b" " in b" " + b" ".join(decontaminate.words_of(texts[i])) + b" " for p in items)]
    own = bpe.Bpe(bpe.vocabulary(bpe.default_path()))
    expected = {i: hashlib.sha256(own.joined(own.encode(texts[i])).encode()).hexdigest() for i in clean}
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, tiny).collect()}
    assert got == expected
    assert len(good) < len(texts) and len(distinct) < len(good) and len(clean) < len(one)


def test_stages_keep_the_columns(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tiny).schema == docs.schema


def test_empty_documents(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tiny).count() == 0


def test_registration():
    names = set(queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and "pipeline" not in oracle_sql() and "op6_exact_dedup" in oracle_sql()


def test_null_ids_repeats_and_empty_side_tables(spark, documents, write_tables):
    long = " ".join(f"word{i}" for i in range(60))
    docs = documents((1, long), (1, long), (None, "another text of its own"), (None, None), (2, "x"), (3, long + " more"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([], "item_id long, text string")
    folder = write_tables(documents=docs, labels=labels, benchmark=benchmark)
    got = sorted(((r.doc_id is None, r.doc_id or 0) for r in corpus_pipeline.run(spark, folder).collect()))
    # Without labels nothing is rejected; one row of each text, and of the near copies the smallest id.
    assert got == [(False, 1), (False, 2), (True, 0), (True, 0)]


def test_only_the_last_output_is_left(spark, tiny, monkeypatch, tmp_path):
    made = []
    real = session.work_dir
    monkeypatch.setattr(session, "work_dir", lambda *a: made.append(real(*a)) or made[-1])
    with session.scratch(spark):
        result = corpus_pipeline.run(spark, tiny)
        assert result.count() > 0
        there = [p for p in made if os.path.exists(p.removeprefix("file://").removeprefix("file:"))]
        assert len(made) > 6 and len(there) == 1 and "benchmark-decontamination" in there[0]
    assert not os.path.exists(there[0].removeprefix("file://").removeprefix("file:"))
