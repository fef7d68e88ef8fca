import hashlib

from pyspark.sql import functions as F

from logilake.llm import exact_dedup


def test_largest_id_stays_and_null_is_empty(documents, rows):
    docs = documents((1, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (6, "a "))
    got = {r.doc_id: r for r in exact_dedup.flag_copies(docs).collect()}
    assert {i: (r.keep_id, r.group_size, r.kept) for i, r in got.items()} == {
        1: (2, 2, False), 2: (2, 2, True), 3: (4, 2, False), 4: (4, 2, True), 5: (5, 1, True), 6: (6, 1, True),
    }
    assert got[1].text_sha256 == hashlib.sha256(b"a").hexdigest()
    assert sorted(r.doc_id for r in exact_dedup.drop_copies(docs).collect()) == [2, 4, 5, 6]


def test_null_ids_repeated_rows_and_clashing_columns(documents):
    docs = documents((None, "x"), (7, "x"), (None, "y"), (8, "z"), (8, "z")).withColumns(
        {"keep_id": F.lit(0), "digest": F.lit("d"), "salt": F.lit(1), "n": F.lit(2)}
    )
    got = exact_dedup.flag_copies(docs).collect()
    assert sorted((r.doc_id is None, r.keep_id, r.group_size, r.kept) for r in got if r.keep_id is not None) == [
        (False, 7, 2, True), (False, 8, 2, True), (False, 8, 2, True), (True, 7, 2, False),
    ]
    assert [(r.doc_id, r.kept) for r in got if r.keep_id is None] == [(None, False)]
    assert exact_dedup.drop_copies(docs).columns == docs.columns


def test_hot_text_over_many_tasks(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot " * 500)).otherwise(F.col("id").cast("string")).alias("text")
    )
    got = exact_dedup.flag_copies(docs.repartition(40))
    assert got.where("kept").count() == 2001
    hot = got.where("group_size > 1").agg(F.min("keep_id"), F.max("keep_id"), F.min("group_size"), F.count("*")).first()
    assert tuple(hot) == (2997, 2997, 1000, 1000)


def test_texts_that_share_a_digest_stay_apart(documents, monkeypatch):
    docs = documents((1, "a"), (2, "b"), (3, "a"), (4, "c"))

    def coarse(frame):
        text = F.coalesce("text", F.lit(""))
        return frame.select("doc_id", text.alias("text"), F.when(text == "c", "2").otherwise("1").alias("digest"))

    monkeypatch.setattr(exact_dedup, "_rows", coarse)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.flag_copies(docs).collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2), 4: (4, 1)}


def test_empty_table(documents):
    assert exact_dedup.flag_copies(documents()).count() == 0
    assert exact_dedup.drop_copies(documents()).count() == 0


def test_one_row_of_each_text_stays(documents):
    docs = documents((None, "x"), (None, "x"), (None, "y"), (7, "y"), (8, "a"), (8, "b"), (9, "a"), (5, "z"), (5, "z"), (None, None), (3, ""))
    got = sorted((r.doc_id or 0, r.text) for r in exact_dedup.drop_copies(docs.repartition(4)).collect())
    assert got == [(0, "x"), (3, ""), (5, "z"), (7, "y"), (8, "b"), (9, "a")]
    got = exact_dedup.drop_copies(documents((1, ""), (2, None))).collect()
    assert [(r.doc_id, r.text, r.lang, r.n_chars) for r in got] == [(2, None, "en", None)]
    assert exact_dedup.drop_copies(docs).schema == docs.schema


def test_ties_are_broken_by_the_other_columns(documents):
    docs = documents(*[(5, "z")] * 6).withColumn("source", F.concat(F.lit("s"), (F.rand(3) * 1000).cast("int").cast("string")))
    rows = docs.collect()
    again = docs.sparkSession.createDataFrame(rows, docs.schema)
    found = {exact_dedup.drop_copies(again.repartition(n)).first() for n in (1, 3, 7)}
    assert len(found) == 1 and found.pop().source == max(r.source for r in rows)
