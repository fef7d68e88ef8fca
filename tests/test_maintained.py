from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from logilake.operators import maintained as m
from logilake.plans import silver
from logilake.session import observed
from logilake.sources import partitions as ps
from logilake.sources.entities import ENTITIES
from logilake.streaming import intake

@pytest.fixture
def measures(spark):
    return {
        "n": m.counted("n"),
        "even": m.counted("even", F.col("v") % 2 == 0),
        "total": m.summed("total", F.col("v")),
        "top": m.largest("top", F.col("v")),
        "low": m.smallest("low", F.col("v")),
        "mean": m.mean("mean", F.col("v")),
        "median": m.quantile("q", F.col("v"), 0.5),
        "kinds": m.distinct("kinds", F.col("v")),
    }


def test_figures_after_batches_equal_one_run_and_read_changed_parts_only(spark, tmp_path, rows, measures):
    table, base = str(tmp_path / "t"), str(tmp_path / "a")
    layout = ps.Layout(("k",), span=100)
    groups = {"g": F.col("k") % 3}
    waves = [[(i, i % 50) for i in range(500)], [(i, i % 7) for i in range(480, 620)], [(5, 1000), (6, None)]]
    read = []
    for n, wave in enumerate(waves):
        ps.merge_batch(spark, spark.createDataFrame(wave, "k long, v int"), table, layout, f"b{n}", first_run=n == 0)
        read.append(m.refresh(spark, table, base, groups, measures).counts["parts_read"])
    assert read == [5, 3, 1]
    whole = m.merged_figures(m.partial_states(ps.read_state(spark, table), groups, measures), ["g"], measures)
    assert rows(m.figures(spark, base, ["g"], measures)) == rows(whole)
    values = sorted(v for v in dict(w for wave in waves for w in wave).values() if v is not None)
    row = m.figures(spark, base, [], measures).first()
    assert (row.n, row.total, row.top, row.low, row.kinds) == (620, sum(values), 1000, 0, len(set(values)))
    assert row.median == values[-(-len(values) // 2) - 1]
    # Nothing changed: nothing is read.
    assert m.refresh(spark, table, base, groups, measures).counts["parts_read"] == 0
    assert m.figures(spark, base, [], measures).first() == row


def test_a_group_without_values(spark, measures):
    df = spark.createDataFrame([(1, None)], "k long, v int")
    row = m.merged_figures(m.partial_states(df, {}, measures), [], measures).first()
    assert (row.n, row.total, row.median, row.kinds, row["mean"]) == (1, None, None, 0, None)


def test_observed_counters_run_no_action(spark, tmp_path):
    frame, counts = observed(spark.range(100), [F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") < 10).alias("small")])
    frame.write.parquet(str(tmp_path / "x"))
    assert counts() == {"n": 100, "small": 10}
    frame, counts = observed(spark.range(5).where("id > 9").repartition(2), [F.count(F.lit(1)).alias("n")])
    frame.write.parquet(str(tmp_path / "y"))
    assert counts() == {"n": 0}


def test_micro_batches_are_observed(spark, tmp_path):
    entity = replace(ENTITIES["outbound_delivery_partner"], compare=["Supplier"])
    raw = tmp_path / "raw"
    raw.mkdir()
    record = '{"SDDocument": "%s", "PartnerFunction": "SH", "AddressID": "A%s", "Supplier": "S"}'
    nested = '{"d": {"results": [%s]}}' if entity.envelope.startswith("d.") else '{"%s": [%%s]}' % entity.envelope
    (raw / "one.json").write_text(nested % (record % (1, 1)) + "\n" + nested % (record % (2, 2)) + "\nnot json\n")
    seen = []
    listener = intake.IntakeProgress(seen.append)
    spark.streams.addListener(listener)
    try:
        paths = silver.SilverPaths(str(tmp_path / "silver"))
        intake.run_intake(spark, entity, str(raw), paths, str(tmp_path / "checkpoint"))
        spark._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert [(s["epoch"], s["documents"], s["corrupt_documents"]) for s in seen] == [(0, 3, 1)]
    log = silver.read_log(spark, paths, entity).first()
    assert (log.records_processed, log.records_rejected) == (2, 1)
