"""Streams give what the batch gives."""

import pytest
from pyspark.sql import functions as F

from plimsoll import dimensions as D
from plimsoll.plans import bindings as X
from plimsoll.streaming import cycles, run
from plimsoll.streaming.scoring import score_texts


def source(spark, sf_dir, name):
    schema = X.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def drain(stream, tmp_path, mode="append"):
    out = str(tmp_path / "out")
    q = (stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
         .trigger(availableNow=True).start(out))
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def test_scored_stream_equals_batch(spark, sf_dir, tmp_path):
    score = lambda df: score_texts(df, X.LEXICON, X.CLAUSES, ["doc_id"]).drop("policy_clauses")
    got = drain(score(source(spark, sf_dir, "documents")), tmp_path)
    assert sorted(got.collect()) == sorted(score(X.table(spark, sf_dir, "documents")).collect())


@pytest.mark.parametrize("slide", [None, "1 day"])
def test_closed_cycles_equal_batch(spark, sf_dir, tmp_path, slide):
    count = lambda df: cycles.cycle_counts(X.decisions_from(df), slide=slide, lateness="1 hour")
    got = drain(count(source(spark, sf_dir, "events")), tmp_path)
    batch = count(X.table(spark, sf_dir, "events"))
    last = X.table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    closed = batch.where(F.col("cycle_end") <= F.lit(last) - F.expr("INTERVAL 1 HOUR"))
    assert got.count() > 0 and sorted(got.collect()) == sorted(closed.collect())
    assert got.count() < batch.count()  # the open cycle is held back


def test_resent_rows_are_dropped(spark, sf_dir, tmp_path):
    rows = X.table(spark, sf_dir, "events")
    rows.union(rows).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    got = drain(cycles.unique_rows(cycles.as_event_time(stream), "event_id"), tmp_path)
    assert got.count() == rows.count()


def test_alerts_are_idempotent(spark, tmp_path):
    dims = D.with_tiers(D.declared(spark, X.EVENT_KINDS, ["category", "severity_tier"]), D.tiers(spark, X.TIERS))
    baseline = spark.createDataFrame([("click", 0.9), ("view", 0.9)], "category string, recall double")
    counts = spark.createDataFrame(
        [("click", 8, 2), ("view", 85, 15), ("view", 9, 1)], "category string, tp long, fn long").select(
        F.timestamp_seconds(F.lit(0)).alias("cycle_start"), "category", "tp", F.lit(0).cast("long").alias("fp"), "fn")
    sink = cycles.alert_sink(baseline, dims, str(tmp_path / "alerts"))
    for _ in range(2):
        sink(counts, 0)
    got = spark.read.parquet(str(tmp_path / "alerts")).collect()
    assert {(r["category"], r["kri_status"][:3]) for r in got} == {("click", "RED"), ("view", "AMB")} and len(got) == 2


def test_alert_stream_end_to_end(spark, sf_dir, tmp_path):
    counts = cycles.cycle_counts(X.decisions_from(source(spark, sf_dir, "events")), lateness="1 hour")
    baseline = spark.createDataFrame([(k, 1.0) for k, _ in X.EVENT_KINDS], "category string, recall double")
    sink = cycles.alert_sink(baseline, X.event_dimension(spark), str(tmp_path / "alerts"))
    q = (counts.writeStream.outputMode("append").foreachBatch(sink)
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination()
    alerts = spark.read.parquet(str(tmp_path / "alerts"))
    assert alerts.count() > 0 and alerts.groupBy("cycle_start", "category").count().where("count > 1").count() == 0


def test_a_stream_goes_on_from_its_folder(spark, sf_dir, tmp_path):
    """New files are read once, by a run that starts from what the one before has left."""
    rows = X.table(spark, sf_dir, "events")
    source, folder = str(tmp_path / "in"), str(tmp_path / "stream")
    rows.where("event_id % 2 = 0").coalesce(1).write.parquet(source)
    unique = lambda: cycles.unique_rows(cycles.as_event_time(run.table_stream(spark, source)), "event_id", "3650 days")
    assert run.drain(unique(), folder).count() == rows.where("event_id % 2 = 0").count()
    assert run.drain(unique(), folder).count() == rows.where("event_id % 2 = 0").count()
    rows.where("event_id % 3 < 2").coalesce(2).write.mode("append").parquet(source)  # half of them sent before
    got = run.drain(unique(), folder)
    assert sorted(r["event_id"] for r in got.select("event_id").collect()) == sorted(
        r["event_id"] for r in rows.where("event_id % 2 = 0 OR event_id % 3 < 2").select("event_id").collect())


def test_no_alert_is_an_empty_table(spark, sf_dir, tmp_path):
    counts = cycles.cycle_counts(X.decisions_from(run.table_stream(spark, f"{sf_dir}/events.parquet")), lateness="1 hour")
    got = run.drain_batches(counts, str(tmp_path / "s"), lambda batch, number: batch.count(), str(tmp_path / "rows"), cycles.ALERTS)
    assert got.count() == 0 and got.columns[0] == "cycle_start"
