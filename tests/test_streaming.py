"""Streaming chain: conservation, batch equality, restart, dimensions, health."""

import os
from types import SimpleNamespace

from pyspark.sql import functions as F

import feed as feed_files
from conftest import SF_SMALL
from urbanpulse.operators import quality, silver
from urbanpulse.plans.fixture import telemetry_messages
from urbanpulse.plans.lakehouse import Lakehouse
from urbanpulse.sources import bronze as B
from urbanpulse.streaming import jobs, reports
from urbanpulse.streaming.health import StreamHealth


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_chain_equals_batch_and_conserves_rows(spark, scratch_dir):
    lh = Lakehouse(spark, SF_SMALL)
    feed = os.path.join(scratch_dir, "feed")
    assert feed_files.write_files(lh.messages, feed, 175) == 6
    health = StreamHealth().attach(spark)
    paths = jobs.run_chain(spark, feed_files.stream(spark, feed, 2), scratch_dir,
                           max_files_per_trigger=2, rollup=True)
    health.detach(spark)
    assert not health.running
    bronze = spark.read.parquet(paths["traffic_bronze"])
    dlq = spark.read.parquet(paths["traffic_quarantine"])
    silver = spark.read.parquet(paths["traffic_silver"])
    n_in, n_dlq, n_clean = bronze.count(), dlq.count(), silver.count()
    assert n_in == 1033 and n_dlq == 1033 - 832
    # Conservation: in = quarantined + clean + duplicates + late.
    n_dups = lh.valid.count() - lh.silver.count()
    late = lh.valid.join(silver.select("vehicle_id", "event_ts"), ["vehicle_id", "event_ts"], "left_anti")
    assert n_in == n_dlq + n_clean + n_dups + late.select("vehicle_id", "event_ts").distinct().count()
    # Large micro-batches lose nothing: streamed silver = batch silver.
    keys = ["kafka_partition", "kafka_offset"]
    assert _rows(silver.select(*keys)) == _rows(lh.silver.select(*keys))
    # Dimensions emitted once per key, without empty files.
    assert len(spark.read.parquet(paths["dim_zone"]).inputFiles()) <= 6
    assert spark.read.parquet(paths["dim_zone"]).count() == 6
    assert spark.read.parquet(paths["dim_road"]).count() == 5
    # Closed hours of the streamed rollup equal the batch rollup.
    from urbanpulse.operators.rollups import agg_hourly_congestion
    batch = agg_hourly_congestion(lh.fact, lh.dim_road)
    streamed = spark.read.parquet(paths["agg_hourly_congestion"]).drop("computed_at")
    assert streamed.count() >= batch.count() - 1
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_small_batches_drop_late_rows_and_restart(spark, scratch_dir):
    lh = Lakehouse(spark, SF_SMALL)
    feed = os.path.join(scratch_dir, "feed")
    feed_files.write_files(lh.messages, feed, 18)
    root = os.path.join(scratch_dir, "out")
    # First run: half the feed arrives.
    files = sorted(f for f in os.listdir(feed) if f.endswith(".parquet"))
    assert len(files) >= 30
    paths = jobs.table_paths(root)
    jobs.start_bronze(feed_files.stream(spark, feed, 1), root).awaitTermination()
    bronze_in = B.read_table_stream(spark, paths["traffic_bronze"], jobs.bronze_schema(spark),
                                    max_files_per_trigger=1)
    for q in jobs.start_silver_routes(bronze_in, root, clock="kafka_timestamp"):
        q.awaitTermination()
    silver_1 = spark.read.parquet(paths["traffic_silver"]).count()
    # Restart over the same checkpoints: nothing new, nothing duplicated.
    bronze_in = B.read_table_stream(spark, paths["traffic_bronze"], jobs.bronze_schema(spark),
                                    max_files_per_trigger=1)
    for q in jobs.start_silver_routes(bronze_in, root, clock="kafka_timestamp"):
        q.awaitTermination()
    assert spark.read.parquet(paths["traffic_silver"]).count() == silver_1
    # With small batches some rows fall behind the watermark; they are exactly
    # the valid keys missing from silver.
    silver = spark.read.parquet(paths["traffic_silver"])
    missing = lh.valid.join(silver.select("vehicle_id", "event_ts"), ["vehicle_id", "event_ts"], "left_anti")
    assert silver_1 + missing.select("vehicle_id", "event_ts").distinct().count() == 800


def test_insert_if_absent_is_idempotent(spark, scratch_dir):
    path = os.path.join(scratch_dir, "dim")
    batch = spark.createDataFrame([("A", 1), ("B", 2)], "k string, v int")
    jobs.insert_if_absent(batch, path, "k")
    jobs.insert_if_absent(batch, path, "k")  # replayed micro-batch
    jobs.insert_if_absent(spark.createDataFrame([("C", 3), ("A", 9)], "k string, v int"), path, "k")
    assert _rows(spark.read.parquet(path)) == [("A", 1), ("B", 2), ("C", 3)]


def test_watermark_really_drops_rows(spark):
    from __spark_entry__ import queries
    got = queries()["watermark"](spark, SF_SMALL).first()
    assert got["lost_keys"] > 0 and got["kept_keys"] > 0
    lh = Lakehouse(spark, SF_SMALL)
    assert got["lost_keys"] + got["kept_keys"] == lh.silver.count()


def test_registered_tables(spark, scratch_dir):
    lh = Lakehouse(spark, SF_SMALL)
    stored = lh.materialize(os.path.join(scratch_dir, "lake"))
    names = jobs.register_tables(spark, stored._tables, "telemetry_test")
    assert len(names) == 10
    assert spark.sql("select count(*) from telemetry_test.fact_traffic").first()[0] == 800
    assert "aggregated_at" in spark.table("telemetry_test.fct_hourly_traffic_kpis").columns
    assert "dim_updated_at" in spark.table("telemetry_test.dim_zone").columns
    assert set(jobs.register_tables(spark, stored._tables)) == set(names)
    assert spark.table("dim_road").count() == 5


def test_batches_span_arrival_time_at_any_size(spark, scratch_dir, monkeypatch):
    """A feed of two and a half days in batches of one: valid rows that are 90 minutes late are not lost."""
    events = spark.range(1, 721).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, CAST(5 * id AS INT)) AS ts",
        "id % 90 AS user_id", "'view' AS event_type", "CAST(id % 100 AS DOUBLE) AS value")
    messages = telemetry_messages(events)
    monkeypatch.setattr(reports, "BATCH_SPAN_US", 24 * 3_600_000_000)
    paths, _ = reports._run(SimpleNamespace(spark=spark, sf_dir=scratch_dir, messages=messages))
    batch = silver.silver_clean(quality.evaluate(B.bronze(messages), clock="kafka_timestamp",
                                                 processed_at=F.col("kafka_timestamp")))
    keys = ["vehicle_id", "event_ts"]
    want = _rows(batch.select(*keys))
    assert len(want) > 400
    for name in ("traffic_silver", "fact_traffic"):
        assert _rows(spark.read.parquet(paths[name]).select(*keys)) == want


def test_fact_sink_gathers_an_hour(spark, scratch_dir):
    """A micro-batch of many files writes a file an hour, not one from every task."""
    source = Lakehouse(spark, SF_SMALL).silver.where("event_ts < '2024-01-03'")
    source.repartition(6).write.parquet(f"{scratch_dir}/silver")
    stored = B.read_table_stream(spark, f"{scratch_dir}/silver", spark.read.parquet(f"{scratch_dir}/silver").schema)
    for query in jobs.start_gold(stored, f"{scratch_dir}/out"):
        query.awaitTermination()
    fact = spark.read.parquet(f"{scratch_dir}/out/fact_traffic")
    assert fact.count() == source.count()
    assert len(fact.inputFiles()) == source.select(F.date_trunc("hour", "event_ts")).distinct().count()
