"""Late and duplicate rows in a side output; what the state holds."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanpulse.plans.lakehouse import Lakehouse
from urbanpulse.sources import bronze as B
from urbanpulse.streaming import jobs, late, more_reports, state


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_every_row_is_somewhere(spark):
    """In = clean + duplicate + late + quarantine, row by row, and late rows carry their payload."""
    lake = Lakehouse(spark, SF_SMALL)
    root = more_reports._side_run(lake)
    silver = spark.read.parquet(os.path.join(root, late.SINKS["silver"]))
    side = spark.read.parquet(os.path.join(root, late.SINKS["side"]))
    place = ["kafka_topic", "kafka_partition", "kafka_offset"]
    assert rows(silver.select(*place).unionByName(side.select(*place))) == rows(lake.bronze.select(*place))
    counts = {r[0]: r[1] for r in side.groupBy("route").count().collect()}
    assert set(counts) == {"duplicate", "late", "quarantine"} and counts["late"] > 10
    assert silver.count() == silver.select("vehicle_id", "event_ts").distinct().count()
    assert side.where("route = 'late' and raw_payload is null").count() == 0
    # timers have cleared the hours behind the watermark
    keys = spark.read.format("statestore").option("stateVarName", "seen").load(os.path.join(root, "_checkpoints", "late"))
    held = keys.agg(F.min(F.col("key.k_hour")), F.count("*")).first()
    newest = lake.valid.agg(F.max(F.unix_micros("event_ts"))).first()[0]
    assert 0 < held[1] < 20 and held[0] >= (newest - 15 * 60_000_000) // late.HOUR_US


def test_a_restart_goes_on(spark, scratch_dir):
    """State survives a restart: a key of the first run is a duplicate in the second."""
    lake = Lakehouse(spark, SF_SMALL)
    feed = f"{scratch_dir}/feed"
    newest = lake.valid.agg(F.max("event_ts")).first()[0]
    last = lake.valid.where(F.col("event_ts") == F.lit(newest)).select("kafka_partition", "kafka_offset").first()
    message = lake.messages.where((F.col("partition") == last[0]) & (F.col("offset") == last[1]))
    jobs.use_rocksdb_state(spark)
    for _ in range(2):
        message.write.mode("append").parquet(feed)
        late.start_late_side_output(B.bronze(B.read_table_stream(spark, feed, lake.messages.schema)), scratch_dir,
                                    clock="kafka_timestamp").awaitTermination()
    assert spark.read.parquet(f"{scratch_dir}/{late.SINKS['silver']}").count() == 1
    assert [r[0] for r in spark.read.parquet(f"{scratch_dir}/{late.SINKS['side']}").select("route").collect()] == ["duplicate"]


def test_state_report_skew(spark):
    keys = spark.createDataFrame([(0, 10), (0, 20), (0, 30), (2, 5)], "partition_id int, at int")
    got = state.state_report(keys, F.col("at"), "s", 4).first()
    assert tuple(got) == ("s", 4, 5, 30, 4, 3, 3.0)
    empty = state.state_report(keys.limit(0), F.col("at"), "s", 4).first()
    assert tuple(empty) == ("s", 0, None, None, 4, 0, None)


def test_vehicles_of_an_hour_share_groups(spark, scratch_dir):
    """Very many vehicles make a few calls of the operator an hour; each vehicle's rows are still told apart."""
    one = Lakehouse(spark, SF_SMALL).valid.select("raw_payload", "vehicle_id").first()
    messages = spark.range(400).select(
        F.replace(F.lit(one[0]), F.lit(f'"{one[1]}"'), F.concat(F.lit('"V-'), F.col("id") % 300, F.lit('"'))).alias("raw"), "id")
    at = F.to_timestamp(F.lit("2024-01-05 10:00:30"))
    messages = messages.select(
        F.regexp_replace("raw", '"event_time":"[^"]*"', '"event_time":"2024-01-05T10:00:00+00:00"').alias("value"), at.alias("timestamp"),
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    jobs.use_rocksdb_state(spark)
    for _ in range(2):
        messages.write.mode("append").parquet(f"{scratch_dir}/feed")
        late.start_late_side_output(B.bronze(B.read_table_stream(spark, f"{scratch_dir}/feed", messages.schema)), scratch_dir,
                                    clock="kafka_timestamp").awaitTermination()
    clean = spark.read.parquet(f"{scratch_dir}/{late.SINKS['silver']}")
    assert clean.count() == clean.select("vehicle_id").distinct().count() == 300
    assert rows(spark.read.parquet(f"{scratch_dir}/{late.SINKS['side']}").groupBy("route").count()) == [("duplicate", 500)]
    held = spark.read.format("statestore").option("stateVarName", "seen").load(f"{scratch_dir}/_checkpoints/late")
    assert held.select("key").distinct().count() <= 8
