"""Physical plan shape of the reports: no cross products, partial
aggregation before every shuffle of raw rows, pruned scans."""

import contextlib
import io

import pytest

from conftest import SF_SMALL
from urbanpulse.operators import silver
from urbanpulse.plans.lakehouse import Lakehouse
from urbanpulse.plans.registry import all_reports

# Reports whose builder writes tables or runs streams before returning.
WRITES = {"fact_partitioned_write", "fact_partition_read", "batch_table_read", "compact", "compact_quarantine",
          "zorder_rewrite", "zorder_silver", "commit_history", "as_of", "restore_as_of", "rollup_overwrite",
          "mart_table", "register_tables", "expire", "bronze_ingest",
          "stream_append", "stream_table_read", "dim_zone_stream", "dim_road_stream",
          "stream_dedup", "dual_route", "watermark", "late_arrivals", "medallion_chain", "pipeline_chain",
          "stream_hourly_rollup", "stream_health"}
LAZY = sorted(n for n in all_reports() if n not in WRITES)


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_products(spark, name):
    df = all_reports()[name][0](Lakehouse(spark, SF_SMALL))
    text = plan_text(df)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_dedup_limits_before_shuffle(spark):
    lh = Lakehouse(spark, SF_SMALL)
    text = plan_text(silver.dedup_first(lh.valid), "simple")
    exchange = text.index("Exchange hashpartitioning")  # printed top-down
    assert "WindowGroupLimit" in text[exchange:]


def test_replay_parses_once(spark):
    from urbanpulse.operators import quality
    lh = Lakehouse(spark, SF_SMALL)
    stored = lh.quarantine
    fixes = spark.createDataFrame([], "kafka_topic string, kafka_partition int, kafka_offset long, vehicle_id string")
    inner = plan_text(quality.replay(stored, fixes), "simple").count("from_json")
    assert inner - plan_text(stored, "simple").count("from_json") == 1


def test_dedup_order_across_partitions(spark):
    """Equal offsets in two partitions: the first arrival stays, whatever the input order."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 8)
    rows = [("V", t0, t0 + dt.timedelta(seconds=s), "t", p, 7, x) for s, p, x in ((5, 0, "later"), (1, 1, "first"))]
    schema = ("vehicle_id string, event_ts timestamp, kafka_timestamp timestamp, kafka_topic string, "
              "kafka_partition int, kafka_offset long, x string")
    for order in (rows, rows[::-1]):
        out = silver.dedup_first(spark.createDataFrame(order, schema).coalesce(1)).collect()
        assert [r["x"] for r in out] == ["first"]


def test_scan_is_pruned(spark):
    lh = Lakehouse(spark, SF_SMALL)
    text = plan_text(lh.table("events").select("event_id", "ts").where("event_id % 2 = 0"))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_hot_key_dedup_is_exact(spark):
    """A key holding a third of the rows is reduced map-side and keeps its
    lowest offset."""
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 8)
    rows = [("HOT", t0, 5000 - i, "x") for i in range(300)] + \
           [(f"V{i}", t0, 10000 + i, "y") for i in range(600)]
    df = spark.createDataFrame(rows, "vehicle_id string, event_ts timestamp, kafka_offset long, p string")
    out = silver.dedup_first(df.repartition(8), order=["kafka_offset"])
    assert out.count() == 601
    assert out.where("vehicle_id = 'HOT'").first()["kafka_offset"] == 4701


def test_partition_pruning_and_pushdown_on_stored_fact(spark, scratch_dir):
    import os
    from pyspark.sql import functions as F
    from urbanpulse.operators import gold, kpis
    lh = Lakehouse(spark, SF_SMALL)
    path = os.path.join(scratch_dir, "fact")
    gold.write_fact(lh.fact, path)
    fact = spark.read.parquet(path)
    pruned = fact.where((F.col("event_date") == F.lit("2024-01-15").cast("date"))
                        & F.col("event_hour").between(8, 11))
    text = plan_text(pruned)
    assert "PartitionFilters: [isnotnull(event_date" in text and "event_hour" in text
    detail = kpis.zone_detail(fact, gold.dim_zone(lh.silver), "cbd")
    assert "EqualTo(city_zone,CBD)" in plan_text(detail)
    # One file per date/hour directory.
    files = fact.inputFiles()
    dirs = {os.path.dirname(f) for f in files}
    assert len(files) == len(dirs)
