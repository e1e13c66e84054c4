"""One read of bronze, all sinks: conservation, failures between the writes, restarts."""

import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanpulse.operators import gold, rollup_states
from urbanpulse.operators.rollups import agg_hourly_congestion
from urbanpulse.plans.lakehouse import Lakehouse
from urbanpulse.sources import bronze as B
from urbanpulse.streaming import jobs, router

PLACE = ["kafka_topic", "kafka_partition", "kafka_offset"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """The first two days, stored."""
    path = str(tmp_path_factory.mktemp("run") / "bronze")
    Lakehouse(spark, SF_SMALL).bronze.where("kafka_timestamp < '2024-01-03'").coalesce(1).write.parquet(path)
    return Lakehouse(spark, SF_SMALL, tables={"bronze": path})


def bronze_files(lake, path, files):
    """A bronze table of several files in the order of arrival."""
    spark = lake.spark
    (lake.bronze.repartitionByRange(files, "kafka_timestamp").write.parquet(path))
    return B.read_table_stream(spark, path, jobs.bronze_schema(spark), max_files_per_trigger=1)


def routes(spark, root):
    out = []
    for route, sink in (("clean", "traffic_silver"), ("quarantine", "traffic_quarantine"), ("duplicate", "traffic_duplicates")):
        out += [(*r, route) for r in spark.read.parquet(os.path.join(root, sink)).select(*PLACE).collect()]
    return sorted(out)


def check(lake, root):
    """Every message is in one sink; keys are clean once; fact and rollup equal a recomputation from silver."""
    spark = lake.spark
    found = routes(spark, root)
    assert [r[:3] for r in found] == sorted(tuple(r) for r in lake.bronze.select(*PLACE).collect())
    stored = spark.read.parquet(os.path.join(root, "traffic_silver"))
    assert rows(stored.select("vehicle_id", "event_ts")) == rows(lake.silver.select("vehicle_id", "event_ts"))
    fact = spark.read.parquet(os.path.join(root, "fact_traffic")).select(*gold.FACT_COLUMNS)
    assert rows(fact) == rows(gold.fact_traffic(stored).select(*gold.FACT_COLUMNS))
    hours = rollup_states.hourly_from_states(spark.read.parquet(os.path.join(root, "rollup_states")))
    want = agg_hourly_congestion(fact, lake.dim_road)
    assert rows(hours.select(want.columns)) == rows(want)
    assert spark.read.parquet(os.path.join(root, "dim_zone")).count() == 6
    return found


@pytest.mark.parametrize("sink", ["traffic_duplicates", "traffic_silver"])
def test_killed_between_two_writes(spark, lake, scratch_dir, monkeypatch, sink):
    """The second micro-batch dies before the write of a sink; the restarted query loses and repeats nothing."""
    stream = bronze_files(lake, f"{scratch_dir}/bronze", 3)
    write, calls = router.write_batch, []

    def failing(df, path, batch, partition_by=()):
        if os.path.basename(path) == sink:
            calls.append(batch)
            if len(calls) == 2:
                raise RuntimeError("killed")
        write(df, path, batch, partition_by)

    monkeypatch.setattr(router, "write_batch", failing)
    root = f"{scratch_dir}/out"
    with pytest.raises(StreamingQueryException):
        router.start_router(stream, root, clock="kafka_timestamp").awaitTermination()
    before = routes(spark, root)
    assert 0 < len(before) < lake.bronze.count()
    router.start_router(stream, root, clock="kafka_timestamp").awaitTermination()
    assert calls[1] == calls[2] and len(set(calls)) == 3  # the same query and batch again
    check(lake, root)


def test_batches_and_a_new_checkpoint(spark, lake, scratch_dir):
    """One batch or several give the same clean keys; a second query of its own adds only what is new."""
    one, many = f"{scratch_dir}/one", f"{scratch_dir}/many"
    router.start_router(B.read_table_stream(spark, _bronze(lake, f"{scratch_dir}/b1", 1), jobs.bronze_schema(spark)), one,
                        clock="kafka_timestamp").awaitTermination()
    router.start_router(bronze_files(lake, f"{scratch_dir}/b2", 4), many, clock="kafka_timestamp").awaitTermination()
    assert check(lake, one) == check(lake, many)
    os.rename(f"{many}/_checkpoints", f"{many}/_lost")
    router.start_router(bronze_files(lake, f"{scratch_dir}/b3", 2), many, clock="kafka_timestamp").awaitTermination()
    silver = spark.read.parquet(f"{many}/traffic_silver")
    assert rows(silver.select("vehicle_id", "event_ts")) == rows(lake.silver.select("vehicle_id", "event_ts"))
    assert silver.select("batch").distinct().count() == 4  # all that came again is a duplicate


def _bronze(lake, path, files):
    lake.bronze.repartition(files).write.parquet(path)
    return path


def test_history_is_pruned(spark, lake, scratch_dir):
    """Seen keys come from the dates of the span only, and not from the batch itself."""
    path = f"{scratch_dir}/silver"
    rows_ = lake.silver.select("vehicle_id", "event_ts").withColumn("event_date", F.to_date("event_ts"))
    router.write_batch(rows_, path, "q-0", ("event_date",))
    lo = lake.silver.agg(F.min("event_ts")).first()[0]
    seen = router.seen_keys(spark, path, lo, lo, "q-1")
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert seen.count() == lake.silver.where(F.col("event_ts") == F.lit(lo)).count()
    assert router.seen_keys(spark, path, lo, lo, "q-0").count() == 0
    assert router.seen_keys(spark, f"{scratch_dir}/none", lo, lo, "q-0") is None


def test_only_invalid_rows(spark, lake, scratch_dir):
    bad = lake.evaluated.where("dq_status <> 'VALID'").select(lake.bronze.columns)
    bad.write.parquet(f"{scratch_dir}/bronze")
    stream = B.read_table_stream(spark, f"{scratch_dir}/bronze", jobs.bronze_schema(spark))
    router.start_router(stream, f"{scratch_dir}/out", clock="kafka_timestamp").awaitTermination()
    assert spark.read.parquet(f"{scratch_dir}/out/traffic_quarantine").count() == bad.count()


def test_kept_parts_are_bounded(spark, lake, scratch_dir, monkeypatch):
    """One file of bronze is kept in parts of about ``ROWS_PER_PART`` rows."""
    kept, valid_rows = [], router.silver.valid_rows

    def watched(rows_):
        kept.append([r[1] for r in rows_.groupBy(F.spark_partition_id()).count().collect()])
        return valid_rows(rows_)

    monkeypatch.setattr(router, "ROWS_PER_PART", 5, raising=False)
    monkeypatch.setattr(router.silver, "valid_rows", watched)
    stream = bronze_files(lake, f"{scratch_dir}/bronze", 1)
    router.start_router(stream, f"{scratch_dir}/out", clock="kafka_timestamp").awaitTermination()
    monkeypatch.undo()
    n = lake.bronze.count()
    assert n > 40 and sum(kept[0]) == n and max(kept[0]) < n / 2
    check(lake, f"{scratch_dir}/out")


def test_kept_rows_are_on_disk(spark, lake, scratch_dir, monkeypatch):
    """No executor's heap holds rows of the micro-batch between its writes; without stored keys they are kept once."""
    def stored():
        return {r.id(): (r.memSize(), r.diskSize()) for r in spark.sparkContext._jsc.sc().getRDDStorageInfo()}

    before, write, kept = set(stored()), router.write_batch, {}

    def watched(df, path, batch, partition_by=()):
        write(df, path, batch, partition_by)
        kept.setdefault(batch, []).append([v for k, v in stored().items() if k not in before])

    monkeypatch.setattr(router, "write_batch", watched)
    stream = bronze_files(lake, f"{scratch_dir}/bronze", 2)
    router.start_router(stream, f"{scratch_dir}/out", clock="kafka_timestamp").awaitTermination()
    monkeypatch.undo()
    first, second = (kept[b] for b in sorted(kept))
    assert all(memory == 0 and disk > 0 for found in first + second for memory, disk in found)
    assert {len(found) for found in first} == {1} and len(second[0]) == 2
    check(lake, f"{scratch_dir}/out")
