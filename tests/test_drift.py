"""Type drift, observed checks, frequent vehicles, heat surface, buckets."""

import collections
import random
from math import comb

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from urbanpulse.operators import buckets, drift, heat, heavy_hitters, observed, quality, silver
from urbanpulse.plans import extra
from urbanpulse.plans.lakehouse import Lakehouse
from urbanpulse.streaming import jobs
from urbanpulse.streaming.health import StreamHealth


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- type drift -------------------------------------------------------------------
def test_nested_and_changed_types(spark):
    payloads = ['{"speed": 12}', '{"speed": 12.5}', '{"speed": "FAST"}', '{"speed": {"kmh": 1, "src": {"id": true}}}',
                '{"speed": [1, 2]}', '{"speed": null, "new": 99999999999999999999}', '[1]', '7', 'not json', None, '{}',
                '{"latitude": 13.000}', '{"latitude": "13"}', '{"congestion_level": 2.0}']
    bronze = spark.createDataFrame([(p, k) for k, p in enumerate(payloads)], "raw_payload string, kafka_timestamp int")
    got = {(r["path"], r["type"]): (r["rows"], r["first_seen"], r["drift"]) for r in drift.schema_type_drift(bronze).collect()}
    assert got == {
        ("speed", "integer"): (1, 0, "none"), ("speed", "number"): (1, 1, "none"), ("speed", "string"): (1, 2, "new type"),
        ("speed", "object"): (1, 3, "new type"), ("speed.kmh", "integer"): (1, 3, "new path"),
        ("speed.src", "object"): (1, 3, "new path"), ("speed.src.id", "boolean"): (1, 3, "new path"),
        ("speed", "array"): (1, 4, "new type"), ("speed", "null"): (1, 5, "none"), ("new", "number"): (1, 5, "new path"),
        ("latitude", "number"): (1, 11, "none"), ("latitude", "string"): (1, 12, "new type"),
        ("congestion_level", "number"): (1, 13, "new type")}
    flat = drift.typed_paths(bronze, max_depth=1)
    assert flat.where("path like '%.%'").count() == 0
    assert drift.schema_type_drift(bronze.limit(0)).count() == 0


# --- observed checks ----------------------------------------------------------------
def test_checks_cost_no_second_scan(spark, scratch_dir):
    """One scan of the input, and the numbers of the check queries."""
    lake = Lakehouse(spark, SF_SMALL)
    lake.silver.write.parquet(f"{scratch_dir}/silver")
    stg = lake.stg.withColumn("city_zone", F.when(F.col("event_hour") == 3, None).when(F.col("event_hour") == 4, "X")
                              .otherwise(F.col("city_zone")))
    checks = extra.staging_checks()
    watched, _ = observed.observed(stg, checks)
    plan = watched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan
    got = {(r["test"], r["column_name"]): (r["failures"], r["total"])
           for r in observed.write_checked(stg, f"{scratch_dir}/stg", checks).collect()}
    n = stg.count()
    for r in quality.check_not_null(stg, ["vehicle_id", "city_zone", "speed_kmh", "congestion_level"], "m").collect():
        assert got["not_null", r["column_name"]] == (r["failures"], n)
    zones = [z for z in ("CBD", "TECHPARK", "TRAINSTATION", "AIRPORT", "HARBOR", "SUBURB")]
    assert got["accepted_values", "city_zone"][0] == quality.check_accepted_values(stg, "city_zone", zones, "m").first()["failures"] > 0
    assert got["not_null", "city_zone"][0] > 0
    assert rows(spark.read.parquet(f"{scratch_dir}/stg").select(stg.columns)) == rows(stg)
    empty = observed.write_checked(stg.limit(0), f"{scratch_dir}/none", checks)
    assert empty.where("failures + total > 0").count() == 0


def test_stream_checks_add_up(spark, scratch_dir):
    lake = Lakehouse(spark, SF_SMALL)
    lake.bronze.repartition(3).write.parquet(f"{scratch_dir}/bronze")
    stream = spark.readStream.schema(jobs.bronze_schema(spark)).option("maxFilesPerTrigger", "1").parquet(f"{scratch_dir}/bronze")
    rules = observed.rule_checks()
    evaluated = observed.observe_stream(quality.evaluate(stream, clock="kafka_timestamp"), "quality", rules)
    health = StreamHealth().attach(spark)
    query = (quality.quarantine(evaluated).writeStream.format("parquet").option("path", f"{scratch_dir}/out")
             .option("checkpointLocation", f"{scratch_dir}/ck").trigger(availableNow=True).start())
    query.awaitTermination()
    health.detach(spark)
    total = health.observed["quality"]
    want = quality.dlq_sla_audit(lake.evaluated).first()
    assert total["total"] == want["total_events"]
    report = {r["column_name"]: r["failures"] for r in observed.report(spark, rules, total).collect()}
    assert report["quarantined"] == total["traffic_bronze|sla|quarantined"] == want["quarantined_events"] == spark.read.parquet(f"{scratch_dir}/out").count()


# --- frequent vehicles ----------------------------------------------------------------
@pytest.mark.parametrize("size", [1, 3, 50])
def test_counts_lie_within_the_error(spark, size):
    rng = random.Random(size)
    data = [(f"d{rng.randint(0, 2)}", rng.randint(0, 3), rng.choices("abcdefghij", [40, 20, 9, 5, 5, 4, 3, 2, 1, 1])[0] if k % 40 else None)
            for k in range(3_000)]
    fact = spark.createDataFrame(data, "event_date string, event_hour int, vehicle_id string")
    stored = heavy_hitters.summarise(fact, size=size)
    assert stored.groupBy("event_date", "event_hour").count().where(F.col("count") > size).count() == 0
    for day in (None, "d1"):
        exact = collections.Counter(v for d, _, v in data if v and day in (None, d))
        part = stored if day is None else stored.where(F.col("event_date") == day)
        got = heavy_hitters.combine(part).collect()
        for r in got:
            assert r["estimate"] - r["error"] <= exact[r["value"]] <= r["estimate"]
        if size == 50:
            assert {r["value"]: r["estimate"] for r in got} == dict(exact) and all(r["error"] == 0 for r in got)
        assert heavy_hitters.top_k(part, 1).first()["value"] == "a"
    # what no summary holds occurs at most as often as all floors together
    floors = stored.groupBy("event_date", "event_hour").agg(F.max("floor").alias("f")).agg(F.sum("f")).first()[0]
    held = {r["value"] for r in stored.select("value").distinct().collect()}
    assert all(n <= floors for v, n in collections.Counter(v for *_, v in data if v).items() if v not in held)
    assert heavy_hitters.combine(stored.limit(0)).count() == 0


# --- heat surface -------------------------------------------------------------------
def test_heat_is_spread_and_kept(spark):
    data = [(12.9051, 77.5051, 4)] * 5 + [(12.9949, 77.4951, 3), (-0.001, -0.001, 2), (None, 77.5, 5), (95.0, 0.0, 5), (12.9051, 77.5051, None)]
    fact = spark.createDataFrame(data, "latitude double, longitude double, congestion_level int")
    cells = {(r["level"], r["cell_x"], r["cell_y"]): (r["points"], r["weight"]) for r in heat.pyramid(fact).collect()}
    x, y = 25750, 10290
    assert cells[0, x, y] == (6, 20) and cells[0, 17999, 8999] == (1, 2)
    for level in (1, 2):
        assert cells[level, x >> level, y >> level] == (6, 20)
        assert sum(v[0] for k, v in cells.items() if k[0] == level) == 8
    got = {(r["level"], r["cell_x"], r["cell_y"]): (r["points"], r["heat"]) for r in heat.heat_surface(fact).collect()}
    assert got[0, x, y] == (6, 20 * 36 / 256) and got[0, x + 1, y - 2] == (0, round(20 * comb(4, 3) * 1 / 256, 4))
    for level in range(3):
        assert abs(sum(h for (k, *_), (_, h) in got.items() if k == level) - 25) < 0.01  # nothing is lost or added
    assert heat.heat_surface(fact.limit(0)).count() == 0
    z = spark.range(1).select(heat.morton(F.lit(5), F.lit(3)).alias("z"))
    assert z.first()[0] == 0b011011 and z.select(heat.unmorton(F.col("z"), 0), heat.unmorton(F.col("z"), 1)).first() == (5, 3)


def test_a_dense_cell_is_combined_before_the_shuffle(spark):
    fact = spark.range(10).selectExpr("12.9 as latitude", "77.5 as longitude", "3 as congestion_level")
    plan = heat.pyramid(fact)._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("Exchange"):]
    assert "partial_sum" in first or "partial_count" in first


# --- buckets -------------------------------------------------------------------------
def test_no_exchange_above_the_scans(spark):
    lake = Lakehouse(spark, SF_ORACLE)
    buckets.prepare(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a history beyond it
        valid, stored = extra.bucketed_pair(lake, 4)
        late = buckets.late_arrivals(valid, stored)
        assert buckets.exchanges(late) == 0
        plain = silver.late_arrivals(valid, silver.dedup_first(stored))
        assert rows(late.select("kafka_offset")) == rows(plain.select("kafka_offset")) and late.count() > 0
        assert len(valid.inputFiles()) <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
