"""Registered reports for mergeable rollups, file skipping, packing, drift, checks, sketches, heat and buckets."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.operators import (binpack, buckets, drift, gold, heat, heavy_hitters, maintenance, observed, quality,
                                  rollup_states, silver, skip_index)
from urbanpulse.operators.skip_index import Predicate
from urbanpulse.plans.catalog import REPORTS as BATCH
from urbanpulse.plans.catalog import _scratch
from urbanpulse.plans.oracle import rnd, with_base

REPORTS: dict = {}
FACT_SQL = ", ".join(gold.FACT_COLUMNS)


def report(name, sql):
    def deco(fn):
        REPORTS[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------------------
# Mergeable rollup states
# ---------------------------------------------------------------------------
def _loaded_states(lh):
    """States of three loads, by topic partition, the newest delivery first; the second one is written twice."""
    path = _scratch(lh, "rollup_states")
    stored = _scratch(lh, "silver")
    lh.silver.write.parquet(stored)
    rows = lh.spark.read.parquet(stored)
    for load in (2, 0, 1, 0):
        part = gold.fact_traffic(rows.where(F.col("kafka_partition") == load))
        rollup_states.write_load(rollup_states.partial_states(part, lh.dim_road), path, f"partition-{load}")
    return rollup_states.read_states(lh.spark, path)


@report("rollup_merge_states", BATCH["agg_hourly_congestion"][1])
def _merge_states(lh):
    """The hourly rollup after three loads out of order, one of them repeated, then folded into one."""
    path = _scratch(lh, "rollup_states_compacted")
    rollup_states.compact_states(_loaded_states(lh), path)
    return rollup_states.hourly_from_states(rollup_states.read_states(lh.spark, path))


@report("rollup_merge_deviation", BATCH["kpi_weather_impact"][1])
def _merge_deviation(lh):
    """The weather report and its deviation from the same states."""
    return rollup_states.weather_from_states(_loaded_states(lh))


# ---------------------------------------------------------------------------
# File skipping, bin packing
# ---------------------------------------------------------------------------
INDEXED = ["road_id", "city_zone", "vehicle_id", "event_ts"]
Z_FILES = 16


def z_ordered_fact(lh, files: int = Z_FILES) -> tuple[str, str]:
    """(table, index): the fact in about ``files`` files along the Z-order of road and zone, and its skip index."""
    source, path, index = _scratch(lh, "fact"), _scratch(lh, "fact_zorder"), _scratch(lh, "fact_index")
    lh.fact.write.parquet(source)
    stored = lh.spark.read.parquet(source)
    size = maintenance.file_count(stored, 1)
    maintenance.zorder_rewrite(stored, path, ["road_id", "city_zone"], target_bytes=max(1, size // files))
    skip_index.write_index(lh.spark.read.parquet(path), index, INDEXED, ["vehicle_id"])
    return path, index


@report("skip_index_lookup", with_base(f"""
SELECT 'road and zone' AS lookup, {FACT_SQL} FROM fact WHERE road_id = 'R300' AND city_zone IN ('HARBOR', 'CBD')
UNION ALL SELECT 'vehicle', {FACT_SQL} FROM fact WHERE vehicle_id = (SELECT MIN(vehicle_id) FROM fact)
UNION ALL SELECT 'last day', {FACT_SQL} FROM fact
  WHERE event_ts >= (SELECT MAX(event_ts) FROM fact) - INTERVAL 1 DAY AND road_id = 'R100'"""))
def _skip_lookup(lh):
    """Three lookups through the skip index of the Z-ordered fact; all their rows."""
    path, index = z_ordered_fact(lh)
    stored = lh.spark.read.parquet(path)
    vehicle, newest = stored.agg(F.min("vehicle_id"), F.max("event_ts") - F.expr("INTERVAL 1 DAY")).first()
    since = F.lit(newest).cast(stored.schema["event_ts"].dataType)
    asked = {"road and zone": [Predicate("road_id", "=", "R300"), Predicate("city_zone", "in", ["HARBOR", "CBD"])],
             "vehicle": [Predicate("vehicle_id", "=", vehicle)],
             "last day": [Predicate("event_ts", ">=", since), Predicate("road_id", "=", "R100")]}
    out = None
    for name, predicates in asked.items():
        found = skip_index.lookup(stored, path, index, predicates).rows.select(F.lit(name).alias("lookup"), *gold.FACT_COLUMNS)
        out = found if out is None else out.unionByName(found)
    return out


@report("compact_binpack", with_base(f"SELECT {FACT_SQL} FROM fact"))
def _compact_binpack(lh):
    """The fact by date, as four appends leave it, after its undersized files were packed in place."""
    path = _scratch(lh, "fact_by_date")
    fact = lh.fact.withColumn("part", F.pmod(F.xxhash64("vehicle_id", "event_ts"), F.lit(4)))
    source = _scratch(lh, "fact")
    fact.write.parquet(source)
    stored = lh.spark.read.parquet(source)
    for k in range(4):
        (stored.where(F.col("part") == k).drop("part").repartition("event_date")
         .write.mode("append").partitionBy("event_date").parquet(path))
    binpack.compact_files(lh.spark, path)
    return lh.spark.read.parquet(path).select(*gold.FACT_COLUMNS)


# ---------------------------------------------------------------------------
# Type drift, observed checks
# ---------------------------------------------------------------------------
_TYPES = "CASE json_type(v) WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' " \
         "WHEN 'DOUBLE' THEN 'number' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'OBJECT' THEN 'object' ELSE 'array' END"


@report("schema_type_drift", with_base("""
SELECT path, type, COUNT(*) AS "rows", MIN(kafka_timestamp) AS first_seen, MAX(kafka_timestamp) AS last_seen,
  CASE WHEN path NOT IN ('vehicle_id', 'road_id', 'city_zone', 'speed', 'congestion_level', 'weather', 'vehicle_type',
                         'sensor_id', 'latitude', 'longitude', 'event_time', 'raw') THEN 'new path'
       WHEN type = 'null' OR type = CASE path WHEN 'congestion_level' THEN 'integer' WHEN 'latitude' THEN 'number'
              WHEN 'longitude' THEN 'number' WHEN 'speed' THEN CASE WHEN type IN ('integer', 'number') THEN type ELSE '' END
              ELSE 'string' END THEN 'none' ELSE 'new type' END AS drift
FROM typed_paths GROUP BY path, type""", extra_ctes=f"""
objects AS (SELECT CAST(raw_payload AS JSON) AS j, kafka_timestamp FROM bronze
  WHERE json_valid(raw_payload) AND json_type(raw_payload) = 'OBJECT'),
members AS (SELECT k AS path, json_extract(j, '$."' || k || '"') AS v, kafka_timestamp
  FROM (SELECT unnest(json_keys(j)) AS k, j, kafka_timestamp FROM objects)),
typed_paths AS (SELECT path, {_TYPES} AS type, kafka_timestamp FROM members)"""))
def _type_drift(lh):
    return drift.schema_type_drift(lh.bronze)


def staging_checks() -> list[observed.Check]:
    return [*observed.not_null("stg_traffic", ["vehicle_id", "city_zone", "speed_kmh", "congestion_level"]),
            observed.accepted("stg_traffic", "city_zone", S.ZONES),
            observed.accepted("stg_traffic", "congestion_level", S.CONGESTION_LEVELS)]


@report("observed_checks", with_base("""
SELECT 'stg_traffic' AS model, t.test, t.column_name, CAST(t.failures AS BIGINT) AS failures, n.total
FROM (SELECT COUNT(*) AS total, COUNT(*) - COUNT(vehicle_id) AS a, COUNT(*) - COUNT(city_zone) AS b,
        COUNT(*) - COUNT(speed_kmh) AS c, COUNT(*) - COUNT(congestion_level) AS d,
        COUNT(CASE WHEN city_zone NOT IN ('CBD', 'TECHPARK', 'TRAINSTATION', 'AIRPORT', 'HARBOR', 'SUBURB') THEN 1 END) AS e,
        COUNT(CASE WHEN congestion_level NOT IN (1, 2, 3, 4, 5) THEN 1 END) AS f FROM stg) n,
  LATERAL (VALUES ('not_null', 'vehicle_id', n.a), ('not_null', 'city_zone', n.b), ('not_null', 'speed_kmh', n.c),
    ('not_null', 'congestion_level', n.d), ('accepted_values', 'city_zone', n.e),
    ('accepted_values', 'congestion_level', n.f)) AS t(test, column_name, failures)
UNION ALL
SELECT 'traffic_bronze', 'sla', r.rule, COUNT(CASE WHEN dq_status = r.status OR (r.status = '' AND dq_status <> 'VALID') THEN 1 END),
  COUNT(*)
FROM dq, (VALUES ('Speed Range Check', 'SPEED_OUT_OF_BOUNDS'), ('Timestamp Freshness', 'FUTURE_TIMESTAMP_ANOMALY'),
  ('Payload Integrity', 'CORRUPT_PAYLOAD'), ('Vehicle Identifier', 'MISSING_VEHICLE_ID'),
  ('Watermark Latency', 'EXCESSIVE_LATENCY'), ('quarantined', '')) AS r(rule, status)
GROUP BY r.rule"""))
def _observed_checks(lh):
    """Counts that the writes of the staging table and of the quarantine took along."""
    staged = observed.write_checked(lh.stg, _scratch(lh, "stg_traffic"), staging_checks())
    rules = observed.rule_checks()
    rows, seen = observed.observed(lh.evaluated, rules)
    quality.quarantine(rows).write.parquet(_scratch(lh, "quarantine"))
    return staged.unionByName(observed.report(lh.spark, rules, seen.get))


# ---------------------------------------------------------------------------
# Frequent vehicles, heat surface
# ---------------------------------------------------------------------------
SUMMARY_SIZE = 8
_SUMMARY_CTE = f"""
counted AS (SELECT event_date, event_hour, vehicle_id AS value, COUNT(*) AS times FROM fact GROUP BY ALL),
placed AS (SELECT *, row_number() OVER (PARTITION BY event_date, event_hour ORDER BY times DESC, value) AS place FROM counted),
floors AS (SELECT event_date, event_hour, coalesce(MAX(CASE WHEN place = {SUMMARY_SIZE + 1} THEN times END), 0) AS floor
  FROM placed GROUP BY ALL),
kept AS (SELECT p.*, f.floor FROM placed p JOIN floors f USING (event_date, event_hour) WHERE place <= {SUMMARY_SIZE}
  AND event_date > (SELECT MAX(event_date) FROM fact) - 7)"""


@report("top_k_sketch", with_base("""
SELECT value AS vehicle_id, CAST(SUM(times) + a.all_floors - SUM(floor) AS BIGINT) AS estimate,
  CAST(a.all_floors - SUM(floor) AS BIGINT) AS error
FROM kept, (SELECT SUM(floor) AS all_floors FROM (SELECT DISTINCT event_date, event_hour, floor FROM kept)) a
GROUP BY value, a.all_floors ORDER BY estimate DESC, value LIMIT 20""", extra_ctes=_SUMMARY_CTE))
def _top_k_sketch(lh):
    """The twenty most frequent vehicles of the last seven days, from stored hourly summaries."""
    path = _scratch(lh, "vehicle_summaries")
    heavy_hitters.summarise(lh.fact, size=SUMMARY_SIZE).write.partitionBy("event_date").parquet(path)
    stored = lh.spark.read.parquet(path)
    last = stored.agg(F.max("event_date")).first()[0]
    recent = stored.where(F.col("event_date") > F.date_sub(F.lit(last), 7))
    return heavy_hitters.top_k(recent, 20).withColumnRenamed("value", "vehicle_id")


_HEAT_SQL = f"""
SELECT level, cell_x, cell_y, CAST(SUM(points) AS BIGINT) AS points, {rnd('SUM(weight * w) / 256.0', 4)} AS heat,
  {rnd('(cell_y + 0.5) * 0.01 * pow(2, level) - 90', 6)} AS cell_latitude,
  {rnd('(cell_x + 0.5) * 0.01 * pow(2, level) - 180', 6)} AS cell_longitude
FROM (SELECT level, x + dx AS cell_x, y + dy AS cell_y, CASE WHEN dx = 0 AND dy = 0 THEN points ELSE 0 END AS points, weight,
        (CASE abs(dx) WHEN 0 THEN 6 WHEN 1 THEN 4 ELSE 1 END) * (CASE abs(dy) WHEN 0 THEN 6 WHEN 1 THEN 4 ELSE 1 END) AS w
      FROM cells, (SELECT unnest(range(-2, 3)) AS dx), (SELECT unnest(range(-2, 3)) AS dy))
GROUP BY level, cell_x, cell_y"""


@report("heat_surface", with_base(_HEAT_SQL, extra_ctes="""
base AS (SELECT CAST(floor(longitude / 0.01) + 18000 AS BIGINT) AS x, CAST(floor(latitude / 0.01) + 9000 AS BIGINT) AS y, congestion_level
  FROM fact WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
cells AS (SELECT CAST(l AS INTEGER) AS level, x >> l AS x, y >> l AS y, COUNT(*) AS points, SUM(congestion_level) AS weight
  FROM base, (SELECT unnest([0, 1, 2]) AS l) GROUP BY ALL)"""))
def _heat_surface(lh):
    return heat.heat_surface(lh.fact)


# ---------------------------------------------------------------------------
# Buckets
# ---------------------------------------------------------------------------
_PARTIAL_SILVER = """
delivered AS (SELECT *, event_ts < kafka_timestamp - INTERVAL 15 MINUTE AS late FROM valid),
kept AS (SELECT DISTINCT vehicle_id, event_ts FROM delivered WHERE NOT late)"""


def bucketed_pair(lh, buckets_: int = buckets.BUCKETS):
    """(valid, silver) in buckets: all valid rows, and a silver that never saw rows over the watermark delay late."""
    database = "telemetry"
    lh.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = [*silver.DEDUP_KEYS, *silver.ARRIVAL_ORDER]
    source = _scratch(lh, "valid")
    lh.valid.select(*columns).write.parquet(source)
    valid = lh.spark.read.parquet(source)
    on_time = valid.where(F.col("event_ts") >= F.col("kafka_timestamp") - F.expr(f"INTERVAL {S.DEDUP_WATERMARK}"))
    names = {k: _scratch(lh, f"bucketed_{k}") for k in ("valid", "silver")}
    made = [buckets.store(df, f"{database}.{os.path.basename(names[k]).replace('-', '_')}", names[k], buckets_)
            for k, df in (("valid", valid), ("silver", silver.dedup_first(on_time)))]
    return made[0], made[1]


@report("late_arrivals_bucketed", with_base("""
SELECT vehicle_id, event_ts, kafka_timestamp, kafka_partition, kafka_offset FROM (
  SELECT d.* FROM delivered d WHERE late
    AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.vehicle_id = d.vehicle_id AND k.event_ts = d.event_ts)
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_ts
    ORDER BY kafka_timestamp, kafka_topic, kafka_partition, kafka_offset) = 1)""", extra_ctes=_PARTIAL_SILVER))
def _late_bucketed(lh):
    """Rows that an on-time silver lacks, recovered bucket by bucket."""
    buckets.prepare(lh.spark)
    return buckets.late_arrivals(*bucketed_pair(lh)).select(
        "vehicle_id", "event_ts", "kafka_timestamp", "kafka_partition", "kafka_offset")
