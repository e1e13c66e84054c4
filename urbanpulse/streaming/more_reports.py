"""Registered streaming reports on the message log, the one-read router, the side output and state."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.operators import gold, rollup_states
from urbanpulse.plans.catalog import REPORTS as BATCH
from urbanpulse.plans.oracle import with_base
from urbanpulse.session import checkpoint_dir
from urbanpulse.sources import bronze as B
from urbanpulse.sources import message_log
from urbanpulse.streaming import jobs, late, reports, router, state

REPORTS: dict = {}
HOUR_US = 3_600_000_000
_RUNS: dict = {}


def report(name, sql):
    def deco(fn):
        REPORTS[name] = (fn, sql)
        return fn
    return deco


def _root(lh) -> str:
    return os.path.join(checkpoint_dir(lh.spark), "streams", uuid.uuid4().hex[:12])


def _once(lh, kind, run):
    key = (kind, lh.spark.sparkContext.applicationId, os.path.abspath(lh.sf_dir))
    if key not in _RUNS:
        _RUNS[key] = run()
    return _RUNS[key]


@report("bronze_log_source", BATCH["bronze_parse"][1])
def _bronze_log(lh):
    """Bronze from a log of messages by topic, partition and offset."""
    root = _root(lh)
    log = os.path.join(root, "_log")
    message_log.append_messages(lh.messages, log)
    jobs.start_bronze(message_log.stream_log(lh.spark, log, startingOffsets="earliest"), root).awaitTermination()
    return lh.spark.read.parquet(os.path.join(root, "traffic_bronze")).drop("ingestion_ts")


# ---------------------------------------------------------------------------
# Router
# ---------------------------------------------------------------------------
def _routed(lh):
    """Run (once) bronze from a log in the order of arrival, then the router."""
    def run():
        root = _root(lh)
        log = os.path.join(root, "_log")
        message_log.append_messages(lh.messages, log, position="timestamp")
        feed = message_log.stream_log(lh.spark, log, startingOffsets="earliest")
        return router.run_chain_once(lh.spark, feed, root)
    return _once(lh, "router", run)


@report("dual_route_once", with_base("""
SELECT kafka_topic, kafka_partition, kafka_offset,
  CASE WHEN dq_status <> 'VALID' THEN 'quarantine'
       WHEN row_number() OVER (PARTITION BY dq_status, vehicle_id, event_ts
              ORDER BY kafka_timestamp, kafka_topic, kafka_partition, kafka_offset) = 1 THEN 'clean' ELSE 'duplicate' END AS route
FROM dq"""))
def _dual_route_once(lh):
    """The sink of every message: each is in exactly one."""
    paths = _routed(lh)
    sinks = {"clean": "traffic_silver", "quarantine": "traffic_quarantine", "duplicate": "traffic_duplicates"}
    out = None
    for route, name in sinks.items():
        part = lh.spark.read.parquet(paths[name]).select("kafka_topic", "kafka_partition", "kafka_offset", F.lit(route).alias("route"))
        out = part if out is None else out.unionByName(part)
    return out


@report("router_fact", BATCH["fact_traffic"][1])
def _router_fact(lh):
    """The fact that the router's batches wrote."""
    return lh.spark.read.parquet(_routed(lh)["fact_traffic"]).select(*gold.FACT_COLUMNS)


@report("router_rollup", BATCH["agg_hourly_congestion"][1])
def _router_rollup(lh):
    """The hourly rollup from the states that the router's batches wrote: all hours, open and late ones too."""
    return rollup_states.hourly_from_states(lh.spark.read.parquet(_routed(lh)["rollup_states"]))


@report("router_closed_hours", reports.REPORTS["stream_hourly_rollup"][1])
def _router_closed(lh):
    """The continuous rollup (T7) without a second pass over bronze: hours that the watermark has passed."""
    paths = _routed(lh)
    hours = rollup_states.hourly_from_states(lh.spark.read.parquet(paths["rollup_states"]))
    newest = lh.spark.read.parquet(paths["traffic_silver"]).agg(F.max("event_ts")).first()[0]
    newest = F.date_trunc("millisecond", F.lit(newest).cast("timestamp"))
    return router.closed_hours(hours, newest)


# ---------------------------------------------------------------------------
# Side output, state
# ---------------------------------------------------------------------------
def _side_run(lh):
    """Run (once) the side output over two deliveries: the messages that are on time, then the late ones."""
    def run():
        root = _root(lh)
        behind = F.coalesce(F.col("event_ts") < F.col("kafka_timestamp") - F.expr(f"INTERVAL {S.DEDUP_WATERMARK}"), F.lit(False))
        messages = lh.evaluated.select(
            F.col("raw_payload").alias("value"), F.col("kafka_timestamp").alias("timestamp"), F.col("kafka_topic").alias("topic"),
            F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), behind.alias("behind"))
        stored = os.path.join(root, "_messages")
        messages.write.partitionBy("behind").parquet(stored)
        jobs.use_rocksdb_state(lh.spark)
        for delivery in ("false", "true"):  # each is what the feed folder holds when the query runs again
            part = lh.spark.read.schema(S.MESSAGE_SCHEMA).parquet(f"{stored}/behind={delivery}")
            part.write.mode("append").parquet(os.path.join(root, "_feed"))
            stream = B.bronze(B.read_table_stream(lh.spark, os.path.join(root, "_feed"), S.MESSAGE_SCHEMA))
            late.start_late_side_output(stream, root, clock="kafka_timestamp").awaitTermination()
        return root
    return _once(lh, "late", run)


@report("late_side_output", with_base("""
SELECT vehicle_id, event_ts, kafka_partition, route, COUNT(*) AS "rows" FROM routed GROUP BY ALL""", extra_ctes="""
delivered AS (SELECT *, coalesce(event_ts < kafka_timestamp - INTERVAL 15 MINUTE, false) AS behind FROM dq),
mark AS (SELECT date_trunc('milliseconds', MAX(event_ts)) - INTERVAL 15 MINUTE AS w FROM delivered
         WHERE NOT behind AND dq_status = 'VALID'),
told AS (SELECT vehicle_id, event_ts, kafka_partition, CASE WHEN dq_status <> 'VALID' THEN 'quarantine'
    WHEN behind AND event_ts <= w THEN 'late' ELSE 'seen' END AS route, behind, kafka_offset FROM delivered, mark),
first_seen AS (SELECT *, route = 'seen' AND row_number() OVER (PARTITION BY route, vehicle_id, event_ts ORDER BY behind) = 1 AS is_first
  FROM told),
keyed AS (SELECT vehicle_id, event_ts, MIN(kafka_partition) AS one, MAX(kafka_partition) AS other FROM told
  WHERE route = 'seen' GROUP BY vehicle_id, event_ts),
routed AS (SELECT f.vehicle_id, f.event_ts, CASE WHEN f.route = 'seen' THEN k.one ELSE f.kafka_partition END AS kafka_partition,
    CASE WHEN f.route <> 'seen' THEN f.route WHEN f.is_first THEN 'clean' ELSE 'duplicate' END AS route
  FROM first_seen f LEFT JOIN keyed k ON f.vehicle_id = k.vehicle_id AND f.event_ts = k.event_ts AND f.route = 'seen')"""))
def _late_side_output(lh):
    """Rows by key and route over silver and the side output; the clean one of equal keys is any of them."""
    root = _side_run(lh)
    clean = lh.spark.read.parquet(os.path.join(root, late.SINKS["silver"])).withColumn("route", F.lit(router.CLEAN))
    side = lh.spark.read.parquet(os.path.join(root, late.SINKS["side"]))
    columns = ["vehicle_id", "event_ts", "kafka_partition", "route"]
    rows = clean.select(*columns).unionByName(side.select(*columns))
    seen = F.col("route").isin(router.CLEAN, router.DUPLICATE)
    lowest = rows.where(seen).groupBy("vehicle_id", "event_ts").agg(F.min("kafka_partition").alias("one"))
    named = rows.where(seen).join(lowest, ["vehicle_id", "event_ts"]).select(
        "vehicle_id", "event_ts", F.col("one").alias("kafka_partition"), "route")
    return named.unionByName(rows.where(~seen)).groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


@report("stream_state_health", with_base("""
SELECT 'silver_dedup' AS store, COUNT(*) AS keys, MIN(event_ts) AS oldest_event, MAX(event_ts) AS newest_event FROM silver, mark
WHERE event_ts > w
UNION ALL
SELECT 'rollup_hours', COUNT(*), MIN(h), MAX(h)
FROM (SELECT DISTINCT city_zone, road_id, date_trunc('hour', event_ts) AS h FROM silver), mark WHERE h + INTERVAL 1 HOUR > w""",
    extra_ctes="""
mark AS (SELECT date_trunc('milliseconds', MAX(event_ts)) - INTERVAL 15 MINUTE AS w FROM silver)"""))
def _state_health(lh):
    """What the state of the chain still holds when the feed is through."""
    paths, _ = reports._run(lh)
    folder = os.path.join(os.path.dirname(paths["traffic_silver"]), "_checkpoints")
    found = state.dedup_report(lh.spark, os.path.join(folder, "silver")).unionByName(
        state.rollup_report(lh.spark, os.path.join(folder, "rollup")))
    return found.select("store", "keys", "oldest_event", "newest_event")
