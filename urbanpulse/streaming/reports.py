"""Registered streaming reports.

Each report replays the telemetry messages derived from ``events`` from a message log
(``sources.message_log``) in the order of their arrival, runs the streaming chain into a
fresh folder under the session's checkpoint directory, and reads a sink back as a batch
DataFrame.  The chain runs once per (session, input folder) and is shared by the reports.

The log admits ``BATCH_SPAN_US`` of arrival time per micro-batch, whatever the size of the
table or of its files, and a batch of the later layers holds a whole one of those.  A row is dropped only behind
the watermark of the batch before the previous one, and a valid row is no more than
``MAX_LATENCY`` late, so nothing is lost and every sink has a plain SQL answer: silver
and fact equal the batch tables, the rollup equals the batch rollup on closed hours.  ``watermark`` and
``late_arrivals`` use a second feed whose late messages are delivered last, so
that the watermark really drops rows.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.operators import gold, quality, silver
from urbanpulse.plans.catalog import REPORTS as BATCH
from urbanpulse.plans.oracle import with_base
from urbanpulse.session import checkpoint_dir
from urbanpulse.sources import bronze as B
from urbanpulse.sources import message_log
from urbanpulse.streaming import jobs
from urbanpulse.streaming.health import StreamHealth

REPORTS: dict = {}
DATABASE = "telemetry"
#: Messages of a file of the second feed.
ROWS_PER_FILE = 1_000_000
#: Three days of arrival time: wide against the largest valid lateness (``MAX_LATENCY`` and ``FUTURE_TOLERANCE``).
BATCH_SPAN_US = 72 * 3_600_000_000
_RUNS: dict = {}
_LATE: dict = {}


def report(name, sql):
    def deco(fn):
        REPORTS[name] = (fn, sql)
        return fn
    return deco


def _run(lh):
    """Run (once) the whole chain for this session and input folder."""
    key = (lh.spark.sparkContext.applicationId, os.path.abspath(lh.sf_dir))
    if key in _RUNS:
        return _RUNS[key]
    root = os.path.join(checkpoint_dir(lh.spark), "streams", uuid.uuid4().hex[:12])
    log = os.path.join(root, "_log")
    message_log.append_messages(lh.messages, log, position="timestamp")
    feed = message_log.stream_log(lh.spark, log, startingOffsets="earliest", maxSpanPerTrigger=str(BATCH_SPAN_US),
                                  checkpointLocation=os.path.join(root, "_checkpoints", "bronze"))
    health = StreamHealth().attach(lh.spark)
    try:
        # Bronze writes at most ``tasks`` files a batch, so twice as many hold a whole batch
        # of the feed, wherever a downstream batch starts.
        tasks = lh.spark.sparkContext.defaultParallelism
        paths = jobs.run_chain(lh.spark, feed.coalesce(tasks), root, clock="kafka_timestamp",
                               max_files_per_trigger=2 * tasks, rollup=True, limited_source=True)
    finally:
        health.detach(lh.spark)
    _RUNS[key] = (paths, health)
    return _RUNS[key]


def _late_run(lh):
    """Run (once) silver over a feed that delivers the late messages last.

    Three deliveries, one micro-batch each: on-time messages of partition 0, the other
    on-time messages, and the messages over the watermark delay late.
    """
    key = (lh.spark.sparkContext.applicationId, os.path.abspath(lh.sf_dir))
    if key in _LATE:
        return _LATE[key]
    root = os.path.join(checkpoint_dir(lh.spark), "streams", uuid.uuid4().hex[:12])
    feed = os.path.join(root, "_feed")
    late = F.coalesce(F.col("event_ts") < F.col("kafka_timestamp") - F.expr(f"INTERVAL {S.DEDUP_WATERMARK}"),
                      F.lit(False))
    messages = lh.evaluated.select(
        F.col("raw_payload").alias("value"), F.col("kafka_timestamp").alias("timestamp"),
        F.col("kafka_topic").alias("topic"), F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.when(late, 2).when(F.col("kafka_partition") == 0, 0).otherwise(1).alias("delivery"))
    rows = messages.groupBy("delivery").count().collect()  # three numbers
    # a delivery is one write job of so many files, so the next one's files are newer
    counts = [r["count"] for r in rows]
    files = max(1, min(min(counts), -(-max(counts) // ROWS_PER_FILE)))
    for k in sorted(r["delivery"] for r in rows):
        part = messages.where(F.col("delivery") == k).drop("delivery")
        part.repartition(files).write.mode("append").parquet(feed)
    jobs.use_rocksdb_state(lh.spark)
    stream = B.bronze(B.read_table_stream(lh.spark, feed, S.MESSAGE_SCHEMA, max_files_per_trigger=files))
    evaluated = quality.evaluate(stream, clock="kafka_timestamp", processed_at=F.col("kafka_timestamp"))
    path = os.path.join(root, "traffic_silver")
    jobs.stream_append(silver.silver_stream(evaluated), path, os.path.join(root, "_checkpoints", "silver"),
                       "LateSilverStream").awaitTermination()
    _LATE[key] = path
    return path


def _read(lh, name):
    paths, _ = _run(lh)
    return lh.spark.read.parquet(paths[name])


@report("stream_append", BATCH["bronze_parse"][1])
def _stream_append(lh):
    return _read(lh, "traffic_bronze").drop("ingestion_ts")


@report("bronze_ingest", BATCH["bronze_parse"][1])
def _bronze_ingest(lh):
    """S1 on a replayed message stream (a Kafka topic needs the connector jar)."""
    return _read(lh, "traffic_bronze").drop("ingestion_ts")


@report("stream_table_read", BATCH["quarantine"][1])
def _stream_table_read(lh):
    return _read(lh, "traffic_quarantine")


@report("dim_zone_stream", BATCH["dim_zone"][1])
def _dim_zone_stream(lh):
    return _read(lh, "dim_zone").where("dim_updated_at IS NOT NULL").drop("dim_updated_at")


@report("dim_road_stream", BATCH["dim_road"][1])
def _dim_road_stream(lh):
    return _read(lh, "dim_road").where("dim_updated_at IS NOT NULL").drop("dim_updated_at")


@report("stream_dedup", BATCH["silver_clean"][1])
def _stream_dedup(lh):
    return _read(lh, "traffic_silver").drop("ingestion_ts")


@report("dual_route", with_base("""
SELECT a.rows_in, a.quarantined, b.clean, a.rows_in - a.quarantined - b.clean AS dropped
FROM (SELECT COUNT(*) AS rows_in, COUNT(CASE WHEN dq_status <> 'VALID' THEN 1 END) AS quarantined FROM dq) a,
     (SELECT COUNT(*) AS clean FROM silver) b"""))
def _dual_route(lh):
    """Conservation: rows in = quarantined + clean + dropped (duplicates and late)."""
    bronze = _read(lh, "traffic_bronze").agg(F.count(F.lit(1)).alias("rows_in"))
    dlq = _read(lh, "traffic_quarantine").agg(F.count(F.lit(1)).alias("quarantined"))
    clean = _read(lh, "traffic_silver").agg(F.count(F.lit(1)).alias("clean"))
    row = bronze.unionByName(dlq, allowMissingColumns=True).unionByName(clean, allowMissingColumns=True)
    totals = row.agg(*[F.max(c).alias(c) for c in ("rows_in", "quarantined", "clean")])
    return totals.withColumn("dropped", F.col("rows_in") - F.col("quarantined") - F.col("clean"))


# Rows that the second feed loses.  A micro-batch drops rows at or behind the watermark
# that held before the previous one: for the third delivery, what the first one set.
_LOST_CTE = """
delivered AS (SELECT *, CASE WHEN event_ts < kafka_timestamp - INTERVAL 15 MINUTE THEN 2
                             WHEN kafka_partition = 0 THEN 0 ELSE 1 END AS delivery FROM valid),
mark AS (SELECT date_trunc('milliseconds', MAX(event_ts)) - INTERVAL 15 MINUTE AS w FROM delivered
         WHERE delivery = 0),
kept AS (SELECT vehicle_id, event_ts FROM delivered, mark WHERE delivery < 2 OR event_ts > w),
lost AS (SELECT * FROM (SELECT d.* FROM delivered d, mark WHERE d.delivery = 2 AND d.event_ts <= mark.w) l
  WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.vehicle_id = l.vehicle_id AND k.event_ts = l.event_ts)
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_ts
    ORDER BY kafka_timestamp, kafka_topic, kafka_partition, kafka_offset) = 1)"""


@report("watermark", with_base("""
SELECT (SELECT COUNT(*) FROM lost) AS lost_keys,
  (SELECT COUNT(*) FROM (SELECT DISTINCT vehicle_id, event_ts FROM kept)) AS kept_keys""", extra_ctes=_LOST_CTE))
def _watermark(lh):
    """Keys that the streamed silver lost behind the watermark, and those it has."""
    stored = lh.spark.read.parquet(_late_run(lh))
    lost = silver.late_arrivals(lh.valid, stored).agg(F.count(F.lit(1)).alias("lost_keys"))
    kept = stored.select(*silver.DEDUP_KEYS).distinct().agg(F.count(F.lit(1)).alias("kept_keys"))
    both = lost.unionByName(kept, allowMissingColumns=True)
    return both.agg(F.max("lost_keys").alias("lost_keys"), F.max("kept_keys").alias("kept_keys"))


@report("late_arrivals", with_base("""
SELECT vehicle_id, event_ts, kafka_timestamp, kafka_partition, kafka_offset FROM lost""", extra_ctes=_LOST_CTE))
def _late_arrivals(lh):
    """VALID rows that a streamed silver lost, recovered from the valid rows."""
    return silver.late_arrivals(lh.valid, lh.spark.read.parquet(_late_run(lh))).select(
        "vehicle_id", "event_ts", "kafka_timestamp", "kafka_partition", "kafka_offset")


@report("medallion_chain", BATCH["fact_traffic"][1])
def _chain(lh):
    return _read(lh, "fact_traffic").select(*gold.FACT_COLUMNS)


REPORTS["pipeline_chain"] = REPORTS["medallion_chain"]


@report("stream_hourly_rollup", f"""
SELECT * FROM ({BATCH["agg_hourly_congestion"][1]})
WHERE event_date + event_hour * INTERVAL 1 HOUR + INTERVAL 1 HOUR <=
  (SELECT date_trunc('milliseconds', MAX(event_ts)) - INTERVAL 15 MINUTE FROM ({BATCH["fact_traffic"][1]}))""")
def _rollup(lh):
    """The rollup of closed hours: those the watermark has passed.  Open hours are not out yet."""
    return _read(lh, "agg_hourly_congestion").drop("computed_at")


@report("stream_health", with_base("""
SELECT q AS query_name, CAST(rows_in AS BIGINT) AS rows_in, CAST(0 AS BIGINT) AS rows_dropped_by_watermark,
  CAST(dups AS BIGINT) AS duplicate_rows_dropped
FROM (SELECT (SELECT COUNT(*) FROM msgs) AS m, (SELECT COUNT(*) FROM silver) AS s, (SELECT COUNT(*) FROM valid) AS v) n,
LATERAL (VALUES ('BronzeIngestionStream', n.m, 0), ('SilverCleanStream', n.m, n.v - n.s), ('QuarantineDLQStream', n.m, 0),
         ('GoldFactStream', n.s, 0), ('DimZoneStream', n.s, 0), ('DimRoadStream', n.s, 0),
         ('HourlyRollupStream', n.m, n.v - n.s)) AS t(q, rows_in, dups)"""))
def _health(lh):
    """Rows in and rows dropped of every query of the chain."""
    _, health = _run(lh)
    return health.report(lh.spark).select("query_name", "rows_in", "rows_dropped_by_watermark",
                                          "duplicate_rows_dropped")


#: Registered table -> a key column to look at.
TABLE_KEYS = {"bronze": "kafka_offset", "silver": "kafka_offset", "quarantine": "kafka_offset", "fact_traffic": "vehicle_id",
              "dim_zone": "city_zone", "dim_road": "road_id", "dim_zones_mart": "city_zone", "dim_roads_mart": "road_id",
              "fct_hourly_traffic_kpis": "road_id", "agg_hourly_congestion": "road_id"}


def _table_oracle() -> str:
    """The same facts of each table from the oracle's CTEs."""
    source = {"fact_traffic": "fact", "agg_hourly_congestion": "hours", "fct_hourly_traffic_kpis": "mart_hours"}
    folders = {"fact_traffic": "(SELECT COUNT(*) FROM (SELECT DISTINCT event_date, event_hour FROM fact))",
               "agg_hourly_congestion": "(SELECT COUNT(DISTINCT event_date) FROM fact)",
               "fct_hourly_traffic_kpis": "(SELECT COUNT(DISTINCT event_date) FROM stg)"}
    parts = [f"SELECT '{t}' AS table_name, COUNT(*) AS \"rows\", CAST(MIN({k}) AS VARCHAR) AS least_key, "
             f"CAST(MAX({k}) AS VARCHAR) AS greatest_key, CAST({folders.get(t, '0')} AS BIGINT) AS partitions FROM {source.get(t, t)}"
             for t, k in TABLE_KEYS.items()]
    return with_base("\nUNION ALL\n".join(parts), extra_ctes="""
hours AS (SELECT DISTINCT city_zone, road_id, event_date, event_hour FROM fact),
mart_hours AS (SELECT DISTINCT event_date, event_hour, city_zone, road_id, is_peak_hour, is_weekend FROM stg)""")


@report("register_tables", _table_oracle())
def _register(lh):
    """Every table of a stored lakehouse, by its name in a catalog database: rows, ends of a key, partition folders found."""
    stored = lh.materialize(os.path.join(checkpoint_dir(lh.spark), "lakehouse", uuid.uuid4().hex[:12]))
    names = jobs.register_tables(lh.spark, stored._tables, DATABASE)
    out = None
    for name in names:
        table, key = f"{DATABASE}.{name}", TABLE_KEYS[name]
        folders = 0
        if any(c.isPartition for c in lh.spark.catalog.listColumns(table)):
            folders = lh.spark.sql(f"SHOW PARTITIONS {table}").count()
        found = lh.spark.sql(f"""SELECT '{name}' AS table_name, COUNT(*) AS rows, CAST(MIN({key}) AS STRING) AS least_key,
            CAST(MAX({key}) AS STRING) AS greatest_key, {folders}L AS partitions FROM {table}""")
        out = found if out is None else out.unionByName(found)
    return out
