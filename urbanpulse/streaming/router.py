"""One read of bronze, every sink of a micro-batch.

``start_router`` runs one ``foreachBatch`` query over bronze.  A micro-batch is evaluated once and
kept for the time of its writes, dealt by its keys and not as its files lie: a bronze file of few bytes holds
very many rows, and a part that is kept is read whole by one task.  It is kept on the executors' disks: their heaps hold
what their tasks work on, whatever the size of the batch.  Each row is routed to exactly one of clean, duplicate and
quarantine.  From the clean rows of the batch the same function writes the fact, new
dimension keys and the hour states of the rollup (``operators.rollup_states``): no
other query reads or parses bronze again.

Exactly once: every sink has the partition column ``batch`` (query id and batch id), and a write
replaces its own batch.  A batch that is run again after a failure, wherever it stopped, writes the same
rows to the same partitions; a new checkpoint has a new query id and touches no older
rows.  Dimensions are inserted if absent.  Only what earlier batches stored counts as seen, never the
batch's own rows of a former attempt.

The fact of a micro-batch lies by date and batch, clustered by hour; ``gold.write_fact`` gives the layout by date
and hour where it is stored for good.

Duplicates are found against the stored keys of the event-time span that the batch covers
(valid rows are at most some hours late), so no row is lost behind a watermark and no state store
is needed.  The span's dates prune partitions and its bounds the row groups that are read.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from urbanpulse import schemas as S
from urbanpulse.operators import gold, quality, rollup_states, silver
from urbanpulse.sources import bronze as B
from urbanpulse.streaming import jobs

CLEAN, DUPLICATE, QUARANTINE = "clean", "duplicate", "quarantine"
#: Rows of a micro-batch that one part holds while it is kept.
ROWS_PER_PART = 100_000
SINKS = ("traffic_silver", "traffic_quarantine", "traffic_duplicates", "fact_traffic", "rollup_states")


def sink_paths(root: str) -> dict[str, str]:
    return {name: os.path.join(root, name) for name in (*SINKS, "traffic_bronze", "dim_zone", "dim_road")}


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the query of a checkpoint: the same for every restart."""
    return spark.read.json(os.path.join(checkpoint, "metadata")).first()["id"]


def write_batch(df: DataFrame, path: str, batch: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write the rows of a batch; what an earlier attempt of it wrote is replaced."""
    (df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by, "batch").parquet(path))


def seen_keys(spark: SparkSession, path: str, lo, hi, batch: str) -> DataFrame | None:
    """Keys that other batches stored with an event time in the span; None where nothing is stored."""
    stored = jobs._read_or_none(spark, path)
    if stored is None or lo is None:
        return None
    return (stored.where(F.col("event_date").between(F.to_date(F.lit(lo)), F.to_date(F.lit(hi))))
            .where(F.col("event_ts").between(F.lit(lo), F.lit(hi))).where(F.col("batch") != batch)
            .select(*silver.DEDUP_KEYS))


def ranked(evaluated: DataFrame, parts: int | None = None) -> DataFrame:
    """Every row with ``_nth``, its place among the arrivals of its key; in so many parts (default: as the session shuffles)."""
    valid = F.col("dq_status") == S.STATUS_VALID
    # invalid rows have no key to meet on: they are spread by their offset
    own = F.when(~valid, F.xxhash64("kafka_topic", "kafka_partition", "kafka_offset"))
    keys = ["_vehicle", "_event", "_own"]
    rows = evaluated.withColumns({
        "_vehicle": F.when(valid, F.col("vehicle_id")), "_event": F.when(valid, F.col("event_ts")), "_own": own})
    if parts:
        rows = rows.repartition(parts, *keys)
    first = Window.partitionBy(*keys).orderBy(*silver.ARRIVAL_ORDER)
    return rows.withColumn("_nth", F.row_number().over(first)).drop(*keys)


def with_route(rows: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Every ``ranked`` row with its ``route``; the first arrival of a key that is not ``seen`` yet is clean."""
    valid = F.col("dq_status") == S.STATUS_VALID
    columns = [c for c in rows.columns if c != "_nth"]
    if seen is None:
        known: Column = F.lit(False)
    else:
        marks = seen.distinct().select(*(F.col(k).alias(f"_{k}") for k in silver.DEDUP_KEYS), F.lit(True).alias("_known"))
        rows = rows.join(marks, [F.col(k) == F.col(f"_{k}") for k in silver.DEDUP_KEYS], "left")
        known = F.coalesce("_known", F.lit(False))
    route = (F.when(~valid, F.lit(QUARANTINE)).when(known | (F.col("_nth") > 1), F.lit(DUPLICATE)).otherwise(F.lit(CLEAN)))
    return rows.withColumn("route", route).select(*columns, "route")


def parts_of(batch: DataFrame) -> int | None:
    """Parts that hold a micro-batch of ``ROWS_PER_PART`` rows each; None where the session's number does."""
    parts = -(-batch.count() // ROWS_PER_PART)
    return parts if parts > int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def route_batch(batch: DataFrame, batch_id: int, root: str, query: str, clock: str) -> None:
    """All writes of one micro-batch of bronze."""
    spark = batch.sparkSession
    paths, name = sink_paths(root), f"{query}-{batch_id}"
    evaluated = quality.evaluate(batch, clock=clock, processed_at=F.col(clock))
    arrived = ranked(evaluated, parts_of(batch)).persist(StorageLevel.DISK_ONLY)
    try:
        valid = silver.valid_rows(arrived)
        lo, hi = valid.agg(F.min("event_ts"), F.max("event_ts")).first()
        seen = seen_keys(spark, paths["traffic_silver"], lo, hi, name)
        routed = with_route(arrived, seen)
        if seen is not None:  # else a projection of what is kept already
            routed = routed.persist(StorageLevel.DISK_ONLY)
        try:
            write_batch(quality.quarantine(routed.where(F.col("route") == QUARANTINE)), paths["traffic_quarantine"], name)
            keys = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", *silver.DEDUP_KEYS]
            write_batch(routed.where(F.col("route") == DUPLICATE).select(*keys), paths["traffic_duplicates"], name)
            if lo is None:
                return
            clean = silver.enrich(routed.where(F.col("route") == CLEAN).drop("route"))
            fact = gold.fact_traffic(clean)
            for build, table, key in ((gold.dim_zone, "dim_zone", "city_zone"), (gold.dim_road, "dim_road", "road_id")):
                jobs.insert_if_absent(build(clean, with_updated_at=True), paths[table], key)
            # by date, clustered by hour: a micro-batch has few rows an hour, and a folder for each would hold little else
            clustered = fact.hint("rebalance", "event_date").sortWithinPartitions("event_date", "event_hour")
            write_batch(clustered, paths["fact_traffic"], name, ("event_date",))
            states = rollup_states.partial_states(fact, spark.read.parquet(paths["dim_road"]))
            write_batch(states, paths["rollup_states"], name, ("event_date",))
            # last: from now on the batch's keys are seen, by other batches only
            stored = clean.withColumn("event_date", F.to_date("event_ts")).hint("rebalance", "event_date")
            write_batch(stored, paths["traffic_silver"], name, ("event_date",))
        finally:
            routed.unpersist()
    finally:
        arrived.unpersist()


def start_router(bronze_stream: DataFrame, root: str, clock: str = "ingestion_ts",
                 trigger: dict | None = None) -> StreamingQuery:
    """The router as one query over a stream of bronze rows."""
    checkpoint = os.path.join(root, "_checkpoints", "router")

    def run(batch: DataFrame, batch_id: int) -> None:
        route_batch(batch, batch_id, root, query_id(batch.sparkSession, checkpoint), clock)

    writer = bronze_stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).queryName("RouterStream")
    return jobs._trigger(writer, trigger).start()


def run_chain_once(spark: SparkSession, messages: DataFrame, root: str, clock: str = "kafka_timestamp",
                   max_files_per_trigger: int | None = None) -> dict[str, str]:
    """Bronze, then everything else from one read of it; both restart from their checkpoints."""
    paths = sink_paths(root)
    jobs.start_bronze(messages, root).awaitTermination()
    bronze_in = B.read_table_stream(spark, paths["traffic_bronze"], jobs.bronze_schema(spark),
                                    max_files_per_trigger=max_files_per_trigger)
    start_router(bronze_in, root, clock).awaitTermination()
    return paths


def closed_hours(hours: DataFrame, newest: Column, delay: str = S.DEDUP_WATERMARK) -> DataFrame:
    """Hours of a rollup whose end lies ``delay`` or more before ``newest``."""
    end = F.col("event_date").cast("timestamp") + F.make_dt_interval(hours=F.col("event_hour") + F.lit(1))
    return hours.where(end <= newest - F.expr(f"INTERVAL {delay}"))
