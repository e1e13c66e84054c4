"""Structured Streaming jobs: bronze -> silver/quarantine -> gold.

Every job is one ``writeStream`` with its own checkpoint, so each layer
restarts where it stopped (exactly-once file sinks).  The same batch
operators run inside the streams; only the sinks and the stateful parts
(watermark + dedup, windowed rollup) are stream-specific.

Layouts on a cluster: ``root`` and every checkpoint live on the shared file
system; nothing is written to a machine-local folder.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from urbanpulse import schemas as S
from urbanpulse.operators import gold, quality, rollups, silver
from urbanpulse.sources import bronze as B


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


# ---------------------------------------------------------------------------
# Sinks
# ---------------------------------------------------------------------------
def stream_append(df: DataFrame, path: str, checkpoint: str, name: str,
                  partition_by: Sequence[str] | None = None,
                  trigger: dict | None = None) -> StreamingQuery:
    """Append sink with a checkpoint and a query name (S4, S6 for the fact)."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint).queryName(name))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _trigger(writer, trigger).start()


def start_bronze(messages: DataFrame, root: str, ingestion_ts: Column | None = None,
                 trigger: dict | None = None) -> StreamingQuery:
    """Messages -> bronze table."""
    return stream_append(B.bronze(messages, ingestion_ts), os.path.join(root, "traffic_bronze"),
                         os.path.join(root, "_checkpoints", "bronze"), "BronzeIngestionStream",
                         trigger=trigger)


def bronze_schema(spark: SparkSession):
    empty = spark.createDataFrame([], S.MESSAGE_SCHEMA)
    return B.bronze(empty).schema


def start_silver_routes(bronze_stream: DataFrame, root: str, clock: str = "ingestion_ts",
                        delay: str = S.DEDUP_WATERMARK,
                        trigger: dict | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """One bronze stream, two sinks: clean silver and quarantine (T4).

    Both queries evaluate the same rule chain with the same ``clock``
    column (frozen in bronze), so every row is routed to exactly one of
    them.  Silver adds the watermark and the stateful dedup (T1, T2).
    """
    evaluated = quality.evaluate(bronze_stream, clock=clock, processed_at=F.col(clock))
    silver_q = stream_append(silver.silver_stream(evaluated, delay),
                             os.path.join(root, "traffic_silver"),
                             os.path.join(root, "_checkpoints", "silver"), "SilverCleanStream",
                             trigger=trigger)
    dlq_q = stream_append(quality.quarantine(evaluated), os.path.join(root, "traffic_quarantine"),
                          os.path.join(root, "_checkpoints", "quarantine"), "QuarantineDLQStream",
                          trigger=trigger)
    return silver_q, dlq_q


def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table; None where nothing is stored yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def insert_if_absent(batch: DataFrame, path: str, key: str) -> None:
    """Append the rows of ``batch`` whose key is not stored yet; no file without one.

    Stateless: the stored table is the state, so a replayed micro-batch (or
    a lost checkpoint) cannot create duplicates.  The stored dimension is
    tiny; the anti join is broadcast by size.
    """
    existing = _read_or_none(batch.sparkSession, path)
    new = (batch if existing is None else batch.join(existing.select(key), key, "left_anti")).persist()
    try:
        if new.count():  # evaluates the batch once, for the test and the write
            new.coalesce(1).write.mode("append").parquet(path)
    finally:
        new.unpersist()


def start_dimension(silver_stream: DataFrame, path: str, checkpoint: str, name: str,
                    build, key: str, trigger: dict | None = None) -> StreamingQuery:
    """Emit each new dimension key once (T3): per micro-batch, the distinct
    keys of the batch mapped through the label table, inserted if absent."""
    def upsert(batch: DataFrame, _batch_id: int) -> None:
        insert_if_absent(build(batch), path, key)
    writer = (silver_stream.writeStream.foreachBatch(upsert)
              .option("checkpointLocation", checkpoint).queryName(name))
    return _trigger(writer, trigger).start()


def start_gold(silver_stream: DataFrame, root: str, trigger: dict | None = None) -> list[StreamingQuery]:
    """Fact (partitioned by date and hour) and both dimensions.

    ``rebalance`` gathers an hour of a micro-batch before the sink: a folder gets a file for a batch and not one
    from every task, each of which the task reports to the driver.
    """
    ck = os.path.join(root, "_checkpoints")
    return [
        stream_append(gold.fact_traffic(silver_stream).hint("rebalance", *gold.FACT_PARTITIONS), os.path.join(root, "fact_traffic"),
                      os.path.join(ck, "fact"), "GoldFactStream",
                      partition_by=gold.FACT_PARTITIONS, trigger=trigger),
        start_dimension(silver_stream, os.path.join(root, "dim_zone"), os.path.join(ck, "dim_zone"),
                        "DimZoneStream", partial(gold.dim_zone, with_updated_at=True), "city_zone", trigger),
        start_dimension(silver_stream, os.path.join(root, "dim_road"), os.path.join(ck, "dim_road"),
                        "DimRoadStream", partial(gold.dim_road, with_updated_at=True), "road_id", trigger),
    ]


def hourly_rollup_stream(fact_stream: DataFrame, dim_road: DataFrame,
                         delay: str | None = S.DEDUP_WATERMARK) -> DataFrame:
    """A1 as a continuous query (T7): tumbling one-hour event-time windows
    per zone and road, emitted once the watermark passes the window end.

    Hours that the watermark has not passed are open and not in the result yet.
    ``delay`` None keeps the watermark that the input has.
    """
    marked = fact_stream.withWatermark("event_ts", delay) if delay else fact_stream
    hours = (rollups.with_limits(marked, dim_road).groupBy(F.window("event_ts", "1 hour").alias("w"), "city_zone", "road_id")
             .agg(*rollups.hour_measures()))
    return hours.select(*rollups.hour_columns(
        "city_zone", "road_id", F.to_date(F.col("w.start")).alias("event_date"), F.hour(F.col("w.start")).alias("event_hour")),
        F.current_timestamp().alias("computed_at"))


def start_hourly_rollup(fact_stream: DataFrame, dim_road: DataFrame, root: str,
                        delay: str | None = S.DEDUP_WATERMARK, trigger: dict | None = None) -> StreamingQuery:
    return stream_append(hourly_rollup_stream(fact_stream, dim_road, delay),
                         os.path.join(root, "agg_hourly_congestion"),
                         os.path.join(root, "_checkpoints", "rollup"), "HourlyRollupStream",
                         trigger=trigger)


# ---------------------------------------------------------------------------
# Chain and catalog
# ---------------------------------------------------------------------------
def table_paths(root: str) -> dict[str, str]:
    return {name: os.path.join(root, name) for name in
            ("traffic_bronze", "traffic_silver", "traffic_quarantine", "fact_traffic",
             "dim_zone", "dim_road", "agg_hourly_congestion")}


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state (dedup keys, open windows) in RocksDB on local
    disk with checkpointed changelogs instead of the JVM heap.  Must be set
    before a query's first run (the provider is recorded in its checkpoint)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def run_to_end(query: StreamingQuery) -> None:
    """Let a query take in all that its source has now, however many admissions that takes, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def run_chain(spark: SparkSession, messages: DataFrame, root: str, clock: str = "kafka_timestamp",
              delay: str = S.DEDUP_WATERMARK, max_files_per_trigger: int = 1,
              rollup: bool = False, rocksdb_state: bool = True, limited_source: bool = False) -> dict[str, str]:
    """Bronze -> silver/quarantine -> gold, each layer an ``availableNow``
    query over the previous layer's table (T5).  Rerunning with the same
    ``root`` resumes every layer from its checkpoint: only new input is read.
    ``limited_source``: ``messages`` admits a part per trigger (``sources.message_log``).
    """
    if rocksdb_state:
        use_rocksdb_state(spark)
    paths = table_paths(root)
    if limited_source:
        run_to_end(start_bronze(messages, root, trigger={"processingTime": "0 seconds"}))
    else:
        start_bronze(messages, root).awaitTermination()
    bronze_in = B.read_table_stream(spark, paths["traffic_bronze"], bronze_schema(spark),
                                    max_files_per_trigger=max_files_per_trigger)
    for q in start_silver_routes(bronze_in, root, clock=clock, delay=delay):
        q.awaitTermination()
    silver_schema = spark.read.parquet(paths["traffic_silver"]).schema
    silver_in = B.read_table_stream(spark, paths["traffic_silver"], silver_schema,
                                    max_files_per_trigger=max_files_per_trigger)
    for q in start_gold(silver_in, root):
        q.awaitTermination()
    if rollup:
        # The rollup reads bronze with the same file cap and runs the clean rows and the
        # dedup itself (stateful operators in a chain share one watermark): its
        # micro-batches are bounded, and none splits a batch that silver read whole, which
        # would move the watermark early and drop on-time rows.
        bronze_again = B.read_table_stream(spark, paths["traffic_bronze"], bronze_schema(spark),
                                           max_files_per_trigger=max_files_per_trigger)
        clean = silver.silver_stream(quality.evaluate(bronze_again, clock=clock, processed_at=F.col(clock)), delay)
        start_hourly_rollup(gold.fact_traffic(clean), spark.read.parquet(paths["dim_road"]),
                            root, delay=None).awaitTermination()
    return paths


def register_tables(spark: SparkSession, paths: dict[str, str], database: str | None = None) -> list[str]:
    """Name every stored table (S14): temp views, or tables of a catalog database.

    Tables are external (``USING parquet LOCATION``): dropping or replacing a name
    leaves the files.  Partitions of partitioned tables are recovered from the folders.
    """
    names = []
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, path in paths.items():
        df = _read_or_none(spark, path)
        if df is None:
            continue
        if not database:
            df.createOrReplaceTempView(name)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
            spark.catalog.createTable(f"{database}.{name}", path=path, source="parquet")
            if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{name}")):
                spark.catalog.recoverPartitions(f"{database}.{name}")
        names.append(name)
    return names
