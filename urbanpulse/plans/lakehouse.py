"""The medallion layers over a directory of input tables, as lazy DataFrames.

``Lakehouse(spark, sf_dir)`` derives every layer from ``events.parquet``:
messages -> bronze -> evaluated (typed + dq_status) -> silver / quarantine
-> fact, dimensions, staging.  Nothing runs until an action; Catalyst sees
each report as one plan from the Parquet scan to the result, so column
pruning and filter pushdown reach the scan.

``materialize(out_dir)`` writes bronze, silver, quarantine, fact (partitioned
by date and hour) and the dimensions as Parquet tables and returns a
Lakehouse that reads them back: reports then start from stored tables (the
normal serving path), dimensions carry file statistics (so joins against
them are broadcast by size), and the lineage is cut at each table.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanpulse.operators import gold, quality, rollups, silver
from urbanpulse.plans.fixture import telemetry_messages
from urbanpulse.session import configure
from urbanpulse.sources import bronze as B


class Lakehouse:
    """Lazy layers of the telemetry lakehouse.

    ``clock`` decides the freshness rules and ``processed_at`` stamps the
    quarantine; both default to the message arrival time so that reruns of a
    report are deterministic (a live stream passes ``current_timestamp()``).
    """

    def __init__(self, spark: SparkSession, sf_dir: str, clock: str = "kafka_timestamp",
                 processed_at: Column | None = None, tables: dict[str, str] | None = None,
                 input_partitions: int | None = None):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.clock = clock
        self._processed_at = processed_at
        self._tables = tables or {}
        self.input_partitions = input_partitions

    # -- inputs ------------------------------------------------------------
    def table(self, name: str) -> DataFrame:
        """One of the given tables."""
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    def _stored(self, name: str) -> DataFrame | None:
        path = self._tables.get(name)
        return self.spark.read.parquet(path) if path else None

    @cached_property
    def messages(self) -> DataFrame:
        events = self.table("events")
        # asked for by the caller where the input is one row group, which Spark cannot split
        if self.input_partitions:
            events = events.repartition(self.input_partitions)
        return telemetry_messages(events)

    @cached_property
    def bronze(self) -> DataFrame:
        stored = self._stored("bronze")
        if stored is not None:
            return stored
        return B.bronze(self.messages, ingestion_ts=F.current_timestamp())

    @cached_property
    def evaluated(self) -> DataFrame:
        processed_at = self._processed_at if self._processed_at is not None else F.col(self.clock)
        return quality.evaluate(self.bronze, clock=self.clock, processed_at=processed_at)

    # -- silver / quarantine ----------------------------------------------------
    @cached_property
    def valid(self) -> DataFrame:
        return silver.valid_rows(self.evaluated)

    @cached_property
    def silver(self) -> DataFrame:
        stored = self._stored("silver")
        return stored if stored is not None else silver.silver_clean(self.evaluated)

    @cached_property
    def quarantine(self) -> DataFrame:
        stored = self._stored("quarantine")
        return stored if stored is not None else quality.quarantine(self.evaluated)

    # -- gold -------------------------------------------------------------------
    @cached_property
    def fact(self) -> DataFrame:
        stored = self._stored("fact_traffic")
        return stored if stored is not None else gold.fact_traffic(self.silver)

    @cached_property
    def dim_zone(self) -> DataFrame:
        stored = self._stored("dim_zone")
        return stored.drop("dim_updated_at") if stored is not None else gold.dim_zone(self.silver)

    @cached_property
    def dim_road(self) -> DataFrame:
        stored = self._stored("dim_road")
        return stored.drop("dim_updated_at") if stored is not None else gold.dim_road(self.silver)

    @cached_property
    def stg(self) -> DataFrame:
        return gold.stg_traffic(self.silver)

    @cached_property
    def dim_zones_mart(self) -> DataFrame:
        stored = self._stored("dim_zones_mart")
        return stored.drop("dbt_updated_at") if stored is not None else gold.dim_zones_mart(self.stg)

    @cached_property
    def dim_roads_mart(self) -> DataFrame:
        stored = self._stored("dim_roads_mart")
        return stored.drop("dbt_updated_at") if stored is not None else gold.dim_roads_mart(self.stg)

    # -- materialization ----------------------------------------------------------
    def materialize(self, out_dir: str) -> "Lakehouse":
        """Write the layers as Parquet tables under ``out_dir`` and return a Lakehouse over them.

        The fact is partitioned by event_date and event_hour, the mart rollup by
        event_date; dimensions and rollups carry the time they were made.  Every table
        is replaced as a whole.
        """
        paths = {name: os.path.join(out_dir, name) for name in
                 ("bronze", "silver", "quarantine", "fact_traffic", "dim_zone", "dim_road",
                  "dim_zones_mart", "dim_roads_mart", "fct_hourly_traffic_kpis", "agg_hourly_congestion")}

        def over(*names: str) -> Lakehouse:
            return Lakehouse(self.spark, self.sf_dir, self.clock, self._processed_at,
                             {n: paths[n] for n in names}, self.input_partitions)

        def write(df: DataFrame, name: str) -> None:
            (df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(paths[name]))

        write(self.bronze, "bronze")
        stored = over("bronze")
        write(stored.silver, "silver")
        write(stored.quarantine, "quarantine")
        stored = over("bronze", "silver")
        gold.write_fact(stored.fact, paths["fact_traffic"])
        # one pass over silver for all dimensions: the pairs that occur, and which of them staging keeps
        pairs = os.path.join(out_dir, "_dimension_keys")
        (stored.silver.groupBy("city_zone", "road_id").agg(F.max(F.col("vehicle_id").isNotNull()).alias("staged"))
         .write.mode("overwrite").parquet(pairs))
        keys = self.spark.read.parquet(pairs)
        staged = keys.where("staged")
        write(gold.dim_zone(keys, with_updated_at=True).coalesce(1), "dim_zone")
        write(gold.dim_road(keys, with_updated_at=True).coalesce(1), "dim_road")
        write(gold.dim_zones_mart(staged, with_updated_at=True).coalesce(1), "dim_zones_mart")
        write(gold.dim_roads_mart(staged, with_updated_at=True).coalesce(1), "dim_roads_mart")
        stored = over("bronze", "silver", "fact_traffic", "dim_zone", "dim_road", "dim_zones_mart", "dim_roads_mart")
        rollups.write_rollup(rollups.fct_hourly_traffic_kpis(stored.stg, stored.dim_roads_mart, True),
                             paths["fct_hourly_traffic_kpis"], ["event_date"])
        rollups.write_rollup(rollups.agg_hourly_congestion(stored.fact, stored.dim_road, True),
                             paths["agg_hourly_congestion"], ["event_date"])
        return over(*paths)
