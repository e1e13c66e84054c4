"""Hourly rollups.

Both rollups are one join against a road dimension followed by one grouped
aggregate.  The aggregate runs partial (map side) then final, so the shuffle
carries one row per group per task, whatever the skew of the raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanpulse.functions.columns import count_if, pct, round_half_up
from urbanpulse.functions.features import is_speeding

A1_KEYS = ["city_zone", "road_id", "event_date", "event_hour"]
A2_KEYS = ["event_date", "event_hour", "city_zone", "road_id", "road_classification",
           "is_peak_hour", "is_weekend"]


def with_limits(fact: DataFrame, dim_road: DataFrame) -> DataFrame:
    """Fact rows with the speed limit of their road (J1); without a known road it is NULL."""
    return fact.join(dim_road.select("road_id", "speed_limit_kmh"), "road_id", "left")


def hour_measures() -> list[Column]:
    """The aggregates of the hourly rollup over ``with_limits`` rows, for batch and stream alike."""
    speed, level = F.col("speed_kmh"), F.col("congestion_level")
    return [F.count("vehicle_id").alias("total_vehicle_flow"),
            F.avg(speed).alias("avg_speed_kmh"), F.min(speed).alias("min_speed_kmh"), F.max(speed).alias("max_speed_kmh"),
            F.avg(level).alias("avg_congestion_level"), count_if(level >= 4).alias("high_congestion_event_count"),
            count_if(speed > F.col("speed_limit_kmh")).alias("speed_violation_count")]


def hour_columns(*keys: str | Column) -> list[str | Column]:
    """Keys and rounded columns of the hourly rollup over ``hour_measures``."""
    return [*keys, "total_vehicle_flow", round_half_up("avg_speed_kmh", 2).alias("avg_speed_kmh"),
            "min_speed_kmh", "max_speed_kmh", round_half_up("avg_congestion_level", 2).alias("avg_congestion_level"),
            "high_congestion_event_count", "speed_violation_count",
            round_half_up(pct("high_congestion_event_count", "total_vehicle_flow"), 1).alias("high_congestion_pct")]


def agg_hourly_congestion(fact: DataFrame, dim_road: DataFrame,
                          with_computed_at: bool = False) -> DataFrame:
    """Hourly congestion rollup by zone, road, date, hour."""
    grouped = with_limits(fact, dim_road).groupBy(*A1_KEYS).agg(*hour_measures())
    out = grouped.select(*hour_columns(*A1_KEYS))
    return out.withColumn("computed_at", F.current_timestamp()) if with_computed_at else out


def fct_hourly_traffic_kpis(stg: DataFrame, dim_roads: DataFrame,
                            with_aggregated_at: bool = False) -> DataFrame:
    """Mart rollup over staging with 7 keys and a violation rate."""
    joined = stg.join(dim_roads.select("road_id", "road_classification", "speed_limit_kmh"),
                      "road_id", "left")
    joined = joined.withColumn("is_speeding", is_speeding("speed_kmh", "speed_limit_kmh"))
    out = (joined.groupBy(*A2_KEYS)
           .agg(F.count("vehicle_id").alias("total_vehicle_volume"),
                round_half_up(F.avg("speed_kmh"), 2).alias("avg_speed_kmh"),
                F.min("speed_kmh").alias("min_speed_kmh"),
                F.max("speed_kmh").alias("max_speed_kmh"),
                round_half_up(F.avg("congestion_level"), 2).alias("avg_congestion_level"),
                count_if(F.col("congestion_level") >= 4).alias("gridlock_observations"),
                F.sum("is_speeding").cast("bigint").alias("speeding_violation_count"))
           .withColumn("speeding_violation_rate_pct",
                       round_half_up(pct("speeding_violation_count", "total_vehicle_volume"), 2)))
    return out.withColumn("aggregated_at", F.current_timestamp()) if with_aggregated_at else out


def write_rollup(rollup: DataFrame, path: str, partition_by: list[str] | None = None,
                 only_touched: bool = False) -> None:
    """Overwrite a rollup table; its schema may change.

    A full rewrite (the default) replaces the whole table.  With ``only_touched``
    a partitioned rewrite replaces just the partitions present in ``rollup``.
    Partitions written before a column was added lack it: ``read_rollup`` merges
    the schemas, and the column is NULL there.
    """
    mode = "dynamic" if only_touched else "static"
    writer = rollup.write.mode("overwrite").option("partitionOverwriteMode", mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """A rollup table with the columns of all its partitions."""
    return spark.read.option("mergeSchema", "true").parquet(path)
