"""Gold star schema: fact, dimensions, serving and staging views.

Dimensions are the distinct keys seen in silver mapped through fixed label
tables.  ``distinct`` runs as a partial + final aggregate, so building a
dimension from a huge fact moves one row per key per task.  Joins against
dimensions carry no broadcast hint: Spark broadcasts a side whose size
statistics are under ``spark.sql.autoBroadcastJoinThreshold`` (stored dims
are a few KB of Parquet) and AQE re-checks the real size at runtime; any
dimension that outgrows the threshold falls back to a shuffle join instead
of exhausting executor memory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.functions import features as X

FACT_COLUMNS = ["vehicle_id", "road_id", "city_zone", "speed_kmh", "congestion_level",
                "congestion_risk_score", "speed_band", "peak_flag", "is_weekend", "weather",
                "vehicle_type", "sensor_id", "latitude", "longitude", "event_ts",
                "event_date", "event_hour"]
FACT_PARTITIONS = ["event_date", "event_hour"]


def write_fact(fact: DataFrame, path: str, partition_by: Sequence[str] = FACT_PARTITIONS) -> None:
    """Write a whole table partitioned by date and hour.

    ``rebalance`` gathers each (date, hour) in one task, so that a directory gets
    one file instead of one per task; AQE cuts a partition that exceeds
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` into several tasks and joins
    small ones, so the number of tasks follows the bytes and a hot hour is split.
    The overwrite is static: partitions that the new table lacks go.
    """
    (fact.hint("rebalance", *partition_by).write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path))


def fact_traffic(silver: DataFrame) -> DataFrame:
    """Fact projection of silver, with ``event_date`` for partitioning."""
    return silver.select(
        "vehicle_id", "road_id", "city_zone",
        F.col("speed_int").alias("speed_kmh"),
        "congestion_level", "congestion_risk_score", "speed_band", "peak_flag",
        "is_weekend", "weather", "vehicle_type", "sensor_id", "latitude", "longitude",
        "event_ts", F.to_date("event_ts").alias("event_date"), "event_hour",
    )


def dim_zone(silver: DataFrame, with_updated_at: bool = False) -> DataFrame:
    """Zone dimension: type and risk tier per zone seen (P10)."""
    out = silver.select("city_zone").distinct().select(
        "city_zone",
        X.zone_type("city_zone", S.ZONE_TYPE_GOLD).alias("zone_type"),
        X.zone_risk_tier("city_zone").alias("traffic_risk_tier"),
    )
    return out.withColumn("dim_updated_at", F.current_timestamp()) if with_updated_at else out


def dim_road(silver: DataFrame, with_updated_at: bool = False) -> DataFrame:
    """Road dimension: type, speed limit and lanes per road seen."""
    out = silver.select("road_id").distinct().select(
        "road_id",
        X.road_type("road_id").alias("road_type"),
        X.road_speed_limit("road_id").alias("speed_limit_kmh"),
        X.road_lanes("road_id").alias("lane_count"),
    )
    return out.withColumn("dim_updated_at", F.current_timestamp()) if with_updated_at else out


def stg_traffic(silver: DataFrame) -> DataFrame:
    """Typed, renamed staging view over silver; drops rows without vehicle."""
    return silver.where(F.col("vehicle_id").isNotNull()).select(
        F.col("vehicle_id").cast("string").alias("vehicle_id"),
        F.col("road_id").cast("string").alias("road_id"),
        F.col("city_zone").cast("string").alias("city_zone"),
        F.col("speed_int").cast("int").alias("speed_kmh"),
        F.col("congestion_level").cast("int").alias("congestion_level"),
        F.col("congestion_risk_score").cast("int").alias("congestion_risk_score"),
        F.col("speed_band").cast("string").alias("speed_band"),
        F.col("peak_flag").cast("int").alias("is_peak_hour"),
        F.col("is_weekend").cast("int").alias("is_weekend"),
        F.col("weather").cast("string").alias("weather_condition"),
        F.col("vehicle_type").cast("string").alias("vehicle_type"),
        F.col("sensor_id").cast("string").alias("sensor_id"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("event_ts").cast("timestamp").alias("event_timestamp"),
        F.to_date("event_ts").alias("event_date"),
        F.col("event_hour").cast("int").alias("event_hour"),
    )


def dim_zones_mart(stg: DataFrame, with_updated_at: bool = False) -> DataFrame:
    """Mart zone dimension with its own labels."""
    out = stg.select("city_zone").distinct().select(
        "city_zone",
        X.zone_type("city_zone", S.ZONE_TYPE_MART).alias("zone_classification"),
        X.zone_risk_tier("city_zone").alias("traffic_risk_tier"),
    )
    return out.withColumn("dbt_updated_at", F.current_timestamp()) if with_updated_at else out


def dim_roads_mart(stg: DataFrame, with_updated_at: bool = False) -> DataFrame:
    """Mart road dimension: classification, limit, total lanes."""
    out = stg.select("road_id").distinct().select(
        "road_id",
        X.road_type("road_id").alias("road_classification"),
        X.road_speed_limit("road_id").alias("speed_limit_kmh"),
        X.road_lanes("road_id").alias("total_lanes"),
    )
    return out.withColumn("dbt_updated_at", F.current_timestamp()) if with_updated_at else out


# ---------------------------------------------------------------------------
# Serving views (S9-S12): fixed column types and names for BI tools.
# ---------------------------------------------------------------------------
def bi_fact_traffic(fact: DataFrame) -> DataFrame:
    return fact.select(
        F.col("vehicle_id").cast("string").alias("vehicle_id"),
        F.col("road_id").cast("string").alias("road_id"),
        F.col("city_zone").cast("string").alias("city_zone"),
        F.col("speed_kmh").cast("double").alias("speed_kmh"),
        F.col("congestion_level").cast("int").alias("congestion_level"),
        F.col("congestion_risk_score").cast("int").alias("congestion_risk_score"),
        F.col("speed_band").cast("string").alias("speed_band"),
        F.col("peak_flag").cast("int").alias("peak_flag"),
        F.col("is_weekend").cast("int").alias("is_weekend"),
        F.col("weather").cast("string").alias("weather"),
        F.col("vehicle_type").cast("string").alias("vehicle_type"),
        F.col("sensor_id").cast("string").alias("sensor_id"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        F.col("event_ts").cast("timestamp").alias("event_timestamp"),
        F.col("event_date").cast("date").alias("event_date"),
        F.col("event_hour").cast("int").alias("event_hour"),
    )


def bi_dim_zone(dim: DataFrame) -> DataFrame:
    return dim.select(F.col("city_zone").cast("string").alias("city_zone"),
                      F.col("zone_type").cast("string").alias("zone_type"),
                      F.col("traffic_risk_tier").cast("string").alias("traffic_risk_tier"))


def bi_dim_road(dim: DataFrame) -> DataFrame:
    return dim.select(F.col("road_id").cast("string").alias("road_id"),
                      F.col("road_type").cast("string").alias("road_type"),
                      F.col("speed_limit_kmh").cast("int").alias("speed_limit_kmh"),
                      F.col("lane_count").cast("int").alias("lane_count"))


def bi_quarantine_audit(dlq: DataFrame) -> DataFrame:
    return dlq.select("quarantine_reason", "vehicle_id", "road_id", "city_zone",
                      "raw_speed", "raw_event_time", "quarantine_ts")
