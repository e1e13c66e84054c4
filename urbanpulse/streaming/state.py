"""What streaming state holds, read from the checkpoints.

The state data source shows the keys that a stateful operator still holds as of its last committed
batch.  ``state_report`` tells per operator how many there are, the oldest and newest event time among
them, and how evenly they lie in the state partitions (``skew``: the fullest against the mean).  One
aggregate by partition, then one over the partitions; nothing but the report leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def operators(spark: SparkSession, checkpoint: str) -> list[tuple[int, str, int]]:
    """(operator id, name, state partitions) of a query's stateful operators."""
    found = spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorName", "numPartitions").distinct()
    return sorted((r[0], r[1], r[2]) for r in found.collect())  # a handful per query


def state_keys(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """(partition_id, key...) of what an operator holds."""
    return spark.read.format("statestore").option("operatorId", str(operator)).load(checkpoint).select("partition_id", "key.*")


def state_report(keys: DataFrame, event_time: Column, store: str, partitions: int) -> DataFrame:
    """One row: store, keys, oldest_event, newest_event, partitions, fullest, skew.

    ``skew`` is 1 where every state partition holds as many keys; NULL without a key.
    """
    by_part = keys.groupBy("partition_id").agg(F.count(F.lit(1)).alias("n"), F.min(event_time).alias("lo"), F.max(event_time).alias("hi"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return by_part.agg(
        total.alias("keys"), F.min("lo").alias("oldest_event"), F.max("hi").alias("newest_event"),
        F.coalesce(F.max("n"), F.lit(0)).alias("fullest")).select(
        F.lit(store).alias("store"), "keys", "oldest_event", "newest_event", F.lit(partitions).alias("partitions"), "fullest",
        F.try_divide(F.col("fullest") * F.lit(partitions), F.col("keys")).alias("skew"))


def dedup_report(spark: SparkSession, checkpoint: str) -> DataFrame:
    """State of the built-in dedup of silver."""
    number, _, parts = next(o for o in operators(spark, checkpoint) if o[1] == "dedupe")
    return state_report(state_keys(spark, checkpoint, number), F.col("event_ts"), "silver_dedup", parts)


def rollup_report(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Open hours of the windowed rollup, by the start of the hour."""
    number, _, parts = next(o for o in operators(spark, checkpoint) if o[1] == "stateStoreSave")
    keys = state_keys(spark, checkpoint, number)
    window = next(f.name for f in keys.schema.fields if f.dataType.typeName() == "struct")
    return state_report(keys, F.col(f"`{window}`.start"), "rollup_hours", parts)
