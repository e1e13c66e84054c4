"""Silver: clean rows, deduplication, enrichment, late-row recovery.

Deduplication keeps, per (vehicle_id, event_ts), the message that arrived first:
the smallest (arrival time, topic, partition, offset).  Offsets alone do not do,
they are numbered per partition.  It is written as ``row_number() = 1``: Spark
puts a group limit below the shuffle, so each input task sends one row per key
and a key that holds a third of all rows never crosses the network as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.functions import features as X

DEDUP_KEYS = ["vehicle_id", "event_ts"]
ARRIVAL_ORDER = ["kafka_timestamp", "kafka_topic", "kafka_partition", "kafka_offset"]


def valid_rows(evaluated: DataFrame) -> DataFrame:
    return evaluated.where(F.col("dq_status") == S.STATUS_VALID)


def dedup_first(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS,
                order: Sequence[str] = ARRIVAL_ORDER) -> DataFrame:
    """One row per key: the first in ``order`` (T2, batch)."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def enrich(df: DataFrame) -> DataFrame:
    """Add hour, weekend, peak, speed band and risk score."""
    return (df.withColumn("event_hour", X.event_hour("event_ts"))
            .withColumns({
                "is_weekend": X.is_weekend("event_ts"),
                "peak_flag": X.peak_flag("event_hour"),
                "speed_band": X.speed_band("speed_int"),
                "congestion_risk_score": X.congestion_risk_score("congestion_level"),
            }))


def silver_clean(evaluated: DataFrame) -> DataFrame:
    """Batch silver: VALID rows, deduplicated, enriched (Q9)."""
    return enrich(dedup_first(valid_rows(evaluated)))


def silver_stream(evaluated: DataFrame, delay: str = S.DEDUP_WATERMARK) -> DataFrame:
    """Streaming silver: event-time watermark + stateful dedup.

    The event time is part of the dedup key, so state for a key is dropped
    once the watermark passes it; rows behind the watermark are dropped by
    Spark and counted in ``numRowsDroppedByWatermark`` (see ``late_arrivals``).
    """
    return enrich(valid_rows(evaluated).withWatermark("event_ts", delay)
                  .dropDuplicates(DEDUP_KEYS))


def late_arrivals(valid: DataFrame, silver: DataFrame,
                  keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """VALID rows whose key never reached silver, deduplicated.

    ``silver`` is a stored table that a stream has written.  Deduplicating first
    leaves at most one row per key on the left, so a hot key cannot skew the
    anti join that follows.
    """
    return dedup_first(valid, keys).join(silver.select(*keys), list(keys), "left_anti")
