"""Silver and valid rows co-bucketed by the dedup key.

Both tables are stored in the same number of buckets by (vehicle_id, event_ts) and sorted within them.
Dedup against history, recovery of late rows and replay then meet bucket by bucket: no exchange
above either scan, however large the history.  Rows are dealt by the buckets' own hash before
the write, so a bucket is one file.

All arrivals of one key are in one bucket.  ``bucketed`` of valid rows therefore keeps the columns that
a recovery needs and no payload, and dedup runs first: one row per key meets the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from urbanpulse.operators.silver import ARRIVAL_ORDER, DEDUP_KEYS, dedup_first

BUCKETS = 16


def store(df: DataFrame, table: str, path: str, buckets: int = BUCKETS, keys: Sequence[str] = tuple(DEDUP_KEYS)) -> DataFrame:
    """Write ``df`` as an external catalog table in buckets; returns the stored table.

    The name may have a database, which must exist.  A table of this name is replaced; the files that
    it had at another path stay.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return spark.table(table)


def late_arrivals(valid: DataFrame, silver: DataFrame) -> DataFrame:
    """Valid rows whose key never reached silver, deduplicated; both are bucketed alike."""
    return dedup_first(valid, DEDUP_KEYS, ARRIVAL_ORDER).join(silver.select(*DEDUP_KEYS), DEDUP_KEYS, "left_anti")


def exchanges(df: DataFrame) -> int:
    """Shuffles in the plan of ``df`` as it would run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line and "ReusedExchange" not in line for line in plan.splitlines())


def prepare(spark: SparkSession) -> None:
    """Read bucketed tables as buckets, whatever AQE thinks of their size."""
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
