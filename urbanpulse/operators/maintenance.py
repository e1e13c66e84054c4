"""Table maintenance as Spark jobs on Parquet tables (V1-V6).

There is no transaction log here: a versioned table is an append-only
Parquet table whose loads are tagged by the sink that writes them
(``append_load``: ``commit_id``, ``committed_at``, ``operation``).  History, time
travel, restore and retention are row operations on those columns.  They give no
concurrent-writer isolation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_BYTES = 128 << 20
#: Bytes of rows, before the shuffle compresses them, that one task of a rewrite takes.
TASK_BYTES = 256 << 20


# ---------------------------------------------------------------------------
# V1 compaction, V2 Z-order clustering
# ---------------------------------------------------------------------------
def file_count(stored: DataFrame, target_bytes: int = TARGET_BYTES) -> int:
    """Files of about ``target_bytes`` for a stored table, from the size of its files."""
    size = int(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, math.ceil(size / target_bytes))


def row_bytes(stored: DataFrame) -> int:
    """Bytes of a table's rows outside its files: a word per column, and the lengths of text, binary and nested values.

    One aggregate over the columns of varying length; a file may hold many times its size in rows.
    """
    varying = []
    for f in stored.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            varying.append(F.octet_length(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            varying.append(F.octet_length(F.col(f.name).cast("string")))
    rows, *lengths = stored.agg(F.count(F.lit(1)), *(F.sum(c) for c in varying)).first()
    return rows * 8 * (len(stored.columns) + 1) + sum(n or 0 for n in lengths)


def task_count(stored: DataFrame, target_bytes: int = TARGET_BYTES) -> int:
    """Tasks, one file each, of a rewrite: as many as there are files to be, or more where the rows of a file exceed ``TASK_BYTES``."""
    return max(file_count(stored, target_bytes), math.ceil(row_bytes(stored) / TASK_BYTES))


def _tie(df: DataFrame) -> Column:
    """A number that spreads rows with equal keys: range partitioning alone keeps them together."""
    return F.xxhash64(*df.columns)


def _overwrite(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def compact(stored: DataFrame, path: str, partition_by: Sequence[str] | None = None,
            sort_by: Sequence[str] | None = None, target_bytes: int = TARGET_BYTES) -> None:
    """Rewrite a stored table into files of about ``target_bytes``, or of ``TASK_BYTES`` of rows where that is less (V1).

    Without ``partition_by`` the rows are range partitioned by ``sort_by`` and a tie
    break, so a hot key is cut into as many files as it fills.  With it, AQE's
    rebalance sizes the tasks.
    """
    if partition_by:
        out = stored.hint("rebalance", *partition_by)
        if sort_by:
            out = out.sortWithinPartitions(*partition_by, *sort_by)
        return _overwrite(out, path, partition_by)
    n = task_count(stored, target_bytes)
    if not sort_by:
        return _overwrite(stored.repartition(n), path)
    _overwrite(stored.repartitionByRange(n, *sort_by, _tie(stored)).sortWithinPartitions(*sort_by), path)


#: Values of a column that its bounds are taken from, per bucket.
SAMPLED_PER_BUCKET = 16
_HASH_SPACE = 1 << 40


def z_bucket_bounds(df: DataFrame, columns: Sequence[str], bits: int = 8) -> dict[str, list]:
    """Bounds that divide the distinct values of each Z column into at most 2**bits buckets.

    The values keep their own type and order (text is compared whole, in any
    script).  Two aggregates over all columns at once, neither of which shuffles
    values: the number of distinct values (HyperLogLog), and those of them whose hash is low
    enough that about ``SAMPLED_PER_BUCKET`` a bucket are kept.  That is a uniform sample of the
    distinct values, whatever their frequencies, and all of them where there are few;
    its quantiles are the bounds.  The result has a fixed size whatever the table size.
    """
    buckets = 2 ** bits
    wanted = buckets * SAMPLED_PER_BUCKET
    many = df.agg(*(F.approx_count_distinct(c) for c in columns)).first()
    low = [_HASH_SPACE if n <= wanted else max(1, _HASH_SPACE * wanted // n) for n in many]
    kept = df.agg(*(F.array_sort(F.collect_set(F.when(F.pmod(F.xxhash64(c), F.lit(_HASH_SPACE)) < F.lit(limit), F.col(c))))
                    for c, limit in zip(columns, low, strict=True))).first()
    bounds = {}
    for c, values in zip(columns, kept, strict=True):
        n = min(buckets, len(values))
        bounds[c] = [values[k * len(values) // n] for k in range(n)]
    return bounds


def _bucket(key: Column, bounds: list) -> Column:
    """Number of bounds at or below ``key`` by a balanced CASE: as many comparisons as bits.

    NULL has bucket 0.
    """
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key >= F.lit(bounds[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(bounds)).cast("long")


def z_value(columns: Sequence[str], bounds: dict[str, list], bits: int = 8) -> Column:
    """Bit-interleaved bucket ids of the columns (a Morton / Z-order key)."""
    buckets = [_bucket(F.col(c), bounds[c]) for c in columns]
    z = F.lit(0).cast("long")
    for b in range(bits + 1):
        for j, bucket in enumerate(buckets):
            bit = F.shiftright(bucket, b).bitwiseAND(F.lit(1))
            z = z.bitwiseOR(F.shiftleft(bit, b * len(buckets) + j))
    return z


def zorder_rewrite(stored: DataFrame, path: str, columns: Sequence[str], bits: int = 8,
                   target_bytes: int = TARGET_BYTES) -> None:
    """Cluster a stored table by the Z-order of ``columns`` and write it (V2).

    Rows close in every Z column land in the same files, so min/max file
    statistics skip files for a predicate on any one of them.  Within a Z value the
    columns themselves and a tie break go on dividing, so few distinct values or a
    hot one still use as many tasks as there are files (``task_count``).
    """
    bounds = z_bucket_bounds(stored, columns, bits)
    rows = stored.withColumn("_z", z_value(columns, bounds, bits))
    order = ["_z", *columns]
    _overwrite(rows.repartitionByRange(task_count(stored, target_bytes), *order, _tie(stored))
               .sortWithinPartitions(*order).drop("_z"), path)


# ---------------------------------------------------------------------------
# V3-V6 versioned rows
# ---------------------------------------------------------------------------
def with_commit(df: DataFrame, commit_id: Column, committed_at: Column,
                operation: str = "WRITE") -> DataFrame:
    """Tag rows with their commit (what a versioned sink adds)."""
    return df.withColumns({"commit_id": commit_id.cast("long"),
                           "committed_at": committed_at,
                           "operation": F.lit(operation)})


def append_load(df: DataFrame, path: str, commit_id: int, committed_at: Column,
                operation: str = "WRITE") -> None:
    """Append one load to a versioned table; the sink tags its rows."""
    with_commit(df, F.lit(commit_id), committed_at, operation).write.mode("append").parquet(path)


def commit_history(versioned: DataFrame, limit: int | None = 10) -> DataFrame:
    """Newest commits first: id, time, operation, rows (V3)."""
    hist = (versioned.groupBy("commit_id", "committed_at", "operation")
            .agg(F.count(F.lit(1)).alias("num_output_rows"))
            .orderBy(F.col("commit_id").desc()))
    return hist.limit(limit) if limit else hist


def as_of(versioned: DataFrame, version: int | None = None, timestamp: Column | str | None = None,
          keys: Sequence[str] | None = None,
          order: Sequence[str] | None = None) -> DataFrame:
    """The table as of a commit id or a commit time (V4).

    For a table whose rows are updated (several versions per key), ``keys``
    returns the latest version of each key by ``order`` (by default the commit,
    then all other columns, so that no ties are left): a partial-aggregated
    ``max_by``, so a key with very many versions never lands whole in one task.
    """
    rows = versioned
    if version is not None:
        rows = rows.where(F.col("commit_id") <= F.lit(version))
    if timestamp is not None:
        ts = F.lit(timestamp).cast("timestamp") if isinstance(timestamp, str) else timestamp
        rows = rows.where(F.col("committed_at") <= ts)
    if not keys:
        return rows
    rest = [c for c in rows.columns if c not in keys]
    order = list(order) if order else ["commit_id", *(c for c in rest if c != "commit_id")]
    latest = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return latest.select(*keys, *[F.col("_r").getField(c).alias(c) for c in rest]).select(*rows.columns)


def restore_as_of(versioned: DataFrame, path: str, version: int, new_commit_id: int,
                  committed_at: Column, keys: Sequence[str] | None = None,
                  order: Sequence[str] | None = None) -> None:
    """Make an old state current again: write it as a new load (V5)."""
    old = as_of(versioned, version=version, keys=keys, order=order)
    _overwrite(with_commit(old.drop("commit_id", "committed_at", "operation"), F.lit(new_commit_id),
                           committed_at, "RESTORE"), path)


def expire(versioned: DataFrame, keys: Sequence[str], retention_hours: int = 168,
           now=None) -> DataFrame:
    """Drop superseded row versions committed more than ``retention_hours``
    before ``now``, keep the current version of every key (V6).

    ``now`` defaults to the newest commit time of the table (one small
    aggregate job returning a single timestamp).  Recent rows stay without a join.
    Old rows are matched on (key, commit) against the latest commit per key: a key
    with very many versions is spread over its commits.
    """
    if now is None:
        now = versioned.agg(F.max("committed_at")).first()[0]
    now_col = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    recent = F.col("committed_at") >= now_col - F.expr(f"INTERVAL {int(retention_hours)} HOURS")
    latest = versioned.groupBy(*keys).agg(F.max("commit_id").alias("commit_id"))
    old = versioned.where(~recent).join(latest, [*keys, "commit_id"], "left_semi")
    return versioned.where(recent).unionByName(old.select(*versioned.columns))
