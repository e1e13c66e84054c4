"""A file-skipping index for stored tables: value bounds and Bloom bits per file.

Two small tables describe the files of a table.  ``bounds`` has a row per file with the least
and greatest value of each indexed column.  ``blooms`` has, per file and column, the
bits of a blocked Bloom filter: a value sets ``PROBES`` bits in one block of 32,768.  Both are
one scan of the indexed columns; a file's rows are combined before the shuffle, so it
carries a row, or a block of 4 KB, per file and not per value.

A lookup compares the predicate with the bounds, tests the one block that a value falls
in, and reads the files that are left.  Bounds and bits never lie about what is in a
file, so no row is missed; a file that is read in vain costs time only.  NULL matches no
predicate.  When more than ``MAX_FILES`` files or ``MAX_SHARE`` of them are left, the whole table is
read with the same predicate: the list of files that reaches the driver is bounded.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BITS = 32_768
PROBES = 4
#: About ten bits per different value: false positives of 1 to 2 %.
BITS_PER_VALUE = 10
MAX_FILES = 10_000
MAX_SHARE = 0.5


class Predicate(NamedTuple):
    """``column op value``; op is one of = in < <= > >= between (``in``: a list, ``between``: two bounds, both in)."""

    column: str
    op: str
    value: Any

    def on(self, col: Column) -> Column:
        low, high = self.value if self.op == "between" else (None, None)
        return {"=": lambda: col == F.lit(self.value), "in": lambda: col.isin(*self.value),
                "<": lambda: col < F.lit(self.value), "<=": lambda: col <= F.lit(self.value),
                ">": lambda: col > F.lit(self.value), ">=": lambda: col >= F.lit(self.value),
                "between": lambda: col.between(F.lit(low), F.lit(high))}[self.op]()

    def within(self, lo: Column, hi: Column) -> Column:
        """Whether bounds leave room for a match."""
        def holds(v: Any) -> Column:
            return (lo <= F.lit(v)) & (hi >= F.lit(v))

        low, high = self.value if self.op == "between" else (None, None)
        return {"=": lambda: holds(self.value), "in": lambda: reduce(Column.__or__, [holds(v) for v in self.value], F.lit(False)),
                "<": lambda: lo < F.lit(self.value), "<=": lambda: lo <= F.lit(self.value),
                ">": lambda: hi > F.lit(self.value), ">=": lambda: hi >= F.lit(self.value),
                "between": lambda: (lo <= F.lit(high)) & (hi >= F.lit(low))}[self.op]()

    @property
    def points(self) -> list[Any] | None:
        """The values that an equality asks for; None where the predicate is a range."""
        return [self.value] if self.op == "=" else list(self.value) if self.op == "in" else None


def _block(value: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(blocks)).cast("int")


def _bits(value: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(value, F.lit(k)), F.lit(BLOCK_BITS)).cast("int") for k in range(PROBES)]


def blocks_for(values_per_file: int) -> int:
    """Blocks that keep the filters of files with so many different values selective."""
    return max(1, -(-values_per_file * BITS_PER_VALUE // BLOCK_BITS))


def file_bounds(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per file: file, bytes, rows, ``lo_<c>``, ``hi_<c>``.  ``stored`` is a scan of files."""
    return stored.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_bytes")).groupBy(
        F.col("_file").alias("file"), F.col("_bytes").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), *(f(c).alias(f"{side}_{c}") for c in columns for side, f in (("lo", F.min), ("hi", F.max))))


def file_blooms(stored: DataFrame, columns: Sequence[str], blocks: int) -> DataFrame:
    """One row per file, column and block that has a value: the block's bits."""
    probes = F.explode(F.flatten(F.array(*(
        F.when(F.col(c).isNotNull(), F.array(*(
            F.struct(F.lit(c).alias("column"), _block(F.col(c), blocks).alias("block"), b.alias("bit")) for b in _bits(F.col(c)))))
        .otherwise(F.array()) for c in columns))))
    return stored.select(F.col("_metadata.file_path").alias("file"), probes.alias("p")).groupBy(
        "file", "p.column", "p.block").agg(F.bitmap_construct_agg(F.col("p.bit").cast("long")).alias("bits"))


def write_index(stored: DataFrame, path: str, columns: Sequence[str], bloom_columns: Sequence[str] = (),
                values_per_file: int = 1_000_000) -> None:
    """Store the index of a table under ``path``: bounds of ``columns``, Bloom bits of ``bloom_columns``."""
    blocks = blocks_for(values_per_file)
    file_bounds(stored, columns).write.mode("overwrite").parquet(os.path.join(path, "bounds"))
    if bloom_columns:
        (file_blooms(stored, bloom_columns, blocks).withColumn("blocks", F.lit(blocks))
         .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("column")
         .parquet(os.path.join(path, "blooms")))


def _block_may_hold(value: Column, blocks: Column) -> Column:
    """Whether a stored block is the value's block and has all its bits."""
    def bit(at: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1

    own = F.pmod(F.xxhash64(value), blocks).cast("int") == F.col("block")
    return reduce(Column.__and__, [bit(b) for b in _bits(value)], own)


def candidates(spark: SparkSession, path: str, predicates: Sequence[Predicate]) -> DataFrame:
    """The rows of ``bounds`` whose files may hold a match of all predicates."""
    bounds = spark.read.parquet(os.path.join(path, "bounds"))
    indexed = {c.removeprefix("lo_") for c in bounds.columns if c.startswith("lo_")}
    left = bounds
    for p in predicates:
        if p.column in indexed:
            left = left.where(p.within(F.col(f"lo_{p.column}"), F.col(f"hi_{p.column}")))
    stored = os.path.join(path, "blooms")
    points = [p for p in predicates if p.points is not None]
    if not points or not _exists(spark, stored):
        return left
    blooms = spark.read.schema("file string, block int, bits binary, blocks int, column string").parquet(stored)
    columns = {r[0] for r in blooms.select("column").distinct().collect()}  # one per indexed column
    for p in points:
        if p.column not in columns:
            continue
        kind = bounds.schema[f"lo_{p.column}"].dataType if p.column in indexed else None
        values = [F.lit(v) if kind is None else F.lit(v).cast(kind) for v in p.points]
        may = reduce(Column.__or__, [_block_may_hold(v, F.col("blocks")) for v in values], F.lit(False))
        hits = blooms.where(F.col("column") == p.column).where(may).select("file").distinct()
        left = left.join(hits, "file", "left_semi")
    return left


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


class Lookup(NamedTuple):
    """``rows``; ``opened`` files out of ``files`` were read (all of them where the index left too many)."""

    rows: DataFrame
    opened: int
    files: int


def lookup(stored: DataFrame, table_path: str, index_path: str, predicates: Sequence[Predicate],
           max_files: int = MAX_FILES, max_share: float = MAX_SHARE) -> Lookup:
    """Rows of the table that match all predicates, reading only files that may hold one."""
    spark = stored.sparkSession
    files = spark.read.parquet(os.path.join(index_path, "bounds")).count()
    left = [r[0] for r in candidates(spark, index_path, predicates).select("file").limit(max_files + 1).collect()]
    match = reduce(Column.__and__, [p.on(F.col(p.column)) for p in predicates], F.lit(True))
    if len(left) > max_files or len(left) > max_share * files:
        return Lookup(stored.where(match), files, files)
    if not left:
        return Lookup(stored.limit(0), 0, files)
    some = spark.read.schema(stored.schema).option("basePath", table_path).parquet(*left)
    return Lookup(some.select(*stored.columns).where(match), len(left), files)
