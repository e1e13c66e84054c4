"""Bin-packing compaction: only undersized files are rewritten (V1).

Files below ``small`` bytes are packed, folder by folder, into bins of about ``target``
bytes by first fit decreasing; each bin becomes one file.  A bin of a single file
stays as it is, as do all other files: their names, times and bytes are untouched.

A folder with very many small files is packed in groups of ``GROUP_FILES`` (one underfilled bin
per group at most), and a run rewrites at most ``MAX_FILES`` files per job, so neither a task nor the
driver holds a list that grows with the table.

The bins are written to a folder that readers ignore, with a list of what each replaces
(the journal).  Then the new files are moved in and the old ones deleted, by tasks.
``recover`` finishes a compaction that was interrupted between the two: repeating any
of the moves and deletions changes nothing.  The table must not be read in that moment: plain files
give no isolation.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urbanpulse.sources.message_log import open_folder

TARGET_BYTES = 128 << 20
SMALL_SHARE = 0.75
GROUP_FILES = 10_000
MAX_FILES = 10_000
_STAGING = "_compaction-"


def first_fit_decreasing(sizes: Sequence[int], target: int) -> list[int]:
    """A bin number for each size; bins hold ``target`` at most, unless a single size exceeds it."""
    out, room = [0] * len(sizes), []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        at = next((b for b, r in enumerate(room) if r >= sizes[k]), None)
        if at is None:
            at = len(room)
            room.append(target)
        room[at] -= sizes[k]
        out[k] = at
    return out


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, folder, bytes) of the data files of a table; names and sizes only, no content is read."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
             .load(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")))
    return found.withColumn("folder", F.expr("substring_index(file, '/', size(split(file, '/')) - 1)"))


def plan_bins(files: DataFrame, target: int = TARGET_BYTES, small: int | None = None) -> DataFrame:
    """(file, folder, bin): files to rewrite, by bin; only bins of two files or more."""
    small = int(target * SMALL_SHARE) if small is None else small
    undersized = files.where(F.col("bytes") < small)
    many = undersized.groupBy("folder").agg(F.ceil(F.count(F.lit(1)) / GROUP_FILES).alias("groups"))
    grouped = undersized.join(many, "folder").withColumn("grp", F.pmod(F.xxhash64("file"), F.col("groups")))

    def pack(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["file"])
        bins = first_fit_decreasing([r["bytes"] for r in rows], target)
        files = Counter(bins)
        out = [{"file": r["file"], "folder": r["folder"], "bin": f"{r['grp']}-{b}"}
               for r, b in zip(rows, bins, strict=True) if files[b] > 1]
        return pa.Table.from_pylist(out, pa.schema([(c, pa.string()) for c in ("file", "folder", "bin")]))

    packed = grouped.select("file", "folder", "bytes", "grp").groupBy("folder", "grp").applyInArrow(
        pack, "file string, folder string, bin string")
    return packed.withColumn("bin", F.sha2(F.concat_ws("|", "folder", "bin"), 256))


def _swap(journal: DataFrame, staging: str) -> None:
    """Move the bins in and delete what they replace; every step may be repeated."""
    run = staging.rsplit(_STAGING, 1)[1].strip("/")  # no name is used twice

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins: dict[str, tuple[str, list[str]]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                bins.setdefault(row["bin"], (row["folder"], []))[1].append(row["file"])
        for bin_, (folder, files) in bins.items():
            system, folder = open_folder(folder)
            new = f"{folder}/compacted-{run}-{bin_[:16]}.parquet"
            _, made = open_folder(f"{staging}/data/bin={bin_}")
            for part in system.get_file_info(pafs.FileSelector(made, allow_not_found=True)):
                if part.base_name.endswith(".parquet"):
                    system.move(part.path, new)
            if system.get_file_info(new).type != pafs.FileType.File:
                raise OSError(f"{new} is missing; nothing that it replaces was deleted")
            for old in files:
                _, old = open_folder(old)
                if system.get_file_info(old).type == pafs.FileType.File:
                    system.delete_file(old)
        yield pa.RecordBatch.from_arrays([pa.array(list(bins), pa.string())], names=["bin"])

    # all rows of a bin are in one task: its files fit one bin
    done = journal.repartition("bin").mapInArrow(work, "bin string")
    done.agg(F.count(F.lit(1))).collect()


def compact_files(spark: SparkSession, path: str, target: int = TARGET_BYTES, small: int | None = None,
                  max_files: int = MAX_FILES, swap: bool = True) -> int:
    """Compact the table at ``path`` in place; returns the number of files rewritten.

    ``swap=False`` leaves the bins staged, for ``recover`` to move in.
    """
    recover(spark, path)
    rewritten = 0
    while True:
        staging = os.path.join(path, _STAGING + uuid.uuid4().hex)
        bins = plan_bins(list_files(spark, path), target, small)
        # whole bins, as many as hold about max_files files together
        first = bins.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).orderBy("bin").limit(max(1, max_files // 2))
        chosen = first.withColumn("upto", F.sum("n").over(Window.orderBy("bin"))).where(F.col("upto") - F.col("n") < max_files)
        plan = bins.join(chosen.select("bin"), "bin", "left_semi").persist()
        try:
            rows = plan.select("file", "bin").collect()  # bounded by max_files and the files of a bin
            if not rows:
                return rewritten
            stored = spark.read.option("basePath", path).parquet(path)
            folders = {f.name for f in stored.schema.fields} - _file_columns(spark, rows[0]["file"])
            some = spark.read.schema(stored.schema).option("basePath", path).parquet(*[r["file"] for r in rows])
            names = F.broadcast(plan.select(F.col("file").alias("_file"), "bin"))
            out = some.withColumn("_file", F.col("_metadata.file_path")).join(names, "_file").drop("_file", *folders)
            out.repartition(len({r["bin"] for r in rows}), "bin").write.partitionBy("bin").parquet(f"{staging}/data")
            plan.select("file", "folder", "bin").coalesce(1).write.parquet(f"{staging}/journal")
        finally:
            plan.unpersist()
        rewritten += len(rows)
        if not swap:
            return rewritten
        recover(spark, path)


def _file_columns(spark: SparkSession, file: str) -> set[str]:
    return set(spark.read.parquet(file).columns)


def recover(spark: SparkSession, path: str) -> int:
    """Finish or drop compactions that were interrupted; returns how many were finished."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    finished = 0
    for found in system.listStatus(root):
        staging = found.getPath()
        if not staging.getName().startswith(_STAGING):
            continue
        if system.exists(jvm.org.apache.hadoop.fs.Path(staging, "journal/_SUCCESS")):
            _swap(spark.read.parquet(f"{staging}/journal"), staging.toString())
            finished += 1
        system.delete(staging, True)
    return finished
