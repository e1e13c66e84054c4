"""Bin-packing compaction: which files are rewritten, which are not, and recovery."""

import glob
import os
import random

from pyspark.sql import functions as F

from urbanpulse.operators import binpack as P


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(path):
    return {f: (os.path.getsize(f), os.stat(f).st_mtime_ns) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)
            if "/_" not in f}


def local(uri):
    return "/" + uri.removeprefix("file:").lstrip("/")


def test_first_fit_decreasing():
    assert P.first_fit_decreasing([], 10) == []
    assert P.first_fit_decreasing([6, 5, 4, 5, 11], 10) == [1, 2, 1, 2, 0]
    rng = random.Random(0)
    for _ in range(50):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(1, 80))]
        bins: dict[int, int] = {}
        for b, s in zip(P.first_fit_decreasing(sizes, 100), sizes, strict=True):
            bins[b] = bins.get(b, 0) + s
        assert max(bins.values()) <= 100
        assert len(bins) <= 11 / 9 * -(-sum(sizes) // 100) + 1  # the known bound over the least number


def make(spark, path):
    """Two folders of a few small files each, one with a large file, and one folder with a single file."""
    df = spark.range(3_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), (F.col("id") % 2).alias("day"))
    for k in range(5):
        df.where(F.col("id") % 5 == k).coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    big = spark.range(20_000, 40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit(1).alias("day"))
    big.coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    df.limit(3).withColumn("day", F.lit(7)).coalesce(1).write.mode("append").partitionBy("day").parquet(path)


def test_only_small_files_are_rewritten(spark, scratch_dir):
    path = f"{scratch_dir}/t"
    make(spark, path)
    before, want = files(path), rows(spark.read.parquet(path))
    small = {f for f, (size, _) in before.items() if size < 200_000}
    single = next(f for f in before if "day=7" in f)
    assert P.compact_files(spark, path, target=400_000, small=200_000) == len(small) - 1 == 10
    after = files(path)
    assert rows(spark.read.parquet(path)) == want
    # one new file a folder; the large file and the single one keep name, bytes and time
    new = set(after) - set(before)
    assert len(new) == 2 and {os.path.dirname(f)[-1] for f in new} == {"0", "1"}
    stays = set(before) - small | {single}
    assert all(after[f] == before[f] for f in stays) and set(after) == new | stays
    assert P.compact_files(spark, path, target=400_000, small=200_000) == 0
    assert files(path) == after and not glob.glob(f"{path}/_compaction-*")


def test_interrupted_compaction_is_finished(spark, scratch_dir, monkeypatch):
    path = f"{scratch_dir}/t"
    make(spark, path)
    want, before = rows(spark.read.parquet(path)), files(path)
    assert P.compact_files(spark, path, target=400_000, small=200_000, swap=False) == 10
    assert rows(spark.read.parquet(path)) == want and files(path) == before  # staged only
    # half of the swap is done: one bin is moved in and some of its old files are gone
    staging = glob.glob(f"{path}/_compaction-*")[0]
    journal = spark.read.parquet(f"{staging}/journal").collect()
    one = sorted(r["bin"] for r in journal)[0]
    own = [r for r in journal if r["bin"] == one]
    run = staging.rsplit("-", 1)[1]
    part = glob.glob(f"{staging}/data/bin={one}/part-*.parquet")[0]
    folder = local(own[0]["folder"])
    os.rename(part, f"{folder}/compacted-{run}-{one[:16]}.parquet")
    os.remove(local(own[0]["file"]))
    assert P.recover(spark, path) == 1 and P.recover(spark, path) == 0
    assert rows(spark.read.parquet(path)) == want and len(files(path)) == 4
    # without a journal nothing was promised: the staging folder goes
    os.makedirs(f"{path}/_compaction-x/data")
    assert P.recover(spark, path) == 0 and not os.path.exists(f"{path}/_compaction-x")
    assert rows(spark.read.parquet(path)) == want


def test_many_jobs_and_plain_folder(spark, scratch_dir):
    """A table without partitions, packed a few files a job."""
    path = f"{scratch_dir}/t"
    df = spark.range(1_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    df.repartition(20).write.parquet(path)
    want = rows(spark.read.parquet(path))
    assert P.compact_files(spark, path, target=20_000, max_files=4) >= 20
    assert rows(spark.read.parquet(path)) == want and len(files(path)) < 12
