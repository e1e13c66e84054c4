"""Compaction and Z-order keep the rows; Z-order lets min/max skip files."""

import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanpulse.operators import maintenance as V
from urbanpulse.plans.lakehouse import Lakehouse


def _multiset(df):
    return sorted(tuple(r) for r in df.collect())


def _files_overlapping(spark, path, column, value):
    """Files whose [min, max] of ``column`` contains ``value``."""
    df = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), column)
    stats = df.groupBy("f").agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return stats.where((F.col("lo") <= value) & (F.col("hi") >= value)).count(), stats.count()


def test_compact_keeps_rows(spark, scratch_dir):
    fact = Lakehouse(spark, SF_SMALL).fact
    small = os.path.join(scratch_dir, "small")
    fact.repartition(32).write.parquet(small)
    out = os.path.join(scratch_dir, "compact")
    V.compact(spark.read.parquet(small), out, sort_by=["event_date"])
    assert len(spark.read.parquet(out).inputFiles()) == 1
    assert _multiset(spark.read.parquet(out)) == _multiset(spark.read.parquet(small))


def test_zorder_skips_files(spark, scratch_dir):
    fact = Lakehouse(spark, SF_SMALL).fact.select("road_id", "city_zone", "vehicle_id", "speed_kmh")
    unordered = os.path.join(scratch_dir, "unordered")
    fact.repartition(16).write.parquet(unordered)
    z = os.path.join(scratch_dir, "z")
    stored = spark.read.parquet(unordered)
    V.zorder_rewrite(stored, z, ["road_id", "city_zone"], target_bytes=V.file_count(stored, 1) // 16 + 1)
    assert _multiset(spark.read.parquet(z)) == _multiset(fact)
    u_hit, u_total = _files_overlapping(spark, unordered, "road_id", "R300")
    z_hit, z_total = _files_overlapping(spark, z, "road_id", "R300")
    zz_hit, _ = _files_overlapping(spark, z, "city_zone", "CBD")
    assert u_hit == u_total
    assert z_hit < z_total and zz_hit < z_total


def test_zorder_of_whole_strings(spark, scratch_dir):
    """Ids that share a long prefix, and text in other scripts, are told apart."""
    rows = [(f"VEHICLE-NUMBER-{i % 200:06d}", "\u4e2d\u6587\u8f66\u8f86\u7f16\u53f7" + chr(0x4E00 + i // 200), i)
            for i in range(2000)]
    path, out = os.path.join(scratch_dir, "in"), os.path.join(scratch_dir, "out")
    spark.createDataFrame(rows, "a string, b string, n int").write.parquet(path)
    stored = spark.read.parquet(path)
    bounds = V.z_bucket_bounds(stored, ["a", "b"], bits=4)
    assert len(bounds["a"]) > 8 and len(bounds["b"]) > 8
    assert stored.select(V.z_value(["a", "b"], bounds, 4)).distinct().count() > 64
    V.zorder_rewrite(stored, out, ["a", "b"], bits=4, target_bytes=V.file_count(stored, 1) // 12 + 1)
    hit, total = _files_overlapping(spark, out, "a", "VEHICLE-NUMBER-000100")
    assert total > 6 and hit < total
    assert _multiset(spark.read.parquet(out)) == _multiset(stored)


def _share_of_largest(spark, path):
    df = spark.read.parquet(path)
    counts = [r["n"] for r in df.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    return max(counts) / sum(counts), len(counts)


def test_hot_key_is_split(spark, scratch_dir):
    """Nine rows in ten have one key: no file holds more than about its share."""
    path = os.path.join(scratch_dir, "in")
    spark.range(20_000).select((F.col("id") % 10 == 0).cast("int").alias("k"), "id",
                               F.sha2(F.col("id").cast("string"), 256).alias("x")).write.parquet(path)
    stored = spark.read.parquet(path)
    target = V.file_count(stored, 1) // 10 + 1
    for write in ("compact", "zorder"):
        out = os.path.join(scratch_dir, write)
        if write == "compact":
            V.compact(stored, out, sort_by=["k"], target_bytes=target)
        else:
            V.zorder_rewrite(stored, out, ["k"], target_bytes=target)
        share, files = _share_of_largest(spark, out)
        assert files >= 9 and share < 0.2, (write, share, files)


def test_hot_partition_of_the_fact_is_split(spark, scratch_dir):
    from urbanpulse.operators import gold
    rows = spark.range(20_000).select(
        F.lit("2024-01-01").cast("date").alias("event_date"), (F.col("id") % 10 == 0).cast("int").alias("event_hour"),
        F.sha2(F.col("id").cast("string"), 256).alias("x"))
    path = os.path.join(scratch_dir, "fact")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        gold.write_fact(rows.repartition(16), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    share, files = _share_of_largest(spark, path)
    assert files >= 4 and share < 0.5, (share, files)


def test_full_write_replaces_old_partitions(spark, scratch_dir):
    from urbanpulse.operators import gold
    fact = Lakehouse(spark, SF_SMALL).fact
    path = os.path.join(scratch_dir, "fact")
    gold.write_fact(fact, path)
    some = fact.where("event_hour < 8")
    gold.write_fact(some, path)
    assert spark.read.parquet(path).count() == some.count() < 800


def test_rollup_schema_change(spark, scratch_dir):
    from urbanpulse.operators import rollups
    path = os.path.join(scratch_dir, "rollup")
    old = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "d string, x int")
    rollups.write_rollup(old, path, ["d"])
    new = spark.createDataFrame([("2024-01-02", 3, 9)], "d string, x int, y int")
    rollups.write_rollup(new, path, ["d"], only_touched=True)
    got = sorted((str(r["d"]), r["x"], r["y"]) for r in rollups.read_rollup(spark, path).collect())
    assert got == [("2024-01-01", 1, None), ("2024-01-02", 3, 9)]
    rollups.write_rollup(new, path, ["d"])
    assert rollups.read_rollup(spark, path).count() == 1


def test_versions(spark, scratch_dir):
    rows = [("A", 1, 10, "2024-01-01"), ("A", 2, 20, "2024-01-10"), ("B", 1, 10, "2024-01-01"), ("A", 3, 20, "2024-01-10")]
    path = os.path.join(scratch_dir, "v")
    for commit in (10, 20):
        part = spark.createDataFrame([r[:2] for r in rows if r[2] == commit], "k string, x int")
        at = next(r[3] for r in rows if r[2] == commit)
        V.append_load(part, path, commit, F.lit(at).cast("timestamp"))
    versioned = spark.read.parquet(path)
    hist = [(r["commit_id"], r["num_output_rows"]) for r in V.commit_history(versioned, None).collect()]
    assert hist == [(20, 2), (10, 2)]
    state = {r["k"]: r["x"] for r in V.as_of(versioned, keys=["k"]).collect()}
    assert state == {"A": 3, "B": 1}
    old = {r["k"]: r["x"] for r in V.as_of(versioned, version=10, keys=["k"]).collect()}
    assert old == {"A": 1, "B": 1}
    kept = sorted((r["k"], r["x"]) for r in V.expire(versioned, ["k"], 24).collect())
    assert kept == [("A", 2), ("A", 3), ("B", 1)]
    out = os.path.join(scratch_dir, "restored")
    V.restore_as_of(versioned, out, 20, 30, F.lit("2024-02-01").cast("timestamp"), keys=["k"], order=["commit_id", "x"])
    assert sorted((r["k"], r["x"], r["commit_id"]) for r in spark.read.parquet(out).collect()) == [("A", 3, 30), ("B", 1, 30)]


def test_rows_of_a_task_are_bounded(spark, scratch_dir, monkeypatch):
    """A file may hold many times its size in rows: tasks follow the rows where these are more."""
    path = os.path.join(scratch_dir, "in")
    spark.range(8_000).select((F.col("id") % 5).alias("k"), F.repeat(F.lit("x"), 1_000).alias("x"), "id").write.parquet(path)
    stored = spark.read.parquet(path)
    assert V.file_count(stored) == 1
    monkeypatch.setattr(V, "TASK_BYTES", 1 << 20, raising=False)
    for write in ("compact", "spread", "zorder"):
        out = os.path.join(scratch_dir, write)
        if write == "zorder":
            V.zorder_rewrite(stored, out, ["k"])
        else:
            V.compact(stored, out, sort_by=["k"] if write == "compact" else None)
        share, files = _share_of_largest(spark, out)
        assert files >= 7 and share < 0.25, (write, share, files)
        assert _multiset(spark.read.parquet(out)) == _multiset(stored)


def test_row_bytes(spark):
    rows = spark.createDataFrame([(1, "abc", None), (2, None, [1, 2])], "a int, b string, c array<int>")
    assert V.row_bytes(rows) == 2 * 8 * 4 + 3 + len("[1, 2]")
    assert V.row_bytes(rows.limit(0)) == 0
