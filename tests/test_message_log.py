"""The message log source: positions, restart, admission, lost ranges."""

import glob
import os

import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanpulse.plans.lakehouse import Lakehouse
from urbanpulse.sources import message_log as M

COLUMNS = ["topic", "partition", "offset", "timestamp", "value"]


def rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def messages(spark):
    """All messages without the late copies, whose offsets lie far behind the others."""
    found = Lakehouse(spark, SF_SMALL).messages.where("offset < 1000000000").persist()
    yield found
    found.unpersist()


def files(path):
    return sorted(glob.glob(f"{path}/data/*/topic=*/partition=*/part-*.parquet"))


def run(stream, folder, once=True):
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck")
    if once:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    else:
        query = writer.trigger(processingTime="0 seconds").start()
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def test_batch_read_and_ranges(spark, messages, scratch_dir):
    log = f"{scratch_dir}/log"
    M.append_messages(messages, log, rows_per_file=50)
    assert len(files(log)) > 12
    assert rows(M.read_log(spark, log)) == rows(messages)
    assert M.read_log(spark, log, subscribe="other").count() == 0
    some = M.read_log(spark, log, startingOffsets='{"traffic-topic": {"0": 300, "1": -1}}')
    want = messages.where("partition = 2 or (partition = 0 and offset >= 300)")
    assert rows(some) == rows(want)
    # a task reads files up to the bytes it is given
    assert M.read_log(spark, log, maxBytesPerTask="1").rdd.getNumPartitions() == len(files(log))
    assert M.read_log(spark, log).rdd.getNumPartitions() == 3


def test_restart_reads_what_is_new(spark, messages, scratch_dir):
    log = f"{scratch_dir}/log"
    M.append_messages(messages.where("offset < 400"), log, rows_per_file=50)
    assert sum(run(M.stream_log(spark, log, startingOffsets="earliest"), scratch_dir)) == messages.where("offset < 400").count()
    assert run(M.stream_log(spark, log, startingOffsets="earliest"), scratch_dir) == []
    M.append_messages(messages.where("offset >= 400"), log, rows_per_file=50)
    run(M.stream_log(spark, log, startingOffsets="latest"), scratch_dir)  # a checkpoint decides, not the option
    assert rows(spark.read.parquet(f"{scratch_dir}/out")) == rows(messages)
    with pytest.raises(ValueError, match="already holds"):
        M.append_messages(messages.where("offset = 10"), log)


def test_latest_skips_what_was_there(spark, messages, scratch_dir):
    log = f"{scratch_dir}/log"
    M.append_messages(messages.where("offset < 400"), log)
    assert run(M.stream_log(spark, log), scratch_dir) == []
    M.append_messages(messages.where("offset >= 400"), log)
    run(M.stream_log(spark, log), scratch_dir)
    assert rows(spark.read.parquet(f"{scratch_dir}/out")) == rows(messages.where("offset >= 400"))


@pytest.mark.parametrize("limit", [{"maxBytesPerTrigger": "1"}, {"maxSpanPerTrigger": "120"}])
def test_admission_and_restart(spark, messages, scratch_dir, limit):
    """Every partition advances by little, also across a restart, and nothing is read twice."""
    log, ck = f"{scratch_dir}/log", f"{scratch_dir}/ck"
    M.append_messages(messages.where("offset < 500"), log, rows_per_file=50)
    options = {"startingOffsets": "earliest", "checkpointLocation": ck, **limit}
    first = run(M.stream_log(spark, log, **options), scratch_dir, once=False)
    assert len(first) >= 3 and max(first) <= 160
    M.append_messages(messages.where("offset >= 500"), log, rows_per_file=50)
    second = run(M.stream_log(spark, log, **options), scratch_dir, once=False)
    assert len(second) >= 3 and max(second) <= 160
    assert rows(spark.read.parquet(f"{scratch_dir}/out")) == rows(messages)
    with pytest.raises(Exception, match="checkpointLocation"):
        M.stream_log(spark, log, **limit).writeStream.format("noop").start().processAllAvailable()


def test_log_in_the_order_of_arrival(spark, scratch_dir):
    """Positions are arrival times: each micro-batch goes on by the span, whatever the size of the log."""
    whole = Lakehouse(spark, SF_SMALL).messages
    log, ck = f"{scratch_dir}/log", f"{scratch_dir}/ck"
    M.append_messages(whole, log, rows_per_file=40, position="timestamp")
    span = 10 * 24 * 3_600_000_000
    options = {"startingOffsets": "earliest", "checkpointLocation": ck, "maxSpanPerTrigger": str(span)}
    seen = []
    query = (M.stream_log(spark, log, **options).writeStream.option("checkpointLocation", ck)
             .foreachBatch(lambda df, k: seen.append(df.agg(F.min("timestamp"), F.max("timestamp"), F.count("*")).first()))
             .trigger(processingTime="0 seconds").start())
    query.processAllAvailable()
    query.stop()
    seen = [s for s in seen if s[2]]
    assert sum(s[2] for s in seen) == whole.count() and len(seen) == 3 or len(seen) == 4
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:], strict=False))
    assert all((s[1] - s[0]).total_seconds() * 1e6 <= span for s in seen)


def test_lost_range(spark, messages, scratch_dir):
    log = f"{scratch_dir}/log"
    M.append_messages(messages.where("offset < 300"), log, rows_per_file=50)
    run(M.stream_log(spark, log, startingOffsets="earliest"), scratch_dir)
    M.append_messages(messages.where("offset >= 300"), log, rows_per_file=50)
    # retention takes a file that was read and one that was not
    first = {f: spark.read.parquet(f).agg(F.min("offset")).first()[0] for f in files(log)}
    old = next(f for f, least in first.items() if "partition=0" in f and least < 300)
    new = next(f for f, least in first.items() if "partition=1" in f and least >= 300)
    gone = spark.read.parquet(new).agg(F.min("offset"), F.max("offset")).first()
    os.remove(old)
    os.remove(new)
    with pytest.raises(StreamingQueryException, match="are gone"):
        run(M.stream_log(spark, log), scratch_dir)
    run(M.stream_log(spark, log, failOnDataLoss="false"), scratch_dir)
    want = messages.where(~((F.col("partition") == 1) & F.col("offset").between(*gone)))
    got = spark.read.parquet(f"{scratch_dir}/out")
    assert (got.exceptAll(want.select(got.columns)).count(), want.select(got.columns).exceptAll(got).count()) == (0, 0)
    # a new reader starts at the earliest offset that is left
    left = M.read_log(spark, log, failOnDataLoss="false")
    assert left.where("partition = 0").count() < messages.where("partition = 0").count()


def test_a_file_is_read_in_pieces(spark, scratch_dir):
    """What a reading task holds does not grow with the file."""
    log, n = f"{scratch_dir}/log", 160_000
    text = F.concat(*(F.sha2(F.concat_ws("-", "id", F.lit(k)), 512) for k in range(4)))
    own = spark.range(n).select(
        text.alias("value"), F.timestamp_seconds("id").alias("timestamp"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"))
    M.append_messages(own, log)
    held = M.Log({"path": log})
    size = max(s.bytes for found in held.segments().values() for s in found)
    base, most, offsets = pa.total_allocated_bytes(), 0, []
    for part in held.plan(held.start("earliest"), held.end()):
        for batch in held.read(part):
            most = max(most, pa.total_allocated_bytes() - base)
            offsets += batch.column("offset").to_pylist()
    assert sorted(offsets) == list(range(n))
    assert size > 10 << 20 and most < size
