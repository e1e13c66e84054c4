"""A message source on a log of files, by topic, partition and offset.

``append_messages`` adds one load of messages to a log folder: Parquet files by topic and
partition, each with a range of positions, and an index entry per file (topic, partition,
first position, next position, bytes).  A message's position is its offset, or its arrival time in
microseconds for a log that replays messages in the order of their arrival.  A load is visible once
its index is complete.

``MessageLog`` is a Python data source over such a folder, for batch
(``spark.read.format("message_log")``) and streams.  Spark's offsets are ``{topic: {partition: next
position}}``; it keeps them in the query's checkpoint, so a restart goes on where it
stopped.  The driver plans ranges from the index alone; the tasks read the files as Arrow
batches, so no message passes through the driver.

Options
-------
path                  the log folder, local or any URI that pyarrow's file systems open
subscribe             topics, comma separated (default: all)
startingOffsets       ``earliest``, ``latest`` or JSON ``{topic: {partition: position}}``; -2 and -1 in it
                      are earliest and latest, a partition that it leaves out is read from the earliest.
                      Only a query without a checkpoint looks at it.
failOnDataLoss        ``true`` (default): offsets that were indexed but whose file is gone end the query;
                      ``false``: they are skipped
maxBytesPerTrigger    admission: bytes of files that one micro-batch takes from each partition (one file at
                      least)
maxSpanPerTrigger     admission: positions that one micro-batch goes on from the partition that is furthest behind;
                      with arrival times, all partitions advance together by so many microseconds
checkpointLocation    the folder that the query is started with; either limit needs it, because a restarted
                      reader learns from it where the query stands.  With a limit a trigger takes one
                      admission, so ``availableNow`` ends after the first: use a processing-time trigger.
maxBytesPerTask       bytes of files that one task reads (one file at least)

Message columns are those of the broker's source: value, timestamp, topic, partition, offset.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from urbanpulse import schemas as S

ROWS_PER_FILE = 1_000_000
BYTES_PER_TASK = 128 << 20
#: Messages that a reading task holds at a time, and bytes of each column that it reads ahead.
ROWS_PER_READ, READ_AHEAD = 8192, 1 << 20
EARLIEST, LATEST = -2, -1
Offsets = dict[str, dict[str, int]]


class DataLoss(Exception):
    """Indexed offsets that the log no longer holds."""


# ---------------------------------------------------------------------------
# Writing
# ---------------------------------------------------------------------------
def _index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("topic string, partition int, first long, next long, bytes long, file string").json(
        f"{path}/index/*")


def append_messages(messages: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, position: str = "offset") -> str:
    """Append a load to a log; returns its name.  Its positions must lie behind those of the log.

    ``position``: ``offset`` or ``timestamp``, the same for all loads of a log.

    One range shuffle: a partition with very many messages is cut into as many tasks as it
    fills.  The index is one grouped pass over the offsets, a row per file.
    """
    spark = messages.sparkSession
    load = uuid.uuid4().hex
    order = ["topic", "partition", "position"]
    at = F.col("offset") if position == "offset" else F.unix_micros("timestamp")
    (messages.select("value", "timestamp", "topic", "partition", "offset", at.alias("position"))
     .repartitionByRange(*order).sortWithinPartitions(*order, "offset")
     .write.option("maxRecordsPerFile", str(rows_per_file)).partitionBy("topic", "partition")
     .parquet(f"{path}/data/{load}"))
    stored = (spark.read.schema("position long, topic string, partition int").parquet(f"{path}/data/{load}")
              .groupBy("topic", "partition", F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_size").alias("bytes"))
              .agg(F.min("position").alias("first"), (F.max("position") + 1).alias("next"))
              .withColumn("file", F.expr("substring_index(file, '/data/', -1)"))).persist()
    try:
        fresh = stored.groupBy("topic", "partition").agg(F.min("first").alias("first"))
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/index")
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            ends = _index(spark, path).groupBy("topic", "partition").agg(F.max("next").alias("next"))
            # a row per topic partition
            behind = fresh.join(ends, ["topic", "partition"]).where("first < next").first()
            if behind:
                raise ValueError(f"position {behind['first']} of {behind['topic']}-{behind['partition']} is below {behind['next']}, "
                                 "which the log already holds")
        stored.coalesce(1).write.json(f"{path}/index/{load}")
    finally:
        stored.unpersist()
    return load


# ---------------------------------------------------------------------------
# Reading
# ---------------------------------------------------------------------------
class Segment(NamedTuple):
    """One indexed file: positions from ``first`` to before ``next``."""

    topic: str
    partition: str
    first: int
    next: int
    bytes: int
    file: str


class LogRange(InputPartition):
    """What one task reads: files of one topic partition, positions from ``start`` to before ``end``."""

    def __init__(self, topic: str, partition: int, files: list[str], start: int, end: int):
        self.topic, self.partition, self.files, self.start, self.end = topic, partition, files, start, end


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "file:///" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class Log:
    """The index of a log folder, and what its options ask for."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.topics = [t.strip() for t in options.get("subscribe", "").split(",") if t.strip()]
        self.strict = str(options.get("failondataloss", options.get("failOnDataLoss", "true"))).lower() != "false"
        self.starting = options.get("startingoffsets", options.get("startingOffsets"))
        limit = options.get("maxbytespertrigger", options.get("maxBytesPerTrigger"))
        self.limit = int(limit) if limit else None
        span = options.get("maxspanpertrigger", options.get("maxSpanPerTrigger"))
        self.span = int(span) if span else None
        self.limited = self.limit is not None or self.span is not None
        self.task_bytes = int(options.get("maxbytespertask", options.get("maxBytesPerTask", BYTES_PER_TASK)))
        self.checkpoint = options.get("checkpointlocation", options.get("checkpointLocation"))
        if self.limited and not self.checkpoint:
            raise ValueError("a limit per trigger needs checkpointLocation")
        self._seen: dict[str, list[Segment]] = {}

    def segments(self) -> dict[tuple[str, str], list[Segment]]:
        """The files of every subscribed topic partition, by offset.  Loads that were read before are not read again."""
        system, root = open_folder(f"{self.path}/index")
        loads = system.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        whole = {x.path.rsplit("/", 2)[1] for x in loads if x.base_name == "_SUCCESS"}
        for x in loads:
            load = x.path.rsplit("/", 2)[1]
            if load in whole and x.base_name.startswith("part-") and x.path not in self._seen:
                with system.open_input_stream(x.path) as f:
                    rows = [json.loads(line) for line in f.read().decode().splitlines() if line]
                self._seen[x.path] = [Segment(r["topic"], str(r["partition"]), r["first"], r["next"], r["bytes"], unquote(r["file"]))
                                      for r in rows]
        out: dict[tuple[str, str], list[Segment]] = {}
        for s in sorted(s for found in self._seen.values() for s in found):
            if not self.topics or s.topic in self.topics:
                out.setdefault((s.topic, s.partition), []).append(s)
        return out

    def missing(self, segments: list[Segment]) -> set[str]:
        """Files of these segments that are gone."""
        system, root = open_folder(f"{self.path}/data")
        found = system.get_file_info([f"{root}/{s.file}" for s in segments])
        return {s.file for s, x in zip(segments, found, strict=True) if x.type == pafs.FileType.NotFound}

    def start(self, default: str) -> Offsets:
        """The offsets that a new query starts from."""
        asked = self.starting or default
        given = {} if asked in ("earliest", "latest") else json.loads(asked)
        out: Offsets = {}
        for (topic, partition), found in self.segments().items():
            at = given.get(topic, {}).get(partition, LATEST if asked == "latest" else EARLIEST)
            if at == LATEST:
                at = found[-1].next
            elif at == EARLIEST:
                gone = self.missing(found)
                at = next((s.first for s in found if s.file not in gone), found[-1].next)
            out.setdefault(topic, {})[partition] = at
        return out

    def end(self, position: Offsets | None = None) -> Offsets:
        """The offsets behind the newest messages; with a position and a limit, as far as is admitted."""
        out: Offsets = {t: dict(p) for t, p in (position or {}).items()}
        known = self.segments()
        at = {key: (position or {}).get(key[0], {}).get(key[1], found[0].first) for key, found in known.items()}
        waiting = [max(at[key], s.first) for key, found in known.items() for s in found if s.next > at[key]]
        stop = min(waiting) + self.span if waiting and position is not None and self.span is not None else None
        for key, found in known.items():
            end, taken = at[key], 0
            for s in found:
                if s.next <= at[key]:
                    continue
                if stop is not None and s.next > stop:
                    end = max(end, min(stop, s.next)) if s.first < stop else end
                    break
                if position is not None and self.limit is not None and taken and taken + s.bytes > self.limit:
                    break
                end, taken = max(end, s.next), taken + s.bytes
            out.setdefault(key[0], {})[key[1]] = end
        return out

    def plan(self, start: Offsets, end: Offsets) -> list[LogRange]:
        """Ranges between two offsets; each has files of one partition, of about ``task_bytes`` together."""
        known, out = self.segments(), []
        for topic, partitions in end.items():
            for partition, stop in partitions.items():
                found = known.get((topic, partition), [])
                at = start.get(topic, {}).get(partition, found[0].first if found else 0)
                wanted = [s for s in found if s.next > at and s.first < stop]
                gone = self.missing(wanted)
                lost = [(max(s.first, at), min(s.next, stop)) for s in wanted if s.file in gone]
                newest = max((s.next for s in found), default=0)
                if newest < at:  # the log was made anew
                    lost.append((newest, at))
                if lost and self.strict:
                    raise DataLoss(f"{topic}-{partition}: positions " + ", ".join(f"{a} to {b - 1}" for a, b in lost) +
                                   " are gone; failOnDataLoss=false skips them")
                held: list[Segment] = []
                for s in [s for s in wanted if s.file not in gone]:
                    if held and sum(x.bytes for x in held) + s.bytes > self.task_bytes:
                        out.append(LogRange(topic, int(partition), [x.file for x in held], at, stop))
                        held = []
                    held.append(s)
                if held:
                    out.append(LogRange(topic, int(partition), [x.file for x in held], at, stop))
        return out

    def committed(self) -> Offsets | None:
        """Where the query of the checkpoint stands: the offsets of its last committed batch."""
        system, root = open_folder(self.checkpoint)

        def newest(name: str) -> int | None:
            found = system.get_file_info(pafs.FileSelector(f"{root}/{name}", allow_not_found=True))
            return max((int(x.base_name) for x in found if x.base_name.isdigit()), default=None)

        batch = newest("commits")
        if batch is None:
            return None
        with system.open_input_stream(f"{root}/offsets/{batch}") as f:
            lines = f.read().decode().splitlines()
        return json.loads(lines[2]) if len(lines) > 2 and lines[2] != "-" else None

    def read(self, part: LogRange) -> Iterator[pa.RecordBatch]:
        """Messages of a range as Arrow batches; pages are read as they are needed, never a whole column of a file."""
        system, root = open_folder(f"{self.path}/data")
        for file in part.files:
            with system.open_input_file(f"{root}/{file}") as f:
                held = pq.ParquetFile(f, pre_buffer=False, buffer_size=READ_AHEAD)
                for batch in held.iter_batches(ROWS_PER_READ, columns=["value", "timestamp", "offset", "position"],
                                               use_threads=False):
                    at = batch.column("position")
                    batch = batch.filter(pc.and_(pc.greater_equal(at, part.start), pc.less(at, part.end)))
                    n = batch.num_rows
                    if n:
                        stamp = batch.column("timestamp").cast(pa.timestamp("us")).cast(pa.timestamp("us", tz="UTC"))
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("value").cast(pa.string()), stamp, pa.array([part.topic] * n, pa.string()),
                             pa.array([part.partition] * n, pa.int32()), batch.column("offset").cast(pa.int64())],
                            names=["value", "timestamp", "topic", "partition", "offset"])


class _BatchReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.log = Log(options)

    def partitions(self) -> list[LogRange]:
        return self.log.plan(self.log.start("earliest"), self.log.end())

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition) if partition is not None else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.log = Log(options)
        self.position: Offsets | None = None

    def initialOffset(self) -> Offsets:  # noqa: N802 (Spark's names)
        return self.log.start("latest")

    def latestOffset(self) -> Offsets:  # noqa: N802
        if not self.log.limited:
            return self.log.end()
        if self.position is None:
            self.position = self.log.committed() or self.log.start("latest")
        return self.log.end(self.position)

    def partitions(self, start: Offsets, end: Offsets) -> list[LogRange]:
        self.position = end
        return self.log.plan(start, end)

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        return self.log.read(partition)

    def commit(self, end: Offsets) -> None:
        self.position = end


class MessageLog(DataSource):
    """``format("message_log")``; register it once per session with ``register``."""

    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self):
        return S.MESSAGE_SCHEMA

    def reader(self, schema) -> _BatchReader:
        return _BatchReader(self.options)

    def streamReader(self, schema) -> _StreamReader:  # noqa: N802
        return _StreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MessageLog)


def read_log(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The messages of a log as a batch."""
    register(spark)
    return spark.read.format("message_log").options(**options).load(path)


def stream_log(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """The messages of a log as a stream."""
    register(spark)
    return spark.readStream.format("message_log").options(**options).load(path)
