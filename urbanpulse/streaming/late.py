"""Late and duplicate rows of a stream go to a side output.

The built-in dedup drops what it does not pass on.  Here an arbitrary-state operator keeps the vehicles and
event times that it has seen, and labels every row: ``clean`` (the first of its vehicle and
event time), ``duplicate``, ``late`` (at or behind the watermark when it came) or ``quarantine`` (invalid; it
passes without state).  An event-time timer clears the state of an hour once the watermark has passed its end:
the state is as large as that of the built-in dedup.

The operator's key is an hour and one of ``HOUR_GROUPS`` groups, by a hash of vehicle and event time: a call
and its few exchanges with the state store serve many vehicles, and a hot vehicle is spread within its hours too.

No row is lost: rows in = clean + duplicate + late + quarantine.  Bronze is read once; one ``foreachBatch``
writes silver and the side output, each by query and batch id, so a batch that runs again replaces its rows.

The watermark follows the event times of valid rows, as in ``silver.silver_stream``.  An operator that
reads the watermarked column itself never sees late rows; this one reads a copy in microseconds.

Of equal keys in one micro-batch any one is the clean one.  A late row is ``late`` even if its key was seen
in time: the state that would tell may be gone.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from urbanpulse import schemas as S
from urbanpulse.operators import quality, silver
from urbanpulse.streaming import jobs, router

LATE = "late"
HOUR_US = 3_600_000_000
#: Groups that the valid rows of an hour are dealt over; of those, each has its own state.
HOUR_GROUPS = 8
#: Invalid rows have no state; they are dealt over this many groups.
INVALID_GROUPS = 256
SINKS = {"silver": "traffic_silver", "side": "traffic_side_output"}


class LabelArrivals(StatefulProcessor):
    """State of one group of an hour: the vehicles and event times (microseconds) that were passed on, with their rows in a batch."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", "vehicle string, event_us long, rows long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 (Spark's names)
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        known: set[tuple[str, int]] | None = None
        counts: dict[tuple[str, int], int] = {}
        for part in rows:
            route = []
            for vehicle, at, valid in zip(part["k_vehicle"].tolist(), part["k_event_us"].tolist(), part["k_valid"].tolist(), strict=True):
                if not valid:
                    route.append(router.QUARANTINE)
                    continue
                if at <= mark:
                    route.append(LATE)
                    continue
                if known is None:
                    known = {(k[0], k[1]) for k in self.seen.get()}
                one = (vehicle, at)
                route.append(router.DUPLICATE if one in known or one in counts else router.CLEAN)
                counts[one] = counts.get(one, 0) + 1
            yield part.drop(columns=["k_vehicle", "k_hour", "k_group", "k_event_us", "k_valid"]).assign(route=route)
        if counts:
            self.seen.appendList([(*one, n) for one, n in counts.items()])
            self.handle.registerTimer((int(key[0]) + 1) * HOUR_US // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def label_stream(evaluated: DataFrame, delay: str = S.DEDUP_WATERMARK) -> DataFrame:
    """Every row of ``evaluated`` with its ``route``."""
    valid = F.col("dq_status") == S.STATUS_VALID
    micros = F.unix_micros("event_ts")
    spread = -F.pmod(F.xxhash64("kafka_topic", "kafka_partition", "kafka_offset"), F.lit(INVALID_GROUPS)) - 1
    group = F.pmod(F.xxhash64("vehicle_id", "event_ts"), F.lit(HOUR_GROUPS))
    rows = (evaluated.withColumn("k_mark", F.when(valid, F.col("event_ts"))).withWatermark("k_mark", delay)
            .withColumns({"k_vehicle": F.when(valid, F.col("vehicle_id")),
                          "k_hour": F.when(valid, F.floor(micros / HOUR_US)).otherwise(spread).cast("long"),
                          "k_group": F.when(valid, group).otherwise(F.lit(0)).cast("long"),
                          "k_event_us": F.coalesce(micros, F.lit(0)).cast("long"), "k_valid": valid}).drop("k_mark"))
    out = T.StructType([*evaluated.schema.fields, T.StructField("route", T.StringType())])
    return rows.groupBy("k_hour", "k_group").transformWithStateInPandas(
        statefulProcessor=LabelArrivals(), outputStructType=out, outputMode="Append", timeMode="EventTime")


def start_late_side_output(bronze_stream: DataFrame, root: str, clock: str = "ingestion_ts", delay: str = S.DEDUP_WATERMARK,
                           trigger: dict | None = None) -> StreamingQuery:
    """Clean rows to silver, all others with their route to the side output, from one read of bronze."""
    checkpoint = os.path.join(root, "_checkpoints", "late")
    labelled = label_stream(quality.evaluate(bronze_stream, clock=clock, processed_at=F.col(clock)), delay)

    def run(batch: DataFrame, batch_id: int) -> None:
        name = f"{router.query_id(batch.sparkSession, checkpoint)}-{batch_id}"
        batch.persist()  # the operator runs once for both writes
        try:
            clean = silver.enrich(batch.where(F.col("route") == router.CLEAN).drop("route"))
            router.write_batch(clean, os.path.join(root, SINKS["silver"]), name)
            router.write_batch(batch.where(F.col("route") != router.CLEAN), os.path.join(root, SINKS["side"]), name)
        finally:
            batch.unpersist()

    writer = (labelled.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).queryName("LateSideOutputStream"))
    return jobs._trigger(writer, trigger).start()
