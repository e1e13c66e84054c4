"""Data quality: ordered rule chain, quarantine, replay, data tests (Q1-Q16).

The rule chain is a declarative list of (status, predicate) evaluated as one
first-match CASE, so every row gets exactly one status in a single narrow
projection.  Routing to clean / quarantine is a filter on that status; both
branches share the same deterministic ``clock`` column, so a row can never
land in both tables or in neither.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.functions.columns import col_of, count_if, pct, round_half_up
from urbanpulse.functions.features import typed_event_ts, typed_speed


def with_typed_fields(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Add ``speed_int``, ``event_ts`` and ``processed_at``."""
    processed_at = F.current_timestamp() if processed_at is None else processed_at
    return bronze.withColumns({
        "speed_int": typed_speed("speed"),
        "event_ts": typed_event_ts("event_time"),
        "processed_at": processed_at,
    })


def dq_rules(clock: Column | str = "ingestion_ts",
             future_tolerance: str = S.FUTURE_TOLERANCE,
             max_latency: str = S.MAX_LATENCY) -> list[tuple[str, Column]]:
    """The ordered rules (Q2-Q7); the first rule that holds names the status."""
    clock = col_of(clock)
    payload = F.col("raw_payload")
    vid = F.col("vehicle_id")
    speed = F.col("speed_int")
    ts = F.col("event_ts")
    return [
        (S.STATUS_CORRUPT, payload.contains(S.CORRUPT_MARKER)
         | payload.startswith(S.CORRUPT_PREFIX) | F.col("raw").isNotNull()),
        (S.STATUS_NO_VEHICLE, vid.isNull() | (F.trim(vid) == "")),
        (S.STATUS_BAD_TS, ts.isNull()),
        (S.STATUS_SPEED, speed.isNull() | (speed < S.SPEED_MIN_KMH) | (speed > S.SPEED_MAX_KMH)),
        (S.STATUS_FUTURE, ts > clock + F.expr(f"INTERVAL {future_tolerance}")),
        (S.STATUS_LATENCY, ts < clock - F.expr(f"INTERVAL {max_latency}")),
    ]


def dq_status(rules: Sequence[tuple[str, Column]]) -> Column:
    """First-match CASE over the rules; VALID when none holds (Q1)."""
    expr = None
    for name, cond in rules:
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(S.STATUS_VALID))


def evaluate(bronze: DataFrame, clock: Column | str = "ingestion_ts",
             processed_at: Column | None = None, **rule_args) -> DataFrame:
    """Bronze -> typed fields + ``dq_status`` (one narrow projection)."""
    typed = with_typed_fields(bronze, processed_at)
    return typed.withColumn("dq_status", dq_status(dq_rules(clock, **rule_args)))


QUARANTINE_COLUMNS = ["raw_payload", "vehicle_id", "road_id", "city_zone", "raw_speed",
                      "raw_event_time", "quarantine_reason", "kafka_timestamp",
                      "quarantine_ts", "kafka_topic", "kafka_partition", "kafka_offset"]


def quarantine(evaluated: DataFrame) -> DataFrame:
    """Failed rows in the audit shape (Q8).

    The nine audit columns plus the message coordinates (topic, partition,
    offset), which identify the original message for replay.
    """
    return evaluated.where(F.col("dq_status") != S.STATUS_VALID).select(
        "raw_payload", "vehicle_id", "road_id", "city_zone",
        F.col("speed").alias("raw_speed"),
        F.col("event_time").alias("raw_event_time"),
        F.col("dq_status").alias("quarantine_reason"),
        "kafka_timestamp",
        F.col("processed_at").alias("quarantine_ts"),
        "kafka_topic", "kafka_partition", "kafka_offset",
    )


def schema_drift_report(bronze: DataFrame, contract: Sequence[str] = tuple(S.PAYLOAD_FIELDS)) -> DataFrame:
    """Payload keys outside the contract: key, rows, first and last arrival (Q10).

    The contract's keys leave each key array before it is exploded, so only drift
    makes rows; then a partial aggregate per key.
    """
    drift = F.array_except(F.json_object_keys("raw_payload"), F.array(*(F.lit(k) for k in contract)))
    return (bronze.select(F.explode(drift).alias("drift_key"), "kafka_timestamp")
            .groupBy("drift_key")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.min("kafka_timestamp").alias("first_seen"),
                 F.max("kafka_timestamp").alias("last_seen")))


REPLAY_FIELDS = ["vehicle_id", "road_id", "city_zone", "speed", "event_time"]
MESSAGE_KEY = ["kafka_topic", "kafka_partition", "kafka_offset"]
SALTS = 16


def replay(quarantined: DataFrame, corrections: DataFrame,
           clock: Column | str = "kafka_timestamp") -> DataFrame:
    """Quarantined messages with corrections overlaid, through the rules again (Q11).

    ``corrections`` is keyed by (kafka_topic, kafka_partition, kafka_offset)
    and holds any of ``REPLAY_FIELDS``; a NULL keeps the original value.  Each
    payload is parsed once (the audit shape drops fields).  The result has bronze's
    shape with ``speed_int``, ``event_ts``, ``processed_at``, ``quarantine_reason``,
    ``corrected`` and the new ``dq_status``.
    """
    base = quarantined.select(*MESSAGE_KEY, "raw_payload", "kafka_timestamp", "quarantine_reason",
                              F.inline(F.array(F.from_json("raw_payload", S.PAYLOAD_SCHEMA))))
    fix_cols = [c for c in REPLAY_FIELDS if c in corrections.columns]
    fixes = corrections.select(*MESSAGE_KEY, *[F.col(c).alias(f"fix_{c}") for c in fix_cols])
    joined = base.join(fixes, MESSAGE_KEY, "left")
    corrected = F.lit(False)
    for c in fix_cols:
        corrected = corrected | F.col(f"fix_{c}").isNotNull()
    overlaid = (joined.withColumn("corrected", corrected)
                .withColumns({c: F.coalesce(F.col(f"fix_{c}"), F.col(c)) for c in fix_cols})
                .drop(*(f"fix_{c}" for c in fix_cols)))
    typed = with_typed_fields(overlaid, F.col("kafka_timestamp"))
    return typed.withColumn("dq_status", dq_status(dq_rules(clock)))


def dlq_replay(quarantined: DataFrame, corrections: DataFrame,
               clock: Column | str = "kafka_timestamp") -> DataFrame:
    """One row per quarantined message: its old reason and its ``replay_status`` (Q11)."""
    return replay(quarantined, corrections, clock).select(
        *MESSAGE_KEY, "quarantine_reason", "vehicle_id", "speed", "event_time", "corrected",
        F.col("dq_status").alias("replay_status"))


def replay_failed(replayed: DataFrame) -> DataFrame:
    """Replayed messages that still fail, in the audit shape with their new reason."""
    return quarantine(replayed)


def replay_clean(replayed: DataFrame, silver: DataFrame) -> DataFrame:
    """Replayed messages that pass now, in silver's shape, first arrival per key, without
    keys that silver has already."""
    from urbanpulse.operators import silver as clean

    fresh = clean.dedup_first(clean.valid_rows(replayed))
    fresh = fresh.join(silver.select(*clean.DEDUP_KEYS), clean.DEDUP_KEYS, "left_anti")
    return clean.enrich(fresh).drop("quarantine_reason", "corrected")


def sensor_vehicle_corrections(quarantined: DataFrame, clean: DataFrame) -> DataFrame:
    """Vehicle id corrections learned from clean data: for each quarantined row
    missing its vehicle id, the vehicle last seen (by event time, then
    arrival) on the same sensor in the clean table.

    The lookup has one row per sensor (partial aggregate).  A broken sensor may
    send most of the quarantine, so its rows are dealt over ``SALTS`` keys and the
    lookup is repeated for each.
    """
    last_on_sensor = (clean.where(F.col("sensor_id").isNotNull())
                      .groupBy("sensor_id")
                      .agg(F.max_by("vehicle_id", F.struct("event_ts", "kafka_timestamp", "kafka_partition",
                                                           "kafka_offset")).alias("vehicle_id"))
                      .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    missing = (quarantined.where(F.col("quarantine_reason") == S.STATUS_NO_VEHICLE)
               .select(*MESSAGE_KEY, F.inline(F.array(F.from_json("raw_payload", S.PAYLOAD_SCHEMA))))
               .select(*MESSAGE_KEY, "sensor_id",
                       F.pmod(F.xxhash64(*MESSAGE_KEY), F.lit(SALTS)).cast("int").alias("salt")))
    return missing.join(last_on_sensor, ["sensor_id", "salt"]).drop("sensor_id", "salt")


# ---------------------------------------------------------------------------
# Data tests (dbt-style), reported as failure counts per check.
# ---------------------------------------------------------------------------
def check_not_null(df: DataFrame, columns: Sequence[str], model: str) -> DataFrame:
    """Rows with a NULL per column, one global pass (Q12)."""
    agg = df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.select(
        F.lit(model).alias("model"),
        F.expr(f"stack({len(columns)}, {stack}) as (column_name, failures)"),
    ).select("model", F.lit("not_null").alias("test"), "column_name", "failures")


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count (Q13 detail)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_unique(df: DataFrame, key: str | Sequence[str], model: str) -> DataFrame:
    """Number of duplicated values of a key of one or more columns (Q13)."""
    keys = [key] if isinstance(key, str) else list(key)
    return unique_violations(df, keys).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit("unique").alias("test"),
        F.lit(",".join(keys)).alias("column_name"), "failures")


def check_accepted_values(df: DataFrame, column: str, values: Sequence, model: str) -> DataFrame:
    """Rows whose value is outside the accepted set; NULL is not counted (Q14)."""
    c = F.col(column)
    return df.agg(count_if(c.isNotNull() & ~c.isin(*values)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit("accepted_values").alias("test"),
        F.lit(column).alias("column_name"), "failures")


def dlq_sla_audit(evaluated: DataFrame, max_pct: float = S.DLQ_SLA_MAX_PCT) -> DataFrame:
    """Quarantine rate against the SLA, one conditional global pass (Q15)."""
    agg = evaluated.agg(
        F.count(F.lit(1)).alias("total_events"),
        count_if(F.col("dq_status") != S.STATUS_VALID).alias("quarantined_events"),
    )
    rate = pct("quarantined_events", "total_events")
    return agg.select(
        "total_events", "quarantined_events",
        round_half_up(rate, 2).alias("quarantine_rate_pct"),
        F.lit(max_pct).alias("sla_max_pct"),
        F.coalesce(rate > max_pct, F.lit(False)).alias("sla_breached"),
    )


# Rule of the SLA matrix -> the status it counts as a failure.
SLA_RULE_STATUS = {
    "Speed Range Check": S.STATUS_SPEED,
    "Timestamp Freshness": S.STATUS_FUTURE,
    "Payload Integrity": S.STATUS_CORRUPT,
    "Vehicle Identifier": S.STATUS_NO_VEHICLE,
    "Watermark Latency": S.STATUS_LATENCY,
}


def dq_sla_matrix(evaluated: DataFrame) -> DataFrame:
    """Measured pass rate of each rule against its target (Q16).

    One conditional aggregate over the rows (five counters), then ``stack``
    to long form and a literal join-free lookup of the targets.
    """
    counters = [count_if(F.col("dq_status") == SLA_RULE_STATUS[rule]).alias(f"f{i}")
                for i, (rule, _, _) in enumerate(S.DQ_SLA_TARGETS)]
    agg = evaluated.agg(F.count(F.lit(1)).alias("total_events"), *counters)
    parts = ", ".join(
        f"'{rule}', '{bound}', CAST({target} AS DOUBLE), f{i}"
        for i, (rule, bound, target) in enumerate(S.DQ_SLA_TARGETS))
    long = agg.select("total_events", F.expr(
        f"stack({len(S.DQ_SLA_TARGETS)}, {parts}) as (dq_rule, target_boundary, sla_target_pct, failed_events)"))
    pass_rate = F.lit(100.0) - F.coalesce(pct("failed_events", "total_events"), F.lit(0.0))
    return long.select(
        "dq_rule", "target_boundary", "sla_target_pct", "failed_events", "total_events",
        round_half_up(pass_rate, 3).alias("pass_rate_pct"),
        (pass_rate >= F.col("sla_target_pct")).alias("meets_target"),
    )
