"""Deterministic telemetry message stream derived from the ``events`` table.

The test tables carry generic click events, not traffic telemetry.  This
module maps every event (plus a copy of some of them) to one traffic message
with the fault mix of a dirty sensor feed: exact duplicates, missing and
blank vehicle ids, non-numeric / negative / too-high speeds, bad timestamps,
events from the future, very late arrivals, corrupt and non-JSON payloads and
schema drift.  The mapping is a pure projection (plus one ``explode`` for the
duplicates), so it scales with ``events`` and never shuffles.

Output columns follow the Kafka source schema: ``value, timestamp, topic,
partition, offset``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The fault mix.  Each fault hits the events whose id is a
# multiple of the given modulus; the first matching rule wins within a column.
DUPLICATE_EVERY = 31
NULL_VEHICLE_EVERY = 41
BLANK_VEHICLE_EVERY = 83
NULL_SPEED_EVERY = 37
TEXT_SPEED_EVERY = 43
NEGATIVE_SPEED_EVERY = 47
BAD_TIME_EVERY = 67
FUTURE_EVENT_EVERY = 59
VERY_LATE_EVERY = 53
LATE_EVERY = 29
CORRUPT_EVERY = 61
NOT_JSON_EVERY = 97
DRIFT_EVERY = 19
TOPIC = "traffic-topic"
TOPIC_PARTITIONS = 3
DUPLICATE_OFFSET_SHIFT = 1_000_000_000
CORRUPT_TEXT = '{"raw":"###CORRUPT_SENSOR_PAYLOAD_HEX_DEADBEEF###"}'
NOT_JSON_TEXT = "not json"
DRIFT_SUFFIX = ',"road_surface_temp_c":12.5,"firmware_version":"v3.8.1-rc2"'
ZONE_BY_USER_MOD6 = ["CBD", "AIRPORT", "TECHPARK", "SUBURB", "TRAINSTATION", "HARBOR"]
WEATHER_BY_EVENT_TYPE = {"view": "CLEAR", "click": "RAIN", "purchase": "FOG",
                         "error": "STORM", "signup": "SNOW"}
WEATHER_OTHER = "SNOW"
VEHICLE_BY_ID_MOD6 = ["SEDAN", "SUV", "TRUCK", "BUS", "MOTORCYCLE", "EV_TAXI"]


def _every(c: Column, n: int) -> Column:
    return (c % n) == 0


def _pick(c: Column, values: list[str]) -> Column:
    """values[c % len(values)] as a CASE (no array literal per row)."""
    m = c % len(values)
    expr = F.when(m == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:-1], start=1):
        expr = expr.when(m == i, F.lit(v))
    return expr.otherwise(F.lit(values[-1]))


def _json_str(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))


def telemetry_messages(events: DataFrame) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value) -> message stream."""
    eid = F.col("event_id")
    uid = F.col("user_id")
    base = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.explode(F.when(_every(eid, DUPLICATE_EVERY), F.array(F.lit(0), F.lit(1)))
                  .otherwise(F.array(F.lit(0)))).alias("dup"),
    )

    vid = (F.when(_every(eid, NULL_VEHICLE_EVERY), F.lit(None).cast("string"))
           .when(_every(eid, BLANK_VEHICLE_EVERY), F.lit(""))
           .otherwise(F.concat(F.lit("VEH-"), uid.cast("string"))))
    rid = F.concat(F.lit("R"), ((F.lit(1) + eid % 5) * 100).cast("string"))
    zone = _pick(uid, ZONE_BY_USER_MOD6)
    spd = (F.when(_every(eid, NULL_SPEED_EVERY), F.lit("null"))
           .when(_every(eid, TEXT_SPEED_EVERY), F.lit('"FAST"'))
           .when(_every(eid, NEGATIVE_SPEED_EVERY), F.lit("-30"))
           .otherwise(F.floor("value").cast("int").cast("string")))
    lvl = (F.lit(1) + (eid + uid) % 5).cast("string")
    wx = F.col("event_type")
    weather = None
    for k, v in WEATHER_BY_EVENT_TYPE.items():
        weather = F.when(wx == k, F.lit(v)) if weather is None else weather.when(wx == k, F.lit(v))
    weather = weather.otherwise(F.lit(WEATHER_OTHER))
    vtype = _pick(eid, VEHICLE_BY_ID_MOD6)
    lat3 = (F.lit(12900) + eid % 300).cast("string")
    lon3 = (F.lit(77500) + eid % 200).cast("string")
    shifted = F.col("ts") + F.when(_every(eid, FUTURE_EVENT_EVERY), F.expr("INTERVAL 30 MINUTES")) \
        .otherwise(F.expr("INTERVAL 0 MINUTES"))
    etime = (F.when(_every(eid, BAD_TIME_EVERY), F.lit("not-a-time"))
             .otherwise(F.concat(F.replace(shifted.cast("string"), F.lit(" "), F.lit("T")),
                                 F.lit("+00:00"))))
    body = F.concat(
        F.lit('{"vehicle_id":'),
        F.coalesce(F.concat(F.lit('"'), vid, F.lit('"')), F.lit("null")),
        F.lit(","), _json_str("road_id", rid),
        F.lit(","), _json_str("city_zone", zone),
        F.lit(',"speed":'), spd,
        F.lit(',"congestion_level":'), lvl,
        F.lit(","), _json_str("weather", weather),
        F.lit(","), _json_str("vehicle_type", vtype),
        F.lit(","), _json_str("sensor_id", F.concat(F.lit("SNS-"), (F.lit(1000) + eid % 9000).cast("string"))),
        F.lit(',"latitude":'), F.substring(lat3, 1, 2), F.lit("."), F.substring(lat3, 3, 10),
        F.lit(',"longitude":'), F.substring(lon3, 1, 2), F.lit("."), F.substring(lon3, 3, 10),
        F.lit(","), _json_str("event_time", etime),
        F.when(_every(eid, DRIFT_EVERY), F.lit(DRIFT_SUFFIX)).otherwise(F.lit("")),
        F.lit("}"),
    )
    value = (F.when(_every(eid, CORRUPT_EVERY), F.lit(CORRUPT_TEXT))
             .when(_every(eid, NOT_JSON_EVERY), F.lit(NOT_JSON_TEXT))
             .otherwise(body))
    arrival = F.col("ts") + (F.when(_every(eid, VERY_LATE_EVERY), F.expr("INTERVAL 4 HOURS"))
                             .when(_every(eid, LATE_EVERY), F.expr("INTERVAL 90 MINUTES"))
                             .otherwise(F.expr("INTERVAL 20 SECONDS")))
    return base.select(
        value.alias("value"),
        arrival.cast("timestamp").alias("timestamp"),
        F.lit(TOPIC).alias("topic"),
        (eid % TOPIC_PARTITIONS).cast("int").alias("partition"),
        (eid + F.col("dup") * DUPLICATE_OFFSET_SHIFT).cast("long").alias("offset"),
    )
