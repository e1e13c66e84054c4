"""Schemas, domains and label tables of the telemetry model.

All literal values below are fixed values of the data contract: they must
stay exactly as written for results to match (zone / road / weather codes,
dimension labels, rule thresholds, scoring weights).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Message payload contract (JSON document inside the message value).
# `speed` is text on purpose: dirty values such as "FAST" must survive
# parsing so the quality rules can see and report them.
# ---------------------------------------------------------------------------
PAYLOAD_SCHEMA = T.StructType([
    T.StructField("vehicle_id", T.StringType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("city_zone", T.StringType()),
    T.StructField("speed", T.StringType()),
    T.StructField("congestion_level", T.IntegerType()),
    T.StructField("weather", T.StringType()),
    T.StructField("vehicle_type", T.StringType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("event_time", T.StringType()),
    T.StructField("raw", T.StringType()),
])
PAYLOAD_FIELDS = [f.name for f in PAYLOAD_SCHEMA.fields]

# Columns of a message source (the Kafka source schema, minus key/type).
MESSAGE_SCHEMA = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

ENVELOPE_COLUMNS = ["raw_payload", "kafka_timestamp", "kafka_topic",
                    "kafka_partition", "kafka_offset", "ingestion_ts"]
BRONZE_COLUMNS = ENVELOPE_COLUMNS + PAYLOAD_FIELDS

# ---------------------------------------------------------------------------
# Domains.
# ---------------------------------------------------------------------------
ZONES = ["CBD", "TECHPARK", "TRAINSTATION", "AIRPORT", "HARBOR", "SUBURB"]
ROADS = ["R100", "R200", "R300", "R400", "R500"]
WEATHERS = ["CLEAR", "RAIN", "FOG", "STORM", "SNOW"]
VEHICLE_TYPES = ["SEDAN", "SUV", "TRUCK", "BUS", "MOTORCYCLE", "EV_TAXI"]
CONGESTION_LEVELS = [1, 2, 3, 4, 5]

# ---------------------------------------------------------------------------
# Dimension labels.  Each table is (label, codes) in the order
# the first-match CASE evaluates them; the last entry's codes are None and
# mean "everything else".
# ---------------------------------------------------------------------------
ZONE_TYPE_GOLD = [
    ("Commercial / Financial", ["CBD"]),
    ("IT & Technology Hub", ["TECHPARK"]),
    ("Multimodal Transit Hub", ["AIRPORT", "TRAINSTATION", "HARBOR"]),
    ("Residential & Suburban", None),
]
ZONE_TYPE_MART = [
    ("Commercial / Financial Center", ["CBD"]),
    ("IT & Technology Hub", ["TECHPARK"]),
    ("Multimodal Transit Hub", ["AIRPORT", "TRAINSTATION", "HARBOR"]),
    ("Residential & Suburban District", None),
]
ZONE_RISK_TIER = [
    ("CRITICAL", ["CBD", "AIRPORT", "TRAINSTATION"]),
    ("HIGH", ["TECHPARK"]),
    ("MEDIUM", ["HARBOR"]),
    ("LOW", None),
]
ROAD_TYPE = [
    ("Expressway / Highway", ["R100", "R200"]),
    ("Major Arterial Road", ["R300"]),
    ("Urban Collector Road", ["R400"]),
    ("Local Access Street", None),
]
ROAD_SPEED_LIMIT_KMH = [
    (100, ["R100", "R200"]),
    (60, ["R300"]),
    (50, ["R400"]),
    (40, None),
]
ROAD_LANES = [
    (4, ["R100", "R200"]),
    (3, ["R300"]),
    (2, ["R400"]),
    (1, None),
]

# ---------------------------------------------------------------------------
# Quality rule names and thresholds.
# ---------------------------------------------------------------------------
STATUS_VALID = "VALID"
STATUS_CORRUPT = "CORRUPT_PAYLOAD"
STATUS_NO_VEHICLE = "MISSING_VEHICLE_ID"
STATUS_BAD_TS = "MISSING_OR_INVALID_TIMESTAMP"
STATUS_SPEED = "SPEED_OUT_OF_BOUNDS"
STATUS_FUTURE = "FUTURE_TIMESTAMP_ANOMALY"
STATUS_LATENCY = "EXCESSIVE_LATENCY"
CORRUPT_MARKER = "CORRUPT"
CORRUPT_PREFIX = "###"
SPEED_MIN_KMH = 0
SPEED_MAX_KMH = 180
FUTURE_TOLERANCE = "10 minutes"
MAX_LATENCY = "3 hours"
DEDUP_WATERMARK = "15 minutes"
DLQ_SLA_MAX_PCT = 5.0

# Per-rule pass-rate targets, percent (rule, boundary text, target).
DQ_SLA_TARGETS = [
    ("Speed Range Check", "0 km/h <= speed <= 180 km/h", 99.5),
    ("Timestamp Freshness", "ts <= now() + 10 mins", 99.9),
    ("Payload Integrity", "Valid UTF-8 JSON schema", 99.99),
    ("Vehicle Identifier", "Non-null UUID string", 99.0),
    ("Watermark Latency", "ts >= now() - 3 hours", 98.5),
]

# ---------------------------------------------------------------------------
# Feature thresholds.
# ---------------------------------------------------------------------------
PEAK_HOUR_RANGES = [(8, 11), (17, 20)]
LOW_SPEED_BELOW = 30
MEDIUM_SPEED_BELOW = 70

# ---------------------------------------------------------------------------
# Webhook defaults.
# ---------------------------------------------------------------------------
INGEST_REQUIRED = ["vehicle_id", "road_id", "city_zone", "speed", "congestion_level"]
INGEST_DEFAULTS = {"weather": "CLEAR", "vehicle_type": "SEDAN",
                   "latitude": 12.9716, "longitude": 77.5946}

# ---------------------------------------------------------------------------
# Congestion scoring weights.
# ---------------------------------------------------------------------------
SCORE_ZONE_BASE_LOAD = {"CBD": 3.2, "TECHPARK": 2.8, "TRAINSTATION": 2.9,
                        "AIRPORT": 2.4, "HARBOR": 1.8, "SUBURB": 1.4}
SCORE_ZONE_DEFAULT = 2.0
SCORE_ROAD_FACTOR = {"R100": 0.7, "R200": 0.75, "R300": 1.1, "R400": 1.3, "R500": 1.5}
SCORE_ROAD_DEFAULT = 1.0
SCORE_WEATHER_WEIGHT = {"CLEAR": 1.0, "RAIN": 1.4, "FOG": 1.6, "STORM": 2.1, "SNOW": 2.4}
SCORE_WEATHER_DEFAULT = 1.0
SCORE_PEAK_WEEKDAY = 1.45
SCORE_WEEKEND = 0.85
SCORE_RISK_BANDS = [
    ("CRITICAL", 4.2, "Activate dynamic signal retiming & divert arterial traffic"),
    ("SEVERE", 3.4, "Dispatch traffic marshals & trigger variable message signs (VMS)"),
    ("MODERATE", 2.4, "Monitor ramp meters and maintain standard signal cycles"),
    ("LOW", None, "Optimal network flow. No intervention required"),
]
ANOMALY_SPEEDING_RATIO = 1.35
ANOMALY_CRITICAL_RATIO = 1.6
ANOMALY_SCORE_SCALE_KMH = 50.0
ANOMALY_STOP_SPEED_BELOW = 10
ANOMALY_STOP_MAX_LEVEL = 2
ANOMALY_STOP_SCORE = 0.82
ANOMALY_NORMAL_SCORE = 0.05
ANOMALY_SPEEDING = "EXCESSIVE_SPEED_VIOLATION"
ANOMALY_STOP = "UNEXPECTED_STOP_OR_BREAKDOWN"

# Zone live-status thresholds on average congestion.
ZONE_STATUS_BANDS = [("SEVERE_CONGESTION", 4.0), ("MODERATE_FLOW", 2.5), ("OPTIMAL_FLOW", None)]
