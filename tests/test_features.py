"""Boundary values of the scalar features and the quality rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.functions import features as X
from urbanpulse.operators import quality


def _one(spark, col, value, ddl):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(col(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("hour,expected", [(2, 0), (7, 0), (8, 1), (9, 1), (11, 1), (12, 0), (14, 0),
                                           (16, 0), (17, 1), (19, 1), (20, 1), (21, 0), (23, 0)])
def test_peak_flag(spark, hour, expected):
    assert _one(spark, X.peak_flag, hour, "int") == expected


@pytest.mark.parametrize("speed,band", [(15, "LOW_SPEED"), (29, "LOW_SPEED"), (30, "MEDIUM_SPEED"),
                                        (65, "MEDIUM_SPEED"), (69, "MEDIUM_SPEED"), (70, "HIGH_SPEED"),
                                        (120, "HIGH_SPEED")])
def test_speed_band(spark, speed, band):
    assert _one(spark, X.speed_band, speed, "int") == band


@pytest.mark.parametrize("level,score", [(None, 1), (1, 1), (2, 1), (3, 2), (4, 3), (5, 3)])
def test_risk_score(spark, level, score):
    assert _one(spark, X.congestion_risk_score, level, "int") == score


@pytest.mark.parametrize("zone,label", [("CBD", "Commercial / Financial"), ("TECHPARK", "IT & Technology Hub"),
                                        ("AIRPORT", "Multimodal Transit Hub"), ("SUBURB", "Residential & Suburban")])
def test_zone_type(spark, zone, label):
    assert _one(spark, X.zone_type, zone, "string") == label


@pytest.mark.parametrize("text,value", [("65", 65), ("65.7", 65), ("FAST", None), ("NaN", None),
                                        ("1e12", None), (None, None), ("-30", -30)])
def test_typed_speed_is_ansi_safe(spark, text, value):
    assert _one(spark, X.typed_speed, text, "string") == value


def test_typed_event_ts(spark):
    assert _one(spark, X.typed_event_ts, "not-a-time", "string") is None
    got = _one(spark, X.typed_event_ts, "2024-01-01T10:00:00+02:00", "string")
    assert got == dt.datetime(2024, 1, 1, 8, 0, 0)


def test_weekend(spark):
    # 2024-01-06 is a Saturday, 2024-01-07 a Sunday, 2024-01-08 a Monday.
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 12),) for d in (6, 7, 8)], "t timestamp")
    assert [r[0] for r in df.select(X.is_weekend("t")).collect()] == [1, 1, 0]


CLOCK = dt.datetime(2024, 1, 10, 12, 0, 0)


def _status(spark, raw_payload, vehicle_id, speed, event_time, raw=None):
    row = [(raw_payload, vehicle_id, speed, event_time, raw, CLOCK)]
    df = spark.createDataFrame(row, "raw_payload string, vehicle_id string, speed string, "
                                    "event_time string, raw string, clock timestamp")
    return quality.evaluate(df, clock="clock").first()["dq_status"]


def _iso(t):
    return t.strftime("%Y-%m-%dT%H:%M:%S+00:00")


@pytest.mark.parametrize("args,expected", [
    (("{}", "V123", "65", _iso(CLOCK)), S.STATUS_VALID),
    (("{}", None, "65", _iso(CLOCK)), S.STATUS_NO_VEHICLE),
    (("{}", "", "65", _iso(CLOCK)), S.STATUS_NO_VEHICLE),
    (("{}", "  ", "65", _iso(CLOCK)), S.STATUS_NO_VEHICLE),
    (("{}", "V1", "-30", _iso(CLOCK)), S.STATUS_SPEED),
    (("{}", "V1", "-1", _iso(CLOCK)), S.STATUS_SPEED),
    (("{}", "V1", "0", _iso(CLOCK)), S.STATUS_VALID),
    (("{}", "V1", "180", _iso(CLOCK)), S.STATUS_VALID),
    (("{}", "V1", "181", _iso(CLOCK)), S.STATUS_SPEED),
    (("{}", "V1", "250", _iso(CLOCK)), S.STATUS_SPEED),
    (("{}", "V1", "FAST", _iso(CLOCK)), S.STATUS_SPEED),
    (("###CORRUPT_PAYLOAD###", "V1", "65", _iso(CLOCK)), S.STATUS_CORRUPT),
    (("###x", "V1", "65", _iso(CLOCK)), S.STATUS_CORRUPT),
    (("{}", "V1", "65", "nope"), S.STATUS_BAD_TS),
    (("{}", "V1", "65", _iso(CLOCK + dt.timedelta(hours=2))), S.STATUS_FUTURE),
    (("{}", "V1", "65", _iso(CLOCK + dt.timedelta(minutes=10))), S.STATUS_VALID),
    (("{}", "V1", "65", _iso(CLOCK + dt.timedelta(minutes=10, seconds=1))), S.STATUS_FUTURE),
    (("{}", "V1", "65", _iso(CLOCK - dt.timedelta(hours=3))), S.STATUS_VALID),
    (("{}", "V1", "65", _iso(CLOCK - dt.timedelta(hours=3, seconds=1))), S.STATUS_LATENCY),
    ((None, "V1", "65", _iso(CLOCK)), S.STATUS_VALID),
])
def test_rule_chain(spark, args, expected):
    assert _status(spark, *args) == expected


def test_raw_field_marks_corrupt(spark):
    assert _status(spark, "{}", "V1", "65", _iso(CLOCK), raw="x") == S.STATUS_CORRUPT
