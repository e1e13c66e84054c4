"""Scoring golden values and anomaly examples."""

import pytest
from pyspark.sql import functions as F

from urbanpulse.functions import scoring as M

GOLDEN = [
    ("CBD", "R300", "CLEAR", 9, False, 1.0, 3.45, 52.7, "SEVERE"),
    ("CBD", "R300", "STORM", 9, False, 1.0, 4.99, 97.1, "CRITICAL"),
    ("CBD", "R300", "RAIN", 9, False, 1.2, 4.89, 96.4, "CRITICAL"),
    ("CBD", "R100", "RAIN", 9, False, 1.1, 2.85, 23.0, "MODERATE"),
    ("SUBURB", "R100", "CLEAR", 12, False, 1.0, 1.00, 0.5, "LOW"),
    ("AIRPORT", "R400", "FOG", 18, True, 1.0, 2.18, 6.4, "LOW"),
    ("TECHPARK", "R200", "SNOW", 23, False, 1.0, 2.49, 11.9, "MODERATE"),
    ("UNKNOWN", "R999", "HAIL", 6, False, 1.0, 1.38, 1.2, "LOW"),
]


def test_golden_predictions(spark):
    df = spark.createDataFrame([g[:6] for g in GOLDEN],
                               "zone string, road string, weather string, hour int, weekend boolean, density double")
    lv = M.predicted_congestion_level("zone", "road", "weather", "hour", "weekend", F.col("density"))
    out = df.select(lv.alias("lv")).select("lv", M.gridlock_probability("lv").alias("p"),
                                           M.risk_category("lv").alias("c")).collect()
    assert [(r.lv, r.p, r.c) for r in out] == [(g[6], g[7], g[8]) for g in GOLDEN]


def test_case_insensitive_lookup(spark):
    df = spark.createDataFrame([("cbd", "r300", "clear", 9, False)], "z string, r string, w string, h int, k boolean")
    assert df.select(M.predicted_congestion_level("z", "r", "w", "h", "k")).first()[0] == 3.45


def test_storm_above_clear_and_ranges(spark):
    rows = [(z, "R300", w, 9, False) for z in ("CBD", "TECHPARK", "AIRPORT", "SUBURB") for w in ("CLEAR", "RAIN", "STORM")]
    df = spark.createDataFrame(rows, "z string, r string, w string, h int, k boolean")
    out = df.select("z", "w", M.predicted_congestion_level("z", "r", "w", "h", "k").alias("lv"))
    out = out.select("z", "w", "lv", M.gridlock_probability("lv").alias("p")).collect()
    by = {(r.z, r.w): r for r in out}
    for r in out:
        assert 1.0 <= r.lv <= 5.0 and 0.0 <= r.p <= 100.0
    for z in ("CBD", "TECHPARK", "AIRPORT", "SUBURB"):
        assert by[(z, "STORM")].lv > by[(z, "CLEAR")].lv


@pytest.mark.parametrize("speed,limit,level,kind,severity", [
    (60, 60, 2, None, "NORMAL"),
    (110, 60, 2, "EXCESSIVE_SPEED_VIOLATION", "CRITICAL"),
    (85, 60, 3, "EXCESSIVE_SPEED_VIOLATION", "HIGH"),
    (4, 60, 1, "UNEXPECTED_STOP_OR_BREAKDOWN", "HIGH"),
    (4, 60, 3, None, "NORMAL"),
])
def test_anomaly(spark, speed, limit, level, kind, severity):
    df = spark.createDataFrame([(speed, limit, level)], "s int, l int, c int")
    r = df.select(M.anomaly_struct("s", "l", "c").alias("v")).select("v.*").first()
    assert r.anomaly_type == kind and r.severity == severity and r.is_anomaly == (kind is not None)
    if kind == "EXCESSIVE_SPEED_VIOLATION":
        assert r.anomaly_score == min(1.0, round((speed - limit) / 50.0, 2))


def test_contributions_ignore_weekend(spark):
    df = spark.createDataFrame([("CBD", "R300", "RAIN", 9)], "z string, r string, w string, h int")
    m = df.select(M.feature_contributions("z", "r", "w", "h")).first()[0]
    assert m == {"Zone Base Load": 0.96, "Rush Hour Surge": 0.58, "Weather Severity": 0.2,
                 "Road Capacity Impact": 0.04}
