"""Scalar features of a telemetry row (typed casts and derived flags).

Each function maps input columns to one output column; none needs a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.functions.columns import col_of, flag, label_case


def typed_speed(speed: str | Column = "speed") -> Column:
    """Speed text -> int, NULL for non-numeric text.

    ANSI mode makes a plain cast of "FAST" abort the job, so both steps are
    ``try_cast``; going through double keeps "65.7" as 65 (truncation), and
    NaN / overflow become NULL.
    """
    return col_of(speed).try_cast("double").try_cast("int")


def typed_event_ts(event_time: str | Column = "event_time") -> Column:
    """ISO-8601 text (offset allowed) -> timestamp, NULL if unparsable."""
    return F.try_to_timestamp(col_of(event_time))


def event_hour(ts: str | Column = "event_ts") -> Column:
    """Hour of day 0..23 in the session zone."""
    return F.hour(col_of(ts))


def is_weekend(ts: str | Column = "event_ts") -> Column:
    """1 on Saturday/Sunday (Spark: Sunday=1, Saturday=7) (P5)."""
    return flag(F.dayofweek(col_of(ts)).isin(1, 7))


def peak_flag(hour: str | Column = "event_hour") -> Column:
    """1 if the hour is in a rush-hour range, both ends inclusive."""
    h = col_of(hour)
    cond = None
    for lo, hi in S.PEAK_HOUR_RANGES:
        part = h.between(lo, hi)
        cond = part if cond is None else (cond | part)
    return flag(cond)


def speed_band(speed: str | Column = "speed_int") -> Column:
    """LOW_SPEED below 30, MEDIUM_SPEED below 70, else HIGH_SPEED."""
    s = col_of(speed)
    return (F.when(s < S.LOW_SPEED_BELOW, F.lit("LOW_SPEED"))
            .when(s < S.MEDIUM_SPEED_BELOW, F.lit("MEDIUM_SPEED"))
            .otherwise(F.lit("HIGH_SPEED")))


def congestion_risk_score(level: str | Column = "congestion_level") -> Column:
    """3 for level >= 4, 2 for level 3, else 1 (NULL level -> 1)."""
    lv = col_of(level)
    return F.when(lv >= 4, F.lit(3)).when(lv == 3, F.lit(2)).otherwise(F.lit(1))


def zone_type(zone: str | Column = "city_zone", table=S.ZONE_TYPE_GOLD) -> Column:
    return label_case(zone, table)


def zone_risk_tier(zone: str | Column = "city_zone") -> Column:
    return label_case(zone, S.ZONE_RISK_TIER)


def road_type(road: str | Column = "road_id") -> Column:
    return label_case(road, S.ROAD_TYPE)


def road_speed_limit(road: str | Column = "road_id") -> Column:
    return label_case(road, S.ROAD_SPEED_LIMIT_KMH)


def road_lanes(road: str | Column = "road_id") -> Column:
    return label_case(road, S.ROAD_LANES)


def is_speeding(speed: str | Column = "speed_kmh", limit: str | Column = "speed_limit_kmh") -> Column:
    """1 if speed exceeds the limit; a NULL limit (unknown road) gives 0."""
    return flag(col_of(speed) > col_of(limit))


def period_type(peak: str | Column = "peak_flag") -> Column:
    """RUSH_HOUR for peak rows, NORMAL otherwise."""
    return F.when(col_of(peak) == 1, F.lit("RUSH_HOUR")).otherwise(F.lit("NORMAL"))


def zone_status(avg_congestion: str | Column) -> Column:
    """Live zone status from the average congestion level."""
    a = col_of(avg_congestion)
    expr = None
    default = None
    for label, bound in S.ZONE_STATUS_BANDS:
        if bound is None:
            default = F.lit(label)
            continue
        expr = F.when(a >= bound, F.lit(label)) if expr is None else expr.when(a >= bound, F.lit(label))
    return expr.otherwise(default)
