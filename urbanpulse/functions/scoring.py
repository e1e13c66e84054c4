"""Congestion scoring and speed anomaly rules as column expressions (M1-M6).

The model is a closed-form heuristic, so it needs no UDF: the weight tables
become CASE lookups and the formula plain arithmetic, evaluated inside
whole-stage codegen.  Rounding is half-up on the decimal value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.functions.columns import col_of, lookup, round_half_up

CONTRIBUTION_KEYS = ["Zone Base Load", "Rush Hour Surge", "Weather Severity", "Road Capacity Impact"]


def _is_peak(hour: Column) -> Column:
    cond = None
    for lo, hi in S.PEAK_HOUR_RANGES:
        part = hour.between(lo, hi)
        cond = part if cond is None else (cond | part)
    return cond


def zone_base_load(zone) -> Column:
    return lookup(F.upper(col_of(zone)), S.SCORE_ZONE_BASE_LOAD, S.SCORE_ZONE_DEFAULT)


def road_capacity_factor(road) -> Column:
    return lookup(F.upper(col_of(road)), S.SCORE_ROAD_FACTOR, S.SCORE_ROAD_DEFAULT)


def weather_weight(weather) -> Column:
    return lookup(F.upper(col_of(weather)), S.SCORE_WEATHER_WEIGHT, S.SCORE_WEATHER_DEFAULT)


def peak_multiplier(hour, weekend) -> Column:
    """1.45 on weekday rush hours, 0.85 on weekends, else 1.0."""
    h, w = col_of(hour), col_of(weekend).cast("boolean")
    return (F.when(_is_peak(h) & ~w, F.lit(S.SCORE_PEAK_WEEKDAY))
            .when(w, F.lit(S.SCORE_WEEKEND))
            .otherwise(F.lit(1.0)))


def predicted_congestion_level(zone, road, weather, hour, weekend, density=1.0) -> Column:
    """clamp((base*0.45 + (hour%12)*0.08) * road * weather^0.5 * peak * density, 1, 5), 2 dp (M1)."""
    h = col_of(hour)
    density = F.lit(density) if isinstance(density, (int, float)) else col_of(density)
    raw = ((zone_base_load(zone) * F.lit(0.45) + (h % 12) * F.lit(0.08))
           * road_capacity_factor(road)
           * F.pow(weather_weight(weather), F.lit(0.5))
           * peak_multiplier(h, weekend)
           * density)
    return round_half_up(F.greatest(F.lit(1.0), F.least(F.lit(5.0), raw)), 2)


def gridlock_probability(level) -> Column:
    """Logistic probability in percent, 1 dp (M2)."""
    lv = col_of(level)
    return round_half_up(F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.2) * (lv - F.lit(3.4)))) * F.lit(100), 1)


def risk_category(level) -> Column:
    """CRITICAL >= 4.2, SEVERE >= 3.4, MODERATE >= 2.4, else LOW (M3)."""
    lv = col_of(level)
    expr = None
    default = None
    for name, bound, _ in S.SCORE_RISK_BANDS:
        if bound is None:
            default = F.lit(name)
            continue
        expr = F.when(lv >= bound, F.lit(name)) if expr is None else expr.when(lv >= bound, F.lit(name))
    return expr.otherwise(default)


def recommended_action(category) -> Column:
    """Fixed action sentence per category (M4)."""
    c = col_of(category)
    expr = None
    for name, _, action in S.SCORE_RISK_BANDS:
        expr = F.when(c == name, F.lit(action)) if expr is None else expr.when(c == name, F.lit(action))
    return expr


def feature_contributions(zone, road, weather, hour) -> Column:
    """map<string,double> of the four factor contributions, 2 dp (M5).

    The rush-hour entry follows the hour only (weekends are not considered).
    """
    h = col_of(hour)
    surge = F.when(_is_peak(h), F.lit(S.SCORE_PEAK_WEEKDAY)).otherwise(F.lit(1.0))
    values = [
        round_half_up(zone_base_load(zone) * F.lit(0.3), 2),
        round_half_up(surge * F.lit(0.4), 2),
        round_half_up((weather_weight(weather) - F.lit(1.0)) * F.lit(0.5), 2),
        round_half_up((road_capacity_factor(road) - F.lit(1.0)) * F.lit(0.4), 2),
    ]
    pairs = []
    for k, v in zip(CONTRIBUTION_KEYS, values):
        pairs += [F.lit(k), v]
    return F.create_map(*pairs)


def anomaly_struct(speed, limit, level) -> Column:
    """Speed anomaly verdict as a struct (is_anomaly, anomaly_score,
    anomaly_type, severity) (M6)."""
    s = col_of(speed).cast("double")
    lim = col_of(limit).cast("double")
    lv = col_of(level)
    speeding = s > lim * F.lit(S.ANOMALY_SPEEDING_RATIO)
    stop = (s < F.lit(S.ANOMALY_STOP_SPEED_BELOW)) & (lv <= F.lit(S.ANOMALY_STOP_MAX_LEVEL))
    over_score = round_half_up(F.least(F.lit(1.0), (s - lim) / F.lit(S.ANOMALY_SCORE_SCALE_KMH)), 2)
    return (F.when(speeding, F.struct(
                F.lit(True).alias("is_anomaly"), over_score.alias("anomaly_score"),
                F.lit(S.ANOMALY_SPEEDING).alias("anomaly_type"),
                F.when(s > lim * F.lit(S.ANOMALY_CRITICAL_RATIO), F.lit("CRITICAL"))
                 .otherwise(F.lit("HIGH")).alias("severity")))
            .when(stop, F.struct(
                F.lit(True).alias("is_anomaly"), F.lit(S.ANOMALY_STOP_SCORE).alias("anomaly_score"),
                F.lit(S.ANOMALY_STOP).alias("anomaly_type"), F.lit("HIGH").alias("severity")))
            .otherwise(F.struct(
                F.lit(False).alias("is_anomaly"), F.lit(S.ANOMALY_NORMAL_SCORE).alias("anomaly_score"),
                F.lit(None).cast("string").alias("anomaly_type"), F.lit("NORMAL").alias("severity"))))
