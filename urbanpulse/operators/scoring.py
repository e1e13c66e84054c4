"""Scoring operators over tables (M1-M7).

``score_observations`` scores every fact row from its own context (zone,
road, weather, hour, weekend).  ``velocity_anomalies`` joins the road
dimension for the limit.  ``scenario_grid`` is the what-if table: every
(zone, road, weather) of the contract's domains, expanded to all 24 hours x
weekday/weekend by generators, so the grid never needs a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.functions import scoring as M


def with_prediction(df: DataFrame, zone="city_zone", road="road_id", weather="weather",
                    hour="event_hour", weekend="is_weekend", density=1.0,
                    contributions: bool = False) -> DataFrame:
    """Add predicted level, gridlock probability, category and action (M1-M4),
    plus the contribution map when asked (M5)."""
    out = df.withColumn("predicted_congestion_level",
                        M.predicted_congestion_level(zone, road, weather, hour, weekend, density))
    out = out.withColumns({
        "gridlock_probability_pct": M.gridlock_probability("predicted_congestion_level"),
        "risk_category": M.risk_category("predicted_congestion_level"),
    }).withColumn("recommended_action", M.recommended_action("risk_category"))
    if contributions:
        out = out.withColumn("feature_contributions", M.feature_contributions(zone, road, weather, hour))
    return out


def score_observations(fact: DataFrame, density: float = 1.0) -> DataFrame:
    """Predicted congestion for every observation, next to the observed level."""
    base = fact.select("vehicle_id", "event_ts", "city_zone", "road_id", "weather",
                       "event_hour", "is_weekend", "congestion_level")
    return with_prediction(base, density=density)


def contribution_rows(fact: DataFrame) -> DataFrame:
    """The contribution map of each observation, one row per factor (M5)."""
    base = fact.select("vehicle_id", "event_ts",
                       M.feature_contributions("city_zone", "road_id", "weather", "event_hour").alias("m"))
    return base.select("vehicle_id", "event_ts",
                       F.explode("m").alias("feature", "contribution"))


def velocity_anomalies(fact: DataFrame, dim_road: DataFrame) -> DataFrame:
    """Speed anomaly verdict per observation against its road's limit (M6)."""
    joined = fact.join(dim_road.select("road_id", "speed_limit_kmh"), "road_id", "inner")
    verdict = M.anomaly_struct("speed_kmh", "speed_limit_kmh", "congestion_level")
    return joined.select("vehicle_id", "event_ts", "road_id", "speed_kmh", "speed_limit_kmh",
                         "congestion_level", verdict.alias("v")).select(
        "vehicle_id", "event_ts", "road_id", "speed_kmh", "speed_limit_kmh", "congestion_level",
        "v.is_anomaly", "v.anomaly_score", "v.anomaly_type", "v.severity")


def scenario_grid(fact: DataFrame, density: float = 1.0) -> DataFrame:
    """What-if predictions for every (zone, road, weather) of the contract's domains at every
    hour, weekday and weekend, with the number of observations behind it (M7).

    The cells are generated by ``explode`` (7,200 whatever the input); the
    observations are one grouped pass, joined to the cells.
    """
    seen = (fact.groupBy("city_zone", "road_id", "weather")
            .agg(F.count(F.lit(1)).alias("observations")))

    def domain(values):
        return F.explode(F.array(*(F.lit(v) for v in values)))

    cells = (fact.sparkSession.range(1).select(domain(S.ZONES).alias("city_zone"))
             .withColumn("road_id", domain(S.ROADS)).withColumn("weather", domain(S.WEATHERS)))
    grid = (cells.join(seen, ["city_zone", "road_id", "weather"], "left")
            .withColumn("observations", F.coalesce("observations", F.lit(0)).cast("bigint"))
            .withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
            .withColumn("is_weekend", F.explode(F.array(F.lit(False), F.lit(True)))))
    return with_prediction(grid, hour="hour", weekend="is_weekend", density=density)
