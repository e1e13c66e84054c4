"""The hourly rollup as mergeable partial states.

A state is one row per zone, road, weather, date and hour of one load: counts, sums, sum of
squares, least and greatest speed, and two sketches (vehicles: HyperLogLog; speeds: KLL
quantiles).  Every column merges, so a load of late rows adds its own states and nothing of
an hour that was rolled up before is read again.  Sums are whole numbers: merged results
equal a recomputation from the raw rows exactly; only the sketches are estimates.

The table is partitioned by date and load.  Writing a load again replaces its partitions, so a
load that is repeated after a failure counts once.  ``compact_states`` folds all loads into
one, row for row the same report.

Every step is a partial and a final aggregate: a hot hour arrives in the shuffle as one row
per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanpulse.functions.columns import count_if, pct, round_half_up
from urbanpulse.operators.rollups import A1_KEYS, with_limits

STATE_KEYS = ["city_zone", "road_id", "weather", "event_date", "event_hour"]
#: 2 ** 12 registers: a standard error of 1.04 / 64 = 1.6 % for the number of vehicles.
VEHICLE_LG_K = 12
#: Rank error of about 1.7 % (single-sided, 99 % of the time) for speed quantiles.
SPEED_K = 200
_SUMS = ["flow", "speeds", "speed_sum", "speed_squares", "levels", "level_sum", "high", "violations"]
_EDGES = {"min_speed": F.min, "max_speed": F.max}


def partial_states(fact: DataFrame, dim_road: DataFrame) -> DataFrame:
    """States of the rows of one load."""
    speed, level = F.col("speed_kmh").cast("long"), F.col("congestion_level").cast("long")
    return with_limits(fact, dim_road).groupBy(*STATE_KEYS).agg(
        F.count("vehicle_id").alias("flow"), F.count(speed).alias("speeds"), F.sum(speed).alias("speed_sum"),
        F.sum(speed * speed).alias("speed_squares"), F.min("speed_kmh").alias("min_speed"),
        F.max("speed_kmh").alias("max_speed"), F.count(level).alias("levels"), F.sum(level).alias("level_sum"),
        count_if(level >= 4).alias("high"), count_if(F.col("speed_kmh") > F.col("speed_limit_kmh")).alias("violations"),
        F.hll_sketch_agg("vehicle_id", VEHICLE_LG_K).alias("vehicles_hll"),
        F.kll_sketch_agg_bigint(speed, SPEED_K).alias("speeds_kll"))


def merge_states(states: DataFrame, keys: list[str]) -> DataFrame:
    """States of any loads and any finer keys, merged to one row per ``keys``."""
    return states.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in _SUMS), *(f(c).alias(c) for c, f in _EDGES.items()),
        F.hll_union_agg("vehicles_hll").alias("vehicles_hll"),
        F.kll_merge_agg_bigint("speeds_kll", SPEED_K).alias("speeds_kll"))


def write_load(states: DataFrame, path: str, load_id: str) -> None:
    """Add the states of a load; a load with this id that was written before is replaced."""
    (states.withColumn("load_id", F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date", "load_id").parquet(path))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def compact_states(states: DataFrame, path: str, load_id: str = "compacted") -> None:
    """Fold all loads into one, in a table of its own."""
    merged = merge_states(states, STATE_KEYS).hint("rebalance", "event_date")
    merged.withColumn("load_id", F.lit(load_id)).write.partitionBy("event_date", "load_id").parquet(path)


def _average(total: str, count: str) -> Column:
    return F.try_divide(F.col(total).cast("double"), F.col(count))


def hourly_from_states(states: DataFrame) -> DataFrame:
    """The hourly rollup (A1) from states, whatever loads its hours came in."""
    merged = merge_states(states, A1_KEYS)
    return merged.select(
        *A1_KEYS, F.col("flow").alias("total_vehicle_flow"),
        round_half_up(_average("speed_sum", "speeds"), 2).alias("avg_speed_kmh"),
        F.col("min_speed").alias("min_speed_kmh"), F.col("max_speed").alias("max_speed_kmh"),
        round_half_up(_average("level_sum", "levels"), 2).alias("avg_congestion_level"),
        F.col("high").alias("high_congestion_event_count"), F.col("violations").alias("speed_violation_count"),
        round_half_up(pct("high", "flow"), 1).alias("high_congestion_pct"))


def deviation() -> Column:
    """Sample standard deviation of the speeds of a merged state; NULL below two speeds."""
    n, total = F.col("speeds").cast("double"), F.col("speed_sum").cast("double")
    spread = F.col("speed_squares").cast("double") - F.try_divide(total * total, n)
    return F.when(n > 1, F.sqrt(F.greatest(F.try_divide(spread, n - 1), F.lit(0.0))))


def weather_from_states(states: DataFrame) -> DataFrame:
    """The weather report (A5) from states, with its deviation."""
    merged = merge_states(states, ["weather"])
    return merged.select(
        "weather", F.col("flow").alias("observation_volume"),
        round_half_up(_average("speed_sum", "speeds"), 2).alias("avg_speed_kmh"),
        round_half_up(_average("level_sum", "levels"), 2).alias("avg_congestion_level"),
        round_half_up(deviation(), 2).alias("speed_variance"))


def estimates(states: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct vehicles and speed quartiles per ``keys``, from the sketches."""
    merged = merge_states(states, keys)
    return merged.select(
        *keys, F.hll_sketch_estimate("vehicles_hll").alias("vehicles"),
        *(F.kll_sketch_get_quantile_bigint("speeds_kll", F.lit(p)).alias(name)
          for name, p in (("speed_q1", 0.25), ("speed_median", 0.5), ("speed_q3", 0.75))))
