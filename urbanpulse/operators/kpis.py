"""KPI reports over the star schema and the quarantine.

Every report is a grouped aggregate (partial + final) over the fact or the
quarantine.  Window functions and ordering run only over the aggregated
rows (a few dozen), never over raw rows.  Shares of a total are a window
``sum`` over the aggregated rows instead of a second scan for the scalar
subquery total.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanpulse import schemas as S
from urbanpulse.functions import features as X
from urbanpulse.functions.columns import count_if, flag, pct, round_half_up

def _all():
    """Window over the whole (small, already aggregated) result."""
    return Window.partitionBy()


def _share(count_col: str, total: Column) -> Column:
    return round_half_up(pct(count_col, total), 2)


def kpi_top_congested_zones(fact: DataFrame, dim_zone: DataFrame, k: int = 5) -> DataFrame:
    """Top-k zones by average congestion during rush hours."""
    joined = fact.where(F.col("peak_flag") == 1).join(dim_zone, "city_zone", "inner")
    out = (joined.groupBy("city_zone", "zone_type", "traffic_risk_tier")
           .agg(F.count("vehicle_id").alias("total_vehicles_observed"),
                round_half_up(F.avg("speed_kmh"), 1).alias("avg_speed_kmh"),
                round_half_up(F.avg("congestion_level"), 2).alias("avg_congestion_level"),
                count_if(F.col("congestion_level") >= 4).alias("gridlock_events_count")))
    return out.orderBy(F.col("avg_congestion_level").desc(), F.col("city_zone")).limit(k)


def kpi_speeding_by_road(fact: DataFrame, dim_road: DataFrame) -> DataFrame:
    """Speeding count, rate and mean excess speed per road."""
    joined = fact.join(dim_road, "road_id", "inner")
    out = (joined.groupBy("road_id", "road_type", "speed_limit_kmh")
           .agg(F.count("vehicle_id").alias("total_sampled_vehicles"),
                count_if(F.col("speed_kmh") > F.col("speed_limit_kmh")).alias("speeding_count"),
                round_half_up(F.avg(F.col("speed_kmh") - F.col("speed_limit_kmh")), 2).alias("avg_speed_delta"))
           .withColumn("speeding_violation_rate_pct",
                       round_half_up(pct("speeding_count", "total_sampled_vehicles"), 2)))
    return out.orderBy(F.col("speeding_violation_rate_pct").desc(), "road_id")


def kpi_weather_impact(fact: DataFrame) -> DataFrame:
    """Volume, mean speed and congestion, sample stddev of speed per weather (A5)."""
    out = (fact.groupBy("weather")
           .agg(F.count("vehicle_id").alias("observation_volume"),
                round_half_up(F.avg("speed_kmh"), 2).alias("avg_speed_kmh"),
                round_half_up(F.avg("congestion_level"), 2).alias("avg_congestion_level"),
                round_half_up(F.stddev_samp("speed_kmh"), 2).alias("speed_variance")))
    return out.orderBy("avg_speed_kmh", "weather")


def kpi_hourly_curve(fact: DataFrame) -> DataFrame:
    """Hourly curve by hour and rush flag with share of volume."""
    hourly = (fact.groupBy("event_hour", "peak_flag")
              .agg(F.count("vehicle_id").alias("vehicle_count"),
                   F.avg("congestion_level").alias("avg_congestion"),
                   F.avg("speed_kmh").alias("avg_speed")))
    return hourly.select(
        "event_hour",
        X.period_type("peak_flag").alias("period_type"),
        "vehicle_count",
        round_half_up("avg_congestion", 2).alias("avg_congestion"),
        round_half_up("avg_speed", 2).alias("avg_speed_kmh"),
        _share("vehicle_count", F.sum("vehicle_count").over(_all())).alias("pct_of_daily_volume"),
    ).orderBy("event_hour", "period_type")


def kpi_dlq_root_cause(dlq: DataFrame) -> DataFrame:
    """Quarantine volume, share and first/last detection per reason."""
    out = (dlq.groupBy("quarantine_reason")
           .agg(F.count(F.lit(1)).alias("total_rejected_events"),
                F.min("quarantine_ts").alias("first_detected_at"),
                F.max("quarantine_ts").alias("last_detected_at")))
    return out.withColumn(
        "pct_of_total_anomalies",
        _share("total_rejected_events", F.sum("total_rejected_events").over(_all())),
    ).orderBy(F.col("total_rejected_events").desc(), "quarantine_reason")


def kpi_fleet_mix(fact: DataFrame) -> DataFrame:
    """Fleet count, means and share of all fact rows per vehicle type."""
    out = (fact.groupBy("vehicle_type")
           .agg(F.count("vehicle_id").alias("fleet_count"),
                F.count(F.lit(1)).alias("_rows"),
                round_half_up(F.avg("speed_kmh"), 2).alias("avg_fleet_speed"),
                round_half_up(F.avg("congestion_level"), 2).alias("avg_zone_congestion")))
    return (out.withColumn("fleet_share_pct", _share("fleet_count", F.sum("_rows").over(_all())))
            .drop("_rows")
            .orderBy(F.col("fleet_count").desc(), "vehicle_type"))


def banner_kpis(fact: DataFrame, dlq: DataFrame) -> DataFrame:
    """Headline numbers: clean, quarantined, total, pass rate, mean speed,
    high-congestion share (A9).  One pass over the union of both tables."""
    rows = (fact.select(F.lit(1).alias("is_clean"), "speed_kmh", "congestion_level")
            .unionByName(dlq.select(F.lit(0).alias("is_clean"),
                                    F.lit(None).cast("int").alias("speed_kmh"),
                                    F.lit(None).cast("int").alias("congestion_level"))))
    agg = rows.agg(count_if(F.col("is_clean") == 1).alias("total_clean"),
                   count_if(F.col("is_clean") == 0).alias("total_quarantined"),
                   F.avg("speed_kmh").alias("_speed"),
                   F.avg(F.when(F.col("is_clean") == 1, flag(F.col("congestion_level") >= 4))).alias("_high"))
    total = F.col("total_clean") + F.col("total_quarantined")
    return agg.select(
        "total_clean", "total_quarantined", total.alias("total_events"),
        F.coalesce(round_half_up(pct("total_clean", total), 2), F.lit(100.0)).alias("dq_pass_rate_pct"),
        F.coalesce(round_half_up("_speed", 2), F.lit(0.0)).alias("avg_velocity_kmh"),
        F.coalesce(round_half_up(F.col("_high") * 100, 2), F.lit(0.0)).alias("high_congestion_pct"),
    )


def zone_summary(fact: DataFrame) -> DataFrame:
    """Mean speed, mean congestion and rows per zone (A10)."""
    return (fact.groupBy("city_zone")
            .agg(round_half_up(F.avg("speed_kmh"), 4).alias("avg_speed"),
                 round_half_up(F.avg("congestion_level"), 4).alias("avg_congestion"),
                 F.count("vehicle_id").alias("vehicle_count"))
            .orderBy("city_zone"))


def speed_band_distribution(fact: DataFrame) -> DataFrame:
    """Rows per speed band."""
    return fact.groupBy("speed_band").agg(F.count(F.lit(1)).alias("rows")).orderBy("speed_band")


def dlq_reason_counts(evaluated: DataFrame) -> DataFrame:
    """Rows per quarantine reason with the DLQ total and the pass rate.

    One grouped count over the evaluated rows (<= 7 groups), then window
    sums over those few rows.
    """
    per_status = evaluated.groupBy("dq_status").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(_all())
    bad = F.sum(F.when(F.col("dq_status") != S.STATUS_VALID, F.col("n")).otherwise(0)).over(_all())
    good = F.sum(F.when(F.col("dq_status") == S.STATUS_VALID, F.col("n")).otherwise(0)).over(_all())
    return (per_status
            .select(F.col("dq_status").alias("quarantine_reason"),
                    F.col("n").alias("rows"),
                    bad.cast("bigint").alias("total_quarantined_events"),
                    F.coalesce(round_half_up(pct(good, total), 2), F.lit(100.0)).alias("sla_pass_rate_pct"))
            .where(F.col("quarantine_reason") != S.STATUS_VALID)
            .orderBy(F.col("rows").desc(), "quarantine_reason"))


def hourly_congestion_trend(fact: DataFrame) -> DataFrame:
    """Mean congestion by hour and rush flag."""
    return (fact.groupBy("event_hour", "peak_flag")
            .agg(round_half_up(F.avg("congestion_level"), 4).alias("congestion_level"))
            .orderBy("event_hour", "peak_flag"))


def vehicle_type_counts(fact: DataFrame) -> DataFrame:
    """Rows per vehicle type."""
    return (fact.groupBy("vehicle_type").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), "vehicle_type"))


def preset_top_zones(fact: DataFrame, k: int = 5) -> DataFrame:
    """Rush-hour mean congestion and volume per zone, top k."""
    return (fact.where(F.col("peak_flag") == 1).groupBy("city_zone")
            .agg(round_half_up(F.avg("congestion_level"), 4).alias("avg_congestion"),
                 F.count("vehicle_id").alias("total_vehicles"))
            .orderBy(F.col("avg_congestion").desc(), "city_zone").limit(k))


def preset_violation_by_type(fact: DataFrame, dim_road: DataFrame) -> DataFrame:
    """Observations and speeding count by road type and limit."""
    joined = fact.join(dim_road, "road_id", "inner")
    return (joined.groupBy("road_type", "speed_limit_kmh")
            .agg(F.count("vehicle_id").alias("total_obs"),
                 count_if(F.col("speed_kmh") > F.col("speed_limit_kmh")).alias("speeding_count"))
            .orderBy("road_type", "speed_limit_kmh"))


def preset_weather_speed(fact: DataFrame) -> DataFrame:
    """Mean speed per weather."""
    return (fact.groupBy("weather").agg(round_half_up(F.avg("speed_kmh"), 4).alias("avg_speed"))
            .orderBy("weather"))


def eda_weather_stats(fact: DataFrame) -> DataFrame:
    """Mean and sample std of speed, mean congestion per weather."""
    return (fact.groupBy("weather")
            .agg(round_half_up(F.avg("speed_kmh"), 2).alias("avg_speed_kmh"),
                 round_half_up(F.stddev_samp("speed_kmh"), 2).alias("speed_stddev"),
                 round_half_up(F.avg("congestion_level"), 2).alias("avg_congestion"))
            .orderBy("weather"))


def eda_speed_boxplot(fact: DataFrame, keys: Sequence[str] = ("city_zone", "peak_flag"),
                      value: str = "speed_kmh") -> DataFrame:
    """Box-plot numbers per group: quartiles, 1.5 IQR whiskers, outliers.

    Speeds are integers in a bounded range (0..180 after the quality rules),
    so one partial-aggregated histogram per group, (group, speed) -> rows,
    carries all the information: exact quartiles come from ``percentile``
    with a frequency argument over the histogram, and the whiskers and
    outlier count from a second pass over the histogram joined to the
    per-group quartiles.  The raw rows are scanned once and never joined.
    """
    keys = list(keys)
    hist = fact.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n"))
    q = (hist.groupBy(*keys)
         .agg(F.percentile(F.col(value), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"),
              F.sum("n").alias("observations"))
         .select(*keys, "observations",
                 F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3")))
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_fence = F.col("q1") - F.lit(1.5) * F.col("iqr")
    hi_fence = F.col("q3") + F.lit(1.5) * F.col("iqr")
    v = F.col(value)
    inside = (v >= lo_fence) & (v <= hi_fence)
    whiskers = (hist.join(q, keys, "inner")
                .groupBy(*keys, "observations", "q1", "median", "q3", "iqr")
                .agg(F.min(F.when(inside, v)).alias("lower_whisker"),
                     F.max(F.when(inside, v)).alias("upper_whisker"),
                     F.sum(F.when(~inside, F.col("n")).otherwise(0)).cast("bigint").alias("outliers")))
    return whiskers.select(
        *keys, "observations",
        round_half_up("q1", 4).alias("q1"), round_half_up("median", 4).alias("median"),
        round_half_up("q3", 4).alias("q3"), round_half_up("iqr", 4).alias("iqr"),
        "lower_whisker", "upper_whisker", "outliers",
    ).orderBy(*keys)


def map_centroid(fact: DataFrame) -> DataFrame:
    """Mean latitude and longitude."""
    return fact.agg(round_half_up(F.avg("latitude"), 6).alias("center_latitude"),
                    round_half_up(F.avg("longitude"), 6).alias("center_longitude"),
                    F.count("latitude").alias("points"))


def congestion_heat_grid(fact: DataFrame, resolution_deg: float = 0.01) -> DataFrame:
    """Congestion-weighted point density per lat/lon grid cell."""
    res = F.lit(resolution_deg)
    cells = fact.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        F.floor(F.col("latitude") / res).alias("lat_cell"),
        F.floor(F.col("longitude") / res).alias("lon_cell"),
        "congestion_level")
    return (cells.groupBy("lat_cell", "lon_cell")
            .agg(F.count(F.lit(1)).alias("points"),
                 F.sum("congestion_level").cast("bigint").alias("congestion_weight"))
            .withColumns({
                "cell_latitude": round_half_up((F.col("lat_cell") + 0.5) * res, 6),
                "cell_longitude": round_half_up((F.col("lon_cell") + 0.5) * res, 6),
            })
            .orderBy("lat_cell", "lon_cell"))


def zone_status(fact: DataFrame, dim_zone: DataFrame, since: Column | None = None,
                approximate: bool = False) -> DataFrame:
    """Live status per zone (P16): active vehicles, mean speed and congestion,
    status band, zone type and tier.

    ``active_vehicles`` is an exact distinct count (Spark plans it as two
    aggregation levels keyed by (zone, vehicle), so a hot zone is spread
    over many tasks); ``approximate=True`` switches to HyperLogLog++ with a
    fixed-size buffer per zone.
    """
    rows = fact if since is None else fact.where(F.col("event_ts") >= since)
    distinct = (F.approx_count_distinct("vehicle_id") if approximate
                else F.count_distinct("vehicle_id"))
    agg = (rows.groupBy("city_zone")
           .agg(distinct.alias("active_vehicles"),
                F.avg("speed_kmh").alias("_speed"),
                F.avg("congestion_level").alias("_level")))
    return (agg.join(dim_zone.select("city_zone", "zone_type", "traffic_risk_tier"), "city_zone", "inner")
            .select("city_zone", "zone_type", "traffic_risk_tier", "active_vehicles",
                    round_half_up("_speed", 1).alias("avg_speed_kmh"),
                    round_half_up("_level", 2).alias("current_congestion_level"),
                    X.zone_status("_level").alias("status"))
            .orderBy("city_zone"))


def zone_detail(fact: DataFrame, dim_zone: DataFrame, zone_id: str) -> DataFrame:
    """P16 for one zone, case-insensitive; an unknown zone gives no row.
    The literal predicate is pushed to the scan of the fact."""
    key = zone_id.upper()
    return zone_status(fact.where(F.col("city_zone") == F.lit(key)),
                       dim_zone.where(F.col("city_zone") == F.lit(key)))


def ingest_defaults(records: DataFrame) -> DataFrame:
    """Webhook contract as a batch step.

    Required fields must be present (speed and congestion as integers);
    optional ones get their defaults.  Every record gets ``ingest_status``
    ACCEPTED or REJECTED and, when rejected, the first missing field.
    """
    speed = X.typed_speed("speed")
    level = F.col("congestion_level")
    checks = [("vehicle_id", F.col("vehicle_id").isNull()),
              ("road_id", F.col("road_id").isNull()),
              ("city_zone", F.col("city_zone").isNull()),
              ("speed", speed.isNull()),
              ("congestion_level", level.isNull())]
    reason = None
    for name, cond in checks:
        reason = F.when(cond, F.lit(f"missing {name}")) if reason is None else reason.when(cond, F.lit(f"missing {name}"))
    d = S.INGEST_DEFAULTS
    return records.select(
        "kafka_topic", "kafka_partition", "kafka_offset",
        "vehicle_id", "road_id", "city_zone",
        speed.alias("speed"), level.alias("congestion_level"),
        F.coalesce(F.col("weather"), F.lit(d["weather"])).alias("weather"),
        F.coalesce(F.col("vehicle_type"), F.lit(d["vehicle_type"])).alias("vehicle_type"),
        F.coalesce(F.col("latitude"), F.lit(d["latitude"])).alias("latitude"),
        F.coalesce(F.col("longitude"), F.lit(d["longitude"])).alias("longitude"),
        F.when(reason.isNull(), F.lit("ACCEPTED")).otherwise(F.lit("REJECTED")).alias("ingest_status"),
        reason.alias("reject_reason"),
    )


def filter_options(fact: DataFrame) -> DataFrame:
    """Sorted distinct zone, road and weather values.

    One scan: each row is unpivoted into three (option, value) pairs and a
    single partial-aggregated ``distinct`` runs over them.
    """
    pairs = fact.select(F.explode(F.array(
        F.struct(F.lit("city_zone").alias("option_name"), F.col("city_zone").alias("option_value")),
        F.struct(F.lit("road_id").alias("option_name"), F.col("road_id").alias("option_value")),
        F.struct(F.lit("weather").alias("option_name"), F.col("weather").alias("option_value")),
    )).alias("p")).select("p.option_name", "p.option_value")
    return (pairs.where(F.col("option_value").isNotNull()).distinct()
            .orderBy("option_name", "option_value"))


def dlq_recent(dlq: DataFrame, n: int = 25) -> DataFrame:
    """Newest ``n`` quarantined rows (O3): a top-k, planned as
    TakeOrderedAndProject (each task keeps its own top n)."""
    return (dlq.select("vehicle_id", "road_id", "city_zone", "raw_speed",
                       "quarantine_reason", "quarantine_ts",
                       "kafka_topic", "kafka_partition", "kafka_offset")
            .orderBy(F.col("quarantine_ts").desc(), F.col("kafka_offset").desc(),
                     F.col("kafka_partition").desc(), F.col("kafka_topic").desc())
            .limit(n))


def filter_multi(fact: DataFrame, zones: Sequence[str] | None = None,
                 roads: Sequence[str] | None = None,
                 weathers: Sequence[str] | None = None) -> DataFrame:
    """Membership filters on zone, road and weather (F1); literal IN lists
    are pushed down to the Parquet scan."""
    cond = F.lit(True)
    for column, values in (("city_zone", zones), ("road_id", roads), ("weather", weathers)):
        if values is not None:
            cond = cond & F.col(column).isin(*values)
    return fact.where(cond)
