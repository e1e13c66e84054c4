"""Registered reports for scoring (M1-M7) and table maintenance (V1-V6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanpulse.operators import gold, maintenance as V, scoring
from urbanpulse.plans.catalog import _scratch
from urbanpulse.plans.oracle import rnd, with_base

REPORTS: dict = {}


def report(name, sql):
    def deco(fn):
        REPORTS[name] = (fn, sql)
        return fn
    return deco


FACT_SQL = ", ".join(gold.FACT_COLUMNS)


# The weights are written out here, not taken from the operators' tables: a wrong
# weight on either side shows up as a difference.
def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _zone_load(c: str) -> str:
    return (f"(CASE upper({c}) WHEN 'CBD' THEN {_d('3.2')} WHEN 'TECHPARK' THEN {_d('2.8')} "
            f"WHEN 'TRAINSTATION' THEN {_d('2.9')} WHEN 'AIRPORT' THEN {_d('2.4')} "
            f"WHEN 'HARBOR' THEN {_d('1.8')} WHEN 'SUBURB' THEN {_d('1.4')} ELSE {_d('2.0')} END)")


def _road_factor(c: str) -> str:
    return (f"(CASE upper({c}) WHEN 'R100' THEN {_d('0.7')} WHEN 'R200' THEN {_d('0.75')} WHEN 'R300' THEN {_d('1.1')} "
            f"WHEN 'R400' THEN {_d('1.3')} WHEN 'R500' THEN {_d('1.5')} ELSE {_d('1.0')} END)")


def _weather_weight(c: str) -> str:
    return (f"(CASE upper({c}) WHEN 'CLEAR' THEN {_d('1.0')} WHEN 'RAIN' THEN {_d('1.4')} WHEN 'FOG' THEN {_d('1.6')} "
            f"WHEN 'STORM' THEN {_d('2.1')} WHEN 'SNOW' THEN {_d('2.4')} ELSE {_d('1.0')} END)")


def _score_sql(zone: str, road: str, weather: str, hour: str, weekend: str, density: str = "1.0") -> str:
    peak = f"({hour} BETWEEN 8 AND 11 OR {hour} BETWEEN 17 AND 20)"
    mult = (f"(CASE WHEN {peak} AND NOT CAST({weekend} AS BOOLEAN) THEN {_d('1.45')} "
            f"WHEN CAST({weekend} AS BOOLEAN) THEN {_d('0.85')} ELSE {_d('1.0')} END)")
    raw = (f"(({_zone_load(zone)} * {_d('0.45')} + ({hour} % 12) * {_d('0.08')}) * {_road_factor(road)}"
           f" * pow({_weather_weight(weather)}, {_d('0.5')}) * {mult} * {_d(density)})")
    return rnd(f"greatest({_d('1.0')}, least({_d('5.0')}, {raw}))", 2)


def _prob_sql(level: str) -> str:
    return rnd(f"CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(CAST(-2.2 AS DOUBLE) * ({level} - CAST(3.4 AS DOUBLE)))) * 100", 1)


_CATEGORY = ("CASE WHEN lv >= 4.2 THEN 'CRITICAL' WHEN lv >= 3.4 THEN 'SEVERE' "
             "WHEN lv >= 2.4 THEN 'MODERATE' ELSE 'LOW' END")
_ACTION = ("WHEN 'CRITICAL' THEN 'Activate dynamic signal retiming & divert arterial traffic' "
           "WHEN 'SEVERE' THEN 'Dispatch traffic marshals & trigger variable message signs (VMS)' "
           "WHEN 'MODERATE' THEN 'Monitor ramp meters and maintain standard signal cycles' "
           "WHEN 'LOW' THEN 'Optimal network flow. No intervention required'")

_LEVEL = _score_sql("city_zone", "road_id", "weather", "event_hour", "is_weekend")
_LEVEL_DENSE = _score_sql("city_zone", "road_id", "weather", "event_hour", "is_weekend", "1.2")
_SCORED = """
scored0 AS (SELECT vehicle_id, event_ts, city_zone, road_id, weather, event_hour, is_weekend,
  congestion_level, {level} AS lv FROM fact),
scored AS (SELECT *, {category} AS cat FROM scored0)"""
_SCORED_CTE = _SCORED.format(level=_LEVEL, category=_CATEGORY)


@report("predict_congestion", with_base(f"""
SELECT vehicle_id, event_ts, city_zone, road_id, weather, event_hour, is_weekend, congestion_level,
  lv AS predicted_congestion_level, {_prob_sql('lv')} AS gridlock_probability_pct,
  cat AS risk_category, CASE cat {_ACTION} END AS recommended_action
FROM scored""", extra_ctes=_SCORED_CTE))
def _predict(lh):
    return scoring.score_observations(lh.fact)


@report("predict_congestion_dense", with_base(f"""
SELECT vehicle_id, event_ts, city_zone, road_id, weather, event_hour, is_weekend, congestion_level,
  lv AS predicted_congestion_level, {_prob_sql('lv')} AS gridlock_probability_pct,
  cat AS risk_category, CASE cat {_ACTION} END AS recommended_action
FROM scored""", extra_ctes=_SCORED.format(level=_LEVEL_DENSE, category=_CATEGORY)))
def _predict_dense(lh):
    """Scores at a vehicle density of 1.2, the default of a scoring request."""
    return scoring.score_observations(lh.fact, density=1.2)


@report("gridlock_probability", with_base(f"""
SELECT vehicle_id, event_ts, lv AS predicted_congestion_level, {_prob_sql('lv')} AS gridlock_probability_pct
FROM scored""", extra_ctes=_SCORED_CTE))
def _gridlock(lh):
    return scoring.score_observations(lh.fact).select(
        "vehicle_id", "event_ts", "predicted_congestion_level", "gridlock_probability_pct")


@report("risk_category", with_base("""
SELECT risk_category, COUNT(*) AS observations FROM (SELECT cat AS risk_category FROM scored)
GROUP BY risk_category""", extra_ctes=_SCORED_CTE))
def _risk(lh):
    return (scoring.score_observations(lh.fact).groupBy("risk_category")
            .agg(F.count(F.lit(1)).alias("observations")))


@report("recommended_action", with_base(f"""
SELECT DISTINCT cat AS risk_category, CASE cat {_ACTION} END AS recommended_action FROM scored""",
    extra_ctes=_SCORED_CTE))
def _action(lh):
    return scoring.score_observations(lh.fact).select("risk_category", "recommended_action").distinct()


def _contrib_sql() -> str:
    base, roadf, w = _zone_load("city_zone"), _road_factor("road_id"), _weather_weight("weather")
    surge = ("(CASE WHEN event_hour BETWEEN 8 AND 11 OR event_hour BETWEEN 17 AND 20 "
             "THEN CAST(1.45 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END)")
    parts = [("Zone Base Load", f"{base} * CAST(0.3 AS DOUBLE)"),
             ("Rush Hour Surge", f"{surge} * CAST(0.4 AS DOUBLE)"),
             ("Weather Severity", f"({w} - CAST(1.0 AS DOUBLE)) * CAST(0.5 AS DOUBLE)"),
             ("Road Capacity Impact", f"({roadf} - CAST(1.0 AS DOUBLE)) * CAST(0.4 AS DOUBLE)")]
    return "\nUNION ALL\n".join(
        f"SELECT vehicle_id, event_ts, '{k}' AS feature, {rnd(e, 2)} AS contribution FROM fact"
        for k, e in parts)


@report("feature_contributions", with_base(_contrib_sql()))
def _contrib(lh):
    return scoring.contribution_rows(lh.fact)


@report("velocity_anomaly", with_base(f"""
SELECT f.vehicle_id, f.event_ts, f.road_id, f.speed_kmh, r.speed_limit_kmh, f.congestion_level,
  CASE WHEN f.speed_kmh > r.speed_limit_kmh * CAST(1.35 AS DOUBLE) THEN true
       WHEN f.speed_kmh < 10 AND f.congestion_level <= 2 THEN true ELSE false END AS is_anomaly,
  CASE WHEN f.speed_kmh > r.speed_limit_kmh * CAST(1.35 AS DOUBLE)
         THEN {rnd('least(CAST(1.0 AS DOUBLE), (CAST(f.speed_kmh AS DOUBLE) - r.speed_limit_kmh) / CAST(50.0 AS DOUBLE))', 2)}
       WHEN f.speed_kmh < 10 AND f.congestion_level <= 2 THEN CAST(0.82 AS DOUBLE)
       ELSE CAST(0.05 AS DOUBLE) END AS anomaly_score,
  CASE WHEN f.speed_kmh > r.speed_limit_kmh * CAST(1.35 AS DOUBLE) THEN 'EXCESSIVE_SPEED_VIOLATION'
       WHEN f.speed_kmh < 10 AND f.congestion_level <= 2 THEN 'UNEXPECTED_STOP_OR_BREAKDOWN' END AS anomaly_type,
  CASE WHEN f.speed_kmh > r.speed_limit_kmh * CAST(1.35 AS DOUBLE)
         THEN CASE WHEN f.speed_kmh > r.speed_limit_kmh * CAST(1.6 AS DOUBLE) THEN 'CRITICAL' ELSE 'HIGH' END
       WHEN f.speed_kmh < 10 AND f.congestion_level <= 2 THEN 'HIGH' ELSE 'NORMAL' END AS severity
FROM fact f JOIN dim_road r ON f.road_id = r.road_id"""))
def _velocity(lh):
    return scoring.velocity_anomalies(lh.fact, lh.dim_road)


_GRID_LEVEL = _score_sql("z.zone", "r.road", "x.weather", "h.hour", "w.is_weekend")


@report("scenario_grid", with_base(f"""
SELECT city_zone, road_id, weather, CAST(observations AS BIGINT) AS observations, hour, is_weekend,
  lv AS predicted_congestion_level, {_prob_sql('lv')} AS gridlock_probability_pct,
  {_CATEGORY} AS risk_category, CASE {_CATEGORY} {_ACTION} END AS recommended_action
FROM (SELECT z.zone AS city_zone, r.road AS road_id, x.weather, coalesce(c.observations, 0) AS observations,
             CAST(h.hour AS INTEGER) AS hour, w.is_weekend, {_GRID_LEVEL} AS lv
      FROM (VALUES ('CBD'), ('AIRPORT'), ('TECHPARK'), ('SUBURB'), ('TRAINSTATION'), ('HARBOR')) z(zone)
      CROSS JOIN (VALUES ('R100'), ('R200'), ('R300'), ('R400'), ('R500')) r(road)
      CROSS JOIN (VALUES ('CLEAR'), ('RAIN'), ('FOG'), ('STORM'), ('SNOW')) x(weather)
      CROSS JOIN (SELECT CAST(range AS INTEGER) AS hour FROM range(24)) h
      CROSS JOIN (VALUES (false), (true)) w(is_weekend)
      LEFT JOIN (SELECT city_zone, road_id, weather, COUNT(*) AS observations FROM fact
                 GROUP BY city_zone, road_id, weather) c
        ON c.city_zone = z.zone AND c.road_id = r.road AND c.weather = x.weather)"""))
def _grid(lh):
    return scoring.scenario_grid(lh.fact)


# ---------------------------------------------------------------------------
# Maintenance
# ---------------------------------------------------------------------------
def _stored_fact(lh):
    """The fact as its sink leaves it: small files by date and hour."""
    path = _scratch(lh, "fact_by_hour")
    gold.write_fact(lh.fact, path)
    return lh.spark.read.parquet(path).select(*gold.FACT_COLUMNS)


@report("compact", with_base(f"SELECT {FACT_SQL} FROM fact"))
def _compact(lh):
    out = _scratch(lh, "fact_compacted")
    V.compact(_stored_fact(lh), out, sort_by=["event_date", "event_hour"])
    return lh.spark.read.parquet(out).select(*gold.FACT_COLUMNS)


@report("zorder_rewrite", with_base(f"SELECT {FACT_SQL} FROM fact"))
def _zorder(lh):
    out = _scratch(lh, "fact_zorder")
    V.zorder_rewrite(_stored_fact(lh), out, ["road_id", "city_zone"])
    return lh.spark.read.parquet(out).select(*gold.FACT_COLUMNS)


@report("zorder_silver", with_base("SELECT vehicle_id, event_ts, city_zone, road_id, speed_int, kafka_offset FROM silver"))
def _zorder_silver(lh):
    """Silver clustered by vehicle and time."""
    path, out = _scratch(lh, "silver"), _scratch(lh, "silver_zorder")
    lh.silver.select(*_VERSIONED_COLS).write.parquet(path)
    V.zorder_rewrite(lh.spark.read.parquet(path), out, ["vehicle_id", "event_ts"])
    return lh.spark.read.parquet(out).select(*_VERSIONED_COLS)


@report("compact_quarantine", with_base("SELECT * FROM quarantine"))
def _compact_quarantine(lh):
    path, out = _scratch(lh, "quarantine"), _scratch(lh, "quarantine_compacted")
    lh.quarantine.write.parquet(path)
    stored = lh.spark.read.parquet(path)
    V.compact(stored, out, sort_by=["kafka_timestamp"])
    return lh.spark.read.parquet(out).select(*stored.columns)


LOADS = 3
_VERSIONED_COLS = ["vehicle_id", "event_ts", "city_zone", "road_id", "speed_int", "kafka_offset"]
# Load k holds the rows that arrived in the k-th third of the arrival span.
_VERSIONED_CTE = f"""
span AS (SELECT epoch_us(MIN(kafka_timestamp)) AS lo, epoch_us(MAX(kafka_timestamp)) AS hi FROM silver),
loaded AS (SELECT vehicle_id, event_ts, city_zone, road_id, speed_int, kafka_offset, kafka_timestamp,
  CASE WHEN epoch_us(kafka_timestamp) < lo + (hi - lo) // {LOADS} THEN 1
       WHEN epoch_us(kafka_timestamp) < lo + (hi - lo) * 2 // {LOADS} THEN 2 ELSE 3 END AS load
  FROM silver, span),
versioned AS (SELECT vehicle_id, event_ts, city_zone, road_id, speed_int, kafka_offset,
  CAST(load AS BIGINT) AS commit_id, MAX(kafka_timestamp) OVER (PARTITION BY load) AS committed_at,
  'STREAMING UPDATE' AS operation FROM loaded)"""


def _versioned(lh):
    """A table that ``LOADS`` appends have written, each tagged by the sink."""
    path, stored = _scratch(lh, "vehicle_versions"), _scratch(lh, "silver")
    lh.silver.select(*_VERSIONED_COLS, "kafka_timestamp").write.parquet(stored)
    rows = lh.spark.read.parquet(stored)
    lo, hi = rows.agg(*(F.unix_micros(f(F.col("kafka_timestamp").cast("timestamp"))) for f in (F.min, F.max))).first()
    bounds = [lo + (hi - lo) * k // LOADS for k in range(LOADS)] + [hi + 1]
    for k in range(LOADS):
        at = F.unix_micros(F.col("kafka_timestamp").cast("timestamp"))
        part = rows.where((at >= bounds[k]) & (at < bounds[k + 1]))
        newest = part.agg(F.max("kafka_timestamp")).first()[0]
        V.append_load(part.drop("kafka_timestamp"), path, k + 1,
                      F.lit(newest).cast(rows.schema["kafka_timestamp"].dataType), "STREAMING UPDATE")
    return lh.spark.read.parquet(path)


@report("commit_history", with_base("""
SELECT commit_id, committed_at, operation, COUNT(*) AS num_output_rows FROM versioned
GROUP BY commit_id, committed_at, operation ORDER BY commit_id DESC LIMIT 10""", extra_ctes=_VERSIONED_CTE))
def _history(lh):
    return V.commit_history(_versioned(lh), 10)


@report("as_of", with_base("""
SELECT * FROM versioned WHERE committed_at <= (SELECT MAX(committed_at) FROM versioned WHERE commit_id = 2)
QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY commit_id DESC, event_ts DESC, kafka_offset DESC) = 1""",
    extra_ctes=_VERSIONED_CTE))
def _as_of(lh):
    """Each vehicle's row as of the time of the second load."""
    versioned = _versioned(lh)
    then = versioned.where("commit_id = 2").agg(F.max("committed_at")).first()[0]
    return V.as_of(versioned, timestamp=F.lit(then).cast(versioned.schema["committed_at"].dataType),
                   keys=["vehicle_id"], order=["commit_id", "event_ts", "kafka_offset"])


@report("restore_as_of", with_base(f"""
SELECT vehicle_id, event_ts, city_zone, road_id, speed_int, kafka_offset,
  CAST({LOADS + 1} AS BIGINT) AS commit_id,
  (SELECT MAX(committed_at) FROM versioned) + INTERVAL 1 HOUR AS committed_at, 'RESTORE' AS operation
FROM versioned WHERE commit_id <= 2""", extra_ctes=_VERSIONED_CTE))
def _restore(lh):
    """The rows of the first two loads, made current again by a fourth."""
    out, versioned = _scratch(lh, "vehicle_state_restored"), _versioned(lh)
    newest = versioned.agg(F.max("committed_at") + F.expr("INTERVAL 1 HOUR")).first()[0]
    V.restore_as_of(versioned, out, 2, LOADS + 1, F.lit(newest).cast(versioned.schema["committed_at"].dataType))
    return lh.spark.read.parquet(out)


@report("expire", with_base("""
SELECT * EXCLUDE (latest, newest) FROM (
  SELECT *, MAX(commit_id) OVER (PARTITION BY vehicle_id) AS latest, MAX(committed_at) OVER () AS newest FROM versioned)
WHERE commit_id = latest OR committed_at >= newest - INTERVAL 168 HOUR""", extra_ctes=_VERSIONED_CTE))
def _expire(lh):
    return V.expire(_versioned(lh), ["vehicle_id"], 168)
