"""Independent SQL (DuckDB dialect) for every registered report.

Each oracle is one SQL text over the raw ``events`` view: the same message
mapping, JSON parse, rule chain, dedup and star schema written as plain
CTEs, then the report.  It shares no code with the Spark operators; it only
shares the fixed values of the data contract.

Dialect notes (DuckDB vs Spark): Sunday is 0 in ``dayofweek``; ``sum`` of
integers is HUGEINT (cast to BIGINT); ``try_cast('65.7' as int)`` rounds, so
speeds go through ``trunc``; averages and rates are rounded as
``round(cast(x as decimal(30,10)), n)`` exactly as on the Spark side.
"""

from __future__ import annotations


def rnd(expr: str, n: int) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(30,10)), {n}) AS DOUBLE)"


def pct(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) * 100 / NULLIF({den}, 0))"


BASE_CTES = r"""
e AS (
  SELECT event_id, ts, user_id, event_type, value, 0 AS dup FROM events
  UNION ALL
  SELECT event_id, ts, user_id, event_type, value, 1 AS dup FROM events WHERE event_id % 31 = 0),
f AS (SELECT *,
  CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 83 = 0 THEN ''
       ELSE 'VEH-' || CAST(user_id AS VARCHAR) END AS vid,
  'R' || CAST((1 + event_id % 5) * 100 AS VARCHAR) AS rid,
  CASE user_id % 6 WHEN 0 THEN 'CBD' WHEN 1 THEN 'AIRPORT' WHEN 2 THEN 'TECHPARK'
       WHEN 3 THEN 'SUBURB' WHEN 4 THEN 'TRAINSTATION' ELSE 'HARBOR' END AS zone,
  CASE WHEN event_id % 37 = 0 THEN 'null' WHEN event_id % 43 = 0 THEN '"FAST"'
       WHEN event_id % 47 = 0 THEN '-30' ELSE CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) END AS spd,
  CAST(1 + (event_id + user_id) % 5 AS VARCHAR) AS lvl,
  CASE event_type WHEN 'view' THEN 'CLEAR' WHEN 'click' THEN 'RAIN' WHEN 'purchase' THEN 'FOG'
       WHEN 'error' THEN 'STORM' ELSE 'SNOW' END AS wx,
  CASE event_id % 6 WHEN 0 THEN 'SEDAN' WHEN 1 THEN 'SUV' WHEN 2 THEN 'TRUCK' WHEN 3 THEN 'BUS'
       WHEN 4 THEN 'MOTORCYCLE' ELSE 'EV_TAXI' END AS vt,
  CAST(12900 + event_id % 300 AS VARCHAR) AS lat3, CAST(77500 + event_id % 200 AS VARCHAR) AS lon3,
  CASE WHEN event_id % 67 = 0 THEN 'not-a-time'
       ELSE replace(CAST(ts + CASE WHEN event_id % 59 = 0 THEN INTERVAL '30' MINUTE
                                   ELSE INTERVAL '0' MINUTE END AS VARCHAR), ' ', 'T') || '+00:00' END AS et
 FROM e),
msgs AS (SELECT
  CASE WHEN event_id % 61 = 0 THEN '{"raw":"###CORRUPT_SENSOR_PAYLOAD_HEX_DEADBEEF###"}'
       WHEN event_id % 97 = 0 THEN 'not json'
       ELSE '{"vehicle_id":' || coalesce('"' || vid || '"', 'null') || ',"road_id":"' || rid
         || '","city_zone":"' || zone || '","speed":' || spd || ',"congestion_level":' || lvl
         || ',"weather":"' || wx || '","vehicle_type":"' || vt || '","sensor_id":"SNS-'
         || CAST(1000 + event_id % 9000 AS VARCHAR) || '","latitude":' || substr(lat3,1,2) || '.'
         || substr(lat3,3) || ',"longitude":' || substr(lon3,1,2) || '.' || substr(lon3,3)
         || ',"event_time":"' || et || '"'
         || CASE WHEN event_id % 19 = 0
                 THEN ',"road_surface_temp_c":12.5,"firmware_version":"v3.8.1-rc2"' ELSE '' END
         || '}' END AS value,
  ts + CASE WHEN event_id % 53 = 0 THEN INTERVAL '4' HOUR
            WHEN event_id % 29 = 0 THEN INTERVAL '90' MINUTE
            ELSE INTERVAL '20' SECOND END AS kafka_timestamp,
  'traffic-topic' AS kafka_topic, CAST(event_id % 3 AS INTEGER) AS kafka_partition,
  CAST(event_id + dup * 1000000000 AS BIGINT) AS kafka_offset
 FROM f),
bronze AS (SELECT value AS raw_payload, kafka_timestamp, kafka_topic, kafka_partition, kafka_offset,
  json_extract_string(j, '$.vehicle_id') AS vehicle_id,
  json_extract_string(j, '$.road_id') AS road_id,
  json_extract_string(j, '$.city_zone') AS city_zone,
  json_extract_string(j, '$.speed') AS speed,
  TRY_CAST(json_extract_string(j, '$.congestion_level') AS INTEGER) AS congestion_level,
  json_extract_string(j, '$.weather') AS weather,
  json_extract_string(j, '$.vehicle_type') AS vehicle_type,
  json_extract_string(j, '$.sensor_id') AS sensor_id,
  TRY_CAST(json_extract_string(j, '$.latitude') AS DOUBLE) AS latitude,
  TRY_CAST(json_extract_string(j, '$.longitude') AS DOUBLE) AS longitude,
  json_extract_string(j, '$.event_time') AS event_time,
  json_extract_string(j, '$.raw') AS raw
 FROM (SELECT *, CASE WHEN json_valid(value) THEN value ELSE '{}' END AS j FROM msgs)),
typed AS (SELECT *,
  TRY_CAST(trunc(TRY_CAST(speed AS DOUBLE)) AS INTEGER) AS speed_int,
  timezone('UTC', TRY_CAST(event_time AS TIMESTAMPTZ)) AS event_ts
 FROM bronze),
dq AS (SELECT *, CASE
  WHEN contains(raw_payload, 'CORRUPT') OR starts_with(raw_payload, '###') OR raw IS NOT NULL THEN 'CORRUPT_PAYLOAD'
  WHEN vehicle_id IS NULL OR trim(vehicle_id) = '' THEN 'MISSING_VEHICLE_ID'
  WHEN event_ts IS NULL THEN 'MISSING_OR_INVALID_TIMESTAMP'
  WHEN speed_int IS NULL OR speed_int < 0 OR speed_int > 180 THEN 'SPEED_OUT_OF_BOUNDS'
  WHEN event_ts > kafka_timestamp + INTERVAL 10 MINUTE THEN 'FUTURE_TIMESTAMP_ANOMALY'
  WHEN event_ts < kafka_timestamp - INTERVAL 3 HOUR THEN 'EXCESSIVE_LATENCY'
  ELSE 'VALID' END AS dq_status
 FROM typed),
valid AS (SELECT * FROM dq WHERE dq_status = 'VALID'),
dedup AS (SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, event_ts ORDER BY kafka_timestamp, kafka_topic, kafka_partition, kafka_offset) = 1),
silver AS (SELECT *,
  CAST(hour(event_ts) AS INTEGER) AS event_hour,
  CASE WHEN dayofweek(event_ts) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour(event_ts) BETWEEN 8 AND 11 OR hour(event_ts) BETWEEN 17 AND 20 THEN 1 ELSE 0 END AS peak_flag,
  CASE WHEN speed_int < 30 THEN 'LOW_SPEED' WHEN speed_int < 70 THEN 'MEDIUM_SPEED' ELSE 'HIGH_SPEED' END AS speed_band,
  CASE WHEN congestion_level >= 4 THEN 3 WHEN congestion_level = 3 THEN 2 ELSE 1 END AS congestion_risk_score
 FROM dedup),
quarantine AS (SELECT raw_payload, vehicle_id, road_id, city_zone, speed AS raw_speed,
  event_time AS raw_event_time, dq_status AS quarantine_reason, kafka_timestamp,
  kafka_timestamp AS quarantine_ts, kafka_topic, kafka_partition, kafka_offset
 FROM dq WHERE dq_status <> 'VALID'),
fact AS (SELECT vehicle_id, road_id, city_zone, speed_int AS speed_kmh, congestion_level,
  congestion_risk_score, speed_band, peak_flag, is_weekend, weather, vehicle_type, sensor_id,
  latitude, longitude, event_ts, CAST(event_ts AS DATE) AS event_date, event_hour
 FROM silver),
dim_zone AS (SELECT city_zone,
  CASE WHEN city_zone = 'CBD' THEN 'Commercial / Financial'
       WHEN city_zone = 'TECHPARK' THEN 'IT & Technology Hub'
       WHEN city_zone IN ('AIRPORT', 'TRAINSTATION', 'HARBOR') THEN 'Multimodal Transit Hub'
       ELSE 'Residential & Suburban' END AS zone_type,
  CASE WHEN city_zone IN ('CBD', 'AIRPORT', 'TRAINSTATION') THEN 'CRITICAL'
       WHEN city_zone = 'TECHPARK' THEN 'HIGH' WHEN city_zone = 'HARBOR' THEN 'MEDIUM'
       ELSE 'LOW' END AS traffic_risk_tier
 FROM (SELECT DISTINCT city_zone FROM silver)),
dim_road AS (SELECT road_id,
  CASE WHEN road_id IN ('R100', 'R200') THEN 'Expressway / Highway' WHEN road_id = 'R300' THEN 'Major Arterial Road'
       WHEN road_id = 'R400' THEN 'Urban Collector Road' ELSE 'Local Access Street' END AS road_type,
  CASE WHEN road_id IN ('R100', 'R200') THEN 100 WHEN road_id = 'R300' THEN 60
       WHEN road_id = 'R400' THEN 50 ELSE 40 END AS speed_limit_kmh,
  CASE WHEN road_id IN ('R100', 'R200') THEN 4 WHEN road_id = 'R300' THEN 3
       WHEN road_id = 'R400' THEN 2 ELSE 1 END AS lane_count
 FROM (SELECT DISTINCT road_id FROM silver)),
stg AS (SELECT CAST(vehicle_id AS VARCHAR) AS vehicle_id, CAST(road_id AS VARCHAR) AS road_id,
  CAST(city_zone AS VARCHAR) AS city_zone, CAST(speed_int AS INTEGER) AS speed_kmh,
  CAST(congestion_level AS INTEGER) AS congestion_level,
  CAST(congestion_risk_score AS INTEGER) AS congestion_risk_score, CAST(speed_band AS VARCHAR) AS speed_band,
  CAST(peak_flag AS INTEGER) AS is_peak_hour, CAST(is_weekend AS INTEGER) AS is_weekend,
  CAST(weather AS VARCHAR) AS weather_condition, CAST(vehicle_type AS VARCHAR) AS vehicle_type,
  CAST(sensor_id AS VARCHAR) AS sensor_id, CAST(latitude AS DOUBLE) AS latitude,
  CAST(longitude AS DOUBLE) AS longitude, CAST(event_ts AS TIMESTAMP) AS event_timestamp,
  CAST(event_ts AS DATE) AS event_date, CAST(event_hour AS INTEGER) AS event_hour
 FROM silver WHERE vehicle_id IS NOT NULL),
dim_zones_mart AS (SELECT city_zone,
  CASE WHEN city_zone = 'CBD' THEN 'Commercial / Financial Center'
       WHEN city_zone = 'TECHPARK' THEN 'IT & Technology Hub'
       WHEN city_zone IN ('AIRPORT', 'TRAINSTATION', 'HARBOR') THEN 'Multimodal Transit Hub'
       ELSE 'Residential & Suburban District' END AS zone_classification,
  CASE WHEN city_zone IN ('CBD', 'AIRPORT', 'TRAINSTATION') THEN 'CRITICAL'
       WHEN city_zone = 'TECHPARK' THEN 'HIGH' WHEN city_zone = 'HARBOR' THEN 'MEDIUM'
       ELSE 'LOW' END AS traffic_risk_tier
 FROM (SELECT DISTINCT city_zone FROM stg)),
dim_roads_mart AS (SELECT road_id,
  CASE WHEN road_id IN ('R100', 'R200') THEN 'Expressway / Highway' WHEN road_id = 'R300' THEN 'Major Arterial Road'
       WHEN road_id = 'R400' THEN 'Urban Collector Road' ELSE 'Local Access Street' END AS road_classification,
  CASE WHEN road_id IN ('R100', 'R200') THEN 100 WHEN road_id = 'R300' THEN 60
       WHEN road_id = 'R400' THEN 50 ELSE 40 END AS speed_limit_kmh,
  CASE WHEN road_id IN ('R100', 'R200') THEN 4 WHEN road_id = 'R300' THEN 3
       WHEN road_id = 'R400' THEN 2 ELSE 1 END AS total_lanes
 FROM (SELECT DISTINCT road_id FROM stg))
"""


def with_base(select_sql: str, extra_ctes: str = "") -> str:
    ctes = BASE_CTES.strip()
    if extra_ctes:
        ctes = ctes + ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{select_sql.strip()}"
