"""Bronze-shaped views over the driver's tables; the same text runs in Spark SQL and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("events", "supplier", "nation", "orders", "lineitem", "customer", "part", "region")
VIEWS = {
    "readings": """
SELECT concat('F', CAST(user_id % 8 AS STRING)) AS facility_code,
       concat('Plant ', CAST(user_id % 8 AS STRING)) AS facility_name,
       'NEM' AS network_code,
       CASE user_id % 4 WHEN 0 THEN 'NSW1' WHEN 1 THEN 'QLD1' WHEN 2 THEN 'VIC1' ELSE 'SA1' END AS network_region,
       CASE event_type WHEN 'error' THEN 'power' WHEN 'signup' THEN 'price' ELSE 'energy' END AS metric,
       CASE WHEN event_id % 17 = 0 THEN 0.0E0 ELSE value - 2.0E0 END AS value,
       ts AS interval_ts,
       event_id AS ingest_seq
FROM events""",
    "raw_weather": """
SELECT facility_code, facility_name, weather_timestamp,
       hi * 3.0E0 AS shortwave_radiation,
       hi * 2.0E0 AS direct_radiation,
       lo * 1.5E0 AS diffuse_radiation,
       hi * 2.5E0 AS direct_normal_irradiance,
       CAST(a % 70 AS DOUBLE) - 12.0E0 AS temperature_2m,
       CAST(a % 70 AS DOUBLE) - 12.0E0 - CAST(b % 15 AS DOUBLE) AS dew_point_2m,
       CAST(b % 101 AS DOUBLE) AS cloud_cover,
       CAST((b * 37) % 3601 AS DOUBLE) AS sunshine_duration,
       CAST(b % 55 AS DOUBLE) AS wind_speed_10m,
       CAST(a % 361 AS DOUBLE) AS wind_direction_10m,
       CAST(980 + a % 75 AS DOUBLE) AS pressure_msl,
       CAST(b % 50 AS DOUBLE) - 7.0E0 AS wet_bulb_temperature_2m,
       CAST(a % 103 AS DOUBLE) AS cloud_cover_low,
       CASE WHEN a % 7 = 0 THEN NULL ELSE CAST(b % 102 AS DOUBLE) END AS cloud_cover_mid,
       CAST((a + b) % 104 AS DOUBLE) AS cloud_cover_high,
       CAST(b % 1009 AS DOUBLE) AS precipitation,
       CAST(a % 124 AS DOUBLE) AS wind_gusts_10m,
       CASE WHEN a % 3 = 0 THEN NULL ELSE CAST(a % 60 AS DOUBLE) END AS total_column_integrated_water_vapour
FROM (SELECT concat('F', CAST(user_id % 8 AS STRING)) AS facility_code,
             concat('Plant ', CAST(user_id % 8 AS STRING)) AS facility_name,
             date_trunc('hour', ts) AS weather_timestamp,
             max(value) AS hi, min(value) AS lo, min(event_id) AS a, max(event_id) AS b
      FROM events
      GROUP BY concat('F', CAST(user_id % 8 AS STRING)), concat('Plant ', CAST(user_id % 8 AS STRING)), date_trunc('hour', ts)) g""",
    "raw_air_quality": """
SELECT facility_code, facility_name, air_timestamp,
       CASE WHEN a % 11 = 0 THEN NULL ELSE hi * 1.2E0 END AS pm2_5,
       hi * 1.4E0 AS pm10,
       lo AS dust,
       CAST(a % 120 AS DOUBLE) AS nitrogen_dioxide,
       CAST(b % 180 AS DOUBLE) AS ozone,
       CAST(a % 17 AS DOUBLE) AS uv_index,
       CAST(a % 509 AS DOUBLE) AS sulphur_dioxide,
       CASE WHEN b % 5 = 0 THEN NULL ELSE CAST(b % 503 AS DOUBLE) END AS carbon_monoxide,
       CAST(b % 19 AS DOUBLE) AS uv_index_clear_sky
FROM (SELECT concat('F', CAST(user_id % 8 AS STRING)) AS facility_code,
             concat('Plant ', CAST(user_id % 8 AS STRING)) AS facility_name,
             date_trunc('hour', ts) AS air_timestamp,
             max(value) AS hi, min(value) AS lo, min(event_id) AS a, max(event_id) AS b
      FROM events WHERE event_type <> 'click'
      GROUP BY concat('F', CAST(user_id % 8 AS STRING)), concat('Plant ', CAST(user_id % 8 AS STRING)), date_trunc('hour', ts)) g""",
    "raw_facilities": """
SELECT concat('F', CAST(s_suppkey AS STRING)) AS facility_code,
       s_name AS facility_name,
       'NEM' AS network_id,
       n_name AS network_region,
       CAST(-20 - s_suppkey % 25 AS DOUBLE) AS location_lat,
       CAST(140 + s_suppkey % 15 AS DOUBLE) AS location_lng,
       CASE WHEN s_suppkey = 7 THEN 0.0E0 ELSE abs(s_acctbal) / 50.0E0 END AS total_capacity_mw
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "facility_history": """
SELECT concat('F', CAST(s_suppkey AS STRING)) AS facility_code, s_name AS facility_name, 'NEM' AS network_id, n_name AS network_region,
       CAST(-20 - s_suppkey % 25 AS DOUBLE) AS location_lat, CAST(140 + s_suppkey % 15 AS DOUBLE) AS location_lng,
       h.units AS unit_count, h.capacity AS total_capacity_mw, h.effective_from
FROM (SELECT l_suppkey, date_trunc('year', l_shipdate) AS effective_from, CAST(count(DISTINCT l_returnflag) AS INT) AS units,
             CAST(count(*) % 3 AS DOUBLE) AS capacity
      FROM lineitem GROUP BY l_suppkey, date_trunc('year', l_shipdate)) h
JOIN supplier ON s_suppkey = h.l_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "attribute_history": """
SELECT o_custkey AS entity_id, o_orderdate AS effective_from, o_orderkey AS seq,
       o_orderpriority AS priority, o_orderstatus AS status
FROM orders""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, or one of VIEWS over them."""
    if name in BASE:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tables = {b: spark.read.parquet(f"{sf_dir}/{b}.parquet") for b in BASE if re.search(rf"\b(FROM|JOIN) {b}\b", VIEWS[name])}
    return spark.sql(re.sub(rf"\b(FROM|JOIN) ({'|'.join(tables)})\b", r"\1 {\2}", VIEWS[name]), **tables)  # no view of the session is replaced
