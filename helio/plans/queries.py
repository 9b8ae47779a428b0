"""Registered queries and their DuckDB twins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.functions.scalars import date_key, row_hash
from helio.operators import audit, dims, facts, features, kpi, silver, upsert, watermarks
from helio.operators.rules import AIR_BOUNDS, WEATHER_BOUNDS
from helio.plans.sample import VIEWS, view
from helio.sources import nested
from helio.sources.shared import shared_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _bounds_sql(bounds: dict, have: set[str]) -> tuple[str, str]:
    """Issue list and validity of bounds, for the columns that the sample has."""
    bad = {c: f"coalesce({c} NOT BETWEEN {lo} AND {hi}, false)" for c, (lo, hi) in bounds.items() if c in have}
    return ", ".join(f"CASE WHEN {b} THEN '{c}_OUT_OF_BOUNDS' END" for c, b in bad.items()), " OR ".join(bad.values())


_W = ("shortwave_radiation", "direct_radiation", "diffuse_radiation", "direct_normal_irradiance", "temperature_2m", "dew_point_2m", "cloud_cover", "sunshine_duration", "wind_speed_10m", "wind_direction_10m", "pressure_msl", "wet_bulb_temperature_2m", "cloud_cover_low", "cloud_cover_mid", "cloud_cover_high", "precipitation", "wind_gusts_10m", "total_column_integrated_water_vapour")
_A = ("pm2_5", "pm10", "dust", "nitrogen_dioxide", "ozone", "uv_index", "sulphur_dioxide", "carbon_monoxide", "uv_index_clear_sky")
#: Fixed values, written down for the twins apart from the operators' own.
TWIN_LIMITS = {
    "shortwave_radiation": (0.0, 1150.0), "direct_radiation": (0.0, 1050.0), "diffuse_radiation": (0.0, 520.0), "direct_normal_irradiance": (0.0, 1060.0),
    "temperature_2m": (-10.0, 50.0), "dew_point_2m": (-20.0, 30.0), "wet_bulb_temperature_2m": (-5.0, 40.0),
    "cloud_cover": (0.0, 100.0), "cloud_cover_low": (0.0, 100.0), "cloud_cover_mid": (0.0, 100.0), "cloud_cover_high": (0.0, 100.0),
    "precipitation": (0.0, 1000.0), "sunshine_duration": (0.0, 3600.0), "total_column_integrated_water_vapour": (0.0, 100.0),
    "wind_speed_10m": (0.0, 50.0), "wind_direction_10m": (0.0, 360.0), "wind_gusts_10m": (0.0, 120.0), "pressure_msl": (985.0, 1050.0),
    "pm2_5": (0.0, 500.0), "pm10": (0.0, 500.0), "dust": (0.0, 500.0), "nitrogen_dioxide": (0.0, 500.0), "ozone": (0.0, 500.0),
    "sulphur_dioxide": (0.0, 500.0), "carbon_monoxide": (0.0, 500.0), "uv_index": (0.0, 15.0), "uv_index_clear_sky": (0.0, 15.0),
}
_wi, _wb = _bounds_sql(TWIN_LIMITS, set(_W))
_ai, _ab = _bounds_sql(TWIN_LIMITS, set(_A))
_h = "extract(hour FROM date_hour)"
CTES = dict(VIEWS)
CTES["energy0"] = """SELECT facility_code, facility_name, network_code, network_region, date_trunc('hour', interval_ts + INTERVAL 11 HOUR) AS date_hour,
 CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS energy_mwh, count(value) AS intervals_count, CAST(100 AS DOUBLE) AS completeness_pct
 FROM readings WHERE metric = 'energy' AND interval_ts IS NOT NULL AND facility_code IS NOT NULL GROUP BY ALL HAVING count(value) > 0"""
CTES["energy1"] = f"""SELECT *, energy_mwh < 0 AS r1, ({_h} >= 22 OR {_h} < 6) AND energy_mwh > 1 AS r2, {_h} BETWEEN 8 AND 17 AND energy_mwh = 0 AS r3, {_h} BETWEEN 10 AND 14 AND energy_mwh = 0 AS r4,
 energy_mwh > 0.01 AND energy_mwh < 186 * (CASE WHEN {_h} BETWEEN 6 AND 7 THEN 0.05 WHEN {_h} BETWEEN 8 AND 9 THEN 0.08 WHEN {_h} BETWEEN 17 AND 18 THEN 0.1 ELSE 0 END) AS r5,
 {_h} BETWEEN 10 AND 14 AND energy_mwh > 0.5 AND energy_mwh < 93 AS r6 FROM energy0"""
CTES["energy"] = """SELECT facility_code, facility_name, network_code, network_region, date_hour, energy_mwh, intervals_count, completeness_pct,
 concat_ws('|', CASE WHEN r1 THEN 'OUT_OF_BOUNDS' END, CASE WHEN r2 THEN 'NIGHT_ENERGY_ANOMALY' END, CASE WHEN r3 THEN 'DAYTIME_ZERO_ENERGY' END, CASE WHEN r4 THEN 'EQUIPMENT_DOWNTIME' END,
 CASE WHEN r5 THEN 'TRANSITION_HOUR_LOW_ENERGY' END, CASE WHEN r6 THEN 'PEAK_HOUR_LOW_ENERGY' END) AS quality_issues,
 CASE WHEN r1 THEN 'BAD' WHEN r2 OR r3 OR r4 OR r5 OR r6 THEN 'WARNING' ELSE 'GOOD' END AS quality_flag FROM energy1"""
_fill = "coalesce(total_column_integrated_water_vapour, last_value(total_column_integrated_water_vapour IGNORE NULLS) OVER (PARTITION BY facility_code, CAST(weather_timestamp AS DATE) ORDER BY weather_timestamp ROWS BETWEEN 100 PRECEDING AND CURRENT ROW))"
CTES["weather0"] = f"SELECT facility_code, facility_name, weather_timestamp AS date_hour, {', '.join(f'round({c}, 4) AS {c}' for c in _W[:-1])}, round({_fill}, 4) AS {_W[-1]} FROM raw_weather"
_wr = {
    "NIGHT_RADIATION_SPIKE": f"coalesce(({_h} < 6 OR {_h} >= 22) AND shortwave_radiation > 100, false)",
    "RADIATION_INCONSISTENCY": "coalesce(direct_radiation + diffuse_radiation > shortwave_radiation * 1.05E0, false)",
    "CLOUD_MEASUREMENT_INCONSISTENCY": f"coalesce({_h} BETWEEN 10 AND 14 AND cloud_cover > 98 AND shortwave_radiation < 600, false)",
    "EXTREME_TEMPERATURE": "coalesce(temperature_2m < -10 OR temperature_2m > 45, false)",
}
_nulls = lambda bounds, have: ", ".join(c if c in have else f"CAST(NULL AS DOUBLE) AS {c}" for c in bounds)
_bad, _warn = f"{_wb} OR {_wr['NIGHT_RADIATION_SPIKE']}", " OR ".join(list(_wr.values())[1:])
CTES["weather"] = f"""SELECT facility_code, facility_name, date_hour, CAST(date_hour AS DATE) AS date, {_nulls(WEATHER_BOUNDS, _W)}, NOT ({_bad} OR {_warn}) AS is_valid,
 CASE WHEN {_bad} THEN 'BAD' WHEN {_warn} THEN 'WARNING' ELSE 'GOOD' END AS quality_flag,
 concat_ws('|', {_wi}, {', '.join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _wr.items())}) AS quality_issues FROM weather0"""
_bands = ((0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150), (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 500.0, 301, 500))
_aqi = "CASE WHEN pm2_5 IS NULL THEN NULL " + " ".join(f"WHEN pm2_5 <= {hi}E0 OR {i} = 5 THEN (least(pm2_5, 500E0) - {lo}E0) / ({hi}E0 - {lo}E0) * {b - a} + {a}" for i, (lo, hi, a, b) in enumerate(_bands)) + " END"
CTES["air0"] = f"SELECT facility_code, facility_name, air_timestamp AS date_hour, {', '.join(f'round({c}, 4) AS {c}' for c in _A)} FROM raw_air_quality"
CTES["air1"] = f"SELECT *, CAST(round({_aqi}) AS INTEGER) AS aqi_value FROM air0"
_aq = f"({_ab} OR coalesce(aqi_value NOT BETWEEN 0 AND 500, false))"
CTES["air"] = f"""SELECT facility_code, facility_name, date_hour, CAST(date_hour AS DATE) AS date, {_nulls(AIR_BOUNDS, _A)}, aqi_value,
 CASE WHEN aqi_value <= 50 THEN 'Good' WHEN aqi_value <= 100 THEN 'Moderate' WHEN aqi_value <= 200 THEN 'Unhealthy' WHEN aqi_value IS NOT NULL THEN 'Hazardous' END AS aqi_category,
 NOT {_aq} AS is_valid, CASE WHEN {_aq} THEN 'WARNING' ELSE 'GOOD' END AS quality_flag,
 concat_ws('|', {_ai}, CASE WHEN aqi_value NOT BETWEEN 0 AND 500 THEN 'AQI_OUT_OF_RANGE' END) AS quality_issues FROM air1"""
CTES["aqi"] = "SELECT * FROM (VALUES (1, 'Good', 0, 50, 0.0, 12.0), (2, 'Moderate', 51, 100, 12.1, 35.0), (3, 'Unhealthy for Sensitive', 101, 150, 35.1, 55.0), (4, 'Unhealthy', 151, 200, 55.1, 150.0), (5, 'Very Unhealthy', 201, 300, 150.1, 250.0), (6, 'Hazardous', 301, 500, 250.1, 500.0)) v(aqi_category_key, aqi_category, aqi_range_min, aqi_range_max, pm2_5_min, pm2_5_max)"
CTES["fac"] = "SELECT CAST(row_number() OVER (ORDER BY facility_code) AS INTEGER) AS facility_key, facility_code, facility_name, CAST(location_lat AS DECIMAL(10,6)) AS location_lat, CAST(location_lng AS DECIMAL(10,6)) AS location_lng, CAST(total_capacity_mw AS DECIMAL(10,4)) AS total_capacity_mw FROM raw_facilities"
CTES["fact0"] = f"""SELECT e.facility_code, e.date_hour, e.energy_mwh, e.intervals_count, {', '.join(f'w.{c}' for c in WEATHER_BOUNDS)}, {', '.join(f'a.{c}' for c in AIR_BOUNDS)}, a.aqi_value,
 f.facility_key, f.total_capacity_mw, q.aqi_category_key, CAST(strftime(e.date_hour, '%Y%m%d') AS INTEGER) AS date_key, CAST(extract(hour FROM e.date_hour) AS INTEGER) AS time_key,
 CAST((CASE WHEN e.energy_mwh IS NULL THEN 0 ELSE 33.33 END) + (CASE WHEN w.shortwave_radiation IS NULL THEN 0 ELSE 33.33 END) + (CASE WHEN a.pm2_5 IS NULL THEN 0 ELSE 33.34 END) AS DECIMAL(5,2)) AS completeness_pct,
 coalesce(e.energy_mwh >= 0, false) AS is_valid, w.shortwave_radiation / 1000E0 AS irr_kwh_m2_hour, w.sunshine_duration / 3600E0 AS sunshine_hours,
 w.shortwave_radiation / 1000E0 * CAST(f.total_capacity_mw AS DOUBLE) * 1000E0 AS yr_weighted_kwh,
 CASE WHEN w.temperature_2m IS NOT NULL AND w.dew_point_2m IS NOT NULL THEN least(100E0, greatest(0E0, 100E0 * exp(17.625E0 * w.dew_point_2m / (243.04E0 + w.dew_point_2m)) / exp(17.625E0 * w.temperature_2m / (243.04E0 + w.temperature_2m)))) END AS humidity_2m
 FROM energy e LEFT JOIN weather w ON e.facility_code = w.facility_code AND e.date_hour = w.date_hour LEFT JOIN air a ON e.facility_code = a.facility_code AND e.date_hour = a.date_hour
 LEFT JOIN fac f ON e.facility_code = f.facility_code LEFT JOIN aqi q ON a.aqi_value BETWEEN q.aqi_range_min AND q.aqi_range_max"""
CTES["fact"] = "SELECT *, CASE WHEN NOT is_valid THEN 'BAD' WHEN completeness_pct >= 90 THEN 'GOOD' WHEN completeness_pct >= 50 THEN 'WARNING' ELSE 'BAD' END AS quality_flag FROM fact0"
CTES["base"] = "SELECT * FROM fact WHERE energy_mwh > 0 AND yr_weighted_kwh > 0"
_SE, _SY = "CAST(sum(CAST(energy_mwh AS DECIMAL(18,6))) AS DOUBLE)", "CAST(sum(CAST(yr_weighted_kwh AS DECIMAL(24,6))) AS DOUBLE)"
_PR = f"round({_SE} * 1000 / nullif({_SY}, 0) * 100, 4)"


def _sql(body: str) -> str:
    """``body`` under the CTEs that it needs."""
    import re

    need: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in need and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                need.append(name)

    visit(body)
    return ("WITH " + ",\n".join(f"{n} AS (\n{CTES[n]})" for n in need) + "\n" if need else "") + body


def query(sql: str | None = None):
    """Register a query under its function's name, with its twin."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = _sql(sql)
        return f

    return add


def _energy(spark, d):
    return silver.hourly_energy(view(spark, d, "readings"))


def _weather(spark, d):
    return silver.hourly_weather(view(spark, d, "raw_weather"))


def _air(spark, d):
    return silver.hourly_air_quality(view(spark, d, "raw_air_quality"))


def _fac(spark, d):
    return dims.dim_facility(view(spark, d, "raw_facilities"))


def _fact(spark, d, fac=None, core=True):
    return facts.fact_environmental(_energy(spark, d), _weather(spark, d), _air(spark, d), fac if fac is not None else _fac(spark, d), dims.dim_aqi(spark), core)


@query(f"SELECT date_key, f.facility_code, facility_name, round({_SE}, 4) AS total_mwh, round(CAST(sum(CAST(shortwave_radiation AS DECIMAL(18,6))) AS DOUBLE), 4) AS total_radiation, count(*) AS hours FROM fact f JOIN fac USING (facility_key) GROUP BY ALL")
def bi_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    fac = _fac(spark, sf_dir)
    star = _fact(spark, sf_dir, fac).join(fac.select("facility_key", "facility_name"), "facility_key")
    total = lambda c: F.round(F.sum(F.col(c).cast("decimal(18,6)")).cast("double"), 4)
    return star.groupBy("date_key", "facility_code", "facility_name").agg(total("energy_mwh").alias("total_mwh"), total("shortwave_radiation").alias("total_radiation"), F.count(F.lit(1)).alias("hours"))


@query(f"SELECT time_of_day, f.time_key, facility_code, round({_SE}, 4) AS total_mwh FROM fact f JOIN (SELECT range AS k, CASE WHEN range < 6 THEN 'Night' WHEN range < 12 THEN 'Morning' WHEN range < 17 THEN 'Afternoon' WHEN range < 21 THEN 'Evening' ELSE 'Night' END AS time_of_day FROM range(24)) t ON t.k = f.time_key GROUP BY ALL")
def bi_hourly_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = dims.lookup(_fact(spark, sf_dir), dims.dim_time(spark), [(F.col("time_key"), "time_key")], ["time_of_day"], "inner")
    return star.groupBy("time_of_day", "time_key", "facility_code").agg(F.round(F.sum(F.col("energy_mwh").cast("decimal(18,6)")).cast("double"), 4).alias("total_mwh"))


@query("SELECT date_key, facility_code, q.aqi_category, count(*) AS hours, max(aqi_value) AS worst FROM fact f JOIN aqi q ON f.aqi_category_key = q.aqi_category_key GROUP BY ALL")
def bi_air_quality_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = dims.lookup(_fact(spark, sf_dir), dims.dim_aqi(spark), [(F.col("aqi_category_key"), "aqi_category_key")], ["aqi_category"], "inner")
    return star.groupBy("date_key", "facility_code", "aqi_category").agg(F.count(F.lit(1)).alias("hours"), F.max("aqi_value").alias("worst"))


@query("SELECT * FROM energy")
def hourly_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _energy(spark, sf_dir)


@query("SELECT * FROM weather")
def hourly_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weather(spark, sf_dir)


@query(f"SELECT facility_code, weather_timestamp, {_fill} AS total_column_integrated_water_vapour FROM raw_weather")
def weather_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "raw_weather").select("facility_code", "weather_timestamp", F.to_date("weather_timestamp").alias("day"), "total_column_integrated_water_vapour")
    return silver.forward_fill(rows, "total_column_integrated_water_vapour", ["facility_code", "day"], "weather_timestamp").drop("day")


@query("SELECT * FROM air")
def hourly_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _air(spark, sf_dir)


@query("""SELECT entity_id, effective_from, lead(effective_from) OVER w AS effective_to, priority, status, row_hash, lead(effective_from) OVER w IS NULL AS is_current FROM (
 SELECT *, sha256(concat(coalesce(priority, ''), '||', coalesce(status, ''))) AS row_hash, lag(sha256(concat(coalesce(priority, ''), '||', coalesce(status, '')))) OVER (PARTITION BY entity_id ORDER BY effective_from, seq) AS before FROM attribute_history) h
 WHERE before IS NULL OR before <> row_hash WINDOW w AS (PARTITION BY entity_id ORDER BY effective_from, seq)""")
def facility_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.scd2(view(spark, sf_dir, "attribute_history"), "entity_id", "effective_from", ["priority", "status"], "seq")


@query("""SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name, week(d) AS week, day(d) AS day_of_month, isodow(d) AS day_of_week, dayname(d) AS day_name
 FROM (SELECT DISTINCT CAST(date_hour AS DATE) AS d FROM (SELECT date_hour FROM energy UNION ALL SELECT date_hour FROM weather UNION ALL SELECT date_hour FROM air))""")
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_date((_energy(spark, sf_dir), "date_hour"), (_weather(spark, sf_dir), "date_hour"), (_air(spark, sf_dir), "date_hour"))


@query("SELECT * FROM fac")
def dim_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fac(spark, sf_dir)


@query("SELECT e.facility_code, e.date_hour, f.facility_key, f.total_capacity_mw FROM energy e LEFT JOIN fac f USING (facility_code)")
def key_lookup_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.lookup(_energy(spark, sf_dir).select("facility_code", "date_hour"), _fac(spark, sf_dir), [(F.col("facility_code"), "facility_code")], ["facility_key", "total_capacity_mw"])


def _range(how: str):
    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dims.range_lookup(_air(spark, sf_dir).select("facility_code", "date_hour", "aqi_value"), "aqi_value", dims.dim_aqi(spark), "aqi_range_min", "aqi_range_max", ["aqi_category_key", "aqi_category"], how)

    f.__name__ = f"aqi_range_lookup_{how}"
    query(f"SELECT a.facility_code, a.date_hour, a.aqi_value, q.aqi_category_key, q.aqi_category FROM air a {how} JOIN aqi q ON a.aqi_value BETWEEN q.aqi_range_min AND q.aqi_range_max")(f)


_range("left")
_range("inner")


CTES["wclass"] = """SELECT facility_code, date_hour, CASE WHEN shortwave_radiation >= 800 THEN 'High Radiation' WHEN shortwave_radiation >= 300 THEN 'Moderate Radiation' WHEN shortwave_radiation IS NOT NULL THEN 'Low Radiation' END AS condition_name,
 CASE WHEN shortwave_radiation >= 800 THEN 'High' WHEN shortwave_radiation >= 300 THEN 'Medium' WHEN shortwave_radiation IS NOT NULL THEN 'Low' END AS radiation_level,
 CASE WHEN cloud_cover <= 20 THEN 'Clear' WHEN cloud_cover <= 70 THEN 'Partly Cloudy' WHEN cloud_cover IS NOT NULL THEN 'Overcast' END AS cloud_category,
 CASE WHEN temperature_2m <= 10 THEN 'Cold' WHEN temperature_2m <= 25 THEN 'Mild' WHEN temperature_2m IS NOT NULL THEN 'Hot' END AS temperature_range,
 CASE WHEN shortwave_radiation < 100 THEN 'High' WHEN cloud_cover > 80 THEN 'Medium' WHEN shortwave_radiation IS NOT NULL AND cloud_cover IS NOT NULL THEN 'Low' END AS weather_severity FROM weather"""


@query("SELECT * FROM wclass")
def classify_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.classify_weather(_weather(spark, sf_dir)).select("facility_code", "date_hour", "condition_name", "radiation_level", "cloud_category", "temperature_range", "weather_severity")


@query("SELECT facility_code, date_hour, CASE WHEN pm2_5 <= 12.0 THEN 'Good' WHEN pm2_5 <= 35.4 THEN 'Moderate' WHEN pm2_5 <= 55.4 THEN 'Unhealthy' WHEN pm2_5 IS NOT NULL THEN 'Hazardous' END AS aq_category FROM air")
def classify_air_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.classify_air(_air(spark, sf_dir)).select("facility_code", "date_hour", "aq_category")


@query("SELECT * REPLACE (round(humidity_2m, 6) AS humidity_2m, round(yr_weighted_kwh, 6) AS yr_weighted_kwh) FROM fact")
def fact_environmental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir, core=False).withColumns({"humidity_2m": F.round("humidity_2m", 6), "yr_weighted_kwh": F.round("yr_weighted_kwh", 6)})


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.latest_per_key(view(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_orderkey", "o_custkey", "o_orderdate")


_SRC = "SELECT CASE WHEN l_returnflag = 'R' THEN -l_orderkey ELSE l_orderkey END AS o_orderkey, max(l_suppkey) AS o_custkey, max(l_returnflag) AS o_orderstatus FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00' GROUP BY 1"


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_SRC})) UNION ALL SELECT * FROM ({_SRC})")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, with changes from lines shipped since 1996: those of an order change it, returned ones make an order of their own (negative key)."""
    orders = view(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    lines = view(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= F.lit("1996-01-01").cast("timestamp"))
    key = F.when(F.col("l_returnflag") == "R", -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    changes = lines.select(key.alias("o_orderkey"), F.col("l_suppkey").alias("o_custkey"), F.col("l_returnflag").alias("o_orderstatus")).groupBy("o_orderkey").agg(F.max("o_custkey").alias("o_custkey"), F.max("o_orderstatus").alias("o_orderstatus"))
    return upsert.upsert(orders, changes, ["o_orderkey"])


@query("SELECT 'orders' AS table_name, count(*) FILTER (CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1996-12-31') AS affected FROM orders UNION ALL SELECT 'lineitem', count(*) FILTER (CAST(l_shipdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1996-12-31') FROM lineitem")
def delete_range_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.delete_preview({n: view(spark, sf_dir, n) for n in ("orders", "lineitem")}, "1995-01-01", "1996-12-31")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE NOT coalesce(CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '1996-12-31', false)")
def delete_range_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.delete_range(view(spark, sf_dir, "orders"), "1995-01-01", "1996-12-31").select("o_orderkey", "o_orderdate")


@query()
def partition_overwrite_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all orders by status as revision 1, overwrite one status with revision 2, read back."""
    path = f"{shared_folder(spark)}/orders-{uuid.uuid4().hex}"
    orders = view(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    upsert.overwrite_partitions(orders.withColumn("revision", F.lit(1)), path, "o_orderstatus")
    upsert.overwrite_partitions(orders.where("o_orderstatus = 'F'").withColumn("revision", F.lit(2)), path, "o_orderstatus")
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderstatus", "revision")


ORACLES["partition_overwrite_result"] = "SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS revision FROM orders"


@query("SELECT max(interval_ts) + INTERVAL 1 HOUR AS start_ts FROM readings")
def watermark_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks.next_hour(view(spark, sf_dir, "readings"), "interval_ts")


@query("SELECT max(date_hour) - INTERVAL 13 HOUR AS start_ts FROM energy")
def watermark_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks.lookback(_energy(spark, sf_dir), "date_hour", 13)


@query("SELECT max(date_key) AS start_key, CAST(strptime(CAST(max(date_key) AS VARCHAR), '%Y%m%d') AS TIMESTAMP) AS start_ts FROM fact")
def watermark_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks.gold_start(_fact(spark, sf_dir), {"energy": (_energy(spark, sf_dir), "date_hour"), "weather": (_weather(spark, sf_dir), "date_hour")})


@query("SELECT facility_code, date_hour, energy_mwh FROM energy WHERE date_hour BETWEEN (SELECT date_trunc('day', min(date_hour)) FROM energy) + INTERVAL 1 DAY AND (SELECT date_trunc('day', min(date_hour)) FROM energy) + INTERVAL 3 DAY")
def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    energy = _energy(spark, sf_dir)
    start = F.date_trunc("day", F.min("date_hour"))
    span = F.broadcast(energy.agg((start + F.expr("INTERVAL 1 DAY")).alias("_from"), (start + F.expr("INTERVAL 3 DAYS")).alias("_to")))  # one row
    return energy.join(span, watermarks.within("date_hour", F.col("_from"), F.col("_to"))).select("facility_code", "date_hour", "energy_mwh")


@query("SELECT facility_code, date_hour, energy_mwh FROM energy WHERE date_hour <= TIMESTAMP '2024-01-15 00:00:00'")
def drop_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    return watermarks.drop_future(_energy(spark, sf_dir), "date_hour", F.lit("2024-01-15").cast("timestamp")).select("facility_code", "date_hour", "energy_mwh")


@query("SELECT * FROM energy")
def pipeline_incremental_equals_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of the first half, then an upsert of what follows its watermark less a lookback, gives the full result."""
    readings = view(spark, sf_dir, "readings")
    middle = F.timestamp_seconds(F.floor((F.unix_timestamp(F.min("interval_ts")) + F.unix_timestamp(F.max("interval_ts"))) / 2))
    marked = readings.crossJoin(F.broadcast(readings.agg(middle.alias("_middle"))))  # one row
    first = silver.hourly_energy(marked.where("interval_ts <= _middle"))
    later = silver.hourly_energy(marked.where("date_trunc('hour', interval_ts) >= date_trunc('hour', _middle)"))
    return upsert.upsert(first, later, ["facility_code", "facility_name", "network_code", "network_region", "date_hour"])


@query("SELECT 'energy' AS table_name, count(*) AS row_count FROM energy UNION ALL SELECT 'weather', count(*) FROM weather UNION ALL SELECT 'orders', count(*) FROM orders")
def row_count_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.row_counts({"energy": _energy(spark, sf_dir), "weather": _weather(spark, sf_dir), "orders": view(spark, sf_dir, "orders")})


@query("SELECT 'energy' AS table_name, max(n) AS max_rows_per_key, count(*) FILTER (n > 1) AS duplicate_keys FROM (SELECT count(*) AS n FROM energy GROUP BY facility_code, date_hour) UNION ALL SELECT 'lineitem', max(n), count(*) FILTER (n > 1) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def dup_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.duplicate_keys({"energy": (_energy(spark, sf_dir), ["facility_code", "date_hour"]), "lineitem": (view(spark, sf_dir, "lineitem"), ["l_orderkey"])})


@query("SELECT facility_code, count(*) FILTER (quality_flag = 'GOOD') AS good, count(*) FILTER (quality_flag = 'WARNING') AS warning, count(*) FILTER (quality_flag = 'BAD') AS bad, round(avg(completeness_pct), 4) AS avg_completeness, min(date_hour) AS first_hour, max(date_hour) AS last_hour FROM energy GROUP BY 1")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.quality_summary(_energy(spark, sf_dir), "facility_code")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, round(count(*) FILTER ({c} IS NULL) * 100E0 / count(*), 2) AS null_pct FROM air" for c in _A))
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.null_profile(_air(spark, sf_dir), list(_A))


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER ({c} NOT BETWEEN {TWIN_LIMITS[c][0]} AND {TWIN_LIMITS[c][1]}) AS out_count, round(count(*) FILTER ({c} NOT BETWEEN {TWIN_LIMITS[c][0]} AND {TWIN_LIMITS[c][1]}) * 100E0 / count({c}), 2) AS out_pct, min({c}) AS min_value, max({c}) AS max_value FROM weather" for c in _W))
def bounds_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.bounds_profile(_weather(spark, sf_dir), {c: WEATHER_BOUNDS[c] for c in _W})


@query(" UNION ALL ".join(f"SELECT '{k}' AS key_name, count(*) FILTER ({k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM {d})) AS orphans FROM fact" for k, d in (("facility_key", "fac"), ("date_key", "(SELECT CAST(strftime(weather_timestamp, '%Y%m%d') AS INTEGER) AS date_key FROM raw_weather)"), ("time_key", "(SELECT range AS time_key FROM range(24))"), ("aqi_category_key", "aqi"))))
def fk_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four keys of the fact; the date dimension has the days of the weather only, so some are orphans."""
    fac, dates = _fac(spark, sf_dir), dims.dim_date((view(spark, sf_dir, "raw_weather"), "weather_timestamp"))
    known = {"facility_key": (fac, "facility_key"), "date_key": (dates, "date_key"), "time_key": (dims.dim_time(spark), "time_key"), "aqi_category_key": (dims.dim_aqi(spark), "aqi_category_key")}
    return audit.orphan_keys(_fact(spark, sf_dir, fac), known)


_SD = "round(CAST(sum(CAST({c} AS DECIMAL(18,6))) AS DOUBLE) / count({c}), 4)"


def _dist_sql(column: str, group: str, table: str) -> str:
    p = ", ".join(f"round(quantile_cont({column}, {q / 100}), 4) AS p{q}" for q in (1, 5, 10, 50, 90, 95, 99))
    return f"SELECT {group}, count({column}) AS n, min({column}) AS min_value, {_SD.format(c=column)} AS avg_value, round(stddev_samp({column}), 2) AS std_value, max({column}) AS max_value, {p} FROM {table} GROUP BY 1"


@query(_dist_sql("l_quantity", "l_returnflag", "lineitem"))
def value_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distribution(view(spark, sf_dir, "lineitem").withColumn("l_quantity", F.col("l_quantity").cast("double")), "l_quantity", ["l_returnflag"], exact=True)


@query(_dist_sql("energy_mwh", "CAST(extract(hour FROM date_hour) AS INTEGER) AS hour_of_day", "energy"))
def hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distribution(_energy(spark, sf_dir).withColumn("hour_of_day", F.hour("date_hour")), "energy_mwh", ["hour_of_day"], exact=True)


@query(_dist_sql("energy_mwh", "facility_code", "energy"))
def facility_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.distribution(_energy(spark, sf_dir), "energy_mwh", ["facility_code"], exact=True)


@query(f"""SELECT round(count(*) FILTER (n AND energy_mwh > 1) * 100E0 / nullif(count(*) FILTER (n), 0), 4) AS night_pct, round(count(*) FILTER (dy AND energy_mwh = 0) * 100E0 / nullif(count(*) FILTER (dy), 0), 4) AS zero_pct, round(count(*) FILTER (p AND energy_mwh < m / 2) * 100E0 / nullif(count(*) FILTER (p), 0), 4) AS low_peak_pct
 FROM (SELECT energy_mwh, ({_h} >= 22 OR {_h} < 6) AS n, {_h} BETWEEN 8 AND 17 AS dy, {_h} BETWEEN 10 AND 14 AS p FROM energy), (SELECT CAST(sum(CAST(energy_mwh AS DECIMAL(18,6))) AS DOUBLE) / count(energy_mwh) AS m FROM energy WHERE {_h} BETWEEN 10 AND 14)""")
def anomaly_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.anomaly_shares(_energy(spark, sf_dir))


@query(f"SELECT facility_code, count(*) AS n, {_PR} AS pr_pct FROM base GROUP BY 1")
def pr_by_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.pr_by_facility(_fact(spark, sf_dir))


@query(f"SELECT count(*) AS n, count(*) FILTER (pr > 100) AS excluded, round((count(*) - count(*) FILTER (pr > 100)) * 100E0 / count(*), 4) AS retention_pct FROM base JOIN (SELECT facility_code, {_PR} AS pr FROM base GROUP BY 1) USING (facility_code)")
def pr_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.pr_exclusion(_fact(spark, sf_dir))


@query(f"""SELECT facility_code, pr_pct, retention_pct, coalesce(pr_pct > 60, false) AND retention_pct >= 70 AS compliant, concat_ws('; ', CASE WHEN NOT coalesce(pr_pct > 60, false) THEN 'PR too low' END, CASE WHEN retention_pct < 70 THEN 'retention too low' END) AS reason
 FROM (SELECT facility_code, pr_pct, round(coalesce(n, 0) * 100E0 / total, 4) AS retention_pct FROM (SELECT facility_code, count(*) AS total FROM fact GROUP BY 1) LEFT JOIN (SELECT facility_code, count(*) AS n, {_PR} AS pr_pct FROM base GROUP BY 1) USING (facility_code))""")
def pr_compliance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.pr_compliance(_fact(spark, sf_dir))


@query(f"SELECT threshold, sum(n) AS n, round(avg(pr), 3) AS avg_pr, min(pr) AS min_pr, max(pr) AS max_pr FROM (SELECT threshold, facility_code, count(*) AS n, {_PR} AS pr FROM base JOIN (VALUES (0.02E0), (0.05E0), (0.1E0), (0.2E0), (0.3E0), (0.4E0), (0.5E0)) t(threshold) ON irr_kwh_m2_hour >= threshold GROUP BY 1, 2) GROUP BY 1")
def pr_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.pr_sensitivity(_fact(spark, sf_dir), spark)


_c1, _c2, _c3, _c4 = "energy_mwh > 0", "total_capacity_mw > 0", "irr_kwh_m2_hour >= 0.02", "quality_flag = 'GOOD'"
_f = lambda c: f"count(*) FILTER ({c})"


@query(f"""SELECT step, filter_name, alone, round(alone * 100E0 / nullif(t, 0), 4) AS alone_pct, cumulative, round(cumulative * 100E0 / nullif(t, 0), 4) AS retention_pct, lost, round(lost * 100E0 / nullif(cumulative + lost, 0), 4) AS lost_pct, round((t - cumulative) * 100E0 / nullif(t, 0), 4) AS total_loss_pct FROM (
 SELECT t, unnest([0, 1, 2, 3, 4]) AS step, unnest(['no_filter', 'energy_positive', 'has_capacity', 'irradiance', 'good_quality']) AS filter_name, unnest([t, a1, a2, a3, a4]) AS alone, unnest([t, b1, b2, b3, b4]) AS cumulative, unnest([0, t - b1, b1 - b2, b2 - b3, b3 - b4]) AS lost
 FROM (SELECT count(*) AS t, {_f(_c1)} AS a1, {_f(_c2)} AS a2, {_f(_c3)} AS a3, {_f(_c4)} AS a4, {_f(_c1)} AS b1, {_f(f"{_c1} AND {_c2}")} AS b2, {_f(f"{_c1} AND {_c2} AND {_c3}")} AS b3, {_f(f"{_c1} AND {_c2} AND {_c3} AND {_c4}")} AS b4 FROM fact))""")
def filter_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.filter_waterfall(_fact(spark, sf_dir))


_KPI = f"""SELECT facility_code, round({_SE}, 4) AS total_mwh, {_PR} AS pr_pct, round({_SE} / nullif(CAST(max(total_capacity_mw) AS DOUBLE) * count(DISTINCT date_key) * 24, 0) * 100, 4) AS cf_calendar_pct,
 round({_SE} / nullif(CAST(max(total_capacity_mw) AS DOUBLE) * count(DISTINCT date_hour), 0) * 100, 4) AS cf_observed_pct, round({_SE} / nullif(CAST(max(total_capacity_mw) AS DOUBLE), 0), 4) AS specific_yield FROM fact GROUP BY 1"""


@query(_KPI)
def plant_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.plant_kpis(_fact(spark, sf_dir))


@query(" UNION ALL ".join(f"SELECT facility_code, '{m}' AS metric, {m} AS value, '{u}' AS unit FROM ({_KPI})" for m, u in (("total_mwh", "MWh"), ("pr_pct", "%"), ("cf_calendar_pct", "%"), ("cf_observed_pct", "%"), ("specific_yield", "kWh/kWp"))))
def plant_kpi_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.kpi_rows(kpi.plant_kpis(_fact(spark, sf_dir)))


@query("SELECT o_custkey, count(DISTINCT o_orderkey) AS n_orders, count(*) AS n_lines, CAST(sum(l_quantity) AS DOUBLE) AS sum_qty, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE), 2) AS sum_price FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1")
def customer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = view(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(view(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity", "l_extendedprice"), "o_orderkey")
    return lines.groupBy("o_custkey").agg(F.count_distinct("o_orderkey").alias("n_orders"), F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").cast("double").alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).cast("double"), 2).alias("sum_price"))


_PI = "2 * pi() * extract({p} FROM date_hour) / {n}"


@query(f"""SELECT facility_code, date_hour, energy_mwh, CAST({_h} AS DOUBLE) AS hour_of_day, CAST(dayofweek(date_hour) + 1 AS DOUBLE) AS day_of_week, CAST(month(date_hour) AS DOUBLE) AS month, CAST(dayofweek(date_hour) IN (0, 6) AS DOUBLE) AS is_weekend,
 round(sin({_PI.format(p='hour', n=24)}), 6) AS hour_sin, round(cos({_PI.format(p='hour', n=24)}), 6) AS hour_cos, round(sin({_PI.format(p='month', n=12)}), 6) AS month_sin, round(cos({_PI.format(p='month', n=12)}), 6) AS month_cos FROM energy""")
def features_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.temporal(_energy(spark, sf_dir).select("facility_code", "date_hour", "energy_mwh"))
    # Adding 0 turns a rounded -0.0 into 0.0.
    return out.withColumns({c: F.round(c, 6) + 0.0 for c in ("hour_sin", "hour_cos", "month_sin", "month_cos")})


@query(f"SELECT *, lag(energy_mwh, 1) OVER w AS energy_mwh_lag_1, lag(energy_mwh, 24) OVER w AS energy_mwh_lag_24, lag(energy_mwh, 168) OVER w AS energy_mwh_lag_168 FROM (SELECT facility_code, date_hour, max(energy_mwh) AS energy_mwh FROM energy GROUP BY 1, 2) WINDOW w AS (PARTITION BY facility_code ORDER BY date_hour)")
def features_lag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.lag_rows(_energy(spark, sf_dir).groupBy("facility_code", "date_hour").agg(F.max("energy_mwh").alias("energy_mwh")))


CTES["hourly"] = "SELECT facility_code, date_hour, max(energy_mwh) AS energy_mwh FROM energy GROUP BY 1, 2"


@query("SELECT a.*, b.energy_mwh AS energy_mwh_lag_1h, c.energy_mwh AS energy_mwh_lag_24h, d.energy_mwh AS energy_mwh_lag_168h FROM hourly a" + "".join(f" LEFT JOIN hourly {t} ON a.facility_code = {t}.facility_code AND {t}.date_hour = a.date_hour - INTERVAL {n} HOUR" for t, n in (("b", 1), ("c", 24), ("d", 168))))
def features_lag_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.lag_hours(_energy(spark, sf_dir).groupBy("facility_code", "date_hour").agg(F.max("energy_mwh").alias("energy_mwh")))


_INTERACTIONS = f"""round(shortwave_radiation * temperature_2m, 4) + 0 AS radiation_temp_interaction, round(CASE WHEN shortwave_radiation > 1e-6 THEN cloud_cover / shortwave_radiation ELSE 0 END, 6) AS cloud_radiation_ratio, round({_h} * shortwave_radiation, 4) AS hour_radiation_interaction,
 round(completeness_pct * shortwave_radiation, 4) AS completeness_radiation_interaction, round(wind_speed_10m * temperature_2m, 4) + 0 AS wind_temp_interaction, round(CASE WHEN diffuse_radiation > 1e-6 THEN direct_radiation / diffuse_radiation ELSE 0 END, 6) AS direct_diffuse_ratio,
 round(shortwave_radiation * shortwave_radiation, 4) AS shortwave_radiation_sq, round(temperature_2m * temperature_2m, 4) AS temperature_sq, round(cloud_cover * temperature_2m, 4) + 0 AS cloud_temp_interaction,
 CASE WHEN shortwave_radiation >= 10 THEN 1E0 ELSE 0E0 END AS is_production_hour"""
INTERACTIONS = {"radiation_temp_interaction": 4, "cloud_radiation_ratio": 6, "hour_radiation_interaction": 4, "completeness_radiation_interaction": 4, "wind_temp_interaction": 4, "direct_diffuse_ratio": 6, "shortwave_radiation_sq": 4, "temperature_sq": 4, "cloud_temp_interaction": 4}


@query(f"SELECT facility_code, date_hour, {_INTERACTIONS}, CASE WHEN energy_mwh <= 0.1 THEN 1E0 ELSE 0E0 END AS is_low_energy_period FROM (SELECT e.energy_mwh, e.completeness_pct, w.* FROM energy e JOIN weather w ON e.facility_code = w.facility_code AND e.date_hour = w.date_hour)")
def features_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["facility_code", "date_hour"]
    rows = _energy(spark, sf_dir).select(*keys, "energy_mwh", "completeness_pct").join(_weather(spark, sf_dir), keys).withColumn("hour_of_day", F.hour("date_hour"))
    out = features.indicators(features.interactions(rows), low_energy=0.1)
    return out.select(*keys, *[(F.round(c, n) + 0.0).alias(c) for c, n in INTERACTIONS.items()], "is_production_hour", "is_low_energy_period")


@query("SELECT split, count(*) AS n, min(date_hour) AS first_hour, max(date_hour) AS last_hour FROM (SELECT date_hour, CASE WHEN rn <= floor(t * 0.7E0) THEN 'train' WHEN rn <= floor(t * 0.85E0) THEN 'validation' ELSE 'test' END AS split FROM (SELECT date_hour, row_number() OVER (ORDER BY date_hour, facility_code) AS rn, count(*) OVER () AS t FROM hourly)) GROUP BY 1")
def split_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.temporal_split(_energy(spark, sf_dir).select("facility_code", "date_hour").distinct())
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("date_hour").alias("first_hour"), F.max("date_hour").alias("last_hour"))


_dd = "CAST(sum(CAST({x} AS DECIMAL(28,8))) AS DOUBLE)"
_y, _p = "CAST(l_extendedprice AS DOUBLE)", "CAST(l_quantity AS DOUBLE) * 1500E0"
_se, _ae, _sy, _syy = (_dd.format(x=x) for x in (f"({_y} - {_p}) * ({_y} - {_p})", f"abs({_y} - {_p})", _y, f"{_y} * {_y}"))
_mp = _dd.format(x=f"CASE WHEN {_y} <> 0 THEN abs(({_y} - {_p}) / {_y}) END")


@query(f"SELECT count(*) AS n, round(sqrt({_se} / count(*)), 4) AS rmse, round({_ae} / count(*), 4) AS mae, round({_se} / count(*), 4) AS mse, round(1 - {_se} / ({_syy} - {_sy} * {_sy} / count(*)), 4) AS r2, round({_mp} / count(*) FILTER ({_y} <> 0) * 100, 4) AS mape_pct FROM lineitem")
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").cast("double").alias("y"), (F.col("l_quantity").cast("double") * 1500.0).alias("p"))
    return features.metrics(rows, "y", "p")


@query(f"SELECT l_orderkey, l_linenumber, {_y} AS actual, {_p} AS predicted, round({_y} - {_p}, 4) AS residual, round(abs({_y} - {_p}), 4) AS absolute_error, round(abs({_y} - {_p}) / abs({_y}) * 100, 4) AS ape_pct, round(100 - abs({_y} - {_p}) / abs({_y}) * 100, 4) AS accuracy_pct, coalesce(abs({_y} - {_p}) / nullif(abs({_y}), 0) * 100 <= 10, false) AS is_accurate_forecast FROM lineitem")
def forecast_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("double").alias("y"), (F.col("l_quantity").cast("double") * 1500.0).alias("p"))
    out = facts.fact_forecast(rows, "y", "p", ["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "actual", "predicted", *[F.round(c, 4).alias(c) for c in ("residual", "absolute_error", "ape_pct", "accuracy_pct")], "is_accurate_forecast")


_TREE = ["shortwave_radiation", "temperature_2m", "cloud_cover", "hour_of_day", "energy_mwh_lag_1"]


def _training(spark, d):
    energy = features.lag_rows(_energy(spark, d).groupBy("facility_code", "date_hour").agg(F.max("energy_mwh").alias("energy_mwh")), steps=(1,)).fillna(0.0, ["energy_mwh_lag_1"])
    return energy.join(_weather(spark, d).select("facility_code", "date_hour", "shortwave_radiation", "temperature_2m", "cloud_cover"), ["facility_code", "date_hour"]).withColumn("hour_of_day", F.hour("date_hour").cast("double"))


@query()
def train_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _training(spark, sf_dir)
    model = features.train_trees(rows, _TREE, "energy_mwh", "decision_tree")
    return model.transform(rows).select("facility_code", "date_hour", "energy_mwh", "prediction")


@query()
def feature_importance_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _training(spark, sf_dir)
    return features.importance_rank(spark, features.train_trees(rows, _TREE, "energy_mwh", "gbt"), _TREE)


@query("SELECT 'NEM' AS network_code, concat('F', CAST(user_id % 8 AS STRING)) AS facility_code, concat('U', CAST(user_id AS STRING)) AS unit_code, 'energy' AS metric, '1h' AS interval, 'MWh' AS value_unit, date_trunc('second', ts) AS interval_start, value FROM events")
def flatten_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events packed as JSON payloads of one unit and hour each, parsed and flattened again."""
    rows = view(spark, sf_dir, "events").select(F.concat(F.lit("U"), "user_id").alias("unit_code"), F.pmod("user_id", F.lit(8)).alias("f"), "ts", "value")
    point = F.array(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.col("value").cast("string"))
    packed = rows.groupBy("unit_code", F.date_trunc("hour", "ts").alias("h")).agg(F.collect_list(point).alias("data"))
    result = F.array(F.struct(F.struct("unit_code", F.lit(None).cast("string").alias("facility_code")).alias("columns"), "data"))
    payload = F.to_json(F.struct(F.array(F.struct(F.lit("NEM").alias("network_code"), F.lit("energy").alias("metric"), F.lit("1h").alias("interval"), F.lit("MWh").alias("unit"), result.alias("results"))).alias("data")))
    units = rows.select("unit_code", F.concat(F.lit("F"), "f").alias("facility_code")).distinct()
    return nested.flatten_series(packed.select(F.from_json(payload, nested.SERIES).alias("j")).select("j.*"), units)


def _plants(spark, d):
    """Suppliers as plants, with all their parts as units in the order of their codes."""
    units = view(spark, d, "lineitem").select("l_suppkey", "l_partkey").distinct().join(view(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    size = F.col("p_size").cast("double")
    unit = F.struct(
        F.concat(F.lit("P"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("code"), F.when(F.col("p_size") > 25, "Operating").otherwise("RETIRED").alias("status_id"),
        F.concat(F.lit("S"), (F.col("p_size") % 10).cast("string")).alias("fueltech_id"), F.when(F.col("p_size") < 10, "generator").when(F.col("p_size") < 40, "load").alias("dispatch_type"),
        F.when(F.col("p_size") % 3 == 0, 0.0).when(F.col("p_size") % 3 == 1, size).alias("capacity_mw"), F.when(F.col("p_size") % 2 == 0, size / 2).alias("capacity_registered"), (size * 2).alias("registered_capacity"), size.alias("capacity_maximum"))
    packed = units.groupBy("l_suppkey").agg(F.array_sort(F.collect_list(unit)).alias("units"))
    plants = view(spark, d, "supplier").join(view(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    network = F.when(F.col("s_nationkey") < 20, "NEM").otherwise("WEM")
    return plants.join(packed, F.col("s_suppkey") == F.col("l_suppkey"), "left").select(F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name"), network.alias("network_id"), F.col("n_name").alias("network_region"), F.coalesce("units", F.array().cast(packed.schema["units"].dataType)).alias("units"))


CTES["units"] = """SELECT DISTINCT l_suppkey, p_partkey, p_size, CASE WHEN p_size > 25 THEN 'operating' ELSE 'retired' END AS status, 's' || (p_size % 10) AS fuel, CASE WHEN p_size < 10 THEN 'GENERATOR' WHEN p_size < 40 THEN 'LOAD' END AS dispatch,
 CASE WHEN p_size % 3 = 1 THEN p_size WHEN p_size % 2 = 0 THEN p_size / 2E0 ELSE p_size * 2E0 END AS capacity, CASE WHEN p_size % 2 = 0 THEN p_size / 2E0 ELSE p_size * 2E0 END AS registered FROM lineitem JOIN part ON l_partkey = p_partkey"""
_kinds = lambda c, name: f"(SELECT l_suppkey AS sk_{name}, string_agg(k || ':' || n, '; ' ORDER BY k) AS {name} FROM (SELECT l_suppkey, {c} AS k, count(*) AS n FROM units WHERE {c} IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"


@query(f"""SELECT CAST(s_suppkey AS STRING) AS code, s_name AS name, CAST(coalesce(n, 0) AS INTEGER) AS unit_count, total_capacity_mw, total_capacity_registered_mw, total_capacity_maximum_mw, CAST(NULL AS DOUBLE) AS total_capacity_storage_mwh, unit_fueltech_summary, unit_status_summary, unit_dispatch_summary, unit_codes FROM supplier
 LEFT JOIN (SELECT l_suppkey, count(*) AS n, round(sum(capacity), 3) AS total_capacity_mw, round(sum(registered), 3) AS total_capacity_registered_mw, CAST(sum(p_size) AS DOUBLE) AS total_capacity_maximum_mw, string_agg('P' || lpad(CAST(p_partkey AS STRING), 9, '0'), ',' ORDER BY p_partkey) AS unit_codes FROM units GROUP BY 1) u ON u.l_suppkey = s_suppkey
 LEFT JOIN {_kinds("fuel", "unit_fueltech_summary")} ON sk_unit_fueltech_summary = s_suppkey LEFT JOIN {_kinds("status", "unit_status_summary")} ON sk_unit_status_summary = s_suppkey LEFT JOIN {_kinds("dispatch", "unit_dispatch_summary")} ON sk_unit_dispatch_summary = s_suppkey""")
def facility_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.facility_summary(_plants(spark, sf_dir))


@query("SELECT CAST(s_suppkey AS STRING) AS code, s_name AS name, n_name AS network_region FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey WHERE s_nationkey < 20 AND EXISTS (SELECT 1 FROM units WHERE l_suppkey = s_suppkey AND status = 'operating' AND fuel IN ('s5', 's7'))")
def facility_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.select_facilities(_plants(spark, sf_dir), networks=["nem"], statuses=["OPERATING"], fueltechs=["S5", "s7"]).select("code", "name", "network_region")


@query("SELECT CAST(s_suppkey AS STRING) AS code, s_name AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name = (SELECT min(n_name) FROM nation)")
def facility_select_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = view(spark, sf_dir, "nation").agg(F.min("n_name")).first()[0]
    return nested.select_facilities(_plants(spark, sf_dir), region=f" {region} ").select("code", "name")


@query("SELECT facility_code, facility_name, -20E0 AS latitude, 140E0 AS longitude, date_trunc('second', interval_ts) AS date, value FROM readings")
def hourly_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings packed as columnar arrays by facility and day, and unpacked again."""
    rows = view(spark, sf_dir, "readings").select("facility_code", "facility_name", F.date_trunc("second", "interval_ts").alias("t"), "value")
    packed = rows.groupBy("facility_code", "facility_name", F.to_date("t").alias("d")).agg(F.collect_list(F.struct("t", "value")).alias("x"))
    return nested.hourly_arrays(packed.select("facility_code", "facility_name", F.lit(-20.0).alias("latitude"), F.lit(140.0).alias("longitude"), F.struct(F.col("x.t").alias("time"), F.col("x.value").alias("value")).alias("hourly")), ["value"])


def _round_trip(kind: str):
    def f(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"
        orders = view(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
        schema = "o_orderkey long, o_custkey long, o_orderstatus string"
        if kind == "csv":
            nested.export_csv({"orders": orders}, path)
            return nested.read_csv(spark, f"{path}/orders", schema)
        if kind == "json":
            orders.write.json(path)
            return nested.read_json(spark, path, schema)
        nested.write_snapshot(orders, path, "2024-01-31")
        return nested.read_table(spark, f"{path}/load_date=2024-01-31", ["o_orderkey"])

    f.__name__ = {"csv": "csv_scan", "json": "json_scan", "parquet": "snapshot_roundtrip"}[kind]
    query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")(f)


for _kind in ("csv", "json", "parquet"):
    _round_trip(_kind)


@query("SELECT o_orderkey, sha256(concat(o_orderstatus, '||', o_orderpriority)) AS row_hash FROM orders")
def row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "orders").select("o_orderkey", row_hash(["o_orderstatus", "o_orderpriority"]).alias("row_hash"))


@query("SELECT facility_code, date_hour, energy_mwh FROM energy ORDER BY date_hour DESC, facility_code, network_region LIMIT 100")
def latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _energy(spark, sf_dir).orderBy(F.desc("date_hour"), "facility_code", "network_region").limit(100).select("facility_code", "date_hour", "energy_mwh")


@query("SELECT e.facility_code, e.date_hour, c.date_key, c.full_date, c.year, c.month FROM energy e LEFT JOIN (SELECT DISTINCT CAST(strftime(date_hour, '%Y%m%d') AS INTEGER) AS date_key, CAST(date_hour AS DATE) AS full_date, year(date_hour) AS year, month(date_hour) AS month FROM energy) c ON CAST(e.date_hour AS DATE) = c.full_date")
def key_lookup_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    energy = _energy(spark, sf_dir).select("facility_code", "date_hour")
    return dims.lookup(energy, dims.dim_date((energy, "date_hour")), [(date_key(F.col("date_hour")), "date_key")], ["date_key", "full_date", "year", "month"])


@query(f"SELECT facility_code, date_hour, CAST({_h} AS INTEGER) AS time_key, CASE WHEN {_h} < 6 THEN 'Night' WHEN {_h} < 12 THEN 'Morning' WHEN {_h} < 17 THEN 'Afternoon' WHEN {_h} < 21 THEN 'Evening' ELSE 'Night' END AS time_of_day FROM energy")
def key_lookup_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.lookup(_energy(spark, sf_dir).select("facility_code", "date_hour"), dims.dim_time(spark), [(F.hour("date_hour"), "time_key")], ["time_key", "time_of_day"])


_wc = ", ".join(dims.WEATHER_CLASS)
CTES["wdim"] = f"SELECT CAST(row_number() OVER (ORDER BY {_wc}) AS INTEGER) AS weather_condition_key, * FROM (SELECT DISTINCT {_wc} FROM wclass WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in dims.WEATHER_CLASS) + ")"


@query("SELECT * FROM wdim")
def dim_weather_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_weather(_weather(spark, sf_dir))


@query("SELECT w.facility_code, w.date_hour, d.weather_condition_key FROM wclass w LEFT JOIN wdim d ON " + " AND ".join(f"w.{c} = d.{c}" for c in dims.WEATHER_CLASS))
def key_lookup_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = _weather(spark, sf_dir)
    return dims.lookup(dims.classify_weather(weather), dims.dim_weather(weather), [(F.col(c), c) for c in dims.WEATHER_CLASS], ["weather_condition_key"]).select("facility_code", "date_hour", "weather_condition_key")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count, count(DISTINCT facility_code) AS keys, min(date_hour) AS first_ts, max(date_hour) AS last_ts FROM {n}" for n in ("energy", "weather", "air")))
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.table_profile({n: (f(spark, sf_dir), "facility_code", "date_hour") for n, f in (("energy", _energy), ("weather", _weather), ("air", _air))})


@query(f"SELECT count(*) AS total, count(*) FILTER (energy_mwh < 0) AS negative, count(*) FILTER (({_h} >= 22 OR {_h} < 6) AND energy_mwh > 1) AS night_over_1, count(*) FILTER ({_h} BETWEEN 8 AND 17 AND energy_mwh = 0) AS daytime_zero FROM energy")
def filtered_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filtered_counts(_energy(spark, sf_dir))


@query(f"SELECT hour_of_day, round(m, 4) AS avg_value, round(m * 100 / max(m) OVER (), 4) AS peak_pct FROM (SELECT CAST({_h} AS INTEGER) AS hour_of_day, {_SE} / count(energy_mwh) AS m FROM energy GROUP BY 1)")
def peak_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.peak_share(_energy(spark, sf_dir), "energy_mwh", "date_hour")


@query(f"SELECT max(value) AS max_value, round(quantile_cont(value, 0.95), 4) AS p95, round(quantile_cont(value, 0.99), 4) AS p99, {_SD.format(c='value')} AS avg_value FROM readings WHERE metric = 'energy' AND extract(hour FROM interval_ts + INTERVAL 11 HOUR) BETWEEN 10 AND 14")
def peak_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "readings").where("metric = 'energy'").select("value", F.expr("interval_ts + INTERVAL 11 HOUR").alias("local_ts"))
    return audit.peak_reference(rows, "value", "local_ts", exact=True)


def _by_filter_sql(cond: str) -> str:
    """Rows and ratio of each facility under a filter."""
    e, y = (f"CAST(sum(CAST({c} AS DECIMAL({n},6))) FILTER ({cond}) AS DOUBLE)" for c, n in (("energy_mwh", 18), ("yr_weighted_kwh", 24)))
    return f"SELECT facility_code, count(*) AS total, count(*) FILTER ({cond}) AS n, round({e} * 1000 / nullif({y}, 0) * 100, 4) AS pr FROM fact GROUP BY 1"


_known = "yr_weighted_kwh IS NOT NULL"
_TWIN_SCENARIOS = {
    "all_filters": f"is_valid AND irr_kwh_m2_hour >= 0.02 AND {_known}", "without_is_valid": f"irr_kwh_m2_hour >= 0.02 AND {_known}", "irradiance_0.01": f"is_valid AND irr_kwh_m2_hour >= 0.01 AND {_known}",
    "irradiance_0.005": f"is_valid AND irr_kwh_m2_hour >= 0.005 AND {_known}", "without_irradiance": f"is_valid AND {_known}",
}


@query("SELECT *, retention_pct >= 70 AND coalesce(avg_pr > 60, false) AS compliant FROM (SELECT scenario, CAST(sum(n) AS BIGINT) AS records, round(sum(n) * 100E0 / sum(total), 4) AS retention_pct, round(avg(pr), 3) AS avg_pr, min(pr) AS min_pr, max(pr) AS max_pr FROM ("
       + " UNION ALL ".join(f"SELECT '{k}' AS scenario, * FROM ({_by_filter_sql(c)})" for k, c in _TWIN_SCENARIOS.items()) + ") GROUP BY 1)")
def filter_scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.filter_scenarios(_fact(spark, sf_dir))


@query(f"""SELECT *, new_n - old_n AS added, round(new_pr - old_pr, 4) AS pr_change, new_retention >= 70 AND new_pr > 60 AS compliant FROM (SELECT facility_code, o.total, o.n AS old_n, w.n AS new_n, round(o.n * 100E0 / o.total, 4) AS old_retention, round(w.n * 100E0 / o.total, 4) AS new_retention, coalesce(o.pr, 0) AS old_pr, coalesce(w.pr, 0) AS new_pr
 FROM ({_by_filter_sql(_TWIN_SCENARIOS["all_filters"])}) o JOIN ({_by_filter_sql("is_valid AND irr_kwh_m2_hour IS NOT NULL AND yr_weighted_kwh IS NOT NULL")}) w USING (facility_code))""")
def filter_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.filter_comparison(_fact(spark, sf_dir))


@query("SELECT facility_code, count(*) AS days, round(CAST(sum(s) AS DOUBLE) / count(s), 4) AS avg_daily_mwh, round(CAST(sum(n) AS DOUBLE) / count(n), 4) AS avg_daily_rows FROM (SELECT facility_code, date_key, sum(CAST(energy_mwh AS DECIMAL(18,6))) AS s, count(energy_mwh) AS n FROM fact GROUP BY 1, 2) GROUP BY 1")
def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.daily_stats(_fact(spark, sf_dir))


@query("SELECT facility_code, date_key, energy_mwh FROM fact WHERE date_key BETWEEN 20240105 AND 20240112")
def date_key_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written by date_key and read again for some days: only their partitions are listed and read."""
    path = f"{shared_folder(spark)}/fact-{uuid.uuid4().hex}"
    upsert.overwrite_partitions(_fact(spark, sf_dir).select("facility_code", "date_key", "energy_mwh"), path, "date_key")
    return spark.read.parquet(path).where(F.col("date_key").between(20240105, 20240112)).select("facility_code", "date_key", "energy_mwh")


@query(f"SELECT count(r) AS n, round({_dd.format(x='r')} / count(r), 4) AS mean_residual, round(quantile_cont(r, 0.5), 4) AS median_residual, round(stddev_samp(r), 2) AS residual_std, min(r) AS min_residual, max(r) AS max_residual FROM (SELECT {_y} - {_p} AS r FROM lineitem)")
def residual_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").cast("double").alias("y"), (F.col("l_quantity").cast("double") * 1500.0).alias("p"))
    return features.residual_stats(rows, "y", "p", exact=True)


@query("SELECT l_orderkey, l_linenumber, CASE WHEN md5(concat_ws('|', '42', l_orderkey, l_linenumber)) < 'cccccccc' THEN 'train' ELSE 'test' END AS split FROM lineitem")
def split_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.random_split(view(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("SELECT e.facility_code, e.date_hour, e.energy_mwh, w.shortwave_radiation, w.temperature_2m, coalesce(a.pm2_5, 0) AS pm2_5 FROM energy e JOIN weather w ON e.facility_code = w.facility_code AND e.date_hour = w.date_hour LEFT JOIN air a ON e.facility_code = a.facility_code AND e.date_hour = a.date_hour WHERE e.energy_mwh IS NOT NULL")
def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["facility_code", "date_hour"]
    rows = _energy(spark, sf_dir).where("energy_mwh IS NOT NULL").select(*keys, "energy_mwh").join(_weather(spark, sf_dir).select(*keys, "shortwave_radiation", "temperature_2m"), keys)
    return rows.join(_air(spark, sf_dir).select(*keys, "pm2_5"), keys, "left").fillna(0.0, ["pm2_5"])
