"""Registered queries of loading: sinks, upserts, watermarks, audit columns, facility master, ordered layers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.functions.scalars import network_offset, network_zone, season
from helio.operators import dims, facts, silver, upsert, watermarks
from helio.plans.queries import CTES, _air, _energy, _fac, _weather, query
from helio.plans.sample import view
from helio.sources import nested
from helio.sources.shared import shared_folder

_ORDERS = ("o_orderkey", "o_custkey", "o_orderstatus")


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def append_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders added to a partitioned table in two loads, the first of which creates it."""
    path, orders = _path(spark, "append"), view(spark, sf_dir, "orders").select(*_ORDERS)
    for load in (orders.where("o_orderstatus = 'O'"), orders.where("o_orderstatus <> 'O'")):
        nested.append_table(load, path, ["o_orderstatus"])
    return spark.read.parquet(path).select(*_ORDERS)


@query("SELECT s_suppkey, s_name FROM supplier")
def master_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master data written from another table first, then replaced as a whole."""
    path = _path(spark, "master")
    nested.overwrite_table(view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("s_name")), path)
    nested.overwrite_table(view(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, true AS created, false AS created_again FROM orders")
def empty_then_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty table is created once, then orders are added to it."""
    path = _path(spark, "empty")
    made = [nested.create_empty(spark, path, "o_orderkey long, o_custkey long, o_orderstatus string") for _ in range(2)]
    nested.append_table(view(spark, sf_dir, "orders").select(*_ORDERS), path)
    return spark.read.parquet(path).withColumns({"created": F.lit(made[0]), "created_again": F.lit(made[1])})


@query("""SELECT facility_code, weather_timestamp, facility_name, CASE WHEN weather_timestamp >= TIMESTAMP '2024-01-10 00:00:00' THEN temperature_2m + 1 ELSE temperature_2m END AS temperature_2m,
 CASE WHEN weather_timestamp >= TIMESTAMP '2024-01-10 00:00:00' THEN 0E0 ELSE cloud_cover END AS cloud_cover, wind_speed_10m FROM raw_weather
 UNION ALL SELECT facility_code, weather_timestamp + INTERVAL 10 YEAR, NULL, temperature_2m + 1, 0E0, NULL FROM raw_weather WHERE weather_timestamp >= TIMESTAMP '2024-01-10 00:00:00'""")
def upsert_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather of the last days corrected in two columns, and the same as new rows ten years later; the key comes from the columns."""
    target = view(spark, sf_dir, "raw_weather").select("facility_code", "weather_timestamp", "facility_name", "temperature_2m", "cloud_cover", "wind_speed_10m")
    late = target.where("weather_timestamp >= TIMESTAMP '2024-01-10 00:00:00'").withColumns({"temperature_2m": F.col("temperature_2m") + 1, "cloud_cover": F.lit(0.0)})
    source = late.unionByName(late.withColumn("weather_timestamp", F.col("weather_timestamp") + F.expr("INTERVAL 10 YEARS")))
    return upsert.upsert_listed(target, source, ["temperature_2m", "cloud_cover"])


@query("SELECT facility_code, interval_ts, metric, value, ingest_seq FROM (SELECT *, row_number() OVER (PARTITION BY facility_code, interval_ts, metric ORDER BY ingest_seq DESC) AS rn FROM (SELECT facility_code, date_trunc('hour', interval_ts) AS interval_ts, metric, value, ingest_seq FROM readings)) WHERE rn = 1")
def backfill_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings by facility, hour and metric: the latest of each key overwrites the whole table."""
    path = _path(spark, "backfill")
    rows = view(spark, sf_dir, "readings").select("facility_code", F.date_trunc("hour", "interval_ts").alias("interval_ts"), "metric", "value", "ingest_seq")
    upsert.backfill(rows, path, ["facility_code", "interval_ts", "metric"], [F.desc("ingest_seq")])
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def upsert_partitions_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status; those of one status move to another partition by an upsert, and none stays behind."""
    path, orders = _path(spark, "moved"), view(spark, sf_dir, "orders").select(*_ORDERS)
    upsert.upsert_partitions(spark, path, orders, ["o_orderkey"], "o_orderstatus")
    upsert.upsert_partitions(spark, path, orders.where("o_orderstatus = 'P'").withColumn("o_orderstatus", F.lit("F")), ["o_orderkey"], "o_orderstatus")
    return spark.read.parquet(path).select(*_ORDERS)


@query("""SELECT 'loaded' AS state, CAST(max(weather_timestamp) AS DATE) AS start_date FROM raw_weather UNION ALL SELECT 'empty', DATE '2024-05-31'""")
def watermark_reload_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather, today = view(spark, sf_dir, "raw_weather"), F.lit("2024-06-01").cast("date")
    state = lambda df, name: watermarks.reload_day(df, "weather_timestamp", today).withColumn("state", F.lit(name))
    return state(weather, "loaded").unionByName(state(weather.where("weather_timestamp IS NULL"), "empty"))


@query("SELECT 'past' AS state, date_trunc('hour', max(date_hour)) - INTERVAL 13 HOUR AS start_ts FROM energy UNION ALL SELECT 'ahead', TIMESTAMP '2024-01-05 10:00:00' - INTERVAL 13 HOUR UNION ALL SELECT 'empty', NULL")
def watermark_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the last hour is in the past, where it is ahead of now, and where nothing is loaded."""
    energy = _energy(spark, sf_dir)
    state = lambda df, now, name: watermarks.lookback(df, "date_hour", 13, F.lit(now).cast("timestamp")).withColumn("state", F.lit(name))
    return state(energy, "2034-01-01 00:30:00", "past").unionByName(state(energy, "2024-01-05 10:30:00", "ahead")).unionByName(state(energy.where("date_hour IS NULL"), "2034-01-01 00:30:00", "empty"))


@query("SELECT 'past' AS state, CAST(max(o_orderdate) AS DATE) + 1 AS start_date FROM orders UNION ALL SELECT 'ahead', DATE '1995-01-01' UNION ALL SELECT 'empty', NULL")
def watermark_next_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = view(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    state = lambda df, today, name: watermarks.next_day(df, "day", F.lit(today).cast("date")).withColumn("state", F.lit(name))
    return state(days, "2034-01-01", "past").unionByName(state(days, "1995-01-01", "ahead")).unionByName(state(days.where("day IS NULL"), "1995-01-01", "empty"))


@query("SELECT 'open' AS state, min(interval_ts) AS start_ts FROM readings UNION ALL SELECT 'later', min(interval_ts) FROM readings UNION ALL SELECT 'earlier', TIMESTAMP '2020-01-01 00:00:00'")
def watermark_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No start asked for, one after the earliest reading (pulled back), one before it."""
    readings = view(spark, sf_dir, "readings")
    state = lambda name, asked: watermarks.first_load(readings, "interval_ts", asked).withColumn("state", F.lit(name))
    at = lambda t: F.lit(t).cast("timestamp")
    return state("open", None).unionByName(state("later", at("2034-01-01"))).unionByName(state("earlier", at("2020-01-01")))


@query("SELECT least((SELECT max(date_hour) FROM energy) + INTERVAL 1 HOUR, (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) + INTERVAL 1 DAY) AS start_ts, CAST(strftime(least((SELECT max(date_hour) FROM energy) + INTERVAL 1 HOUR, (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) + INTERVAL 1 DAY), '%Y%m%d') AS INTEGER) AS start_key")
def watermark_gold_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing in the fact yet: after the source that is furthest behind, by hours or by days."""
    energy = _energy(spark, sf_dir)
    nothing = energy.where("date_hour IS NULL").select(F.lit(0).alias("date_key"))
    return watermarks.gold_start(nothing, {"energy": (energy, "date_hour"), "orders": (view(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")), "day")})


@query("SELECT facility_code, interval_ts, value, 'incremental' AS ingest_mode, TIMESTAMP '2024-06-01 12:00:00' AS ingest_timestamp, DATE '2024-06-01' AS ingest_date FROM readings")
def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.ingested(view(spark, sf_dir, "readings").select("facility_code", "interval_ts", "value"), "incremental", F.lit("2024-06-01 12:00:00").cast("timestamp"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-06-01 00:00:00' END AS created_at, TIMESTAMP '2024-06-01 00:00:00' AS updated_at FROM orders""")
def load_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one status were loaded before, so they keep their time of creation."""
    first, now = (F.lit(t).cast("timestamp") for t in ("2024-01-01", "2024-06-01"))
    orders = view(spark, sf_dir, "orders").withColumn("created_at", F.when(F.col("o_orderstatus") == "F", first))
    return silver.with_load_times(orders, now).select("o_orderkey", "created_at", "updated_at")


@query("SELECT ingest_seq, date_trunc('second', interval_ts) AS interval_ts, CAST(interval_ts AS DATE) AS interval_date FROM readings WHERE metric <> 'price' UNION ALL SELECT ingest_seq, NULL, NULL FROM readings WHERE metric = 'price'")
def typed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as text to timestamps and dates; the text of one metric is no time."""
    text = F.when(F.col("metric") == "price", "soon").otherwise(F.date_format("interval_ts", "yyyy-MM-dd HH:mm:ss"))
    rows = view(spark, sf_dir, "readings").select("ingest_seq", text.alias("interval_start"))
    return nested.typed_times(rows, {"interval": "interval_start"}).drop("interval_start")


_ZONES = {"F1": "Australia/Perth", "F2": "Asia/Kolkata", "F3": "UTC"}
CTES["zoned"] = "SELECT facility_code, interval_ts + CASE facility_code WHEN 'F1' THEN INTERVAL 480 MINUTE WHEN 'F2' THEN INTERVAL 330 MINUTE WHEN 'F3' THEN INTERVAL 0 MINUTE ELSE INTERVAL 600 MINUTE END + INTERVAL 1 HOUR AS local_end, value FROM readings WHERE metric = 'energy'"


@query("SELECT facility_code, date_trunc('hour', local_end) AS date_hour, CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS energy_mwh, count(value) AS intervals_count FROM zoned GROUP BY 1, 2")
def hourly_energy_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours in the zone of each facility, one of them by half hours from UTC."""
    return silver.hourly_energy(view(spark, sf_dir, "readings"), zones=_ZONES).select("facility_code", "date_hour", "energy_mwh", "intervals_count")


@query("SELECT s_suppkey, CASE WHEN s_nationkey < 8 THEN 'WEM' WHEN s_nationkey < 20 THEN 'NEM' ELSE 'NZ' END AS network_id, CASE WHEN s_nationkey < 8 THEN 'Australia/Perth' ELSE 'Australia/Brisbane' END AS zone, CASE WHEN s_nationkey < 8 THEN 8 ELSE 10 END AS utc_offset FROM supplier")
def network_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.when(F.col("s_nationkey") < 8, "WEM").when(F.col("s_nationkey") < 20, "NEM").otherwise("NZ")
    return view(spark, sf_dir, "supplier").select("s_suppkey", n.alias("network_id"), network_zone(n).alias("zone"), network_offset(n).alias("utc_offset"))


@query("SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'Summer' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'Autumn' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'Winter' ELSE 'Spring' END AS season, minute(o_orderdate) AS minute, dayofyear(o_orderdate) AS day_of_year FROM orders")
def seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "orders").select("o_orderkey", season(F.month("o_orderdate")).alias("season"), F.minute("o_orderdate").cast("long").alias("minute"), F.dayofyear("o_orderdate").cast("long").alias("day_of_year"))


@query("SELECT 'F' || s_suppkey AS code, CASE WHEN s_nationkey = 3 THEN 'F' || s_suppkey ELSE s_name END AS name, -20E0 - s_suppkey % 25 AS latitude, 140E0 + s_suppkey % 15 AS longitude FROM supplier WHERE s_acctbal >= 0")
def facility_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plants of suppliers; those with a debt have no latitude, and those of one nation no name."""
    base = view(spark, sf_dir, "supplier").select(F.concat(F.lit("F"), "s_suppkey").alias("facility_code"), "s_nationkey", "s_acctbal")
    known = view(spark, sf_dir, "raw_facilities").join(base, "facility_code")
    rows = known.withColumns({"location_lat": F.when(F.col("s_acctbal") >= 0, F.col("location_lat")), "facility_name": F.when(F.col("s_nationkey") == 3, "").otherwise(F.col("facility_name"))})
    return nested.locations(rows)


_ATTR = "facility_name, network_id, network_region, location_lat, location_lng, unit_count, total_capacity_mw, CAST(NULL AS DECIMAL(10,4)) AS total_capacity_registered_mw, CAST(NULL AS DECIMAL(10,4)) AS total_capacity_maximum_mw, CAST(NULL AS VARCHAR) AS unit_fueltech_summary, CAST(NULL AS VARCHAR) AS unit_status_summary, CAST(NULL AS VARCHAR) AS facility_description"
_HASH = "sha256(concat(coalesce(facility_name, ''), '||', coalesce(network_id, ''), '||', coalesce(network_region, ''), '||', location_lat, '||', location_lng, '||', unit_count, '||', total_capacity_mw, '||||||||||'))"
CTES["master0"] = f"SELECT facility_code, effective_from, {_ATTR}, {_HASH} AS row_hash FROM (SELECT facility_code, effective_from, facility_name, network_id, network_region, CAST(location_lat AS DECIMAL(10,6)) AS location_lat, CAST(location_lng AS DECIMAL(10,6)) AS location_lng, unit_count, CAST(total_capacity_mw AS DECIMAL(10,4)) AS total_capacity_mw FROM facility_history)"
CTES["master1"] = "SELECT *, lag(row_hash) OVER (PARTITION BY facility_code ORDER BY effective_from) AS before FROM master0"
CTES["master"] = """SELECT * EXCLUDE (before), lead(effective_from) OVER w AS effective_to, lead(effective_from) OVER w IS NULL AS is_current, total_capacity_mw > 0 AS is_valid, CASE WHEN total_capacity_mw > 0 THEN 'GOOD' ELSE 'CAPACITY_INVALID' END AS quality_flag
 FROM master1 WHERE before IS NULL OR before <> row_hash WINDOW w AS (PARTITION BY facility_code ORDER BY effective_from)"""


@query("SELECT * FROM master")
def facility_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.facility_master(view(spark, sf_dir, "facility_history"))


@query("SELECT * FROM master")
def facility_master_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known before 1996, then the rest against its current versions: upserted, it is the full history."""
    raw = view(spark, sf_dir, "facility_history")
    first = silver.facility_master(raw.where("effective_from < TIMESTAMP '1996-01-01 00:00:00'"))
    later = silver.facility_master(raw.where("effective_from >= TIMESTAMP '1996-01-01 00:00:00'"), first)
    return upsert.upsert(first, later, ["facility_code", "effective_from"])


@query("SELECT CAST(row_number() OVER (ORDER BY facility_code) AS INTEGER) AS facility_key, facility_code, facility_name, location_lat, location_lng, total_capacity_mw FROM master WHERE is_current")
def dim_facility_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension from the current versions of the master."""
    return dims.dim_facility(silver.facility_master(view(spark, sf_dir, "facility_history")))


def layer_run_tables(spark: SparkSession, sf_dir: str, base: str) -> dict[str, DataFrame]:
    """Raw tables to hourly tables to dimensions to the fact, each written under ``base`` and read again by the next layer; a layer without rows stops the run."""

    def stored(name: str, df: DataFrame) -> DataFrame:
        nested.overwrite_table(df, f"{base}/{name}")
        out = nested.read_table(spark, f"{base}/{name}", df.columns)
        facts.require(**{name: out})
        return out

    raw = {n: stored(f"raw_{n}", view(spark, sf_dir, v)) for n, v in (("readings", "readings"), ("weather", "raw_weather"), ("air", "raw_air_quality"), ("facilities", "raw_facilities"))}
    hourly = {"energy": stored("energy", silver.hourly_energy(raw["readings"])), "weather": stored("weather", silver.hourly_weather(raw["weather"])), "air": stored("air", silver.hourly_air_quality(raw["air"]))}
    dimensions = {"facility": stored("dim_facility", dims.dim_facility(raw["facilities"])), "date": stored("dim_date", dims.dim_date(*[(df, "date_hour") for df in hourly.values()])), "time": stored("dim_time", dims.dim_time(spark)), "aqi": stored("dim_aqi", dims.dim_aqi(spark))}
    fact = facts.fact_environmental(hourly["energy"], hourly["weather"], hourly["air"], dimensions["facility"], dimensions["aqi"])
    fact = silver.with_load_times(facts.typed(fact, facts.FACT_COLUMNS), F.lit("2024-06-01").cast("timestamp"))
    upsert.overwrite_partitions(fact, f"{base}/fact", "date_key")
    return {**hourly, **dimensions, "fact": nested.read_table(spark, f"{base}/fact", ["date_key"])}


@query("SELECT facility_code, date_hour, CAST(energy_mwh AS DECIMAL(12,6)) AS energy_mwh, TRY_CAST(CAST(irr_kwh_m2_hour AS VARCHAR) AS DECIMAL(10,6)) AS irr_kwh_m2_hour, TIMESTAMP '2024-06-01 00:00:00' AS created_at, TIMESTAMP '2024-06-01 00:00:00' AS updated_at, facility_key, date_key, time_key, aqi_category_key, quality_flag, full_date, time_of_day FROM fact JOIN (SELECT DISTINCT CAST(strftime(date_hour, '%Y%m%d') AS INTEGER) AS date_key, CAST(date_hour AS DATE) AS full_date FROM energy) USING (date_key) JOIN (SELECT range AS time_key, CASE WHEN range < 6 THEN 'Night' WHEN range < 12 THEN 'Morning' WHEN range < 17 THEN 'Afternoon' WHEN range < 21 THEN 'Evening' ELSE 'Night' END AS time_of_day FROM range(24)) USING (time_key)")
def layer_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers in order, and the typed fact with its dimensions as stored: facility, day and hour come from their keys."""
    t = layer_run_tables(spark, sf_dir, _path(spark, "layers"))
    fact = t["fact"].select("energy_mwh", "irr_kwh_m2_hour", "facility_key", "date_key", "time_key", "aqi_category_key", "quality_flag", "created_at", "updated_at")
    star = fact.join(t["date"].select("date_key", "full_date"), "date_key").join(t["time"].select("time_key", "time_of_day"), "time_key").join(t["facility"].select("facility_key", "facility_code"), "facility_key")
    return star.withColumn("date_hour", F.timestamp_seconds(F.unix_timestamp(F.col("full_date").cast("timestamp")) + F.col("time_key") * 3600))


CTES["wlook"] = "SELECT w.facility_code, w.date_hour, CAST(w.date_hour AS DATE) AS full_date, d.weather_condition_key, x.shortwave_radiation, x.direct_radiation, x.diffuse_radiation, x.temperature_2m, x.cloud_cover, x.wind_speed_10m, x.precipitation, x.sunshine_duration, w.weather_severity FROM wclass w JOIN weather x ON w.facility_code = x.facility_code AND w.date_hour = x.date_hour LEFT JOIN wdim d ON " + " AND ".join(f"w.{c} = d.{c}" for c in dims.WEATHER_CLASS)


@query("SELECT * FROM wlook")
def weather_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly weather twice over, with the key of its class: one row an hour comes back."""
    weather = _weather(spark, sf_dir)
    return dims.weather_lookup(weather.unionByName(weather), dims.dim_weather(weather))


@query("SELECT a.facility_code, a.date_hour, CAST(a.date_hour AS DATE) AS full_date, CASE WHEN pm2_5 <= 12.0 THEN 1 WHEN pm2_5 <= 35.4 THEN 2 WHEN pm2_5 <= 55.4 THEN 3 WHEN pm2_5 IS NOT NULL THEN 4 END AS air_quality_category_key, pm2_5, pm10, dust, nitrogen_dioxide, ozone, uv_index FROM air a")
def air_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    air = _air(spark, sf_dir)
    categories = spark.createDataFrame([(1, "Good"), (2, "Moderate"), (3, "Unhealthy"), (4, "Hazardous")], "air_quality_category_key int, category_name string")
    return dims.air_lookup(air.unionByName(air), categories)


_kind = {"energy_mwh": "DECIMAL(12,6)", "shortwave_radiation": "DECIMAL(10,4)", "direct_radiation": "DECIMAL(10,4)", "diffuse_radiation": "DECIMAL(10,4)", "direct_normal_irradiance": "DECIMAL(10,4)", "irr_kwh_m2_hour": "DECIMAL(10,6)", "sunshine_hours": "DECIMAL(6,3)"}


@query("SELECT facility_key, date_key, time_key, aqi_category_key, intervals_count, " + ", ".join(f"TRY_CAST(CAST({c} AS VARCHAR) AS {k}) AS {c}" for c, k in _kind.items()) + ", TRY_CAST(round(yr_weighted_kwh, 6) AS DECIMAL(16,6)) AS yr_weighted_kwh, round(humidity_2m, 6) AS humidity_2m, " + ", ".join(c for c in facts.FACT_COLUMNS if c not in (*_kind, "facility_key", "date_key", "time_key", "aqi_category_key", "intervals_count", "yr_weighted_kwh", "humidity_2m")) + " FROM fact")
def fact_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The environmental fact in the columns, order and types of its table."""
    fact = facts.fact_environmental(_energy(spark, sf_dir), _weather(spark, sf_dir), _air(spark, sf_dir), _fac(spark, sf_dir), dims.dim_aqi(spark))
    return facts.typed(fact.withColumns({"humidity_2m": F.round("humidity_2m", 6), "yr_weighted_kwh": F.round("yr_weighted_kwh", 6)}), facts.FACT_COLUMNS)
