"""Dimensions and key lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helio.functions.scalars import date_key, ladder, time_of_day
from helio.operators.ranks import global_rank

#: Key, label, index range, PM2.5 range.
AQI_RANGES = (
    (1, "Good", 0, 50, 0.0, 12.0), (2, "Moderate", 51, 100, 12.1, 35.0), (3, "Unhealthy for Sensitive", 101, 150, 35.1, 55.0),
    (4, "Unhealthy", 151, 200, 55.1, 150.0), (5, "Very Unhealthy", 201, 300, 150.1, 250.0), (6, "Hazardous", 301, 500, 250.1, 500.0),
)


def dim_date(*sources: tuple[DataFrame, str]) -> DataFrame:
    """Calendar of all days in the sources."""
    days = None
    for df, ts in sources:
        one = df.select(F.to_date(ts).alias("full_date")).where("full_date IS NOT NULL")
        days = one if days is None else days.unionByName(one)
    d = F.col("full_date")
    return days.distinct().select(
        date_key(d).alias("date_key"), "full_date", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"), F.dayofmonth(d).alias("day_of_month"), (F.weekday(d) + 1).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"))


def dim_time(spark: SparkSession) -> DataFrame:
    h = F.col("id").cast("int")
    return spark.range(24).select(h.alias("time_key"), h.alias("hour"), F.lit(0).alias("minute"), time_of_day(h).alias("time_of_day"))


def dim_aqi(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(AQI_RANGES), "aqi_category_key long, aqi_category string, aqi_range_min int, aqi_range_max int, pm2_5_min double, pm2_5_max double")


#: Columns of a row that describes a trained model.
MODEL_VERSION = "model_version_key int, model_version_id string, model_name string, model_type string, model_algorithm string, train_start_date string, train_end_date string, hyperparameters string, feature_columns string, target_column string, performance_metrics string, is_active boolean, model_description string"


def dim_model_version(spark: SparkSession, records: list[dict]) -> DataFrame:
    """A row for each trained model, from records with columns of MODEL_VERSION; what a record lacks is null."""
    names = [x.split()[0] for x in MODEL_VERSION.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], MODEL_VERSION)


def dim_facility(facilities: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per code with a dense key, from current rows where the table tells them; keys that are ``known`` (facility_key, facility_code) stay. Fresh keys are ranks over ranges of codes."""
    if "is_current" in facilities.columns:
        facilities = facilities.where("is_current")
    one = facilities.withColumn("_rn", F.row_number().over(Window.partitionBy("facility_code").orderBy(F.desc_nulls_last("facility_name")))).where("_rn = 1 AND facility_code IS NOT NULL").drop("_rn")
    if known is not None:
        one = one.join(known.select("facility_code", F.col("facility_key").alias("_key")), "facility_code", "left")
        top = F.broadcast(one.agg(F.coalesce(F.max("_key"), F.lit(0)).alias("_top")))
        fresh = global_rank(one.where("_key IS NULL"), [F.col("facility_code")], "_fresh").crossJoin(top)
        one = one.where("_key IS NOT NULL").unionByName(fresh.withColumn("_key", F.col("_top") + F.col("_fresh")).drop("_top", "_fresh"))
    else:
        one = global_rank(one, [F.col("facility_code")], "_key")
    return one.select(F.col("_key").cast("int").alias("facility_key"), "facility_code", "facility_name", *[F.col(c).try_cast("decimal(10,6)").alias(c) for c in ("location_lat", "location_lng")], F.col("total_capacity_mw").try_cast("decimal(10,4)").alias("total_capacity_mw"))


def lookup(fact: DataFrame, dim: DataFrame, on: list[tuple[Column, str]], take: list[str], how: str = "left", required: bool = False) -> DataFrame:
    """Fact rows with columns of the matching dimension row; null keys match nothing. Spark broadcasts the dimension if its size allows. ``required``: empty inputs raise."""
    if required and (fact.isEmpty() or dim.isEmpty()):
        raise ValueError("fact and dimension must have rows")
    d = dim.select(*[F.col(c).alias(f"_k{i}") for i, (_, c) in enumerate(on)], *[F.col(c).alias(f"_d_{c}") for c in take])
    cond = [expr == d[f"_k{i}"] for i, (expr, _) in enumerate(on)]
    return fact.join(d, cond, how).drop(*[f"_k{i}" for i in range(len(on))]).withColumnsRenamed({f"_d_{c}": c for c in take})


def range_lookup(fact: DataFrame, value: str, dim: DataFrame, low: str, high: str, take: list[str], how: str = "left") -> DataFrame:
    """Fact rows with the range that holds the value. ``dim`` is a small fixed table of ranges apart from each other."""
    d = dim.select(F.col(low).alias("_lo"), F.col(high).alias("_hi"), *take)
    return fact.join(F.broadcast(d), F.col(value).between(F.col("_lo"), F.col("_hi")), how).drop("_lo", "_hi")


def classify_weather(df: DataFrame) -> DataFrame:
    sun, cloud, t = F.col("shortwave_radiation"), F.col("cloud_cover"), F.col("temperature_2m")
    level = lambda a, b, c: ladder(sun, [(800, a), (300, b)], c, below=False)
    return df.withColumns({
        "condition_name": level("High Radiation", "Moderate Radiation", "Low Radiation"), "radiation_level": level("High", "Medium", "Low"),
        "cloud_category": ladder(cloud, [(20, "Clear"), (70, "Partly Cloudy")], "Overcast"), "temperature_range": ladder(t, [(10, "Cold"), (25, "Mild")], "Hot"),
        "weather_severity": F.when(sun < 100, "High").when(cloud > 80, "Medium").when(sun.isNotNull() & cloud.isNotNull(), "Low"),
    })


def classify_air(df: DataFrame) -> DataFrame:
    return df.withColumn("aq_category", ladder(F.col("pm2_5"), [(12.0, "Good"), (35.4, "Moderate"), (55.4, "Unhealthy")], "Hazardous"))


WEATHER_CLASS = ("condition_name", "radiation_level", "cloud_category", "temperature_range", "weather_severity")


def dim_weather(weather: DataFrame) -> DataFrame:
    """The combinations of weather classes that occur, with a dense key; at most 81, as each class has three values and two of them go together."""
    rows = classify_weather(weather).select(*WEATHER_CLASS).dropna().distinct()
    return rows.withColumn("weather_condition_key", F.row_number().over(Window.orderBy(*WEATHER_CLASS)))


def _first_per_hour(df: DataFrame) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in df.columns if c not in ("facility_code", "date_hour")]
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy("facility_code", "date_hour").orderBy(*order))).where("_rn = 1").drop("_rn")


def weather_lookup(weather: DataFrame, conditions: DataFrame) -> DataFrame:
    """Weather with the key of its class, one row for each facility and hour (the first by all columns), to join hourly facts on."""
    keyed = lookup(classify_weather(weather), conditions, [(F.col(c), c) for c in WEATHER_CLASS], ["weather_condition_key"])
    return _first_per_hour(keyed.select("facility_code", "date_hour", F.to_date("date_hour").alias("full_date"), "weather_condition_key", "shortwave_radiation", "direct_radiation", "diffuse_radiation", "temperature_2m", "cloud_cover", "wind_speed_10m", "precipitation", "sunshine_duration", "weather_severity"))


def air_lookup(air: DataFrame, categories: DataFrame) -> DataFrame:
    """Air quality with the key of its category (air_quality_category_key, category_name), one row for each facility and hour."""
    keyed = lookup(classify_air(air), categories, [(F.col("aq_category"), "category_name")], ["air_quality_category_key"])
    return _first_per_hour(keyed.select("facility_code", "date_hour", F.to_date("date_hour").alias("full_date"), "air_quality_category_key", "pm2_5", "pm10", "dust", "nitrogen_dioxide", "ozone", "uv_index"))
