"""Fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helio.functions.scalars import date_key, humidity
from helio.operators.dims import lookup, range_lookup
from helio.operators.rules import AIR_BOUNDS, WEATHER_BOUNDS


#: Columns of the environmental fact and, where they are cast, their types.
FACT_COLUMNS = {
    "facility_key": None, "date_key": None, "time_key": None, "aqi_category_key": None, "energy_mwh": "decimal(12,6)", "intervals_count": None,
    "shortwave_radiation": "decimal(10,4)", "direct_radiation": "decimal(10,4)", "diffuse_radiation": "decimal(10,4)", "direct_normal_irradiance": "decimal(10,4)",
    "irr_kwh_m2_hour": "decimal(10,6)", "sunshine_hours": "decimal(6,3)", "temperature_2m": None, "dew_point_2m": None, "humidity_2m": None,
    "cloud_cover": None, "cloud_cover_low": None, "cloud_cover_mid": None, "cloud_cover_high": None, "precipitation": None,
    "wind_speed_10m": None, "wind_direction_10m": None, "wind_gusts_10m": None, "pressure_msl": None,
    "pm2_5": None, "pm10": None, "dust": None, "nitrogen_dioxide": None, "ozone": None, "sulphur_dioxide": None, "carbon_monoxide": None, "uv_index": None, "uv_index_clear_sky": None,
    "aqi_value": None, "is_valid": None, "quality_flag": None, "completeness_pct": None, "yr_weighted_kwh": "decimal(16,6)",
}


def one_per(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key: the first by all other columns, nulls last."""
    order = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def aligned(main: DataFrame, sides: dict[str, tuple[DataFrame, list[str]]], keys: list[str]) -> DataFrame:
    """Rows of ``main`` with columns of each side's first row of equal keys, by its columns in their order, nulls last; null keys match nothing.

    All tables go through one exchange by the keys: their rows are tagged and stacked, a group's side rows come first, and
    each row of ``main`` takes the first that has come by. So no side is deduplicated or joined by itself.
    """
    rest = [c for c in main.columns if c not in keys]
    stacked = main.select(*keys, F.lit(len(sides)).alias("_tag"), *[F.col(c).alias(f"_m_{c}") for c in rest])
    for tag, (name, (df, columns)) in enumerate(sides.items()):
        known = df.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
        stacked = stacked.unionByName(known.select(*keys, F.lit(tag).alias("_tag"), *[F.col(c).alias(f"{name}_{c}") for c in columns]), allowMissingColumns=True)
    order = Window.partitionBy(*keys).orderBy("_tag", *[F.col(f"{name}_{c}").asc_nulls_last() for name, (_, columns) in sides.items() for c in columns])
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = lambda tag, name, columns: F.first(F.when(F.col("_tag") == tag, F.struct(*[F.col(f"{name}_{c}").alias(c) for c in columns])), ignorenulls=True).over(before)
    met = stacked.withColumns({name: first(tag, name, columns) for tag, (name, (_, columns)) in enumerate(sides.items())}).where(F.col("_tag") == len(sides))
    return met.select(*keys, *[F.col(f"_m_{c}").alias(c) for c in rest], *[F.col(f"{name}.{c}") for name, (_, columns) in sides.items() for c in columns])


def typed(df: DataFrame, columns: dict[str, str | None], absent: str = "double") -> DataFrame:
    """The columns of a schema list in its order; what is absent is null, what does not fit its type too."""
    pick = lambda c, kind: F.col(c) if c in df.columns else F.lit(None).cast(kind or absent)
    return df.select(*[(pick(c, kind).try_cast(kind) if kind else pick(c, kind)).alias(c) for c, kind in columns.items()])


def require(**tables: DataFrame | None) -> None:
    """Raise if a table is missing or has no rows."""
    empty = [name for name, df in tables.items() if df is None or df.isEmpty()]
    if empty:
        raise ValueError(f"missing or empty: {', '.join(empty)}")


#: Measures that flags and figures come from.
CORE_WEATHER = ["shortwave_radiation", "temperature_2m", "dew_point_2m", "cloud_cover", "sunshine_duration"]
CORE_AIR = ["pm2_5", "aqi_value"]


def fact_environmental(energy: DataFrame, weather: DataFrame, air: DataFrame, facilities: DataFrame, aqi: DataFrame, core: bool = False) -> DataFrame:
    """One row per energy hour: keys, measures of all sources, completeness and flags. Weather and air are aligned on (facility, hour).

    Of several rows there the first by the core measures counts, then by the others. ``core`` leaves these out, so
    studies that do not need them do not sort by them either.
    """
    more = lambda df, have, bounds: [] if core else [c for c in bounds if c in df.columns and c not in have]
    sides = {"_w": (weather, [*CORE_WEATHER, *more(weather, CORE_WEATHER, WEATHER_BOUNDS)]), "_a": (air, [*CORE_AIR, *more(air, CORE_AIR, AIR_BOUNDS)])}
    fact = aligned(energy.select("facility_code", "date_hour", "energy_mwh", "intervals_count"), sides, ["facility_code", "date_hour"])
    fact = lookup(fact, facilities, [(F.col("facility_code"), "facility_code")], ["facility_key", "total_capacity_mw"])
    fact = range_lookup(fact, "aqi_value", aqi, "aqi_range_min", "aqi_range_max", ["aqi_category_key"])
    part = lambda c, p: F.when(F.col(c).isNotNull(), p).otherwise(0.0)
    done = part("energy_mwh", 33.33) + part("shortwave_radiation", 33.33) + part("pm2_5", 33.34)
    irr = F.col("shortwave_radiation") / 1000.0
    valid = F.coalesce(F.col("energy_mwh") >= 0, F.lit(False))
    fact = fact.withColumns({
        "date_key": date_key(F.to_date("date_hour")), "time_key": F.hour("date_hour"), "completeness_pct": done.cast("decimal(5,2)"), "is_valid": valid,
        "irr_kwh_m2_hour": irr, "sunshine_hours": F.col("sunshine_duration") / 3600.0, "yr_weighted_kwh": irr * F.col("total_capacity_mw").cast("double") * 1000.0,
        "humidity_2m": humidity(F.col("temperature_2m"), F.col("dew_point_2m")),
    })
    return fact.withColumn("quality_flag", F.when(~valid, "BAD").when(F.col("completeness_pct") >= 90, "GOOD").when(F.col("completeness_pct") >= 50, "WARNING").otherwise("BAD"))


def fact_forecast(predictions: DataFrame, actual: str, predicted: str, keys: list[str]) -> DataFrame:
    """Predictions with error columns and an id from the digest of their keys, so that equal keys have equal ids wherever they are computed. APE is null where the actual value is 0."""
    a, p = F.col(actual), F.col(predicted)
    ape = F.try_divide(F.abs(a - p), F.abs(a)) * 100
    return predictions.select(F.conv(F.substring(F.md5(F.concat_ws("|", *keys)), 1, 15), 16, 10).cast("long").alias("forecast_id"), *keys, a.alias("actual"), p.alias("predicted"), (a - p).alias("residual"), F.abs(a - p).alias("absolute_error"),
                              ape.alias("ape_pct"), (100 - ape).alias("accuracy_pct"), F.coalesce(ape <= 10, F.lit(False)).alias("is_accurate_forecast"))


def fact_forecast_star(forecast: DataFrame, model: DataFrame, facilities: DataFrame, dates: DataFrame, times: DataFrame, made: Column, now: Column) -> DataFrame:
    """Forecast rows with the attributes of facility, date and time, joined on their keys, and the figures of their model.

    ``forecast``: as from ``fact_forecast`` with facility_key, date_key, time_key and model_version_key; ``model``: a row
    for each model_version_key with mae, rmse and r2; ``made`` is when the forecast was made, ``now`` when it is loaded. Types are those of the table.
    """
    out = lookup(forecast, facilities, [(F.col("facility_key"), "facility_key")], ["facility_code", "facility_name"])
    out = lookup(out, dates.withColumnRenamed("day_of_month", "day"), [(F.col("date_key"), "date_key")], ["year", "month", "day"])
    out = lookup(out, times, [(F.col("time_key"), "time_key")], ["hour"])
    out = lookup(out, model, [(F.col("model_version_key"), "model_version_key")], ["mae", "rmse", "r2"])
    dec = lambda c, kind, name: F.col(c).try_cast(kind).alias(name)
    return out.select(
        "forecast_id", "facility_key", "date_key", "time_key", "model_version_key", "facility_code", "facility_name", "year", "month", "day", "hour",
        dec("actual", "decimal(12,6)", "actual_energy_mwh"), dec("predicted", "decimal(12,6)", "predicted_energy_mwh"), dec("residual", "decimal(12,6)", "forecast_error_mwh"),
        dec("residual", "decimal(12,6)", "residual_mwh"), dec("ape_pct", "decimal(10,4)", "absolute_percentage_error"), dec("ape_pct", "decimal(10,4)", "mape_pct"),
        dec("accuracy_pct", "decimal(10,4)", "prediction_accuracy_pct"), dec("mae", "decimal(12,6)", "mae_metric"), dec("rmse", "decimal(12,6)", "rmse_metric"), dec("r2", "decimal(10,6)", "r2_score"), "is_accurate_forecast",
        made.cast("timestamp").alias("forecast_timestamp"), now.cast("timestamp").alias("created_at"), now.cast("timestamp").alias("updated_at"),
    )
