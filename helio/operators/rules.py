"""Table-driven quality rules: each rule has a name, a condition and a severity; unknown conditions pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bounds of measures.
WEATHER_BOUNDS = {
    "shortwave_radiation": (0.0, 1150.0), "direct_radiation": (0.0, 1050.0), "diffuse_radiation": (0.0, 520.0), "direct_normal_irradiance": (0.0, 1060.0),
    "temperature_2m": (-10.0, 50.0), "dew_point_2m": (-20.0, 30.0), "wet_bulb_temperature_2m": (-5.0, 40.0),
    "cloud_cover": (0.0, 100.0), "cloud_cover_low": (0.0, 100.0), "cloud_cover_mid": (0.0, 100.0), "cloud_cover_high": (0.0, 100.0),
    "precipitation": (0.0, 1000.0), "sunshine_duration": (0.0, 3600.0), "total_column_integrated_water_vapour": (0.0, 100.0),
    "wind_speed_10m": (0.0, 50.0), "wind_direction_10m": (0.0, 360.0), "wind_gusts_10m": (0.0, 120.0), "pressure_msl": (985.0, 1050.0),
}
AIR_BOUNDS = {
    "pm2_5": (0.0, 500.0), "pm10": (0.0, 500.0), "dust": (0.0, 500.0), "nitrogen_dioxide": (0.0, 500.0), "ozone": (0.0, 500.0),
    "sulphur_dioxide": (0.0, 500.0), "carbon_monoxide": (0.0, 500.0), "uv_index": (0.0, 15.0), "uv_index_clear_sky": (0.0, 15.0),
}
#: Fixed value: energy of a full peak hour; hours and shares in the rules below are fixed values too.
PEAK_MWH = 186.0


def bound_rules(bounds: dict, severity: str) -> list[tuple[str, Column, str]]:
    return [(f"{c}_OUT_OF_BOUNDS", ~F.col(c).between(lo, hi), severity) for c, (lo, hi) in bounds.items()]


def apply_rules(df: DataFrame, rules: list[tuple[str, Column, str]]) -> DataFrame:
    """Add is_valid (no rule hit), quality_flag (the worst severity: BAD, WARNING, GOOD) and quality_issues (names joined by a bar)."""
    hit = {name: F.coalesce(cond, F.lit(False)) for name, cond, _ in rules}
    any_of = lambda level: reduce(lambda a, b: a | b, [hit[n] for n, _, s in rules if s == level], F.lit(False))
    return df.withColumns({
        "quality_issues": F.concat_ws("|", *[F.when(c, n) for n, c in hit.items()]),
        "quality_flag": F.when(any_of("BAD"), "BAD").when(any_of("WARNING"), "WARNING").otherwise("GOOD"),
        "is_valid": ~(any_of("BAD") | any_of("WARNING")),
    })


def energy_rules(hour: Column, energy: Column) -> list[tuple[str, Column, str]]:
    share = F.when(hour.between(6, 7), 0.05).when(hour.between(8, 9), 0.08).when(hour.between(17, 18), 0.10)
    return [
        ("OUT_OF_BOUNDS", energy < 0, "BAD"),
        ("NIGHT_ENERGY_ANOMALY", ((hour >= 22) | (hour < 6)) & (energy > 1.0), "WARNING"),
        ("DAYTIME_ZERO_ENERGY", hour.between(8, 17) & (energy == 0), "WARNING"),
        ("EQUIPMENT_DOWNTIME", hour.between(10, 14) & (energy == 0), "WARNING"),
        ("TRANSITION_HOUR_LOW_ENERGY", (energy > 0.01) & (energy < PEAK_MWH * share), "WARNING"),
        ("PEAK_HOUR_LOW_ENERGY", hour.between(10, 14) & (energy > 0.5) & (energy < PEAK_MWH / 2), "WARNING"),
    ]


def weather_rules(hour: Column) -> list[tuple[str, Column, str]]:
    sun, t = F.col("shortwave_radiation"), F.col("temperature_2m")
    return [
        *bound_rules(WEATHER_BOUNDS, "BAD"),
        ("NIGHT_RADIATION_SPIKE", ((hour < 6) | (hour >= 22)) & (sun > 100), "BAD"),
        ("RADIATION_INCONSISTENCY", F.col("direct_radiation") + F.col("diffuse_radiation") > sun * 1.05, "WARNING"),
        ("CLOUD_MEASUREMENT_INCONSISTENCY", hour.between(10, 14) & (F.col("cloud_cover") > 98) & (sun < 600), "WARNING"),
        ("EXTREME_TEMPERATURE", (t < -10) | (t > 45), "WARNING"),
    ]


def air_rules() -> list[tuple[str, Column, str]]:
    return [*bound_rules(AIR_BOUNDS, "WARNING"), ("AQI_OUT_OF_RANGE", ~F.col("aqi_value").between(0, 500), "WARNING")]
