"""Registered queries of profiles, figures, features and forecasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.functions.scalars import date_key
from helio.operators import audit, dims, facts, features, kpi, upsert
from helio.operators.rules import AIR_BOUNDS, WEATHER_BOUNDS
from helio.plans.queries import _INTERACTIONS, _PI, _SD, CTES, INTERACTIONS, _air, _energy, _fac, _fact, _h, _weather, query
from helio.plans.sample import view
from helio.sources.shared import shared_folder

_STUDY_W = ("temperature_2m", "shortwave_radiation", "wind_speed_10m")
_STUDY_A = ("pm2_5", "uv_index")


def _describe_sql(column: str, table: str, percents: tuple[int, ...]) -> str:
    p = ", ".join(f"round(quantile_cont({column}, {q / 100}), 4) AS p{q}" for q in percents)
    return f"SELECT '{column}' AS column_name, count({column}) AS n, min({column}) AS min_value, {_SD.format(c=column)} AS avg_value, round(stddev_samp({column}), 2) AS std_value, max({column}) AS max_value, {p} FROM {table}"


def _study_sql() -> str:
    limits = {"temperature_2m": (-10.0, 50.0), "shortwave_radiation": (0.0, 1150.0), "wind_speed_10m": (0.0, 50.0), "pm2_5": (0.0, 500.0), "uv_index": (0.0, 15.0)}
    parts = [f"SELECT *, {lo}E0 AS bound_low, {hi}E0 AS bound_high FROM ({_describe_sql(c, 'weather' if c in _STUDY_W else 'air', (1, 5, 50, 95, 99))})" for c, (lo, hi) in limits.items()]
    return "SELECT *, round(min_value - bound_low, 4) AS room_low, round(bound_high - max_value, 4) AS room_high FROM (" + " UNION ALL ".join(parts) + ")"


@query(_study_sql())
def bounds_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.bounds_study([(_weather(spark, sf_dir), {c: WEATHER_BOUNDS[c] for c in _STUDY_W}), (_air(spark, sf_dir), {c: AIR_BOUNDS[c] for c in _STUDY_A})], exact=True)


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
CTES["lines"] = "SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _MEASURES) + " FROM lineitem"


@query(" UNION ALL ".join(_describe_sql(c, "lines", (25, 50, 75, 95, 99)) for c in _MEASURES))
def describe_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.describe(view(spark, sf_dir, "lineitem"), list(_MEASURES), exact=True)


@query("SELECT count(DISTINCT facility_code) AS keys, min(CAST(date_hour AS DATE)) AS first_day, max(CAST(date_hour AS DATE)) AS last_day FROM fact")
def facility_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.span(_fact(spark, sf_dir), "facility_code", "date_hour")


@query("SELECT date_key, round(CAST(sum(CAST(energy_mwh AS DECIMAL(18,6))) AS DOUBLE), 4) AS total_mwh, round(CAST(sum(CAST(irr_kwh_m2_hour AS DECIMAL(18,6))) AS DOUBLE), 4) AS total_irradiation, count(*) AS row_count FROM fact GROUP BY 1")
def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.daily_totals(_fact(spark, sf_dir))


@query("""SELECT e.facility_code, CAST(e.date_hour AS DATE) AS local_date, extract(hour FROM e.date_hour) AS hour, e.energy_mwh, CAST(coalesce(CASE WHEN f.facility_code <> 'F2' THEN f.total_capacity_mw END, 102) AS DOUBLE) AS total_capacity_mw,
 w.shortwave_radiation / 1000E0 AS irr_kwh_m2_hour, w.temperature_2m, w.wind_speed_10m, w.cloud_cover, CAST(strftime(e.date_hour, '%Y%m%d') AS INTEGER) AS date_key
 FROM energy e LEFT JOIN fac f ON e.facility_code = f.facility_code JOIN weather w ON e.facility_code = w.facility_code AND e.date_hour = w.date_hour""")
def local_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy with weather by local date and hour; one facility's capacity is unknown."""
    fac = _fac(spark, sf_dir).withColumn("total_capacity_mw", F.when(F.col("facility_code") != "F2", F.col("total_capacity_mw")))
    return kpi.local_hours(_energy(spark, sf_dir), fac, _weather(spark, sf_dir)).withColumn("hour", F.col("hour").cast("long"))


_LAGS = {n: f"coalesce(lag(energy_mwh, {n}) OVER (PARTITION BY facility_code ORDER BY date_hour), 0)" for n in (1, 24, 168)}
CTES["joined"] = """SELECT e.facility_code, e.date_hour, max(e.energy_mwh) AS energy_mwh, max(e.intervals_count) AS intervals_count, max(e.completeness_pct) AS completeness_pct, any_value(w.temperature_2m) AS temperature_2m, any_value(w.cloud_cover) AS cloud_cover,
 any_value(w.shortwave_radiation) AS shortwave_radiation, any_value(w.direct_radiation) AS direct_radiation, any_value(w.diffuse_radiation) AS diffuse_radiation, any_value(w.wind_speed_10m) AS wind_speed_10m FROM energy e LEFT JOIN weather w ON e.facility_code = w.facility_code AND e.date_hour = w.date_hour GROUP BY 1, 2"""
CTES["selected"] = f"""SELECT facility_code, date_hour, energy_mwh, intervals_count, completeness_pct, CAST({_h} AS DOUBLE) AS hour_of_day, CAST(dayofweek(date_hour) + 1 AS DOUBLE) AS day_of_week, CAST(month(date_hour) AS DOUBLE) AS month, CAST(dayofweek(date_hour) IN (0, 6) AS DOUBLE) AS is_weekend,
 round(sin({_PI.format(p='hour', n=24)}), 6) + 0 AS hour_sin, round(cos({_PI.format(p='hour', n=24)}), 6) + 0 AS hour_cos, round(sin({_PI.format(p='month', n=12)}), 6) + 0 AS month_sin, round(cos({_PI.format(p='month', n=12)}), 6) + 0 AS month_cos,
 temperature_2m, cloud_cover, shortwave_radiation, direct_radiation, diffuse_radiation, wind_speed_10m, {_INTERACTIONS}, {_LAGS[1]} AS energy_lag_1h, {_LAGS[24]} AS energy_lag_24h, {_LAGS[168]} AS energy_lag_168h FROM joined"""


def _joined(spark: SparkSession, d: str) -> DataFrame:
    keys = ["facility_code", "date_hour"]
    energy = _energy(spark, d).groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("energy_mwh", "intervals_count", "completeness_pct")])
    return energy.join(_weather(spark, d).select(*keys, "temperature_2m", "cloud_cover", "shortwave_radiation", "direct_radiation", "diffuse_radiation", "wind_speed_10m"), keys, "left")


@query("SELECT * FROM selected WHERE shortwave_radiation IS NOT NULL AND temperature_2m IS NOT NULL AND cloud_cover IS NOT NULL AND direct_radiation IS NOT NULL AND diffuse_radiation IS NOT NULL AND wind_speed_10m IS NOT NULL AND energy_mwh IS NOT NULL")
def features_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features of energy joined with weather, the production ones selected, rows with nulls left out."""
    out = features.validated(features.select_features(features.prepare(_joined(spark, sf_dir))))
    small = {**INTERACTIONS, **dict.fromkeys(("hour_sin", "hour_cos", "month_sin", "month_cos"), 6)}
    return out.withColumns({c: F.round(c, n) + 0.0 for c, n in small.items()})


@query("""SELECT e.energy_mwh AS target, w.shortwave_radiation, w.temperature_2m, w.dew_point_2m AS humidity_2m, w.cloud_cover, w.sunshine_duration AS sunshine_hours, coalesce(a.pm2_5, 0) AS pm2_5, coalesce(a.ozone, 0) AS ozone, extract(hour FROM e.date_hour) AS hour_of_day, dayofweek(e.date_hour) + 1 AS day_of_week, dayofyear(e.date_hour) AS day_of_year
 FROM energy e JOIN weather w ON e.facility_code = w.facility_code AND e.date_hour = w.date_hour LEFT JOIN air a ON e.facility_code = a.facility_code AND e.date_hour = a.date_hour WHERE e.energy_mwh >= 0 AND w.shortwave_radiation IS NOT NULL""")
def training_set_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy at 0 or more joined with weather (inner) and air quality (left, nulls as 0), with calendar features."""
    keys = ["facility_code", "date_hour"]
    rows = _energy(spark, sf_dir).where("energy_mwh >= 0").select(*keys, F.col("energy_mwh").alias("target"))
    rows = rows.join(_weather(spark, sf_dir).where("shortwave_radiation IS NOT NULL").select(*keys, "shortwave_radiation", "temperature_2m", F.col("dew_point_2m").alias("humidity_2m"), "cloud_cover", F.col("sunshine_duration").alias("sunshine_hours")), keys)
    rows = rows.join(_air(spark, sf_dir).select(*keys, "pm2_5", "ozone"), keys, "left").fillna(0.0, ["pm2_5", "ozone"])
    part = {"hour_of_day": F.hour, "day_of_week": F.dayofweek, "day_of_year": F.dayofyear}
    return rows.withColumns({n: f("date_hour").cast("long") for n, f in part.items()}).drop(*keys)


CTES["shares"] = "SELECT p_brand AS feature_name, substr(p_brand, 1, 7) AS feature_category, CAST(round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / CAST((SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) FROM lineitem) AS DOUBLE), 8) AS DOUBLE) AS importance FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2"


@query("""SELECT CAST(row_number() OVER o AS INTEGER) AS feature_importance_key, feature_name, feature_category, importance AS importance_value, round(importance * 100, 6) AS importance_percentage, round(CAST(sum(CAST(importance AS DECIMAL(20,10))) OVER o AS DOUBLE) * 100, 6) AS cumulative_importance,
 CAST(row_number() OVER o AS INTEGER) AS rank_overall, CAST(row_number() OVER (PARTITION BY feature_category ORDER BY importance DESC, feature_name) AS INTEGER) AS rank_in_category, row_number() OVER o <= 15 AS is_top_15, contains(feature_name, 'lag') AS is_lag_feature, 1 AS model_version_key FROM shares WINDOW o AS (ORDER BY importance DESC, feature_name)""")
def importance_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The importance dimension over shares of brands in revenue, in place of a model's importances; stored for two versions, of which one is read."""
    path = f"{shared_folder(spark)}/importance-{uuid.uuid4().hex}"
    shares = _shares(spark, sf_dir)
    for version in (1, 2, 1):
        features.store_importances(features.rank_importances(shares, version=version), path, F.lit("2024-06-01").cast("timestamp"))
    return spark.read.parquet(path).where("model_version_key = 1").drop("created_at")


@query("SELECT feature_name, importance AS importance_value FROM shares ORDER BY importance DESC, feature_name LIMIT 15")
def importance_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.top_features(features.rank_importances(_shares(spark, sf_dir))).select("feature_name", "importance_value")


def _shares(spark: SparkSession, d: str) -> DataFrame:
    lines = view(spark, d, "lineitem").select("l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    by = lines.join(view(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_brand").alias("feature_name")).agg(F.sum("price").cast("double").alias("s"))
    total = lines.agg(F.sum("price").cast("double").alias("t"))
    return by.crossJoin(F.broadcast(total)).select("feature_name", F.substring("feature_name", 1, 7).alias("feature_category"), F.round(F.col("s") / F.col("t"), 8).alias("importance"))


_pred = "w.shortwave_radiation / 4"
CTES["preds"] = f"SELECT e.facility_code, e.date_hour, e.energy_mwh AS actual, {_pred} AS predicted FROM energy e JOIN weather w ON e.facility_code = w.facility_code AND e.date_hour = w.date_hour"
CTES["figures"] = "SELECT CAST(sum(CAST(abs(actual - predicted) AS DECIMAL(28,8))) AS DOUBLE) / count(*) AS mae, CAST(sum(CAST((actual - predicted) * (actual - predicted) AS DECIMAL(28,8))) AS DOUBLE) / count(*) AS mse, 1 - CAST(sum(CAST((actual - predicted) * (actual - predicted) AS DECIMAL(28,8))) AS DOUBLE) / (CAST(sum(CAST(actual * actual AS DECIMAL(28,8))) AS DOUBLE) - CAST(sum(CAST(actual AS DECIMAL(28,8))) AS DOUBLE) * CAST(sum(CAST(actual AS DECIMAL(28,8))) AS DOUBLE) / count(*)) AS r2 FROM preds"
#: The version row of the forecast by a rule on radiation.
RULE_MODEL = {"model_version_key": 1, "model_version_id": "rule_v1", "model_name": "radiation_rule", "model_type": "regression", "model_algorithm": "Rule", "target_column": "energy_mwh", "is_active": True}
_ape = "abs(actual - predicted) / nullif(abs(actual), 0) * 100"


@query(f"""SELECT facility_key, CAST(strftime(p.date_hour, '%Y%m%d') AS INTEGER) AS date_key, CAST(extract(hour FROM p.date_hour) AS INTEGER) AS time_key, 1 AS model_version_key, f.facility_code, f.facility_name, year(p.date_hour) AS year, month(p.date_hour) AS month, day(p.date_hour) AS day, extract(hour FROM p.date_hour) AS hour,
 TRY_CAST(actual AS DECIMAL(12,6)) AS actual_energy_mwh, TRY_CAST(predicted AS DECIMAL(12,6)) AS predicted_energy_mwh, TRY_CAST(round(actual - predicted, 4) AS DECIMAL(12,6)) AS forecast_error_mwh, TRY_CAST(round(actual - predicted, 4) AS DECIMAL(12,6)) AS residual_mwh,
 TRY_CAST(round({_ape}, 2) AS DECIMAL(10,4)) AS absolute_percentage_error, TRY_CAST(round({_ape}, 2) AS DECIMAL(10,4)) AS mape_pct, TRY_CAST(round(100 - round({_ape}, 2), 2) AS DECIMAL(10,4)) AS prediction_accuracy_pct,
 CAST(round(mae, 4) AS DECIMAL(12,6)) AS mae_metric, CAST(round(sqrt(mse), 4) AS DECIMAL(12,6)) AS rmse_metric, CAST(round(r2, 4) AS DECIMAL(10,6)) AS r2_score, CAST('0x' || substr(md5(concat_ws('|', facility_key, strftime(p.date_hour, '%Y%m%d'), extract(hour FROM p.date_hour), 1)), 1, 15) AS BIGINT) AS forecast_id,
 TIMESTAMP '2024-05-31 18:00:00' AS forecast_timestamp, TIMESTAMP '2024-06-01 00:00:00' AS created_at, TIMESTAMP '2024-06-01 00:00:00' AS updated_at, 'rule_v1' AS model_version_id, 'Rule' AS model_algorithm, coalesce({_ape} <= 10, false) AS is_accurate_forecast FROM preds p JOIN fac f USING (facility_code) CROSS JOIN figures""")
def forecast_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy forecast by a rule on radiation, as the forecast fact with the attributes of its dimensions."""
    keys = ["facility_code", "date_hour"]
    rows = _energy(spark, sf_dir).select(*keys, F.col("energy_mwh").alias("y")).join(_weather(spark, sf_dir).select(*keys, (F.col("shortwave_radiation") / 4).alias("p")), keys)
    versions = dims.dim_model_version(spark, [RULE_MODEL])
    return dims.lookup(forecast_rows(spark, sf_dir, rows), versions, [(F.col("model_version_key"), "model_version_key")], ["model_version_id", "model_algorithm"])


def forecast_rows(spark: SparkSession, d: str, rows: DataFrame) -> DataFrame:
    """The forecast fact of rows with facility_code, date_hour, y and p."""
    fac = _fac(spark, d)
    keyed = dims.lookup(rows, fac, [(F.col("facility_code"), "facility_code")], ["facility_key"], "inner").withColumns({"date_key": date_key(F.to_date("date_hour")), "time_key": F.hour("date_hour"), "model_version_key": F.lit(1)})
    model = features.metrics(rows, "y", "p").withColumn("model_version_key", F.lit(1))
    forecast = facts.fact_forecast(keyed, "y", "p", ["facility_key", "date_key", "time_key", "model_version_key"])
    forecast = forecast.withColumns({"residual": F.round("residual", 4), "ape_pct": F.round("ape_pct", 2), "accuracy_pct": F.round(100 - F.round("ape_pct", 2), 2)})
    made, now = (F.lit(t).cast("timestamp") for t in ("2024-05-31 18:00:00", "2024-06-01"))
    return facts.fact_forecast_star(forecast, model, fac, dims.dim_date((rows, "date_hour")), dims.dim_time(spark), made, now)


_MODEL = ["shortwave_radiation", "temperature_2m", "cloud_cover", "hour_of_day", "hour_sin", "hour_cos", "energy_lag_1h", "energy_lag_24h", "energy_lag_168h"]


def _trained(spark: SparkSession, d: str):
    rows = features.validated(features.select_features(features.prepare(_joined(spark, d))))
    return rows, features.train_evaluate(rows, _MODEL, "energy_mwh", "decision_tree")


@query()
def train_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a tree on the validation and the test part, after training on the rows before them."""
    _, (_, figures, _) = _trained(spark, sf_dir)
    return figures


@query()
def forecast_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a trained tree for all rows, written as the forecast fact by date and read again."""
    rows, (model, _, _) = _trained(spark, sf_dir)
    path = f"{shared_folder(spark)}/forecast-{uuid.uuid4().hex}"
    predicted = model.transform(rows).select("facility_code", "date_hour", F.col("energy_mwh").alias("y"), F.col("prediction").alias("p"))
    upsert.overwrite_partitions(forecast_rows(spark, sf_dir, predicted), path, "date_key")
    return spark.read.parquet(path)
