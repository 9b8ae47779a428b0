"""Features, splits, metrics and tree regression."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helio.functions.scalars import exact_sum
from helio.operators.ranks import exact_quantiles, numbered, with_quantiles
from helio.sources.shared import cut

EPSILON = 1e-6


def temporal(df: DataFrame, ts: str = "date_hour") -> DataFrame:
    """Hour, weekday (1 is Sunday), month, weekend, and their sines and cosines."""
    out = df.withColumns({"hour_of_day": F.hour(ts).cast("double"), "day_of_week": F.dayofweek(ts).cast("double"), "month": F.month(ts).cast("double"), "is_weekend": F.dayofweek(ts).isin(1, 7).cast("double")})
    turn = lambda c, n: 2 * math.pi * F.col(c) / n
    return out.withColumns({"hour_sin": F.sin(turn("hour_of_day", 24)), "hour_cos": F.cos(turn("hour_of_day", 24)), "month_sin": F.sin(turn("month", 12)), "month_cos": F.cos(turn("month", 12))})


#: Rows of one facility that a task sorts at once, beside those handed on from the stretch before.
STRETCH = 100_000


def _handed_on(df: DataFrame, tail: Column) -> DataFrame:
    """Rows in their ``_stretch``, those of ``tail`` once more in the next one, as ``_halo``; the input is read once."""
    here, there = F.struct(F.col("_stretch").alias("at"), F.lit(False).alias("halo")), F.struct((F.col("_stretch") + 1).alias("at"), F.lit(True).alias("halo"))
    rows = df.withColumn("_of", F.explode(F.when(tail, F.array(here, there)).otherwise(F.array(here))))
    return rows.withColumns({"_stretch": F.col("_of.at"), "_halo": F.col("_of.halo")}).drop("_of")


def lag_rows(df: DataFrame, value: str = "energy_mwh", steps=(1, 24, 168), stretch: int = STRETCH) -> DataFrame:
    """Values some rows before; gaps shift them. Rows of one hour are ordered by value.

    No task has a facility's whole history: rows are numbered within their facility by counts of ranges, cut into stretches of ``stretch``
    rows, and the last rows of a stretch, as many as the longest step, go along with the next one.
    """
    most = max(steps)
    stretch = max(stretch, most)
    placed = numbered(df, ["facility_code"], ["date_hour", value], "_no").withColumn("_stretch", F.floor((F.col("_no") - 1) / stretch))  # numbers from 1
    rows = _handed_on(placed, (F.col("_no") - 1) % stretch >= stretch - most)
    w = Window.partitionBy("facility_code", "_stretch").orderBy("_no")
    lags = {f"{value}_lag_{n}": F.lag(value, n).over(w) for n in steps}
    return rows.withColumns(lags).where("NOT _halo").select(*df.columns, *lags)


def lag_hours(df: DataFrame, value: str = "energy_mwh", steps=(1, 24, 168), hours: int = 20_000) -> DataFrame:
    """Values exactly some hours before, null where that hour is missing; of several rows there the largest.

    A facility's history is cut into stretches of ``hours`` hours; the hours at the end of one that the longest step reaches
    go along with the next one. One exchange, by facility and stretch.
    """
    most = max(steps)
    hours = max(hours, most)
    at = F.unix_timestamp("date_hour")
    placed = df.withColumns({"_at": at, "_stretch": F.floor(at / (hours * 3600))})
    rows = _handed_on(placed, F.coalesce(F.col("_at") >= ((F.col("_stretch") + 1) * hours - most) * 3600, F.lit(False)))
    lags = {}
    for n in steps:
        w = Window.partitionBy("facility_code", "_stretch").orderBy("_at").rangeBetween(-n * 3600, -n * 3600)
        lags[f"{value}_lag_{n}h"] = F.max(value).over(w)
    return rows.withColumns(lags).where("NOT _halo").select(*df.columns, *lags)


def interactions(df: DataFrame) -> DataFrame:
    sun, t, cloud = F.col("shortwave_radiation"), F.col("temperature_2m"), F.col("cloud_cover")
    ratio = lambda a, b: F.when(b > EPSILON, a / b).otherwise(0.0)
    out = {"radiation_temp_interaction": sun * t, "cloud_radiation_ratio": ratio(cloud, sun), "hour_radiation_interaction": F.col("hour_of_day") * sun, "shortwave_radiation_sq": sun * sun, "temperature_sq": t * t, "cloud_temp_interaction": cloud * t}
    if "completeness_pct" in df.columns:
        out["completeness_radiation_interaction"] = F.col("completeness_pct") * sun
    if "wind_speed_10m" in df.columns:
        out["wind_temp_interaction"] = F.col("wind_speed_10m") * t
    if {"direct_radiation", "diffuse_radiation"} <= set(df.columns):
        out["direct_diffuse_ratio"] = ratio(F.col("direct_radiation"), F.col("diffuse_radiation"))
    return df.withColumns(out)


def indicators(df: DataFrame, least_radiation: float = 10.0, low_energy: float | None = None) -> DataFrame:
    """Production hours; the low-energy indicator uses the target, so it is off unless a threshold is given."""
    df = df.withColumn("is_production_hour", F.when(F.col("shortwave_radiation") >= least_radiation, 1.0).otherwise(0.0))
    return df if low_energy is None else df.withColumn("is_low_energy_period", F.when(F.col("energy_mwh") <= low_energy, 1.0).otherwise(0.0))


#: Features of the production model by group, and the least rows to train on.
FEATURES = {
    "Energy Features": ["intervals_count", "completeness_pct"],
    "Temporal Features": ["hour_of_day", "day_of_week", "month", "is_weekend", "hour_sin", "hour_cos", "month_sin", "month_cos"],
    "Weather Features": ["temperature_2m", "cloud_cover", "shortwave_radiation", "direct_radiation", "diffuse_radiation", "wind_speed_10m"],
    "Derived Weather": ["radiation_temp_interaction", "cloud_radiation_ratio", "hour_radiation_interaction", "completeness_radiation_interaction", "wind_temp_interaction", "direct_diffuse_ratio", "shortwave_radiation_sq", "temperature_sq", "cloud_temp_interaction"],
    "LAG Features": ["energy_lag_1h", "energy_lag_24h", "energy_lag_168h"],
    "Production Features": ["is_production_hour", "is_low_energy_period"],
    "Air Quality": ["pm2_5", "pm10", "ozone", "nitrogen_dioxide"],
}
LEAST_ROWS = 100


def prepare(df: DataFrame, low_energy: float | None = None, lags: bool = True) -> DataFrame:
    """All features of joined hourly rows: calendar, cycles, lags by rows, interactions, indicators. ``low_energy`` adds the indicator that uses the target."""
    out = temporal(df)
    if lags:
        out = lag_rows(out).withColumnsRenamed({f"energy_mwh_lag_{n}": f"energy_lag_{n}h" for n in (1, 24, 168)})
    return indicators(interactions(out), low_energy=low_energy)


def select_features(df: DataFrame, air: bool = False, target: str = "energy_mwh") -> DataFrame:
    """Keys, target and those features that the table has."""
    names = [f for group, fs in FEATURES.items() if air or group != "Air Quality" for f in fs]
    return df.select("facility_code", "date_hour", target, *[c for c in names if c in df.columns])


def validated(df: DataFrame, least_rows: int = LEAST_ROWS) -> DataFrame:
    """Lags that are null become 0, rows with other nulls go (keys may be null); too few rows raise. The check stops counting at ``least_rows``."""
    lags = [c for c in df.columns if "lag" in c]
    out = df.fillna(0.0, lags) if lags else df
    out = out.dropna(subset=[c for c in out.columns if c not in ("facility_code", "date_hour", *lags)])
    n = out.limit(least_rows).count()
    if n < least_rows:
        raise ValueError(f"insufficient data: {n} rows (at least {least_rows})")
    return out


def latest(df: DataFrame, n: int, ts: str = "date_hour", tie: str = "facility_code") -> DataFrame:
    """The ``n`` latest rows, ties by facility: each task keeps ``n`` at the most."""
    return df.orderBy(F.desc_nulls_last(ts), tie).limit(n)


def temporal_split(df: DataFrame, ts: str = "date_hour", tie: str = "facility_code", train: float = 0.70, validate: float = 0.15) -> DataFrame:
    """Label rows train, validation or test by their place in time order.

    Counts per hour and their running sums (one row an hour) place whole hours; rows are ranked within their hour only.
    """
    hours = df.groupBy(ts).agg(F.count(F.lit(1)).alias("_n"))
    months = hours.groupBy(F.date_trunc("month", ts).alias("_m")).agg(F.sum("_n").alias("_mn"))
    months = months.withColumn("_mbase", F.coalesce(F.sum("_mn").over(Window.orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("_total", F.sum("_mn").over(Window.partitionBy(F.lit(1))))
    hours = hours.withColumn("_m", F.date_trunc("month", ts)).join(months, "_m")
    inside = Window.partitionBy("_m").orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select(ts, (F.col("_mbase") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_base"), "_total")
    rank = F.col("_base") + F.row_number().over(Window.partitionBy(ts).orderBy(tie))
    placed = df.join(hours, ts).withColumn("_rank", rank)
    a, b = F.floor(F.col("_total") * train), F.floor(F.col("_total") * (train + validate))
    return placed.withColumn("split", F.when(F.col("_rank") <= a, "train").when(F.col("_rank") <= b, "validation").otherwise("test")).drop("_rank", "_base", "_total")


def metrics(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """rmse, mae, mse, r2 and MAPE over non-zero labels (infinite if there are none)."""
    y, p = F.col(label), F.col(predicted)
    d, n = exact_sum, F.count(F.lit(1))
    sums = df.agg(n.alias("n"), d((y - p) * (y - p)).alias("se"), d(F.abs(y - p)).alias("ae"), d(y).alias("sy"), d(y * y).alias("syy"), F.try_divide(d(F.when(y != 0, F.abs(F.try_divide(y - p, y)))), F.count_if(y != 0)).alias("mape"))
    mse = F.try_divide(F.col("se"), F.col("n"))
    return sums.select("n", F.round(F.sqrt(mse), 4).alias("rmse"), F.round(F.try_divide(F.col("ae"), F.col("n")), 4).alias("mae"), F.round(mse, 4).alias("mse"),
                       F.round(1 - F.try_divide(F.col("se"), F.col("syy") - F.try_divide(F.col("sy") * F.col("sy"), F.col("n"))), 4).alias("r2"),
                       F.round(F.coalesce(F.col("mape") * 100, F.lit(float("inf"))), 4).alias("mape_pct"))


#: Production settings of the tree models.
TREE_PARAMS = {
    "gbt": {"maxDepth": 8, "maxIter": 150, "stepSize": 0.08, "minInstancesPerNode": 20, "maxBins": 256, "subsamplingRate": 0.85, "featureSubsetStrategy": "auto", "minInfoGain": 0.005},
    "decision_tree": {"maxDepth": 20, "minInstancesPerNode": 20, "maxBins": 64, "minInfoGain": 0.0},
}


def train_trees(df: DataFrame, features: list[str], label: str, kind: str = "gbt", **params):
    """Fit an assembler and a tree regressor with TREE_PARAMS, or ``params`` in their place; rows with null features are left out."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor

    makers = {"gbt": GBTRegressor, "decision_tree": DecisionTreeRegressor}
    if kind not in makers:
        raise ValueError(f"unknown model kind {kind}")
    tree = makers[kind](featuresCol="features", labelCol=label, predictionCol="prediction", seed=42, **TREE_PARAMS[kind] | params)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip"), tree]).fit(df.dropna(subset=[label]))


def importances(spark, model, features: list[str]) -> DataFrame:
    """(feature_name, importance) of a fitted pipeline; as many rows as features."""
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, model.stages[-1].featureImportances.toArray(), strict=True)], "feature_name string, importance double")


def category_of(name: Column) -> Column:
    """The group of a feature."""
    out = None
    for group, names in FEATURES.items():
        out = F.when(name.isin(names), group) if out is None else out.when(name.isin(names), group)
    return out.otherwise(F.when(name.contains("lag"), "LAG Features").otherwise("Other"))


def rank_importances(df: DataFrame, top: int = 15, version: int = 1) -> DataFrame:
    """The importance dimension from (feature_name, feature_category, importance): percentages, running share, ranks overall and in the category, flags.

    Ties go by name. The window over all features is small: a model has a bounded number of them.
    """
    order = [F.desc("importance"), F.asc("feature_name")]
    rank, inside = F.row_number().over(Window.orderBy(*order)), F.row_number().over(Window.partitionBy("feature_category").orderBy(*order))
    running = F.sum(F.col("importance").cast("decimal(20,10)")).over(Window.orderBy(*order)).cast("double")
    return df.select(
        rank.alias("feature_importance_key"), "feature_name", "feature_category", F.col("importance").alias("importance_value"), F.round(F.col("importance") * 100, 6).alias("importance_percentage"),
        F.round(running * 100, 6).alias("cumulative_importance"), rank.alias("rank_overall"), inside.alias("rank_in_category"), (rank <= top).alias("is_top_15"), F.col("feature_name").contains("lag").alias("is_lag_feature"), F.lit(version).alias("model_version_key"))


#: Columns of the stored importance dimension, beside created_at.
IMPORTANCE = "feature_importance_key int, feature_name string, feature_category string, importance_value double, importance_percentage double, cumulative_importance double, rank_overall int, rank_in_category int, is_top_15 boolean, is_lag_feature boolean, model_version_key int"


def store_importances(ranked: DataFrame, path: str, now: Column) -> None:
    """Add ranked importances, with created_at, to the table of all model versions; a version's rows replace its earlier ones."""
    ranked.select(*[F.col(c).cast(kind).alias(c) for c, kind in (x.split() for x in IMPORTANCE.split(", "))], now.alias("created_at")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_version_key").parquet(path)


def top_features(ranked: DataFrame, n: int = 15) -> DataFrame:
    return ranked.orderBy("rank_overall").limit(n)


def importance_rank(spark, model, features: list[str], top: int = 15) -> DataFrame:
    """Features of a fitted pipeline by importance, as ``rank_importances`` has them."""
    return rank_importances(importances(spark, model, features).withColumn("feature_category", category_of(F.col("feature_name"))), top)


def train_evaluate(rows: DataFrame, features: list[str], label: str, kind: str = "gbt", **params) -> tuple:
    """Split by time, fit on the training part, and give the pipeline, the metrics of validation and test part (split, n, rmse and so on) and the ranked importances.

    ``rows`` are cut first: they are read once for each tree otherwise.
    """
    split = cut(temporal_split(rows))
    model = train_trees(split.where("split = 'train'"), features, label, kind, **params)
    figures = None
    for part in ("validation", "test"):
        one = metrics(model.transform(split.where(F.col("split") == part)), label, "prediction").withColumn("split", F.lit(part))
        figures = one if figures is None else figures.unionByName(one)
    return model, figures, importance_rank(rows.sparkSession, model, features)


def residual_stats(df: DataFrame, label: str, predicted: str, exact: bool = False) -> DataFrame:
    """Mean, median, deviation, least, most and number of residuals; the median is a sketch (1 %) unless ``exact``."""
    r = (F.col(label) - F.col(predicted)).alias("r")
    mean = F.try_divide(exact_sum(F.col("r")), F.count("r"))
    rows = df.select(r)
    middle = [] if exact else [F.percentile_approx("r", F.lit(0.5), 100).alias("_middle")]
    out = rows.agg(F.count("r").alias("n"), F.round(mean, 4).alias("mean_residual"), *middle, F.round(F.stddev_samp("r"), 2).alias("residual_std"), F.min("r").alias("min_residual"), F.max("r").alias("max_residual"))
    out = with_quantiles(out, exact_quantiles(rows, "r", {"_middle": 0.5}), []) if exact else out
    return out.select("n", "mean_residual", F.round("_middle", 4).alias("median_residual"), "residual_std", "min_residual", "max_residual")


def random_split(df: DataFrame, keys: list[str], train: float = 0.8, seed: int = 42) -> DataFrame:
    """Label rows train or test by the digest of seed and keys: the same at every partitioning and after a lost executor."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *keys))
    return df.withColumn("split", F.when(digest < F.lit(f"{int(train * 2**32):08x}"), "train").otherwise("test"))
