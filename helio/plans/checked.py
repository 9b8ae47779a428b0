"""Registered queries of broken input, growing ranges, trees that SQL can check, and the life of a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.operators import features, intervals, models
from helio.plans.loads import _path
from helio.plans.queries import _TREE, CTES, _training, query, training_set
from helio.plans.sample import view
from helio.plans.studies import forecast_written, train_evaluate
from helio.sources import nested, quarantine

_EVENT = "event_id long, user_id long, event_type string, value double"
_NOW = "2024-06-01"


def _event_files(spark: SparkSession, d: str, path: str, kind: str) -> None:
    """Events as text lines; every thirteenth is cut short, every seventeenth has a word for its number, every nineteenth no user."""
    e, broken = view(spark, d, "events"), lambda n: F.col("event_id") % n == 0
    user, value = F.when(~broken(19), F.col("user_id").cast("string")), F.when(broken(17), "'many'").otherwise(F.col("value").cast("string"))
    if kind == "json":
        text = F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"user_id":'), F.coalesce(user, F.lit("null")), F.lit(',"event_type":"'), "event_type", F.lit('","value":'), F.translate(value, "'", '"'), F.lit("}"))
        e.select(F.when(broken(13), F.substring(text, 1, 20)).otherwise(text).alias("value")).write.text(path)
    else:
        line = F.concat_ws(",", "event_id", F.coalesce(user, F.lit("")), "event_type", value)
        header = spark.createDataFrame([("event_id,user_id,event_type,value",)], "value string")
        lines = e.select(F.when(broken(13), F.concat("event_id", F.lit(",x"))).otherwise(line).alias("value"))
        lines.write.text(f"{path}-lines")
        header.unionAll(spark.read.text(f"{path}-lines")).coalesce(1).write.text(path)  # one header stands above all lines


_BROKEN = "event_id % 13 = 0 OR event_id % 17 = 0"


def _checked(spark: SparkSession, d: str, kind: str) -> tuple[DataFrame, DataFrame]:
    path = _path(spark, f"broken-{kind}")
    _event_files(spark, d, path, kind)
    return quarantine.read_checked(spark, path, _EVENT, kind, {"no user": F.col("user_id").isNull(), "negative": F.col("value") < 0})


@query(f"SELECT event_id, user_id, event_type, value FROM events WHERE NOT ({_BROKEN} OR event_id % 19 = 0) AND value >= 0")
def json_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events from JSON lines of which some are broken: those that can be read and keep the rules."""
    return _checked(spark, sf_dir, "json")[0]


@query(f"SELECT event_id, user_id, event_type, value FROM events WHERE NOT ({_BROKEN} OR event_id % 19 = 0) AND value >= 0")
def csv_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from CSV."""
    return _checked(spark, sf_dir, "csv")[0]


@query(f"""SELECT source, reason, count(*) AS n, DATE '{_NOW}' AS quarantine_date FROM (SELECT CASE WHEN {_BROKEN} THEN 'unreadable' WHEN event_id % 19 = 0 THEN 'no user' WHEN value < 0 THEN 'negative' END AS reason, unnest(['events-csv', 'events-json']) AS source FROM events) WHERE reason IS NOT NULL GROUP BY ALL""")
def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was set aside of either, as stored in the quarantine table, by reason."""
    path = _path(spark, "quarantine")
    for kind in ("json", "csv"):
        quarantine.store_quarantine(_checked(spark, sf_dir, kind)[1], path, f"events-{kind}", F.lit(_NOW).cast("date"))
    return quarantine.quarantine_counts(spark.read.parquet(path)).withColumn("quarantine_date", F.col("quarantine_date").cast("date"))


_POINT = """CASE WHEN event_id % 23 = 0 THEN 'too short' WHEN event_id % 29 = 0 THEN 'no time' WHEN event_id % 31 = 0 THEN 'bad time' WHEN event_id % 37 = 0 THEN 'bad value' END"""


def _points(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e, broken = view(spark, d, "events"), lambda n: F.col("event_id") % n == 0
    time = F.when(broken(29), None).when(broken(31), "at noon").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    value = F.when(broken(37), "much").when(broken(41), None).otherwise(F.col("value").cast("string"))
    point = F.when(broken(23), F.array(time)).otherwise(F.array(time, value))
    packed = e.select(F.concat(F.lit("U"), "user_id").alias("unit_code"), point.alias("p")).groupBy("unit_code").agg(F.collect_list("p").alias("data"))
    result = F.array(F.struct(F.struct("unit_code", F.lit(None).cast("string").alias("facility_code")).alias("columns"), "data"))
    payloads = packed.select(F.array(F.struct(F.lit("NEM").alias("network_code"), F.lit("energy").alias("metric"), F.lit("1h").alias("interval"), F.lit("MWh").alias("unit"), result.alias("results"))).alias("data"))
    units = e.select(F.concat(F.lit("U"), "user_id").alias("unit_code"), F.concat(F.lit("F"), F.col("user_id") % 8).alias("facility_code")).distinct()
    return quarantine.points_checked(payloads, units)


@query(f"SELECT 'F' || (user_id % 8) AS facility_code, 'U' || user_id AS unit_code, date_trunc('second', ts) AS interval_start, CASE WHEN event_id % 41 <> 0 THEN value END AS value FROM events WHERE {_POINT} IS NULL")
def points_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of payloads among which some are broken."""
    return _points(spark, sf_dir)[0].select("facility_code", "unit_code", "interval_start", "value")


@query(f"SELECT unit_code, reason, count(*) AS n FROM (SELECT 'U' || user_id AS unit_code, {_POINT} AS reason FROM events) WHERE reason IS NOT NULL GROUP BY ALL")
def points_set_aside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken ones by unit and reason."""
    return _points(spark, sf_dir)[1].groupBy("unit_code", "reason").agg(F.count(F.lit(1)).alias("n"))


CTES["bands"] = "SELECT p_partkey, CAST(p_retailprice AS DOUBLE) AS band_low, CAST(p_retailprice AS DOUBLE) + CASE WHEN p_partkey % 50 = 0 THEN 300E0 ELSE CAST(p_size AS DOUBLE) / 16E0 END AS band_high FROM part"


@query("SELECT o_orderkey, band.p_partkey, band.lo AS band_low FROM orders LEFT JOIN (SELECT o_orderkey AS k, min({'lo': band_low, 'hi': band_high, 'p_partkey': p_partkey}) AS band FROM orders JOIN bands ON CAST(o_totalprice AS DOUBLE) / 200E0 BETWEEN band_low AND band_high GROUP BY 1) ON k = o_orderkey")
def price_band_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price band of each order among the bands of all parts, narrow and wide ones that overlap; some orders are in none."""
    low = F.col("p_retailprice").cast("double")
    bands = view(spark, sf_dir, "part").select("p_partkey", low.alias("band_low"), (low + F.when(F.col("p_partkey") % 50 == 0, 300.0).otherwise(F.col("p_size").cast("double") / 16.0)).alias("band_high"))
    orders = view(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice").cast("double") / 200.0).alias("unit_price"))
    return intervals.interval_lookup(orders, "unit_price", bands, "band_low", "band_high", ["p_partkey", "band_low"]).drop("unit_price")


_STUMP = ("l_quantity", "l_discount", "l_tax", "l_linenumber")
_means = "SELECT '{c}' AS feature, {i} AS place, CAST({c} AS DOUBLE) AS v, count(*) AS n, CAST(sum(CAST(l_extendedprice AS DECIMAL(28,4))) AS DOUBLE) AS s FROM lineitem GROUP BY 3"
CTES["steps"] = " UNION ALL ".join(_means.format(c=c, i=i) for i, c in enumerate(_STUMP))
CTES["splits"] = """SELECT feature, place, (v + lead(v) OVER w) / 2 AS threshold, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER a - sum(n) OVER w AS nr, sum(s) OVER a - sum(s) OVER w AS sr FROM steps
 WINDOW w AS (PARTITION BY feature ORDER BY v), a AS (PARTITION BY feature)"""


@query("SELECT feature, round(threshold, 6) AS threshold, round(sl / nl, 2) AS mean_under, round(sr / nr, 2) AS mean_over FROM splits WHERE threshold IS NOT NULL ORDER BY sl * sl / nl + sr * sr / nr DESC, place LIMIT 1")
def stump_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single split of lines by quantity, discount, tax or line number that explains most of the price's variance; the twin tries all of them."""
    lines = view(spark, sf_dir, "lineitem").select(*[F.col(c).cast("double").alias(c) for c in (*_STUMP, "l_extendedprice")])
    feature, threshold, under, over = models.stump(lines, list(_STUMP), "l_extendedprice")
    return spark.createDataFrame([(feature, round(threshold, 6), round(under, 2), round(over, 2))], "feature string, threshold double, mean_under double, mean_over double")


@query("SELECT count(*) AS n, true AS many_leaves, 0 AS leaves_off FROM lineitem")
def tree_leaf_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deep tree with the production settings: what each leaf predicts is the mean label of its rows."""
    lines = view(spark, sf_dir, "lineitem").select(*[F.col(c).cast("double").alias(c) for c in (*_STUMP, "l_extendedprice")])
    model = features.train_trees(lines, list(_STUMP), "l_extendedprice", "decision_tree", maxDepth=8)
    off = F.count_if(F.abs(F.col("prediction") - F.col("mean_label")) > 1e-6 * F.abs(F.col("mean_label")))
    return models.leaf_means(model, lines, "l_extendedprice").agg(F.sum("n").alias("n"), (F.count(F.lit(1)) > 10).alias("many_leaves"), off.cast("int").alias("leaves_off"))


def lifecycle(spark: SparkSession, d: str, base: str) -> DataFrame:
    """Two versions of a tree trained and stored, the active one loaded again; its predictions with the row of its version."""
    rows = _training(spark, d)
    for version, depth in ((1, 3), (2, 5), (2, 6)):  # the second one is trained anew
        model = features.train_trees(rows, _TREE, "energy_mwh", "decision_tree", maxDepth=depth)
        record = {"model_version_id": f"tree_v{version}", "model_name": "energy_tree", "model_type": "regression", "model_algorithm": "DecisionTreeRegressor", "hyperparameters": {"maxDepth": depth}, "feature_columns": ",".join(_TREE), "target_column": "energy_mwh", "is_active": True}
        models.register_model(spark, base, model, record, features.importance_rank(spark, model, _TREE), F.lit("2024-06-0" + str(version)).cast("timestamp"))
    model, row = models.active_model(spark, base, "energy_tree")
    versions = nested.read_table(spark, f"{base}/dim_model_version", ["model_version_key"])
    out = model.transform(rows).withColumn("model_version_key", F.lit(row["model_version_key"]))
    return out.join(versions.select("model_version_key", "model_version_id", "hyperparameters", "is_active"), "model_version_key")


@query("""SELECT e.facility_code, e.date_hour, e.energy_mwh, 2 AS model_version_key, 'tree_v2' AS model_version_id, '{"maxDepth": 6}' AS hyperparameters, true AS is_active, true AS predicted FROM hourly e JOIN weather w ON e.facility_code = w.facility_code AND e.date_hour = w.date_hour WHERE shortwave_radiation IS NOT NULL AND temperature_2m IS NOT NULL AND cloud_cover IS NOT NULL""")
def model_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle(spark, sf_dir, _path(spark, "models")).select("facility_code", "date_hour", "energy_mwh", "model_version_key", "model_version_id", "hyperparameters", "is_active", F.col("prediction").isNotNull().alias("predicted"))


@query(" UNION ALL ".join(f"SELECT {v} AS model_version_key, 'tree_v{v}' AS model_version_id, {str(v == 2).lower()} AS is_active, TIMESTAMP '2024-06-0{v} 00:00:00' AS created_at, TIMESTAMP '2024-06-0{v} 00:00:00' AS updated_at, {len(_TREE)} AS n_features, true AS whole FROM (SELECT 1)" for v in (1, 2)))
def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The version dimension as stored, with the importances stored for each version: as many as features, one in all."""
    base = _path(spark, "models")
    lifecycle(spark, sf_dir, base)
    kept = spark.read.parquet(f"{base}/dim_feature_importance").groupBy("model_version_key").agg(F.count(F.lit(1)).cast("int").alias("n_features"), (F.abs(F.sum("importance_value") - 1) < 1e-6).alias("whole"))
    return spark.read.parquet(f"{base}/dim_model_version").join(kept, "model_version_key").select("model_version_key", "model_version_id", "is_active", "created_at", "updated_at", "n_features", "whole")


@query("SELECT * FROM (SELECT e.facility_code, e.date_hour, e.energy_mwh, w.shortwave_radiation, w.temperature_2m, coalesce(a.pm2_5, 0) AS pm2_5 FROM energy e JOIN weather w ON e.facility_code = w.facility_code AND e.date_hour = w.date_hour LEFT JOIN air a ON e.facility_code = a.facility_code AND e.date_hour = a.date_hour WHERE e.energy_mwh IS NOT NULL) ORDER BY date_hour DESC, facility_code LIMIT 500")
def training_set_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set's 500 latest rows, as a model is trained anew on what is recent."""
    return features.latest(training_set(spark, sf_dir), 500)


CTES["complete"] = "SELECT * FROM selected WHERE shortwave_radiation IS NOT NULL AND temperature_2m IS NOT NULL AND cloud_cover IS NOT NULL AND direct_radiation IS NOT NULL AND diffuse_radiation IS NOT NULL AND wind_speed_10m IS NOT NULL AND energy_mwh IS NOT NULL"


@query("SELECT unnest(['validation', 'test']) AS split, unnest([CAST(floor(t * 0.85E0) - floor(t * 0.7E0) AS BIGINT), CAST(t - floor(t * 0.85E0) AS BIGINT)]) AS n, true AS figures_known FROM (SELECT count(*) AS t FROM complete)")
def train_evaluate_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts on which a trained tree is measured: their rows, and that errors and the share explained hang together."""
    known = (F.col("rmse") >= F.col("mae")) & (F.abs(F.col("mse") - F.col("rmse") * F.col("rmse")) <= 1e-3 * F.col("mse") + 1e-3) & (F.col("r2") <= 1) & (F.col("mape_pct") >= 0)
    return train_evaluate(spark, sf_dir).select("split", "n", known.alias("figures_known"))


@query("SELECT CAST('0x' || substr(md5(concat_ws('|', facility_key, strftime(date_hour, '%Y%m%d'), extract(hour FROM date_hour), 1)), 1, 15) AS BIGINT) AS forecast_id, facility_key, CAST(strftime(date_hour, '%Y%m%d') AS INTEGER) AS date_key, CAST(extract(hour FROM date_hour) AS INTEGER) AS time_key, 1 AS model_version_key, TRY_CAST(energy_mwh AS DECIMAL(12,6)) AS actual_energy_mwh, true AS errors_fit FROM complete JOIN fac USING (facility_code)")
def forecast_written_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of a trained tree as written: ids, keys and actual values, and that the error columns follow from the predicted value."""
    off = F.abs(F.col("actual_energy_mwh") - F.col("predicted_energy_mwh") - F.col("residual_mwh"))
    return forecast_written(spark, sf_dir).select("forecast_id", "facility_key", F.col("date_key").cast("int").alias("date_key"), "time_key", "model_version_key", "actual_energy_mwh", F.coalesce((off <= 0.0001) & (F.col("residual_mwh") == F.col("forecast_error_mwh")), F.lit(False)).alias("errors_fit"))
