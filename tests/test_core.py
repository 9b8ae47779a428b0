import datetime as dt

import pytest
from pyspark.sql import functions as F

from helio.functions.scalars import aqi_from_pm25, clean_number, humidity, season, time_of_day
from helio.operators import audit, dims, features, kpi, silver, upsert
from helio.operators.rules import apply_rules, energy_rules


@pytest.mark.parametrize(("pm", "aqi"), [(None, None), (0.0, 0), (12.0, 50), (12.05, 51), (35.4, 100), (55.4, 150), (150.4, 200), (250.4, 300), (500.0, 500), (600.0, 500)])
def test_aqi_bands(spark, pm, aqi):
    assert spark.createDataFrame([(pm,)], "x double").select(aqi_from_pm25(F.col("x"))).first()[0] == aqi


def test_scalars(spark):
    df = spark.createDataFrame([(h,) for h in (0, 6, 12, 17, 21, 23)], "h int")
    assert [r[0] for r in df.select(time_of_day(F.col("h"))).collect()] == ["Night", "Morning", "Afternoon", "Evening", "Night", "Night"]
    df = spark.createDataFrame([(m,) for m in range(1, 13)], "m int")
    assert [r[0] for r in df.select(season(F.col("m"))).collect()] == ["Summer"] * 2 + ["Autumn"] * 3 + ["Winter"] * 3 + ["Spring"] * 3 + ["Summer"]
    row = spark.createDataFrame([(25.0, None, float("nan"))], "t double, d double, n double").select(humidity(F.col("t"), F.col("d")), humidity(F.col("t"), F.col("t")), clean_number(F.col("n"))).first()
    assert row[0] is None and abs(row[1] - 100) < 1e-9 and row[2] is None


@pytest.mark.parametrize(("hour", "mwh", "flag"), [(3, 1.0, "GOOD"), (3, 1.1, "WARNING"), (12, 0.0, "WARNING"), (12, 92.9, "WARNING"), (12, 93.0, "GOOD"), (9, -0.1, "BAD"), (6, 0.01, "GOOD"), (6, 9.0, "WARNING"), (12, None, "GOOD")])
def test_energy_rules(spark, hour, mwh, flag):
    df = spark.createDataFrame([(hour, mwh)], "h int, e double")
    assert apply_rules(df, energy_rules(F.col("h"), F.col("e"))).first()["quality_flag"] == flag


def test_scd2_sequences(spark):
    rows = [(1, i, s, i) for i, s in enumerate("AABA")]
    out = silver.scd2(spark.createDataFrame(rows, "k long, t long, s string, q long"), "k", "t", ["s"], "q").orderBy("t").collect()
    assert [(r["t"], r["effective_to"], r["s"], r["is_current"]) for r in out] == [(0, 2, "A", False), (2, 3, "B", False), (3, None, "A", True)]


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    source = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    once = upsert.upsert(target, source, ["k"])
    twice = upsert.upsert(once, source, ["k"])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_upsert_rewrites_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.upsert_partitions(spark, path, spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k long, v string, p string"), ["k"], "p")
    upsert.upsert_partitions(spark, path, spark.createDataFrame([(2, "c", "y")], "k long, v string, p string"), ["k"], "p")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "p").collect()) == [(1, "a", "x"), (2, "c", "y")]


def test_facility_keys_stay(spark):
    kind = "facility_code string, facility_name string, location_lat double, location_lng double, total_capacity_mw double"
    first = dims.dim_facility(spark.createDataFrame([("B", "b", 1.0, 1.0, 5.0), ("C", "c", 1.0, 1.0, 5.0)], kind))
    later = dims.dim_facility(spark.createDataFrame([("A", "a", 1.0, 1.0, 5.0), ("B", "b", 1.0, 1.0, 5.0)], kind), first)
    assert {r["facility_code"]: r["facility_key"] for r in later.collect()} == {"B": 1, "A": 2}


def test_facility_keys_need_no_single_window(spark):
    kind = "facility_code string, facility_name string, location_lat double, location_lng double, total_capacity_mw double"
    codes = [f"F{i}" for i in range(500)]
    dim = dims.dim_facility(spark.createDataFrame([(c, c, 1.0, 1.0, 5.0) for c in codes], kind).repartition(5))
    assert {r["facility_code"]: r["facility_key"] for r in dim.collect()} == {c: k for k, c in enumerate(sorted(codes), 1)}
    plan = dim._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number() windowspecdefinition(_range" in plan


def test_lags_with_a_gap(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("F", t, 1.0), ("F", t + dt.timedelta(hours=2), 3.0), ("F", t + dt.timedelta(hours=3), 4.0)], "facility_code string, date_hour timestamp, energy_mwh double")
    rows = features.lag_hours(features.lag_rows(df, steps=(1,)), steps=(1,)).orderBy("date_hour").collect()
    assert [(r["energy_mwh_lag_1"], r["energy_mwh_lag_1h"]) for r in rows] == [(None, None), (1.0, None), (3.0, 3.0)]


def test_entry_imports_and_names_match():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_random_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000)
    one, other = (sorted(features.random_split(d, ["id"]).collect()) for d in (df.repartition(7), df.coalesce(1)))
    assert one == other and 0.77 < sum(r["split"] == "train" for r in one) / 5000 < 0.83


def test_studies_of_empty_facts(spark):
    fact = spark.createDataFrame([], "facility_code string, date_key int, energy_mwh double, yr_weighted_kwh double, irr_kwh_m2_hour double, is_valid boolean")
    assert kpi.filter_scenarios(fact).count() == kpi.filter_comparison(fact).count() == kpi.daily_stats(fact).count() == 0


def test_filter_without_rows_is_listed(spark):
    fact = spark.createDataFrame([("F", 1, 1.0, 2000.0, 0.001, True), ("F", 1, 1.0, None, None, False)], "facility_code string, date_key int, energy_mwh double, yr_weighted_kwh double, irr_kwh_m2_hour double, is_valid boolean")
    out = {r["scenario"]: (r["records"], r["retention_pct"], r["avg_pr"], r["compliant"]) for r in kpi.filter_scenarios(fact).collect()}
    assert out["all_filters"] == (0, 0.0, None, False) and out["without_irradiance"] == (1, 50.0, 50.0, False)


def test_trees_have_production_settings(spark):
    rows = spark.createDataFrame([(float(i), float(i % 7)) for i in range(200)], "x double, y double")
    tree = features.train_trees(rows, ["x"], "y", "decision_tree").stages[-1]
    assert (tree.getMaxDepth(), tree.getMinInstancesPerNode(), tree.getMaxBins()) == (20, 20, 64)
    boosted = features.train_trees(rows, ["x"], "y", maxIter=2).stages[-1]  # two trees will do here
    assert (boosted.getMaxDepth(), boosted.getStepSize(), boosted.getMaxBins(), boosted.getMinInfoGain(), boosted.getSubsamplingRate()) == (8, 0.08, 256, 0.005, 0.85)
    assert features.TREE_PARAMS["gbt"]["maxIter"] == 150


def test_exact_percentiles_hold_no_column_in_one_task(spark):
    rows = [(g, float(x)) for g, n in (("a", 501), ("b", 2), (None, 7)) for x in range(n)] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    out = audit.distribution(df, "x", ["g"], (0.05, 0.5, 0.95), exact=True)
    assert {r["g"]: (r["n"], r["p5"], r["p50"], r["p95"]) for r in out.collect()} == {"a": (501, 25.0, 250.0, 475.0), "b": (2, 0.05, 0.5, 0.95), None: (7, 0.3, 3.0, 5.7), "c": (0, None, None, None)}
    whole, none = (features.residual_stats(d.withColumn("p", F.lit(0.0)), "x", "p", exact=True) for d in (df, df.where("g = 'c'")))
    assert (whole.first()["n"], whole.first()["median_residual"], none.first()["median_residual"]) == (510, 245.5, None)
    for d in (out, whole):
        assert "percentile(" not in d._jdf.queryExecution().optimizedPlan().toString()
