import datetime as dt

import pytest
from pyspark.sql import functions as F

from helio.functions.scalars import network_offset, network_zone
from helio.operators import audit, dims, facts, features, kpi, silver, upsert, watermarks
from helio.sources import nested

T = dt.datetime(2024, 1, 1)
HOURS = "facility_code string, date_hour timestamp"


def test_missing_table_is_none_and_columns_are_required(spark, tmp_path):
    assert nested.read_table(spark, str(tmp_path / "no"), ["a"]) is None
    nested.overwrite_table(spark.createDataFrame([(1,)], "a int"), str(tmp_path / "t"))
    assert nested.read_table(spark, str(tmp_path / "t"), ["a"]).count() == 1
    with pytest.raises(ValueError, match="lacks columns"):
        nested.read_table(spark, str(tmp_path / "t"), ["a", "b"])


def test_required_tables(spark):
    facts.require(a=spark.range(1))
    with pytest.raises(ValueError, match="b, c"):
        facts.require(a=spark.range(1), b=spark.range(0), c=None)


@pytest.mark.parametrize(("start", "end", "day"), [(None, None, "2024-02-01"), (dt.date(2024, 1, 2), None, "2024-01-02"), (dt.date(2024, 1, 2), dt.datetime(2024, 1, 5, 7), "2024-01-05")])
def test_snapshot_day(start, end, day):
    assert nested.snapshot_day(start, end, dt.date(2024, 2, 1)) == day


def test_empty_table_is_created_once(spark, tmp_path):
    path = str(tmp_path / "e")
    assert nested.create_empty(spark, path, "a int") and not nested.create_empty(spark, path, "a int")
    assert spark.read.parquet(path).columns == ["a"]


def test_facility_summary_of_odd_units(spark):
    unit = "struct<code:string, status_id:string, fueltech_id:string, dispatch_type:string, capacity_mw:string, capacity:double, capacity_registered:double, registered_capacity:double, capacity_maximum:double, capacity_storage:double>"
    rows = [
        ("A", "a", [("u1", "Operating", "Solar", "gen", "0", 2.5, None, 7.0, None, None), ("", None, "solar", "GEN", "NaN", None, 3.0, None, 1.25, 0.0), (None, "retired", "", None, None, None, None, 4.0, None, None)]),
        ("B", "b", []),
        ("C", None, None),
    ]
    out = {r["code"]: r for r in nested.facility_summary(spark.createDataFrame(rows, f"code string, name string, units array<{unit}>")).collect()}
    a = out["A"]
    assert (a["unit_count"], a["total_capacity_mw"], a["total_capacity_registered_mw"], a["total_capacity_maximum_mw"], a["total_capacity_storage_mwh"]) == (3, 9.5, 14.0, 1.25, None)
    assert (a["unit_fueltech_summary"], a["unit_status_summary"], a["unit_dispatch_summary"], a["unit_codes"]) == ("solar:2", "operating:1; retired:1", "GEN:2", "u1")
    for code in "BC":
        assert out[code]["unit_count"] <= 0 and all(out[code][c] is None for c in ("total_capacity_mw", "unit_fueltech_summary", "unit_codes"))


def test_facilities_are_ordered_nulls_last(spark):
    kind = "code string, name string, network_id string, network_region string, units array<struct<status_id:string, fueltech_id:string>>"
    ok = [("Operating", "solar")]
    rows = [("1", None, "NEM", "B", ok), ("2", "z", "NEM", None, ok), ("3", "y", None, "A", ok), ("4", "x", "NEM", "B", ok), ("5", "w", "WEM", "A", [("operating", "wind"), ("retired", "solar")]), ("6", "v", "NEM", "B", None)]
    df = spark.createDataFrame(rows, kind)
    assert [r["code"] for r in nested.select_facilities(df).collect()] == ["6", "4", "1", "2", "5", "3"]
    assert [r["code"] for r in nested.select_facilities(df, statuses=["OPERATING"], fueltechs=["Solar"]).collect()] == ["4", "1", "2", "3"]
    assert [r["code"] for r in nested.select_facilities(df, codes=["4"], networks=["nem"], region="B").collect()] == ["4"]


def test_flatten_series_leaves_out_malformed_points(spark):
    text = '{"data": [{"network_code": "NEM", "metric": "energy", "interval": "1h", "unit": "MWh", "results": [{"columns": {"unit_code": "U1"}, "data": [["2024-01-01 00:00:00", 1.5], ["soon", 2], ["2024-01-01 01:00:00"], ["2024-01-01 02:00:00", null]]}, {"columns": {"unit_code": "U9", "facility_code": "F9"}, "data": [["2024-01-01 03:00:00", "x"]]}]}]}'
    payload = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", nested.SERIES).alias("j")).select("j.*")
    out = nested.flatten_series(payload, spark.createDataFrame([("U1", "F1")], "unit_code string, facility_code string")).collect()
    assert sorted((r["facility_code"], r["interval_start"].hour, r["value"]) for r in out if r["value"] is not None) == [("F1", 0, 1.5)]
    assert sorted((r["facility_code"], r["interval_start"].hour) for r in out) == [("F1", 0), ("F1", 2), ("F9", 3)]


def test_listed_upsert_keeps_other_columns(spark):
    kind = "facility_code string, air_timestamp timestamp, a int, b int"
    target = spark.createDataFrame([("F", T, 1, 1), ("G", T, 2, 2)], kind)
    source = spark.createDataFrame([("F", T, None, 9), ("H", T, 3, 9)], kind)
    assert upsert.wide_keys(source.columns) == ["facility_code", "air_timestamp"] and upsert.wide_keys(["date", "weather_timestamp"])[1] == "weather_timestamp"
    out = {r["facility_code"]: (r["a"], r["b"]) for r in upsert.upsert_listed(target, source, ["a"]).collect()}
    assert out == {"F": (None, 1), "G": (2, 2), "H": (3, None)}
    assert upsert.upsert_listed(None, source, ["a"]).count() == 2
    with pytest.raises(ValueError):
        upsert.wide_keys(["facility_code"])


def test_upsert_moves_keys_between_partitions(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "k long, v string, p string"
    upsert.upsert_partitions(spark, path, spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "y")], kind), ["k"], "p")
    upsert.upsert_partitions(spark, path, spark.createDataFrame([(2, "d", "x")], kind), ["k"], "p")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "p").collect()) == [(1, "a", "x"), (2, "d", "x"), (3, "c", "y")]
    upsert.upsert_partitions(spark, path, spark.createDataFrame([(3, "e", "x")], kind), ["k"], "p")  # y has no row left
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "v", "p").collect()) == [(1, "a", "x"), (2, "d", "x"), (3, "e", "x")]


def test_date_ranges_of_all_types(spark):
    rows = spark.createDataFrame([("2024-01-05", 20240105), ("no date", 20240301), (None, None)], "text string, key int")
    assert upsert.delete_range(rows.select(F.col("text").alias("date")), "2024-01-01", "2024-01-31").count() == 2
    assert upsert.delete_range(rows.select(F.col("key").alias("date_key")), "2024-01-01", "2024-01-31").count() == 2


def test_windows(spark):
    watermarks.check_window(1, 1)
    with pytest.raises(ValueError):
        watermarks.check_window(2, 1)


def test_forward_fill_stays_within_a_day(spark):
    kind = "facility_code string, weather_timestamp timestamp, total_column_integrated_water_vapour double"
    rows = [("F", T + dt.timedelta(hours=h), v) for h, v in ((22, 5.0), (23, None), (24, None), (25, 7.0), (26, None))]
    out = silver.hourly_weather(spark.createDataFrame(rows, kind).withColumn("facility_name", F.lit("f"))).orderBy("date_hour").collect()
    assert [r["total_column_integrated_water_vapour"] for r in out] == [5.0, 5.0, None, 7.0, 7.0]


def _star(spark, weather, air):
    energy = spark.createDataFrame([("A", T, 25.5, 1), ("B", T, 38.25, 1)], HOURS + ", energy_mwh double, intervals_count long")
    w = spark.createDataFrame(weather, HOURS + ", shortwave_radiation double, temperature_2m double, dew_point_2m double, cloud_cover double, sunshine_duration double")
    a = spark.createDataFrame(air, HOURS + ", pm2_5 double, aqi_value int")
    fac = spark.createDataFrame([(1, "A", 50.0)], "facility_key int, facility_code string, total_capacity_mw double")
    return facts.fact_environmental(energy, w, a, fac, dims.dim_aqi(spark))


def test_fact_takes_the_first_of_double_hours(spark):
    twice = [("A", T, 850.0, 25.5, 15.2, 10.0, 3600.0), ("A", T, 650.0, 20.0, 10.0, 20.0, 1800.0)]
    for order in (twice, twice[::-1]):
        out = {r["facility_code"]: r for r in _star(spark, order, [("A", T, 9.0, 40), ("A", T, 8.0, 35)]).collect()}
        assert len(out) == 2 and (out["A"]["shortwave_radiation"], out["A"]["pm2_5"], out["A"]["aqi_value"]) == (650.0, 8.0, 35)
        assert (out["A"]["quality_flag"], out["B"]["quality_flag"], out["B"]["facility_key"]) == ("GOOD", "BAD", None)


def test_typed_projection(spark):
    out = facts.typed(spark.createDataFrame([(123456789.5, "x")], "a double, b string"), {"b": None, "a": "decimal(5,2)", "c": "decimal(4,1)", "d": None})
    assert out.columns == ["b", "a", "c", "d"] and tuple(out.first()) == ("x", None, None, None)


def test_forecast_ids_are_stable(spark):
    df = spark.range(200).select("id", F.lit(2.0).alias("y"), F.lit(1.0).alias("p"))
    one, other = ({r["id"]: r["forecast_id"] for r in facts.fact_forecast(d, "y", "p", ["id"]).collect()} for d in (df.repartition(5), df.coalesce(1)))
    assert one == other and len(set(one.values())) == 200


def test_model_version_row(spark):
    row = dims.dim_model_version(spark, [{"model_version_key": 1, "model_version_id": "tree_v1", "is_active": True}]).first()
    assert (row["model_version_id"], row["is_active"], row["hyperparameters"]) == ("tree_v1", True, None)


def test_lookup_can_require_rows(spark):
    fact, dim = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([], "k int, v int")
    assert dims.lookup(fact, dim, [(F.col("k"), "k")], ["v"]).count() == 1
    with pytest.raises(ValueError):
        dims.lookup(fact, dim, [(F.col("k"), "k")], ["v"], required=True)


def test_networks(spark):
    rows = spark.createDataFrame([("NEM",), ("WEM",), (None,), ("X",)], "n string").select(network_zone(F.col("n")), network_offset(F.col("n"))).collect()
    assert [tuple(r) for r in rows] == [("Australia/Brisbane", 10), ("Australia/Perth", 8), ("Australia/Brisbane", 10), ("Australia/Brisbane", 10)]


def test_facility_master_against_its_baseline(spark):
    kind = "facility_code string, effective_from timestamp, facility_name string, total_capacity_mw double"
    day = lambda n: T + dt.timedelta(days=n)
    rows = [("A", day(0), "a", 5.0), ("A", day(1), "a", 5.0), ("A", day(2), "b", 0.0), ("A", day(3), "a", 5.0), ("B", day(0), "x", None), (None, day(0), "n", 1.0)]
    full = silver.facility_master(spark.createDataFrame(rows, kind))
    want = [("A", day(0), day(2), False, "GOOD"), ("A", day(2), day(3), False, "CAPACITY_INVALID"), ("A", day(3), None, True, "GOOD"), ("B", day(0), None, True, "CAPACITY_INVALID")]
    pick = lambda df: sorted((r["facility_code"], r["effective_from"], r["effective_to"], r["is_current"], r["quality_flag"]) for r in df.collect())
    assert pick(full) == want
    for cut in (1, 2, 3):  # also where nothing changes after the baseline
        first = silver.facility_master(spark.createDataFrame([r for r in rows if r[1] < day(cut)], kind))
        later = silver.facility_master(spark.createDataFrame([r for r in rows if r[1] >= day(cut)], kind), first)
        assert pick(upsert.upsert(first, later, ["facility_code", "effective_from"])) == want
        assert pick(silver.facility_master(spark.createDataFrame([], kind), first).where("is_current")) == [w for w in pick(first) if w[3]]


def test_validated_features(spark):
    df = spark.createDataFrame([("F", T, 1.0, None, 2.0), ("F", T, 1.0, 3.0, None)], HOURS + ", energy_mwh double, energy_lag_1h double, cloud_cover double")
    assert [tuple(r)[2:] for r in features.validated(df, 1).collect()] == [(1.0, 0.0, 2.0)]
    with pytest.raises(ValueError, match="insufficient"):
        features.validated(df, 2)
    assert "pm2_5" not in features.select_features(df.withColumn("pm2_5", F.lit(1.0))).columns
    assert features.select_features(df.withColumn("pm2_5", F.lit(1.0)), air=True).columns[-1] == "pm2_5"


def test_train_evaluate_and_stored_model(spark, tmp_path):
    from pyspark.ml import PipelineModel

    rows = spark.createDataFrame([(f"F{i % 3}", T + dt.timedelta(hours=i), float(i % 24), float(i % 24) * 2 + 1) for i in range(600)], HOURS + ", x double, energy_lag double, y double".replace(", energy_lag double", ""))
    model, figures, ranked = features.train_evaluate(rows.withColumn("x_lag", F.lit(0.0)), ["x", "x_lag"], "y", "decision_tree")
    got = {r["split"]: (r["n"], r["rmse"], r["r2"]) for r in figures.collect()}
    assert got["validation"][0] == 90 and got["test"][0] == 90 and all(v[1] < 5 and v[2] > 0.8 for v in got.values())
    first = ranked.orderBy("rank_overall").first()
    assert (first["feature_name"], first["rank_in_category"], first["is_lag_feature"]) == ("x", 1, False)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    test = rows.limit(50).withColumn("x_lag", F.lit(0.0))
    assert [r["prediction"] for r in again.transform(test).collect()] == [r["prediction"] for r in model.transform(test).collect()]


def test_ranks_within_categories(spark):
    df = spark.createDataFrame([("b_lag", "L", 0.3), ("a", "W", 0.3), ("c", "W", 0.4)], "feature_name string, feature_category string, importance double")
    out = [(r["feature_name"], r["rank_overall"], r["rank_in_category"], r["cumulative_importance"], r["is_top_15"], r["is_lag_feature"]) for r in features.rank_importances(df, top=2).orderBy("rank_overall").collect()]
    assert out == [("c", 1, 1, 40.0, True, False), ("a", 2, 2, 70.0, True, False), ("b_lag", 3, 1, 100.0, False, True)]


def test_mape_without_labels_is_infinite(spark):
    assert features.metrics(spark.createDataFrame([(0.0, 1.0)], "y double, p double"), "y", "p").first()["mape_pct"] == float("inf")


def test_profiles_of_empty_tables(spark):
    none = spark.createDataFrame([], "x double, k string, d date")
    assert audit.describe(none, ["x"], exact=True).count() == 0 and audit.span(none, "k", "d").first()["keys"] == 0
    assert kpi.filter_waterfall(spark.createDataFrame([], "energy_mwh double, total_capacity_mw double, irr_kwh_m2_hour double, quality_flag string")).first()["retention_pct"] is None
