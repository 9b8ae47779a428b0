"""Broken input, lookups in many ranges, stumps and leaves, the life of a model."""

import random

import pytest
from pyspark.sql import functions as F

from helio.operators import features, intervals, models
from helio.sources import quarantine

SCHEMA = "id long, name string, value double"


def test_json_rows_are_kept_or_set_aside_with_their_first_reason(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text('{"id":1,"name":"a","value":1.5}\n{"id":2,"name":\n{"id":"x","name":"b","value":1}\n{"id":3,"value":-1}\n{"id":4,"name":null,"value":-2,"more":1}\n[1,2]\n{"id":5,"name":"c"}\n')
    good, aside = quarantine.read_checked(spark, str(path), SCHEMA, rules={"no name": F.col("name").isNull(), "negative": F.col("value") < 0})
    assert [tuple(r) for r in good.orderBy("id").collect()] == [(1, "a", 1.5), (5, "c", None)]
    rows = aside.collect()
    assert sorted(r["reason"] for r in rows) == ["no name", "no name", "unreadable", "unreadable", "unreadable"]
    assert all((r["raw"] is not None) == (r["reason"] == "unreadable") and r["file"].endswith("in.json") for r in rows)
    store = str(tmp_path / "aside")
    for source in ("a", "b", "a"):
        quarantine.store_quarantine(aside, store, source, F.lit("2024-01-02").cast("date"))
    counts = {(r["source"], r["reason"]): r["n"] for r in quarantine.quarantine_counts(spark.read.parquet(store)).collect()}
    assert counts == {("a", "unreadable"): 6, ("a", "no name"): 4, ("b", "unreadable"): 3, ("b", "no name"): 2}


def test_csv_rows_of_the_wrong_width_or_kind_are_set_aside(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,name,value\n1,a,1.5\n2,b\n3,c,many\n4,d,2,5\n5,,\n")
    good, aside = quarantine.read_checked(spark, str(path), SCHEMA, "csv")
    assert [r["id"] for r in good.orderBy("id").collect()] == [1, 5] and sorted(r["raw"] for r in aside.collect()) == ["2,b", "3,c,many", "4,d,2,5"]


def test_points_are_kept_or_set_aside(spark):
    points = [["2024-01-01 00:00:00", "1.5"], ["2024-01-01 01:00:00", None], ["soon", "1"], [None, "1"], ["2024-01-01 02:00:00"], ["2024-01-01 03:00:00", "much"], None, []]
    kind = "data array<struct<network_code:string, metric:string, interval:string, unit:string, results:array<struct<columns:struct<unit_code:string, facility_code:string>, data:array<array<string>>>>>>"
    series = [("NEM", "energy", "1h", "MWh", [(("U1", None), points), (("U2", "F9"), points[:1]), (("U3", None), points[:1]), (None, None)])]
    payloads = spark.createDataFrame([(series,), ([],), (None,)], kind)
    good, aside = quarantine.points_checked(payloads, spark.createDataFrame([("U1", "F1")], "unit_code string, facility_code string"))
    assert sorted((r["unit_code"], r["facility_code"], r["value"]) for r in good.where("value IS NOT NULL").collect()) == sorted([("U1", "F1", 1.5), ("U2", "F9", 1.5), ("U3", None, 1.5)], key=str)
    assert good.count() == 4
    assert sorted(r["reason"] for r in aside.collect()) == ["bad time", "bad value", "no time", "too short", "too short", "too short"]


def test_ranges_that_overlap_against_all_pairs(spark):
    rng = random.Random(8)
    spans = [(i, lo, lo + w) for i, lo, w in ((i, rng.uniform(-50, 50), rng.choice([0, 0.0001, 0.3, 1, 4, 64, 200])) for i in range(200))] + [(900, None, 1.0), (901, 5.0, 1.0), (902, float("nan"), 3.0), (903, 7.0, 7.0)]
    values = [rng.uniform(-80, 120) for _ in range(300)] + [None, float("nan"), 7.0, *[s[1] for s in spans[:20]], *[s[2] for s in spans[:20]]]
    fact = spark.createDataFrame(list(enumerate(values)), "n int, v double").withColumn("_b", F.lit("c"))
    ranges = spark.createDataFrame(spans, "k int, lo double, hi double")
    got = {r["n"]: (r["k"], r["lo"]) for r in intervals.interval_lookup(fact, "v", ranges.repartition(3), "lo", "hi", ["k", "lo"]).collect()}
    ok = [s for s in spans if s[1] is not None and s[1] == s[1] and s[1] <= s[2]]
    for n, v in enumerate(values):
        best = min(((s[1], s[2], s[0]) for s in ok if v is not None and v == v and s[1] <= v <= s[2]), default=None)
        assert got[n] == ((None, None) if best is None else (best[2], best[0])), (n, v)
    inner = intervals.interval_lookup(fact, "v", ranges, "lo", "hi", ["k"], "inner")
    assert inner.columns == ["n", "v", "_b", "k"] and inner.count() == sum(k is not None for k, _ in got.values())
    assert intervals.interval_lookup(fact, "v", ranges.limit(0), "lo", "hi", ["k"]).where("k IS NULL").count() == len(values)


def test_a_hundred_thousand_ranges_without_a_loop_over_them(spark):
    ranges = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("lo"), (F.col("id") * 10 + F.col("id") % 9).alias("hi"))
    fact = spark.range(200_000).select((F.col("id") * 7919 % 1_000_000).alias("v"))
    out = intervals.interval_lookup(fact, "v", ranges, "lo", "hi", ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    wrong = ~F.col("k").eqNullSafe(F.when(F.col("v") % 10 <= F.floor(F.col("v") / 10) % 9, F.floor(F.col("v") / 10)))
    assert out.count() == 200_000 and out.where(wrong).isEmpty()


def test_stump_against_all_splits(spark):
    rng = random.Random(3)
    rows = [(float(rng.randrange(6)), float(rng.randrange(9)), 0.0, 0.0) for _ in range(400)]
    rows = [(a, b, c, (10.0 if b > 4 else 1.0) + a * 0.1 + rng.random()) for a, b, c, _ in rows]
    df = spark.createDataFrame(rows, "a double, b double, flat double, y double")
    best = None
    for i, name in enumerate(("a", "b", "flat")):
        values = sorted({r[i] for r in rows})
        for lo, hi in zip(values, values[1:]):
            cut = (lo + hi) / 2
            under, over = ([r[3] for r in rows if (r[i] <= cut) == side] for side in (True, False))
            gain = sum(under) ** 2 / len(under) + sum(over) ** 2 / len(over)
            best = max(best or (0,), (gain, name, cut, sum(under) / len(under), sum(over) / len(over)))
    name, cut, under, over = models.stump(df, ["a", "b", "flat"], "y")
    assert (name, cut) == best[1:3] and (under, over) == pytest.approx(best[3:])
    assert models.stump(df, ["flat"], "y") is None
    with pytest.raises(ValueError, match="more than 5"):
        models.stump(df, ["a", "b"], "y", most_values=5)
    tree = features.train_trees(df, ["a", "b"], "y", "decision_tree", maxDepth=4)
    leaves = models.leaf_means(tree, df, "y").collect()
    assert sum(r["n"] for r in leaves) == 400 and len(leaves) > 2 and all(r["prediction"] == pytest.approx(r["mean_label"]) for r in leaves)


def test_versions_keep_keys_and_times_and_one_is_active(spark, tmp_path):
    base = str(tmp_path / "models")
    df = spark.range(60).select((F.col("id") % 6).cast("double").alias("a"), (F.col("id") % 6 * 2).cast("double").alias("y"))
    with pytest.raises(ValueError, match="no active version"):
        models.active_model(spark, base, "m")
    day = lambda n: F.lit(f"2024-06-0{n}").cast("timestamp")
    keys = []
    for n, (version, depth) in enumerate([("v1", 1), ("v2", 2), ("v1", 3), ("other", 1)], 1):
        tree = features.train_trees(df, ["a"], "y", "decision_tree", maxDepth=depth, minInstancesPerNode=1)
        record = {"model_version_id": version, "model_name": "n" if version == "other" else "m", "is_active": version != "other", "hyperparameters": {"maxDepth": depth}}
        keys.append(models.register_model(spark, base, tree, record, features.importance_rank(spark, tree, ["a"]), day(n)))
    assert keys == [1, 2, 1, 3]
    rows = {r["model_version_id"]: r for r in spark.read.parquet(f"{base}/dim_model_version").collect()}
    assert [(rows[v]["is_active"], rows[v]["created_at"].day, rows[v]["updated_at"].day) for v in ("v1", "v2", "other")] == [(True, 1, 3), (False, 2, 2), (False, 4, 4)]
    loaded, row = models.active_model(spark, base, "m")
    assert row["model_version_id"] == "v1" and loaded.stages[-1].depth == 3 and rows["v1"]["train_start_date"] is None
    kept = spark.read.parquet(f"{base}/dim_feature_importance")
    assert sorted((r["model_version_key"], r["importance_value"]) for r in kept.collect()) == [(1, 1.0), (2, 1.0), (3, 1.0)]


def test_crowded_ranges_are_not_all_met_by_a_value(spark):
    n = 20_000  # all of them hold 5,000 to 100,000, but for every tenth, which lies inside the one before
    ranges = spark.range(n).select(F.col("id").alias("k"), (F.col("id") / 4).alias("lo"), F.when(F.col("id") % 10 == 9, 60_000).otherwise(100_000 + F.col("id")).cast("double").alias("hi"))
    assert intervals._needed(ranges.selectExpr("lo AS _lo", "hi AS _hi", "k AS _best").repartition(7)).count() == n * 9 // 10
    fact = spark.range(-500, 130_000, 1).select(F.col("id").alias("n"), F.col("id").cast("double").alias("v"))
    out = intervals.interval_lookup(fact, "v", ranges, "lo", "hi", ["k"]).cache()
    first = F.when((F.col("v") - 100_000) % 10 == 9, F.col("v") - 99_999).otherwise(F.col("v") - 100_000).cast("long")
    want = F.when((F.col("v") >= 0) & (F.col("v") <= 100_000), 0).when((F.col("v") > 100_000) & (F.col("v") < 100_000 + n - 1), first)
    assert out.count() == 130_500 and out.where(~F.col("k").eqNullSafe(want)).isEmpty()
    groups = spark.createDataFrame([(1, float("-inf"), 1.0), (2, 1e301, float("inf")), (3, 0.5, 0.5 + 1e-12)], "k int, lo double, hi double")
    ends = spark.createDataFrame([(0, float("-inf")), (1, 0.5), (2, 1.5), (3, 1e305), (4, float("inf")), (5, float("nan")), (6, None)], "n int, v double")
    assert {r["n"]: r["k"] for r in intervals.interval_lookup(ends, "v", groups, "lo", "hi", ["k"]).collect()} == {0: 1, 1: 1, 2: None, 3: 2, 4: 2, 5: None, 6: None}
