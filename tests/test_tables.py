"""Stored tables: deletes by file, clustered writes, late versions, aligned facts, stretches, pruning, buckets, sketches, loads."""

import datetime as dt
import os
import pathlib
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helio.operators import facts, features, silver, sketches, upsert
from helio.operators.ranks import numbered
from helio.plans import tables
from helio.sources import stored

SF = "/root/testdata/sf0.001"


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in pathlib.Path(path).rglob("*.parquet") if not any(x[0] in "._" for x in p.relative_to(path).parts)}


def table(spark, path, rows=400):
    df = spark.range(rows).select("id", (F.col("id") % 4).cast("int").alias("k"), F.concat(F.lit("d:"), F.col("id") % 2).alias("part"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 10).cast("int")).alias("day"))
    stored.write_partitioned(df, path, ["part", "k"], most_rows=30)


def test_delete_rewrites_only_files_with_matching_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path)
    before = files_of(path)
    done = stored.delete_stored(spark, path, (F.col("k") == 1) & (F.col("id") < 60), ["part", "k"])
    left = spark.read.parquet(path)
    assert done["deleted"] == 15 and done["partitions_dropped"] == 0 and done["files_rewritten"] + done["files_removed"] >= 1
    assert sorted(r["id"] for r in left.collect()) == [i for i in range(400) if not (i % 4 == 1 and i < 60)]
    after = files_of(path)
    assert all(after.get(f) == t for f, t in before.items() if "k=1" not in f) and left.where("k = 1").select("part").distinct().count() == 1
    assert not [x for x in os.listdir(path) if x.startswith("_change")]


def test_delete_drops_empty_partitions_and_keeps_unknown_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, path)
    done = stored.delete_stored(spark, path, F.when(F.col("id") != 7, F.col("k") >= 2), ["part", "k"])  # null for one row, which stays
    left = spark.read.parquet(path)
    assert done["partitions_dropped"] == 1 and left.count() == 201 and left.where("k >= 2").collect()[0]["id"] == 7
    assert stored.delete_stored(spark, path, F.col("id") < 0, ["part", "k"]) == {"deleted": 0, "files_rewritten": 0, "files_removed": 0, "partitions_dropped": 0}


@pytest.mark.parametrize("partition", [[], ["part", "k"]])
def test_delete_of_all_rows_keeps_the_schema(spark, tmp_path, partition):
    path = str(tmp_path / "t")
    df = spark.range(50).select("id", (F.col("id") % 4).cast("int").alias("k"), F.lit("x").alias("part"))
    stored.write_partitioned(df, path, partition)
    assert stored.delete_stored(spark, path, None, partition)["deleted"] == 50
    left = spark.read.parquet(path)
    assert left.count() == 0 and sorted(left.columns) == ["id", "k", "part"]


def test_a_half_done_change_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    table(spark, path)

    def lost(files, journal):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(stored, "_apply", lost)
        with pytest.raises(RuntimeError):
            stored.delete_stored(spark, path, F.col("id") < 100, ["part", "k"])
    assert spark.read.parquet(path).count() == 400  # not touched yet
    assert stored.recover(spark, path) == 1 and stored.recover(spark, path) == 0
    spark.catalog.refreshByPath(path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(100, 400))


def test_purge_counts_first_and_skips_tables_without_a_date(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    table(spark, a)
    spark.range(3).select(F.col("id").cast("double").alias("x")).write.parquet(b)
    days = lambda df: upsert.date_range_condition(df, "2024-01-03", "2024-01-04", stored.PURGE_COLUMNS)
    every = {"a": (a, ["part", "k"]), "b": (b, [])}
    assert [tuple(r)[:2] for r in stored.purge(spark, every, days, dry_run=True).collect()] == [("a", 20), ("b", 0)] and spark.read.parquet(a).count() == 400
    assert [(r["table_name"], r["deleted"], r["skipped"]) for r in stored.purge(spark, every, days).collect()] == [("a", 20, False), ("b", 0, True)]
    assert spark.read.parquet(a).count() == 380


def test_writes_are_clustered_by_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 20_000, 1, 200).select("id", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 1000).cast("int")).alias("day"))
    stored.write_partitioned(rows, path, ["day"])
    per_day = {}
    for f in files_of(path):
        per_day[os.path.dirname(f)] = per_day.get(os.path.dirname(f), 0) + 1
    assert len(per_day) == 1000 and max(per_day.values()) <= 2
    hot = str(tmp_path / "hot")
    stored.write_partitioned(spark.range(1000).select("id", F.lit(1).alias("k")), hot, ["k"], most_rows=100)
    assert len(files_of(hot)) >= 10 and spark.read.parquet(hot).count() == 1000


def test_upsert_that_empties_a_partition_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.upsert_partitions(spark, path, spark.createDataFrame([(1, "a:b"), (2, "c"), (3, "d")], "id int, k string"), ["id"], "k")
    before = files_of(path)
    upsert.upsert_partitions(spark, path, spark.createDataFrame([(1, "c")], "id int, k string"), ["id"], "k")
    after = files_of(path)
    assert {f: t for f, t in before.items() if "k=d" in f}.items() <= after.items() and not any("k=a" in f for f in after)
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "k").collect()) == [(1, "c"), (2, "c"), (3, "d")]


def _peaks(spark, group, run):
    """Most execution memory of the stages that ``run`` starts, in bytes."""
    sc = spark.sparkContext
    sc.setJobGroup(group, "")
    run()
    sc.setLocalProperty("spark.jobGroup.id", None)
    jobs, store = sc.statusTracker(), sc._jsc.sc().statusStore()
    stages = {s for j in jobs.getJobIdsForGroup(group) for s in jobs.getJobInfo(j).stageIds}
    assert stages
    return max(store.lastStageAttempt(s).peakExecutionMemory() for s in stages if jobs.getStageInfo(s) is not None)


def test_a_large_partition_is_written_without_being_held(spark, tmp_path):
    rows = spark.range(300_000).select("id", F.when(F.col("id") % 3 == 0, "P").otherwise("F").alias("s"))
    assert _peaks(spark, "write", lambda: stored.write_partitioned(rows, str(tmp_path / "t"), ["s"])) == 0
    assert spark.read.parquet(str(tmp_path / "t")).where("s = 'F'").count() == 200_000
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_partitions_are_not_brought_into_one_task_by_an_upsert(spark, tmp_path, monkeypatch):
    path, plans, cut = str(tmp_path / "t"), [], upsert.cut
    monkeypatch.setattr(upsert, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(9000).select("id", F.element_at(F.array(*map(F.lit, "FOP")), (F.col("id") % 3 + 1).cast("int")).alias("s"))
        upsert.upsert_partitions(spark, path, rows, ["id"], "s")
        upsert.upsert_partitions(spark, path, rows.where("s = 'P'").withColumn("s", F.lit("F")), ["id"], "s")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plans[-1] and "hashpartitioning(s#" not in plans[-1]
    assert sorted((r["s"], r["count"]) for r in spark.read.parquet(path).groupBy("s").count().collect()) == [("F", 6000), ("O", 3000)]


def test_upsert_keeps_rows_without_a_partition_value(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert.upsert_partitions(spark, path, spark.createDataFrame([(1, None), (2, "b"), (3, None), (4, "c")], "id int, k string"), ["id"], "k")
    upsert.upsert_partitions(spark, path, spark.createDataFrame([(3, "b"), (5, None)], "id int, k string"), ["id"], "k")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "k").collect()) == [(1, None), (2, "b"), (3, "b"), (4, "c"), (5, None)]
    upsert.upsert_partitions(spark, path, spark.createDataFrame([(1, "b"), (5, "b")], "id int, k string"), ["id"], "k")  # none is left without one
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("id", "k").collect()) == [(1, "b"), (2, "b"), (3, "b"), (4, "c"), (5, "b")]


HISTORY = "code string, day timestamp, size int, name string"


def test_versions_do_not_depend_on_the_order_of_arrival(spark):
    rng = random.Random(4)
    t = dt.datetime(2024, 1, 1)
    rows = [(c, t + dt.timedelta(days=d), rng.choice([1, 1, 2, None]), rng.choice(["x", "x", "y"])) for c in "abc" for d in rng.sample(range(60), 20)]
    want, full = [], {}
    for r in sorted(rows):
        full.setdefault(r[0], []).append(r)
    for c, each in full.items():
        kept = [r for i, r in enumerate(each) if i == 0 or r[2:] != each[i - 1][2:]]
        want += [(c, r[1], kept[i + 1][1] if i + 1 < len(kept) else None, *r[2:], i + 1 == len(kept)) for i, r in enumerate(kept)]
    for _ in range(2):
        rng.shuffle(rows)
        known = None
        for lo in range(0, len(rows), 20):
            new = silver.splice(known, spark.createDataFrame(rows[lo : lo + 20], HISTORY), "code", "day", ["size", "name"])
            known = silver.replace_keys(known, new, "code").checkpoint()
        got = [tuple(r) for r in known.select("code", "day", "effective_to", "size", "name", "is_current").orderBy("code", "day").collect()]
        assert got == want


def test_a_row_corrects_its_own_day_and_other_keys_stay(spark):
    t = dt.datetime(2024, 1, 1)
    day = lambda n: t + dt.timedelta(days=n)
    first = silver.splice(None, spark.createDataFrame([("a", day(0), 1, "x"), ("a", day(2), 1, "x"), ("b", day(0), 5, "z"), ("a", None, 9, "q")], HISTORY), "code", "day", ["size", "name"])
    late = silver.splice(first, spark.createDataFrame([("a", day(1), 2, "x")], HISTORY), "code", "day", ["size", "name"])
    assert {r["code"] for r in late.collect()} == {"a"}
    whole = silver.replace_keys(first, late, "code").orderBy("code", "day").collect()
    assert [(r["code"], r["day"], r["size"]) for r in whole] == [("a", day(0), 1), ("a", day(1), 2), ("a", day(2), 1), ("b", day(0), 5)]
    fixed = silver.splice(silver.replace_keys(first, late, "code"), spark.createDataFrame([("a", day(1), 1, "x")], HISTORY), "code", "day", ["size", "name"]).collect()
    assert [(r["day"], r["effective_to"], r["seen"]) for r in fixed] == [(day(0), None, [day(0), day(1), day(2)])]


def test_aligned_tables_take_each_sides_first_row_in_one_exchange(spark):
    rng = random.Random(2)
    some = lambda: rng.choice([None, 1.0, 2.0, 3.0])
    main = spark.createDataFrame([(rng.choice(["a", "b", None]), rng.randrange(6), float(i)) for i in range(40)], "f string, h int, e double")
    w = spark.createDataFrame([(rng.choice(["a", "b", None]), rng.choice([0, 1, 2, 3, None]), some(), some()) for _ in range(30)], "f string, h int, x double, y double")
    a = spark.createDataFrame([(rng.choice(["a", "b"]), rng.randrange(6), some()) for _ in range(5)], "f string, h int, z double")
    got = facts.aligned(main, {"_w": (w, ["x", "y"]), "_a": (a, ["z"])}, ["f", "h"])
    want = main.join(facts.one_per(w, ["f", "h"]), ["f", "h"], "left").join(facts.one_per(a, ["f", "h"]), ["f", "h"], "left").select("f", "h", "e", "x", "y", "z")
    key = lambda r: str(tuple(r))
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect())) and got.count() == 40
    assert got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning(f") == 1


def test_lags_over_stretches_are_those_of_one_window(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 9 == 0, None).otherwise(F.concat(F.lit("F"), (F.col("id") % 5 > 0).cast("int"))).alias("facility_code"), F.timestamp_seconds((F.col("id") * 7919 % 3001) * 3600).alias("date_hour"), F.col("id").cast("double").alias("energy_mwh"), F.lit("c").alias("_no_such"))
    w = Window.partitionBy("facility_code").orderBy("date_hour")
    by_rows = rows.withColumns({f"energy_mwh_lag_{n}": F.lag("energy_mwh", n).over(w) for n in (1, 24, 168)})
    for stretch in (168, 200, 10_000):
        got = features.lag_rows(rows, stretch=stretch)
        assert got.columns == by_rows.columns and got.exceptAll(by_rows).isEmpty() and got.count() == 3000
    by_hours = rows
    for n in (1, 24, 168):
        at = Window.partitionBy("facility_code").orderBy(F.unix_timestamp("date_hour")).rangeBetween(-n * 3600, -n * 3600)
        by_hours = by_hours.withColumn(f"energy_mwh_lag_{n}h", F.max("energy_mwh").over(at))
    for hours in (168, 500, 100_000):
        got = features.lag_hours(rows, hours=hours)
        assert got.columns == by_hours.columns and got.exceptAll(by_hours).isEmpty() and got.count() == 3000


def test_one_facilitys_ten_million_rows_are_not_in_one_task(spark):
    rows = spark.range(10_000_000).select(F.lit("F1").alias("facility_code"), F.timestamp_seconds(F.col("id") * 3600).alias("date_hour"), (F.col("id") % 1000).cast("double").alias("energy_mwh"))
    out = features.lag_rows(rows, steps=(1, 168), stretch=500_000)
    far = lambda n: F.when(F.unix_timestamp("date_hour") >= n * 3600, F.pmod(F.floor(F.unix_timestamp("date_hour") / 3600) - n, F.lit(1000)).cast("double"))
    wrong = F.count_if(~F.col("energy_mwh_lag_1").eqNullSafe(far(1)) | ~F.col("energy_mwh_lag_168").eqNullSafe(far(168)))
    tasks = out.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), wrong.alias("wrong")).collect()
    assert sum(r["n"] for r in tasks) == 10_000_000 and sum(r["wrong"] for r in tasks) == 0 and max(r["n"] for r in tasks) < 6_000_000


def test_numbers_within_groups(spark):
    rows = spark.range(500).select(F.when(F.col("id") >= 20, F.lit("hot")).otherwise(F.when(F.col("id") > 3, F.col("id").cast("string"))).alias("g"), (F.col("id") * 37 % 501).alias("o"))
    want = rows.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("o")).cast("long"))
    assert numbered(rows.repartition(7), ["g"], ["o"], "n").exceptAll(want).isEmpty()


def test_star_reads_only_the_partitions_of_its_days(spark, tmp_path):
    fact, dates = tables.star_tables(spark, SF, str(tmp_path))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        star = tables.weekends(fact, dates)
        rows = star.collect()
        plan = star._jdf.queryExecution().executedPlan()
        assert "dynamicpruning" in plan.toString()
        leaves = plan.collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size()) if "date_key" in leaves.apply(i).toString() and "energy_mwh" in leaves.apply(i).toString()]
        assert [s.metrics().apply("numPartitions").value() for s in scans] == [len(rows)]
        assert 0 < len(rows) < fact.select("date_key").distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_bucketed_upsert_does_not_exchange_the_table(spark, tmp_path):
    store = stored.Bucketed(spark, str(tmp_path / "b"), ["id"], 8)
    assert store.read() is None
    store.upsert(spark.range(1000).select("id", F.lit("old").alias("v")))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.range(990, 1010).select("id", F.lit("new").alias("v"))
        plan = store.merged(batch)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        for _ in range(3):
            store.upsert(batch)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    got = {r["id"]: r["v"] for r in store.read().collect()}
    assert got == {i: "new" if i >= 990 else "old" for i in range(1010)}
    assert sorted(x for x in os.listdir(tmp_path / "b")) == ["v3", "v4"]
    assert "Exchange" not in store.read().groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    reopened = stored.Bucketed(spark.newSession(), str(tmp_path / "b"), ["id"], 8)
    assert reopened.read().count() == 1010


def test_sketches_of_days_merge_to_the_table(spark):
    rows = spark.range(20_000).select(F.timestamp_seconds(F.col("id") * 50).alias("ts"), (F.col("id") % 3000).alias("key"), F.when(F.col("id") % 10 > 0, F.col("id").cast("double")).alias("v"), (F.col("id") % 2).alias("g"))
    daily = sketches.daily_sketches(rows, "ts", "v", "key", ["g"])
    assert daily.count() == 2 * 12
    percents = {"p10": 0.1, "p90": 0.9}
    profile = sketches.merged_sketches(daily, percents)
    one = profile.first()
    assert one["n"] == 20_000 and abs(one["distinct_keys"] - 3000) < 150 and (one["min_value"], one["max_value"]) == (1.0, 19_999.0)
    assert all(r["rank_error"] < 0.02 for r in sketches.rank_errors(rows, "v", profile, percents).collect())
    empty = sketches.merged_sketches(sketches.daily_sketches(rows.withColumn("v", F.lit(None)), "ts", "v", "key"), percents).first()
    assert empty["p10"] is None and empty["n"] == 20_000


def test_loads_from_watermarks_change_only_what_is_new(spark, tmp_path):
    base = str(tmp_path / "layers")
    raw = {n: tables.view(spark, SF, v) for n, v in (("readings", "readings"), ("weather", "raw_weather"), ("air", "raw_air_quality"), ("facilities", "raw_facilities"))}
    once, again = (F.lit(x).cast("timestamp") for x in ("2024-06-01", "2024-06-02"))
    tables.layer_load(spark, raw, base, once)
    first = spark.read.parquet(f"{base}/fact").cache()
    rows, held = first.count(), files_of(base)
    tables.layer_load(spark, raw, base, again)
    fact = spark.read.parquet(f"{base}/fact")
    assert fact.count() == rows and fact.where(F.col("created_at") != once).isEmpty()
    reloaded = fact.where(F.col("updated_at") == again).select("date_key").distinct().count()
    assert 1 <= reloaded < fact.select("date_key").distinct().count()
    now = files_of(base)
    assert sum(now.get(f) == t for f, t in held.items() if "/fact/" in f) >= fact.select("date_key").distinct().count() - reloaded
    assert fact.drop("updated_at").exceptAll(first.drop("updated_at")).isEmpty()
