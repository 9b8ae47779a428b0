"""Registered queries of stored tables: deletes, purges, clustered writes, late master rows, pruned stars, bucketed upserts, sketches, incremental layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.functions.scalars import DEFAULT_ZONE, local_time
from helio.operators import dims, facts, silver, sketches, upsert, watermarks
from helio.plans.loads import _path
from helio.plans.queries import CTES, _air, _energy, _fac, _weather, query
from helio.plans.sample import view
from helio.sources import nested, stored
from helio.sources.shared import cut

_FROM, _TO = "1994-06-01", "1996-03-15"
_KEPT = f"NOT CAST({{c}} AS DATE) BETWEEN DATE '{_FROM}' AND DATE '{_TO}'"


def _orders_by_year(spark: SparkSession, d: str, path: str) -> None:
    orders = view(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.year("o_orderdate").alias("o_year"))
    nested.append_table(orders, path, ["o_year"])


@query(f"SELECT o_orderkey, o_custkey, o_orderdate, year(o_orderdate) AS o_year FROM orders WHERE {_KEPT.format(c='o_orderdate')}")
def delete_range_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by year; those of a range of days are deleted from the table: one year goes, two are rewritten, the others stay."""
    path = _path(spark, "deleted")
    _orders_by_year(spark, sf_dir, path)
    stored.delete_stored(spark, path, upsert.date_range_condition(spark.read.parquet(path), _FROM, _TO), ["o_year"])
    return spark.read.parquet(path).withColumn("o_year", F.col("o_year").cast("long"))


_CUT = "count(*) FILTER (CAST({c} AS DATE) BETWEEN DATE '" + _FROM + "' AND DATE '" + _TO + "')"


@query(" UNION ALL ".join([
    f"SELECT '{n}' AS table_name, {_CUT.format(c=c)} AS planned, {_CUT.format(c=c)} AS deleted, count(*) - {_CUT.format(c=c)} AS remaining, false AS skipped FROM {n}" for n, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
] + ["SELECT 'nation', 0, 0, count(*), true FROM nation"]))
def purge_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run and a purge of three stored tables by a range of days; the one without a date column is left alone."""
    base = _path(spark, "purged")
    _orders_by_year(spark, sf_dir, f"{base}/orders")
    nested.append_table(view(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate"), f"{base}/lineitem")
    nested.overwrite_table(view(spark, sf_dir, "nation").select("n_nationkey", "n_name"), f"{base}/nation")
    tables = {"orders": (f"{base}/orders", ["o_year"]), "lineitem": (f"{base}/lineitem", []), "nation": (f"{base}/nation", [])}

    def days(df: DataFrame):
        if "n_nationkey" in df.columns:
            df = df.select("n_name")  # whole numbers would be taken for days
        return upsert.date_range_condition(df, _FROM, _TO, stored.PURGE_COLUMNS)

    planned = stored.purge(spark, tables, days, dry_run=True).select("table_name", F.col("deleted").alias("planned"))
    done = stored.purge(spark, tables, days).select("table_name", "deleted", "skipped")
    left = None
    for name, (path, _) in tables.items():
        one = spark.read.parquet(path).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("remaining"))
        left = one if left is None else left.unionAll(one)
    return planned.join(done, "table_name").join(left, "table_name").select("table_name", "planned", "deleted", "remaining", "skipped")


@query("SELECT CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS ship_month, count(*) AS n, true AS few_files FROM lineitem GROUP BY 1")
def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dealt over 64 tasks and written by ship month: each of the eighty months or so is in one file or two, not in 64."""
    path = _path(spark, "by-month")
    lines = view(spark, sf_dir, "lineitem").select("l_orderkey", F.date_format("l_shipdate", "yyyyMM").cast("int").alias("ship_month")).repartition(64)
    nested.append_table(lines, path, ["ship_month"])
    return spark.read.parquet(path).groupBy("ship_month").agg(F.count(F.lit(1)).alias("n"), (F.count_distinct("_metadata.file_path") <= 2).alias("few_files"))


@query("SELECT * FROM master")
def facility_master_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master from four loads of rows of any year, late ones among them: the same as from the history in its order."""
    history, path, master = view(spark, sf_dir, "facility_history"), _path(spark, "master"), None
    for load in range(4):
        rows = history.where(F.pmod(F.xxhash64("facility_code", "effective_from"), F.lit(4)) == load)
        nested.overwrite_table(silver.facility_master_spliced(master, rows), f"{path}/{load}")
        master = spark.read.parquet(f"{path}/{load}")
    return master.drop("seen")


@query("SELECT date_key, full_date, day_name, count(*) AS hours, round(CAST(sum(CAST(energy_mwh AS DECIMAL(18,6))) AS DOUBLE), 4) AS total_mwh, max(aqi_value) AS worst FROM fact JOIN (SELECT DISTINCT CAST(strftime(date_hour, '%Y%m%d') AS INTEGER) AS date_key, CAST(date_hour AS DATE) AS full_date, dayname(date_hour) AS day_name FROM energy WHERE isodow(date_hour) >= 6) USING (date_key) GROUP BY ALL")
def bi_weekends_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekends of the stored fact: the filter stands on the date dimension, and only the partitions of its days are read."""
    return weekends(*star_tables(spark, sf_dir, _path(spark, "star")))


def star_tables(spark: SparkSession, d: str, base: str) -> tuple[DataFrame, DataFrame]:
    """The typed fact, by date_key, and the date dimension, as stored."""
    energy = _energy(spark, d)
    fact = facts.fact_environmental(energy, _weather(spark, d), _air(spark, d), _fac(spark, d), dims.dim_aqi(spark))
    fact = silver.with_load_times(facts.typed(fact, facts.FACT_COLUMNS), F.lit("2024-06-01").cast("timestamp"))
    upsert.overwrite_partitions(fact, f"{base}/fact", "date_key")
    nested.overwrite_table(dims.dim_date((energy, "date_hour")), f"{base}/dim_date")
    return spark.read.parquet(f"{base}/fact"), spark.read.parquet(f"{base}/dim_date")


def weekends(fact: DataFrame, dates: DataFrame) -> DataFrame:
    star = fact.join(dates.where("day_of_week >= 6").select("date_key", "full_date", "day_name"), "date_key")
    return star.groupBy("date_key", "full_date", "day_name").agg(F.count(F.lit(1)).alias("hours"), F.round(F.sum("energy_mwh").cast("double"), 4).alias("total_mwh"), F.max("aqi_value").alias("worst"))


_BATCH = "SELECT o_orderkey + CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 100000000 END AS o_orderkey, o_custkey, 'X' AS o_orderstatus FROM orders WHERE o_orderkey % 50 < 2"


@query(f"SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_BATCH})) UNION ALL SELECT * FROM ({_BATCH})")
def upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders kept in buckets of their key; a small batch of changed and new ones is exchanged to the buckets, the table is not."""
    orders = view(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    table = stored.Bucketed(spark, _path(spark, "bucketed"), ["o_orderkey"], 16)
    table.write(orders)
    fresh = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).otherwise(F.col("o_orderkey") + 100_000_000)
    table.upsert(orders.where("o_orderkey % 50 < 2").select(fresh.alias("o_orderkey"), "o_custkey", F.lit("X").alias("o_orderstatus")))
    return table.read()


_PERCENTS = {"p5": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99}


@query("SELECT l_returnflag, count(*) AS n, CAST(min(l_extendedprice) AS DOUBLE) AS min_value, CAST(max(l_extendedprice) AS DOUBLE) AS max_value, count(DISTINCT l_orderkey) AS exact_keys, true AS keys_within FROM lineitem GROUP BY 1")
def sketch_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders of lines by flag from sketches stored by day, and whether they are within 5 % of the exact numbers."""
    daily, lines = _daily(spark, sf_dir)
    found = sketches.merged_sketches(daily, {}, ["l_returnflag"])
    exact = lines.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("exact_keys"))
    out = found.join(exact, "l_returnflag")
    return out.select("l_returnflag", "n", "min_value", "max_value", "exact_keys", (F.abs(F.col("distinct_keys") - F.col("exact_keys")) <= 0.05 * F.col("exact_keys")).alias("keys_within"))


@query(" UNION ALL ".join(f"SELECT '{p}' AS percentile, true AS within FROM (SELECT 1)" for p in _PERCENTS))
def sketch_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of line prices from sketches stored by day, and whether each is within 2 % of the rows of its place."""
    daily, lines = _daily(spark, sf_dir)
    errors = sketches.rank_errors(lines, "l_extendedprice", sketches.merged_sketches(daily, _PERCENTS), _PERCENTS)
    return errors.select("percentile", (F.col("rank_error") <= 0.02).alias("within"))


def _daily(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    path, lines = _path(spark, "sketches"), view(spark, d, "lineitem")
    nested.overwrite_table(sketches.daily_sketches(lines, "l_shipdate", "l_extendedprice", "l_orderkey", ["l_returnflag"]), path)
    return spark.read.parquet(path), lines


def layer_load(spark: SparkSession, raw: dict[str, DataFrame], base: str, now, hours: int = 13) -> None:
    """Bring the stored layers under ``base`` up to what ``raw`` holds: readings, weather, air and facilities.

    Each hourly table starts ``hours`` before its last hour (at the beginning without one), the weather at the start of that day, as gaps are
    filled from rows of the day before it; what comes of it is upserted by day. Keys of known facilities stay. The fact starts at the first day
    that any hourly table has loaded again or anew and its rows are upserted by date, with created_at kept and updated_at set to ``now``.
    Raw rows older than the lookback are not seen; a load of an empty table does nothing.
    """
    label = {"energy": F.date_trunc("hour", local_time(F.col("interval_ts"), F.lit(DEFAULT_ZONE)) + F.expr("INTERVAL 1 HOUR")), "weather": F.date_trunc("hour", "weather_timestamp"), "air": F.date_trunc("hour", "air_timestamp")}
    source = {"energy": "readings", "weather": "weather", "air": "air"}
    clean = {"energy": silver.hourly_energy, "weather": silver.hourly_weather, "air": silver.hourly_air_quality}
    keys = {"energy": ["facility_code", "facility_name", "network_code", "network_region", "date_hour"], "weather": ["facility_code", "date_hour"], "air": ["facility_code", "date_hour"]}
    starts, tables = [], {}
    for name in label:
        path, rows = f"{base}/{name}", raw[source[name]]
        known = nested.read_table(spark, path, ["date_hour"])
        start = None if known is None else watermarks.lookback(known, "date_hour", hours).first()["start_ts"]
        if start is not None:
            rows = rows.where(label[name] >= (F.date_trunc("day", F.lit(start)) if name == "weather" else F.lit(start)))
        fresh = clean[name](rows)
        fresh = (fresh if start is None else fresh.where(F.col("date_hour") >= F.lit(start))).withColumn("day", F.to_date("date_hour"))
        order = [F.col(c).asc_nulls_last() for c in fresh.columns if c not in keys[name]] if name != "energy" else None
        upsert.upsert_partitions(spark, path, fresh, keys[name], "day", order)
        starts.append(start)
        tables[name] = spark.read.parquet(path)
    known = nested.read_table(spark, f"{base}/dim_facility", ["facility_key"])
    facility = cut(dims.dim_facility(raw["facilities"], known))  # it reads the table that it replaces
    nested.overwrite_table(facility, f"{base}/dim_facility")
    if None not in starts:
        first = F.to_date(F.lit(min(starts)))
        tables = {name: df.where(F.col("day") >= first) for name, df in tables.items()}
    fact = facts.fact_environmental(tables["energy"], tables["weather"], tables["air"], facility, dims.dim_aqi(spark))
    fact = facts.typed(fact, facts.FACT_COLUMNS)
    known, grain = nested.read_table(spark, f"{base}/fact", ["date_key"]), ["facility_key", "date_key", "time_key"]
    if known is not None:
        fact = fact.join(known.select(*grain, "created_at"), grain, "left")
    upsert.upsert_partitions(spark, f"{base}/fact", silver.with_load_times(fact, now), grain, "date_key")


CTES["middle"] = "SELECT to_timestamp(CAST(floor((epoch(min(interval_ts)) + epoch(max(interval_ts))) / 2) AS BIGINT)) AT TIME ZONE 'UTC' AS middle FROM readings"
CTES["met"] = "SELECT facility_code, date_trunc('hour', interval_ts + INTERVAL 11 HOUR) AS date_hour, min(interval_ts) <= any_value(middle) AS before FROM readings CROSS JOIN middle WHERE metric = 'energy' AND value IS NOT NULL GROUP BY 1, 2"


@query("SELECT facility_key, date_key, time_key, aqi_category_key, CAST(energy_mwh AS DECIMAL(12,6)) AS energy_mwh, intervals_count, TRY_CAST(CAST(shortwave_radiation AS VARCHAR) AS DECIMAL(10,4)) AS shortwave_radiation, pm2_5, completeness_pct, quality_flag, CASE WHEN before THEN TIMESTAMP '2024-06-01 00:00:00' ELSE TIMESTAMP '2024-06-02 00:00:00' END AS created_at FROM fact JOIN met USING (facility_code, date_hour)")
def layer_run_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of all layers, the second from the watermarks of the first: the fact as from one load, with the time at which each row came."""
    base = _path(spark, "incremental")
    raw = {"readings": view(spark, sf_dir, "readings"), "weather": view(spark, sf_dir, "raw_weather"), "air": view(spark, sf_dir, "raw_air_quality"), "facilities": view(spark, sf_dir, "raw_facilities")}
    middle = F.lit(raw["readings"].agg(F.timestamp_seconds(F.floor((F.unix_timestamp(F.min("interval_ts")) + F.unix_timestamp(F.max("interval_ts"))) / 2))).first()[0])
    early = raw | {"readings": raw["readings"].where(F.col("interval_ts") <= middle), "weather": raw["weather"].where(F.col("weather_timestamp") <= middle), "air": raw["air"].where(F.col("air_timestamp") <= middle)}
    layer_load(spark, early, base, F.lit("2024-06-01").cast("timestamp"))
    layer_load(spark, raw, base, F.lit("2024-06-02").cast("timestamp"))
    return spark.read.parquet(f"{base}/fact").select("facility_key", "date_key", "time_key", "aqi_category_key", "energy_mwh", "intervals_count", "shortwave_radiation", "pm2_5", "completeness_pct", "quality_flag", "created_at")
