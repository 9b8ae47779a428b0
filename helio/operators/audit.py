"""Audits and profiles; several figures of a table come from one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helio.operators.ranks import exact_quantiles, with_quantiles


PERCENTS = (0.01, 0.05, 0.1, 0.5, 0.9, 0.95, 0.99)


def _stack(one_row: DataFrame, columns: list[str], figures: list[str]) -> DataFrame:
    """From one row with <column>__<figure> fields to one row per column."""
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{f}").alias(f) for f in figures]) for c in columns])
    return one_row.select(F.inline(rows))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()])


def duplicate_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    one = lambda name, df, keys: df.groupBy(*keys).count().agg(F.lit(name).alias("table_name"), F.max("count").alias("max_rows_per_key"), F.count_if(F.col("count") > 1).alias("duplicate_keys"))
    return reduce(DataFrame.unionAll, [one(n, df, k) for n, (df, k) in tables.items()])


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    aggs = [x for c in columns for x in (F.count_if(F.col(c).isNull()).alias(f"{c}__null_count"), F.round(F.try_divide(F.count_if(F.col(c).isNull()) * 100.0, F.count(F.lit(1))), 2).alias(f"{c}__null_pct"))]
    return _stack(df.agg(*aggs), columns, ["null_count", "null_pct"])


def bounds_profile(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    aggs = []
    for c, (lo, hi) in bounds.items():
        out = F.count_if(~F.col(c).between(lo, hi))
        aggs += [out.alias(f"{c}__out_count"), F.round(F.try_divide(out * 100.0, F.count(c)), 2).alias(f"{c}__out_pct"), F.min(c).alias(f"{c}__min_value"), F.max(c).alias(f"{c}__max_value")]
    return _stack(df.agg(*aggs), list(bounds), ["out_count", "out_pct", "min_value", "max_value"])


def quality_summary(df: DataFrame, group: str) -> DataFrame:
    flag = lambda f: F.count_if(F.col("quality_flag") == f).alias(f.lower())
    return df.groupBy(group).agg(flag("GOOD"), flag("WARNING"), flag("BAD"), F.round(F.try_divide(F.sum(F.col("completeness_pct").cast("decimal(18,6)")).cast("double"), F.count("completeness_pct")), 4).alias("avg_completeness"), F.min("date_hour").alias("first_hour"), F.max("date_hour").alias("last_hour"))


def orphan_keys(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Fact rows whose key (not null) has no row in the dimension, by key: the fact is read once and meets each dimension's distinct keys."""
    rows = fact.select(*dims)
    for key, (dim, col) in dims.items():
        known = dim.select(F.col(col).alias(f"_{key}")).where(F.col(col).isNotNull()).distinct()
        rows = rows.join(known, F.col(key) == F.col(f"_{key}"), "left")
    one = rows.agg(*[F.count_if(F.col(k).isNotNull() & F.col(f"_{k}").isNull()).alias(f"{k}__orphans") for k in dims])
    return _stack(one, list(dims), ["orphans"]).withColumnRenamed("column_name", "key_name")


def distribution(df: DataFrame, column: str, group: list[str], percents=PERCENTS, exact: bool = False) -> DataFrame:
    """Count, least, mean, deviation, most and percentiles. ``exact`` ranks values over ranges; the default is the sketch, in one pass."""
    names = {f"p{round(p * 100)}": p for p in percents}
    mean = F.try_divide(F.sum(F.col(column).cast("decimal(18,6)")).cast("double"), F.count(column))
    figures = [F.count(column).alias("n"), F.min(column).alias("min_value"), F.round(mean, 4).alias("avg_value"), F.round(F.stddev_samp(column), 2).alias("std_value"), F.max(column).alias("max_value")]
    if not exact:
        return df.groupBy(*group).agg(*figures, *[F.round(F.percentile_approx(column, F.lit(p)), 4).alias(n) for n, p in names.items()])
    out = with_quantiles(df.groupBy(*group).agg(*figures), exact_quantiles(df, column, names, group), group)
    return out.withColumns({n: F.round(n, 4) for n in names})


def anomaly_shares(energy: DataFrame) -> DataFrame:
    """Shares with their own denominators: night energy, daytime zero, low peak against half of the peak mean."""
    h, e = F.hour("date_hour"), F.col("energy_mwh")
    rows = energy.withColumns({"_night": (h >= 22) | (h < 6), "_day": h.between(8, 17), "_peak": h.between(10, 14)})
    mean = rows.where("_peak").agg(F.try_divide(F.sum(e.cast("decimal(18,6)")).cast("double"), F.count(e)).alias("_mean"))
    pct = lambda cond, base: F.round(F.try_divide(F.count_if(base & cond) * 100.0, F.count_if(base)), 4)
    return rows.join(F.broadcast(mean)).agg(pct(e > 1, F.col("_night")).alias("night_pct"), pct(e == 0, F.col("_day")).alias("zero_pct"), pct(e < F.col("_mean") / 2, F.col("_peak")).alias("low_peak_pct"))


def table_profile(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Rows, distinct keys and first and last time of each (table, key column, time column)."""
    one = lambda name, df, key, ts: df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("keys"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    return reduce(DataFrame.unionAll, [one(n, *t) for n, t in tables.items()])


def filtered_counts(energy: DataFrame) -> DataFrame:
    """Negative energy, night energy over 1 and daytime zeros, in one pass."""
    h, e = F.hour("date_hour"), F.col("energy_mwh")
    return energy.agg(F.count(F.lit(1)).alias("total"), F.count_if(e < 0).alias("negative"), F.count_if(((h >= 22) | (h < 6)) & (e > 1)).alias("night_over_1"), F.count_if(h.between(8, 17) & (e == 0)).alias("daytime_zero"))


def peak_share(df: DataFrame, column: str, ts: str) -> DataFrame:
    """Mean by hour of day, and its share of the largest such mean; the window is over 24 rows."""
    mean = F.try_divide(F.sum(F.col(column).cast("decimal(18,6)")).cast("double"), F.count(column))
    hours = df.groupBy(F.hour(ts).alias("hour_of_day")).agg(mean.alias("avg_value"))
    share = F.try_divide(F.col("avg_value") * 100, F.max("avg_value").over(Window.partitionBy(F.lit(1))))
    return hours.select("hour_of_day", F.round("avg_value", 4).alias("avg_value"), F.round(share, 4).alias("peak_pct"))


def peak_reference(df: DataFrame, column: str, ts: str, exact: bool = False) -> DataFrame:
    """Most, 95th and 99th percentile and mean of a column from 10 to 14 o'clock."""
    rows = df.where(F.hour(ts).between(10, 14))
    return distribution(rows, column, [], (0.95, 0.99), exact).select("max_value", "p95", "p99", "avg_value")


def describe(df: DataFrame, columns: list[str], percents=(0.25, 0.5, 0.75, 0.95, 0.99), exact: bool = False) -> DataFrame:
    """Distribution of each of several columns, as rows (column_name, n, least, mean, deviation, most, percentiles). The columns are unpivoted, so it is one pass over the table."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column_name", "value")
    return distribution(long, "value", ["column_name"], percents, exact)


def bounds_study(tables: list[tuple[DataFrame, dict[str, tuple[float, float]]]], exact: bool = False) -> DataFrame:
    """``describe`` with 1 to 99 % of the measures of several tables, with the bounds in force and how much room there is on either side of them."""
    parts = []
    for df, bounds in tables:
        limits = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for c, (lo, hi) in bounds.items()])
        mine = lambda f: F.filter(limits, lambda x: x["c"] == F.col("column_name"))[0][f]
        parts.append(describe(df, list(bounds), (0.01, 0.05, 0.5, 0.95, 0.99), exact).withColumns({"bound_low": mine("lo"), "bound_high": mine("hi")}))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumns({"room_low": F.round(F.col("min_value") - F.col("bound_low"), 4), "room_high": F.round(F.col("bound_high") - F.col("max_value"), 4)})


def span(df: DataFrame, key: str, day: str) -> DataFrame:
    """Distinct keys, and first and last day."""
    return df.agg(F.count_distinct(key).alias("keys"), F.min(F.to_date(day)).alias("first_day"), F.max(F.to_date(day)).alias("last_day"))
