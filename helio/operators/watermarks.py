"""Incremental windows of batch jobs: where a load starts, and predicates for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def next_hour(df: DataFrame, ts: str) -> DataFrame:
    """Start of the next load: the hour after the last one; null for an empty table."""
    return df.agg((F.max(ts) + F.expr("INTERVAL 1 HOUR")).alias("start_ts"))


def reload_day(df: DataFrame, ts: str, today: Column) -> DataFrame:
    """Start of the next load: the day of the last row, which is loaded again; for an empty table the day before ``today``."""
    return df.agg(F.coalesce(F.to_date(F.max(ts)), F.date_sub(today, 1)).alias("start_date"))


def check_window(start, end) -> None:
    """Raise unless the end is at or after the start."""
    if end < start:
        raise ValueError(f"end {end} is before start {start}")


def lookback(df: DataFrame, ts: str, hours: int, now: Column | None = None) -> DataFrame:
    """Start of the next load: ``hours`` before the last hour, or before the hour of ``now`` if the last one is later; null for an empty table."""
    last = F.date_trunc("hour", F.max(ts))
    if now is not None:
        last = F.when(last.isNotNull(), F.least(last, F.date_trunc("hour", now)))
    return df.agg((last - F.expr(f"INTERVAL {hours} HOURS")).alias("start_ts"))


def next_day(df: DataFrame, day: str, today: Column) -> DataFrame:
    """Start of the next load of a table kept by day: the day after the last one, ``today`` at the latest; null for an empty table."""
    last = F.max(day)
    return df.agg(F.when(last.isNotNull(), F.least(F.date_add(last, 1), today)).alias("start_date"))


def first_load(df: DataFrame, ts: str, asked: Column | None = None) -> DataFrame:
    """Start of the first load: the earliest row, also when a later start is asked for."""
    least = F.min(ts)
    return df.agg((least if asked is None else F.least(least, asked)).alias("start_ts"))


def gold_start(fact: DataFrame, sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """start_ts and start_key: the last loaded day (loaded again), else what follows the least of the sources' last times: the next hour, or the next day for dates."""
    lasts = None
    for df, ts in sources.values():
        step = F.date_add(F.max(ts), 1).cast("timestamp") if dict(df.dtypes)[ts] == "date" else F.max(ts) + F.expr("INTERVAL 1 HOUR")
        one = df.agg(step.alias("t"))
        lasts = one if lasts is None else lasts.unionAll(one)
    last = fact.agg(F.max("date_key").alias("k"))
    both = last.crossJoin(lasts.agg(F.min("t").alias("t")))  # one row each
    start = F.coalesce(F.to_timestamp(F.col("k").cast("string"), "yyyyMMdd"), "t")
    return both.select(start.alias("start_ts"), F.date_format(start, "yyyyMMdd").cast("int").alias("start_key"))


def within(ts: str, start, end) -> Column:
    return F.col(ts).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))


def drop_future(df: DataFrame, ts: str, now: Column) -> DataFrame:
    return df.where(F.col(ts).isNotNull() & (F.col(ts) <= now))
