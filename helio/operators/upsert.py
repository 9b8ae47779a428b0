"""Keyed upserts, dedup, partition overwrite and range deletes over plain files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helio.sources.shared import cut
from helio.sources.stored import drop_partitions, write_partitioned


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``. Give a full order: ties are otherwise broken at will."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def upsert(target: DataFrame | None, source: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """The target with rows of equal keys replaced and new keys added; the source is deduplicated by ``order``. No target: the source."""
    source = latest_per_key(source, keys, order) if order else source
    if target is None:
        return source
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source, allowMissingColumns=True)


def wide_keys(columns: list[str]) -> list[str]:
    """Key of an hourly table, from its columns: the facility and its weather time, else its air time, else its date."""
    times = [c for c in ("weather_timestamp", "air_timestamp", "date") if c in columns]
    if not times:
        raise ValueError("no time column to merge on")
    return ["facility_code", times[0]]


def upsert_listed(target: DataFrame | None, source: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Upsert that sets only ``columns`` (and keys): other columns of rows that exist stay, those of new rows are null.

    Without ``keys`` they come from the source's schema. The source has each key once. One shuffle of either side.
    """
    keys = keys or wide_keys(source.columns)
    rows = source.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_s_{c}") for c in columns if c not in keys], F.lit(True).alias("_new"))
    if target is None:
        return source.select(*keys, *[c for c in columns if c not in keys])
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    both = target.join(rows, on, "full_outer")
    out = [F.coalesce(c, f"_k_{c}").alias(c) if c in keys else F.when(F.col("_new"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns]
    return both.select(*out)


def backfill(source: DataFrame, path: str, keys: list[str], order: list[Column]) -> None:
    """Overwrite a whole table with the latest row of each key."""
    latest_per_key(source, keys, order).write.mode("overwrite").parquet(path)


def upsert_partitions(spark, path: str, source: DataFrame, keys: list[str], partition: str, order: list[Column] | None = None) -> None:
    """Upsert into a partitioned Parquet table, through a checkpoint. Only partitions that hold a key of the source, or will, are rewritten; so a key that moves leaves its old one, and a partition that it leaves empty goes.

    Partition values, one row for each folder that is touched, are broadcast: an exchange by them would bring each partition into one task.
    """
    try:
        target = spark.read.parquet(path)
    except Exception as e:  # no table yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        target = None
    if target is not None:
        held = target.join(source.select(*keys), keys, "left_semi").select(partition).distinct()
        touched = cut(held.unionByName(source.select(partition)).distinct())
        target = target.join(F.broadcast(touched), target[partition].eqNullSafe(touched[partition]), "left_semi")
    merged = cut(upsert(target, source, keys, order))
    overwrite_partitions(merged, path, partition)
    if target is not None:
        filled = merged.select(F.col(partition).alias("_filled")).distinct()
        drop_partitions(spark, path, touched.join(F.broadcast(filled), F.col(partition).eqNullSafe(F.col("_filled")), "left_anti"), partition)


def overwrite_partitions(df: DataFrame, path: str, partition: str, most_rows: int = 5_000_000) -> None:
    """Replace the partitions that ``df`` has rows of; the others stay."""
    write_partitioned(df, path, [partition], "overwrite", most_rows, dynamic=True)


def date_range_condition(df: DataFrame, start: str, end: str, preferred: tuple[str, ...] = ("date_hour", "interval_ts", "date_key", "date")) -> Column:
    """Predicate on the best date column: by preference, else the first timestamp or date column; whole numbers are YYYYMMDD."""
    kinds = dict(df.dtypes)
    names = [c for c in preferred if c in kinds] or [c for c, k in df.dtypes if k.startswith("timestamp") or k == "date"]
    if not names:
        raise ValueError("no date column")
    c, kind = F.col(names[0]), kinds[names[0]]
    if kind in ("int", "bigint"):
        return c.between(int(start.replace("-", "")), int(end.replace("-", "")))
    day = c.cast("date") if kind.startswith("timestamp") or kind == "date" else F.expr(f"try_to_date(`{names[0]}`)")
    return day.between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def delete_range(df: DataFrame, start: str, end: str, **kw) -> DataFrame:
    """What stays; rows whose date is unknown stay."""
    return df.where(~F.coalesce(date_range_condition(df, start, end, **kw), F.lit(False)))


def delete_preview(tables: dict[str, DataFrame], start: str, end: str, **kw) -> DataFrame:
    """Rows to be deleted by table."""
    out = None
    for name, df in tables.items():
        n = df.agg(F.lit(name).alias("table_name"), F.count_if(date_range_condition(df, start, end, **kw)).alias("affected"))
        out = n if out is None else out.unionAll(n)
    return out
