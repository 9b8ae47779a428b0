"""Cleaned hourly tables and the slowly changing facility master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helio.functions.scalars import DEFAULT_ZONE, aqi_from_pm25, aqi_label, by_code, clean_number, local_time, row_hash
from helio.operators.rules import AIR_BOUNDS, WEATHER_BOUNDS, air_rules, apply_rules, energy_rules, weather_rules


def with_columns_or_null(df: DataFrame, names, kind: str = "double") -> DataFrame:
    """Add what is missing as null columns."""
    return df.withColumns({c: F.lit(None).cast(kind) for c in names if c not in df.columns})


def hourly_energy(readings: DataFrame, zone: str = DEFAULT_ZONE, zones: dict[str, str] | None = None) -> DataFrame:
    """Energy by facility and local hour (labelled by its end), with quality rules. Sums are decimal, so their order does not matter.

    ``zones`` has the zones of facilities by code; the others are in ``zone``.
    """
    rows = readings.where("facility_code IS NOT NULL AND interval_ts IS NOT NULL AND metric = 'energy'").withColumn("value", clean_number(F.col("value")))
    hour = F.date_trunc("hour", local_time(F.col("interval_ts"), by_code(F.col("facility_code"), zones or {}, zone)) + F.expr("INTERVAL 1 HOUR"))
    out = (
        rows.groupBy("facility_code", "facility_name", "network_code", "network_region", hour.alias("date_hour"))
        .agg(F.sum(F.col("value").cast("decimal(18,6)")).cast("double").alias("energy_mwh"), F.count("value").alias("intervals_count"))
        .where("intervals_count > 0")
        .withColumn("completeness_pct", F.lit(100.0))
    )
    return apply_rules(out, energy_rules(F.hour("date_hour"), F.col("energy_mwh"))).drop("is_valid")


def forward_fill(df: DataFrame, column: str, keys: list[str], order: str, most_rows: int = 100) -> DataFrame:
    """Fill nulls with the last known value among the ``most_rows`` rows before with equal ``keys``."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(-most_rows, 0)
    return df.withColumn(column, F.coalesce(column, F.last(column, ignorenulls=True).over(before)))


def _clean(df: DataFrame, time_col: str, measures) -> DataFrame:
    rows = with_columns_or_null(df, measures).where(F.col("facility_code").isNotNull() & F.col(time_col).isNotNull())
    rows = rows.withColumns({c: F.round(clean_number(F.col(c)), 4) for c in measures})
    return rows.withColumns({"date_hour": F.date_trunc("hour", time_col), "date": F.to_date(time_col)})


def hourly_weather(raw: DataFrame) -> DataFrame:
    rows = forward_fill(_clean(raw, "weather_timestamp", WEATHER_BOUNDS), "total_column_integrated_water_vapour", ["facility_code", "date"], "weather_timestamp")
    return apply_rules(rows, weather_rules(F.hour("weather_timestamp"))).select("facility_code", "facility_name", "date_hour", "date", *WEATHER_BOUNDS, "is_valid", "quality_flag", "quality_issues")


def hourly_air_quality(raw: DataFrame) -> DataFrame:
    rows = _clean(raw, "air_timestamp", AIR_BOUNDS).withColumn("aqi_value", aqi_from_pm25(F.col("pm2_5"))).withColumn("aqi_category", aqi_label(F.col("aqi_value")))
    return apply_rules(rows, air_rules()).select("facility_code", "facility_name", "date_hour", "date", *AIR_BOUNDS, "aqi_value", "aqi_category", "is_valid", "quality_flag", "quality_issues")


def scd2(history: DataFrame, key: str, effective: str, attributes: list[str], tie: str) -> DataFrame:
    """Versions of each key: repeats without a change are dropped first, then each version ends where the next begins."""
    order = Window.partitionBy(key).orderBy(effective, tie)
    hashed = history.withColumn("row_hash", row_hash(attributes)).withColumn("_before", F.lag("row_hash").over(order))
    changed = hashed.where(F.col("_before").isNull() | (F.col("_before") != F.col("row_hash"))).withColumn("effective_to", F.lead(effective).over(order))
    return changed.withColumn("is_current", F.col("effective_to").isNull()).select(key, effective, "effective_to", *attributes, "row_hash", "is_current")


def splice(known: DataFrame | None, rows: DataFrame, key: str, effective: str, attributes: list[str]) -> DataFrame:
    """All versions of the keys in ``rows`` after rows of any date have come in: key, effective, effective_to, attributes, row_hash, is_current, seen.

    A version keeps in ``seen`` when its attributes were observed (its own date first). So a row that falls into a known version
    splits it where the next observation stands, one that says the same as a neighbour is joined to it, one before all opens
    the history: the versions are those of the whole history, in whatever order its rows have come. A row replaces what was observed at
    its very date; of two such rows in one load the one of lesser hash stays. Only the keys in ``rows`` are read
    from ``known``; a row without a date is left out.
    """
    columns = [key, effective, *attributes]
    fresh = rows.where(F.col(effective).isNotNull()).select(*columns, row_hash(attributes).alias("row_hash"), F.lit(1).alias("_load"))
    if known is not None:
        old = known.join(fresh.select(key).distinct(), key, "left_semi").drop(effective)
        fresh = old.select(key, F.explode("seen").alias(effective), *attributes, "row_hash", F.lit(0).alias("_load")).unionByName(fresh)
    in_time = Window.partitionBy(key).orderBy(effective)
    best = Window.partitionBy(key, effective).orderBy(F.desc("_load"), "row_hash")
    one = fresh.repartition(key).withColumn("_rn", F.row_number().over(best)).where("_rn = 1")
    starts = F.when(F.col("row_hash").eqNullSafe(F.lag("row_hash").over(in_time)), 0).otherwise(1)
    runs = one.withColumn("_start", starts).withColumn("_run", F.sum("_start").over(in_time))
    out = runs.groupBy(key, "_run").agg(F.min(effective).alias(effective), F.array_sort(F.collect_list(effective)).alias("seen"), *[F.first(c).alias(c) for c in (*attributes, "row_hash")])
    out = out.withColumn("effective_to", F.lead(effective).over(in_time))
    return out.select(key, effective, "effective_to", *attributes, "row_hash", F.col("effective_to").isNull().alias("is_current"), "seen")


def replace_keys(known: DataFrame | None, spliced: DataFrame, key: str) -> DataFrame:
    """The whole table after ``splice``: other keys as they were."""
    return spliced if known is None else known.join(spliced.select(key).distinct(), key, "left_anti").unionByName(spliced)


#: Decimal columns of the facility master, and the attributes whose change starts a new version.
MASTER_DECIMALS = {"location_lat": "decimal(10,6)", "location_lng": "decimal(10,6)", "total_capacity_mw": "decimal(10,4)", "total_capacity_registered_mw": "decimal(10,4)", "total_capacity_maximum_mw": "decimal(10,4)"}
MASTER_ATTRIBUTES = ["facility_name", "network_id", "network_region", "location_lat", "location_lng", "unit_count", "total_capacity_mw", "total_capacity_registered_mw", "total_capacity_maximum_mw", "unit_fueltech_summary", "unit_status_summary", "facility_description"]


def facility_master(raw: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Versions of facilities with validity: facility_code, effective_from and to, attributes, row_hash, is_current, is_valid, quality_flag.

    ``raw`` has an effective_from; columns that it lacks are null. The current versions of ``existing`` stand before
    the new rows, so an unchanged facility makes no new version; they come back with their end, to be upserted on
    (facility_code, effective_from).
    """
    columns = ["facility_code", "effective_from", *MASTER_ATTRIBUTES]
    rows = _master_rows(raw).select(*columns, F.lit(1).alias("_source"))
    if existing is not None:
        rows = existing.where("is_current").select(*columns, F.lit(0).alias("_source")).unionByName(rows)
    return _master_flags(scd2(rows, "facility_code", "effective_from", MASTER_ATTRIBUTES, "_source"))


def _master_rows(raw: DataFrame) -> DataFrame:
    rows = with_columns_or_null(raw.where("facility_code IS NOT NULL"), MASTER_DECIMALS, "double")
    rows = with_columns_or_null(rows, ["unit_count"], "int")
    rows = with_columns_or_null(rows, MASTER_ATTRIBUTES, "string")
    return rows.withColumns({c: F.col(c).try_cast(kind) for c, kind in MASTER_DECIMALS.items()})


def _master_flags(versions: DataFrame) -> DataFrame:
    return versions.withColumn("is_valid", F.coalesce(F.col("total_capacity_mw") > 0, F.lit(False))).withColumn("quality_flag", F.when(F.col("is_valid"), "GOOD").otherwise("CAPACITY_INVALID"))


def facility_master_spliced(known: DataFrame | None, raw: DataFrame) -> DataFrame:
    """The master after rows of any date have come in, late ones too: the columns of ``facility_master`` and ``seen`` (see ``splice``). ``known``: what this gave before."""
    late = splice(known, _master_rows(raw), "facility_code", "effective_from", MASTER_ATTRIBUTES)
    return replace_keys(known, _master_flags(late), "facility_code")


def with_load_times(df: DataFrame, now: Column) -> DataFrame:
    """created_at (kept where it is known) and updated_at."""
    created = F.coalesce("created_at", now) if "created_at" in df.columns else now
    return df.withColumn("created_at", created).withColumn("updated_at", now)


def ingested(df: DataFrame, mode: str, now: Column) -> DataFrame:
    """Columns that say how and when rows came in: ingest_mode, ingest_timestamp, ingest_date."""
    return df.withColumns({"ingest_mode": F.lit(mode), "ingest_timestamp": now, "ingest_date": F.to_date(now)})
