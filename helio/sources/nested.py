"""Tables and nested payloads in, files out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.sources.stored import write_partitioned

SERIES = "data array<struct<network_code:string, metric:string, interval:string, unit:string, results:array<struct<columns:struct<unit_code:string, facility_code:string>, data:array<array<string>>>>>>"


def read_table(spark: SparkSession, path: str, required: list[str]) -> DataFrame | None:
    """A table that has the required columns; None if it does not exist."""
    try:
        df = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    return df


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").schema(schema).csv(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def flatten_series(payloads: DataFrame, units: DataFrame) -> DataFrame:
    """Points of series payloads: facility from the columns, else by unit (unit_code, facility_code); malformed points are left out."""
    rows = payloads.select(F.explode("data").alias("s")).select("s.*").select("network_code", "metric", "interval", F.col("unit").alias("value_unit"), F.explode("results").alias("r"))
    points = rows.select("network_code", "metric", "interval", "value_unit", F.col("r.columns.unit_code").alias("unit_code"), F.col("r.columns.facility_code").alias("_own"), F.explode("r.data").alias("p"))
    points = points.where(F.size("p") >= 2).withColumn("interval_start", F.try_to_timestamp(F.get("p", F.lit(0)))).where("interval_start IS NOT NULL")
    named = points.join(units.select("unit_code", F.col("facility_code").alias("_by_unit")), "unit_code", "left")
    return named.select("network_code", F.coalesce("_own", "_by_unit").alias("facility_code"), "unit_code", "metric", "interval", "value_unit", "interval_start", F.get("p", F.lit(1)).try_cast("double").alias("value"))


#: Columns of a unit that a payload may have.
UNIT = "code string, status_id string, fueltech_id string, dispatch_type string, capacity_mw double, capacity double, capacity_registered double, registered_capacity double, capacity_maximum double, capacity_storage double"


def typed_times(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """For each (new name, text column) a timestamp <name>_ts and a date <name>_date; unreadable text is null."""
    return df.withColumns({k: v for name, c in names.items() for k, v in ((f"{name}_ts", F.try_to_timestamp(c)), (f"{name}_date", F.to_date(F.try_to_timestamp(c))))})


def facility_summary(facilities: DataFrame) -> DataFrame:
    """Plants with nested units (any columns of UNIT): count, capacities, ``kind:count`` lists and unit codes in their order. Nothing is exploded.

    A unit's capacity is the first of four that is neither null nor 0. Sums of 0 and empty lists are null; sums
    are rounded to three places.
    """
    have = {f.name for f in facilities.schema["units"].dataType.elementType.fields}
    number = lambda u, c: F.nullif(u[c].try_cast("double"), F.lit(0.0)) if c in have else F.lit(None).cast("double")

    def total(*names: str) -> Column:
        one = lambda u: F.coalesce(*[F.when(~F.isnan(number(u, c)), number(u, c)) for c in names], F.lit(0.0))
        return F.round(F.nullif(F.aggregate("units", F.lit(0.0), lambda a, u: a + one(u)), F.lit(0.0)), 3)

    def counts(name: str, case) -> Column:
        if name not in have:
            return F.lit(None).cast("string")
        kinds = F.filter(F.transform("units", lambda u: case(u[name])), lambda k: F.coalesce(k != "", F.lit(False)))
        parts = F.transform(F.array_sort(F.array_distinct(kinds)), lambda k: F.concat(k, F.lit(":"), F.size(F.filter(kinds, lambda x: x == k)).cast("string")))
        return F.nullif(F.array_join(parts, "; "), F.lit(""))

    codes = F.filter(F.transform("units", lambda u: u["code"]), lambda c: F.coalesce(c != "", F.lit(False)))
    return facilities.select(
        "code", "name", F.coalesce(F.size("units"), F.lit(0)).alias("unit_count"),
        total("capacity_mw", "capacity", "capacity_registered", "registered_capacity").alias("total_capacity_mw"),
        total("capacity_registered", "registered_capacity").alias("total_capacity_registered_mw"), total("capacity_maximum").alias("total_capacity_maximum_mw"),
        total("capacity_storage").alias("total_capacity_storage_mwh"), counts("fueltech_id", F.lower).alias("unit_fueltech_summary"),
        counts("status_id", F.lower).alias("unit_status_summary"), counts("dispatch_type", F.upper).alias("unit_dispatch_summary"),
        F.nullif(F.array_join(codes, ","), F.lit("")).alias("unit_codes"),
    )


def select_facilities(facilities: DataFrame, codes: list[str] | None = None, networks: list[str] | None = None, statuses: list[str] | None = None, fueltechs: list[str] | None = None, region: str | None = "ALL") -> DataFrame:
    """Plants by code, network, region, and a unit of wanted status and fuel (any case); ordered by network, region and name, nulls last. Nothing given: no filter."""
    out = facilities
    for c, wanted in (("code", codes), ("network_id", networks)):
        if wanted:
            out = out.where(F.upper(c).isin(*[x.upper() for x in wanted]))
    if region and region.strip().upper() != "ALL":
        out = out.where(F.col("network_region") == region.strip())
    units = [(c, [x.lower() for x in wanted]) for c, wanted in (("status_id", statuses), ("fueltech_id", fueltechs)) if wanted]
    if units:
        def fits(u):
            ok = F.lit(True)
            for c, wanted in units:
                ok &= F.lower(u[c]).isin(*wanted)
            return F.coalesce(ok, F.lit(False))

        out = out.where(F.exists("units", fits))
    return out.orderBy(F.asc_nulls_last("network_id"), F.asc_nulls_last("network_region"), F.asc_nulls_last("name"), "code")


def locations(facilities: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """Code, name (else the code), latitude and longitude of plants that have both."""
    out = facilities.where("location_lat IS NOT NULL AND location_lng IS NOT NULL")
    if codes:
        out = out.where(F.upper("facility_code").isin(*[c.upper() for c in codes]))
    return out.select(F.col("facility_code").alias("code"), F.coalesce(F.nullif("facility_name", F.lit("")), "facility_code").alias("name"), F.col("location_lat").cast("double").alias("latitude"), F.col("location_lng").cast("double").alias("longitude"))


def hourly_arrays(payloads: DataFrame, measures: list[str], places: list[str] = ("facility_code", "facility_name", "latitude", "longitude")) -> DataFrame:  # type: ignore[assignment]
    """Columnar hourly arrays to rows: the columns ``places`` in front, date, measures."""
    return payloads.select(*places, F.inline(F.arrays_zip(*[F.col(f"hourly.{c}").alias(c) for c in ("time", *measures)]))).withColumnRenamed("time", "date")


def snapshot_day(start=None, end=None, today: dt.date | None = None) -> str:
    """The day of a load: that of its end, else of its start, else today."""
    day = end or start or today or dt.date.today()
    return (day.date() if isinstance(day, dt.datetime) else day).isoformat()


def write_snapshot(df: DataFrame, base: str, day: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(f"{base}/load_date={day}")


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a table of master data as a whole."""
    df.write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str, partition: list[str] = (), most_rows: int = 5_000_000) -> None:  # type: ignore[assignment]
    """Add rows to a table, which is created when missing; rows of one partition value come together first."""
    write_partitioned(df, path, list(partition), "append", most_rows)


def export_csv(tables: dict[str, DataFrame], base: str) -> list[str]:
    """Write each table that has rows as CSV with a header; the names written."""
    done = []
    for name, df in tables.items():
        if not df.isEmpty():
            df.write.mode("overwrite").option("header", True).csv(f"{base}/{name}")
            done.append(name)
    return done


def create_empty(spark: SparkSession, path: str, schema: str) -> bool:
    """Create an empty table unless it exists; whether it was created."""
    try:
        spark.read.parquet(path)
        return False
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        return True
