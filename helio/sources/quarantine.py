"""Input that may be broken: what can be read is kept, the rest is set aside with its reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helio.sources.stored import write_partitioned

_RAW = "_raw_record"


def read_checked(spark: SparkSession, path: str, schema: str, kind: str = "json", rules: dict[str, Column] | None = None, options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of a JSON or CSV file that have the schema and keep ``rules`` (reason: a condition that must not hold), and the others.

    The others have raw (the record as it stands, where the reader can't take it apart), fields (what was read, as JSON), reason and
    file. A row goes by its first reason: ``unreadable`` before the rules in their order. No row is in both or in neither.
    """
    reader = spark.read.schema(f"{schema}, {_RAW} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RAW)
    if kind == "csv":
        reader = reader.option("header", True).option("enforceSchema", False).option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
    rows = reader.options(**(options or {})).format(kind).load(path)
    columns = [c for c in rows.columns if c != _RAW]
    reason = F.when(F.col(_RAW).isNotNull(), "unreadable")
    for name, broken in (rules or {}).items():
        reason = reason.when(F.coalesce(broken, F.lit(False)), name)
    marked = rows.select("*", reason.alias("_reason"), F.col("_metadata.file_path").alias("_file"))
    aside = marked.where("_reason IS NOT NULL").select(F.col(_RAW).alias("raw"), F.to_json(F.struct(*columns)).alias("fields"), F.col("_reason").alias("reason"), F.col("_file").alias("file"))
    return marked.where("_reason IS NULL").select(*columns), aside


def store_quarantine(aside: DataFrame, path: str, source: str, day: Column) -> None:
    """Add rows set aside to the quarantine table, by source and day."""
    write_partitioned(aside.withColumns({"source": F.lit(source), "quarantine_date": day}), path, ["source", "quarantine_date"])


def quarantine_counts(table: DataFrame) -> DataFrame:
    """Rows set aside by source, day and reason."""
    return table.groupBy("source", "quarantine_date", "reason").agg(F.count(F.lit(1)).alias("n"))


def points_checked(payloads: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points of series payloads (see ``flatten_series``) and those that can't be used: too short, without a time, or of a time or value that can't be read.

    A point whose value is null is kept, as is one whose facility is unknown. Points set aside have network_code, metric, unit_code, the
    point as text and its reason.
    """
    rows = payloads.select(F.explode("data").alias("s")).select("s.*").select("network_code", "metric", "interval", F.col("unit").alias("value_unit"), F.explode("results").alias("r"))
    each = rows.select("network_code", "metric", "interval", "value_unit", F.col("r.columns.unit_code").alias("unit_code"), F.col("r.columns.facility_code").alias("_own"), F.explode("r.data").alias("p"))
    time, value = F.get("p", F.lit(0)), F.get("p", F.lit(1))
    each = each.withColumns({"interval_start": F.try_to_timestamp(time), "value": value.try_cast("double")})
    reason = F.when(F.col("p").isNull() | (F.size("p") < 2), "too short").when(time.isNull(), "no time").when(F.col("interval_start").isNull(), "bad time").when(value.isNotNull() & F.col("value").isNull(), "bad value")
    each = each.withColumn("reason", reason)
    named = each.where("reason IS NULL").join(units.select("unit_code", F.col("facility_code").alias("_by_unit")), "unit_code", "left")
    good = named.select("network_code", F.coalesce("_own", "_by_unit").alias("facility_code"), "unit_code", "metric", "interval", "value_unit", "interval_start", "value")
    return good, each.where("reason IS NOT NULL").select("network_code", "metric", "unit_code", F.to_json(F.struct("p")).alias("point"), "reason")
