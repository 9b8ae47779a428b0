"""Ranks of a whole table without a window over one partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helio.sources.shared import cut


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with their rank from 1 by ``order``, which must tell all rows apart.

    Rows are dealt into ranges; each range counts its rows, the counts of the ranges before are added to the
    rank inside. The window over one partition sees a row for each range.
    """
    keys = [f"_o{i}" for i in range(len(order))]
    ranges = df.withColumns(dict(zip(keys, order, strict=True))).repartitionByRange(*[F.col(k).asc_nulls_last() for k in keys]).withColumn("_range", F.spark_partition_id())
    ranges = cut(ranges)  # a second drawing of ranges could differ
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = ranges.groupBy("_range").count().select("_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*[F.col(k).asc_nulls_last() for k in keys]))
    return ranges.withColumn("_in", inside).join(base, "_range").withColumn(name, F.col("_base") + F.col("_in")).drop("_range", "_base", "_in", *keys)


def numbered(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Rows with their number from 1 within their group by ``order``, nulls last; of equal ones at will. Null groups are groups.

    Rows are dealt into ranges by group and order, numbered within the part of a group that a range has, and moved on by
    the counts of the group's parts before. So a group may be as large as it likes; windows see a row for each part.
    """
    keys = [*[F.col(c).asc_nulls_first() for c in group], *[F.col(c).asc_nulls_last() for c in order]]
    ranges = cut(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    own = Window.partitionBy(*group, "_range").orderBy(*keys[len(group) :])
    parts = ranges.groupBy(*group, "_range").count()
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select(*[F.col(c).alias(f"_b{i}") for i, c in enumerate(group)], F.col("_range").alias("_r"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    on = F.col("_range") == F.col("_r")
    for i, c in enumerate(group):
        on &= F.col(c).eqNullSafe(F.col(f"_b{i}"))
    out = ranges.withColumn("_in", F.row_number().over(own)).join(base, on)
    return out.select(*df.columns, (F.col("_base") + F.col("_in")).alias(name))


def exact_quantiles(df: DataFrame, column: str, percents: dict[str, float], group: list[str] = ()) -> DataFrame:  # type: ignore[assignment]
    """One row per group (one row in all without): the group as _g0, _g1 and so on, and each of ``percents``, interpolated.

    Rows are counted per value, the values dealt into ranges, and the counts of the ranges before are added to
    those inside; so no task has more than a range of the distinct values. Nulls don't count.
    """
    by = [f"_g{i}" for i in range(len(group))]
    counts = df.select(*[F.col(g).alias(b) for g, b in zip(group, by, strict=True)], F.col(column).cast("double").alias("_v")).where("_v IS NOT NULL").groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranges = cut(counts.repartitionByRange(*by, "_v").withColumn("_range", F.spark_partition_id()))
    part = ranges.groupBy(*by, "_range").agg(F.sum("_c").alias("_n")).withColumnsRenamed({b: f"_b{b}" for b in by} | {"_range": "_r"})
    whole = Window.partitionBy(*[f"_b{b}" for b in by])
    before = whole.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    base = part.select(*[f"_b{b}" for b in by], "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"), F.sum("_n").over(whole).alias("_total"))
    on = F.col("_range") == F.col("_r")
    for b in by:
        on &= F.col(b).eqNullSafe(F.col(f"_b{b}"))
    inside = F.sum("_c").over(Window.partitionBy(*by, "_range").orderBy("_v"))
    placed = ranges.withColumn("_in", inside).join(base, on).withColumn("_end", F.col("_base") + F.col("_in"))

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("_end") - F.col("_c") <= place) & (place < F.col("_end")), F.col("_v")))

    picks, outs = [], []
    for name, p in percents.items():
        pos = (F.col("_total") - 1) * F.lit(p)
        picks += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}"), F.max(pos - F.floor(pos)).alias(f"_w_{name}")]
        lo, hi, w = (F.col(f"_{k}_{name}") for k in ("lo", "hi", "w"))
        outs.append(F.when(w == 0, lo).otherwise(lo * (1 - w) + hi * w).alias(name))
    return placed.groupBy(*by).agg(*picks).select(*by, *outs)


def with_quantiles(summary: DataFrame, quantiles: DataFrame, group: list[str]) -> DataFrame:
    """Rows of ``summary`` (a row per group) with their quantiles; a group without values has none."""
    if not group:
        return summary.crossJoin(F.broadcast(quantiles))
    on = F.lit(True)
    for i, g in enumerate(group):
        on &= summary[g].eqNullSafe(quantiles[f"_g{i}"])
    return summary.join(quantiles, on, "left").drop(*[f"_g{i}" for i in range(len(group))])
