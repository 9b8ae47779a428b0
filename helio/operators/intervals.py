"""Lookups in ranges of any number, which may overlap, by equality joins down a search tree."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helio.operators.ranks import global_rank
from helio.sources.shared import cut

#: Entries of a node, and up to how many nodes a level of the tree is small enough to be broadcast.
FAN, FEW = 32, 1024


def _needed(rows: DataFrame) -> DataFrame:
    """Ranges that are the answer for some value: all but those inside one that goes before them by ``_lo``, then ``_hi``.

    Rows are dealt into ranges in that order; the highest end before a row is the one inside its range or that of the ranges before. The
    window over one partition sees a row for each range.
    """
    dealt = cut(rows.repartitionByRange("_lo", "_hi").withColumn("_range", F.spark_partition_id()))  # a second drawing could differ
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("_range").agg(F.max("_hi").alias("_top")).select("_range", F.max("_top").over(ahead(Window.orderBy("_range"))).alias("_base"))
    inside = F.max("_hi").over(ahead(Window.partitionBy("_range").orderBy("_lo", "_hi")))
    return dealt.withColumn("_in", inside).join(base, "_range").where("coalesce(_hi > greatest(_in, _base), true)").select("_hi", "_best")


def interval_lookup(fact: DataFrame, value: str, ranges: DataFrame, low: str, high: str, take: list[str], how: str = "left") -> DataFrame:
    """Each fact row with ``take`` of a range that holds its value, ends included: of several the one of least low, then high, then ``take``.

    Ranges inside one that goes before them are no value's answer. Without these, ends rise with the order, so the only candidate is the
    first range that ends at the value or behind it. It is found down a tree whose nodes have ``FAN`` entries in order of their
    ends, by one equality join a level (of a million ranges, four); so a fact row is compared with some tens of ranges however many
    overlap, stays one row, and a crowded node of the fact can be split. Null values and ranges without a low or high match nothing; with
    ``how`` inner, rows without a range go.
    """
    rows = ranges.select(F.col(low).cast("double").alias("_lo"), F.col(high).cast("double").alias("_hi"), *take).where("_lo <= _hi AND NOT isnan(_lo) AND NOT isnan(_hi)")
    best = rows.groupBy("_lo", "_hi").agg(F.min(F.struct("_lo", "_hi", *take)).alias("_best"))
    level = global_rank(_needed(best), [F.col("_hi")], "_rank").select((F.col("_rank") - 1).alias("_at"), "_hi", "_best")
    n, levels = level.count(), []
    while n > 1 or not levels:  # leaves first, the root last; an empty root still gives nulls
        n = -(-n // FAN)
        entry = F.struct("_hi", "_best") if not levels else F.struct("_hi")
        level = level.groupBy(F.floor(F.col("_at") / FAN).alias("_node")).agg(F.array_sort(F.collect_list(entry)).alias("_entries"), F.max("_hi").alias("_hi"))
        side = level.select(F.col("_node").alias("_iv_at"), F.col("_entries").alias("_iv_entries"))
        levels.append(F.broadcast(side) if n <= FEW else side)
        level = level.select(F.col("_node").alias("_at"), "_hi")
    out = fact.withColumn("_iv_value", F.col(value).cast("double"))  # names that a fact's own columns don't have
    out = out.withColumn("_iv_node", F.when(F.col("_iv_value").isNotNull(), F.lit(0).cast("long")))
    for side in levels[:0:-1]:
        out = out.join(side, F.col("_iv_node") == F.col("_iv_at"), "left")
        passed = F.size(F.filter("_iv_entries", lambda x: x["_hi"] < F.col("_iv_value")))
        node = F.when(passed < F.size("_iv_entries"), F.col("_iv_node") * FAN + passed)  # null behind the last range
        out = out.withColumn("_iv_node", node).drop("_iv_at", "_iv_entries")
    out = out.join(levels[0], F.col("_iv_node") == F.col("_iv_at"), "left")
    first = F.get(F.filter("_iv_entries", lambda x: x["_hi"] >= F.col("_iv_value")), F.lit(0))["_best"]
    out = out.withColumn("_iv_first", first).withColumn("_iv_best", F.when(F.col("_iv_first._lo") <= F.col("_iv_value"), F.col("_iv_first")))
    out = out.where("_iv_best IS NOT NULL") if how == "inner" else out
    return out.select(*fact.columns, *[F.col(f"_iv_best.{c}").alias(c) for c in take])
