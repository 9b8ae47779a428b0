"""Sketches of distinct values and quantiles, kept by day and merged for any span."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_sketches(df: DataFrame, ts: str, value: str, key: str, group: list[str] = (), lg_k: int = 12, k: int = 400) -> DataFrame:  # type: ignore[assignment]
    """A row for each day and group: day, n, n_value, min_value, max_value, a sketch of distinct ``key`` (``lg_k``) and one of quantiles of ``value`` (``k``).

    One pass with partial aggregation; a day's sketches take a few KB whatever its rows. Nulls are in neither sketch.
    """
    v = F.col(value).cast("double")
    return df.groupBy(*group, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("n_value"), F.min(v).alias("min_value"), F.max(v).alias("max_value"),
        F.hll_sketch_agg(key, F.lit(lg_k)).alias("keys"), F.kll_sketch_agg_double(v, k).alias("quantiles"))


def merged_sketches(daily: DataFrame, percents: dict[str, float], group: list[str] = ()) -> DataFrame:  # type: ignore[assignment]
    """The profile of all days of ``daily`` by group, from its sketches alone: n, least and largest value, distinct keys, and each of ``percents``."""
    merged = daily.groupBy(*group).agg(F.sum("n").alias("n"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.sum("n_value").alias("_n"),
                                       F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("distinct_keys"), F.kll_merge_agg_double("quantiles").alias("_q"))
    at = {name: F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_q", F.lit(p))) for name, p in percents.items()}
    return merged.select(*group, "n", "min_value", "max_value", "distinct_keys", *[c.alias(name) for name, c in at.items()])


def rank_errors(df: DataFrame, value: str, profile: DataFrame, percents: dict[str, float]) -> DataFrame:
    """How far each percentile of ``profile`` (one row) is from its place among the rows of ``df``, as a share of them; 0 where rows of the very value reach over it."""
    v = F.col(value).cast("double")
    rows = df.select(v.alias("_v")).where("_v IS NOT NULL").crossJoin(F.broadcast(profile.select(*percents)))  # one row
    below = [x for name in percents for x in (F.count_if(F.col("_v") < F.col(name)).alias(f"{name}__lo"), F.count_if(F.col("_v") <= F.col(name)).alias(f"{name}__hi"))]
    counts = rows.agg(F.count(F.lit(1)).alias("_n"), *below)
    far = lambda name, p: F.greatest(F.col(f"{name}__lo") / F.col("_n") - p, p - F.col(f"{name}__hi") / F.col("_n"), F.lit(0.0))
    return counts.select(F.inline(F.array(*[F.struct(F.lit(name).alias("percentile"), far(name, p).alias("rank_error")) for name, p in percents.items()])))
