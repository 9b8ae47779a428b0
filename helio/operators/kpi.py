"""Performance ratio, filter studies and plant figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def performance_ratio() -> Column:
    """Energy over what the irradiance allows, in percent."""
    total = lambda c, kind: F.sum(F.col(c).cast(kind)).cast("double")
    return F.round(F.try_divide(total("energy_mwh", "decimal(18,6)") * 1000, total("yr_weighted_kwh", "decimal(24,6)")) * 100, 4)


def base_rows(fact: DataFrame) -> DataFrame:
    return fact.where("energy_mwh > 0 AND yr_weighted_kwh > 0")


def pr_by_facility(fact: DataFrame) -> DataFrame:
    return base_rows(fact).groupBy("facility_code").agg(F.count(F.lit(1)).alias("n"), performance_ratio().alias("pr_pct"))


def pr_exclusion(fact: DataFrame, limit: float = 100.0) -> DataFrame:
    """Rows kept when facilities with a ratio over ``limit`` are left out; facilities are summed once, then added up."""
    each = pr_by_facility(fact)
    n = F.coalesce(F.sum("n"), F.lit(0))
    over = F.coalesce(F.sum(F.when(F.col("pr_pct") > limit, F.col("n"))), F.lit(0))
    return each.agg(n.alias("n"), over.alias("excluded"), F.round(F.try_divide((n - over) * 100.0, n), 4).alias("retention_pct"))


def pr_compliance(fact: DataFrame, least_pr: float = 60.0, least_retention: float = 70.0) -> DataFrame:
    """Ratio and retention of each facility against their limits, in one pass."""
    out = _by_filter(fact, {"base": "energy_mwh > 0 AND yr_weighted_kwh > 0"}).withColumn("retention_pct", F.round(F.col("n0") * 100.0 / F.col("total"), 4))
    low, few = ~F.coalesce(F.col("pr0") > least_pr, F.lit(False)), F.col("retention_pct") < least_retention
    return out.select("facility_code", F.col("pr0").alias("pr_pct"), "retention_pct", (~low & ~few).alias("compliant"), F.concat_ws("; ", F.when(low, "PR too low"), F.when(few, "retention too low")).alias("reason"))


def pr_sensitivity(fact: DataFrame, spark: SparkSession, thresholds=(0.02, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5)) -> DataFrame:
    """Rows and ratios by irradiance threshold: one pass, each row counted under the thresholds it passes."""
    rows = base_rows(fact).withColumn("threshold", F.explode(F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: F.col("irr_kwh_m2_hour") >= t)))
    each = rows.groupBy("threshold", "facility_code").agg(F.count(F.lit(1)).alias("n"), performance_ratio().alias("pr"))
    return each.groupBy("threshold").agg(F.sum("n").alias("n"), F.round(F.avg("pr"), 3).alias("avg_pr"), F.min("pr").alias("min_pr"), F.max("pr").alias("max_pr"))


def filter_waterfall(fact: DataFrame) -> DataFrame:
    """Rows that pass each filter alone and all filters so far, as shares, and what is lost against the step before and in all."""
    steps = [("no_filter", F.lit(True)), ("energy_positive", F.col("energy_mwh") > 0), ("has_capacity", F.col("total_capacity_mw") > 0), ("irradiance", F.col("irr_kwh_m2_hour") >= 0.02), ("good_quality", F.col("quality_flag") == "GOOD")]
    so_far, aggs = F.lit(True), []
    for i, (_, cond) in enumerate(steps):
        so_far = so_far & cond
        aggs += [F.count_if(cond).alias(f"a{i}"), F.count_if(so_far).alias(f"c{i}")]
    pct = lambda part, whole: F.round(F.try_divide(part * 100.0, whole), 4)
    total = F.col("total")
    rows = []
    for i, (n, _) in enumerate(steps):
        alone, kept = F.col(f"a{i}"), F.col(f"c{i}")
        before = F.col(f"c{i - 1}") if i else total
        rows.append(F.struct(F.lit(i).alias("step"), F.lit(n).alias("filter_name"), alone.alias("alone"), pct(alone, total).alias("alone_pct"), kept.alias("cumulative"), pct(kept, total).alias("retention_pct"), (before - kept).alias("lost"), pct(before - kept, before).alias("lost_pct"), pct(total - kept, total).alias("total_loss_pct")))
    return fact.agg(F.count(F.lit(1)).alias("total"), *aggs).select(F.inline(F.array(*rows)))


def plant_kpis(fact: DataFrame) -> DataFrame:
    """Energy, performance ratio, capacity factors and specific yield by facility."""
    e = F.sum(F.col("energy_mwh").cast("decimal(18,6)")).cast("double")
    cap = F.max("total_capacity_mw").cast("double")
    pct = lambda hours: F.round(F.try_divide(e, cap * hours) * 100, 4)
    return fact.groupBy("facility_code").agg(F.round(e, 4).alias("total_mwh"), performance_ratio().alias("pr_pct"), pct(F.count_distinct("date_key") * 24).alias("cf_calendar_pct"), pct(F.count_distinct("date_hour")).alias("cf_observed_pct"), F.round(F.try_divide(e, cap), 4).alias("specific_yield"))


def kpi_rows(kpis: DataFrame) -> DataFrame:
    """The same as (facility, metric, value, unit)."""
    rows = kpis.unpivot("facility_code", [c for c in kpis.columns if c != "facility_code"], "metric", "value")
    return rows.withColumn("unit", F.when(F.col("metric") == "total_mwh", "MWh").when(F.col("metric") == "specific_yield", "kWh/kWp").otherwise("%"))


#: Named filters of the study.
SCENARIOS = {
    "all_filters": "is_valid AND irr_kwh_m2_hour >= 0.02E0 AND yr_weighted_kwh IS NOT NULL",
    "without_is_valid": "irr_kwh_m2_hour >= 0.02E0 AND yr_weighted_kwh IS NOT NULL",
    "irradiance_0.01": "is_valid AND irr_kwh_m2_hour >= 0.01E0 AND yr_weighted_kwh IS NOT NULL",
    "irradiance_0.005": "is_valid AND irr_kwh_m2_hour >= 0.005E0 AND yr_weighted_kwh IS NOT NULL",
    "without_irradiance": "is_valid AND yr_weighted_kwh IS NOT NULL",
}


def _by_filter(fact: DataFrame, filters: dict[str, str]) -> DataFrame:
    """facility_code, total, and for filter i n{i} and pr{i}: all filters in one pass."""
    aggs = []
    for i, cond in enumerate(filters.values()):
        total = lambda c, kind, cond=cond: F.sum(F.when(F.expr(cond), F.col(c).cast(kind))).cast("double")
        pr = F.round(F.try_divide(total("energy_mwh", "decimal(18,6)") * 1000, total("yr_weighted_kwh", "decimal(24,6)")) * 100, 4)
        aggs += [F.count_if(F.expr(cond)).alias(f"n{i}"), pr.alias(f"pr{i}")]
    return fact.groupBy("facility_code").agg(F.count(F.lit(1)).alias("total"), *aggs)


def filter_scenarios(fact: DataFrame, filters: dict[str, str] = SCENARIOS) -> DataFrame:
    """Rows, retention and facility ratios of each filter, and whether it keeps 70 % and its mean ratio is over 60 %."""
    rows = F.array(*[F.struct(F.lit(name).alias("scenario"), F.col(f"n{i}").alias("n"), F.col("total"), F.col(f"pr{i}").alias("pr")) for i, name in enumerate(filters)])
    out = _by_filter(fact, filters).select(F.inline(rows)).groupBy("scenario").agg(
        F.sum("n").alias("records"), F.round(F.sum("n") * 100.0 / F.sum("total"), 4).alias("retention_pct"),
        F.round(F.avg("pr"), 3).alias("avg_pr"), F.min("pr").alias("min_pr"), F.max("pr").alias("max_pr"))
    return out.withColumn("compliant", (F.col("retention_pct") >= 70) & F.coalesce(F.col("avg_pr") > 60, F.lit(False)))


def filter_comparison(fact: DataFrame, old: str = SCENARIOS["all_filters"], new: str = "is_valid AND irr_kwh_m2_hour IS NOT NULL AND yr_weighted_kwh IS NOT NULL") -> DataFrame:
    """Rows, retention and ratio of each facility under two filters, and what the new one gains; a ratio that is unknown counts as 0."""
    part = lambda i: F.round(F.col(f"n{i}") * 100.0 / F.col("total"), 4)
    pr = lambda i: F.coalesce(f"pr{i}", F.lit(0.0))
    return _by_filter(fact, {"old": old, "new": new}).select(
        "facility_code", "total", F.col("n0").alias("old_n"), F.col("n1").alias("new_n"), part(0).alias("old_retention"), part(1).alias("new_retention"), pr(0).alias("old_pr"), pr(1).alias("new_pr"),
        (F.col("n1") - F.col("n0")).alias("added"), F.round(pr(1) - pr(0), 4).alias("pr_change"), ((part(1) >= 70) & (pr(1) > 60)).alias("compliant"))


def daily_stats(fact: DataFrame) -> DataFrame:
    """Means of daily energy and rows by facility."""
    days = fact.groupBy("facility_code", "date_key").agg(F.sum(F.col("energy_mwh").cast("decimal(18,6)")).alias("_sum"), F.count("energy_mwh").alias("_n"))
    mean = lambda c: F.round(F.try_divide(F.sum(c).cast("double"), F.count(c)), 4)
    return days.groupBy("facility_code").agg(F.count(F.lit(1)).alias("days"), mean("_sum").alias("avg_daily_mwh"), mean("_n").alias("avg_daily_rows"))


def daily_totals(fact: DataFrame) -> DataFrame:
    """Energy and irradiation of all facilities by day."""
    total = lambda c: F.round(F.sum(F.col(c).cast("decimal(18,6)")).cast("double"), 4)
    return fact.groupBy("date_key").agg(total("energy_mwh").alias("total_mwh"), total("irr_kwh_m2_hour").alias("total_irradiation"), F.count(F.lit(1)).alias("row_count"))


#: Fixed value: capacity in MW where none is known.
DEFAULT_CAPACITY_MW = 102.0


def local_hours(energy: DataFrame, facilities: DataFrame, weather: DataFrame, capacity: float = DEFAULT_CAPACITY_MW) -> DataFrame:
    """Energy rows with their facility's capacity (``capacity`` where that is unknown) and the weather of their facility at the same local date and hour; rows without weather go."""
    at = lambda df: [F.to_date("date_hour").alias("local_date"), F.hour("date_hour").alias("hour")]
    known = energy.select("facility_code", *at(energy), "energy_mwh").join(facilities.select("facility_code", "total_capacity_mw"), "facility_code", "left")
    known = known.withColumn("total_capacity_mw", F.coalesce(F.col("total_capacity_mw").cast("double"), F.lit(capacity)))
    w = weather.select("facility_code", *at(weather), (F.col("shortwave_radiation") / 1000.0).alias("irr_kwh_m2_hour"), "temperature_2m", "wind_speed_10m", "cloud_cover")
    return known.join(w, ["facility_code", "local_date", "hour"]).withColumn("date_key", F.date_format("local_date", "yyyyMMdd").cast("int"))
