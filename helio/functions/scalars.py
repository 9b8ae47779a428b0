"""Column expressions: time keys, labels, air-quality index, humidity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "Australia/Brisbane"
#: Zone and hours from UTC of the networks.
NETWORK_ZONES = {"NEM": "Australia/Brisbane", "WEM": "Australia/Perth"}
NETWORK_OFFSETS = {"NEM": 10, "WEM": 8}
#: Concentration band and index band of PM2.5.
PM25_BANDS = ((0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150), (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 500.0, 301, 500))


def ladder(value: Column, steps: list[tuple[float, str]], top: str, below: bool = True) -> Column:
    """First label whose bound is not under (``below``) or not over the value, else ``top``; null stays null."""
    out = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in steps:
        out = out.when(value <= bound if below else value >= bound, label)
    return out.otherwise(top)


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def season(month: Column) -> Column:
    """Seasons of the southern hemisphere."""
    names = F.array(*[F.lit(s) for s in ("Summer", "Autumn", "Winter", "Spring")])
    return F.get(names, F.floor((month % 12) / 3).cast("int"))


def time_of_day(hour: Column) -> Column:
    return F.when(hour < 6, "Night").when(hour < 12, "Morning").when(hour < 17, "Afternoon").when(hour < 21, "Evening").when(hour.isNotNull(), "Night")


def by_code(code: Column, values: dict, default) -> Column:
    """The value of a code in a small fixed map, else ``default``."""
    out = None
    for k, v in values.items():
        out = F.when(code == k, v) if out is None else out.when(code == k, v)
    return F.lit(default) if out is None else out.otherwise(default)


def network_zone(network: Column) -> Column:
    return by_code(network, NETWORK_ZONES, DEFAULT_ZONE)


def network_offset(network: Column) -> Column:
    return by_code(network, NETWORK_OFFSETS, 10)


def local_time(ts: Column, zone: Column | str = DEFAULT_ZONE) -> Column:
    return F.from_utc_timestamp(ts, zone)


def aqi_from_pm25(value: Column) -> Column:
    """Piecewise linear index, capped at 500, as a whole number."""
    capped = F.least(value, F.lit(500.0))
    lines = [((capped - lo) / (hi - lo) * (b - a) + a, hi) for lo, hi, a, b in PM25_BANDS]
    index = reduce(lambda rest, band: F.when(capped <= band[1], band[0]).otherwise(rest), reversed(lines[:-1]), lines[-1][0])
    return F.when(value.isNotNull(), F.round(index)).cast("int")


def aqi_label(index: Column) -> Column:
    return ladder(index, [(50, "Good"), (100, "Moderate"), (200, "Unhealthy")], "Hazardous")


def humidity(temperature: Column, dew_point: Column) -> Column:
    """Relative humidity by the Magnus formula, clamped to 0..100; null if an input is."""
    vapour = lambda t: F.exp(F.lit(17.625) * t / (F.lit(243.04) + t))
    raw = 100.0 * vapour(dew_point) / vapour(temperature)
    return F.when(temperature.isNotNull() & dew_point.isNotNull(), F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw)))


def clean_number(value: Column) -> Column:
    """Double from a number or text; NaN, empty and unreadable values are null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of all attributes as text, nulls as empty, joined by two bars."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def exact_sum(c: Column, places: int = 8) -> Column:
    """Sum of doubles, each rounded to ``places``, whatever the order of rows; null where all are.

    Numbers become scaled longs, whose low, middle and high bits are summed apart, so nothing overflows below 2^42 rows and no decimal is
    made for a row; numbers that a scaled long can't hold are summed as decimals (null from 10^20).
    """
    scale, bits = 10**places, 21
    small = F.abs(c) * scale < 2.0**62
    u = F.when(small, F.rint(c * float(scale)).cast("long"))
    mask = (1 << bits) - 1
    parts = [F.sum(u.bitwiseAND(mask)), F.sum(F.shiftright(u, bits).bitwiseAND(mask)), F.sum(F.shiftright(u, 2 * bits))]
    whole = sum((p.cast("decimal(38,0)") * F.lit(1 << i * bits).cast("decimal(20,0)") for i, p in enumerate(parts[1:], 1)), parts[0].cast("decimal(38,0)"))
    large = F.sum(F.when(~small, c.try_cast(f"decimal(28,{places})"))).cast("double")
    return F.coalesce(whole.cast("double") / scale + F.coalesce(large, F.lit(0.0)), large)
