"""Phenology of one pixel's series, as array expressions; a step that is NULL, NaN or infinite is missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BARE, GREEN, LEAST_VALID = 0.45, 0.60, 8


def finite(x: Column) -> Column:
    # NaN is above every number here.
    return x.isNotNull() & (F.abs(x) < float("inf"))


def known(s: Column) -> Column:
    """The series with every missing step as NULL."""
    return F.transform(s, lambda x: F.when(finite(x), x))


def valid(s: Column) -> Column:
    return F.filter(s, finite)


def quantile(s: Column, q: float) -> Column:
    """Interpolated quantile of the valid values."""
    v = F.array_sort(valid(s))
    at = (F.size(v) - 1) * F.lit(q)
    low = F.floor(at).cast("int")
    a, b = F.get(v, low), F.get(v, F.least(low + 1, F.size(v) - 1))
    return F.when(F.size(v) > 0, a + (b - a) * (at - low))


def mean(s: Column) -> Column:
    v = valid(s)
    return F.when(F.size(v) > 0, F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v))


def std(s: Column) -> Column:
    """Population deviation of the valid values, from one pass of sums about the first value."""
    v = valid(s)
    shift = F.get(v, F.lit(0))
    moved = F.zip_with(v, F.array_repeat(shift, F.size(v)), lambda x, c: x - c)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b"))
    sums = F.aggregate(moved, zero, lambda t, x: F.struct((t.a + x).alias("a"), (t.b + x * x).alias("b")), lambda t: F.struct(t.a.alias("a"), t.b.alias("b")))
    n = F.size(v)
    return F.when(n > 0, F.sqrt(F.greatest(F.lit(0.0), sums["b"] / n - (sums["a"] / n) * (sums["a"] / n))))


def differences(s: Column) -> Column:
    """First differences; NULL where either side is missing."""
    return F.zip_with(F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))), lambda b, a: b - a)


def position(s: Column, extreme: Column) -> Column:
    return (F.array_position(s, extreme) - 1) / (F.size(s) - 1)


def longest_run(s: Column, over: float) -> Column:
    """Longest run of values above ``over``; a missing value ends a run."""
    step = lambda a, x: F.struct(F.when(F.coalesce(x > over, F.lit(False)), a.run + 1).otherwise(0).alias("run"), F.greatest(a.best, F.when(F.coalesce(x > over, F.lit(False)), a.run + 1).otherwise(0)).alias("best"))
    return F.aggregate(s, F.struct(F.lit(0).alias("run"), F.lit(0).alias("best")), step, lambda a: a.best)


FEATURES = {
    "amplitude": lambda s: quantile(s, 0.95) - quantile(s, 0.05),
    "ndvi_min": lambda s: F.array_min(valid(s)),
    "ndvi_max": lambda s: F.array_max(valid(s)),
    "ndvi_mean": mean,
    "ndvi_std": std,
    "interquartile": lambda s: quantile(s, 0.75) - quantile(s, 0.25),
    "sharpest_fall": lambda s: F.array_min(valid(differences(s))),
    "sharpest_rise": lambda s: F.array_max(valid(differences(s))),
    "steps_below_bare": lambda s: F.size(F.filter(s, lambda x: x < BARE)),
    "fraction_above_green": lambda s: F.try_divide(F.size(F.filter(s, lambda x: x > GREEN)).cast("double"), F.size(valid(s))),
    "roughness": lambda s: std(differences(s)),
    "trough_position": lambda s: position(s, F.array_min(valid(s))),
    "peak_position": lambda s: position(s, F.array_max(valid(s))),
    "green_span": lambda s: longest_run(s, GREEN) / F.size(s),
}


def features(s: Column, names: list[str] | None = None) -> list[Column]:
    """Named features; NULL for series of under 3 steps or ``LEAST_VALID`` valid values."""
    names = list(FEATURES) if names is None else names
    if unknown := [n for n in names if n not in FEATURES]:
        raise ValueError(f"unknown features {unknown}")
    s = known(s)
    enough = (F.size(s) >= 3) & (F.size(valid(s)) >= LEAST_VALID)
    return [F.when(enough, FEATURES[n](s)).alias(n) for n in names]


def perennial_gate(ndvi_min: Column, amplitude: Column, steps_below_bare: Column, least: float = 0.45, most: float = 0.45, steps: int = 2) -> Column:
    return (ndvi_min > least) & (amplitude < most) & (steps_below_bare <= steps)
