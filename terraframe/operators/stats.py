"""Distribution statistics: quantiles, shift, separability, stability, areas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUANTILES = (0.02, 0.25, 0.5, 0.75, 0.98)
QUANTILE_NAMES = ("q02", "q25", "q50", "q75", "q98")
OK, WARN = 0.5, 1.0


def unpivot(frame: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    return frame.select(*keys, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(keys, features, "feature", "value")


def quantile_table(frame: DataFrame, features: list[str], role: Column) -> DataFrame:
    """(role, feature, q02..q98) of each class and of all rows together as ``pooled``.

    All features are aggregated in one pass with grouping sets (class), ().
    """
    cols = [F.percentile(F.col(f).cast("double"), F.array(*map(F.lit, QUANTILES))).alias(f) for f in features]
    both = frame.withColumn("role", role).rollup("role").agg(F.grouping("role").alias("_g"), *cols)
    both = both.select(F.when(F.col("_g") == 1, "pooled").otherwise(F.col("role")).alias("role"), *features)
    long = both.unpivot(["role"], features, "feature", "q")
    return long.select("role", "feature", *[F.col("q")[i].alias(n) for i, n in enumerate(QUANTILE_NAMES)])


def blended_reference(quantiles: DataFrame, weight: float) -> DataFrame:
    """Class quantiles blended by 1 / (1 + weight) for the positive class, where no pooled ones exist."""
    w = 1 / (1 + weight)
    share = F.when(F.col("role") == "positive", w).otherwise(1 - w)
    return quantiles.where("role <> 'pooled'").groupBy("feature").agg(*[F.sum(F.col(q) * share).alias(q) for q in QUANTILE_NAMES])


def domain_shift(frame: DataFrame, keys: list[str], features: list[str], reference: DataFrame) -> DataFrame:
    """(keys, feature, shift): (median - q50) / (q75 - q25), without features of zero median or no spread."""
    centres = frame.groupBy(*keys).agg(*[F.percentile(F.col(f).cast("double"), F.lit(0.5)).alias(f) for f in features])
    ref = F.broadcast(reference.select("feature", "q25", "q50", "q75"))  # one row a feature
    usable = F.col("q50").isNotNull() & (F.col("q50") != 0) & (F.col("q75") > F.col("q25"))
    return centres.unpivot(keys, features, "feature", "centre").join(ref, "feature").where(usable).select(*keys, "feature", ((F.col("centre") - F.col("q50")) / (F.col("q75") - F.col("q25"))).alias("shift"))


def domain_verdict(shifts: DataFrame, keys: list[str], enforce: bool = False) -> DataFrame:
    """RMS shift per key, ok to 0.5, warn to 1.0, else refuse (an error when enforced), and its worst features."""
    worst = F.slice(F.sort_array(F.collect_list(F.struct(F.abs("shift").alias("a"), "feature")), False), 1, 3)
    out = shifts.groupBy(*keys).agg(F.sqrt(F.avg(F.col("shift") * F.col("shift"))).alias("score"), worst.alias("_w"))
    refuse = F.raise_error(F.lit("distribution shift beyond the limit")) if enforce else F.lit("refuse")
    return out.select(*keys, "score", F.when(F.col("score") <= OK, "ok").when(F.col("score") <= WARN, "warn").otherwise(refuse).alias("verdict"), F.concat_ws(",", "_w.feature").alias("worst"))


def cohens_d(x: Column, positive: Column, pooled: bool = False) -> Column:
    """Cohen's d between a class and the rest: mean of both variances, or pooled by degrees of freedom."""
    a, b = F.when(positive, x), F.when(~positive, x)
    if pooled:
        na, nb = F.count(a), F.count(b)
        var = F.try_divide((na - 1) * F.var_samp(a) + (nb - 1) * F.var_samp(b), (na + nb - 2).cast("double"))
    else:
        var = (F.var_samp(a) + F.var_samp(b)) / 2
    return F.try_divide(F.avg(a) - F.avg(b), F.sqrt(var))


def separability(frame: DataFrame, keys: list[str], x: str, positive: Column, least: int = 100, weak: float = 0.8) -> DataFrame:
    """Cohen's d per group with a status: ok, weak, or background-only where a class has under ``least`` rows."""
    out = frame.groupBy(*keys).agg(F.count_if(positive).alias("n_pos"), F.count_if(~positive).alias("n_neg"), cohens_d(F.col(x).cast("double"), positive).alias("d"))
    few = (F.col("n_pos") < least) | (F.col("n_neg") < least)
    return out.select(*keys, "n_pos", "n_neg", F.when(~few, F.col("d")).alias("d"), F.when(few, "background-only").when(F.col("d") < weak, "weak").otherwise("ok").alias("status"))


def drop_weak(frame: DataFrame, keys: list[str], status: DataFrame) -> DataFrame:
    """Rows whose group is not weak."""
    return frame.join(status.where("status = 'weak'").select(*keys), keys, "left_anti")


def centres(frame: DataFrame, keys: list[str], features: list[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(*[F.percentile(F.col(f).cast("double"), F.lit(0.5)).alias(f) for f in features])


def paired_deviations(frame: DataFrame, site: str, when: str, reference: str, features: list[str]) -> DataFrame:
    """Percent deviation of each site's date medians from its own reference date; median over sites."""
    long = centres(frame, [site, when], features).unpivot([site, when], features, "feature", "value")
    ref = long.where(F.col(when) == reference).select(site, "feature", F.col("value").alias("ref"))
    each = long.join(ref, [site, "feature"]).where("ref <> 0").withColumn("dev", (F.col("value") - F.col("ref")) / F.col("ref") * 100)
    return each.groupBy(when, "feature").agg(F.percentile("dev", F.lit(0.5)).alias("dev"))


def rank_features(deviations: DataFrame) -> DataFrame:
    """Range and worst absolute deviation of each feature, most stable first."""
    return deviations.groupBy("feature").agg((F.max("dev") - F.min("dev")).alias("range_pct"), F.max(F.abs("dev")).alias("worst_pct"))


def suggest_features(ranking: DataFrame, most: float = 15.0, minimum: int = 3) -> DataFrame:
    """Features within the range limit, or the first ``minimum`` if fewer are."""
    order = Window.orderBy("range_pct", "feature")  # one row a feature
    return ranking.withColumn("pos", F.row_number().over(order)).where((F.col("range_pct") <= most) | (F.col("pos") <= minimum))


def pivot_counts(frame: DataFrame, keys: list[str], column: str, values: list) -> DataFrame:
    return frame.groupBy(*keys).agg(*[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values])


def unit_interval_histogram(x: Column, bins: int = 10) -> Column:
    """Bin number 1..bins on [0, 1]; the last bin has both ends."""
    return F.least(F.width_bucket(x, F.lit(0.0), F.lit(1.0), F.lit(bins)), F.lit(bins))


def robust_match(pairs: DataFrame, keys: list[str], x: str, y: str, limits: tuple[float, float] = (0.5, 2.0), least: int = 100) -> DataFrame:
    """Gain and offset that match x to y: 1-99 % trim of both, medians, ratio of absolute deviations."""
    pct = lambda c, q: F.percentile(F.col(c).cast("double"), F.lit(q))
    cut = pairs.groupBy(*keys).agg(pct(x, 0.01).alias("x1"), pct(x, 0.99).alias("x9"), pct(y, 0.01).alias("y1"), pct(y, 0.99).alias("y9"))
    inside = pairs.join(F.broadcast(cut) if not keys else cut, keys).withColumn("_in", F.col(x).between(F.col("x1"), F.col("x9")) & F.col(y).between(F.col("y1"), F.col("y9")))
    enough = inside.groupBy(*keys).agg(F.count_if("_in").alias("_n"))
    kept = inside.join(enough, keys).where(F.col("_in") | (F.col("_n") < least))
    mid = kept.groupBy(*keys).agg(pct(x, 0.5).alias("mx"), pct(y, 0.5).alias("my"))
    dev = kept.join(mid, keys).groupBy(*keys).agg(F.first("mx").alias("mx"), F.first("my").alias("my"), F.percentile(F.abs(F.col(x) - F.col("mx")), F.lit(0.5)).alias("dx"), F.percentile(F.abs(F.col(y) - F.col("my")), F.lit(0.5)).alias("dy"))
    gain = F.greatest(F.lit(limits[0]), F.least(F.lit(limits[1]), F.try_divide("dy", "dx")))
    return dev.select(*keys, gain.alias("gain"), (F.col("my") - gain * F.col("mx")).alias("shift"))


def area_summary(frame: DataFrame, keys: list[str], area: str) -> DataFrame:
    a = F.col(area).cast("double")
    return frame.groupBy(*keys).agg(F.count(a).alias("n"), F.sum(a).alias("total"), F.percentile(a, F.lit(0.5)).alias("median"), F.percentile(a, F.lit(0.95)).alias("p95"), F.max(a).alias("largest"), F.count_if(a < 1).alias("under_one"))


def share_of_column(frame: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """Totals per (row, column) and their percent of the column's total."""
    total = frame.groupBy(row, column).agg(F.sum(F.col(value).cast("double")).alias("total"))
    return total.withColumn("pct", F.col("total") * 100 / F.sum("total").over(Window.partitionBy(column)))


def centred(frame: DataFrame, group: str, x: str) -> DataFrame:
    """Value minus its group's median."""
    mid = frame.groupBy(group).agg(F.percentile(F.col(x).cast("double"), F.lit(0.5)).alias("_m"))
    return frame.join(mid, group).withColumn("centred", F.col(x) - F.col("_m")).drop("_m")


def field_flips(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(change, n, acres) of fields of (key, crop, acres) that are crop in both runs, became or stopped being crop; a field that a run lacks isn't crop there."""
    side = lambda df, n: df.where(F.col(key) > 0).groupBy(key).agg(F.bool_or("crop").alias(f"_{n}"), F.sum("acres").alias(f"_a{n}"))
    both = side(base, "old").join(side(new, "new"), key, "full").na.fill(False, ["_old", "_new"])
    change = F.when(F.col("_old") & F.col("_new"), "kept").when(F.col("_new"), "gained").when(F.col("_old"), "lost")
    rows = both.select(change.alias("change"), F.when(F.col("_new"), F.col("_anew")).otherwise(F.col("_aold")).alias("acres"))
    return rows.where("change is not null").groupBy("change").agg(F.count(F.lit(1)).alias("n"), F.sum("acres").alias("acres"))
