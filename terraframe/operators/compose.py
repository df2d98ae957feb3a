"""Composites, mosaics, votes and date selection over observations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates, spectral


def search_items(items: DataFrame, collection: str, box: tuple[float, float, float, float], begin: str, end: str, cloud_below: float, ts: str = "ts") -> DataFrame:
    """Items of a collection in [begin, end) whose footprint (x0, y0, x1, y1) meets the box and whose cloud is below a limit; plain filters, which reach the scan."""
    x0, y0, x1, y1 = box
    meets = (F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0)
    within = (F.col(ts) >= F.lit(begin).cast("timestamp")) & (F.col(ts) < F.lit(end).cast("timestamp"))
    return items.where((F.col("collection") == collection) & meets & within & (F.col("cloud") < cloud_below))


def median_composite(obs: DataFrame, start: date, step: int, keys: list[str], bands: list[str], day: str = "day", keep: Column | None = None) -> DataFrame:
    """Median of each band per key and window; masked observations count as missing, not as absent.

    A window without a usable observation stays, with NULL bands and 0 valid.
    """
    keep = F.lit(True) if keep is None else keep
    cols = [F.percentile(F.when(keep, F.col(b)), F.lit(0.5)).alias(b) for b in bands]
    return obs.groupBy(*keys, dates.window_index(F.col(day), start, step).alias("win")).agg(*cols, F.count_if(keep).alias("n_valid"), F.count(F.lit(1)).alias("n_scenes"))


def layered_mosaic(obs: DataFrame, keys: list[str], rank: str, bands: list[str], usable: Column) -> DataFrame:
    """Per key all bands of the first-ranked usable observation; source_rank 0 where there is none."""
    best = F.min_by(F.struct(*bands), F.when(usable, F.col(rank)))
    source = F.min(F.when(usable, F.col(rank)))
    found = obs.groupBy(*keys).agg(best.alias("_b"), source.alias("_s"))
    return found.select(*keys, *[F.when(F.col("_s").isNotNull(), F.col(f"_b.{b}")).alias(b) for b in bands], F.coalesce("_s", F.lit(0)).alias("source_rank"))


def vote_fusion(maps: DataFrame, keys: list[str], cls: str, positive: int, nodata: int, need: int) -> DataFrame:
    """Votes per pixel: union (1 or more) and majority (``need`` or more); unseen pixels are nodata."""
    seen, votes = F.bool_or(F.col(cls) != nodata), F.count_if(F.col(cls) == positive)
    out = maps.groupBy(*keys).agg(seen.alias("seen"), votes.cast("int").alias("votes"))
    rule = lambda n: F.when(~F.col("seen"), nodata).when(F.col("votes") >= n, positive).otherwise(4)
    return out.select(*keys, "votes", rule(1).alias("any_vote"), rule(need).alias("majority"))


def first_wins(tiles: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Mosaic of overlapping tiles: the value of the first tile that has one."""
    return tiles.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min_by(value, order).alias(value))


def baseline_offset(items: DataFrame, keys: list[Column], newer: Column, offset: int = 1000) -> DataFrame:
    """Offset per group: that of the newer processing baseline when at least half the items have it."""
    return items.groupBy(*keys).agg(F.when(2 * F.count_if(newer) >= F.count(F.lit(1)), offset).otherwise(0).alias("dn_offset"))


def date_coverage(obs: DataFrame, pixels: int, day: str = "day", pixel: str = "pixel_id", scl: str = "scl") -> DataFrame:
    """Coverage, valid and cloud percent of each date over an area of ``pixels`` pixels."""
    per = obs.groupBy(day, pixel).agg(F.bool_or(spectral.scl_usable(F.col(scl))).alias("ok"))
    out = per.groupBy(day).agg((F.count(F.lit(1)) * 100.0 / pixels).alias("coverage_pct"), (F.count_if("ok") * 100.0 / pixels).alias("valid_pct"))
    return out.withColumn("cloud_pct", 100 * (1 - F.try_divide("valid_pct", "coverage_pct")))


def anchor_date(stats: DataFrame, day: str = "day") -> DataFrame:
    """Within 1.0 of the best valid percent, the least cloudy date; ties by valid, then the earliest."""
    best = stats.agg(F.max("valid_pct").alias("_best"))
    near = stats.join(F.broadcast(best), F.col("valid_pct") >= F.col("_best") - 1.0).drop("_best")  # one row
    return near.agg(F.min_by(F.struct(*stats.columns), F.struct("cloud_pct", -F.col("valid_pct"), day)).alias("x")).select("x.*")


def scout(obs: DataFrame, site: str, windows: list[tuple[date, date]], day: str = "day", pixel: str = "pixel_id", scl: str = "scl") -> DataFrame:
    """(site, begins, day, coverage_pct, error) of each site and half-open window: its anchor date, or why there is none."""
    spans = F.array(*[F.struct(F.lit(a).alias("begins"), F.lit(b).alias("ends")) for a, b in windows])
    hit = F.filter(spans, lambda w: (F.col(day) >= w["begins"]) & (F.col(day) < w["ends"]))
    rows = obs.select(site, day, pixel, spectral.scl_usable(F.col(scl)).alias("_ok"), F.explode(hit).alias("_w")).groupBy(site, F.col("_w.begins").alias("begins"), day, pixel).agg(F.bool_or("_ok").alias("_ok"))
    per = rows.groupBy(site, "begins", day).agg(F.count(F.lit(1)).alias("_n"), F.count_if("_ok").alias("_v"))
    sizes = obs.groupBy(site).agg(F.count_distinct(pixel).alias("_pixels"))
    share = lambda n: F.col(n) * 100.0 / F.col("_pixels")
    each = per.join(sizes, site).select(site, "begins", day, share("_n").alias("coverage_pct"), share("_v").alias("_valid"), (100 * (1 - F.col("_v") / F.col("_n"))).alias("_cloud"))
    near = each.withColumn("_best", F.max("_valid").over(Window.partitionBy(site, "begins"))).where(F.col("_valid") >= F.col("_best") - 1.0)  # a row a date of the window
    anchor = near.groupBy(site, "begins").agg(F.min_by(F.struct(day, "coverage_pct"), F.struct("_cloud", -F.col("_valid"), day)).alias("_a"))
    every = sizes.select(site, F.explode(spans).alias("_w")).select(site, F.col("_w.begins").alias("begins"))
    out = every.join(anchor, [site, "begins"], "left").select(site, "begins", f"_a.{day}", "_a.coverage_pct")
    return out.withColumn("error", F.when(F.col(day).isNull(), "no scene in the window"))


def single_composite(obs: DataFrame, keys: list[str], bands: list[str], offset: float, most: int = 40_000_000) -> DataFrame:
    """Median of each band per key, less the offset; an error for more than ``most`` keys, which want tiles."""
    out = obs.groupBy(*keys).agg(*[F.percentile(b, F.lit(0.5)).alias(b) for b in bands])
    size = F.broadcast(obs.agg(F.approx_count_distinct(F.struct(*keys), 0.01).alias("_n")))  # one row
    fits = F.when(F.col("_n") > most, F.raise_error(F.lit(f"more than {most} pixels in one composite"))).otherwise(0)
    return out.join(size).select(*keys, *[(spectral.offset_clip(F.col(b), offset) + fits).alias(b) for b in bands])


def greedy_dates(obs: DataFrame, n_dates: int, min_gain: float = 0.5, target: float = 99.0, day: str = "day", pixel: str = "pixel_id", scl: str = "scl") -> list:
    """Dates that add the most new usable pixels, one aggregation for each date chosen."""
    pixels = obs.select(pixel).distinct().count()
    seen = obs.where(spectral.scl_usable(F.col(scl))).select(pixel, day).distinct()
    chosen: list = []
    covered = 0.0
    while len(chosen) < n_dates and covered < target:
        done = seen.where(F.col(day).isin(chosen)).select(pixel).distinct() if chosen else None
        left = seen.join(done, pixel, "left_anti") if chosen else seen
        row = left.groupBy(day).count().orderBy(F.desc("count"), day).first()
        if row is None or (chosen and 100.0 * row["count"] / pixels < min_gain):
            break
        chosen.append(row[day])
        covered += 100.0 * row["count"] / pixels
    return chosen


def overview(grid: DataFrame, row: str, col: str, value: Column, factor: int) -> DataFrame:
    """Average of blocks of ``factor`` by ``factor`` cells."""
    cell = lambda x: F.floor(F.col(x) / factor).cast("bigint").alias(x)
    return grid.groupBy(cell(row), cell(col)).agg(F.avg(value).alias("v"), F.count(value).alias("n"))


def added_share(mosaic: DataFrame) -> DataFrame:
    """Percent of pixels that each layer contributes."""
    total = F.sum(F.count(F.lit(1))).over(Window.partitionBy())
    return mosaic.groupBy("source_rank").agg(F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) * 100.0 / total).alias("pct"))
