"""Per-pixel inference: stored tree models, domain check, classification, labelled pixels, layer matching."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.series import finite
from ..sources.sinks import shared_folder
from . import spatial, stats

NODATA = 255


def flatten(trees: list[dict]) -> tuple[list[int], dict[str, np.ndarray]]:
    """Roots and node arrays of trees of {"feature": i, "cut": t, "below": tree, "above": tree} or {"leaf": v}."""
    rows: list[list[float]] = []

    def add(node: dict) -> int:
        at = len(rows)
        rows.append([-1, 0.0, 0, 0, node.get("leaf", 0.0)])
        if "leaf" not in node:
            rows[at][:2] = [node["feature"], node["cut"]]
            rows[at][2], rows[at][3] = add(node["below"]), add(node["above"])
        return at

    roots = [add(t) for t in trees]
    table = np.array(rows, float).reshape(-1, 5)
    kinds = {"feature": int, "cut": float, "below": int, "above": int, "value": float}
    return roots, {n: table[:, i].astype(k) for i, (n, k) in enumerate(kinds.items())}


def walk(x: np.ndarray, roots: list[int], nodes: dict[str, np.ndarray]) -> np.ndarray:
    """Sum of the leaves that each row of ``x`` reaches; a value goes below a cut if it is smaller."""
    total, every = np.zeros(len(x)), np.arange(len(x))
    for root in roots:
        at = np.full(len(x), root)
        while True:
            feature = nodes["feature"][at]
            if (feature < 0).all():
                break
            less = x[every, np.maximum(feature, 0)] < nodes["cut"][at]
            at = np.where(feature < 0, at, np.where(less, nodes["below"][at], nodes["above"][at]))
        total += nodes["value"][at]
    return total


def tree_score(features: list[Column], trees: list[dict], forest: bool = False) -> Column:
    """Probability of the positive class by a stored model, in Arrow batches.

    Boosted trees: the logistic of the sum of leaves. ``forest``: the mean of leaves, which hold
    shares. NULL where a feature is missing or not finite.
    """
    roots, nodes = flatten(trees)

    @F.pandas_udf("double")
    def run(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(float, na_value=np.nan) for c in columns])
        out = np.full(len(x), np.nan)
        there = np.isfinite(x).all(axis=1)
        total = walk(x[there], roots, nodes)
        out[there] = total / len(roots) if forest else 1 / (1 + np.exp(-total))
        return pd.Series(out).astype(object).where(there, None)

    return run(*[f.cast("double") for f in features])


def all_finite(features: list[Column]) -> Column:
    ok = F.lit(True)
    for f in features:
        ok = ok & finite(f.cast("double"))
    return ok


def classify(frame: DataFrame, features: list[Column], trees: list[dict], threshold: float = 0.5, usable: Column | None = None, positive: int = 1, background: int = 4, forest: bool = False) -> DataFrame:
    """``frame`` with cls and prob: prob >= threshold is ``positive``; a pixel out of use is nodata without a probability."""
    ok = F.coalesce(all_finite(features) & (F.lit(True) if usable is None else usable), F.lit(False))
    scored = frame.withColumn("prob", tree_score([F.when(ok, f) for f in features], trees, forest))
    return scored.withColumn("cls", F.when(F.col("prob").isNull(), NODATA).when(F.col("prob") >= threshold, positive).otherwise(background))


def domain_sample(frame: DataFrame, keys: list[str], most: int = 2_000_000) -> DataFrame:
    """About ``most`` rows by the hash of their keys, the same in every run; all rows if there are no more than that."""
    total = frame.agg(F.count(F.lit(1)).alias("_n"))
    place = F.conv(F.substring(F.md5(F.concat_ws("|", *keys).cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)
    return frame.join(F.broadcast(total)).where(place < most / F.col("_n")).drop("_n")  # one row


def check_scene(scene: DataFrame, keys: list[str], features: dict[str, Column], quantiles: DataFrame, valid: Column, mask: Column | None = None, most: int = 2_000_000, enforce: bool = False) -> DataFrame:
    """One row: role of the reference, RMS shift and verdict of the pixels that a model would classify.

    Under a mask of crop candidates the reference is the positive class, else all training rows.
    """
    role = "pooled" if mask is None else "positive"
    kept = scene.where(valid if mask is None else valid & mask).select(*keys, *[f.alias(n) for n, f in features.items()])
    shifts = stats.domain_shift(domain_sample(kept, keys, most), [], list(features), quantiles.where(F.col("role") == role))
    return stats.domain_verdict(shifts, [], enforce).select(F.lit(role).alias("role"), "score", "verdict", "worst")


def labelled_pixels(squares: DataFrame, boxes: DataFrame, keys: list[str], size: float, positive: int = 1, background: int = 4, most: int | None = None) -> DataFrame:
    """Squares with a class: wholly in a box, or clear of all; those that a border crosses have none and go.

    ``most`` caps a class in a hash order of the keys. A square that only several boxes cover
    together counts as crossed.
    """
    key = F.struct(*keys)
    bounds = squares.select(key.alias("_key"), "x0", "y0", "x1", "y1")
    within = (F.col("l_x0") >= F.col("r_x0")) & (F.col("l_x1") <= F.col("r_x1")) & (F.col("l_y0") >= F.col("r_y0")) & (F.col("l_y1") <= F.col("r_y1"))
    met = spatial.box_join(bounds, boxes.select("x0", "y0", "x1", "y1"), size, ("_key", "x0")).groupBy("l__key").agg(F.bool_or(within).alias("_in"))
    met = met.select(*[F.col(f"l__key.{k}").alias(k) for k in keys], "_in")
    label = F.when(F.col("_in").isNull(), background).when(F.col("_in"), positive)
    rows = squares.join(met, keys, "left").withColumn("label", label).where("label is not null").drop("_in")
    if most is None:
        return rows
    from .evaluate import stratified_cap

    return stratified_cap(rows, ["label"], most, [F.md5(F.concat_ws("|", *keys).cast("binary")), *map(F.col, keys)]).drop("pos")


def match_layers(obs: DataFrame, order: list, pixel: list[str], day: str, bands: list[str], usable: Column, rank: str, least: int = 400, share: float = 0.02, limits: tuple[float, float] = (0.5, 2.0)) -> list[tuple]:
    """(day, band, gain, shift, reference, pixels) that bring each layer of ``order`` onto the top one.

    The reference is the top layer, or else the first layer already corrected that shares at least
    max(``least``, ``share`` of all pixels); a layer without one stays as it is and is not listed.
    Layers lie side by side in one row a pixel, so overlaps are counted in one pass without a join.
    """
    spark, at = obs.sparkSession, [f"_d{i}" for i in range(len(order))]
    best = [F.min_by(F.struct(*[F.col(b).cast("double").alias(b) for b in bands]), F.when(usable & (F.col(day) == F.lit(d)), F.col(rank))).alias(n) for n, d in zip(at, order)]
    path = shared_folder(spark, "layers")
    obs.groupBy(*pixel).agg(*best).write.parquet(path)
    wide = spark.read.parquet(path)
    shared = {(i, j): F.count_if(F.col(at[i]).isNotNull() & F.col(at[j]).isNotNull()).alias(f"{i}_{j}") for i in range(1, len(order)) for j in range(i)}
    counts = wide.agg(F.count(F.lit(1)).alias("n"), *shared.values()).first()  # a number a pair of dates
    need = max(least, int(share * counts["n"]))
    found: dict[int, dict[str, tuple[float, float]]] = {}
    out = []
    for i in range(1, len(order)):
        ref = next((j for j in (0, *found) if counts[f"{i}_{j}"] >= need), None)
        if ref is None:
            continue
        onto = lambda b: F.col(f"{at[ref]}.{b}") * F.lit(found.get(ref, {}).get(b, (1.0, 0.0))[0]) + F.lit(found.get(ref, {}).get(b, (1.0, 0.0))[1])
        pairs = wide.where(F.col(at[i]).isNotNull() & F.col(at[ref]).isNotNull()).select(F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"{at[i]}.{b}").alias("x"), onto(b).alias("y")) for b in bands])).alias("p")).select("p.*")
        rows = stats.robust_match(pairs, ["band"], "x", "y", limits).collect()  # a row a band
        found[i] = {r["band"]: (r["gain"], r["shift"]) for r in rows}
        out += [(order[i], r["band"], r["gain"], r["shift"], order[ref], counts[f"{i}_{ref}"]) for r in rows]
    return out


def layered_image(obs: DataFrame, order: list, pixel: list[str], day: str, bands: list[str], usable: Column, coefficients: list[tuple]) -> DataFrame:
    """Per pixel the bands of the first layer of ``order`` that has it, matched to the top one; source_rank from 1, 0 for none."""
    from .compose import layered_mosaic

    place = F.coalesce(*[F.when(F.col(day) == F.lit(d), i) for i, d in enumerate(order, 1)])
    moved = {b: F.col(b).cast("double") for b in bands}
    for d, band, gain, shift, *_ in coefficients:
        moved[band] = F.when(F.col(day) == F.lit(d), F.greatest(F.col(band) * F.lit(gain) + F.lit(shift), F.lit(0.0))).otherwise(moved[band])
    # Masks are taken from the scene as it was read.
    rows = obs.select(*pixel, place.alias("_rank"), usable.alias("_ok"), *[x.alias(b) for b, x in moved.items()])
    return layered_mosaic(rows, pixel, "_rank", bands, F.col("_ok") & F.col("_rank").isNotNull())


def centroid_scores(train: DataFrame, test: DataFrame, features: list[str], label: Column) -> DataFrame:
    """``test`` with prob: nearness to the mean of the positive class against that of the other, in squared distance."""
    means = train.groupBy().agg(*[F.avg(F.when(k, F.col(f))).alias(f"_{n}_{f}") for f in features for n, k in (("p", label), ("n", ~label))])
    far = lambda n: sum(((F.col(f) - F.col(f"_{n}_{f}")) * (F.col(f) - F.col(f"_{n}_{f}")) for f in features), F.lit(0.0))
    rows = test.join(F.broadcast(means)).withColumn("prob", F.try_divide(far("n"), far("p") + far("n")))  # one row
    return rows.drop(*means.columns)
