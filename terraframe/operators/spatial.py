"""Joins of boxes and pixels by grid cells, raster topology, polygon measures."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import materialized


def with_cells(boxes: DataFrame, size: float, x0: str = "x0", y0: str = "y0", x1: str = "x1", y1: str = "y1") -> DataFrame:
    """One row for each grid cell that a box touches: gx, gy."""
    cell = lambda c: F.floor(F.col(c) / size).cast("bigint")
    return boxes.withColumn("gx", F.explode(F.sequence(cell(x0), cell(x1)))).withColumn("gy", F.explode(F.sequence(cell(y0), cell(y1))))


def box_words(boxes: DataFrame, *keep: str) -> DataFrame:
    """(keep, w, y, bits): the unit cells of half-open boxes of whole numbers, a row of cells in words of 64 columns; empty boxes have none."""
    word = lambda x: F.shiftright(x.cast("bigint"), 6)
    wide = boxes.where("x1 > x0 and y1 > y0").withColumn("w", F.explode(F.sequence(word(F.col("x0")), word(F.col("x1") - 1))))
    cells = wide.withColumn("y", F.explode(F.sequence("y0", F.col("y1") - 1)))
    low, high = "greatest(x0 - w * 64, 0)", "least(x1 - w * 64, 64)"
    bits = F.expr(f"shiftleft(shiftrightunsigned(-1L, cast(64 - {high} + {low} AS int)), cast({low} AS int))")
    return cells.select(*keep, "w", "y", bits.alias("bits"))


def box_join(left: DataFrame, right: DataFrame, size: float, keys: tuple[str, str], touching: bool = False) -> DataFrame:
    """Pairs of boxes whose interiors meet (``touching``: or that share a border), each once: an equi-join on cells, then the exact test.

    A pair that shares several cells is kept only in the one that holds the lower corner of the
    intersection, so nothing has to be made distinct. Columns are prefixed l_ and r_.
    """
    a = with_cells(left, size).select(*[F.col(c).alias(f"l_{c}") for c in left.columns], "gx", "gy")
    b = with_cells(right, size).select(*[F.col(c).alias(f"r_{c}") for c in right.columns], "gx", "gy")
    meet = (F.col("l_x0") < F.col("r_x1")) & (F.col("r_x0") < F.col("l_x1")) & (F.col("l_y0") < F.col("r_y1")) & (F.col("r_y0") < F.col("l_y1"))
    if touching:
        meet = (F.col("l_x0") <= F.col("r_x1")) & (F.col("r_x0") <= F.col("l_x1")) & (F.col("l_y0") <= F.col("r_y1")) & (F.col("r_y0") <= F.col("l_y1"))
    owner = (F.floor(F.greatest("l_x0", "r_x0") / size) == F.col("gx")) & (F.floor(F.greatest("l_y0", "r_y0") / size) == F.col("gy"))
    return a.join(b, ["gx", "gy"]).where(meet & owner).drop("gx", "gy")


def overlap_area() -> Column:
    """Intersection area of a pair of ``box_join``."""
    return (F.least("l_x1", "r_x1") - F.greatest("l_x0", "r_x0")) * (F.least("l_y1", "r_y1") - F.greatest("l_y0", "r_y0"))


def assign_pixels(pixels: DataFrame, boxes: DataFrame, size: float, order: str, x: str = "x", y: str = "y") -> DataFrame:
    """Pixel centres with the box they fall in (half open); the last box in ``order`` wins."""
    cells = with_cells(boxes, size)
    p = pixels.withColumn("gx", F.floor(F.col(x) / size).cast("bigint")).withColumn("gy", F.floor(F.col(y) / size).cast("bigint"))
    inside = (F.col(x) >= F.col("x0")) & (F.col(x) < F.col("x1")) & (F.col(y) >= F.col("y0")) & (F.col(y) < F.col("y1"))
    hit = p.join(cells, ["gx", "gy"]).where(inside)
    return hit.groupBy(*pixels.columns).agg(F.max(order).alias(order))


def neighbours(cells: DataFrame, eight: bool, row: str = "r", col: str = "c") -> DataFrame:
    """Cells of the 4- or 8-neighbourhood of each cell, itself included; distinct."""
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if eight or i == 0 or j == 0]
    moves = F.explode(F.array(*[F.struct((F.col(row) + i).alias("r"), (F.col(col) + j).alias("c")) for i, j in steps]))
    return cells.select(moves.alias("x")).select("x.r", "x.c").distinct()


def dilate(cells: DataFrame, within: DataFrame, eight: bool) -> DataFrame:
    """Binary dilation by one cell inside an extent."""
    return neighbours(cells, eight).join(within.select("r", "c"), ["r", "c"], "left_semi")


#: Side of the tiles that components are labelled in, in cells.
TILE = 256


def _steps(eight: bool) -> list[tuple[int, int]]:
    """Moves to the neighbours of a cell that come after it in row order."""
    return [(0, 1), (1, 0), *([(1, -1), (1, 1)] if eight else [])]


def _root_labels(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest number of each component of the graph on 0..n-1 with edges u-v."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, label[u], low)
        np.minimum.at(label, label[v], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[u] != label[v]
        u, v = u[apart], v[apart]
    return label


def contract(links: DataFrame) -> DataFrame:
    """(id, root) for both ends of ``links`` (id, other): root is the smallest end reachable.

    Every end hooks to its smallest neighbour, the forest is flattened by pointer jumping, and links
    are rewritten to roots, until none is left: a few rounds, each of aggregations that combine
    before the shuffle.
    """
    links, labels = materialized(links), None
    while not links.isEmpty():
        both = links.union(links.select("other", "id"))
        parent = materialized(both.groupBy("id").agg(F.min("other").alias("low")).select("id", F.least("id", "low").alias("root")))
        while True:
            far = parent.select(F.col("id").alias("root"), F.col("root").alias("far"))
            jumped = materialized(parent.join(far, "root", "left").select("id", F.coalesce("far", "root").alias("root"), (F.col("far") < F.col("root")).alias("moved")))
            moved = not jumped.where("moved").isEmpty()
            parent = jumped.select("id", "root")
            if not moved:
                break
        step = parent.select(F.col("id").alias("root"), F.col("root").alias("far"))
        labels = parent if labels is None else labels.join(step, "root", "left").select("id", F.coalesce("far", "root").alias("root"))
        ends = [parent.select(F.col("id").alias(c), F.col("root").alias(f"_{c}")) for c in ("id", "other")]
        links = links.join(ends[0], "id").join(ends[1], "other").select(F.least("_id", "_other").alias("id"), F.greatest("_id", "_other").alias("other"))
        links = materialized(links.where("id <> other").distinct())
    return links.select("id", F.col("other").alias("root")) if labels is None else labels


def components(cells: DataFrame, eight: bool = False, row: str = "r", col: str = "c", value: str | None = None, tile: int = TILE) -> DataFrame:
    """(r, c, component) of connected cells, of equal ``value`` if given; component is row * 2^32 + column of the first cell.

    Tiles are labelled by themselves in one kernel; labels that touch across tile borders are few, and
    only these are linked and contracted.
    """
    names = ["r", "c"] + (["v"] if value else [])
    base = cells.select(F.col(row).cast("bigint").alias("r"), F.col(col).cast("bigint").alias("c"), *([F.col(value).cast("bigint").alias("v")] if value else []))
    at = [F.floor(F.col(x) / tile).cast("bigint").alias(f"t{x}") for x in ("r", "c")]

    def label(frame: pd.DataFrame) -> pd.DataFrame:
        r, c = frame["r"].to_numpy(), frame["c"].to_numpy()
        order = np.lexsort((c, r))
        r, c = r[order], c[order]
        v = frame["v"].to_numpy()[order] if value else np.zeros(len(r), np.int64)
        place = np.full((int(r.max() - r.min()) + 2, int(c.max() - c.min()) + 3), -1)
        y, x = r - r.min(), c - c.min() + 1
        place[y, x] = np.arange(len(r))
        u, w = [], []
        for i, j in _steps(eight):
            near = place[y + i, x + j]
            met = np.nonzero((near >= 0) & (v[np.maximum(near, 0)] == v))[0]
            u.append(met)
            w.append(near[met])
        root = _root_labels(len(r), np.concatenate(u), np.concatenate(w))
        out = {"r": r, "c": c, "label": (r[root] << 32) + c[root]}
        return pd.DataFrame(out | ({"v": v} if value else {}))

    schema = "r bigint, c bigint, label bigint" + (", v bigint" if value else "")
    tiled = materialized(base.distinct().withColumns({"tr": at[0], "tc": at[1]}).groupBy("tr", "tc").applyInPandas(label, schema))
    edge = tiled.where(f"r % {tile} in (0, {tile - 1}) or c % {tile} in (0, {tile - 1})")
    moves = F.explode(F.array(*[F.struct((F.col("r") + i).alias("r"), (F.col("c") + j).alias("c")) for i, j in _steps(eight)]))
    ahead = edge.select(F.col("label").alias("a"), *([F.col("v")] if value else []), moves.alias("x")).select("a", *names[2:], "x.r", "x.c")
    met = ahead.join(edge.select(*names, F.col("label").alias("b")), names).where("a <> b")
    links = met.select(F.least("a", "b").alias("id"), F.greatest("a", "b").alias("other")).distinct()
    roots = contract(links)
    return tiled.join(roots, tiled["label"] == roots["id"], "left").select("r", "c", F.coalesce("root", "label").alias("component"), *([F.col("v")] if value else []))


def drop_small(labelled: DataFrame, least: int) -> DataFrame:
    """Cells of components of at least ``least`` cells."""
    sizes = labelled.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return labelled.join(sizes.select("component"), "component", "left_semi")


def sieve(grid: DataFrame, least: int, nodata: int = 255, eight: bool = False, value: str = "cls") -> DataFrame:
    """Give components of under ``least`` cells the class of their largest neighbour; nodata stays.

    Components are per class. A neighbour must be valid; ties go to the smaller component id.
    """
    known = grid.where(F.col(value) != nodata)
    parts = materialized(components(known, eight, value=value).withColumnRenamed("v", "cls"))
    sizes = parts.groupBy("component", "cls").agg(F.count(F.lit(1)).alias("n"))
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (eight or i == 0 or j == 0)]
    near = parts.select(F.col("component").alias("mine"), F.explode(F.array(*[F.struct((F.col("r") + i).alias("r"), (F.col("c") + j).alias("c")) for i, j in steps])).alias("x")).select("mine", "x.r", "x.c")
    small = sizes.where(F.col("n") < least).select(F.col("component").alias("mine"))
    touch = near.join(small, "mine", "left_semi").join(parts.select("r", "c", "component"), ["r", "c"]).where("component <> mine").select("mine", "component").distinct()
    target = touch.join(sizes, "component").groupBy("mine").agg(F.min_by("cls", F.struct(-F.col("n"), "component")).alias("to"))
    new = parts.join(target.withColumnRenamed("mine", "component"), "component", "left").select("r", "c", F.coalesce("to", "cls").alias("sieved"))
    return grid.join(new, ["r", "c"], "left").withColumn("sieved", F.coalesce("sieved", F.col(value)))


def strict_sieve(grid: DataFrame, sieved: DataFrame, target: int, eight: bool = False, value: str = "cls") -> DataFrame:
    """Undo changes to ``target`` whose clump touches a cell that is not target before or after.

    ``sieved`` is ``sieve``'s result (r, c, value, sieved).
    """
    changed = sieved.where((F.col(value) != target) & (F.col("sieved") == target)).select("r", "c")
    clumps = components(changed, eight)
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (eight or i == 0 or j == 0)]
    edge = clumps.select("component", F.explode(F.array(*[F.struct((F.col("r") + i).alias("r"), (F.col("c") + j).alias("c")) for i, j in steps])).alias("x")).select("component", "x.r", "x.c")
    outside = edge.join(clumps.select("r", "c"), ["r", "c"], "left_anti").join(grid.select("r", "c", value), ["r", "c"]).where(F.col(value) != target)
    back = clumps.join(outside.select("component").distinct(), "component", "left_semi").select("r", "c", F.lit(True).alias("_undo"))
    return sieved.join(back, ["r", "c"], "left").withColumn("strict", F.when(F.col("_undo"), F.col(value)).otherwise(F.col("sieved"))).drop("_undo")


def ring_area(xs: Column, ys: Column) -> Column:
    """Signed shoelace area of a closed ring given as coordinate arrays."""
    n = F.size(xs)
    term = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.element_at(xs, i) * F.element_at(ys, i + 1) - F.element_at(xs, i + 1) * F.element_at(ys, i))
    return F.aggregate(term, F.lit(0.0), lambda a, t: a + t) / 2


def ring_length(xs: Column, ys: Column) -> Column:
    n = F.size(xs)
    side = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.hypot(F.element_at(xs, i + 1) - F.element_at(xs, i), F.element_at(ys, i + 1) - F.element_at(ys, i)))
    return F.aggregate(side, F.lit(0.0), lambda a, t: a + t)


def compactness(area: Column, length: Column) -> Column:
    """Polsby-Popper: 4 pi A / P^2."""
    return F.try_divide(4 * F.pi() * area, length * length)


def slenderness(area: Column, length: Column) -> Column:
    return F.try_divide(length, 4 * F.sqrt(area))


def split_ring(ring: list[tuple[float, float]], theta: float, offset: float) -> tuple[list, list]:
    """Both halves of an open ring cut by the line x cos(theta) + y sin(theta) = offset."""
    from math import cos, sin

    halves = []
    for sign in (1, -1):
        out = []
        for (x, y), (u, v) in zip(ring, ring[1:] + ring[:1]):
            d, e = sign * (x * cos(theta) + y * sin(theta) - offset), sign * (u * cos(theta) + v * sin(theta) - offset)
            if d >= 0:
                out.append((x, y))
            if (d > 0 > e) or (d < 0 < e):
                t = d / (d - e)
                out.append((x + t * (u - x), y + t * (v - y)))
        halves.append(out if len(out) >= 3 else [])
    return halves[0], halves[1]


def best_cut(pixels: DataFrame, field: str, crop: str, x: str, y: str, angles: list[float] | Column, side: int = 10) -> DataFrame:
    """(field, angle, theta, cut, offset, purity): the straight cut with the purest sides, by prefix sums of both classes along a direction.

    Purity is the sum over sides of n * max(share, 1 - share) / n. The lower side has more than ``side``
    pixels, the other at least ``side``; the cut lies half way between two pixels. Positions are
    told apart to nine decimals. ``angles`` is a list for all fields or an array column. Ties: the
    first angle, then the lower position.
    """
    every = angles if isinstance(angles, Column) else F.array(*[F.lit(a) for a in angles])
    axes = F.explode(F.transform(every, lambda a, i: F.struct(i.alias("i"), a.alias("theta"))))
    proj = pixels.withColumn("_a", axes).select(field, F.col("_a.i").alias("angle"), F.col("_a.theta").alias("theta"), along(F.col(x), F.col(y), F.col("_a.theta")).alias("proj"), F.col(crop).cast("int").alias("crop"), F.col(x).alias("_x"), F.col(y).alias("_y"))
    order = Window.partitionBy(field, "angle").orderBy("proj", "_x", "_y")
    whole = Window.partitionBy(field, "angle")
    offset = (F.col("proj") + F.coalesce(F.lead("proj").over(order), "proj")) / 2
    run = proj.select("*", F.row_number().over(order).alias("n1"), offset.alias("offset"), F.sum("crop").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("k1"), F.count(F.lit(1)).over(whole).alias("n"), F.sum("crop").over(whole).alias("k"))
    n2, k2 = F.col("n") - F.col("n1"), F.col("k") - F.col("k1")
    purity = (F.greatest(F.col("k1"), F.col("n1") - F.col("k1")) + F.greatest(k2, n2 - k2)) / F.col("n")
    ok = run.where((F.col("n1") > side) & (n2 >= side)).withColumn("purity", purity)
    best = F.max_by(F.struct("angle", "theta", F.col("n1").alias("cut"), "offset", "purity"), F.struct("purity", -F.col("angle"), -F.col("n1")))
    return ok.groupBy(field).agg(best.alias("b")).select(field, "b.*")


def along(x: Column, y: Column, theta: Column) -> Column:
    """Position of a point along a direction, to nine decimals."""
    return F.round(x * F.cos(theta) + y * F.sin(theta), 9)


def best_chip(grid: DataFrame, classes: list[Column], cell: int, size: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, top, lft, score): the square of ``size`` cells with the largest smallest class count; ties row-major.

    Window sums are separable: each cell is dealt to the ``size`` origins of its row, then each row
    sum to those of its column. Origins are 0 or more; a chip may overhang the far edges.
    """
    names = [f"n{i}" for i in range(len(classes))]
    at = lambda c: F.floor(F.col(c) / cell).cast("bigint")
    sums = grid.groupBy(*keys, at("r").alias("top"), at("c").alias("lft")).agg(*[F.count_if(k).alias(n) for k, n in zip(classes, names)])
    for axis, other in (("lft", "top"), ("top", "lft")):
        origin = F.explode(F.sequence(F.greatest(F.col(axis) - (size - 1), F.lit(0)), F.col(axis)))
        sums = sums.select(*keys, other, *names, origin.alias(axis)).groupBy(*keys, other, axis).agg(*[F.sum(n).alias(n) for n in names])
    best = sums.select(*keys, "top", "lft", F.least(*names).alias("score"))
    return best.groupBy(*keys).agg(F.max_by(F.struct("top", "lft", "score"), F.struct("score", -F.col("top"), -F.col("lft"))).alias("b")).select(*keys, "b.*")


def tile_apply(tiles: DataFrame, key: str, worker, schema: str) -> DataFrame:
    """Run ``worker(frame) -> frame`` per tile; an error becomes a row of ``status``, not a failed job."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        try:
            return worker(frame).assign(status="ok")
        except Exception as e:  # noqa: BLE001 - isolation of tiles is the feature
            return pd.DataFrame({key: [frame[key].iloc[0]], "status": [f"{type(e).__name__}: {e}"]})

    names = [c.split()[0] for c in schema.split(",")]
    return tiles.groupBy(key).applyInPandas(lambda f: run(f).reindex(columns=[*names, "status"]), f"{schema}, status string")


def tile_retry(tiles: DataFrame, key: str, worker, schema: str, attempts: int = 4, first: float = 3.0, most: float = 30.0, pause=time.sleep) -> DataFrame:
    """``worker(frame, attempt) -> frame`` per tile, tried again after pauses of first * 2^n seconds, ``most`` at most.

    Adds status (ok, or the last error), attempts and the seconds waited; a tile that fails every
    time is a row, not a failed job.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        waited = 0.0
        for attempt in range(attempts):
            try:
                return worker(frame, attempt).assign(status="ok", attempts=attempt + 1, waited=waited)
            except Exception as e:  # noqa: BLE001 - isolation of tiles is the feature
                error = f"{type(e).__name__}: {e}"
            if attempt < attempts - 1:
                seconds = min(most, first * 2**attempt)
                waited += seconds
                pause(seconds)
        return pd.DataFrame({key: [frame[key].iloc[0]], "status": [error], "attempts": [attempts], "waited": [waited]})

    names = [c.split()[0] for c in schema.split(",")]
    return tiles.groupBy(key).applyInPandas(lambda f: run(f).reindex(columns=[*names, "status", "attempts", "waited"]), f"{schema}, status string, attempts int, waited double")
