"""Polygons as rings: tracing class regions, width and rectangle tests, parts, rings, well-known binary.

A ring is a closed list of corners; a polygon is its exterior ring and then its holes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 21


def box_ring() -> Column:
    """Closed ring of the columns x0, y0, x1, y1."""
    corner = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))


def boundary_edges(labelled: DataFrame) -> DataFrame:
    """(component, x, y, d): unit sides of cells of (r, c, component) that border another component or none.

    ``d`` is the direction of travel from (x, y) with the cell on the right: 0 east, 1 south, 2 west,
    3 north (rows count southwards). A side shared by two cells of one component occurs twice and
    is dropped; counts are combined before the shuffle.
    """
    side = lambda x, y, d, kx, ky: F.struct(x.alias("x"), y.alias("y"), F.lit(d).alias("d"), kx.alias("kx"), ky.alias("ky"), F.lit(d % 2).alias("up"))
    r, c = F.col("r"), F.col("c")
    sides = F.array(side(c, r, 0, c, r), side(c + 1, r, 1, c + 1, r), side(c + 1, r + 1, 2, c, r + 1), side(c, r + 1, 3, c, r))
    rows = labelled.select("component", F.explode(sides).alias("s")).select("component", "s.*")
    once = rows.groupBy("component", "kx", "ky", "up").agg(F.count(F.lit(1)).alias("n"), F.first("x").alias("x"), F.first("y").alias("y"), F.first("d").alias("d"))
    return once.where("n = 1").select("component", "x", "y", "d")


def stitch(x: np.ndarray, y: np.ndarray, d: np.ndarray, eight: bool) -> list[tuple[list[float], list[float]]]:
    """Closed rings of directed unit sides, corners only.

    Where two rings meet in a point the walk turns right (stays with its cell) under 4-connection
    and left under 8-connection, so that a component has one exterior ring.
    """
    begins: dict[tuple[int, int], dict[int, int]] = {}
    for i, (a, b, k) in enumerate(zip(x.tolist(), y.tolist(), d.tolist())):
        begins.setdefault((a, b), {})[k] = i
    ahead, turns = ((1, 0), (0, 1), (-1, 0), (0, -1)), (3, 0, 1) if eight else (1, 0, 3)
    rings = []
    for start in sorted(begins):
        while begins.get(start):
            at, k = start, min(begins[start])
            xs, ys, last = [], [], None
            while begins.get(at) and k in begins[at]:
                del begins[at][k]
                if k != last:
                    xs.append(float(at[0]))
                    ys.append(float(at[1]))
                last = k
                at = (at[0] + ahead[k][0], at[1] + ahead[k][1])
                k = next((t % 4 for t in (k + turn for turn in turns) if t % 4 in begins.get(at, ())), k)
            rings.append((xs + xs[:1], ys + ys[:1]))
    return rings


def polygonise(labelled: DataFrame, eight: bool = False) -> DataFrame:
    """(component, ring, area, xs, ys): rings of each component; the exterior is ring 0.

    ``labelled`` is the result of ``components`` with the same ``eight``. Areas are positive for
    exteriors and negative for holes, so their sum is the number of cells. A task holds the outline
    of one component, never its cells; an outline has to fit a row in any case.
    """
    kind = labelled.schema["component"].dataType.simpleString()

    def trace(name, frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for xs, ys in stitch(frame["x"].to_numpy(), frame["y"].to_numpy(), frame["d"].to_numpy(), eight):
            u, v = np.array(xs), np.array(ys)
            out.append((float((u[:-1] * v[1:] - u[1:] * v[:-1]).sum() / 2), xs, ys))
        out.sort(key=lambda ring: -ring[0])
        areas, xs, ys = zip(*out)
        return pd.DataFrame({"component": name, "ring": range(len(out)), "area": areas, "xs": xs, "ys": ys})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Sides come sorted by component; the last one of a batch may go on in the next.
        held: list[pd.DataFrame] = []
        for batch in batches:
            if batch.empty:
                continue
            names = batch["component"].to_numpy()
            begins = np.concatenate([[0], np.flatnonzero(names[1:] != names[:-1]) + 1])
            done = []
            for low, high in zip(begins, [*begins[1:], len(names)]):
                part = batch.iloc[low:high]
                if held and held[0]["component"].iloc[0] != names[low]:
                    done.append(pd.concat(held))
                    held = []
                held.append(part)
            if done:
                yield pd.concat([trace(d["component"].iloc[0], d) for d in done])
        if held:
            last = pd.concat(held)
            yield trace(last["component"].iloc[0], last)

    edges = boundary_edges(labelled).repartition("component").sortWithinPartitions("component")
    return edges.mapInPandas(run, f"component {kind}, ring int, area double, xs array<double>, ys array<double>")


def _segments(ring) -> tuple[np.ndarray, np.ndarray]:
    points = np.array([(p["x"], p["y"]) for p in ring], float).reshape(-1, 2)
    return points[:-1], points[1:]


def wider_than(ring, width: float, tolerance: float = 1e-3) -> bool:
    """Whether eroding the ring's inside by ``width`` / 2 leaves anything: its widest circle is larger.

    Squares that cover the ring are halved as long as their centre's distance plus their half
    diagonal can exceed the radius by ``tolerance`` * width; a circle within that of the radius is too narrow.
    """
    if ring is None or len(ring) < 4:
        return False
    a, b = _segments(ring)
    edge, need = b - a, width / 2
    long = np.maximum((edge * edge).sum(1), 1e-300)
    low, high = a.min(0), a.max(0)
    half = float((high - low).max()) / 2
    if float((high - low).min()) / 2 <= need * (1 + tolerance):
        return False
    todo = ((low + high) / 2)[None]
    while len(todo) and half > 0:
        keep = []
        for part in np.array_split(todo, max(1, len(todo) * len(a) // CHUNK)):
            off = part[:, None] - a[None]
            t = np.clip((off * edge).sum(2) / long, 0, 1)
            far = np.sqrt(((off - t[..., None] * edge) ** 2).sum(2).min(1))
            above = (a[None, :, 1] > part[:, 1:]) != (b[None, :, 1] > part[:, 1:])
            with np.errstate(divide="ignore", invalid="ignore"):
                cross = a[None, :, 0] + (part[:, 1:] - a[None, :, 1]) * (edge[:, 0] / edge[:, 1])
            inside = (above & (part[:, :1] < cross)).sum(1) % 2 == 1
            far = np.where(inside, far, -far)
            if (far > need * (1 + tolerance)).any():
                return True
            keep.append(part[far + half * 2**0.5 > need * (1 + tolerance)])
        half /= 2
        steps = np.array([(i, j) for i in (-half, half) for j in (-half, half)])
        todo = (np.concatenate(keep)[:, None] + steps[None]).reshape(-1, 2)
    return False


def field_like(rings: str, width: float) -> Column:
    """``wider_than`` of a column of rings, in Arrow batches; null and short rings are not."""

    @F.pandas_udf("boolean")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda ring: wider_than(ring, width)).astype(bool)

    return run(F.col(rings))


def smallest_rectangle(points: np.ndarray) -> tuple[float, float, float]:
    """(long side, short side, direction of the long side in [0, pi)) of the least enclosing rectangle.

    One of its sides lies along a side of the convex hull; ties go to the smallest direction.
    """
    unique = sorted(set(map(tuple, points.tolist())))
    hull: list = []
    for ordered in (unique, unique[::-1]):
        chain: list = []
        for p in ordered:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (p[1] - chain[-2][1]) <= (chain[-1][1] - chain[-2][1]) * (p[0] - chain[-2][0]):
                chain.pop()
            chain.append(p)
        hull += chain[:-1]
    if len(hull) < 3:
        return (0.0, 0.0, 0.0) if len(unique) < 2 else (float(np.hypot(*np.subtract(unique[-1], unique[0]))), 0.0, float(np.arctan2(*np.subtract(unique[-1], unique[0])[::-1]) % np.pi))
    corners = np.array(hull)
    sides = np.roll(corners, -1, 0) - corners
    angle = np.unique(np.round(np.arctan2(sides[:, 1], sides[:, 0]) % (np.pi / 2), 12))
    along = corners @ np.array([np.cos(angle), np.sin(angle)])
    across = corners @ np.array([-np.sin(angle), np.cos(angle)])
    w, h = np.ptp(along, axis=0), np.ptp(across, axis=0)
    best = int(np.argmin(np.round(w * h, 9)))
    turned = h[best] > w[best]
    return float(max(w[best], h[best])), float(min(w[best], h[best])), float((angle[best] + (np.pi / 2 if turned else 0)) % np.pi)


def rectangle(rings: str) -> Column:
    """struct(long_side, short_side, theta) of a column of rings; null for null and empty ones."""

    @F.pandas_udf("long_side double, short_side double, theta double")
    def run(column: pd.Series) -> pd.DataFrame:
        got = [smallest_rectangle(np.array([(p["x"], p["y"]) for p in ring])) if ring is not None and len(ring) else (None,) * 3 for ring in column]
        return pd.DataFrame(got, columns=["long_side", "short_side", "theta"], dtype=float)

    return run(F.col(rings))


def ring_measures(ring: str) -> tuple[Column, Column]:
    """(area, length) of a closed ring of structs; area is not signed."""
    from .spatial import ring_area, ring_length

    xs, ys = F.col(ring)["x"], F.col(ring)["y"]
    return F.abs(ring_area(xs, ys)), ring_length(xs, ys)


def halves(ring: Column, theta: Column, offset: Column) -> Column:
    """struct(above, below): both parts of a closed ring cut by x cos(theta) + y sin(theta) = offset; NULL for an empty part.

    A part of a ring that is not convex may touch itself along the line.
    """
    n = F.size(ring) - 1
    point = lambda x, y: F.array(F.struct(x.alias("x"), y.alias("y")))
    none = F.array().cast("array<struct<x:double,y:double>>")

    def part(sign: int) -> Column:
        far = F.transform(ring, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), (sign * (p["x"] * F.cos(theta) + p["y"] * F.sin(theta) - offset)).alias("d")))

        def side(a: Column, b: Column) -> Column:
            t = a["d"] / (a["d"] - b["d"])
            cross = point(a["x"] + t * (b["x"] - a["x"]), a["y"] + t * (b["y"] - a["y"]))
            return F.concat(F.when(a["d"] >= 0, point(a["x"], a["y"])).otherwise(none), F.when(a["d"] * b["d"] < 0, cross).otherwise(none))

        points = F.flatten(F.zip_with(F.slice(far, F.lit(1), n), F.slice(far, F.lit(2), n), side))
        return F.when(F.size(points) >= 3, F.concat(points, F.slice(points, 1, 1)))

    return F.when(F.size(ring) >= 4, F.struct(part(1).alias("above"), part(-1).alias("below")))


def field_shaped(polygons: DataFrame, ring: str, least_area: float, width: float, rectangularity: float = 0.45, compact: float = 0.18) -> DataFrame:
    """Polygons that are large, wide, rectangular and compact enough.

    Cheap tests on columns come first; the rectangle and the width are computed for what is left.
    """
    from .spatial import compactness

    area, length = ring_measures(ring)
    left = polygons.withColumns({"area": area, "length": length}).where(F.col("area") >= least_area)
    left = left.where(compactness(F.col("area"), F.col("length")) >= compact).withColumn("_box", rectangle(ring))
    left = left.where(F.try_divide(F.col("area"), F.col("_box.long_side") * F.col("_box.short_side")) >= rectangularity)
    return left.where(field_like(ring, width)).drop("_box")


def crosses_itself(ring) -> bool:
    """Whether two sides of a closed ring that are not neighbours meet."""
    a, b = _segments(ring)
    n, edge = len(a), b - a
    turn = lambda p, q, r: (q[..., 0] - p[..., 0]) * (r[..., 1] - p[..., 1]) - (q[..., 1] - p[..., 1]) * (r[..., 0] - p[..., 0])
    for i in range(n - 2):
        j = np.arange(i + 2, n - 1 if i == 0 else n)
        one, two = turn(a[i], b[i], a[j]), turn(a[i], b[i], b[j])
        three, four = turn(a[j], b[j], a[i]), turn(a[j], b[j], b[i])
        apart = (np.maximum(a[i], b[i]) < np.minimum(a[j], b[j])).any(-1) | (np.maximum(a[j], b[j]) < np.minimum(a[i], b[i])).any(-1)
        if ((one * two <= 0) & (three * four <= 0) & ~apart).any():
            return True
    return bool(((edge == 0).all(1)).any())


def ring_problem(rings: str) -> Column:
    """What is wrong with a ring: empty, open, no area, crossing; NULL for a sound one."""

    @F.pandas_udf("boolean")
    def crossing(column: pd.Series) -> pd.Series:
        return column.map(lambda ring: ring is not None and len(ring) >= 4 and crosses_itself(ring)).astype(bool)

    ring = F.col(rings)
    area = ring_measures(rings)[0]
    return F.when(F.coalesce(F.size(ring), F.lit(0)) < 1, "empty").when((F.size(ring) < 4) | (F.element_at(ring, 1) != F.element_at(ring, -1)), "open").when(area == 0, "no area").when(crossing(ring), "crossing")


def single_parts(polygons: DataFrame, parts: str) -> DataFrame:
    """One row a part of a multipart column, ``part`` its position; null, open and too short rings go."""
    rows = polygons.select(*[c for c in polygons.columns if c != parts], F.posexplode(parts).alias("part", "ring"))
    first, last = F.try_element_at("ring", F.lit(1)), F.try_element_at("ring", F.lit(-1))
    return rows.where((F.size("ring") >= 4) & (first == last))


def holes(polygons: DataFrame, rings: str) -> DataFrame:
    """Interior rings as polygons of their own, ``hole`` from 1."""
    rest = F.when(F.size(rings) > 1, F.slice(rings, 2, F.greatest(F.size(rings) - 1, F.lit(0))))
    return polygons.select(*[c for c in polygons.columns if c != rings], F.posexplode(rest).alias("_p", "ring")).withColumn("hole", F.col("_p") + 1).drop("_p")


def to_wkb(ring: str) -> Column:
    """Little-endian well-known binary of a polygon of one ring."""

    @F.pandas_udf("binary")
    def run(column: pd.Series) -> pd.Series:
        head = struct.Struct("<BIII")
        return column.map(lambda r: None if r is None else head.pack(1, 3, 1, len(r)) + np.array([(p["x"], p["y"]) for p in r], "<f8").tobytes())

    return run(F.col(ring))


def wkb_bounds(data: bytes | None) -> tuple:
    """(x0, y0, x1, y1) of a well-known-binary polygon or multipolygon in either byte order; None if it is neither."""
    if not data:
        return (None,) * 4
    found: list[np.ndarray] = []

    def shape(at: int) -> int:
        order = "<" if data[at] == 1 else ">"
        kind, n = struct.unpack_from(order + "II", data, at + 1)
        at += 9
        if kind % 1000 == 6:
            for _ in range(n):
                at = shape(at)
        elif kind % 1000 == 3:
            for _ in range(n):
                (m,) = struct.unpack_from(order + "I", data, at)
                found.append(np.frombuffer(data, order + "f8", 2 * m, at + 4).reshape(-1, 2))
                at += 4 + 16 * m
        else:
            raise ValueError(f"geometry of kind {kind}")
        return at

    try:
        shape(0)
    except (ValueError, IndexError, struct.error):
        return (None,) * 4
    points = np.concatenate(found) if found else np.zeros((0, 2))
    return (*points.min(0).tolist(), *points.max(0).tolist()) if len(points) else (None,) * 4


def bounds_of_wkb(column: str) -> Column:
    """struct(x0, y0, x1, y1) of a binary column, in Arrow batches."""

    @F.pandas_udf("x0 double, y0 double, x1 double, y1 double")
    def run(data: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([wkb_bounds(v) for v in data], columns=["x0", "y0", "x1", "y1"], dtype=float)

    return run(F.col(column))


def geojson_bounds(text: str) -> Column:
    """struct(x0, y0, x1, y1) of the polygon of a GeoJSON geometry or feature; null if there is none."""
    rings = F.coalesce(
        F.from_json(F.get_json_object(text, "$.geometry.coordinates"), "array<array<array<double>>>"),
        F.from_json(F.get_json_object(text, "$.coordinates"), "array<array<array<double>>>"),
    )
    points = F.flatten(rings)
    axis = lambda i: F.transform(points, lambda p: p[i])
    box = F.struct(F.array_min(axis(0)).alias("x0"), F.array_min(axis(1)).alias("y0"), F.array_max(axis(0)).alias("x1"), F.array_max(axis(1)).alias("y1"))
    return F.when(F.size(points) > 0, box)
