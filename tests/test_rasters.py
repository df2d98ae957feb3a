"""Components against a flood fill, block tables, running totals, series with odd values, projection."""

import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from terraframe.functions import series
from terraframe.operators import evaluate, spatial
from terraframe.plans import catalog, rasters
from terraframe.sources import blocks, sinks


def flood(cells, eight):
    steps = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (eight or i == 0 or j == 0)]
    label = {}
    for start in sorted(cells):
        if start in label:
            continue
        stack = [start]
        label[start] = start
        while stack:
            r, c = stack.pop()
            for i, j in steps:
                near = (r + i, c + j)
                if cells.get(near) == cells[r, c] and near not in label:
                    label[near] = start
                    stack.append(near)
    return {k: (r << 32) + c for k, (r, c) in label.items()}


@pytest.mark.parametrize("eight", [False, True])
def test_components_across_tiles(spark, eight):
    rng = random.Random(3)
    cells = {(r, c): rng.randrange(2) for r in range(23) for c in range(19) if rng.random() < 0.9}
    cells |= {(40, c): 1 for c in range(30)} | {(r, 29): 1 for r in range(30, 41)}  # one long blob over many tiles
    frame = spark.createDataFrame([(r, c, v) for (r, c), v in cells.items()], "r long, c long, k int")
    got = {(x["r"], x["c"]): x["component"] for x in spatial.components(frame, eight, value="k", tile=7).collect()}
    assert got == flood(cells, eight)
    assert spatial.components(frame.limit(0), eight).count() == 0


def test_blocks_round_trip(spark, tmp_path):
    rows = [(0, 0, 5.5), (3, 7, None), (9, 2, 0.25), (300, 301, -2.0)]
    frame = spark.createDataFrame(rows, "r long, c long, x double")
    blocks.write_blocks(frame, f"file://{tmp_path}/b", "x", "float32", 8)
    read = lambda r, c: {tuple(x) for x in blocks.read_window(spark, f"file://{tmp_path}/b", r, c, 8).collect()}
    assert read((0, 1000), (0, 1000)) == {r for r in rows if r[2] is not None}
    assert read((1, 301), (2, 302)) == {(9, 2, 0.25), (300, 301, -2.0)}
    assert read((1, 9), (0, 8)) == set()


def test_layers_are_joined_by_tile(spark, tmp_path):
    rng = random.Random(11)
    one = {(rng.randrange(-20, 50), rng.randrange(40)): rng.randrange(200) for _ in range(600)}
    two = {k: rng.random() for k in [*rng.sample(sorted(one), 300), (900, 900)]}
    paths = {n: f"file://{tmp_path}/{n}" for n in "ab"}
    blocks.write_blocks(spark.createDataFrame([(r, c, v) for (r, c), v in one.items()], "r long, c long, v long"), paths["a"], "v", "uint8", 8)
    blocks.write_blocks(spark.createDataFrame([(r, c, v) for (r, c), v in two.items()], "r long, c long, v double"), paths["b"], "v", "float32", 8)
    both = blocks.read_layers(spark, paths, (-13, 1000), (3, 1000), 8)
    expected = {k: (one[k], pytest.approx(v, abs=1e-6)) for k, v in two.items() if k in one and k[0] >= -13 and k[1] >= 3}
    assert {(x["r"], x["c"]): (x["a"], x["b"]) for x in both.collect()} == expected


def test_box_words(spark):
    rng = random.Random(4)
    boxes = [(i, x, y, x + rng.choice([0, 1, 9, 64, 128, 200]), y + rng.randrange(4)) for i, (x, y) in enumerate((rng.randrange(-130, 130), rng.randrange(-3, 3)) for _ in range(60))]
    boxes += [(60, 0, 0, 64, 1), (61, 64, 5, 60, 6), (62, None, 0, 5, 5), (63, 0, 0, None, 5)]
    got: dict = {}
    for k, w, y, bits in spatial.box_words(spark.createDataFrame(boxes, "k int, x0 long, y0 long, x1 long, y1 long"), "k").collect():
        got.setdefault(k, []).extend((w * 64 + b, y) for b in range(64) if bits >> b & 1)
    expected = {k: sorted((x, y) for x in range(x0, x1) for y in range(y0, y1)) for k, x0, y0, x1, y1 in boxes if None not in (x0, x1)}
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in expected.items() if v}


@pytest.mark.parametrize("name", ["jn7_carved_area", "sk4_label_and_probability"])
def test_cells_are_not_broadcast(spark, name):
    """Estimated sizes are those of boxes and packed files, far below those of their cells."""
    found = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_carving_of_odd_boxes(spark, tmp_path):
    """Repeated, negative and null keys; a null nation leaves no box but still cuts."""
    rows = [(k, k % 25) for k in (0, 0, 1, 39, 40, 41, 6, 46)] + [(-1, 4), (-40, 3), (None, 2), (7, None), (80, None)]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    got = {tuple(r) for r in catalog.QUERIES["jn7_carved_area"](spark, str(tmp_path)).select("field_id", "area").collect()}
    con = duckdb.connect()
    con.execute(f"create view customer as select * from read_parquet('{tmp_path}/customer.parquet/*.parquet')")
    assert got == set(con.execute(catalog.ORACLES["jn7_carved_area"]).fetchall()) and len(got) == 9


def test_running_totals(spark):
    rng = random.Random(9)
    rows = [(k / 97, rng.randrange(4), rng.randrange(4)) for k in range(97)]
    frame = spark.createDataFrame(rows, "p double, pos long, neg long").repartition(6)
    got = {r["p"]: (r["run_pos"], r["run_neg"], r["all_pos"]) for r in evaluate.running_totals(frame, "p", ["pos", "neg"]).collect()}
    assert got == {p: (sum(a for q, a, _ in rows if q >= p), sum(b for q, _, b in rows if q >= p), sum(a for _, a, _ in rows)) for p, _, _ in rows}


def test_series_with_values_that_are_no_numbers(spark):
    nan, inf = float("nan"), float("inf")
    odd, clean = [0.1] * 8 + [nan, nan, nan, inf, -inf], [0.1] * 8 + [None] * 5
    frame = spark.createDataFrame([(1, odd), (2, clean)], "k int, s array<double>")
    one, two = frame.select("k", *series.features(F.col("s"))).orderBy("k").collect()
    assert one[1:] == two[1:]
    assert one["green_span"] == one["fraction_above_green"] == 0 and one["ndvi_max"] == 0.1


def test_retries(spark):
    def worker(frame, attempt):
        if attempt < frame["k"].iloc[0]:
            raise ValueError("not yet")
        return frame

    rows = spark.createDataFrame([(0,), (2,), (9,)], "k long")
    got = {r["k"]: (r["status"], r["attempts"], r["waited"]) for r in spatial.tile_retry(rows, "k", worker, "k long", 4, pause=lambda s: None).collect()}
    assert got == {0: ("ok", 1, 0.0), 2: ("ok", 3, 9.0), 9: ("ValueError: not yet", 4, 21.0)}


def test_reprojection(spark):
    """Against the older series in the eccentricity, and the arc of the meridian."""
    a, f, k0 = 6378137.0, 1 / 298.257223563, 0.9996
    e2 = f * (2 - f)

    def expected(lon, lat):
        p, turn = math.radians(lat), math.radians(lon - 69)
        ep, n = e2 / (1 - e2), a / math.sqrt(1 - e2 * math.sin(p) ** 2)
        t, c, x = math.tan(p) ** 2, ep * math.cos(p) ** 2, turn * math.cos(p)
        steps = 20_000
        m = sum(a * (1 - e2) / (1 - e2 * math.sin((i + 0.5) * p / steps) ** 2) ** 1.5 for i in range(steps)) * p / steps
        east = k0 * n * (x + (1 - t + c) * x**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep) * x**5 / 120) + 500000
        north = k0 * (m + n * math.tan(p) * (x * x / 2 + (5 - t + 9 * c + 4 * c * c) * x**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep) * x**6 / 720))
        return east, north

    points = [(69.0, 24.0), (67.2, 30.5), (71.9, 33.3), (66.1, 0.5)]
    frame = spark.createDataFrame(points, "lon double, lat double")
    for r in frame.select("lon", "lat", *[c.alias(n) for n, c in zip("en", rasters.to_utm(F.col("lon"), F.col("lat"), 42))]).collect():
        assert (r["e"], r["n"]) == pytest.approx(expected(r["lon"], r["lat"]), abs=0.02)


def test_first_that_opens(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/b")
    assert sinks.first_that_opens(spark, [f"{tmp_path}/a", f"{tmp_path}/b"]).count() == 3
    with pytest.raises(FileNotFoundError):
        sinks.first_that_opens(spark, [f"{tmp_path}/a"])
