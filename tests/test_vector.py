"""Rings traced from cells, width and rectangle tests, well-known binary, resumable sinks."""

import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from terraframe.operators import spatial, vector
from terraframe.sources import sinks


def inside(x, y, xs, ys):
    hit = False
    for i in range(len(xs) - 1):
        if (ys[i] > y) != (ys[i + 1] > y) and x < xs[i] + (y - ys[i]) * (xs[i + 1] - xs[i]) / (ys[i + 1] - ys[i]):
            hit = not hit
    return hit


@pytest.mark.parametrize("eight", [False, True])
def test_rings_enclose_exactly_their_cells(spark, eight):
    rng = random.Random(5)
    cells = [(r, c) for r in range(16) for c in range(16) if rng.random() < 0.6]
    labelled = spatial.components(spark.createDataFrame(cells, "r bigint, c bigint"), eight).cache()
    members, rings = {}, {}
    for r, c, k in labelled.select("r", "c", "component").collect():
        members.setdefault(k, set()).add((r, c))
    for x in vector.polygonise(labelled, eight).collect():
        rings.setdefault(x["component"], []).append(x)
    assert members.keys() == rings.keys()
    for k, found in rings.items():
        assert sum(x["area"] for x in found) == len(members[k])
        assert [x["area"] > 0 for x in sorted(found, key=lambda x: x["ring"])] == [True] + [False] * (len(found) - 1)
        got = {(r, c) for r in range(16) for c in range(16) if sum(inside(c + 0.5, r + 0.5, x["xs"], x["ys"]) for x in found) % 2}
        assert got == members[k]


def test_outlines_over_many_batches(spark):
    rng = random.Random(4)
    cells = spark.createDataFrame([(r, c) for r in range(25) for c in range(25) if rng.random() < 0.55], "r long, c long")
    labelled = spatial.components(cells)
    whole = sorted(map(str, vector.polygonise(labelled).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(str, vector.polygonise(labelled).collect())) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(whole) > 20


def test_polygonise_nothing(spark):
    assert vector.polygonise(spark.createDataFrame([], "r bigint, c bigint, component string")).count() == 0


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in (*points, points[0])]


def test_width_of_shapes():
    square = ring((0, 0), (10, 0), (10, 10), (0, 10))
    assert vector.wider_than(square, 9.9) and not vector.wider_than(square, 10)
    ell = ring((0, 0), (20, 0), (20, 3), (3, 3), (3, 20), (0, 20))
    assert vector.wider_than(ell, 3.4) and not vector.wider_than(ell, 3.6)  # widest at the bend: 3 * 2 / (1 + 1 / sqrt 2)
    assert not vector.wider_than(None, 1) and not vector.wider_than([], 1) and not vector.wider_than(ring((0, 0), (5, 0), (9, 0)), 0.5)


def test_rectangle_of_turned_points():
    turn = np.array([[np.cos(0.3), np.sin(0.3)], [-np.sin(0.3), np.cos(0.3)]])
    got = vector.smallest_rectangle(np.array([(0, 0), (8, 0), (8, 3), (0, 3), (4, 1)]) @ turn)
    assert got == pytest.approx((8, 3, 0.3))
    assert vector.smallest_rectangle(np.zeros((0, 2))) == (0, 0, 0) and vector.smallest_rectangle(np.ones((3, 2))) == (0, 0, 0)
    assert vector.smallest_rectangle(np.array([(0.0, 0.0), (0.0, 2.0)]))[:2] == (2, 0)


def test_bounds_of_binary_and_text(spark):
    points = [(1.0, 2.0), (4.0, 2.0), (4.0, 7.0), (1.0, 2.0)]
    for order, mark in (("<", 1), (">", 0)):
        polygon = struct.pack(order + "BII", mark, 3, 1) + struct.pack(order + "I", 4) + np.array(points, order + "f8").tobytes()
        many = struct.pack(order + "BII", mark, 6, 1) + polygon
        assert vector.wkb_bounds(polygon) == vector.wkb_bounds(many) == (1, 2, 4, 7)
    assert vector.wkb_bounds(None) == vector.wkb_bounds(b"") == vector.wkb_bounds(b"\1\1") == (None,) * 4
    rows = [(None,), ("",), ("no json",), ('{"type":"Polygon","coordinates":[]}',), ('{"type":"Polygon","coordinates":[[[1,2],[4,2],[4,7],[1,2]]]}',)]
    got = [r["b"] for r in spark.createDataFrame(rows, "t string").select(vector.geojson_bounds("t").alias("b")).collect()]
    assert got[:4] == [None] * 4 and tuple(got[4]) == (1, 2, 4, 7)


def test_parts_and_holes_of_missing_values(spark):
    kind = "i int, p array<array<struct<x:double,y:double>>>"
    box = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]
    df = spark.createDataFrame([(1, None), (2, []), (3, [box, None, box[:2]]), (4, [box, box])], kind)
    assert sorted((r["i"], r["part"]) for r in vector.single_parts(df, "p").collect()) == [(3, 0), (4, 0), (4, 1)]
    assert [(r["i"], r["hole"]) for r in vector.holes(df.where("i <> 3"), "p").collect()] == [(4, 1)]


def test_resumed_run_writes_each_key_once(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    rows = spark.range(20).select((F.col("id") % 4).alias("tile"), F.col("id").alias("v"))
    assert sinks.write_missing(rows.where("tile < 2"), path, "tile").count() == 10
    rows.where("tile = 2").withColumn("v", F.lit(0).cast("bigint")).write.parquet(f"{path}/rows/run=stopped")  # no manifest
    assert sorted(r["v"] for r in sinks.write_missing(rows, path, "tile").collect()) == list(range(20))
    assert sinks.write_missing(rows, path, "tile").count() == 20
