"""Queries against an independent SQL engine, and unit tests of edges."""

import math
import random
from datetime import date

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from terraframe.functions import dates, series, spectral
from terraframe.operators import compose, evaluate, smooth, spatial
from terraframe.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, (bool, np.bool_, str)):
        return str(v)
    if isinstance(v, date):
        return str(v)[:10]
    return repr(round(float(v), 5) + 0.0)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    names = sorted(got.columns)
    mine = sorted(tuple(map(cell, r)) for r in got.select(*names).collect())
    cursor = duck.execute(f"SELECT {', '.join(names)} FROM ({catalog.ORACLES[name]}) q")
    assert mine == sorted(tuple(map(cell, r)) for r in cursor.fetchall())


def test_whittaker_against_dense_solve(spark):
    rows = [(0, [0.1, None, 0.5, 0.7, None, 0.2, 0.3]), (1, [None] * 7), (2, [0.2, 0.4, 0.1, 0.9, 0.8, 0.3, 0.5]), (3, None), (4, [])]
    got = {r[0]: r[1] for r in spark.createDataFrame(rows, "i int, s array<double>").select("i", smooth.whittaker(0.5)("s")).collect()}
    for i in (0, 2):
        y = np.array([np.nan if v is None else v for v in rows[i][1]])
        w = np.diag(np.isfinite(y).astype(float))
        assert np.allclose(got[i], np.linalg.solve(w + smooth.penalty(7, 0.5), np.nan_to_num(y)))
    assert got[1] == [None] * 7 and got[3] is None and got[4] == []


def test_all_steps_are_smoothed_and_imputed(spark):
    series_of = {r["pixel_id"]: r["z"] for r in catalog.QUERIES["ar2_whittaker_full"](spark, SF).collect()}
    got = {r["pixel_id"]: r["z"] for r in catalog.QUERIES["ar3_whittaker_all_steps"](spark, SF).collect()}
    assert got.keys() == series_of.keys() and all(len(z) == 64 for z in got.values())
    for k, z in got.items():
        assert np.allclose(np.array(z, float), np.array(series_of[k], float), atol=2e-6, equal_nan=True)
    steps = catalog.QUERIES["ag39_mean_imputation"](spark, SF).select("step").distinct().count()
    assert steps == 64
    y = np.array([[0.1, 0.5, 0.2, 0.9, 0.4, 0.3, 0.8], [0.1, np.nan, 0.2, 0.9, np.nan, 0.3, 0.8], [np.nan] * 7])
    frame = spark.createDataFrame([(i, [None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(y)], "i int, s array<double>")
    z = {r["i"]: r["z"] for r in frame.select("i", smooth.smooth_split(F.col("s"), 7, 0.5).alias("z")).collect()}
    for i in (0, 1):
        w = np.diag(np.isfinite(y[i]).astype(float))
        assert np.allclose(z[i], np.linalg.solve(w + smooth.penalty(7, 0.5), np.nan_to_num(y[i])))
    assert z[2] == [None] * 7


def blobs(cells, eight):
    left, out = set(cells), []
    while left:
        todo = [left.pop()]
        blob = set(todo)
        while todo:
            r, c = todo.pop()
            for i in (-1, 0, 1):
                for j in (-1, 0, 1):
                    if (eight or i == 0 or j == 0) and (r + i, c + j) in left:
                        left.discard((r + i, c + j))
                        blob.add((r + i, c + j))
                        todo.append((r + i, c + j))
        out.append(frozenset(blob))
    return set(out)


@pytest.mark.parametrize("eight", [False, True])
def test_components_against_flood_fill(spark, eight):
    rng = random.Random(3)
    cells = [(r, c) for r in range(30) for c in range(30) if rng.random() < 0.55]
    got = {}
    for r, c, k in spatial.components(spark.createDataFrame(cells, "r bigint, c bigint"), eight).select("r", "c", "component").collect():
        got.setdefault(k, set()).add((r, c))
    assert {frozenset(x) for x in got.values()} == blobs(cells, eight)


def test_components_of_nothing(spark):
    assert spatial.components(spark.createDataFrame([], "r bigint, c bigint")).count() == 0


def test_sieve_small_patch_and_strict_undo(spark):
    grid = [(r, c, 1) for r in range(6) for c in range(6)]
    grid = [(r, c, 4 if (r, c) in ((2, 2), (5, 5)) else 255 if (r, c) == (5, 4) else v) for r, c, v in grid]
    df = spark.createDataFrame(grid, "r bigint, c bigint, cls int")
    sieved = spatial.sieve(df, 3)
    got = {(r["r"], r["c"]): (r["sieved"], r["strict"]) for r in spatial.strict_sieve(df, sieved, 1).collect()}
    assert got[2, 2] == (1, 1)
    assert got[5, 5] == (1, 4), "a clump that touches nodata is undone"
    assert got[5, 4] == (255, 255)


def test_phenology_guard_and_gaps(spark):
    rows = [(0, [0.1] * 7), (1, [0.7, None, 0.7, 0.7, 0.1, 0.7, 0.1, 0.1, 0.1, 0.1])]
    got = {r["i"]: r for r in spark.createDataFrame(rows, "i int, s array<double>").select("i", *series.features(F.col("s"))).collect()}
    assert got[0]["amplitude"] is None
    assert got[1]["green_span"] == pytest.approx(0.2)
    assert got[1]["peak_position"] == 0
    with pytest.raises(ValueError):
        series.features(F.col("s"), ["nothing"])


def test_bands_and_features():
    assert spectral.resolve_bands(["B02", "blue", "nir", " B-4 "]) == ["blue", "nir", "red"]
    with pytest.raises(ValueError):
        spectral.resolve_bands([])
    with pytest.raises(ValueError):
        spectral.resolve_bands(["b99"])


def test_windows():
    assert dates.windows(date(2024, 1, 1), date(2024, 1, 12), 8) == [(date(2024, 1, 1), date(2024, 1, 9)), (date(2024, 1, 9), date(2024, 1, 12))]
    assert dates.windows(date(2024, 1, 1), date(2024, 1, 12), 0) == [(date(2024, 1, 1), date(2024, 1, 12))]


def test_unmapped_value_is_an_error(spark):
    with pytest.raises(Exception, match="unmapped"):
        spark.createDataFrame([(7,)], "x int").select(spectral.remap(F.col("x"), {1: 1})).collect()


def test_mosaic_without_usable_observation(spark):
    obs = spark.createDataFrame([(1, 2, 5, False), (2, 1, 6, True), (2, 2, 7, True)], "p int, rank int, red int, ok boolean")
    got = {r["p"]: (r["red"], r["source_rank"]) for r in compose.layered_mosaic(obs, ["p"], "rank", ["red"], F.col("ok")).collect()}
    assert got == {1: (None, 0), 2: (6, 1)}


def test_threshold_ties_and_one_class(spark):
    frame = spark.createDataFrame([(1, 0.9), (1, 0.9), (1, 0.2)], "label int, prob double")
    best = evaluate.best_threshold(evaluate.threshold_table(frame, F.col("label") == 1, "prob", [0.05, 0.1, 0.95])).first()
    assert best["t"] == 0.05
    assert evaluate.roc_auc(frame.withColumn("g", F.lit(1)), ["g"], F.col("label") == 1, "prob").first()["auc"] is None


def test_split_ring():
    a, b = spatial.split_ring([(0, 0), (4, 0), (4, 2), (0, 2)], 0.0, 1.0)
    assert sorted(a) == sorted([(1.0, 0.0), (4, 0), (4, 2), (1.0, 2.0)])
    assert len(b) == 4


def test_tile_failure_is_a_row(spark):
    def worker(frame):
        if frame["t"].iloc[0] == 2:
            raise ValueError("broken")
        return frame[["t"]].assign(n=len(frame))

    got = {r["t"]: r["status"] for r in spatial.tile_apply(spark.createDataFrame([(1,), (1,), (2,)], "t long"), "t", worker, "t long, n long").collect()}
    assert got == {1: "ok", 2: "ValueError: broken"}
