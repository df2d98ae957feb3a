"""Stored models against a walk in Python, checks and caps, layer chains, cut rings, discovery."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from terraframe.functions import spectral
from terraframe.operators import inference, spatial, stats, vector
from terraframe.sources import sinks


def grow(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        return {"leaf": rng.uniform(-1, 1)}
    return {"feature": rng.randrange(3), "cut": rng.uniform(0, 1), "below": grow(rng, depth - 1), "above": grow(rng, depth - 1)}


def reach(tree, x):
    while "leaf" not in tree:
        tree = tree["below"] if x[tree["feature"]] < tree["cut"] else tree["above"]
    return tree["leaf"]


@pytest.mark.parametrize("forest", [False, True])
def test_trees_against_a_walk(spark, forest):
    rng = random.Random(5)
    trees = [grow(rng, 5) for _ in range(9)] + [{"leaf": 0.25}]
    rows = [(i, *(rng.random() for _ in range(3))) for i in range(300)]
    frame = spark.createDataFrame(rows, "i int, a double, b double, c double")
    got = {r["i"]: r["p"] for r in frame.select("i", inference.tree_score([F.col(x) for x in "abc"], trees, forest).alias("p")).collect()}
    for i, *x in rows:
        total = sum(reach(t, x) for t in trees)
        assert math.isclose(got[i], total / len(trees) if forest else 1 / (1 + math.exp(-total)))


def test_pixels_out_of_use_are_nodata(spark):
    rows = [(1, 0.9, True), (2, 0.1, True), (3, None, True), (4, float("nan"), True), (5, float("inf"), True), (6, 0.9, False), (7, 0.9, None), (8, 0.5, True)]
    frame = spark.createDataFrame(rows, "i int, x double, ok boolean")
    tree = [{"feature": 0, "cut": 0.5, "below": {"leaf": 0.2}, "above": {"leaf": 0.6}}]
    got = {r["i"]: (r["cls"], r["prob"]) for r in inference.classify(frame, [F.col("x")], tree, 0.6, F.col("ok"), forest=True).collect()}
    assert got[1] == (1, 0.6) and got[2] == (4, 0.2) and got[8] == (1, 0.6)
    assert all(got[i] == (255, None) for i in (3, 4, 5, 6, 7))
    assert inference.classify(frame.limit(0), [F.col("x")], tree).count() == 0


def test_domain_check_refuses_and_samples(spark):
    train = spark.range(1000).select((F.col("id") % 2 + 0).alias("label"), (F.col("id") % 100 + 1).cast("double").alias("x"))
    table = stats.quantile_table(train, ["x"], F.when(F.col("label") == 1, "positive").otherwise("negative"))
    scene = spark.range(2000).select("id", (F.col("id") % 100 + 401).cast("double").alias("x"))
    check = lambda s, **k: inference.check_scene(s, ["id"], {"x": F.col("x")}, table, F.lit(True), **k).first()
    assert check(scene)["verdict"] == "refuse" and check(scene)["role"] == "pooled"
    assert check(scene.withColumn("x", F.col("x") - 400), mask=F.col("id") >= 0)["verdict"] == "ok"
    with pytest.raises(Exception, match="distribution shift"):
        check(scene, enforce=True)
    part = inference.domain_sample(scene, ["id"], 500)
    assert 400 < part.count() < 600 and part.select("id").collect() == inference.domain_sample(scene, ["id"], 500).select("id").collect()
    assert inference.domain_sample(scene, ["id"], 2000).count() == 2000


def test_labelled_pixels_and_cap(spark):
    squares = spark.range(100).select((F.col("id") / 10).cast("int").alias("r"), (F.col("id") % 10).cast("int").alias("c"))
    squares = squares.select("r", "c", F.col("c").alias("x0"), F.col("r").alias("y0"), (F.col("c") + 1).alias("x1"), (F.col("r") + 1).alias("y1"))
    boxes = spark.createDataFrame([(1.5, 1.5, 5.0, 5.0), (4.0, 4.0, 7.5, 6.0)], "x0 double, y0 double, x1 double, y1 double")
    got = {(r["r"], r["c"]): r["label"] for r in inference.labelled_pixels(squares, boxes, ["r", "c"], 4).collect()}
    for r in range(10):
        for c in range(10):
            whole = (2 <= c <= 4 and 2 <= r <= 4) or (4 <= c <= 6 and 4 <= r <= 5)
            touch = (1 <= c <= 4 and 1 <= r <= 4) or (4 <= c <= 7 and 4 <= r <= 5)
            assert got.get((r, c)) == (1 if whole else None if touch else 4)
    capped = inference.labelled_pixels(squares, boxes, ["r", "c"], 4, most=5).groupBy("label").count().collect()
    assert sorted(map(tuple, capped)) == [(1, 5), (4, 5)]
    assert inference.labelled_pixels(squares, boxes.limit(0), ["r", "c"], 4).count() == 100


def test_layers_are_matched_through_one_another(spark):
    days = [date(2025, 1, k) for k in (1, 2, 3, 4)]
    true = {0: lambda x: x, 1: lambda x: (x - 50) / 0.8, 2: lambda x: (x + 30) / 1.25, 3: lambda x: x + 7}
    spans = [range(0, 600), range(150, 900), range(650, 1200), range(1195, 1300)]
    rows = [(p, days[k], float(true[k](200 + (p * 37) % 1000)), k) for k, span in enumerate(spans) for p in span]
    obs = spark.createDataFrame(rows, "p int, day date, red double, n int")
    found = inference.match_layers(obs, days, ["p"], "day", ["red"], F.lit(True), "n", least=200)
    assert [(x[0], x[4], x[5]) for x in found] == [(days[1], days[0], 450), (days[2], days[1], 250)]
    for (_, _, gain, shift, *_), (g, s) in zip(found, ((0.8, 50), (1.25, -30))):
        assert math.isclose(gain, g, rel_tol=1e-9) and math.isclose(shift, s, rel_tol=1e-6)
    image = {r["p"]: (r["red"], r["source_rank"]) for r in inference.layered_image(obs, days, ["p"], "day", ["red"], F.lit(True), found).collect()}
    for p, (red, rank) in image.items():
        first = next(k for k, span in enumerate(spans) if p in span)
        assert rank == first + 1 and math.isclose(red, 200 + (p * 37) % 1000 + (7 if first == 3 else 0), rel_tol=1e-9)


def test_halves_against_split_ring(spark):
    rng = random.Random(9)
    rows = []
    for i in range(40):
        turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randrange(3, 9)))
        rows.append((i, [(5 * math.cos(t), 5 * math.sin(t)) for t in turns], rng.uniform(0, math.pi), rng.uniform(-6, 6)))
    frame = spark.createDataFrame([(i, [*ring, ring[0]], a, b) for i, ring, a, b in rows] + [(99, None, 0.0, 0.0)], "i int, ring array<struct<x:double,y:double>>, a double, b double")
    got = {r["i"]: r["h"] for r in frame.select("i", vector.halves(F.col("ring"), F.col("a"), F.col("b")).alias("h")).collect()}
    assert got[99] is None
    for i, ring, a, b in rows:
        for mine, want in zip(got[i], spatial.split_ring(ring, a, b)):
            points = [tuple(p) for p in mine][:-1] if mine else []
            assert len(points) == len(want) and all(math.dist(p, q) < 1e-9 for p, q in zip(points, want))


def test_discovery_fails_for_required_artifacts(spark):
    base = sinks.shared_folder(spark, "found")
    spark.range(1).write.parquet(f"{base}/x_map")
    assert sinks.discover(spark, base, {"map": ("*_map",)})["map"].endswith("/x_map")
    with pytest.raises(FileNotFoundError, match="_mask"):
        sinks.discover(spark, base, {"mask": ("*_mask", "*_masks")})


def test_bands():
    assert spectral.split_bands(["B4", "nir", "ndvi"]) == (["red", "nir"], ["ndvi"], ["red", "nir", "ndvi"])
    assert spectral.split_bands(["NBR"]) == (["nir", "swir22"], ["nbr"], ["nbr"])
    assert spectral.provider_assets("mpc", spectral.resolve_bands(["B 8A", "watervapour"])) == ["B8A", "B09"]
    for wrong in ([], ["b99"]):
        with pytest.raises(ValueError):
            spectral.split_bands(wrong)
    assert spectral.source_columns(["k", "B8", "B2"]) == ["B2", "B8"]
    for columns, wanted in ((["k"], None), (["B2"], ["B2", "B3"])):
        with pytest.raises(ValueError):
            spectral.source_columns(columns, wanted)


def test_series_inference_against_numpy(spark):
    import numpy as np

    from terraframe.operators import smooth
    from terraframe.plans import catalog, passes
    from terraframe.sources import fixtures

    sf = "/root/testdata/sf0.001"
    rows = fixtures.load(spark, sf, "series").select("pixel_id", "s").collect()
    got = catalog.QUERIES["ep5_series_inference"](spark, sf)
    assert got.columns == ["pixel_id", "tile", "cls"]
    got = {r["pixel_id"]: r["cls"] for r in got.collect()}
    assert len(got) == len(rows)
    for pixel, s in rows:
        y = np.array([np.nan if v is None else v for v in s])
        z = np.clip(np.linalg.solve(np.diag(np.isfinite(y).astype(float)) + smooth.penalty(len(y), 0.5), np.nan_to_num(y)), 0, 1)
        score = sum(reach(t, [z[21], z[24], z[30]]) for t in passes.FOREST) / 2
        assert got[pixel] == (1 if score >= 0.5 else 4)


def test_rings_that_cross_themselves(spark):
    rng = random.Random(2)

    def crossing(ring):
        def turn(p, q, r):
            return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

        n = len(ring)
        sides = [(ring[i], ring[(i + 1) % n]) for i in range(n)]
        return any(turn(*sides[i], sides[j][0]) * turn(*sides[i], sides[j][1]) < 0 and turn(*sides[j], sides[i][0]) * turn(*sides[j], sides[i][1]) < 0 for i in range(n) for j in range(i + 1, n) if (j - i) % n not in (1, n - 1))

    rows = [(i, [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(rng.randrange(3, 7))]) for i in range(200)]
    frame = spark.createDataFrame([(i, [*ring, ring[0]]) for i, ring in rows] + [(900, None), (901, []), (902, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])], "i int, ring array<struct<x:double,y:double>>")
    got = {r["i"]: r["p"] for r in frame.select("i", vector.ring_problem("ring").alias("p")).collect()}
    assert got[900] == got[901] == "empty" and got[902] == "open"
    assert {got[i] for i, _ in rows} == {None, "crossing"} and all((got[i] == "crossing") == crossing(ring) for i, ring in rows)


def test_labels_of_small_and_empty_fields(spark):
    from terraframe.operators import labelling

    ring = lambda x, w: [(x, 0.0), (x + w, 0.0), (x + w, 10.0), (x, 10.0), (x, 0.0)]
    fields = spark.createDataFrame([(1, ring(0.0, 10.0)), (2, ring(20.0, 10.0)), (3, ring(40.0, 20.0))], "field_id int, ring array<struct<x:double,y:double>>")
    cells = [(2, 20.5 + i, 0.5, True) for i in range(9)] + [(3, 40.5 + i, 0.5 + j, i < 7) for i in range(20) for j in range(10)]
    pixels = spark.createDataFrame(cells, "field_id int, x double, y double, crop boolean")
    got = {(r["field_id"], r["part"]): r for r in labelling.label_fields(pixels, fields, 5.0, 10.0).collect()}
    assert got.keys() == {(1, 0), (2, 0), (3, 1), (3, 2)}
    assert got[1, 0]["decision"] == got[2, 0]["decision"] == "too small to judge" and got[2, 0]["crop_fraction"] is None
    assert got[3, 2]["crop_fraction"] == 1.0 and got[3, 1]["crop_fraction"] == 0.0 and got[3, 1]["pixels"] == 130
    assert got[3, 1]["decision"] == "cut, purity 0.9+" and max(x for x, _ in got[3, 2]["ring"]) == 47.0
    narrow = {r["part"]: r["decision"] for r in labelling.label_fields(pixels, fields, 8.0, 10.0).where("field_id = 3").collect()}
    assert narrow == {0: "mixed, cut would leave a sliver"}
    assert labelling.label_fields(pixels.limit(0), fields, 5.0, 10.0).count() == 3


def test_composites_too_large_for_one_image_are_refused(spark):
    from terraframe.operators import compose

    obs = spark.range(60).select((F.col("id") % 20).alias("p"), (1000 + F.col("id")).alias("red"))
    assert compose.single_composite(obs, ["p"], ["red"], 1000, most=20).count() == 20
    with pytest.raises(Exception, match="more than 10 pixels"):
        compose.single_composite(obs, ["p"], ["red"], 1000, most=10).collect()


def test_flips_of_fields_in_one_run_only(spark):
    schema = "f int, crop boolean, acres double"
    base = spark.createDataFrame([(1, True, 2.0), (2, True, 3.0), (3, False, 4.0), (4, True, 5.0), (0, True, 9.0)], schema)
    new = spark.createDataFrame([(1, True, 1.5), (2, False, 3.0), (3, True, 4.5), (5, True, 6.0), (6, False, 7.0), (5, False, 0.5)], schema)
    got = {r["change"]: (r["n"], r["acres"]) for r in stats.field_flips(base, new, "f").collect()}
    assert got == {"kept": (1, 1.5), "lost": (2, 8.0), "gained": (2, 11.0)}
