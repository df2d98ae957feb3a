"""Queries of inference passes, layer matching, folds, audits, extraction and discovery."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import series, spectral
from ..operators import compose, evaluate, inference, spatial, stats, vector
from ..sources import sinks
from .catalog import _EIGHT, _PAIRED, _PHENOLOGY, START, _deviations, crop, labelled_sql, query, rounded
from .entries import _INSIDE, _covered

# Stored models

leaf = lambda v: {"leaf": v}
split = lambda f, t, a, b: {"feature": f, "cut": t, "below": a, "above": b}

#: Features of the boosted model and its trees.
NAMES = ["GNDVI", "R43", "B4"]
BOOSTED = [split(0, 3700.5, leaf(-0.9), split(2, 800.5, leaf(1.1), leaf(0.2))), split(1, 12000.5, leaf(0.5), leaf(-0.6)), split(2, 1000.5, leaf(0.3), leaf(-0.4))]
SECOND = [split(0, 4200.5, leaf(-0.7), leaf(0.8)), split(2, 900.5, leaf(0.4), leaf(-0.3))]
FOREST = [split(0, 0.55, leaf(0.2), split(1, 0.5, leaf(0.4), leaf(0.9))), split(2, 0.45, leaf(0.3), leaf(0.8))]
PERENNIAL = [split(0, 0.12, leaf(-0.8), leaf(0.6)), split(1, 0.55, leaf(0.7), leaf(-0.2)), split(2, 20.5, leaf(0.1), leaf(-0.5))]


def tree_sql(tree: dict, names: list[str]) -> str:
    if "leaf" in tree:
        return f"CAST({tree['leaf']} AS DOUBLE)"
    return f"CASE WHEN {names[tree['feature']]} < {tree['cut']} THEN {tree_sql(tree['below'], names)} ELSE {tree_sql(tree['above'], names)} END"


def boosted_sql(trees: list[dict], names: list[str]) -> str:
    return "1 / (1 + exp(-(" + " + ".join(tree_sql(t, names) for t in trees) + ")))"


BANDS = ["B2", "B3", "B4", "B5", "B8"]
_FEATURES = "CAST(10000 AS DOUBLE) * (B8 - B3) / nullif(B8 + B3, 0) AS g, CAST(10000 AS DOUBLE) * B4 / nullif(B3, 0) AS q, CAST(B4 AS DOUBLE) AS b"
_SCENE = f", f AS (SELECT r, c, cls AS was, v, B8, {_FEATURES} FROM scene), s AS (SELECT *, {boosted_sql(BOOSTED, ['g', 'q', 'b'])} AS p FROM f)"


def features(names: list[str] = NAMES):
    return {n: spectral.feature(n, BANDS).cast("double") for n in names}


def _training(px: DataFrame) -> DataFrame:
    rows = px.where("B8 > 0").select("label", *[f.alias(n) for n, f in features().items()])
    return stats.quantile_table(rows, NAMES, F.when(crop(), "positive").otherwise("negative"))


def _check_sql(role: str, train: str, keep: str) -> str:
    parts = " UNION ALL ".join(f"SELECT '{n}' AS feature, {x} AS x FROM {{0}}" for n, x in (("g", "g"), ("q", "q"), ("b", "b")))
    ref = f"SELECT feature, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75 FROM ({parts.format(f'(SELECT {_FEATURES} FROM px WHERE B8 > 0 AND {train})')}) t GROUP BY feature"
    mid = f"SELECT feature, quantile_cont(x, 0.5) AS m FROM ({parts.format(f'(SELECT {_FEATURES} FROM scene WHERE B8 > 0 AND {keep})')}) t GROUP BY feature"
    return f"SELECT '{role}' AS role, round(sqrt(avg(z * z)), 5) AS score, CASE WHEN sqrt(avg(z * z)) <= 0.5 THEN 'ok' WHEN sqrt(avg(z * z)) <= 1.0 THEN 'warn' ELSE 'refuse' END AS verdict FROM (SELECT (m - q50) / (q75 - q25) AS z FROM ({mid}) a JOIN ({ref}) b ON a.feature = b.feature WHERE q50 <> 0 AND q75 > q25) y"


_MASKED, _POOLED = _check_sql("positive", "label = 1", "cls = 1"), _check_sql("pooled", "true", "true")


@query("ml13_domain_check", f" {_MASKED} UNION ALL {_POOLED}", ("scene", "px"))
def _(scene, px):
    """Verdict on a scene with and without a crop mask, against the training quantiles."""
    table = _training(px)
    check = lambda mask: inference.check_scene(scene, ["r", "c"], features(), table, F.col("B8") > 0, mask)
    return rounded(check(F.col("cls") == 1).unionByName(check(None)).select("role", "score", "verdict"), "score", n=5)


@query("ml11_classify", _SCENE + f", d AS ({_MASKED}) SELECT r, c, CAST(CASE WHEN was = 1 AND B8 > 0 THEN CASE WHEN p >= 0.55 THEN 1 ELSE 4 END ELSE 255 END AS INTEGER) AS cls, round(CASE WHEN was = 1 AND B8 > 0 THEN p END, 6) AS prob, verdict FROM s CROSS JOIN d", ("scene", "px"))
def _(scene, px):
    """Classes and probabilities of the masked pixels at the model's threshold, with the verdict of the domain check."""
    mask, valid = F.col("cls") == 1, F.col("B8") > 0
    verdict = inference.check_scene(scene, ["r", "c"], features(), _training(px), valid, mask).select("verdict")
    out = inference.classify(scene, list(features().values()), BOOSTED, 0.55, valid & mask)
    return rounded(out.join(F.broadcast(verdict)).select("r", "c", "cls", "prob", "verdict"), "prob")  # one row


@query("ml12_fixed_threshold", _SCENE + " SELECT CAST(CASE WHEN was IN (1, 4) AND B8 > 0 THEN CASE WHEN p >= 0.5 THEN 1 ELSE 4 END ELSE 255 END AS INTEGER) AS cls, count(*) AS n, round(count(*) * 100.0 / 4046.8564224, 5) AS acres FROM s GROUP BY 1", ("scene",))
def _(scene):
    """Pixels and acres of each class at 0.5, without a check or a sidecar."""
    out = inference.classify(scene, list(features().values()), BOOSTED, 0.5, (F.col("B8") > 0) & F.col("cls").isin(1, 4))
    per = out.groupBy("cls").agg(F.count(F.lit(1)).alias("n"))
    return rounded(per.withColumn("acres", spectral.acres(F.col("n"))), "acres", n=5)


_STEPS = (21, 24, 30)


@query("ml10_series_forest", ", w AS (SELECT pixel_id, bool_or(v IS NOT NULL AND v <> 0) AS seen, " + ", ".join(f"coalesce(max(CASE WHEN step = {t} THEN v END), 0) AS s{t}" for t in _STEPS) + " FROM long WHERE step BETWEEN 20 AND 31 GROUP BY pixel_id) SELECT pixel_id, CAST(CASE WHEN NOT seen THEN 255 WHEN ((" + ") + (".join(tree_sql(t, [f"s{i}" for i in _STEPS]) for t in FOREST) + ")) / 2 >= 0.5 THEN 1 ELSE 4 END AS INTEGER) AS cls FROM w", ("series",))
def _(s):
    """Forest over a slice of the series: pixels missing or zero at all its steps are nodata, other gaps are zero."""
    part = s.select("pixel_id", F.slice(series.known(F.col("s")), 21, 12).alias("z"))
    seen = F.exists("z", lambda x: x.isNotNull() & (x != 0))
    steps = [F.coalesce(F.get("z", F.lit(t - 20)), F.lit(0.0)) for t in _STEPS]
    return inference.classify(part, steps, FOREST, 0.5, seen, forest=True).select("pixel_id", "cls")


@query("ml14_perennial_scores", _PHENOLOGY + f"SELECT pixel_id, round({boosted_sql(PERENNIAL, ['lo', 'amplitude', 'below'])}, 6) AS score, lo > 0.05 AND amplitude < 0.6 AND below <= 40 AS gated FROM base", ("series",))
def _(s):
    """Score of each pixel by a model on its phenology, and whether it passes the gate."""
    names = ["ndvi_min", "amplitude", "steps_below_bare"]
    f = s.select("pixel_id", *series.features(F.col("s"), names))
    out = f.withColumn("score", inference.tree_score([F.col(n) for n in names], PERENNIAL))
    return rounded(out.select("pixel_id", "score", series.perennial_gate(*[F.col(n) for n in names], 0.05, 0.6, 40).alias("gated")), "score")


_TWO = f", f AS (SELECT date, label, {_FEATURES} FROM px WHERE B8 > 0), e AS (" + " UNION ALL ".join(f"SELECT '{n}' AS model, date, label, {boosted_sql(t, ['g', 'q', 'b'])} >= {cut} AS hit FROM f" for n, t, cut in (("first", BOOSTED, 0.55), ("second", SECOND, 0.5))) + "), z AS (SELECT model, date, 100 * avg(CASE WHEN label = 1 THEN CASE WHEN hit THEN 1.0 ELSE 0.0 END END) AS recall, 100 * avg(CASE WHEN label = 4 THEN CASE WHEN hit THEN 1.0 ELSE 0.0 END END) AS false_pos FROM e GROUP BY model, date) SELECT model, date, round(recall, 5) AS recall, round(false_pos, 5) AS false_pos, round(recall - false_pos, 5) AS separation, round(max(recall) OVER (PARTITION BY model) - min(recall) OVER (PARTITION BY model), 5) AS spread FROM z"


@query("ml18_two_models", _TWO, ("px",))
def _(px):
    """Recall, false positives and their gap at every date for two models, and the spread of recall over dates."""
    valid = px.where("B8 > 0").select("date", "label", *BANDS)
    rate = lambda k: 100 * F.avg(F.when(F.col("label") == k, F.col("hit").cast("double")))
    out = None
    for name, trees, cut in (("first", BOOSTED, 0.55), ("second", SECOND, 0.5)):
        scored = valid.withColumn("hit", inference.tree_score(list(features().values()), trees) >= cut)
        per = scored.groupBy("date").agg(rate(1).alias("recall"), rate(4).alias("false_pos"))
        span = F.broadcast(per.agg((F.max("recall") - F.min("recall")).alias("spread")))  # one row
        rows = per.join(span).select(F.lit(name).alias("model"), "date", "recall", "false_pos", (F.col("recall") - F.col("false_pos")).alias("separation"), "spread")
        out = rows if out is None else out.unionByName(rows)
    return rounded(out, "recall", "false_pos", "separation", "spread", n=5)


@query("ml17_labelled_pixels", ", m AS (SELECT g.r, g.c, bool_or(g.c * 4 >= f.x0 AND g.c * 4 + 4 <= f.x1 AND g.r * 2 >= f.y0 AND g.r * 2 + 2 <= f.y1) AS whole FROM scene g JOIN fields f ON g.c * 4 < f.x1 AND g.c * 4 + 4 > f.x0 AND g.r * 2 < f.y1 AND g.r * 2 + 2 > f.y0 GROUP BY g.r, g.c) SELECT s.r, s.c, B4 AS b4, B8 AS b8, CAST(CASE WHEN whole THEN 1 ELSE 4 END AS INTEGER) AS label FROM scene s LEFT JOIN m ON s.r = m.r AND s.c = m.c WHERE B8 > 0 AND whole IS DISTINCT FROM false", ("scene", "fields"))
def _(scene, fields):
    """Training pixels of both classes from label polygons; pixels on a border are in neither."""
    square = scene.where("B8 > 0").select("r", "c", F.col("B4").alias("b4"), F.col("B8").alias("b8"), (F.col("c") * 4).alias("x0"), (F.col("r") * 2).alias("y0"), (F.col("c") * 4 + 4).alias("x1"), (F.col("r") * 2 + 2).alias("y1"))
    return inference.labelled_pixels(square, fields, ["r", "c"], 16).select("r", "c", "b4", "b8", "label")


# Layers of an image

_ORDER = [date(2025, 10, 4), date(2025, 10, 9), date(2025, 10, 14)]


def _layer_bands_sql(stage: str, layer: int, onto: str) -> str:
    """Coefficients ``stage`` of a layer against the pairs of ``onto`` (band, r, c, y): trim, medians, deviations."""
    return f"""{stage}p AS (SELECT a.band, a.v AS x, b.y FROM t a JOIN ({onto}) b ON a.band = b.band AND a.r = b.r AND a.c = b.c WHERE a.d = {layer}),
{stage}q AS (SELECT band, quantile_cont(x, 0.01) AS x1, quantile_cont(x, 0.99) AS x9, quantile_cont(y, 0.01) AS y1, quantile_cont(y, 0.99) AS y9 FROM {stage}p GROUP BY band HAVING count(*) >= (SELECT need FROM need)),
{stage}i AS (SELECT p.band, x, y FROM {stage}p p JOIN {stage}q q ON p.band = q.band WHERE x BETWEEN x1 AND x9 AND y BETWEEN y1 AND y9),
{stage}m AS (SELECT band, quantile_cont(x, 0.5) AS mx, quantile_cont(y, 0.5) AS my FROM {stage}i GROUP BY band),
{stage}g AS (SELECT i.band, max(mx) AS mx, max(my) AS my, greatest(0.5, least(2.0, quantile_cont(abs(y - my), 0.5) / quantile_cont(abs(x - mx), 0.5))) AS gain FROM {stage}i i JOIN {stage}m m ON i.band = m.band GROUP BY i.band),
{stage} AS (SELECT band, gain, my - gain * mx AS shift FROM {stage}g)"""


_LAYERED = (
    ", t AS (SELECT d, r, c, 'red' AS band, CAST(red AS DOUBLE) AS v FROM layers WHERE scl <> 9 UNION ALL SELECT d, r, c, 'nir', CAST(nir AS DOUBLE) FROM layers WHERE scl <> 9), need AS (SELECT greatest(400, CAST(floor(0.02 * count(*)) AS BIGINT)) AS need FROM (SELECT DISTINCT r, c FROM layers) u), "
    + _layer_bands_sql("two", 2, "SELECT band, r, c, v AS y FROM t WHERE d = 1") + ", " + _layer_bands_sql("three", 3, "SELECT z.band, r, c, v * gain + shift AS y FROM t z JOIN two ON z.band = two.band WHERE d = 2")
)


@query("tk6_layer_match", _LAYERED + " SELECT DATE '2025-10-09' AS day, band, round(gain, 5) AS gain, round(shift, 3) AS shift FROM two UNION ALL SELECT DATE '2025-10-14', band, round(gain, 5), round(shift, 3) FROM three", ("layers",))
def _(layers):
    """Gains and offsets of two lower layers; the last meets the top one nowhere and is matched by way of the second."""
    found = inference.match_layers(layers, _ORDER, ["r", "c"], "day", ["red", "nir"], spectral.scl_usable(F.col("scl")), "d")
    rows = layers.sparkSession.createDataFrame([x[:4] for x in found], "day date, band string, gain double, shift double")
    return rounded(rounded(rows, "gain", n=5), "shift", n=3)


_MOVED = "greatest({0} * coalesce((SELECT gain FROM two WHERE band = '{0}'), 1) + coalesce((SELECT shift FROM two WHERE band = '{0}'), 0), 0)"


@query("ep3_layered_static", _LAYERED + f", a AS (SELECT r, c, CAST(red AS DOUBLE) AS red, CAST(nir AS DOUBLE) AS nir FROM layers WHERE d = 1), b AS (SELECT r, c, {_MOVED.format('red')} AS red, {_MOVED.format('nir')} AS nir FROM layers WHERE d = 2 AND scl <> 9), k AS (SELECT DISTINCT r, c FROM layers) SELECT k.r, k.c, round(CASE WHEN a.r IS NULL THEN b.red ELSE a.red END, 3) AS red, round(CASE WHEN a.r IS NULL THEN b.nir ELSE a.nir END, 3) AS nir, CAST(CASE WHEN a.r IS NOT NULL THEN 1 WHEN b.r IS NOT NULL THEN 2 ELSE 0 END AS INTEGER) AS source_rank FROM k LEFT JOIN a ON k.r = a.r AND k.c = a.c LEFT JOIN b ON k.r = b.r AND k.c = b.c", ("layers",))
def _(layers):
    """Static image: dates that add the most pixels, matched to the first, layered by rank."""
    rows = layers.withColumn("pixel_id", spectral.pixel_id(F.col("r"), F.col("c"), 100))
    order = compose.greedy_dates(rows, 2, target=100.0)
    usable = spectral.scl_usable(F.col("scl"))
    found = inference.match_layers(rows, order, ["r", "c"], "day", ["red", "nir"], usable, "d")
    return rounded(inference.layered_image(rows, order, ["r", "c"], "day", ["red", "nir"], usable, found), "red", "nir", n=3)


@query("ep2_tiled_series", ", p AS (SELECT CAST(floor(pixel_id / 64) AS BIGINT) AS tile, pixel_id, CAST(floor(date_diff('day', DATE '2024-01-01', day) / 8) AS INTEGER) AS win, quantile_cont(CASE WHEN scl < 8 AND scl <> 3 THEN red END, 0.5) AS red, sum(CASE WHEN scl < 8 AND scl <> 3 THEN 1 ELSE 0 END) AS ok, count(*) AS n FROM obs GROUP BY 1, 2, 3) SELECT tile, win, count(*) AS pixels, CAST(sum(n) AS BIGINT) AS scenes, round(100.0 * sum(CASE WHEN ok > 0 THEN 1 ELSE 0 END) / count(*), 5) AS valid_pct, round(sum(red), 3) AS red FROM p GROUP BY tile, win", ("obs",))
def _(obs):
    """Index of the composites of every tile and window, read from the tiles as written."""
    rows = obs.withColumn("tile", F.floor(F.col("pixel_id") / 64).cast("bigint"))
    made = compose.median_composite(rows, START, 8, ["tile", "pixel_id"], ["red", "nir"], keep=spectral.scl_keep(F.col("scl")))
    tiles = sinks.write_partitioned(made, sinks.shared_folder(obs.sparkSession, "tiles"), ["win"])
    out = tiles.groupBy("tile", F.col("win").cast("int").alias("win")).agg(F.count(F.lit(1)).alias("pixels"), F.sum("n_scenes").alias("scenes"), (F.count_if(F.col("n_valid") > 0) * 100.0 / F.count(F.lit(1))).alias("valid_pct"), F.sum("red").alias("red"))
    return rounded(rounded(out, "valid_pct", n=5), "red", n=3)


# Folds

_FOLD = """, g AS (SELECT {k} AS held_out FROM px GROUP BY {k} HAVING count(*) >= 1000 AND count(*) < (SELECT count(*) FROM px) AND sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) BETWEEN 1 AND count(*) - 1),
m AS (SELECT held_out, avg(CASE WHEN label = 1 THEN B4 END) AS p4, avg(CASE WHEN label <> 1 THEN B4 END) AS n4, avg(CASE WHEN label = 1 THEN B8 END) AS p8, avg(CASE WHEN label <> 1 THEN B8 END) AS n8 FROM g JOIN px ON px.{k} <> g.held_out GROUP BY held_out),
s AS (SELECT held_out, label, ((B4 - n4) * (B4 - n4) + (B8 - n8) * (B8 - n8)) / ((B4 - p4) * (B4 - p4) + (B8 - p8) * (B8 - p8) + (B4 - n4) * (B4 - n4) + (B8 - n8) * (B8 - n8)) AS prob FROM m JOIN px ON px.{k} = m.held_out),
f AS (SELECT held_out, count(*) AS n_test, sum(CASE WHEN label = 1 AND prob >= 0.5 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN label <> 1 AND prob >= 0.5 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN label = 1 AND prob < 0.5 THEN 1 ELSE 0 END) AS fn FROM s GROUP BY held_out),
h AS (SELECT held_out, n_test, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM f) """


def _folds(px: DataFrame, group: str) -> DataFrame:
    fit = lambda train, test: inference.centroid_scores(train, test, ["B4", "B8"], crop())
    return evaluate.leave_one_group_out(px, group, crop(), fit)


@query("ml3_leave_one_out", _FOLD.format(k="date") + "SELECT held_out, n_test, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM h", ("px",))
def _(px):
    """Scores of each date by a model of the others; small and one-class folds are left out."""
    out = evaluate.confusion(_folds(px, "date"), ["held_out"], crop(), F.col("prob") >= 0.5)
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return rounded(out.select("held_out", total.alias("n_test"), "precision", "recall", "f1"), "precision", "recall", "f1")


@query("ml4_pooled_scores", _FOLD.format(k="date") + ", r AS (SELECT label, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2.0 AS place FROM s) SELECT round((sum(CASE WHEN label = 1 THEN place END) - sum(CASE WHEN label = 1 THEN 1.0 ELSE 0 END) * (sum(CASE WHEN label = 1 THEN 1.0 ELSE 0 END) + 1) / 2) / (sum(CASE WHEN label = 1 THEN 1.0 ELSE 0 END) * sum(CASE WHEN label = 1 THEN 0.0 ELSE 1 END)), 6) AS auc FROM r", ("px",))
def _(px):
    """ROC area of the held-out scores of all folds together; curve points go by range of the score."""
    curve = evaluate.running_totals(evaluate.score_steps(_folds(px, "date"), [], crop(), "prob"), "prob", ["pos", "neg"])
    below = F.col("all_neg") - F.col("run_neg")
    got = curve.agg(F.sum(F.col("pos") * (below + F.col("neg") / 2)).alias("u"), F.max("all_pos").alias("p"), F.max("all_neg").alias("n"))
    return rounded(got.select(F.try_divide("u", (F.col("p") * F.col("n")).cast("double")).alias("auc")), "auc")


_SUMMARY = "SELECT {n} AS grouping, count(*) AS folds, round(avg(recall), 6) AS recall_mean, round(min(recall), 6) AS recall_min, round(max(recall) - min(recall), 6) AS recall_range, round(min(f1), 6) AS f1_min FROM h"


@query("ep21_grouped_folds", " SELECT * FROM (WITH " + _FOLD.format(k="date")[2:] + _SUMMARY.format(n="'date'") + ") a UNION ALL SELECT * FROM (WITH " + _FOLD.format(k="aoi")[2:] + _SUMMARY.format(n="'aoi'") + ") b", ("px",))
def _(px):
    """Folds by date and by site, summed up."""
    out = None
    for group in ("date", "aoi"):
        folds = evaluate.confusion(_folds(px, group), ["held_out"], crop(), F.col("prob") >= 0.5)
        row = folds.agg(F.lit(group).alias("grouping"), F.count(F.lit(1)).alias("folds"), F.avg("recall").alias("recall_mean"), F.min("recall").alias("recall_min"), (F.max("recall") - F.min("recall")).alias("recall_range"), F.min("f1").alias("f1_min"))
        out = row if out is None else out.unionByName(row)
    return rounded(out, "recall_mean", "recall_min", "recall_range", "f1_min")


def _arm_sql(name: str, bands: list[str]) -> str:
    means = ", ".join(f"avg(CASE WHEN label {op} 1 THEN {b} END) AS {k}{b}" for b in bands for k, op in (("p", "="), ("n", "<>")))
    far = {k: " + ".join(f"({b} - {k}{b}) * ({b} - {k}{b})" for b in bands) for k in "pn"}
    scored = f"SELECT label, ({far['n']}) / ({far['p']} + {far['n']}) AS prob FROM px CROSS JOIN (SELECT {means} FROM px WHERE date = '2025-11-15') m WHERE date = '2025-08-15'"
    ranked = f"SELECT label, prob, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2.0 AS place FROM ({scored}) s"
    pos = "sum(CASE WHEN label = 1 THEN 1.0 ELSE 0 END)"
    return f"SELECT '{name}' AS arm, {len(bands)} AS n_features, (sum(CASE WHEN label = 1 THEN place END) - {pos} * ({pos} + 1) / 2) / ({pos} * sum(CASE WHEN label = 1 THEN 0.0 ELSE 1 END)) AS auc, sum(CASE WHEN label = 1 AND prob >= 0.5 THEN 1.0 ELSE 0 END) / {pos} AS recall FROM ({ranked}) r"


@query("ep15_more_bands", f", u AS ({_arm_sql('base', ['B4', 'B8'])} UNION ALL {_arm_sql('more', ['B4', 'B8', 'B5'])}) SELECT arm, CAST(n_features AS INTEGER) AS n_features, round(auc, 6) AS auc, round(recall, 6) AS recall, (SELECT max(CASE WHEN arm = 'more' THEN auc END) - max(CASE WHEN arm = 'base' THEN auc END) FROM u) >= 0.02 AS worth FROM u", ("px",))
def _(px):
    """Two sets of bands fitted in November and scored in August; the larger is worth it from 0.02 of area on."""
    train, test = px.where("date = '2025-11-15'"), px.where("date = '2025-08-15'")
    out = None
    for arm, bands in (("base", ["B4", "B8"]), ("more", ["B4", "B8", "B5"])):
        scored = inference.centroid_scores(train, test, bands, crop())
        row = evaluate.roc_auc(scored, [], crop(), "prob").join(evaluate.confusion(scored, [], crop(), F.col("prob") >= 0.5))  # one row each
        row = row.select(F.lit(arm).alias("arm"), F.lit(len(bands)).alias("n_features"), "auc", "recall")
        out = row if out is None else out.unionByName(row)
    gain = F.broadcast(out.agg((F.max(F.when(F.col("arm") == "more", F.col("auc"))) - F.max(F.when(F.col("arm") == "base", F.col("auc"))) >= 0.02).alias("worth")))  # one row
    return rounded(out.join(gain), "auc", "recall")


# Audits

_PID = ", pid AS (SELECT g.r, g.c, max(f.field_id) AS field_id FROM grid g JOIN fields f ON g.c * 4 + 2 >= f.x0 AND g.c * 4 + 2 < f.x1 AND g.r * 2 + 1 >= f.y0 AND g.r * 2 + 1 < f.y1 GROUP BY g.r, g.c)"


def _pixels_of(grid: DataFrame, fields: DataFrame) -> DataFrame:
    centre = grid.select("r", "c", "cls", (F.col("c") * 4 + 2).alias("x"), (F.col("r") * 2 + 1).alias("y"))
    return spatial.assign_pixels(centre, fields, 16, "field_id")


@query("ag20_crop_pieces", ", k AS (SELECT r, c, 1 AS v FROM grid WHERE cls = 1), " + labelled_sql("cc", "k", _EIGHT) + _PID + " SELECT p.field_id, count(*) AS pixels, count(DISTINCT cc.id) AS pieces FROM pid p LEFT JOIN cc ON p.r = cc.r AND p.c = cc.c GROUP BY p.field_id", ("grid", "fields"))
def _(grid, fields):
    """Distinct blobs of crop that each polygon meets; none is 0."""
    blobs = spatial.components(grid.where("cls = 1").select("r", "c"), True).select("r", "c", "component")
    return _pixels_of(grid, fields).join(blobs, ["r", "c"], "left").groupBy("field_id").agg(F.count(F.lit(1)).alias("pixels"), F.count_distinct("component").alias("pieces"))


_FLIPS = _PID + """, m AS (SELECT p.field_id, count(*) AS n, avg(CASE WHEN g.cls = 1 THEN 1.0 ELSE 0.0 END) AS was, avg(CASE WHEN g.cls = 1 OR (g.r * 31 + g.c * 7) % 5 = 0 THEN 1.0 ELSE 0.0 END) AS now FROM pid p JOIN grid g ON p.r = g.r AND p.c = g.c WHERE p.field_id > 0 GROUP BY p.field_id),
e AS (SELECT n, n >= 6 AND was >= 0.5 AS old, n >= 8 AND now >= 0.5 AS new FROM m) SELECT CASE WHEN old AND new THEN 'kept' WHEN new THEN 'gained' ELSE 'lost' END AS change, count(*) AS n, round(sum(n) * 100 / 4046.8564224, 5) AS acres FROM e WHERE old OR new GROUP BY 1"""


@query("jn9_field_flips", _FLIPS, ("grid", "fields"))
def _(grid, fields):
    """Fields that changed hands between two maps; the second run has judged fewer of them."""
    run = lambda hit, least: _pixels_of(grid.withColumn("cls", F.when(hit, 1).otherwise(0)), fields).groupBy("field_id").agg((F.avg("cls") >= 0.5).alias("crop"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("field_id", "crop", spectral.acres(F.col("n")).alias("acres"))
    first, second = F.col("cls") == 1, (F.col("cls") == 1) | ((F.col("r") * 31 + F.col("c") * 7) % 5 == 0)
    return rounded(stats.field_flips(run(first, 6), run(second, 8), "field_id"), "acres", n=5)


_SURVEY = _PID + """, z AS (SELECT p.field_id, g.r, g.c, CASE WHEN g.cls = 1 THEN 1 ELSE 0 END AS crop, f.y1 - f.y0 > f.x1 - f.x0 AS tall FROM pid p JOIN grid g ON p.r = g.r AND p.c = g.c JOIN fields f ON p.field_id = f.field_id),
w AS (SELECT field_id FROM z GROUP BY field_id HAVING count(*) >= 6 AND avg(crop) > 0.15 AND avg(crop) < 0.85), y AS (SELECT z.* FROM z JOIN w ON z.field_id = w.field_id),
a AS (""" + " UNION ALL ".join(f"SELECT field_id, row_number() OVER o AS n1, sum(crop) OVER (o ROWS UNBOUNDED PRECEDING) AS k1, count(*) OVER (PARTITION BY field_id) AS n, sum(crop) OVER (PARTITION BY field_id) AS k FROM y WHERE {cond} WINDOW o AS (PARTITION BY field_id ORDER BY {by})" for cond, by in (("NOT tall", "c, r"), ("true", "r, c"), ("tall", "c DESC, r"))) + """),
b AS (SELECT field_id, max(CAST(greatest(k1, n1 - k1) + greatest(k - k1, n - n1 - (k - k1)) AS DOUBLE) / n) AS purity FROM a GROUP BY field_id)
SELECT CAST(bar AS DOUBLE) AS bar, CAST(sum(CASE WHEN purity >= bar THEN 1 ELSE 0 END) AS BIGINT) AS n, round(avg(CASE WHEN purity >= bar THEN 1.0 ELSE 0.0 END), 6) AS share FROM b CROSS JOIN (VALUES (0.95), (0.90), (0.85), (0.80)) v(bar) GROUP BY bar"""


@query("ge17_cut_survey", _SURVEY, ("grid", "fields"))
def _(grid, fields):
    """Share of mixed polygons that one cut along or across their long axis divides as purely as each bar."""
    axes = fields.select("field_id", vector.box_ring().alias("ring")).select("field_id", vector.rectangle("ring").alias("b")).select("field_id", "b.theta")
    px = _pixels_of(grid, fields).withColumn("crop", F.col("cls") == 1)
    mixed = px.groupBy("field_id").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("crop").cast("double")).alias("f")).where("n >= 6 and f > 0.15 and f < 0.85").select("field_id")
    rows = px.join(mixed, "field_id", "left_semi").join(axes, "field_id").withColumn("axes", F.array("theta", F.col("theta") + F.pi() / 2))
    cuts = spatial.best_cut(rows, "field_id", "crop", "c", "r", F.col("axes"), side=0)
    per = cuts.agg(*[F.struct(F.lit(b).alias("bar"), F.count_if(F.col("purity") >= b).alias("n"), F.avg((F.col("purity") >= b).cast("double")).alias("share")).alias(f"b{i}") for i, b in enumerate((0.95, 0.90, 0.85, 0.80))])
    return rounded(per.select(F.explode(F.array(*per.columns)).alias("x")).select("x.*"), "share")


_FOUR = "(VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) d(i, j)"


@query("ge18_removed_patches", ", k AS (SELECT r, c, 1 AS v FROM grid g WHERE cls = 1 AND " + _INSIDE.format("f.x1 - f.x0 >= 12 AND") + "), " + labelled_sql("cc", "k", _FOUR) + ", m AS (SELECT quantile_cont((g.v % 100) / 100.0, 0.5) AS score FROM grid g JOIN k ON g.r = k.r AND g.c = k.c) SELECT id AS component, CAST(count(*) AS DOUBLE) AS area, round(max(score), 6) AS score FROM cc CROSS JOIN m GROUP BY id", ("grid", "fields"))
def _(grid, fields):
    """Outlines of the crop that a filter took away, with the median score of all removed pixels."""
    gone = _covered(grid.where("cls = 1"), fields.where("x1 - x0 >= 12")).where("inside").select("r", "c", "v")
    score = F.broadcast(gone.agg(F.percentile((F.col("v") % 100) / 100, F.lit(0.5)).alias("score")))  # one row
    rings = vector.polygonise(spatial.components(gone.select("r", "c"))).groupBy("component").agg(F.sum("area").alias("area"))
    return rounded(rings.join(score), "score")


@query("ag38_leak_report", f", q AS (SELECT *, CAST(floor(x0 / 100) AS BIGINT) AS district FROM fields WHERE x1 - x0 >= 12), o AS (SELECT * FROM fields WHERE x1 - x0 <= 10), e AS (SELECT district, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, CAST(sum((x1 - x0) * (y1 - y0)) AS BIGINT) AS mask_area FROM q GROUP BY district), near AS (SELECT e.district, sum((o.x1 - o.x0) * (o.y1 - o.y0)) AS area FROM e JOIN o ON o.x0 < e.x1 AND e.x0 < o.x1 AND o.y0 < e.y1 AND e.y0 < o.y1 GROUP BY e.district), hit AS (SELECT a.district, sum((least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0))) AS area FROM q a JOIN o b ON a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1 GROUP BY a.district) SELECT e.district, mask_area, CAST(near.area AS BIGINT) AS nearby, CAST(coalesce(hit.area, 0) AS BIGINT) AS inside, round(100.0 * coalesce(hit.area, 0) / near.area, 6) AS leak_pct FROM e JOIN near ON e.district = near.district LEFT JOIN hit ON e.district = hit.district", ("fields",))
def _(fields):
    """Area of a record layer inside each district's mask, and its percent of the record near the mask."""
    mask, record = fields.where("x1 - x0 >= 12").withColumn("district", F.floor(F.col("x0") / 100).cast("bigint")), fields.where("x1 - x0 <= 10")
    size = lambda p: (F.col(f"{p}x1") - F.col(f"{p}x0")) * (F.col(f"{p}y1") - F.col(f"{p}y0"))
    extent = mask.groupBy("district").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.sum(size("")).alias("mask_area"))
    near = spatial.box_join(extent, record, 256, ("district", "field_id")).groupBy(F.col("l_district").alias("district")).agg(F.first("l_mask_area").alias("mask_area"), F.sum(size("r_")).alias("nearby"))
    hit = spatial.box_join(mask, record, 16, ("field_id", "field_id")).groupBy(F.col("l_district").alias("district")).agg(F.sum(spatial.overlap_area()).alias("inside"))
    out = near.join(hit, "district", "left").na.fill(0, ["inside"])
    return rounded(out.withColumn("leak_pct", F.try_divide(100 * F.col("inside"), F.col("nearby"))), "leak_pct")


@query("ag18_radar_stats", ", p AS (SELECT pixel_id, CASE WHEN red > 310 THEN CAST(red - 310 AS DOUBLE) END AS vv, CASE WHEN nir > 2300 THEN CAST(nir - 2300 AS DOUBLE) END AS vh FROM obs) SELECT pixel_id, " + ", ".join(f"round(10 * log10(quantile_cont({x}, 0.5)), 5) AS {x}_median, round(stddev_pop(10 * log10({x})), 5) AS {x}_std" for x in ("vv", "vh")) + ", round(quantile_cont(10 * log10(vh) - 10 * log10(vv), 0.5), 5) AS ratio_median, round(stddev_pop(10 * log10(vh) - 10 * log10(vv)), 5) AS ratio_std FROM p GROUP BY pixel_id", ("obs",))
def _(obs):
    """Per pixel the median of linear power in decibel, and the deviation and ratio in decibel."""
    power = lambda x, least: F.when(F.col(x) > least, (F.col(x) - least).cast("double"))
    rows = obs.select("pixel_id", power("red", 310).alias("vv"), power("nir", 2300).alias("vh"))
    db = {"vv": spectral.decibel(F.col("vv")), "vh": spectral.decibel(F.col("vh"))}
    ratio, half = db["vh"] - db["vv"], F.lit(0.5)
    cols = [c for x in db for c in (spectral.decibel(F.percentile(x, half)).alias(f"{x}_median"), F.stddev_pop(db[x]).alias(f"{x}_std"))]
    out = rows.groupBy("pixel_id").agg(*cols, F.percentile(ratio, half).alias("ratio_median"), F.stddev_pop(ratio).alias("ratio_std"))
    return rounded(out, *out.columns[1:], n=5)


@query("ag6_stability_report", _PAIRED + "SELECT 'centre' AS part, date, feature, round(v, 5) AS value FROM (" + " UNION ALL ".join(f"SELECT date, '{f}' AS feature, quantile_cont({f}, 0.5) AS v FROM px GROUP BY date" for f in ("B2", "B4", "B8", "NDVI")) + ") c UNION ALL SELECT 'deviation', date, feature, round(dev, 5) FROM d UNION ALL SELECT 'range', NULL, feature, round(range_pct, 5) FROM k UNION ALL SELECT 'worst', NULL, feature, round(worst_pct, 5) FROM k", ("px",))
def _(px):
    """Centres by date, paired deviations and the ranking in one table."""
    bands = ["B2", "B4", "B8", "NDVI"]
    moved = _deviations(px)
    ranks = stats.rank_features(moved)
    rows = lambda df, part, when, x: df.select(F.lit(part).alias("part"), when.cast("string").alias("date"), "feature", F.col(x).alias("value"))
    centre = stats.centres(px, ["date"], bands).unpivot(["date"], bands, "feature", "value")
    none = F.lit(None)
    out = rows(centre, "centre", F.col("date"), "value").unionByName(rows(moved, "deviation", F.col("date"), "dev")).unionByName(rows(ranks, "range", none, "range_pct")).unionByName(rows(ranks, "worst", none, "worst_pct"))
    return rounded(out, "value", n=5)


@query("ge3_split_halves", "SELECT field_id, CAST((x1 - x0 - 5) * (y1 - y0) AS DOUBLE) AS above, CAST(5 * (y1 - y0) AS DOUBLE) AS below FROM fields", ("fields",))
def _(fields):
    """Areas of both parts of every polygon, cut along a line five units from its left edge."""
    cut = fields.select("field_id", vector.halves(vector.box_ring(), F.lit(0.0), F.col("x0") + F.lit(5.0)).alias("h")).select("field_id", "h.*")
    area = lambda n: vector.ring_measures(n)[0].alias(n)
    return rounded(cut.select("field_id", area("above"), area("below")), "above", "below")


@query("ep16_chips", ", cell AS (SELECT CAST(floor(r / 50) AS BIGINT) AS district, CAST(floor(r / 5) AS BIGINT) AS gr, CAST(floor(c / 5) AS BIGINT) AS gc, sum(CASE WHEN cls = 1 THEN 1 ELSE 0 END) AS a, sum(CASE WHEN cls = 4 THEN 1 ELSE 0 END) AS b FROM grid GROUP BY 1, 2, 3), chip AS (SELECT district, gr - i AS top, gc - j AS lft, CAST(least(sum(a), sum(b)) AS BIGINT) AS score FROM cell CROSS JOIN (SELECT unnest(range(4)) AS i) x CROSS JOIN (SELECT unnest(range(4)) AS j) y WHERE gr >= i AND gc >= j GROUP BY 1, 2, 3) SELECT district, CAST(arg_max(top, (score, -top, -lft)) AS BIGINT) AS top, CAST(arg_max(lft, (score, -top, -lft)) AS BIGINT) AS lft, max(score) AS score FROM chip GROUP BY district", ("grid",))
def _(grid):
    """The best chip of each district."""
    rows = grid.withColumn("district", F.floor(F.col("r") / 50).cast("bigint"))
    return spatial.best_chip(rows, [F.col("cls") == 1, F.col("cls") == 4], 5, 4, ("district",))


# Bands and sources


@query("pr3_feature_matrix", "SELECT k, round(CAST(10000 AS DOUBLE) * B4 / nullif(B3, 0), 4) AS f0, CAST(B4 AS DOUBLE) AS f1, round(CAST(10000 AS DOUBLE) * (B8 - B3) / nullif(B8 + B3, 0), 4) AS f2 FROM px", ("px",))
def _(px):
    """Feature vectors in the order asked for."""
    rows = px.select("k", spectral.feature_matrix(["R43", "B4", "GNDVI"], BANDS).alias("x"))
    return rounded(rows.select("k", *[F.get("x", F.lit(i)).alias(f"f{i}") for i in range(3)]), "f0", "f2", n=4)


@query("pr4_source_bands", "SELECT k, B2 AS b2, B3 AS b3, B4 AS b4, B5 AS b5, B8 AS b8, NDVI AS ndvi FROM px", ("px",))
def _(px):
    """The known bands of a table, whatever else it holds."""
    return px.select("k", *[F.col(b).alias(b.lower()) for b in spectral.source_columns(px.columns)])


@query("pr10_split_bands", "SELECT * FROM (VALUES (CAST(0 AS INTEGER), 'read', 'red'), (1, 'read', 'nir'), (2, 'read', 'green'), (0, 'compute', 'ndvi'), (1, 'compute', 'ndwi'), (0, 'output', 'red'), (1, 'output', 'ndvi'), (2, 'output', 'nir'), (3, 'output', 'ndwi')) t(pos, part, band)")
def _(spark, sf_dir):
    """What to read, compute and give out for a list of bands and indices."""
    parts = zip(("read", "compute", "output"), spectral.split_bands(["B4", "ndvi", "nir", "NDWI", "red"]))
    return spark.createDataFrame([(i, part, b) for part, bands in parts for i, b in enumerate(bands)], "pos int, part string, band string")


@query("pr11_provider_assets", "SELECT * FROM (VALUES ('mpc', 'red', 'B04'), ('mpc', 'swir16', 'B11'), ('mpc', 'nir08', 'B8A'), ('earthsearch', 'red', 'red'), ('earthsearch', 'swir16', 'swir16'), ('earthsearch', 'nir08', 'nir08')) t(provider, band, asset)")
def _(spark, sf_dir):
    bands = spectral.resolve_bands(["B4", "swir1", "b8a"])
    rows = [(p, b, a) for p in spectral.PROVIDERS for b, a in zip(bands, spectral.provider_assets(p, bands))]
    return spark.createDataFrame(rows, "provider string, band string, asset string")


@query("sc15_many_files", "SELECT aoi, count(*) AS n, CAST(sum(B8) AS BIGINT) AS b8 FROM px GROUP BY aoi", ("px",))
def _(px):
    """One table from CSV and Parquet files, read by name of column."""
    spark, rows = px.sparkSession, px.select("aoi", "date", "B8")
    paths = [sinks.shared_folder(spark, n) for n in ("csv", "parquet")]
    late = F.col("date") > "2025-09-30"
    rows.where(~late).write.option("header", True).csv(paths[0])
    rows.where(late).select("B8", "date", "aoi").write.parquet(paths[1])
    both = spark.read.schema(rows.schema).option("header", True).csv(paths[0]).unionByName(spark.read.parquet(paths[1]))
    return both.groupBy("aoi").agg(F.count(F.lit(1)).alias("n"), F.sum("B8").alias("b8"))


@query("sc17_sidecars", "SELECT aoi, date, count(*) AS rows, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS crop FROM px GROUP BY aoi, date", ("px",))
def _(px):
    """Sidecars of all images, one JSON line each, read with their schema."""
    facts = px.groupBy("aoi", "date").agg(F.count(F.lit(1)).alias("rows"), F.count_if(crop()).alias("crop"))
    path = sinks.shared_folder(px.sparkSession, "sidecars")
    facts.write.json(path)
    return px.sparkSession.read.schema(facts.schema).json(path)


@query("sc19_discovery", "SELECT * FROM (VALUES ('index', 'b_index_mask', true), ('smoothed', 'a_smoothed_mosaic', true), ('raw', NULL, false)) t(artifact, name, found)")
def _(spark, sf_dir):
    """Artifacts of a run by the patterns of their names; a missing optional one is NULL."""
    base = sinks.shared_folder(spark, "run")
    for name in ("b_index_mask", "a_smoothed_mosaic", "notes"):
        spark.range(1).write.parquet(f"{base}/{name}")
    found = sinks.discover(spark, base, {"index": ("*_index_mask",), "smoothed": ("*_smooth_mosaic", "*_smoothed_mosaic"), "raw": ("*_raw_mosaic",)}, ("raw",))
    rows = [(k, p and p.rsplit("/", 1)[-1], p is not None) for k, p in found.items()]
    return spark.createDataFrame(rows, "artifact string, name string, found boolean")


@query("sk12_stage_record", "SELECT * FROM (VALUES ('count', 'done'), ('label', 'failed'), ('count', 'done')) t(stage, status)")
def _(spark, sf_dir):
    """Stages of a run with their outcome, one of them failing."""
    record = sinks.Stages(spark, sinks.shared_folder(spark, "stages"))
    for name, table in (("count", "orders"), ("label", "no_such_table"), ("count", "orders")):
        try:
            with record.stage(name):
                spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
        except Exception as e:  # noqa: BLE001 - the record shows the failure
            if name == "count":
                raise e
    return record.table().select("stage", "status")
