"""Further queries of the catalog: discovery, reports, chips, masks, entry points and streams."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from ..functions import dates, series, spectral
from ..operators import compose, evaluate, spatial, stats
from ..streaming import runs
from .catalog import _CONF, _CURVE, _DATES, _PHENOLOGY, START, _coverage, crop, query, rounded

# Discovery


@query("sc10_date_names", "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN concat('Band_', CAST(event_id AS VARCHAR)) ELSE CAST(day AS VARCHAR) END AS name FROM obs", ("obs",))
def _(obs):
    """Dates of band names with a known prefix; a numbered name for others."""
    text = F.when(F.col("event_id") % 4 == 3, F.concat(F.lit("mask_"), F.date_format("day", "yyyy_MM_dd"))).otherwise(F.concat(F.lit("ndvi_"), F.date_format("day", "yyyy_MM_dd")))
    band, day = dates.parse_band(text)
    return obs.select("event_id", F.coalesce(F.when(band.isin("ndvi", "red", "nir"), day.cast("string")), F.concat(F.lit("Band_"), F.col("event_id"))).alias("name"))


@query("sc14_partition_scan", "SELECT k, B8 AS b8 FROM px WHERE aoi = 'aoi_2' AND date = '2025-09-15'", ("px",))
def _(px):
    return px.where("aoi = 'aoi_2' and date = '2025-09-15'").select("k", F.col("B8").alias("b8"))


@query("sc18_image_names", "SELECT DISTINCT aoi, CAST(substr(date, 6, 2) AS INTEGER) AS month, strftime(CAST(date AS DATE), '%B') AS label FROM px", ("px",))
def _(px):
    """Site and month read from image file names."""
    name = F.concat(F.lit("static_"), "aoi", F.lit("_"), F.translate("date", "-", ""), F.lit(".tif"))
    pattern = r"^static_(.+)_(\d{8})\.tif$"
    day = F.try_to_date(F.regexp_extract("name", pattern, 2), "yyyyMMdd")
    return px.select("aoi", "date").distinct().select(name.alias("name")).select(F.regexp_extract("name", pattern, 1).alias("aoi"), F.month(day).alias("month"), F.date_format(day, "MMMM").alias("label")).distinct()


@query("sc23_site_catalog", "SELECT field_id, 'first' AS src FROM fields WHERE x0 < 100 UNION ALL SELECT field_id, 'third' AS src FROM fields WHERE field_id IN (3, 5, 8, 13, 21)", ("fields",))
def _(fields):
    third = fields.where(F.col("field_id").isNotNull() & F.col("field_id").isin(3, 5, 8, 13, 21))
    return fields.where("x0 < 100").select("field_id", F.lit("first").alias("src")).unionByName(third.select("field_id", F.lit("third").alias("src")))


@query("sc24_orbit_scan", "SELECT CAST(lon AS BIGINT) AS orbit, count(*) AS n FROM items WHERE baseline IS NOT NULL GROUP BY 1 HAVING count(*) >= 8", ("items",))
def _(items):
    """Items of one orbit state by a property map; orbits of under eight items are left out."""
    props = F.create_map(F.lit("sat:orbit_state"), F.when(F.col("baseline").isNull(), "descending").otherwise("ascending"))
    kept = items.withColumn("props", props).where(F.col("props")["sat:orbit_state"] == "ascending")
    return kept.groupBy(F.col("lon").cast("bigint").alias("orbit")).agg(F.count(F.lit(1)).alias("n")).where("n >= 8")


@query("sk6_sidecar_json", "SELECT label, count(*) AS n, max(B8) AS top, 0.5 AS threshold FROM px GROUP BY label", ("px",))
def _(px):
    """Training facts written as JSON and read again."""
    facts = px.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max("B8").alias("top")).withColumn("threshold", F.lit(0.5))
    kept = facts.select(F.to_json(F.struct(*facts.columns)).alias("doc"))
    return kept.select(F.from_json("doc", "label bigint, n bigint, top bigint, threshold double").alias("d")).select("d.*")


# Reports


@query("ag4_median_of_medians", "SELECT date, quantile_cont(m, 0.5) AS m FROM (SELECT aoi, date, quantile_cont(B8, 0.5) AS m FROM px GROUP BY aoi, date) t GROUP BY date", ("px",))
def _(px):
    return stats.centres(px, ["aoi", "date"], ["B8"]).groupBy("date").agg(F.percentile("B8", F.lit(0.5)).alias("m"))


@query("ag28_recall_and_false", "SELECT date, round(avg(CASE WHEN label = 1 THEN CASE WHEN prob >= 0.5 THEN 1.0 ELSE 0.0 END END), 6) AS recall, round(avg(CASE WHEN label <> 1 THEN CASE WHEN prob >= 0.5 THEN 1.0 ELSE 0.0 END END), 6) AS false_rate FROM scores GROUP BY date", ("scores",))
def _(scores):
    hit = F.when(F.col("prob") >= 0.5, 1.0).otherwise(0.0)
    return rounded(scores.groupBy("date").agg(F.avg(F.when(crop(), hit)).alias("recall"), F.avg(F.when(~crop(), hit)).alias("false_rate")), "recall", "false_rate")


@query("ag31_class_report", """, n AS (SELECT label, CASE WHEN prob >= 0.5 THEN 1 ELSE 4 END AS pred, count(*) AS n FROM scores GROUP BY 1, 2),
q AS (SELECT cls, sum(CASE WHEN label = cls AND pred = cls THEN n ELSE 0 END) AS tp, sum(CASE WHEN pred = cls THEN n ELSE 0 END) AS p, sum(CASE WHEN label = cls THEN n ELSE 0 END) AS a FROM n CROSS JOIN (VALUES (1), (4)) v(cls) GROUP BY cls)
SELECT CAST(cls AS INTEGER) AS cls, round(CAST(tp AS DOUBLE) / nullif(p, 0), 6) AS precision, round(CAST(tp AS DOUBLE) / nullif(a, 0), 6) AS recall, round(2.0 * tp / nullif(p + a, 0), 6) AS f1 FROM q""", ("scores",))
def _(scores):
    """Per-class report from one count per (actual, predicted)."""
    n = scores.groupBy("label", F.when(F.col("prob") >= 0.5, 1).otherwise(4).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    rows = n.withColumn("cls", F.explode(F.array(F.lit(1), F.lit(4))))
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    mine, said = F.col("label") == F.col("cls"), F.col("pred") == F.col("cls")
    q = rows.groupBy("cls").agg(total(mine & said).alias("tp"), total(said).alias("p"), total(mine).alias("a"))
    return rounded(q.select("cls", F.try_divide("tp", "p").alias("precision"), F.try_divide("tp", "a").alias("recall"), F.try_divide(2 * F.col("tp"), F.col("p") + F.col("a")).alias("f1")), "precision", "recall", "f1")


@query("ag32_fold_summary", ", f AS (SELECT coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS r, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM (" + _CONF + ") t) SELECT round(avg(r), 6) AS recall_mean, round(min(r), 6) AS recall_min, round(max(r) - min(r), 6) AS recall_range, round(avg(f1), 6) AS f1_mean, round(min(f1), 6) AS f1_min FROM f", ("scores",))
def _(scores):
    folds = evaluate.confusion(scores, ["aoi"], crop(), F.col("prob") >= 0.5)
    out = folds.agg(F.avg("recall").alias("recall_mean"), F.min("recall").alias("recall_min"), (F.max("recall") - F.min("recall")).alias("recall_range"), F.avg("f1").alias("f1_mean"), F.min("f1").alias("f1_min"))
    return rounded(out, *out.columns)


@query("ag34_extraction_check", """, f AS (SELECT date, 'B2' AS feature, CAST(B2 AS DOUBLE) AS x FROM px WHERE label = 1 UNION ALL SELECT date, 'NDVI', CAST(NDVI AS DOUBLE) FROM px WHERE label = 1),
ref AS (SELECT feature, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75 FROM f WHERE date = '2025-11-15' GROUP BY feature),
sh AS (SELECT m.date, abs((m.x - q50) / (q75 - q25)) AS s FROM (SELECT date, feature, quantile_cont(x, 0.5) AS x FROM f GROUP BY date, feature) m JOIN ref ON m.feature = ref.feature WHERE q50 <> 0 AND q75 > q25)
SELECT date, round(max(s), 6) AS worst, max(s) < 0.25 AS same FROM sh GROUP BY date""", ("px",))
def _(px):
    """Crop medians of each date against the reference date's quartiles: alike if none moves by a quarter IQR."""
    rows = px.where(crop())
    ref = stats.quantile_table(rows.where("date = '2025-11-15'"), ["B2", "NDVI"], F.lit("positive")).where("role = 'pooled'")
    worst = F.max(F.abs("shift"))
    return rounded(stats.domain_shift(rows, ["date"], ["B2", "NDVI"], ref).groupBy("date").agg(worst.alias("worst"), (worst < 0.25).alias("same")), "worst")


@query("ag36_caught_and_lost", "SELECT district, round(avg(CASE WHEN label = 2 THEN CASE WHEN m >= 0.5 THEN 1.0 ELSE 0.0 END END), 6) AS caught, round(avg(CASE WHEN label = 1 THEN CASE WHEN m >= 0.5 THEN 1.0 ELSE 0.0 END END), 6) AS lost FROM (SELECT pixel_id, district, label, avg(v) AS m FROM long GROUP BY pixel_id, district, label) t GROUP BY district", ("series",))
def _(s):
    hit = F.when(series.mean(F.col("s")) >= 0.5, 1.0).otherwise(0.0)
    out = s.select("district", "label", hit.alias("hit")).groupBy("district").agg(F.avg(F.when(F.col("label") == 2, F.col("hit"))).alias("caught"), F.avg(F.when(F.col("label") == 1, F.col("hit"))).alias("lost"))
    return rounded(out, "caught", "lost")


@query("ag40_cube", "SELECT aoi, date, count(*) AS n FROM px GROUP BY CUBE (aoi, date)", ("px",))
def _(px):
    return px.cube("aoi", "date").agg(F.count(F.lit(1)).alias("n"))


@query("tk9_curve_argmax", _CURVE + "SELECT CAST(prob AS DOUBLE) AS t, round(2 * precision * recall / (precision + recall + 1e-10), 6) AS f1 FROM pr ORDER BY 2 * precision * recall / (precision + recall + 1e-10) DESC, prob LIMIT 1", ("scores",))
def _(scores):
    """Score of the best F1 on the curve; the lowest wins a tie."""
    c = evaluate.pr_curve(scores, crop(), "prob")
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + 1e-10)
    return rounded(evaluate.best_threshold(c.select(F.col("prob").cast("double").alias("t"), f1.alias("f1"))), "f1")


@query("wi8_top_groups", "SELECT k, count(*) AS n FROM px GROUP BY k ORDER BY n DESC, k LIMIT 10", ("px",))
def _(px):
    return px.groupBy("k").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "k").limit(10)


# Grids, chips and masks


@query("sp9_overviews", " UNION ALL ".join(f"SELECT {k} AS factor, CAST(floor(r / {k}) AS BIGINT) AS r, CAST(floor(c / {k}) AS BIGINT) AS c, round(avg(v), 6) AS v FROM grid GROUP BY 2, 3" for k in (2, 4, 8, 16)), ("grid",))
def _(grid):
    levels = [compose.overview(grid, "r", "c", F.col("v"), k).select(F.lit(k).alias("factor"), "r", "c", "v") for k in (2, 4, 8, 16)]
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return rounded(out, "v")


@query("wi7_best_chip", """, cell AS (SELECT CAST(floor(r / 5) AS BIGINT) AS gr, CAST(floor(c / 5) AS BIGINT) AS gc, sum(CASE WHEN cls = 1 THEN 1 ELSE 0 END) AS a, sum(CASE WHEN cls = 4 THEN 1 ELSE 0 END) AS b FROM grid GROUP BY 1, 2),
chip AS (SELECT gr - i AS top, gc - j AS lft, sum(a) AS a, sum(b) AS b FROM cell CROSS JOIN (SELECT unnest(range(4)) AS i) x CROSS JOIN (SELECT unnest(range(4)) AS j) y WHERE gr >= i AND gc >= j GROUP BY 1, 2)
SELECT top, lft, CAST(least(a, b) AS BIGINT) AS score FROM chip ORDER BY least(a, b) DESC, top, lft LIMIT 1""", ("grid",))
def _(grid):
    return spatial.best_chip(grid, [F.col("cls") == 1, F.col("cls") == 4], 5, 4)


@query("ge11_snap", "SELECT field_id, round_even(x0 / 7.0, 7) AS x, round_even(y0 / 7.0, 7) AS y FROM fields", ("fields",))
def _(fields):
    return fields.select("field_id", F.bround(F.col("x0") / 7.0, 7).alias("x"), F.bround(F.col("y0") / 7.0, 7).alias("y"))


@query("ge16_box_health", "SELECT (SELECT count(*) FROM fields) AS n, (SELECT CAST(sum((x1 - x0) * (y1 - y0)) AS BIGINT) FROM fields) AS area, count(*) AS n_overlaps, CAST(sum((least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0))) AS BIGINT) AS double_counted FROM fields a JOIN fields b ON a.field_id < b.field_id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1", ("fields",))
def _(fields):
    pairs = spatial.box_join(fields, fields, 16, ("field_id", "field_id")).where("l_field_id < r_field_id")
    whole = fields.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"))
    return whole.join(F.broadcast(pairs.agg(F.count(F.lit(1)).alias("n_overlaps"), F.sum(spatial.overlap_area()).alias("double_counted"))))  # one row each


_INSIDE = "EXISTS (SELECT 1 FROM fields f WHERE {} g.c * 4 + 2 >= f.x0 AND g.c * 4 + 2 < f.x1 AND g.r * 2 + 1 >= f.y0 AND g.r * 2 + 1 < f.y1)"


def _covered(grid, boxes):
    px = grid.select("r", "c", (F.col("c") * 4 + 2).alias("x"), (F.col("r") * 2 + 1).alias("y"))
    hit = spatial.assign_pixels(px, boxes, 16, "field_id").select("r", "c", F.lit(True).alias("inside"))
    return grid.join(hit, ["r", "c"], "left")


@query("ge19_crop_map", "SELECT r, c, CAST(CASE WHEN " + _INSIDE.format("") + " THEN 1 ELSE 4 END AS INTEGER) AS cls FROM grid g", ("grid", "fields"))
def _(grid, fields):
    return _covered(grid, fields).select("r", "c", F.when(F.col("inside"), 1).otherwise(4).alias("cls"))


@query("ml16_never_mask", "SELECT r, c, CASE WHEN cls = 1 AND " + _INSIDE.format("f.x1 - f.x0 >= 12 AND") + " THEN 4 ELSE cls END AS cls FROM grid g", ("grid", "fields"))
def _(grid, fields):
    """Crop pixels inside the mask's boxes become background."""
    return _covered(grid, fields.where("x1 - x0 >= 12")).select("r", "c", F.when((F.col("cls") == 1) & F.col("inside"), 4).otherwise(F.col("cls")).alias("cls"))


@query("ml15_residual_filter", ", u AS (SELECT k FROM scores GROUP BY k HAVING count(prob) >= 3 AND quantile_cont(prob, 0.5) >= 0.35 AND avg(CASE WHEN label = 4 THEN 1.0 ELSE 0.0 END) >= 0.5) SELECT s.aoi, CAST(sum(CASE WHEN u.k IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS removed, count(*) AS n FROM scores s LEFT JOIN u ON s.k = u.k GROUP BY s.aoi", ("scores",))
def _(scores):
    """Pixels of units whose median score reaches the threshold and of which half are gated."""
    units = scores.groupBy("k").agg(F.count("prob").alias("n"), F.percentile(F.col("prob").cast("double"), F.lit(0.5)).alias("m"), F.avg(F.when(F.col("label") == 4, 1.0).otherwise(0.0)).alias("g"))
    gone = units.where("n >= 3 and m >= 0.35 and g >= 0.5").select("k", F.lit(True).alias("gone"))
    return scores.join(gone, "k", "left").groupBy("aoi").agg(F.count_if(F.coalesce("gone", F.lit(False))).alias("removed"), F.count(F.lit(1)).alias("n"))


# Entry points


@query("ep1_single_composite", "SELECT pixel_id, greatest(quantile_cont(red, 0.5) - 1000, 0) AS red FROM obs WHERE cloud < 60 AND scl < 8 AND scl <> 3 GROUP BY pixel_id", ("obs",))
def _(obs):
    """One composite of the whole area, refused above a number of pixels."""
    return compose.single_composite(obs.where((F.col("cloud") < 60) & spectral.scl_keep(F.col("scl"))), ["pixel_id"], ["red"], 1000)


@query("ep9_layer_catalog", "SELECT date, concat('static_', date) AS folder, CAST(floor(count(*) OVER () / 2) + 1 AS BIGINT) AS need FROM (SELECT DISTINCT date FROM px) t", ("px",))
def _(px):
    days = px.select("date").distinct()
    need = days.agg((F.floor(F.count(F.lit(1)) / 2) + 1).cast("bigint").alias("need"))
    return days.join(F.broadcast(need)).select("date", F.concat(F.lit("static_"), "date").alias("folder"), "need")  # one row


@query("ep12_job_list", "SELECT aoi, date FROM (SELECT aoi, date FROM px WHERE date >= '2025-10-01' UNION SELECT concat('aoi_', CAST(lon % 12 AS BIGINT)) AS aoi, CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM items WHERE cloud < 20) t WHERE aoi IN (SELECT aoi FROM px)", ("px", "items"))
def _(px, items):
    """Selected pairs and existing images of known sites, each once."""
    there = items.where("cloud < 20").select(F.concat(F.lit("aoi_"), (F.col("lon") % 12).cast("bigint")).alias("aoi"), F.to_date("ts").cast("string").alias("date"))
    jobs = px.where("date >= '2025-10-01'").select("aoi", "date").unionByName(there).distinct()
    return jobs.join(px.select("aoi").distinct(), "aoi", "left_semi").select("aoi", "date")


_SCOUT = """, o AS (SELECT *, CAST(floor(pixel_id / 25) AS BIGINT) AS site FROM obs), w AS (SELECT * FROM (VALUES (DATE '2023-12-20'), (DATE '2024-01-01'), (DATE '2024-01-09'), (DATE '2024-01-17'), (DATE '2024-01-25')) t(begins)),
z AS (SELECT site, count(DISTINCT pixel_id) AS pixels FROM o GROUP BY site), p AS (SELECT site, begins, day, pixel_id, max(CASE WHEN scl NOT IN (0, 1, 3, 8, 9, 10, 11) THEN 1 ELSE 0 END) AS ok FROM o JOIN w ON day >= begins AND day < begins + 8 GROUP BY ALL),
d AS (SELECT p.site, begins, day, count(*) * 100.0 / max(pixels) AS coverage, sum(ok) * 100.0 / max(pixels) AS valid, 100 * (1 - sum(ok) / CAST(count(*) AS DOUBLE)) AS cloud FROM p JOIN z ON p.site = z.site GROUP BY p.site, begins, day),
a AS (SELECT site, begins, day, coverage FROM (SELECT *, row_number() OVER (PARTITION BY site, begins ORDER BY cloud, valid DESC, day) AS pos FROM (SELECT *, max(valid) OVER (PARTITION BY site, begins) AS best FROM d) y WHERE valid >= best - 1.0) x WHERE pos = 1)
SELECT z.site, w.begins, a.day, round(coverage, 5) AS coverage_pct, CASE WHEN a.day IS NULL THEN 'no scene in the window' END AS error FROM z CROSS JOIN w LEFT JOIN a ON z.site = a.site AND w.begins = a.begins"""


@query("ep13_scout", _SCOUT, ("obs",))
def _(obs):
    """Anchor date of each site and window; one without a scene is a row with the reason."""
    begins = [date(2023, 12, 20), *[date(2024, 1, d) for d in (1, 9, 17, 25)]]
    sites = obs.withColumn("site", F.floor(F.col("pixel_id") / 25).cast("bigint"))
    return rounded(compose.scout(sites, "site", [(b, b + timedelta(8)) for b in begins]), "coverage_pct", n=5)


@query("ep14_pilot_pairs", "SELECT aoi, max(CASE WHEN date LIKE '2025-08%' THEN date END) AS august, max(CASE WHEN date LIKE '2025-11%' THEN date END) AS november FROM px GROUP BY aoi", ("px",))
def _(px):
    month = lambda m: F.max(F.when(F.col("date").startswith(f"2025-{m}"), F.col("date")))
    return px.groupBy("aoi").agg(month("08").alias("august"), month("11").alias("november"))


@query("ep19_pixel_features", _PHENOLOGY + "SELECT pixel_id, round(amplitude, 5) AS amplitude, round(ndvi_mean, 5) AS ndvi_mean, round(roughness, 5) AS roughness FROM base WHERE amplitude IS NOT NULL AND ndvi_mean IS NOT NULL AND roughness IS NOT NULL", ("series",))
def _(s):
    names = ["amplitude", "ndvi_mean", "roughness"]
    return rounded(s.select("pixel_id", *series.features(F.col("s"), names)).dropna(), *names, n=5)


@query("ep23_compare_runs", "SELECT coalesce(a.origin, b.origin) AS origin, a.acres AS before, b.acres AS after FROM (SELECT field_id % 5 AS origin, CAST(sum((x1 - x0) * (y1 - y0)) AS BIGINT) AS acres FROM fields WHERE x0 < 200 GROUP BY 1) a FULL JOIN (SELECT field_id % 7 AS origin, CAST(sum((x1 - x0) * (y1 - y0)) AS BIGINT) AS acres FROM fields WHERE x0 >= 200 GROUP BY 1) b ON a.origin = b.origin", ("fields",))
def _(fields):
    area = F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")))
    run = lambda f, k, n: f.groupBy((F.col("field_id") % k).alias("origin")).agg(area.alias(n))
    return run(fields.where("x0 < 200"), 5, "before").join(run(fields.where("x0 >= 200"), 7, "after"), "origin", "full")


# Streams


@query("st1_window_composite", "SELECT user_id, DATE '2024-01-01' + CAST(8 * floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 8.0) AS INTEGER) AS begins, quantile_cont(CASE WHEN event_id % 12 < 8 AND event_id % 12 <> 3 THEN value END, 0.5) AS value, CAST(sum(CASE WHEN event_id % 12 < 8 AND event_id % 12 <> 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_valid, count(*) AS n_scenes FROM events GROUP BY 1, 2")
def _(spark, sf_dir):
    """Tumbling median composite over the event stream (windows from 2024-01-01: three days past a multiple of eight)."""
    rows = runs.read_table(spark, f"{sf_dir}/events.parquet")
    out = runs.window_composite(rows, "ts", ["user_id"], ["value"], spectral.scl_keep(F.col("event_id") % 12), 8, 3)
    return runs.run_available(out, "complete", "composite")


@query("st4_running_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, sf_dir):
    return runs.run_available(runs.running_counts(runs.read_table(spark, f"{sf_dir}/events.parquet"), ["event_type"]), "complete", "counts")


@query("st5_sliding_counts", "SELECT event_type, CAST(d - i AS DATE) AS begins, count(*) AS n FROM (SELECT event_type, CAST(ts AS DATE) AS d FROM events) e CROSS JOIN (SELECT CAST(unnest(range(3)) AS INTEGER) AS i) s GROUP BY 1, 2")
def _(spark, sf_dir):
    out = runs.sliding_counts(runs.read_table(spark, f"{sf_dir}/events.parquet"), "ts", ["event_type"], "3 days", "1 day")
    return runs.run_available(out.withColumn("begins", F.to_date("begins")), "complete", "sliding")


@query("st5_sessions", "SELECT user_id, count(*) AS sessions, CAST(sum(n) AS BIGINT) AS n FROM (SELECT user_id, s, count(*) AS n FROM (SELECT user_id, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT user_id, ts, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events) x) y GROUP BY user_id, s) z GROUP BY user_id")
def _(spark, sf_dir):
    found = runs.run_available(runs.sessions(runs.read_table(spark, f"{sf_dir}/events.parquet"), "ts", ["user_id"], "6 hours"), "complete", "sessions")
    return found.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.sum("n").alias("n"))
