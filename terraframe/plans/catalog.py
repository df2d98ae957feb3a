"""Catalog of the library's queries and the SQL that states what each must return."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, series, spectral
from ..operators import compose, evaluate, smooth, spatial, stats
from ..sources import fixtures

FLAGSHIP = "ag8_domain_shift"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BANDS = ["B2", "B3", "B4", "B5", "B8", "NDVI"]
START = date(2024, 1, 1)


def crop():
    """Rows of the crop class."""
    return F.col("label") == 1



def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Register a function of the loaded projections it ``uses`` (or of spark, sf_dir) and its oracle."""

    def add(f):
        QUERIES[name] = (lambda spark, sf_dir: f(*[fixtures.load(spark, sf_dir, u) for u in uses])) if uses else f
        if sql is not None:
            ctes = [fixtures.oracle({"series": "long"}.get(u, u)) for u in dict.fromkeys(uses)]
            ORACLES[name] = (f"WITH {'RECURSIVE ' * ('USING KEY' in sql)}{', '.join(ctes)} " if ctes else "") + sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def rounded(df: DataFrame, *cols: str, n: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c in cols})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Sources and sinks


@query("sc1_item_search", "SELECT item_id, cloud FROM items WHERE baseline IS NOT NULL AND lon + 1 >= 64 AND lon <= 75.5 AND 25 + cloud / 10.0 >= 24.5 AND 24 + cloud / 10.0 <= 27.5 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12' AND cloud < 40", ("items",))
def _(items):
    """Items of a collection whose footprint meets a box, in a half-open time range, under a cloud limit."""
    foot = items.withColumns({"collection": F.when(F.col("baseline").isNull(), "l1c").otherwise("l2a"), "x0": F.col("lon"), "x1": F.col("lon") + 1, "y0": 24 + F.col("cloud") / 10, "y1": 25 + F.col("cloud") / 10})
    return compose.search_items(foot, "l2a", (64, 24.5, 75.5, 27.5), "2024-01-05", "2024-01-12", 40).select("item_id", "cloud")


@query("sc8_decimated_scan", "SELECT r, c, cls FROM grid WHERE r % 4 = 0 AND c % 4 = 0", ("grid",))
def _(grid):
    return grid.where("r % 4 = 0 and c % 4 = 0").select("r", "c", "cls")


@query("sc9_band_parse", "SELECT event_id, CASE WHEN event_id % 3 <> 2 THEN 'red' END AS band, CASE WHEN event_id % 3 <> 2 THEN day END AS day FROM obs", ("obs",))
def _(obs):
    name = F.when(F.col("event_id") % 3 == 2, F.lit("mask")).otherwise(F.concat(F.lit("red_"), F.date_format("day", "yyyy_MM_dd")))
    band, day = dates.parse_band(name)
    return obs.select("event_id", band.alias("band"), day.alias("day"))


@query("sc11_bbox_scan", "SELECT field_id FROM fields WHERE x0 < 200 AND x1 > 100 AND y0 < 150 AND y1 > 50 AND x1 - x0 >= 11", ("fields",))
def _(fields):
    return fields.where("x0 < 200 and x1 > 100 and y0 < 150 and y1 > 50 and x1 - x0 >= 11").select("field_id")


@query("sc13_column_projection", "SELECT aoi, label, NDVI AS ndvi FROM px", ("px",))
def _(px):
    return px.select("aoi", "label", F.col("NDVI").alias("ndvi"))


@query("sc20_point_lookup", "SELECT r, c, cls FROM grid WHERE r * 100 + c = 4242", ("grid",))
def _(grid):
    row, col = spectral.pixel_row_col(F.lit(4242), 100)
    return grid.where((F.col("r") == row) & (F.col("c") == col)).select("r", "c", "cls")


@query("sc21_digest_gate", "SELECT item_id, md5(text) AS digest FROM benchmark WHERE md5(text) < '8'")
def _(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.md5(F.col("text").cast("binary")).alias("digest")).where("digest < '8'")


@query("sk3_mosaic_view", "SELECT r AS row, c AS col, cls FROM grid UNION ALL SELECT r + 1000 AS row, c AS col, cls FROM grid", ("grid",))
def _(grid):
    tile = lambda off: grid.select((F.col("r") + off).alias("row"), F.col("c").alias("col"), "cls")
    return tile(0).unionByName(tile(1000))


@query("sk11_label_update", "SELECT pixel_id, CASE WHEN pixel_id = 17 AND lower(trim(' Fallow')) <> CASE WHEN label = 1 THEN 'cane' ELSE 'orchard' END THEN 'fallow' WHEN label = 1 THEN 'cane' ELSE 'orchard' END AS name FROM (SELECT DISTINCT pixel_id, label FROM long) t", ("series",))
def _(s):
    old = F.when(F.col("label") == 1, "cane").otherwise("orchard")
    return s.select("pixel_id", F.when((F.col("pixel_id") == 17) & (old != "fallow"), "fallow").otherwise(old).alias("name"))


# Projections


@query("pr1_safe_divide", "SELECT k, round(CAST(B4 AS DOUBLE) / nullif(B8, 0), 6) AS q FROM px", ("px",))
def _(px):
    return rounded(px.select("k", spectral.safe_divide(F.col("B4"), F.col("B8")).alias("q")), "q")


@query("pr2_features", """SELECT k, round(10000 * CAST(B8 - B3 AS DOUBLE) / nullif(B8 + B3, 0), 4) AS gndvi, round(10000 * CAST(B8 - B5 AS DOUBLE) / nullif(B8 + B5, 0), 4) AS ndre,
  round(10000 * CAST(B3 - B8 AS DOUBLE) / nullif(B3 + B8, 0), 4) AS ndwi, round(10000 * CAST(B4 AS DOUBLE) / nullif(B3, 0), 4) AS r43, round(10000 * CAST(B2 AS DOUBLE) / nullif(B8, 0), 4) AS r28 FROM px""", ("px",))
def _(px):
    return rounded(px.select("k", *[spectral.feature(n, BANDS).alias(n.lower()) for n in ("GNDVI", "NDRE", "NDWI", "R43", "R28")]), "gndvi", "ndre", "ndwi", "r43", "r28", n=4)


@query("pr7_ndvi", "SELECT event_id, round(CASE WHEN nir + red > 0 THEN CAST(nir - red AS DOUBLE) / (nir + red) END, 6) AS ndvi FROM obs", ("obs",))
def _(obs):
    return rounded(obs.select("event_id", spectral.ndvi(F.col("nir"), F.col("red")).alias("ndvi")), "ndvi")


@query("pr8_landsat_ndvi", "SELECT event_id, round(((nir * 10) * 0.0000275 - (red * 10) * 0.0000275) / nullif((nir * 10) * 0.0000275 - 0.2 + (red * 10) * 0.0000275 - 0.2, 0), 4) AS ndvi FROM obs WHERE red > 1000", ("obs",))
def _(obs):
    d = lambda c: F.col(c).cast("double") * 10
    return rounded(obs.where("red > 1000").select("event_id", spectral.landsat_ndvi(d("nir"), d("red")).alias("ndvi")), "ndvi", n=4)


@query("pr12_baseline_offset", "SELECT CAST(lon AS BIGINT) AS lon, CAST(CASE WHEN 2 * sum(CASE WHEN baseline >= 4 OR (baseline IS NULL AND ts >= TIMESTAMP '2022-01-25') THEN 1 ELSE 0 END) >= count(*) THEN 1000 ELSE 0 END AS INTEGER) AS dn_offset FROM items GROUP BY lon", ("items",))
def _(items):
    newer = F.coalesce(F.col("baseline") >= 4, F.col("ts") >= F.lit("2022-01-25").cast("timestamp"))
    return compose.baseline_offset(items, [F.col("lon").cast("bigint").alias("lon")], newer)


@query("pr13_offset_clip", "SELECT event_id, CASE WHEN scl <> 3 THEN greatest(red - 1000, 0) END AS red FROM obs", ("obs",))
def _(obs):
    return obs.select("event_id", spectral.offset_clip(F.when(F.col("scl") != 3, F.col("red")), 1000).alias("red"))


@query("pr14_pack_uint16", "SELECT event_id, CAST(CASE WHEN scl = 3 THEN 0 ELSE least(65535, nir * 20) END AS INTEGER) AS packed FROM obs", ("obs",))
def _(obs):
    return obs.select("event_id", spectral.pack_uint16(F.when(F.col("scl") != 3, F.col("nir") * 20)).alias("packed"))


@query("pr15_decibel", "SELECT event_id, round(CASE WHEN red > 310 THEN 10 * log10(CAST(red - 310 AS DOUBLE)) END, 5) AS db FROM obs", ("obs",))
def _(obs):
    return rounded(obs.select("event_id", spectral.decibel((F.col("red") - 310).cast("double")).alias("db")), "db", n=5)


@query("pr16_snap", "SELECT field_id, CAST(floor(x0 / 30.0) * 30 AS BIGINT) AS sx, CAST(floor(y1 / 30.0) * 30 AS BIGINT) AS sy FROM fields", ("fields",))
def _(fields):
    return fields.select("field_id", spectral.snap(F.col("x0"), 30.0).cast("bigint").alias("sx"), spectral.snap(F.col("y1"), 30.0).cast("bigint").alias("sy"))


@query("pr17_pixel_index", "SELECT r * 100 + c AS pixel_id, r AS row, c AS col FROM grid", ("grid",))
def _(grid):
    coded = grid.select(spectral.pixel_id(F.col("r"), F.col("c"), 100).alias("pixel_id"))
    row, col = spectral.pixel_row_col(F.col("pixel_id"), 100)
    return coded.select("pixel_id", row.alias("row"), col.alias("col"))


@query("pr18_acres", "SELECT cls, round(count(*) * 100.0 / 4046.8564224, 6) AS acres FROM grid GROUP BY cls", ("grid",))
def _(grid):
    return rounded(grid.groupBy("cls").agg(spectral.acres(F.count(F.lit(1))).alias("acres")), "acres")


@query("pr19_threshold_class", "SELECT k, CAST(CASE WHEN prob >= 0.5 THEN 1 ELSE 4 END AS INTEGER) AS cls FROM scores", ("scores",))
def _(scores):
    return scores.select("k", spectral.classify(F.col("prob").cast("double"), 0.5).alias("cls"))


@query("pr20_remap", "SELECT k, CAST(CASE label WHEN 1 THEN 1 WHEN 4 THEN 0 END AS INTEGER) AS y FROM px", ("px",))
def _(px):
    return px.select("k", spectral.remap(F.col("label"), {1: 1, 4: 0}).alias("y"))


@query("pr9_normalise_band", "SELECT vec_id, regexp_replace(lower(trim(CASE WHEN vec_id % 2 = 0 THEN ' Red-Edge_1 ' ELSE 'B 08' END)), '[-_ ]', '', 'g') AS band FROM embeddings")
def _(spark, sf_dir):
    name = F.when(F.col("vec_id") % 2 == 0, " Red-Edge_1 ").otherwise("B 08")
    return table(spark, sf_dir, "embeddings").select("vec_id", spectral.normalise_band(name).alias("band"))


@query("pr23_month", "SELECT substr(date, 1, 7) AS month, count(*) AS n FROM px GROUP BY 1", ("px",))
def _(px):
    return px.groupBy(F.substring("date", 1, 7).alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("pr27_polygon_metrics", "SELECT field_id, round(CAST((x1 - x0) * (y1 - y0) AS DOUBLE), 6) AS area, round(CAST(2 * (x1 - x0 + y1 - y0) AS DOUBLE), 6) AS perimeter, round(4 * pi() * (x1 - x0) * (y1 - y0) / power(2.0 * (x1 - x0 + y1 - y0), 2), 6) AS compact, round(2.0 * (x1 - x0 + y1 - y0) / (4 * sqrt(CAST((x1 - x0) * (y1 - y0) AS DOUBLE))), 6) AS slender FROM fields", ("fields",))
def _(fields):
    d = lambda *c: F.array(*[F.col(x).cast("double") for x in c])
    ring = fields.withColumn("xs", d("x0", "x1", "x1", "x0", "x0")).withColumn("ys", d("y0", "y0", "y1", "y1", "y0"))
    m = ring.withColumn("area", spatial.ring_area(F.col("xs"), F.col("ys"))).withColumn("perimeter", spatial.ring_length(F.col("xs"), F.col("ys")))
    return rounded(m.select("field_id", "area", "perimeter", spatial.compactness(F.col("area"), F.col("perimeter")).alias("compact"), spatial.slenderness(F.col("area"), F.col("perimeter")).alias("slender")), "area", "perimeter", "compact", "slender")


@query("pr29_window_names", "SELECT DISTINCT concat('red_', strftime(day, '%Y_%m_%d')) AS name FROM obs", ("obs",))
def _(obs):
    return obs.select(dates.band_name("red", F.col("day")).alias("name")).distinct()


# Series

_PHENOLOGY = """, n AS (SELECT pixel_id, step, v, v - lag(v) OVER (PARTITION BY pixel_id ORDER BY step) AS d, count(*) OVER (PARTITION BY pixel_id) AS steps,
  sum(CASE WHEN coalesce(v > 0.6, false) THEN 0 ELSE 1 END) OVER (PARTITION BY pixel_id ORDER BY step) AS isle FROM long),
runs AS (SELECT pixel_id, max(l) AS best FROM (SELECT pixel_id, isle, sum(CASE WHEN v > 0.6 THEN 1 ELSE 0 END) AS l FROM n GROUP BY pixel_id, isle) z GROUP BY pixel_id),
base AS (SELECT pixel_id, max(steps) AS steps, min(v) AS lo, max(v) AS hi, quantile_cont(v, 0.95) - quantile_cont(v, 0.05) AS amplitude, avg(v) AS ndvi_mean, stddev_pop(v) AS ndvi_std,
  quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS interquartile, min(d) AS sharpest_fall, max(d) AS sharpest_rise, sum(CASE WHEN v < 0.45 THEN 1 ELSE 0 END) AS below,
  CAST(sum(CASE WHEN v > 0.6 THEN 1 ELSE 0 END) AS DOUBLE) / count(v) AS fraction_above_green, stddev_pop(d) AS roughness FROM n GROUP BY pixel_id),
pos AS (SELECT n.pixel_id, min(CASE WHEN v = lo THEN step END) AS t, min(CASE WHEN v = hi THEN step END) AS p FROM n JOIN base b ON n.pixel_id = b.pixel_id GROUP BY n.pixel_id) """


@query("ar5_phenology", _PHENOLOGY + """SELECT b.pixel_id, round(amplitude, 5) AS amplitude, round(lo, 5) AS ndvi_min, round(hi, 5) AS ndvi_max, round(ndvi_mean, 5) AS ndvi_mean, round(ndvi_std, 5) AS ndvi_std, round(interquartile, 5) AS interquartile,
  round(sharpest_fall, 5) AS sharpest_fall, round(sharpest_rise, 5) AS sharpest_rise, CAST(below AS DOUBLE) AS steps_below_bare, round(fraction_above_green, 5) AS fraction_above_green, round(roughness, 5) AS roughness,
  round(CAST(t AS DOUBLE) / (steps - 1), 5) AS trough_position, round(CAST(p AS DOUBLE) / (steps - 1), 5) AS peak_position, round(CAST(best AS DOUBLE) / steps, 5) AS green_span
FROM base b JOIN pos ON b.pixel_id = pos.pixel_id JOIN runs ON b.pixel_id = runs.pixel_id""", ("series",))
def _(s):
    return rounded(s.select("pixel_id", *series.features(F.col("s"))), *series.FEATURES, n=5)


@query("ar2_whittaker_full", None, ("series",))
def _(s):
    """Smoothed series with gaps; 64 steps."""
    return s.select("pixel_id", F.transform(smooth.whittaker(0.5)(F.col("s")), lambda x: F.round(x, 6)).alias("z"))


def _full_sql() -> str:
    rows = smooth.full_valid_matrix(64, 0.5)
    values = ", ".join(f"({i}, {j}, {w!r})" for i, row in enumerate(rows) for j, w in enumerate(row))
    return f""", m AS (SELECT * FROM (VALUES {values}) AS t(i, j, w)), y AS (SELECT pixel_id, step, coalesce(v, 0.5) AS v FROM long)
SELECT pixel_id, i AS step, round(sum(w * v), 6) AS z FROM y JOIN m ON y.step = m.j GROUP BY pixel_id, i"""


@query("ar3_whittaker_constant", _full_sql(), ("series",))
def _(s):
    whole = F.transform("s", lambda x: F.coalesce(x, F.lit(0.5)))
    z = s.select("pixel_id", F.posexplode(smooth.smooth_full(whole, smooth.full_valid_matrix(64, 0.5))).alias("step", "z"))
    return rounded(z, "z")


@query("ar3_whittaker_all_steps", None, ("series",))
def _(s):
    """All 64 steps; series with gaps are solved on their own."""
    return s.select("pixel_id", F.transform(smooth.smooth_split(F.col("s"), 64, 0.5), lambda x: F.round(x, 6)).alias("z"))


@query("ar4_date_slice", "SELECT pixel_id, step, round(v, 6) AS v FROM long WHERE step >= 10 AND step < 20", ("long",))
def _(long):
    return rounded(long.where("step >= 10 and step < 20").select("pixel_id", "step", "v"), "v")


@query("ar16_similar_series", """, t AS (SELECT step, v FROM long WHERE pixel_id = 3 AND step < 30) SELECT l.pixel_id, round(sqrt(avg((l.v - t.v) * (l.v - t.v))), 6) AS rmse FROM long l JOIN t ON l.step = t.step + 2
WHERE l.pixel_id <> 3 AND l.label = (SELECT max(label) FROM long WHERE pixel_id = 3) GROUP BY l.pixel_id ORDER BY 2, 1 LIMIT 10""", ("series",))
def _(s):
    """Nearest series of the same class by RMSE after aligning by rank (here an offset of two steps)."""
    probe = F.broadcast(s.where("pixel_id = 3").select(F.slice("s", 1, 30).alias("t"), F.col("label").alias("tl")))  # one row
    pairs = s.where("pixel_id <> 3").join(probe, F.col("label") == F.col("tl"))
    sq = series.valid(F.zip_with(F.slice("s", 3, 30), F.col("t"), lambda a, b: (a - b) * (a - b)))
    out = pairs.select("pixel_id", F.round(F.sqrt(F.aggregate(sq, F.lit(0.0), lambda a, x: a + x) / F.size(sq)), 6).alias("rmse"))
    return out.orderBy("rmse", "pixel_id").limit(10)


@query("ar17_full_outer_merge", "SELECT coalesce(a.day, b.day) AS day, CAST(a.n AS BIGINT) AS raw, CAST(b.n AS BIGINT) AS smooth FROM (SELECT day, count(*) AS n FROM obs WHERE scl < 2 GROUP BY day) a FULL JOIN (SELECT day, count(*) AS n FROM obs WHERE scl = 5 GROUP BY day) b ON a.day = b.day", ("obs",))
def _(obs):
    a = obs.where("scl < 2").groupBy("day").agg(F.count(F.lit(1)).alias("raw"))
    b = obs.where("scl = 5").groupBy("day").agg(F.count(F.lit(1)).alias("smooth"))
    return a.join(b, "day", "full").select("day", "raw", "smooth")


# Filters


@query("fi1_scl_keep", "SELECT event_id FROM obs WHERE scl < 8 AND scl <> 3", ("obs",))
def _(obs):
    return obs.where(spectral.scl_keep(F.col("scl"))).select("event_id")


@query("fi2_scl_drop", "SELECT event_id FROM obs WHERE scl NOT IN (0, 1, 3, 8, 9, 10, 11)", ("obs",))
def _(obs):
    return obs.where(spectral.scl_usable(F.col("scl"))).select("event_id")


@query("fi5_outlier_caps", "SELECT k FROM px WHERE B2 <= 3976 AND B3 <= 3940 AND B4 <= 3000 AND B5 <= 4345 AND B8 <= 6000 AND NDVI <= 9571", ("px",))
def _(px):
    return px.where(spectral.within_caps(BANDS)).select("k")


@query("fi6_valid_band", "SELECT aoi, count(*) AS n FROM px WHERE B8 > 0 GROUP BY aoi", ("px",))
def _(px):
    return px.where("B8 > 0").groupBy("aoi").agg(F.count(F.lit(1)).alias("n"))


@query("fi8_perennial_gate", _PHENOLOGY + "SELECT pixel_id FROM base WHERE lo > 0.05 AND amplitude < 0.6 AND below <= 40", ("series",))
def _(s):
    f = s.select("pixel_id", *series.features(F.col("s"), ["ndvi_min", "amplitude", "steps_below_bare"]))
    return f.where(series.perennial_gate(F.col("ndvi_min"), F.col("amplitude"), F.col("steps_below_bare"), 0.05, 0.6, 40)).select("pixel_id")


@query("fi9_label_validity", "SELECT event_id FROM obs WHERE date_diff('day', DATE '2024-01-15', day) BETWEEN -5 AND 9", ("obs",))
def _(obs):
    return obs.where(dates.label_valid(F.lit(date(2024, 1, 15)), F.col("day"), 5, 9)).select("event_id")


@query("fi11_coverage_pairs", "SELECT DISTINCT aoi, date FROM px GROUP BY aoi, date HAVING 100.0 * sum(CASE WHEN B8 > 0 THEN 1 ELSE 0 END) / count(*) >= 98", ("px",))
def _(px):
    return px.groupBy("aoi", "date").agg((F.count_if(F.col("B8") > 0) * 100.0 / F.count(F.lit(1))).alias("pct")).where("pct >= 98").select("aoi", "date")


_SEPARABLE = """, g AS (SELECT aoi, date, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS n_pos, sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS n_neg,
  (avg(CASE WHEN label = 1 THEN NDVI END) - avg(CASE WHEN label <> 1 THEN NDVI END)) / nullif(sqrt((var_samp(CASE WHEN label = 1 THEN NDVI END) + var_samp(CASE WHEN label <> 1 THEN NDVI END)) / 2), 0) AS d FROM px GROUP BY aoi, date),
st AS (SELECT aoi, date, n_pos, n_neg, CASE WHEN n_pos >= 100 AND n_neg >= 100 THEN d END AS d, CASE WHEN n_pos < 100 OR n_neg < 100 THEN 'background-only' WHEN d < 1.4 THEN 'weak' ELSE 'ok' END AS status FROM g) """


@query("ag10_separability", _SEPARABLE + "SELECT aoi, date, CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg, round(d, 5) AS d, status FROM st", ("px",))
def _(px):
    return rounded(stats.separability(px, ["aoi", "date"], "NDVI", crop(), 100, 1.4), "d", n=5)


@query("fi12_drop_weak", _SEPARABLE + "SELECT px.aoi, px.date, count(*) AS n FROM px WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.aoi = px.aoi AND st.date = px.date AND status = 'weak') GROUP BY px.aoi, px.date", ("px",))
def _(px):
    kept = stats.drop_weak(px, ["aoi", "date"], stats.separability(px, ["aoi", "date"], "NDVI", crop(), 100, 1.4))
    return kept.groupBy("aoi", "date").agg(F.count(F.lit(1)).alias("n"))


@query("fi16_min_pixels", "SELECT k, count(*) AS n FROM px GROUP BY k HAVING count(*) >= 5", ("px",))
def _(px):
    return px.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n >= 5")


@query("fi17_district_audit", "SELECT district, round(quantile_cont(CASE WHEN label = 1 THEN m END, 0.5), 6) AS cane, round(quantile_cont(CASE WHEN label = 2 THEN m END, 0.5), 6) AS orchard, coalesce(quantile_cont(CASE WHEN label = 2 THEN m END, 0.5) > quantile_cont(CASE WHEN label = 1 THEN m END, 0.5) AND avg(CASE WHEN label = 2 THEN m END) >= 0.45, false) AS usable FROM (SELECT district, label, pixel_id, avg(v) AS m FROM long GROUP BY district, label, pixel_id) t GROUP BY district", ("series",))
def _(s):
    m = s.select("district", "label", series.mean(F.col("s")).alias("m"))
    cls = lambda k: F.when(F.col("label") == k, F.col("m"))
    out = m.groupBy("district").agg(F.percentile(cls(1), F.lit(0.5)).alias("cane"), F.percentile(cls(2), F.lit(0.5)).alias("orchard"), F.avg(cls(2)).alias("_a"))
    return rounded(out.select("district", "cane", "orchard", F.coalesce((F.col("orchard") > F.col("cane")) & (F.col("_a") >= 0.45), F.lit(False)).alias("usable")), "cane", "orchard")


# Composites, mosaics and votes


@query("ag1_median_composite", "SELECT pixel_id, CAST(floor(date_diff('day', DATE '2024-01-01', day) / 8.0) AS INTEGER) AS win, quantile_cont(CASE WHEN scl < 8 AND scl <> 3 THEN red END, 0.5) AS red, quantile_cont(CASE WHEN scl < 8 AND scl <> 3 THEN nir END, 0.5) AS nir, CAST(sum(CASE WHEN scl < 8 AND scl <> 3 THEN 1 ELSE 0 END) AS BIGINT) AS n_valid, count(*) AS n_scenes FROM obs GROUP BY 1, 2", ("obs",))
def _(obs):
    return compose.median_composite(obs, START, 8, ["pixel_id"], ["red", "nir"], keep=spectral.scl_keep(F.col("scl")))


@query("ag2_valid_share", "SELECT CAST(floor(date_diff('day', DATE '2024-01-01', day) / 8.0) AS INTEGER) AS win, count(*) AS n_scenes, round(100.0 * sum(CASE WHEN scl < 8 AND scl <> 3 THEN 1 ELSE 0 END) / count(*), 6) AS valid_pct FROM obs GROUP BY 1", ("obs",))
def _(obs):
    keep = spectral.scl_keep(F.col("scl"))
    return rounded(obs.groupBy(dates.window_index(F.col("day"), START, 8).alias("win")).agg(F.count(F.lit(1)).alias("n_scenes"), (F.count_if(keep) * 100.0 / F.count(F.lit(1))).alias("valid_pct")), "valid_pct")


@query("wi1_layered_mosaic", "SELECT o.pixel_id, max(CASE WHEN ok AND event_id = m THEN red END) AS red, max(CASE WHEN ok AND event_id = m THEN nir END) AS nir, coalesce(max(m), 0) AS source_rank FROM (SELECT *, scl NOT IN (0, 1, 3, 8, 9, 10, 11) AS ok FROM obs) o LEFT JOIN (SELECT pixel_id, min(event_id) AS m FROM obs WHERE scl NOT IN (0, 1, 3, 8, 9, 10, 11) GROUP BY pixel_id) f ON o.pixel_id = f.pixel_id GROUP BY o.pixel_id", ("obs",))
def _(obs):
    return compose.layered_mosaic(obs, ["pixel_id"], "event_id", ["red", "nir"], spectral.scl_usable(F.col("scl")))


@query("wi2_added_share", "SELECT source_rank, count(*) AS n, round(count(*) * 100.0 / (SELECT count(DISTINCT pixel_id) FROM obs), 6) AS pct FROM (SELECT pixel_id, coalesce(min(CASE WHEN scl IN (2, 4) THEN CAST(strftime(day, '%d') AS BIGINT) END), 0) AS source_rank FROM obs GROUP BY pixel_id) t GROUP BY source_rank", ("obs",))
def _(obs):
    ranked = obs.withColumn("rank", F.dayofmonth("day").cast("bigint"))
    return rounded(compose.added_share(compose.layered_mosaic(ranked, ["pixel_id"], "rank", ["red"], F.col("scl").isin(2, 4))), "pct")


_VOTES = """, m AS (SELECT r, c, cls FROM grid UNION ALL SELECT r, c, CASE WHEN (r * 31 + c * 7) % 5 = 0 THEN 1 ELSE cls END FROM grid UNION ALL SELECT r, c, CASE WHEN (r * 13 + c * 3) % 4 = 0 THEN 4 ELSE cls END FROM grid),
f AS (SELECT r, c, max(CASE WHEN cls <> 255 THEN 1 ELSE 0 END) AS seen, sum(CASE WHEN cls = 1 THEN 1 ELSE 0 END) AS votes FROM m GROUP BY r, c) """


def _maps(grid: DataFrame) -> DataFrame:
    alter = lambda cond, v: grid.select("r", "c", F.when(F.expr(cond), v).otherwise(F.col("cls")).alias("cls"))
    return grid.select("r", "c", "cls").unionByName(alter("(r * 31 + c * 7) % 5 = 0", 1)).unionByName(alter("(r * 13 + c * 3) % 4 = 0", 4))


@query("ag26_vote_fusion", _VOTES + "SELECT r, c, CAST(votes AS INTEGER) AS votes, CAST(CASE WHEN seen = 0 THEN 255 WHEN votes >= 1 THEN 1 ELSE 4 END AS INTEGER) AS any_vote, CAST(CASE WHEN seen = 0 THEN 255 WHEN votes >= 2 THEN 1 ELSE 4 END AS INTEGER) AS majority FROM f", ("grid",))
def _(grid):
    return compose.vote_fusion(_maps(grid), ["r", "c"], "cls", 1, 255, 2)


@query("se5_vote_summary", _VOTES + "SELECT CAST(votes AS INTEGER) AS votes, count(*) AS n FROM f WHERE seen = 1 GROUP BY votes", ("grid",))
def _(grid):
    return compose.vote_fusion(_maps(grid), ["r", "c"], "cls", 1, 255, 2).where("any_vote <> 255").groupBy("votes").agg(F.count(F.lit(1)).alias("n"))


@query("se2_first_wins", "SELECT a.r, a.c, CASE WHEN a.c < 60 THEN a.v ELSE a.v + 1 END AS v FROM grid a", ("grid",))
def _(grid):
    left = grid.where("c < 60").select("r", "c", "v", F.lit(0).alias("o"))
    right = grid.where("c >= 40").select("r", "c", (F.col("v") + 1).alias("v"), F.lit(1).alias("o"))
    return compose.first_wins(left.unionByName(right), ["r", "c"], "v", "o")


@query("se4_pixel_sets", "SELECT CAST(sum(CASE WHEN a = 1 AND b = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_both, CAST(sum(CASE WHEN a <> 1 AND b = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_new FROM (SELECT cls AS a, CASE WHEN (r * 31 + c * 7) % 5 = 0 THEN 1 ELSE cls END AS b FROM grid) t", ("grid",))
def _(grid):
    old = grid.where("cls = 1").select("r", "c")
    new = grid.where("cls = 1 or (r * 31 + c * 7) % 5 = 0").select("r", "c")
    both, added = new.intersect(old), new.exceptAll(old)
    return both.agg(F.count(F.lit(1)).alias("n_both")).join(added.agg(F.count(F.lit(1)).alias("n_new")))


_DATES = """, p AS (SELECT day, pixel_id, max(CASE WHEN scl NOT IN (0, 1, 3, 8, 9, 10, 11) THEN 1 ELSE 0 END) AS ok FROM obs GROUP BY day, pixel_id),
s AS (SELECT day, count(*) * 100.0 / (SELECT count(DISTINCT pixel_id) FROM obs) AS coverage_pct, sum(ok) * 100.0 / (SELECT count(DISTINCT pixel_id) FROM obs) AS valid_pct FROM p GROUP BY day),
q AS (SELECT *, 100 * (1 - valid_pct / coverage_pct) AS cloud_pct FROM s) """


def _coverage(obs: DataFrame) -> DataFrame:
    return compose.date_coverage(obs, obs.select("pixel_id").distinct().count())


@query("tk4_date_coverage", _DATES + "SELECT day, round(coverage_pct, 5) AS coverage_pct, round(valid_pct, 5) AS valid_pct, round(cloud_pct, 5) AS cloud_pct FROM q", ("obs",))
def _(obs):
    return rounded(_coverage(obs), "coverage_pct", "valid_pct", "cloud_pct", n=5)


@query("tk1_anchor_date", _DATES + "SELECT day, round(valid_pct, 5) AS valid_pct FROM q WHERE valid_pct >= (SELECT max(valid_pct) FROM q) - 1.0 ORDER BY cloud_pct, valid_pct DESC, day LIMIT 1", ("obs",))
def _(obs):
    return rounded(compose.anchor_date(_coverage(obs)).select("day", "valid_pct"), "valid_pct", n=5)


@query("tk2_date_penalty", _DATES + ", a AS (SELECT day AS anchor FROM q WHERE valid_pct >= (SELECT max(valid_pct) FROM q) - 1.0 ORDER BY cloud_pct, valid_pct DESC, day LIMIT 1) SELECT day, round(abs(date_diff('day', anchor, day)) + cloud_pct / 5, 5) AS penalty FROM q CROSS JOIN a WHERE abs(date_diff('day', anchor, day)) <= 10", ("obs",))
def _(obs):
    q = _coverage(obs)
    one = F.broadcast(compose.anchor_date(q).select(F.col("day").alias("anchor")))  # one row
    gap = F.abs(F.datediff("day", "anchor"))
    return rounded(q.join(one, gap <= 10).select("day", (gap + F.col("cloud_pct") / 5).alias("penalty")), "penalty", n=5)


def _greedy_sql(n_dates: int) -> str:
    text = ", s AS (SELECT DISTINCT pixel_id, day FROM obs WHERE scl NOT IN (0, 1, 3, 8, 9, 10, 11)), n AS (SELECT count(DISTINCT pixel_id) AS n FROM obs), d0 AS (SELECT CAST(NULL AS DATE) AS day, 0 AS c WHERE false)"
    for k in range(1, n_dates + 1):
        before = " UNION ALL ".join(f"SELECT day, c FROM d{i}" for i in range(k))
        more = f" AND EXISTS (SELECT 1 FROM d{k - 1}) AND 100.0 * c / (SELECT n FROM n) >= 0.5" if k > 1 else ""
        text += f", b{k} AS ({before}), l{k} AS (SELECT day, count(*) AS c FROM s WHERE NOT EXISTS (SELECT 1 FROM s z JOIN b{k} ON z.day = b{k}.day WHERE z.pixel_id = s.pixel_id) GROUP BY day ORDER BY c DESC, day LIMIT 1)"
        text += f", d{k} AS (SELECT day, c FROM l{k} WHERE 100.0 * coalesce((SELECT sum(c) FROM b{k}), 0) / (SELECT n FROM n) < 99{more})"
    return text + " " + " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS rank, day FROM d{k}" for k in range(1, n_dates + 1))


@query("tk3_greedy_dates", _greedy_sql(4), ("obs",))
def _(obs):
    return obs.sparkSession.createDataFrame(list(enumerate(compose.greedy_dates(obs, 4), 1)), "rank int, day date")


@query("dt1_windows", "SELECT CAST(i AS INTEGER) AS win, DATE '2024-01-01' + CAST(i * 8 AS INTEGER) AS begins, least(DATE '2024-01-31', DATE '2024-01-01' + CAST(i * 8 + 8 AS INTEGER)) AS ends FROM (SELECT unnest(range(4)) AS i) t")
def _(spark, sf_dir):
    return spark.createDataFrame([(i, *w) for i, w in enumerate(dates.windows(START, date(2024, 1, 31), 8))], "win int, begins date, ends date")


@query("dt2_solar_day", "SELECT item_id, CAST(ts + to_seconds(CAST(lon * 240 AS BIGINT)) AS DATE) AS solar FROM items", ("items",))
def _(items):
    return items.select("item_id", dates.solar_day(F.col("ts"), F.col("lon")).alias("solar"))


@query("dt6_sidecar_override", "SELECT vec_id, CASE WHEN label = 3 THEN 0.7 ELSE 0.5 END AS threshold, CAST(label AS INTEGER) AS window_days FROM embeddings")
def _(spark, sf_dir):
    """JSON settings with defaults: a key of the override wins, a missing one falls back."""
    text = F.when(F.col("label") == 3, F.concat(F.lit('{"threshold": 0.7, "days": "'), F.col("label").cast("string"), F.lit('"}'))).otherwise(F.concat(F.lit('{"days": "'), F.col("label").cast("string"), F.lit('"}')))
    got = F.from_json(text, "threshold double, days string")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.coalesce(got["threshold"], F.lit(0.5)).alias("threshold"), got["days"].cast("int").alias("window_days"))


# Statistics


@query("ag3_group_median", "SELECT date, quantile_cont(B2, 0.5) AS b2, quantile_cont(B8, 0.5) AS b8, quantile_cont(NDVI, 0.5) AS ndvi FROM px WHERE B8 > 0 GROUP BY date", ("px",))
def _(px):
    return stats.centres(px.where("B8 > 0"), ["date"], ["B2", "B8", "NDVI"]).select("date", F.col("B2").alias("b2"), F.col("B8").alias("b8"), F.col("NDVI").alias("ndvi"))


_PAIRED = """, l AS (SELECT aoi, date, 'B2' AS feature, quantile_cont(B2, 0.5) AS value FROM px GROUP BY aoi, date UNION ALL SELECT aoi, date, 'B4', quantile_cont(B4, 0.5) FROM px GROUP BY aoi, date UNION ALL SELECT aoi, date, 'B8', quantile_cont(B8, 0.5) FROM px GROUP BY aoi, date UNION ALL SELECT aoi, date, 'NDVI', quantile_cont(NDVI, 0.5) FROM px GROUP BY aoi, date),
d AS (SELECT l.date, l.feature, quantile_cont((l.value - r.value) / r.value * 100, 0.5) AS dev FROM l JOIN l r ON l.aoi = r.aoi AND l.feature = r.feature AND r.date = '2025-11-15' WHERE r.value <> 0 GROUP BY l.date, l.feature),
k AS (SELECT feature, max(dev) - min(dev) AS range_pct, max(abs(dev)) AS worst_pct FROM d GROUP BY feature) """


def _deviations(px: DataFrame) -> DataFrame:
    return stats.paired_deviations(px, "aoi", "date", "2025-11-15", ["B2", "B4", "B8", "NDVI"])


@query("jn11_paired_deviations", _PAIRED + "SELECT date, feature, round(dev, 5) AS dev FROM d", ("px",))
def _(px):
    return rounded(_deviations(px), "dev", n=5)


@query("ag5_feature_ranking", _PAIRED + "SELECT feature, round(range_pct, 5) AS range_pct, round(worst_pct, 5) AS worst_pct FROM k", ("px",))
def _(px):
    return rounded(stats.rank_features(_deviations(px)), "range_pct", "worst_pct", n=5)


@query("tk12_feature_subset", _PAIRED + "SELECT feature FROM (SELECT *, row_number() OVER (ORDER BY range_pct, feature) AS pos FROM k) t WHERE range_pct <= 15 OR pos <= 3", ("px",))
def _(px):
    return stats.suggest_features(stats.rank_features(_deviations(px))).select("feature")


def _role():
    return F.when(crop(), "positive").otherwise("negative")


def _quantile_sql(feature: str, role: str, group: str) -> str:
    cols = ", ".join(f"quantile_cont({feature}, {q}) AS {n}" for q, n in zip(stats.QUANTILES, stats.QUANTILE_NAMES))
    return f"SELECT {role} AS role, '{feature}' AS feature, {cols} FROM px {group}"


_QUANTILES = " UNION ALL ".join(_quantile_sql(f, r, g) for f in ("B2", "NDVI") for r, g in (("CASE WHEN label = 1 THEN 'positive' ELSE 'negative' END", "GROUP BY 1"), ("'pooled'", "")))


@query("ag7_quantile_table", "SELECT * FROM (" + _QUANTILES + ") t", ("px",))
def _(px):
    return stats.quantile_table(px, ["B2", "NDVI"], _role())


@query("ag9_blended_reference", "SELECT feature, round(sum(q25 * CASE WHEN role = 'positive' THEN 1 / 3.0 ELSE 2 / 3.0 END), 5) AS q25, round(sum(q50 * CASE WHEN role = 'positive' THEN 1 / 3.0 ELSE 2 / 3.0 END), 5) AS q50 FROM (" + _QUANTILES + ") t WHERE role <> 'pooled' GROUP BY feature", ("px",))
def _(px):
    return rounded(stats.blended_reference(stats.quantile_table(px, ["B2", "NDVI"], _role()), 2.0).select("feature", "q25", "q50"), "q25", "q50", n=5)


_SHIFT = """, f AS (SELECT date, 'B2' AS feature, CAST(B2 AS DOUBLE) AS x FROM px WHERE B8 > 0 UNION ALL SELECT date, 'NDVI', CAST(NDVI AS DOUBLE) FROM px WHERE B8 > 0),
ref AS (SELECT feature, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75 FROM f WHERE date = '2025-11-15' GROUP BY feature),
sh AS (SELECT m.date, m.feature, (m.x - q50) / (q75 - q25) AS shift FROM (SELECT date, feature, quantile_cont(x, 0.5) AS x FROM f GROUP BY date, feature) m JOIN ref ON m.feature = ref.feature WHERE q50 <> 0 AND q75 > q25) """


def _shift(px: DataFrame) -> DataFrame:
    valid = px.where("B8 > 0")
    ref = stats.quantile_table(valid.where("date = '2025-11-15'"), ["B2", "NDVI"], _role()).where("role = 'pooled'")
    return stats.domain_shift(valid, ["date"], ["B2", "NDVI"], ref)


@query("ag8_domain_shift", _SHIFT + "SELECT date, round(sqrt(avg(shift * shift)), 6) AS score, CASE WHEN sqrt(avg(shift * shift)) <= 0.5 THEN 'ok' WHEN sqrt(avg(shift * shift)) <= 1.0 THEN 'warn' ELSE 'refuse' END AS verdict FROM sh GROUP BY date", ("px",))
def _(px):
    return rounded(stats.domain_verdict(_shift(px), ["date"]).select("date", "score", "verdict"), "score")


@query("tk13_worst_features", _SHIFT + "SELECT date, feature, round(abs(shift), 6) AS shift FROM sh", ("px",))
def _(px):
    return rounded(_shift(px).withColumn("shift", F.abs("shift")), "shift")


@query("ag11_cohens_d", "SELECT aoi, round((avg(CASE WHEN label = 1 THEN B4 END) - avg(CASE WHEN label <> 1 THEN B4 END)) / sqrt((var_samp(CASE WHEN label = 1 THEN B4 END) + var_samp(CASE WHEN label <> 1 THEN B4 END)) / 2), 6) AS d FROM px GROUP BY ROLLUP (aoi)", ("px",))
def _(px):
    return rounded(px.rollup("aoi").agg(stats.cohens_d(F.col("B4").cast("double"), crop()).alias("d")), "d")


@query("ag12_cohens_d_pooled", "SELECT aoi, round((avg(CASE WHEN label = 1 THEN B4 END) - avg(CASE WHEN label <> 1 THEN B4 END)) / sqrt(((count(CASE WHEN label = 1 THEN 1 END) - 1) * var_samp(CASE WHEN label = 1 THEN B4 END) + (count(CASE WHEN label <> 1 THEN 1 END) - 1) * var_samp(CASE WHEN label <> 1 THEN B4 END)) / (count(*) - 2)), 6) AS d FROM px GROUP BY aoi", ("px",))
def _(px):
    return rounded(px.groupBy("aoi").agg(stats.cohens_d(F.col("B4").cast("double"), crop(), True).alias("d")), "d")


@query("ag13_pivot_counts", "SELECT aoi, date, CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_1, CAST(sum(CASE WHEN label = 4 THEN 1 ELSE 0 END) AS BIGINT) AS n_4 FROM px GROUP BY aoi, date", ("px",))
def _(px):
    return stats.pivot_counts(px, ["aoi", "date"], "label", [1, 4])


@query("ag14_month_counts", "SELECT substr(date, 1, 7) AS month, count(DISTINCT aoi) AS aois, count(DISTINCT date) AS days, count(*) AS n FROM px GROUP BY 1", ("px",))
def _(px):
    return px.groupBy(F.substring("date", 1, 7).alias("month")).agg(F.count_distinct("aoi").alias("aois"), F.count_distinct("date").alias("days"), F.count(F.lit(1)).alias("n"))


@query("ag15_field_medians", "SELECT CAST(floor(pixel_id / 20) AS BIGINT) AS field_id, label, round(quantile_cont(m, 0.5), 6) AS ndvi_mean, count(*) AS pixels FROM (SELECT pixel_id, label, avg(v) AS m FROM long GROUP BY pixel_id, label) t GROUP BY 1, 2 HAVING count(*) >= 2", ("series",))
def _(s):
    f = s.select(F.floor(F.col("pixel_id") / 20).cast("bigint").alias("field_id"), "label", series.mean(F.col("s")).alias("m"))
    return rounded(f.groupBy("field_id", "label").agg(F.percentile("m", F.lit(0.5)).alias("ndvi_mean"), F.count(F.lit(1)).alias("pixels")).where("pixels >= 2"), "ndvi_mean")


@query("ag16_residual_units", "SELECT k, round(quantile_cont(prob, 0.5), 6) AS score, quantile_cont(prob, 0.5) >= 0.35 AND avg(CASE WHEN label = 4 THEN 1.0 ELSE 0.0 END) >= 0.5 AS removed FROM scores GROUP BY k HAVING count(prob) >= 3", ("scores",))
def _(scores):
    """Units removed: median score at the threshold and at least half of the pixels gated."""
    gate = F.avg(F.when(F.col("label") == 4, 1.0).otherwise(0.0)) >= 0.5
    mid = F.percentile(F.col("prob").cast("double"), F.lit(0.5))
    return rounded(scores.groupBy("k").agg(mid.alias("score"), ((mid >= 0.35) & gate).alias("removed"), F.count("prob").alias("_n")).where("_n >= 3").drop("_n"), "score")


@query("ag17_object_mean", "SELECT pixel_id, round(avg(v), 6) AS m FROM long GROUP BY pixel_id", ("long",))
def _(long):
    return rounded(long.groupBy("pixel_id").agg(F.avg("v").alias("m")), "m")


@query("ag19_crop_fraction", "SELECT CAST(floor(r / 10) AS BIGINT) AS fr, CAST(floor(c / 10) AS BIGINT) AS fc, count(*) AS pixels, round(avg(CASE WHEN cls = 1 THEN 1.0 ELSE 0.0 END), 6) AS crop_fraction, CASE WHEN count(*) < 10 THEN 'too small' WHEN avg(CASE WHEN cls = 1 THEN 1.0 ELSE 0.0 END) >= 0.85 THEN 'crop' WHEN avg(CASE WHEN cls = 1 THEN 1.0 ELSE 0.0 END) <= 0.15 THEN 'other' ELSE 'mixed' END AS band FROM grid WHERE cls <> 255 GROUP BY 1, 2", ("grid",))
def _(grid):
    share = F.avg(F.when(F.col("cls") == 1, 1.0).otherwise(0.0))
    per = grid.where("cls <> 255").groupBy(F.floor(F.col("r") / 10).cast("bigint").alias("fr"), F.floor(F.col("c") / 10).cast("bigint").alias("fc")).agg(F.count(F.lit(1)).alias("pixels"), share.alias("crop_fraction"))
    band = F.when(F.col("pixels") < 10, "too small").when(F.col("crop_fraction") >= 0.85, "crop").when(F.col("crop_fraction") <= 0.15, "other").otherwise("mixed")
    return rounded(per.withColumn("band", band), "crop_fraction")


@query("ag22_histogram", "SELECT CAST(least(floor(prob * 10) + 1, 10) AS BIGINT) AS bin, count(*) AS n FROM scores GROUP BY 1", ("scores",))
def _(scores):
    return scores.groupBy(stats.unit_interval_histogram(F.col("prob").cast("double")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query("ag23_area_summary", "SELECT field_id % 4 AS origin, count(*) AS n, round(sum(a), 4) AS total, round(quantile_cont(a, 0.5), 5) AS median, round(quantile_cont(a, 0.95), 5) AS p95, round(max(a), 5) AS largest, CAST(sum(CASE WHEN a < 1 THEN 1 ELSE 0 END) AS BIGINT) AS under_one FROM (SELECT field_id, (x1 - x0) * (y1 - y0) / 100.0 AS a FROM fields) t GROUP BY 1", ("fields",))
def _(fields):
    rows = fields.select((F.col("field_id") % 4).alias("origin"), ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / 100).alias("acres"))
    return rounded(rounded(stats.area_summary(rows, ["origin"], "acres"), "median", "p95", "largest", n=5), "total", n=4)


@query("ag24_cross_share", "SELECT origin, layer, round(sum(a), 4) AS total, round(sum(a) * 100 / sum(sum(a)) OVER (PARTITION BY layer), 5) AS pct FROM (SELECT field_id % 4 AS origin, field_id % 3 AS layer, (x1 - x0) * (y1 - y0) / 100.0 AS a FROM fields) t GROUP BY origin, layer", ("fields",))
def _(fields):
    rows = fields.select((F.col("field_id") % 4).alias("origin"), (F.col("field_id") % 3).alias("layer"), ((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0")) / 100).alias("acres"))
    return rounded(rounded(stats.share_of_column(rows, "origin", "layer", "acres"), "pct", n=5), "total", n=4)


_ROBUST = """, q AS (SELECT aoi, quantile_cont(B4, 0.01) AS x1, quantile_cont(B4, 0.99) AS x9, quantile_cont(B3, 0.01) AS y1, quantile_cont(B3, 0.99) AS y9 FROM px GROUP BY aoi),
i AS (SELECT px.aoi, B4 AS x, B3 AS y, B4 BETWEEN x1 AND x9 AND B3 BETWEEN y1 AND y9 AS ok, sum(CASE WHEN B4 BETWEEN x1 AND x9 AND B3 BETWEEN y1 AND y9 THEN 1 ELSE 0 END) OVER (PARTITION BY px.aoi) AS n FROM px JOIN q ON q.aoi = px.aoi),
e AS (SELECT * FROM i WHERE ok OR n < 100), m AS (SELECT aoi, quantile_cont(x, 0.5) AS mx, quantile_cont(y, 0.5) AS my FROM e GROUP BY aoi),
w AS (SELECT e.aoi, any_value(mx) AS mx, any_value(my) AS my, quantile_cont(abs(x - mx), 0.5) AS dx, quantile_cont(abs(y - my), 0.5) AS dy FROM e JOIN m ON m.aoi = e.aoi GROUP BY e.aoi),
g AS (SELECT *, greatest(0.5, least(2.0, dy / nullif(dx, 0))) AS gain FROM w) SELECT aoi, round(gain, 5) AS gain, round(my - gain * mx, 5) AS shift FROM g"""


@query("ag35_robust_match", _ROBUST, ("px",))
def _(px):
    return rounded(stats.robust_match(px, ["aoi"], "B4", "B3"), "gain", "shift", n=5)


@query("ag39_mean_imputation", "SELECT pixel_id, step, round(coalesce(v, avg(v) OVER (PARTITION BY step)), 6) AS v FROM long", ("long",))
def _(long):
    means = F.broadcast(long.groupBy("step").agg(F.avg("v").alias("m")))  # one row a step
    return rounded(long.join(means, "step").select("pixel_id", "step", F.coalesce("v", "m").alias("v")), "v")


@query("wi5_group_centred", "SELECT pixel_id, round(m - quantile_cont(m, 0.5) OVER (PARTITION BY district), 6) AS centred FROM (SELECT pixel_id, district, avg(v) AS m FROM long GROUP BY pixel_id, district) t", ("series",))
def _(s):
    return rounded(stats.centred(s.select("pixel_id", "district", series.mean(F.col("s")).alias("m")), "district", "m").select("pixel_id", "centred"), "centred")


# Evaluation

_CONF = "SELECT aoi, CAST(sum(CASE WHEN label = 1 AND prob >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp, CAST(sum(CASE WHEN label <> 1 AND prob >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fp, CAST(sum(CASE WHEN label = 1 AND prob < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fn, CAST(sum(CASE WHEN label <> 1 AND prob < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM scores GROUP BY aoi"


@query("ag27_confusion", "SELECT *, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM (" + _CONF + ") t", ("scores",))
def _(scores):
    return rounded(evaluate.confusion(scores, ["aoi"], crop(), F.col("prob") >= 0.5), "precision", "recall", "f1")


@query("ag29_roc_auc", "SELECT aoi, round((sum(CASE WHEN label = 1 THEN rk ELSE 0 END) - n1 * (n1 + 1) / 2.0) / (n1 * n0), 6) AS auc FROM (SELECT aoi, label, rank() OVER (PARTITION BY aoi ORDER BY prob) + (count(*) OVER (PARTITION BY aoi, prob) - 1) / 2.0 AS rk, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY aoi) AS n1, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) OVER (PARTITION BY aoi) AS n0 FROM scores) t GROUP BY aoi, n1, n0", ("scores",))
def _(scores):
    return rounded(evaluate.roc_auc(scores, ["aoi"], crop(), "prob"), "auc")


_CURVE = """, st AS (SELECT prob, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM scores GROUP BY prob),
cu AS (SELECT prob, sum(pos) OVER (ORDER BY prob DESC) AS tp, sum(neg) OVER (ORDER BY prob DESC) AS fp, sum(pos) OVER () AS p FROM st),
pr AS (SELECT prob, tp, fp, CAST(tp AS DOUBLE) / (tp + fp) AS precision, CAST(tp AS DOUBLE) / p AS recall FROM cu) """


@query("ag30_pr_curve", _CURVE + "SELECT CAST(prob AS DOUBLE) AS prob, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr", ("scores",))
def _(scores):
    c = evaluate.pr_curve(scores, crop(), "prob")
    return rounded(c.select(F.col("prob").cast("double").alias("prob"), "tp", "fp", "precision", "recall"), "precision", "recall")


@query("ag30_average_precision", _CURVE + "SELECT round(sum(a), 6) AS average_precision FROM (SELECT (recall - coalesce(lag(recall) OVER (ORDER BY prob DESC), 0)) * precision AS a FROM pr) t", ("scores",))
def _(scores):
    return rounded(evaluate.average_precision(evaluate.pr_curve(scores, crop(), "prob"), "prob"), "average_precision")


@query("tk10_recall_at_precision", _CURVE + "SELECT round(coalesce(max(recall), 0), 6) AS recall FROM pr WHERE precision >= 0.6", ("scores",))
def _(scores):
    return rounded(evaluate.recall_at_precision(evaluate.pr_curve(scores, crop(), "prob"), 0.6), "recall")


_GRID = [round(0.05 + 0.01 * i, 2) for i in range(91)]
_SWEEP = ", g AS (SELECT CAST(5 + i AS DOUBLE) / 100 AS t FROM (SELECT unnest(range(91)) AS i) z), sw AS (SELECT t, sum(CASE WHEN prob >= t AND label = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN prob >= t AND label <> 1 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN prob < t AND label = 1 THEN 1 ELSE 0 END) AS fn FROM scores CROSS JOIN g GROUP BY t) "


@query("tk8_threshold_sweep", _SWEEP + "SELECT t, round(2.0 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM sw ORDER BY coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) DESC, t LIMIT 1", ("scores",))
def _(scores):
    return rounded(evaluate.best_threshold(evaluate.threshold_table(scores.withColumn("prob", F.col("prob").cast("double")), crop(), "prob", _GRID)), "f1")


@query("ag33_positives_at", _SWEEP + "SELECT t, CAST(tp + fp AS BIGINT) AS n FROM sw", ("scores",))
def _(scores):
    return evaluate.threshold_table(scores.withColumn("prob", F.col("prob").cast("double")), crop(), "prob", _GRID).select("t", (F.col("tp") + F.col("fp")).alias("n"))


@query("tk11_threshold_at_floor", _SWEEP + ", u AS (SELECT t, fp AS removed, 1.0 - CAST(tp AS DOUBLE) / (tp + fn) AS kept_share FROM sw) SELECT coalesce((SELECT t FROM u WHERE kept_share >= 0.5 AND removed > 0 ORDER BY removed DESC, t LIMIT 1), 1.0) AS t", ("scores",))
def _(scores):
    sw = evaluate.threshold_table(scores.withColumn("prob", F.col("prob").cast("double")), crop(), "prob", _GRID)
    return evaluate.threshold_at_floor(sw.select("t", F.col("fp").alias("removed"), (1 - F.col("tp") / (F.col("tp") + F.col("fn"))).alias("kept_share")), 0.5)


@query("wi6_stratified_cap", "SELECT aoi, label, k, b5 FROM (SELECT aoi, label, k, B5 AS b5, row_number() OVER (PARTITION BY aoi, label ORDER BY md5(CAST(k AS VARCHAR)), k, B5, B2, B4) AS pos FROM px) t WHERE pos <= 50", ("px",))
def _(px):
    order = [F.md5(F.col("k").cast("string").cast("binary")), F.col("k"), F.col("B5"), F.col("B2"), F.col("B4")]
    return evaluate.stratified_cap(px, ["aoi", "label"], 50, order).select("aoi", "label", "k", F.col("B5").alias("b5"))


@query("ml3_fold_sizes", "SELECT aoi, n_test, CAST(n_pos AS BIGINT) AS n_pos, CAST(sum(n_test) OVER () - n_test AS BIGINT) AS n_train, n_test >= 1000 AND sum(n_test) OVER () - n_test > 0 AND n_pos > 0 AND n_pos < n_test AS eligible FROM (SELECT aoi, count(*) AS n_test, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS n_pos FROM px GROUP BY aoi) t", ("px",))
def _(px):
    return evaluate.fold_sizes(px, "aoi", crop())


@query("ml9_stratified_split", "SELECT label, CAST(sum(CASE WHEN pos <= 0.8 * n THEN 1 ELSE 0 END) AS BIGINT) AS n_train, CAST(sum(CASE WHEN pos <= 0.8 * n THEN 0 ELSE 1 END) AS BIGINT) AS n_test FROM (SELECT label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(k AS VARCHAR))) AS pos, count(*) OVER (PARTITION BY label) AS n FROM px) t GROUP BY label", ("px",))
def _(px):
    split = evaluate.stratified_split(px, "label", "k", 0.8)
    return split.groupBy("label").agg(F.count_if("train").alias("n_train"), F.count_if(~F.col("train")).alias("n_test"))


@query("ml1_boosted_trees", None, ("px",))
def _(px):
    """Grouped hold-out: fit on all dates but one, score that one."""
    rows = px.where("B8 > 0")
    model = evaluate.gradient_boosted(rows.where("date <> '2025-08-15'"), ["B2", "B4", "B5", "B8"], crop(), rounds=5, depth=3)
    scored = evaluate.predict(rows.where("date = '2025-08-15'"), *model)
    return rounded(evaluate.roc_auc(scored, ["aoi"], crop(), "prob"), "auc", n=4)


# Joins and topology


@query("jn4_overlap_pairs", "SELECT a.field_id AS l_field_id, b.field_id AS r_field_id, (least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS area FROM fields a JOIN fields b ON a.field_id < b.field_id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1", ("fields",))
def _(fields):
    pairs = spatial.box_join(fields, fields, 16, ("field_id", "field_id")).where("l_field_id < r_field_id")
    return pairs.select("l_field_id", "r_field_id", spatial.overlap_area().alias("area"))


@query("jn6_overlay_share", ", s AS (SELECT a.field_id, sum((least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0))) AS area FROM fields a JOIN fields b ON a.field_id <> b.field_id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1 GROUP BY a.field_id) SELECT f.field_id, coalesce(CAST(s.area AS BIGINT), 0) AS area FROM fields f LEFT JOIN s ON f.field_id = s.field_id", ("fields",))
def _(fields):
    hit = spatial.box_join(fields, fields, 16, ("field_id", "field_id")).where("l_field_id <> r_field_id")
    per = hit.groupBy(F.col("l_field_id").alias("field_id")).agg(F.sum(spatial.overlap_area()).alias("area"))
    return fields.select("field_id").join(per, "field_id", "left").select("field_id", F.coalesce("area", F.lit(0)).alias("area"))


@query("jn8_priority_claims", "SELECT a.field_id AS loser, b.field_id AS winner FROM fields a JOIN fields b ON a.field_id <> b.field_id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1 WHERE (b.x1 - b.x0) * (b.y1 - b.y0) < (a.x1 - a.x0) * (a.y1 - a.y0) OR ((b.x1 - b.x0) * (b.y1 - b.y0) = (a.x1 - a.x0) * (a.y1 - a.y0) AND b.field_id < a.field_id)", ("fields",))
def _(fields):
    """Pairs in which the smaller box (then the smaller id) cuts the other."""
    pairs = spatial.box_join(fields, fields, 16, ("field_id", "field_id")).where("l_field_id <> r_field_id")
    size = lambda s: (F.col(f"{s}_x1") - F.col(f"{s}_x0")) * (F.col(f"{s}_y1") - F.col(f"{s}_y0"))
    better = (size("r") < size("l")) | ((size("r") == size("l")) & (F.col("r_field_id") < F.col("l_field_id")))
    return pairs.where(better).select(F.col("l_field_id").alias("loser"), F.col("r_field_id").alias("winner"))


@query("jn1_pixel_assignment", "SELECT g.r, g.c, max(f.field_id) AS field_id FROM grid g JOIN fields f ON g.c * 4 + 2 >= f.x0 AND g.c * 4 + 2 < f.x1 AND g.r * 2 + 1 >= f.y0 AND g.r * 2 + 1 < f.y1 GROUP BY g.r, g.c", ("grid", "fields"))
def _(grid, fields):
    px = grid.select("r", "c", (F.col("c") * 4 + 2).alias("x"), (F.col("r") * 2 + 1).alias("y"))
    return spatial.assign_pixels(px, fields, 16, "field_id").select("r", "c", "field_id")


@query("jn10_raster_algebra", "SELECT a.cls AS was, CASE WHEN (r * 31 + c * 7) % 5 = 0 THEN 1 ELSE a.cls END AS now, count(*) AS n FROM grid a GROUP BY 1, 2", ("grid",))
def _(grid):
    after = grid.select("r", "c", F.when(F.expr("(r * 31 + c * 7) % 5 = 0"), 1).otherwise(F.col("cls")).alias("now"))
    return grid.select("r", "c", F.col("cls").alias("was")).join(after, ["r", "c"]).groupBy("was", "now").agg(F.count(F.lit(1)).alias("n"))


@query("jn12_lookup_flags", "SELECT k, aoi IN ('aoi_1', 'aoi_5') AS removed FROM px", ("px",))
def _(px):
    flags = F.broadcast(px.sparkSession.createDataFrame([("aoi_1", True), ("aoi_5", True)], "aoi string, removed boolean"))  # two rows
    return px.join(flags, "aoi", "left").select("k", F.coalesce("removed", F.lit(False)).alias("removed"))


@query("jn15_holdout_split", "SELECT held, count(*) AS n FROM (SELECT EXISTS (SELECT 1 FROM px b WHERE b.aoi = px.aoi AND b.date = px.date AND b.aoi = 'aoi_3') AS held FROM px) t GROUP BY held", ("px",))
def _(px):
    groups = px.where("aoi = 'aoi_3'").select("aoi", "date").distinct()
    part = lambda how, held: px.join(groups, ["aoi", "date"], how).agg(F.lit(held).alias("held"), F.count(F.lit(1)).alias("n"))
    return part("left_semi", True).unionByName(part("left_anti", False))


@query("sp6_dilation", ", k AS (SELECT r, c FROM grid WHERE cls = 255) SELECT DISTINCT g.r, g.c FROM grid g JOIN k ON abs(g.r - k.r) + abs(g.c - k.c) <= 1 AND g.r BETWEEN k.r - 1 AND k.r + 1", ("grid",))
def _(grid):
    return spatial.dilate(grid.where("cls = 255"), grid, False)


_FOUR = "(VALUES (0, 1), (1, 0), (0, -1), (-1, 0)) d(i, j)"
_EIGHT = "(VALUES (0, 1), (1, 0), (0, -1), (-1, 0), (1, 1), (1, -1), (-1, 1), (-1, -1)) d(i, j)"


def labelled_sql(name: str, cells: str, steps: str) -> str:
    """Connected cells of equal v as a common table expression: each cell is lowered to the first cell it reaches."""
    return (
        f"{name}(r, c, v, id) USING KEY (r, c) AS (SELECT r, c, v, r * 4294967296 + c AS id FROM {cells} UNION (SELECT k.r, k.c, k.v, min(x.id) AS id "
        f"FROM {name} x CROSS JOIN {steps} JOIN {cells} k ON k.r = x.r + d.i AND k.c = x.c + d.j AND k.v = x.v JOIN recurring.{name} AS cur ON cur.r = k.r AND cur.c = k.c WHERE x.id < cur.id GROUP BY k.r, k.c, k.v))"
    )


_CROP = ", k AS (SELECT r, c, 1 AS v FROM grid WHERE cls = 1), "


@query("sp1_components", _CROP + labelled_sql("cc", "k", _EIGHT) + " SELECT id AS component, count(*) AS n FROM cc GROUP BY id", ("grid",))
def _(grid):
    found = spatial.components(grid.where("cls = 1"), True)
    return found.groupBy("component").agg(F.count(F.lit(1)).alias("n"))


@query("sp2_four_connected", _CROP + labelled_sql("cc", "k", _FOUR) + " SELECT r, c, id AS component FROM cc", ("grid",))
def _(grid):
    return spatial.components(grid.where("cls = 1")).select("r", "c", "component")


@query("sp3_size_filter", _CROP + labelled_sql("cc", "k", _FOUR) + " SELECT r, c, id AS component FROM cc WHERE id IN (SELECT id FROM cc GROUP BY id HAVING count(*) >= 10)", ("grid",))
def _(grid):
    return spatial.drop_small(spatial.components(grid.where("cls = 1"), False), 10)


_SIEVE = (
    ", k AS (SELECT r, c, cls AS v FROM grid WHERE cls <> 255), "
    + labelled_sql("cc", "k", _FOUR)
    + f""", z AS (SELECT id, any_value(v) AS v, count(*) AS n FROM cc GROUP BY id),
t AS (SELECT a.id, arg_min(y.v, (-y.n, y.id)) AS target FROM cc a JOIN z ON z.id = a.id AND z.n < 6 CROSS JOIN {_FOUR} JOIN cc b ON b.r = a.r + d.i AND b.c = a.c + d.j AND b.id <> a.id JOIN z y ON y.id = b.id GROUP BY a.id),
sv AS (SELECT g.r, g.c, g.cls, g.v, coalesce(t.target, g.cls) AS sieved FROM grid g LEFT JOIN cc ON cc.r = g.r AND cc.c = g.c LEFT JOIN t ON t.id = cc.id)"""
)


@query("sp4_sieve", _SIEVE + " SELECT r, c, cls, v, sieved FROM sv", ("grid",))
def _(grid):
    return spatial.sieve(grid, 6).select("r", "c", "cls", "v", F.col("sieved").cast("int").alias("sieved"))


@query(
    "sp5_strict_sieve",
    _SIEVE + ", k2 AS (SELECT r, c, 1 AS v FROM sv WHERE cls <> 1 AND sieved = 1), " + labelled_sql("c2", "k2", _FOUR)
    + f", u AS (SELECT DISTINCT c2.id FROM c2 CROSS JOIN {_FOUR} JOIN grid g ON g.r = c2.r + d.i AND g.c = c2.c + d.j LEFT JOIN k2 ON k2.r = g.r AND k2.c = g.c WHERE k2.r IS NULL AND g.cls <> 1)"
    + " SELECT sv.r, sv.c, sv.sieved, CASE WHEN u.id IS NOT NULL THEN sv.cls ELSE sv.sieved END AS strict FROM sv LEFT JOIN c2 ON c2.r = sv.r AND c2.c = sv.c LEFT JOIN u ON u.id = c2.id",
    ("grid",),
)
def _(grid):
    found = spatial.strict_sieve(grid, spatial.sieve(grid, 6), 1)
    return found.select("r", "c", F.col("sieved").cast("int").alias("sieved"), F.col("strict").cast("int").alias("strict"))


@query("sp8_resample", "SELECT CAST(floor(r / 3) AS BIGINT) AS r, CAST(floor(c / 3) AS BIGINT) AS c, round(avg(v), 6) AS v, count(v) AS n FROM (SELECT r, c, CASE WHEN cls <> 255 THEN v END AS v FROM grid) t GROUP BY 1, 2", ("grid",))
def _(grid):
    return rounded(compose.overview(grid, "r", "c", F.when(F.col("cls") != 255, F.col("v")), 3), "v")


@query("sp10_tiling", "SELECT DISTINCT CAST(floor(x0 / 64) AS BIGINT) AS gx, CAST(floor(y0 / 64) AS BIGINT) AS gy FROM fields", ("fields",))
def _(fields):
    return fields.select(F.floor(F.col("x0") / 64).cast("bigint").alias("gx"), F.floor(F.col("y0") / 64).cast("bigint").alias("gy")).distinct()


_CUT = """, p AS (SELECT CAST(floor(r / 10) * 100 + floor(c / 10) AS BIGINT) AS field, CASE WHEN cls = 1 THEN 1 ELSE 0 END AS crop, r, c FROM grid WHERE cls <> 255),
a AS (SELECT field, 0 AS angle, row_number() OVER (PARTITION BY field ORDER BY c, r) AS n1, sum(crop) OVER (PARTITION BY field ORDER BY c, r ROWS UNBOUNDED PRECEDING) AS k1, count(*) OVER (PARTITION BY field) AS n, sum(crop) OVER (PARTITION BY field) AS k FROM p
  UNION ALL SELECT field, 1, row_number() OVER (PARTITION BY field ORDER BY r, c), sum(crop) OVER (PARTITION BY field ORDER BY r, c ROWS UNBOUNDED PRECEDING), count(*) OVER (PARTITION BY field), sum(crop) OVER (PARTITION BY field) FROM p),
b AS (SELECT field, angle, n1, CAST(greatest(k1, n1 - k1) + greatest(k - k1, n - n1 - (k - k1)) AS DOUBLE) / n AS purity FROM a WHERE n1 > 10 AND n - n1 >= 10)
SELECT field, arg_max(angle, (purity, -angle, -n1)) AS angle, CAST(arg_max(n1, (purity, -angle, -n1)) AS INTEGER) AS cut, round(max(purity), 6) AS purity FROM b GROUP BY field"""


@query("wi3_best_cut", _CUT, ("grid",))
def _(grid):
    px = grid.where("cls <> 255").select((F.floor(F.col("r") / 10) * 100 + F.floor(F.col("c") / 10)).cast("bigint").alias("field"), (F.col("cls") == 1).alias("crop"), "r", "c")
    return rounded(spatial.best_cut(px, "field", "crop", "c", "r", [0.0, 1.5707963267948966]).select("field", "angle", "cut", "purity"), "purity")


@query("se1_union_all", "SELECT k, 'a' AS src FROM px WHERE label = 1 UNION ALL SELECT k, 'b' FROM px WHERE label = 4", ("px",))
def _(px):
    return px.where("label = 1").select("k", F.lit("a").alias("src")).unionByName(px.where("label = 4").select("k", F.lit("b").alias("src")))


@query("se3_distinct", "SELECT DISTINCT aoi, date FROM px", ("px",))
def _(px):
    return px.select("aoi", "date").distinct()


@query("wi4_first_difference", "SELECT pixel_id, step, round(v - lag(v) OVER (PARTITION BY pixel_id ORDER BY step), 6) AS d FROM long", ("series",))
def _(s):
    """Differences inside the arrays; no shuffle."""
    padded = F.concat(F.array(F.lit(None).cast("double")), series.differences(F.col("s")))
    return rounded(s.select("pixel_id", F.posexplode(padded).alias("step", "d")), "d")


@query("tk14_nulls_last", "SELECT step, pixel_id, round(v, 6) AS v, row_number() OVER (PARTITION BY step ORDER BY v NULLS LAST, pixel_id) AS pos FROM long", ("long",))
def _(long):
    place = F.row_number().over(Window.partitionBy("step").orderBy(F.asc_nulls_last("v"), "pixel_id"))
    return rounded(long.select("step", "pixel_id", "v", place.alias("pos")), "v")


@query("dt7_feature_list", "SELECT item_id, CAST(3 AS INTEGER) AS n, 'NDVI' AS first FROM benchmark")
def _(spark, sf_dir):
    names = F.from_json(F.lit(json.dumps(["NDVI", "B4", "R43"])), "array<string>")
    return table(spark, sf_dir, "benchmark").select("item_id", F.size(names).alias("n"), names[0].alias("first"))


from . import entries, layers, passes, pipelines, rasters  # noqa: E402, F401 - register further queries with the names above
