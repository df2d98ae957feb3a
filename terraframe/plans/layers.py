"""Queries of the catalog on vector layers, sources, sinks, masks and model tuning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate, spatial, stats, vector
from ..sources import sinks
from .catalog import _EIGHT, crop, labelled_sql, query, rounded
from .entries import _INSIDE, _covered

_MEET = "a.field_id < b.field_id AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1"
_SHARED = "(least(a.x1, b.x1) - greatest(a.x0, b.x0)) * (least(a.y1, b.y1) - greatest(a.y0, b.y0))"


def _area():
    """Area of a box; built per query, as columns need a session."""
    return (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))


def _outlines(fields):
    return fields.select("field_id", vector.box_ring().alias("ring"))


# Sources


@query("sc6_geojson_bounds", "SELECT field_id, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1 FROM fields", ("fields",))
def _(fields):
    """Bounds of sites given as GeoJSON geometries or features."""
    points = F.transform(vector.box_ring(), lambda p: F.array(p["x"], p["y"]))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(points).alias("coordinates"))
    text = F.when(F.col("field_id") % 2 == 0, F.to_json(shape)).otherwise(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"))))
    return fields.select("field_id", text.alias("doc")).select("field_id", vector.geojson_bounds("doc").alias("b")).select("field_id", "b.*")


@query("sc16_wkb_scan", "SELECT field_id, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1 FROM fields", ("fields",))
def _(fields):
    """Bounds of polygons stored as well-known binary, written to Parquet and read back."""
    path = sinks.shared_folder(fields.sparkSession, "layer")
    _outlines(fields).select("field_id", vector.to_wkb("ring").alias("geometry")).write.parquet(path)
    layer = fields.sparkSession.read.parquet(path)
    return layer.select("field_id", vector.bounds_of_wkb("geometry").alias("b")).select("field_id", "b.*")


@query("sc22_label_polygons", "SELECT field_id, 'v1' AS src FROM fields WHERE y0 < 40 UNION ALL SELECT field_id, 'v3' FROM fields WHERE y0 >= 40 AND x1 - x0 > 10", ("fields",))
def _(fields):
    second = fields.where("y0 >= 40 and x1 - x0 > 10").select("field_id", F.lit("v3").alias("src"))
    return fields.where("y0 < 40").select("field_id", F.lit("v1").alias("src")).unionByName(second)


@query("se6_site_allow_list", "SELECT field_id FROM fields a WHERE field_id % 3 = 0 AND NOT EXISTS (SELECT 1 FROM fields b WHERE b.field_id % 10 = 1 AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1)", ("fields",))
def _(fields):
    """Listed sites that overlap none of another layer."""
    listed, other = fields.where("field_id % 3 = 0"), fields.where("field_id % 10 = 1")
    hit = spatial.box_join(listed, other, 16, ("field_id", "field_id")).select(F.col("l_field_id").alias("field_id"))
    return listed.join(hit, "field_id", "left_anti").select("field_id")


# Sinks


@query("sk1_tiles_and_manifest", "SELECT CAST(floor(r / 32) AS BIGINT) AS tile, count(*) AS n FROM grid GROUP BY 1", ("grid",))
def _(grid):
    """Tiles written with a manifest; a second run over the same tiles adds nothing."""
    tiles = grid.select(F.floor(F.col("r") / 32).cast("bigint").alias("tile"), "r", "c", F.col("cls").alias("v"))
    path = sinks.shared_folder(grid.sparkSession, "tiles")
    sinks.write_missing(tiles.where("tile < 2"), path, "tile")
    return sinks.write_missing(tiles, path, "tile").groupBy("tile").agg(F.count(F.lit(1)).alias("n"))


@query("sk5_partitioned_table", "SELECT aoi, date, count(*) AS n, max(B8) AS top FROM px GROUP BY aoi, date", ("px",))
def _(px):
    """Training table with a folder a site and date; the report reads it back."""
    table = sinks.write_partitioned(px.select("aoi", "date", "B8"), sinks.shared_folder(px.sparkSession, "training"), ["aoi", "date"])
    return table.groupBy("aoi", "date").agg(F.count(F.lit(1)).alias("n"), F.max("B8").alias("top"))


@query("sk8_csv_report", "SELECT aoi, count(*) AS n, round(avg(B8), 6) AS mean FROM px GROUP BY aoi", ("px",))
def _(px):
    report = rounded(px.groupBy("aoi").agg(F.count(F.lit(1)).alias("n"), F.avg("B8").alias("mean")), "mean")
    return sinks.write_report(report, sinks.shared_folder(px.sparkSession, "report"))


@query("sk10_append_report", "SELECT date, count(*) AS n FROM px WHERE date >= '2025-10-01' GROUP BY date", ("px",))
def _(px):
    """Fold rows appended one date at a time."""
    path = sinks.shared_folder(px.sparkSession, "folds")
    per = px.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    sinks.write_report(per.where("date = '2025-10-15'"), path, "append")
    return sinks.write_report(per.where("date = '2025-11-15'"), path, "append")


# Expressions and filters


@query("pr6_index_bands", "SELECT k, " + ", ".join(f"round(CASE WHEN {a} + {b} <> 0 THEN ({a} - {b}) / CAST({a} + {b} AS DOUBLE) END, 6) AS {n}" for n, a, b in (("ndvi", "B8", "B4"), ("gndvi", "B8", "B3"), ("ndre", "B8", "B5"), ("ndwi", "B3", "B8"))) + " FROM px", ("px",))
def _(px):
    ratio = lambda a, b: F.try_divide((F.col(a) - F.col(b)).cast("double"), F.col(a) + F.col(b))
    return rounded(px.select("k", ratio("B8", "B4").alias("ndvi"), ratio("B8", "B3").alias("gndvi"), ratio("B8", "B5").alias("ndre"), ratio("B3", "B8").alias("ndwi")), "ndvi", "gndvi", "ndre", "ndwi")


@query("pr21_radiometric", "SELECT event_id, round(greatest(red * CAST(1.05 AS DOUBLE) - 400, 0), 4) AS red FROM obs", ("obs",))
def _(obs):
    return obs.select("event_id", F.round(F.greatest(F.col("red") * F.lit(1.05) - 400, F.lit(0.0)), 4).alias("red"))


@query("pr22_slugs", "SELECT DISTINCT concat('crop-', replace(aoi, '_', '-'), '-', replace(date, '-', '')) AS slug FROM px", ("px",))
def _(px):
    name = F.concat(F.lit("Crop / "), "aoi", F.lit(" ("), F.translate("date", "-", ""), F.lit(")"))
    slug = F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), F.lit("-"))
    return px.select("aoi", "date").distinct().select(slug.alias("slug"))


@query("pr24_deviation", ", m AS (SELECT date, avg(B8) AS x FROM px GROUP BY date) SELECT m.date, round(100 * (m.x - r.x) / r.x, 6) AS deviation FROM m CROSS JOIN (SELECT x FROM m WHERE date = '2025-11-15') r", ("px",))
def _(px):
    """Deviation in percent of each date's mean from the reference date's."""
    means = px.groupBy("date").agg(F.avg("B8").alias("x"))
    ref = means.where("date = '2025-11-15'").select(F.col("x").alias("ref"))
    return rounded(means.join(F.broadcast(ref)).select("date", (100 * F.try_divide(F.col("x") - F.col("ref"), F.col("ref"))).alias("deviation")), "deviation")  # one row


@query("pr28_long_axis", "SELECT field_id, CAST(greatest(x1 - x0, y1 - y0) AS DOUBLE) AS long_side, CAST(least(x1 - x0, y1 - y0) AS DOUBLE) AS short_side, round(CASE WHEN y1 - y0 > x1 - x0 THEN pi() / 2 ELSE 0 END, 6) AS theta FROM fields", ("fields",))
def _(fields):
    got = _outlines(fields).select("field_id", vector.rectangle("ring").alias("b")).select("field_id", "b.*")
    return rounded(got, "long_side", "short_side", "theta")


@query("dt3_day_distance", "SELECT event_id, CAST(abs(date_diff('day', DATE '2024-01-15', day)) AS INTEGER) AS days FROM obs", ("obs",))
def _(obs):
    return obs.select("event_id", F.abs(F.datediff("day", F.lit("2024-01-15").cast("date"))).alias("days"))


@query("dt5_regex_date", "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN day END AS day FROM obs", ("obs",))
def _(obs):
    """Date of a file name; null where the name has none."""
    name = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("mosaic_"), "event_id")).otherwise(F.concat(F.lit("S2_"), F.date_format("day", "yyyy-MM-dd"), F.lit("_10m.tif")))
    return obs.select("event_id", F.try_to_date(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd").alias("day"))


@query("tk7_manual_date", ", d AS (SELECT pixel_id, max(day) AS auto FROM obs GROUP BY pixel_id) SELECT pixel_id, CASE WHEN pixel_id % 4 = 0 THEN DATE '2024-01-10' ELSE auto END AS day FROM d", ("obs",))
def _(obs):
    """A date set by hand goes before the chosen one."""
    chosen = obs.groupBy("pixel_id").agg(F.max("day").alias("auto"))
    manual = F.when(F.col("pixel_id") % 4 == 0, F.lit("2024-01-10").cast("date"))
    return chosen.select("pixel_id", F.coalesce(manual, "auto").alias("day"))


@query("fi3_finite_bands", "SELECT event_id, red, nir FROM obs WHERE scl <> 3 AND cloud <> 0", ("obs",))
def _(obs):
    """Rows of which every band is finite."""
    red = F.when(F.col("scl") != 3, F.col("red").cast("double"))
    nir = F.when(F.col("cloud") != 0, F.col("nir").cast("double")).otherwise(F.lit(float("nan")))
    kept = obs.select("event_id", red.alias("red"), nir.alias("nir")).where("red is not null and nir is not null and not isnan(red) and not isnan(nir)")
    return kept.select("event_id", F.col("red").cast("bigint").alias("red"), F.col("nir").cast("bigint").alias("nir"))


@query("fi7_inference_validity", "SELECT event_id, CASE WHEN scl = 3 THEN 0 ELSE red END AS red, CASE WHEN scl IN (3, 4) THEN 0 ELSE nir END AS nir FROM obs WHERE scl <> 3", ("obs",))
def _(obs):
    """Pixels that are missing or zero in all bands go; missing values of the others become zero."""
    red, nir = F.when(F.col("scl") != 3, F.col("red")), F.when(~F.col("scl").isin(3, 4), F.col("nir"))
    filled = obs.select("event_id", F.coalesce(red, F.lit(0)).alias("red"), F.coalesce(nir, F.lit(0)).alias("nir"))
    return filled.where("red <> 0 or nir <> 0")


_GUARD = """, f AS (SELECT aoi, date, 'B2' AS feature, CAST(B2 AS DOUBLE) AS x FROM px WHERE B8 > 0 UNION ALL SELECT aoi, date, 'B4', CAST(B4 AS DOUBLE) FROM px WHERE B8 > 0 UNION ALL SELECT aoi, date, 'NDVI', CAST(NDVI AS DOUBLE) FROM px WHERE B8 > 0),
ref AS (SELECT feature, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75 FROM f WHERE date = '2025-11-15' GROUP BY feature),
sh AS (SELECT m.aoi, m.date, (m.x - q50) / (q75 - q25) AS shift FROM (SELECT aoi, date, feature, quantile_cont(x, 0.5) AS x FROM f GROUP BY aoi, date, feature) m JOIN ref ON m.feature = ref.feature WHERE q50 <> 0 AND q75 > q25)
SELECT aoi, date, round(sqrt(avg(shift * shift)), 5) AS score, CASE WHEN sqrt(avg(shift * shift)) <= 0.5 THEN 'ok' WHEN sqrt(avg(shift * shift)) <= 1.0 THEN 'warn' ELSE 'refuse' END AS verdict FROM sh GROUP BY aoi, date"""


@query("fi13_guard_verdict", _GUARD, ("px",))
def _(px):
    """Verdict of the domain guard for every site and date: root mean square of the feature shifts."""
    valid, bands = px.where("B8 > 0"), ["B2", "B4", "NDVI"]
    ref = stats.quantile_table(valid.where("date = '2025-11-15'"), bands, F.lit("all")).where("role = 'pooled'")
    return rounded(stats.domain_verdict(stats.domain_shift(valid, ["aoi", "date"], bands, ref), ["aoi", "date"]).select("aoi", "date", "score", "verdict"), "score", n=5)


@query("fi15_area_bands", "SELECT field_id, (x1 - x0) * (y1 - y0) AS area FROM fields WHERE (x1 - x0) * (y1 - y0) > 80 AND (x1 - x0) * (y1 - y0) <= 140", ("fields",))
def _(fields):
    return fields.select("field_id", _area().alias("area")).where("area > 80 and area <= 140")


@query("fi20_mask_restriction", "SELECT r, c, cls FROM grid g WHERE cls <> 255 AND " + _INSIDE.format(""), ("grid", "fields"))
def _(grid, fields):
    return _covered(grid.where("cls <> 255"), fields).where("inside").select("r", "c", "cls")


@query("fi21_clip", "SELECT r, c, CAST(CASE WHEN " + _INSIDE.format("") + " THEN cls ELSE 255 END AS INTEGER) AS cls FROM grid g", ("grid", "fields"))
def _(grid, fields):
    """Pixels outside the site become nodata."""
    return _covered(grid, fields).select("r", "c", F.when(F.col("inside"), F.col("cls")).otherwise(255).cast("int").alias("cls"))


# Layers


@query("jn3_touching_pairs", "SELECT a.field_id AS a, b.field_id AS b FROM fields a JOIN fields b ON a.field_id < b.field_id AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1", ("fields",))
def _(fields):
    pairs = spatial.box_join(fields, fields, 16, ("field_id", "field_id"), touching=True).where("l_field_id < r_field_id")
    return pairs.select(F.col("l_field_id").alias("a"), F.col("r_field_id").alias("b"))


@query("jn5_shared_area", f"SELECT a.field_id, CAST(sum({_SHARED}) AS BIGINT) AS shared, count(*) AS n FROM fields a JOIN fields b ON {_MEET} GROUP BY a.field_id", ("fields",))
def _(fields):
    pairs = spatial.box_join(fields, fields, 16, ("field_id", "field_id")).where("l_field_id < r_field_id")
    return pairs.groupBy(F.col("l_field_id").alias("field_id")).agg(F.sum(spatial.overlap_area()).alias("shared"), F.count(F.lit(1)).alias("n"))


@query("jn13_tile_ownership", "SELECT field_id, CAST(floor((x0 + x1) / 2.0 / 64) AS BIGINT) AS gx, CAST(floor((y0 + y1) / 2.0 / 64) AS BIGINT) AS gy FROM fields", ("fields",))
def _(fields):
    """The one tile that holds a polygon's inner point; no join, as tiles are a grid."""
    at = lambda a, b: F.floor((F.col(a) + F.col(b)) / 2 / 64).cast("bigint")
    return fields.select("field_id", at("x0", "x1").alias("gx"), at("y0", "y1").alias("gy"))


@query("jn14_day_pad", "SELECT CAST(CAST(ts AS DATE) + p AS DATE) AS day, count(*) AS n FROM items CROSS JOIN (SELECT CAST(unnest(range(3)) - 1 AS INTEGER) AS p) q GROUP BY 1", ("items",))
def _(items):
    """Items within one day of each solar day."""
    days = F.explode(F.sequence(F.date_sub(F.to_date("ts"), 1), F.date_add(F.to_date("ts"), 1)))
    return items.select(days.alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("ag25_layer_summary", "SELECT (SELECT count(*) FROM grid WHERE cls = 1) AS crop, (SELECT count(*) FROM grid g WHERE cls = 1 AND " + _INSIDE.format("") + ") AS caught, (SELECT count(*) FROM fields) AS polygons, (SELECT CAST(sum((x1 - x0) * (y1 - y0)) AS BIGINT) FROM fields) AS area", ("grid", "fields"))
def _(grid, fields):
    found = _covered(grid.where("cls = 1"), fields).agg(F.count(F.lit(1)).alias("crop"), F.count_if("inside").alias("caught"))
    return found.join(F.broadcast(fields.agg(F.count(F.lit(1)).alias("polygons"), F.sum(_area()).alias("area"))))  # one row each


@query("ge9_orphan_pixels", "SELECT r, c FROM grid g WHERE cls = 1 AND NOT " + _INSIDE.format(""), ("grid", "fields"))
def _(grid, fields):
    """Crop pixels in no polygon."""
    return _covered(grid.where("cls = 1"), fields).where("inside is null").select("r", "c")


@query("ag21_orphan_blobs", ", k AS (SELECT r, c, 1 AS v FROM grid g WHERE cls = 1 AND NOT " + _INSIDE.format("") + "), " + labelled_sql("cc", "k", _EIGHT) + ", z AS (SELECT count(*) AS n FROM cc GROUP BY id) SELECT count(*) AS blobs, CAST(sum(n) AS BIGINT) AS pixels, CAST(sum(CASE WHEN n >= 6 THEN 1 ELSE 0 END) AS BIGINT) AS large, max(n) AS largest FROM z", ("grid", "fields"))
def _(grid, fields):
    """Blobs of orphan crop pixels: number, pixels, how many are of six pixels or more, the largest."""
    loose = _covered(grid.where("cls = 1"), fields).where("inside is null").select("r", "c")
    sizes = spatial.components(loose, True).groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("blobs"), F.sum("n").alias("pixels"), F.count_if(F.col("n") >= 6).alias("large"), F.max("n").alias("largest"))


@query("sp7_polygonise", None, ("grid",))
def _(grid):
    return vector.polygonise(spatial.components(grid.where("cls = 1")))


@query("sp7_outline_totals", ", k AS (SELECT r, c FROM grid WHERE cls = 1), s AS (SELECT k.r + dr AS r, k.c + dc AS c FROM k CROSS JOIN (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) v(dr, dc)) SELECT CAST((SELECT count(*) FROM k) AS DOUBLE) AS area, CAST(count(*) AS DOUBLE) AS length FROM s WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.r = s.r AND k.c = s.c)", ("grid",))
def _(grid):
    """Area and length of all outlines of the crop regions."""
    rings = vector.polygonise(spatial.components(grid.where("cls = 1")))
    return rings.agg(F.sum("area").alias("area"), F.sum(spatial.ring_length(F.col("xs"), F.col("ys"))).alias("length"))


@query("ge4_label_decisions", """WITH f AS (SELECT c_custkey AS field_id, c_custkey % 30 AS pixels, (c_custkey * 7) % 101 / 100.0 AS share, (c_custkey * 11) % 100 / 500.0 AS gain FROM customer)
SELECT field_id, CASE WHEN pixels < 4 THEN 'too small' WHEN share <= 0.1 OR share >= 0.9 THEN 'clean' WHEN gain < 0.08 THEN 'majority' WHEN pixels < 10 THEN 'sliver' ELSE 'cut' END AS decision FROM f""")
def _(spark, sf_dir):
    """Decision for each polygon from its pixels, crop share and the gain of its best cut."""
    key = F.col("c_custkey")
    f = spark.read.parquet(f"{sf_dir}/customer.parquet").select(key.alias("field_id"), (key % 30).alias("pixels"), ((key * 7) % 101 / 100).alias("share"), ((key * 11) % 100 / 500).alias("gain"))
    decision = F.when(F.col("pixels") < 4, "too small").when((F.col("share") <= 0.1) | (F.col("share") >= 0.9), "clean").when(F.col("gain") < 0.08, "majority").when(F.col("pixels") < 10, "sliver").otherwise("cut")
    return f.select("field_id", decision.alias("decision"))


@query("ge6_field_like", "SELECT field_id FROM fields WHERE least(x1 - x0, y1 - y0) > 9.5", ("fields",))
def _(fields):
    """Polygons that are not gone when shrunk by half a least width."""
    return _outlines(fields).where(vector.field_like("ring", 9.5)).select("field_id")


@query("ge7_field_shaped", "SELECT field_id, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area FROM fields WHERE (x1 - x0) * (y1 - y0) >= 90 AND least(x1 - x0, y1 - y0) > 8.5 AND 4 * pi() * (x1 - x0) * (y1 - y0) / (4 * (x1 - x0 + y1 - y0) * (x1 - x0 + y1 - y0)) >= 0.75", ("fields",))
def _(fields):
    return vector.field_shaped(_outlines(fields), "ring", 90, 8.5, compact=0.75).select("field_id", "area")


@query("ge10_single_parts", "SELECT field_id, CAST(0 AS INTEGER) AS part, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) AS area FROM fields UNION ALL SELECT field_id, 2, CAST((x1 - x0) * (y1 - y0) AS DOUBLE) FROM fields", ("fields",))
def _(fields):
    """Parts of multipart polygons; the second of each is a line and goes."""
    ring = vector.box_ring()
    parts = fields.select("field_id", F.array(ring, F.slice(ring, 1, 2), F.transform(ring, lambda p: F.struct((p["x"] + 50).alias("x"), p["y"].alias("y")))).alias("parts"))
    return vector.single_parts(parts, "parts").select("field_id", F.col("part").cast("int").alias("part"), vector.ring_measures("ring")[0].alias("area"))


@query("ge12_claim_rank", ", a AS (SELECT field_id, (x1 - x0) * (y1 - y0) AS area, field_id % 5 = 0 AS derived, field_id % 7 = 0 AS inside FROM fields) SELECT field_id, CAST(area + CASE WHEN derived THEN (SELECT max(area) + 1 FROM a) ELSE 0 END - CASE WHEN inside THEN (SELECT max(area) + 1 FROM a) ELSE 0 END AS BIGINT) AS rank FROM a", ("fields",))
def _(fields):
    """Order of claims, the lowest first: blocks carved out, then traced polygons, then derived ones."""
    rows = fields.select("field_id", _area().alias("area"))
    span = F.broadcast(rows.agg((F.max("area") + 1).alias("span")))  # one row
    flag = lambda k: F.when(F.col("field_id") % k == 0, F.col("span")).otherwise(0)
    return rows.join(span).select("field_id", (F.col("area") + flag(5) - flag(7)).alias("rank"))


@query("ge14_interior_rings", "SELECT field_id, CAST(h AS INTEGER) AS hole, CAST(1 + 3 * (h - 1) AS DOUBLE) AS area FROM fields CROSS JOIN (VALUES (1), (2)) v(h) WHERE field_id % 3 <> 0 AND h <= field_id % 3", ("fields",))
def _(fields):
    """Holes of polygons of none to two holes as polygons of their own."""
    hole = lambda k: F.transform(vector.box_ring(), lambda p: F.struct((F.col("x0") + F.when(p["x"] > F.col("x0"), 2.0 * k).otherwise(1.0 * k)).alias("x"), (F.col("y0") + F.when(p["y"] > F.col("y0"), 2.0 * k).otherwise(1.0 * k)).alias("y")))
    rings = F.slice(F.array(vector.box_ring(), hole(1), hole(2)), F.lit(1), (1 + F.col("field_id") % 3).cast("int"))
    return vector.holes(fields.select("field_id", rings.alias("rings")), "rings").select("field_id", "hole", vector.ring_measures("ring")[0].alias("area"))


@query("ag37_rings_per_district", "SELECT field_id % 7 AS district, count(*) AS rings, CAST(sum((x1 - x0) * (y1 - y0)) AS DOUBLE) AS area FROM fields GROUP BY 1", ("fields",))
def _(fields):
    rows = _outlines(fields).select((F.col("field_id") % 7).alias("district"), vector.ring_measures("ring")[0].alias("area"))
    return rows.groupBy("district").agg(F.count(F.lit(1)).alias("rings"), F.sum("area").alias("area"))


@query("ag38_circularity", "SELECT field_id, round(4 * pi() * (x1 - x0) * (y1 - y0) / (4.0 * (x1 - x0 + y1 - y0) * (x1 - x0 + y1 - y0)), 6) AS circularity FROM fields", ("fields",))
def _(fields):
    area, length = vector.ring_measures("ring")
    return rounded(_outlines(fields).select("field_id", spatial.compactness(area, length).alias("circularity")), "circularity")


@query("ge15_screen_share", f"SELECT a.field_id, round(CAST(sum({_SHARED}) AS DOUBLE) / max((a.x1 - a.x0) * (a.y1 - a.y0)), 6) AS share FROM fields a JOIN fields b ON b.field_id % 4 = 0 AND a.field_id % 4 <> 0 AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1 GROUP BY a.field_id HAVING sum({_SHARED}) >= 0.05 * max((a.x1 - a.x0) * (a.y1 - a.y0))", ("fields",))
def _(fields):
    """Share of each block that another layer covers, from one twentieth on."""
    pairs = spatial.box_join(fields.where("field_id % 4 <> 0"), fields.where("field_id % 4 = 0"), 16, ("field_id", "field_id"))
    whole = F.max((F.col("l_x1") - F.col("l_x0")) * (F.col("l_y1") - F.col("l_y0")))
    per = pairs.groupBy(F.col("l_field_id").alias("field_id")).agg(F.sum(spatial.overlap_area()).alias("s"), whole.alias("w")).where("s >= 0.05 * w")
    return rounded(per.select("field_id", (F.col("s") / F.col("w")).alias("share")), "share")


# Models


@query("ml5_ablation", None, ("px",))
def _(px):
    """ROC area of feature sets, fitted on the November rows and scored on the August ones."""
    train, test = px.where("date = '2025-11-15'"), px.where("date = '2025-08-15'")
    return evaluate.ablation(train, test, {"bands": ["B4", "B8"], "index": ["NDVI"], "all": ["B2", "B3", "B4", "B5", "B8", "NDVI"]}, crop())


@query("ml6_tuned_forest", None, ("px",))
def _(px):
    return evaluate.tuned_forest(px.select("B4", "B8", "NDVI", "label"), ["B4", "B8", "NDVI"], crop(), depths=(3, 5), trees=(8,))


@query("ml8_refit_subsample", None, ("px",))
def _(px):
    """Refit with fixed parameters on a stratified subsample; scores of all rows, averaged by label."""
    part = evaluate.stratified_share(px, ["label"], ["k", "B2", "B3"], 0.25)
    model, assembler = evaluate.gradient_boosted(part, ["B4", "B8", "NDVI"], crop(), rounds=5, depth=3)
    return evaluate.predict(px, model, assembler).groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.avg("prob").alias("prob"))


@query("ml8_subsample_sizes", "SELECT label, count(*) AS n FROM px WHERE substr(md5(concat(CAST(k AS VARCHAR), '|', CAST(B2 AS VARCHAR), '|', CAST(B3 AS VARCHAR))), 1, 4) < '4000' GROUP BY label", ("px",))
def _(px):
    """Rows that the subsample of a quarter draws from each stratum."""
    return evaluate.stratified_share(px, ["label"], ["k", "B2", "B3"], 0.25).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("ep26_tile_status", "SELECT CAST(floor(r / 32) AS BIGINT) AS tile, CASE WHEN floor(r / 32) = 1 THEN 'ValueError: no scenes' ELSE 'ok' END AS status FROM grid GROUP BY 1, 2", ("grid",))
def _(grid):
    """A tile whose worker fails gives a status row and leaves the others alone."""

    def worker(frame):
        if frame["tile"].iloc[0] == 1:
            raise ValueError("no scenes")
        return frame[["tile"]].head(1)

    tiles = grid.select(F.floor(F.col("r") / 32).cast("bigint").alias("tile"), "c", "cls")
    return spatial.tile_apply(tiles, "tile", worker, "tile bigint")
