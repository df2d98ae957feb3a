"""Queries of block rasters, carving, as-of joins, windows, reprojection and retries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import spatial
from ..sources import blocks, sinks
from .catalog import query, rounded

# Block rasters


@query("sk2_block_sink", "SELECT r, c, cls FROM grid WHERE cls <> 255", ("grid",))
def _(grid):
    """A class map written as uint16 blocks, nodata 0, and read back whole."""
    path = sinks.shared_folder(grid.sparkSession, "blocks")
    blocks.write_blocks(grid.where("cls <> 255"), path, "cls", "uint16", 64)
    whole = blocks.read_window(grid.sparkSession, path, (0, 1 << 40), (0, 1 << 40), 64)
    return whole.select("r", "c", F.col("v").cast("int").alias("cls"))


@query("sc7_window_scan", "SELECT r, c, cls FROM grid WHERE cls <> 255 AND r >= 20 AND r < 130 AND c >= 10 AND c < 55", ("grid",))
def _(grid):
    """Cells of a window; tiles outside it are pruned by the scan."""
    path = sinks.shared_folder(grid.sparkSession, "blocks")
    blocks.write_blocks(grid.where("cls <> 255"), path, "cls", "uint8", 32)
    return blocks.read_window(grid.sparkSession, path, (20, 130), (10, 55), 32).select("r", "c", F.col("v").cast("int").alias("cls"))


@query("sk4_label_and_probability", "SELECT r, c, CAST(CASE WHEN v % 100 >= 50 THEN 1 ELSE 4 END AS INTEGER) AS cls, (v % 100) / 100.0 AS prob FROM grid WHERE cls <> 255", ("grid",))
def _(grid):
    """Class and probability rasters of one pass, written as two block tables and joined tile by tile."""
    spark, scored = grid.sparkSession, grid.where("cls <> 255").select("r", "c", ((F.col("v") % 100) / 100).alias("prob"))
    paths = {n: sinks.shared_folder(spark, n) for n in ("cls", "prob")}
    blocks.write_blocks(scored.select("r", "c", F.when(F.col("prob") >= 0.5, 1).otherwise(4).alias("cls")), paths["cls"], "cls", "uint8", 64)
    blocks.write_blocks(scored, paths["prob"], "prob", "float32", 64)
    both = blocks.read_layers(spark, paths, (0, 1 << 40), (0, 1 << 40), 64)
    return rounded(both.select("r", "c", F.col("cls").cast("int").alias("cls"), "prob"), "prob")


# Overlays


def owned_cells(boxes: DataFrame) -> DataFrame:
    """(x, y, field_id): the unit cells of all boxes, each owned by the smallest box over it, then the smallest id."""
    size = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    xs = boxes.select("field_id", size.alias("size"), "y0", "y1", F.explode(F.sequence("x0", F.col("x1") - 1)).alias("x"))
    cells = xs.select("field_id", "size", "x", F.explode(F.sequence("y0", F.col("y1") - 1)).alias("y"))
    return cells.groupBy("x", "y").agg(F.min_by("field_id", F.struct("size", "field_id")).alias("field_id"))


_OWNED = ", e AS (SELECT field_id, (x1 - x0) * (y1 - y0) AS size, unnest(range(x0, x1)) AS x, y0, y1 FROM fields), u AS (SELECT field_id, size, x, unnest(range(y0, y1)) AS y FROM e), w AS (SELECT x, y, arg_min(field_id, (size, field_id)) AS field_id FROM u GROUP BY x, y) "


@query("jn8_resolved_area", _OWNED + "SELECT field_id, count(*) AS area FROM w GROUP BY field_id", ("fields",))
def _(fields):
    """What is left of each box after all better ones are cut out of it; boxes without a rest go."""
    return owned_cells(fields).groupBy("field_id").agg(F.count(F.lit(1)).alias("area"))


@query("jn7_carved_area", ", e AS (SELECT field_id, unnest(range(x0, x1)) AS x, y0, y1 FROM fields), u AS (SELECT field_id, x, unnest(range(y0, y1)) AS y FROM e) SELECT field_id, count(*) AS area FROM u WHERE NOT EXISTS (SELECT 1 FROM fields n WHERE u.x >= n.x0 + 4 AND u.x < n.x0 + 8 AND u.y >= n.y0 + 2 AND u.y < n.y0 + 9) GROUP BY field_id", ("fields",))
def _(fields):
    """Difference of two layers: the area of every box of one that no box of the other covers; boxes without a rest go.

    Rows of 64 cells are met with the other layer's, whose boxes are one word for each such row. The join
    is sorted: a layer's estimated size does not know how many cells its boxes have.
    """
    cut = fields.select((F.col("x0") + 4).alias("x0"), (F.col("y0") + 2).alias("y0"), (F.col("x0") + 8).alias("x1"), (F.col("y0") + 9).alias("y1"))
    covered = spatial.box_words(cut).groupBy("w", "y").agg(F.bit_or("bits").alias("cut"))
    rest = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("cut", F.lit(0).cast("bigint")))))
    met = spatial.box_words(fields, "field_id").join(covered.hint("merge"), ["w", "y"], "left")
    return met.groupBy("field_id").agg(F.sum(rest).alias("area")).where("area > 0")


@query("jn2_any_touch", "SELECT f.field_id, count(*) AS touched, CAST(sum(CASE WHEN g.c * 4 >= f.x0 AND g.c * 4 + 4 <= f.x1 AND g.r * 2 >= f.y0 AND g.r * 2 + 2 <= f.y1 THEN 0 ELSE 1 END) AS BIGINT) AS boundary FROM grid g JOIN fields f ON g.c * 4 < f.x1 AND g.c * 4 + 4 > f.x0 AND g.r * 2 < f.y1 AND g.r * 2 + 2 > f.y0 GROUP BY f.field_id", ("grid", "fields"))
def _(grid, fields):
    """Pixels whose square shares area with a polygon, and those of them that its border crosses."""
    squares = grid.select((F.col("c") * 4).alias("x0"), (F.col("r") * 2).alias("y0"), (F.col("c") * 4 + 4).alias("x1"), (F.col("r") * 2 + 2).alias("y1"))
    met = spatial.box_join(squares, fields, 16, ("x0", "field_id"))
    inside = (F.col("l_x0") >= F.col("r_x0")) & (F.col("l_x1") <= F.col("r_x1")) & (F.col("l_y0") >= F.col("r_y0")) & (F.col("l_y1") <= F.col("r_y1"))
    return met.groupBy(F.col("r_field_id").alias("field_id")).agg(F.count(F.lit(1)).alias("touched"), F.count_if(~inside).alias("boundary"))


@query("jn16_as_of", "SELECT a.event_id, b.event_id AS latest, b.nir FROM (SELECT * FROM obs WHERE scl < 6) a ASOF LEFT JOIN (SELECT * FROM obs WHERE scl >= 6) b ON a.pixel_id = b.pixel_id AND a.event_id >= b.event_id", ("obs",))
def _(obs):
    """Each clear observation with the pixel's latest earlier one of the other kind: one sort, no join."""
    upto = Window.partitionBy("pixel_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    other = F.when(F.col("scl") >= 6, F.struct(F.col("event_id").alias("latest"), "nir"))
    found = obs.withColumn("_last", F.last(other, True).over(upto)).where("scl < 6")
    return found.select("event_id", "_last.latest", "_last.nir")


# Filters and windows


@query("fi10_date_list", "SELECT pixel_id, count(*) AS kept FROM (SELECT DISTINCT pixel_id, day FROM obs) t WHERE date_diff('day', DATE '2024-01-15', day) BETWEEN -5 AND 9 GROUP BY pixel_id", ("obs",))
def _(obs):
    """Each pixel's list of dates, filtered by the label's window as an array."""
    lists = obs.groupBy("pixel_id").agg(F.collect_set("day").alias("days"))  # distinct dates of a pixel
    kept = F.filter("days", lambda d: dates.label_valid(F.lit(date(2024, 1, 15)), d, 5, 9))
    return lists.select("pixel_id", F.size(kept).cast("bigint").alias("kept")).where("kept > 0")


@query("fi14_date_columns", "SELECT pixel_id, step, round(v, 6) AS v FROM long WHERE DATE '2025-01-01' + CAST(8 * step AS INTEGER) >= DATE '2025-03-01' AND DATE '2025-01-01' + CAST(8 * step AS INTEGER) < DATE '2025-06-01'", ("series",))
def _(s):
    """Columns named by date, as a map; those of a range are kept by their names."""
    names = F.transform("s", lambda x, i: F.struct(F.concat(F.lit("NDVI_"), F.date_format(F.date_add(F.lit(date(2025, 1, 1)), i * 8), "yyyy_MM_dd")).alias("name"), i.alias("step"), x.alias("v")))
    day = lambda x: F.to_date(F.regexp_extract(x["name"], r"(\d{4}_\d\d_\d\d)$", 1), "yyyy_MM_dd")
    kept = F.filter(names, lambda x: (day(x) >= F.lit(date(2025, 3, 1))) & (day(x) < F.lit(date(2025, 6, 1))))
    rows = s.select("pixel_id", F.explode(kept).alias("k")).select("pixel_id", "k.step", "k.v")
    return rounded(rows, "v")


@query("fi18_radar_coverage", "SELECT event_id FROM obs WHERE scl <> 3 AND red > 310 AND nir > 2000", ("obs",))
def _(obs):
    """Rows whose radar features are all finite."""
    power = lambda x: F.when(x > 0, 10 * F.log10(x.cast("double")))
    vv, vh = power(F.when(F.col("scl") != 3, F.col("red") - 310)), power(F.col("nir") - 2000)
    finite = [x.isNotNull() & (F.abs(x) < float("inf")) for x in (vv, vh, vv - vh)]
    return obs.where(finite[0] & finite[1] & finite[2]).select("event_id")


def grid_parity(a: DataFrame, b: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """One row: whether two rasters (r, c) agree in extent, size and step."""
    extent = lambda g, n: g.agg(*[f(x).cast("double").alias(f"{n}{k}") for k, (f, x) in enumerate(((F.min, "r"), (F.max, "r"), (F.min, "c"), (F.max, "c"), (F.count, "r")))])
    both = extent(a, "a").join(extent(b, "b"))  # one row each
    same = lambda k: F.abs(F.col(f"a{k}") - F.col(f"b{k}")) <= tolerance
    return both.select((same(0) & same(1) & same(2) & same(3)).alias("extent"), same(4).alias("cells"))


@query("fi19_grid_parity", "SELECT a.r0 = b.r0 AND a.r1 = b.r1 AND a.c0 = b.c0 AND a.c1 = b.c1 AS extent, a.n = b.n AS cells FROM (SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1, count(*) AS n FROM grid) a CROSS JOIN (SELECT min(r) AS r0, max(r) AS r1, min(c) AS c0, max(c) AS c1, count(*) AS n FROM grid WHERE cls <> 255) b", ("grid",))
def _(grid):
    return grid_parity(grid, grid.where("cls <> 255"))


def static_window(year: Column, start: str, end: str) -> tuple[Column, Column]:
    """First and last day of a yearly window given as MM-DD; one that ends before it starts ends in the next year."""
    at = lambda y, md: F.make_date(y, F.lit(int(md[:2])), F.lit(int(md[3:])))
    return at(year, start), at(year + (1 if end < start else 0), end)


@query("dt4_static_window", "SELECT event_id, CASE WHEN month(day) = 1 AND day(day) <= 20 THEN CAST(year(day) - 1 AS INTEGER) ELSE CAST(year(day) AS INTEGER) END AS season, month(day) = 1 AND day(day) <= 20 AS inside FROM obs", ("obs",))
def _(obs):
    """The season of a window over the turn of the year (11-10 to 01-20) that a day belongs to."""
    year = F.year("day")
    begins, ends = static_window(year - 1, "11-10", "01-20")
    late = F.col("day").between(begins, ends)
    return obs.select("event_id", F.when(late, year - 1).otherwise(year).alias("season"), (late | F.col("day").between(*static_window(year, "11-10", "01-20"))).alias("inside"))


def scan_step(width: Column, height: Column, cells: int = 250_000, least: float = 20.0, most: int = 4_000_000) -> Column:
    """Side of a scan cell: about ``cells`` of them, at least ``least`` long, doubled until at most ``most`` fit."""
    first = F.greatest(F.lit(least), F.sqrt(width * height / cells))
    over = F.ceil(width / first) * F.ceil(height / first) / most
    return first * F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.ceil(F.log2(F.greatest(over, F.lit(1.0))) / 2)))


@query("tk5_scan_grid", "SELECT field_id, round(f * pow(2.0, greatest(0.0, ceil(log2(greatest(ceil(w / f) * ceil(h / f) / 4000000, 1.0)) / 2))), 6) AS side FROM (SELECT field_id, (x1 - x0) * 9000.0 AS w, (y1 - y0) * 9000.0 AS h, greatest(20.0, sqrt((x1 - x0) * 9000.0 * (y1 - y0) * 9000.0 / 250000)) AS f FROM fields) t", ("fields",))
def _(fields):
    width, height = (F.col("x1") - F.col("x0")) * 9000.0, (F.col("y1") - F.col("y0")) * 9000.0
    return rounded(fields.select("field_id", scan_step(width, height).alias("side")), "side")


# Projections


def to_utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Easting and northing of WGS 84 degrees in a northern UTM zone, by the series in the third flattening."""
    n = 1 / 298.257223563 / (2 - 1 / 298.257223563)
    radius = 6378137 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    series = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    e = 2 * n**0.5 / (1 + n)
    turn, up = F.radians(lon - (6 * zone - 183)), F.radians(lat)
    t = F.sinh(F.atanh(F.sin(up)) - e * F.atanh(e * F.sin(up)))
    x, y = F.atan2(t, F.cos(turn)), F.atanh(F.sin(turn) / F.sqrt(1 + t * t))
    east = y + sum((a * F.cos(2 * k * x) * F.sinh(2 * k * y) for k, a in enumerate(series, 1)), F.lit(0.0))
    north = x + sum((a * F.sin(2 * k * x) * F.cosh(2 * k * y) for k, a in enumerate(series, 1)), F.lit(0.0))
    return 500000 + 0.9996 * radius * east, 0.9996 * radius * north


def _utm_sql() -> str:
    n = 1 / 298.257223563 / (2 - 1 / 298.257223563)
    e, radius = 2 * n**0.5 / (1 + n), 0.9996 * 6378137 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    a, b, c = n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240
    term = lambda f, g: " + ".join(f"{w!r} * {f}({2 * k} * x) * {g}({2 * k} * y)" for k, w in enumerate((a, b, c), 1))
    return f""", u AS (SELECT item_id, radians(lon - 69.0) AS turn, radians(24 + cloud / 10.0) AS up FROM items), t AS (SELECT item_id, turn, sinh(atanh(sin(up)) - {e!r} * atanh({e!r} * sin(up))) AS t FROM u),
v AS (SELECT item_id, atan2(t, cos(turn)) AS x, atanh(sin(turn) / sqrt(1 + t * t)) AS y FROM t) SELECT item_id, round(500000 + {radius!r} * (y + {term("cos", "sinh")}), 3) AS easting, round({radius!r} * (x + {term("sin", "cosh")}), 3) AS northing FROM v"""


@query("pr25_reproject", _utm_sql(), ("items",))
def _(items):
    """Item positions in UTM zone 42 north."""
    east, north = to_utm(F.col("lon").cast("double"), 24 + F.col("cloud") / 10.0, 42)
    return rounded(items.select("item_id", east.alias("easting"), north.alias("northing")), "easting", "northing", n=3)


@query("pr26_random_translate", "SELECT field_id, round(x0 + 500 * cos(2 * pi() * CAST(('0x' || substr(md5(CAST(field_id AS VARCHAR)), 1, 6)) AS BIGINT) / 16777216.0), 5) AS x, round(y0 + 500 * sin(2 * pi() * CAST(('0x' || substr(md5(CAST(field_id AS VARCHAR)), 1, 6)) AS BIGINT) / 16777216.0), 5) AS y FROM fields", ("fields",))
def _(fields):
    """Boxes moved by 500 in a direction drawn from the hash of their id, the same in every run."""
    turn = 2 * F.pi() * F.conv(F.substring(F.md5(F.col("field_id").cast("string").cast("binary")), 1, 6), 16, 10).cast("double") / 16777216.0
    return rounded(fields.select("field_id", (F.col("x0") + 500 * F.cos(turn)).alias("x"), (F.col("y0") + 500 * F.sin(turn)).alias("y")), "x", "y", n=5)


@query("ep26_tile_retries", "SELECT gx, CASE WHEN gx % 5 = 4 THEN 'RuntimeError: no answer' ELSE 'ok' END AS status, CAST(CASE WHEN gx % 5 = 4 THEN 5 ELSE 1 + gx % 5 END AS INTEGER) AS attempts, CAST(CASE gx % 5 WHEN 0 THEN 0 WHEN 1 THEN 3 WHEN 2 THEN 9 WHEN 3 THEN 21 ELSE 45 END AS DOUBLE) AS waited FROM (SELECT DISTINCT CAST(floor(x0 / 40) AS BIGINT) AS gx FROM fields) t", ("fields",))
def _(fields):
    """Tiles that answer at their first to fourth attempt, or never: the pauses double from 3 s to 30 s at most."""

    def worker(frame, attempt):
        need = int(frame["gx"].iloc[0]) % 5
        if need == 4 or attempt < need:
            raise RuntimeError("no answer")
        return frame[["gx"]].head(1)

    tiles = fields.select(F.floor(F.col("x0") / 40).cast("bigint").alias("gx")).distinct()
    return spatial.tile_retry(tiles, "gx", worker, "gx bigint", attempts=5, pause=lambda seconds: None)


@query("sc12_strips", "SELECT CAST(floor(y0 / 25) AS BIGINT) AS strip, count(*) AS n, CAST(sum((x1 - x0) * (y1 - y0)) AS BIGINT) AS area FROM fields GROUP BY 1", ("fields",))
def _(fields):
    """A layer read strip by strip: a box belongs to the strip of its lower edge, so none is read twice."""
    path = sinks.shared_folder(fields.sparkSession, "strips")
    striped = sinks.write_partitioned(fields.withColumn("strip", F.floor(F.col("y0") / 25).cast("bigint")), path, ["strip"])
    return striped.groupBy("strip").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))).alias("area"))


@query("sc2_first_that_opens", "SELECT event_id AS item_id FROM events")
def _(spark, sf_dir):
    """Catalogs in order of preference; the first that opens is read."""
    return sinks.first_that_opens(spark, [f"{sf_dir}/no_such_catalog.parquet", f"{sf_dir}/events.parquet"]).select(F.col("event_id").alias("item_id"))
