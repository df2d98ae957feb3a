"""Input projections over the benchmark tables: labelled pixels, observations, series, rasters, fields.

Each projection is one SQL text that Spark and other engines read alike; ``load`` binds it to the
Parquet files, so column pruning and filters reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PX = """SELECT aoi, date, label, B2, B3, B4, B5, B8,
  CASE WHEN B8 + B4 = 0 THEN 0 ELSE cast(floor(greatest(0, (B8 - B4) * 10000) / (B8 + B4)) AS bigint) END AS NDVI, k
FROM (SELECT aoi, concat('2025-', lpad(cast(mm AS string), 2, '0'), '-15') AS date, label,
    300 + (l_partkey * 37 + l_linenumber * 11) % 900 + (11 - mm) * 220 AS B2,
    400 + (l_partkey * 53 + l_suppkey * 7) % 900 + (11 - mm) * 90 AS B3,
    500 + (l_orderkey * 29 + l_linenumber * 17) % 900 + (11 - mm) * 60 - CASE WHEN label = 1 THEN 200 ELSE 0 END AS B4,
    700 + (l_orderkey * 31 + l_partkey) % 1200 AS B5,
    CASE WHEN l_quantity = 1 THEN 0 ELSE 1800 + (l_orderkey * 13 + l_suppkey * 19) % 1500 - (11 - mm) * 90 + CASE WHEN label = 1 THEN 900 ELSE 0 END END AS B8,
    l_orderkey AS k
  FROM (SELECT *, concat('aoi_', cast(l_suppkey % 8 AS string)) AS aoi, 8 + l_partkey % 4 AS mm,
      CASE WHEN l_returnflag = 'R' THEN 1 ELSE 4 END AS label FROM {lineitem}) s) t"""

OBS = """SELECT event_id, user_id AS pixel_id, cast(ts AS date) AS day, event_id % 12 AS scl,
  300 + (event_id * 17) % 1500 AS red, 2000 + (event_id * 37) % 3000 AS nir, (event_id * 7) % 100 AS cloud FROM {events}"""

GRID = """SELECT r, c, CASE WHEN (o_orderkey * 7919) % 97 = 0 THEN 255
    WHEN (cast(floor(r / 5) AS bigint) * 3 + cast(floor(c / 6) AS bigint) * 5) % 7 < 3 THEN CASE WHEN o_custkey % 11 = 0 THEN 4 ELSE 1 END
    ELSE CASE WHEN o_custkey % 13 = 0 THEN 1 ELSE 4 END END AS cls, o_custkey AS v
FROM (SELECT *, cast(floor(o_orderkey / 100) AS bigint) AS r, o_orderkey % 100 AS c FROM {orders}) s"""

SCENE = """SELECT r, c, cls, v, 300 + (v * 37 + c * 11) % 900 AS B2, 400 + (v * 53 + r * 7) % 900 AS B3,
  500 + (v * 29 + c * 17) % 900 - CASE WHEN cls = 1 THEN 200 ELSE 0 END AS B4, 700 + (v * 31 + r) % 1200 AS B5,
  CASE WHEN v % 50 = 0 THEN 0 ELSE 1800 + (v * 13 + r * 19) % 1500 + CASE WHEN cls = 1 THEN 900 ELSE 0 END END AS B8 FROM (""" + GRID + """) g"""

LAYERS = """SELECT r, c, d, CASE d WHEN 1 THEN DATE '2025-10-04' WHEN 2 THEN DATE '2025-10-09' ELSE DATE '2025-10-14' END AS day,
  CASE WHEN d = 2 AND v % 97 = 0 THEN 9 ELSE 4 END AS scl,
  cast(floor((400 + (v * 13 + r * 7 + c * 3) % 1500) * (11 - d) / 10) AS bigint) - 60 * d + (v * d) % 7 AS red,
  cast(floor((2000 + (v * 19 + r * 5 + c) % 2500) * (13 - d) / 12) AS bigint) - 90 * d + (v * d) % 5 AS nir
FROM (""" + GRID + """) g CROSS JOIN (VALUES (1), (2), (3)) t(d) WHERE (d = 1 AND c < 60) OR (d = 2 AND c >= 40) OR (d = 3 AND c >= 70)"""

FIELDS = """SELECT c_custkey AS field_id, (c_custkey % 40) * 10 AS x0, cast(floor(c_custkey / 40) AS bigint) * 10 AS y0,
  (c_custkey % 40) * 10 + 8 + c_nationkey % 7 AS x1, cast(floor(c_custkey / 40) AS bigint) * 10 + 8 + c_nationkey % 5 AS y1 FROM {customer}"""

ITEMS = """SELECT event_id AS item_id, ts, (event_id * 7) % 100 AS cloud, 60 + user_id % 20 AS lon,
  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 < 3 THEN 3.01 ELSE 5.09 END AS baseline FROM {events}"""

SCORES = "SELECT k, aoi, date, label, cast(5 * (B5 % 1000) + CASE WHEN label = 1 THEN 3000 ELSE 1000 END AS double) / 10000 AS prob FROM (" + PX + ") p"

VIEWS = {"px": (PX, "lineitem"), "obs": (OBS, "events"), "grid": (GRID, "orders"), "scene": (SCENE, "orders"), "layers": (LAYERS, "orders"), "fields": (FIELDS, "customer"), "items": (ITEMS, "events"), "scores": (SCORES, "lineitem")}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the projections, ``series`` (arrays of NDVI-like values) or ``long`` (one row a step)."""
    if name in ("series", "long"):
        table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
        value = lambda x, i: F.when((F.col("vec_id") * 7 + i) % 11 == 0, None).otherwise((x.cast("double") + 0.6) / 1.2)
        rows = table.select(F.col("vec_id").alias("pixel_id"), F.when(F.col("label") < 5, 1).otherwise(2).alias("label"), (F.col("label") % 5).alias("district"), F.transform("embedding", value).alias("s"))
        return rows if name == "series" else rows.select("pixel_id", "label", "district", F.posexplode("s").alias("step", "v"))
    text, table = VIEWS[name]
    return spark.sql(text, **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


LONG_SQL = """SELECT vec_id AS pixel_id, CASE WHEN label < 5 THEN 1 ELSE 2 END AS label, label % 5 AS district, step,
  CASE WHEN (vec_id * 7 + step) % 11 = 0 THEN NULL ELSE (cast(x AS double) + 0.6) / 1.2 END AS v
FROM (SELECT vec_id, label, unnest(range(len(embedding))) AS step, unnest(embedding) AS x FROM embeddings) e"""


def oracle(name: str) -> str:
    """The projection as a common table expression for the oracle's engine."""
    text = LONG_SQL if name == "long" else VIEWS[name][0].replace("{" + VIEWS[name][1] + "}", VIEWS[name][1])
    return f"{name} AS ({text})"
