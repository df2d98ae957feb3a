"""Labels of polygons from the pixels inside them, with straight cuts where a cut earns its place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import materialized
from . import spatial, vector

# Clean shares, least pixels, least gain of a cut.
HIGH, LOW, LEAST_PIXELS, LEAST_GAIN = 0.85, 0.15, 10, 0.08


def label_fields(pixels: DataFrame, fields: DataFrame, width: float, least_area: float) -> DataFrame:
    """(field_id, part, ring, pixels, crop_fraction, origin, decision) of polygons of (field_id, ring).

    ``pixels`` has field_id, x, y and crop. A mixed polygon is cut along or across its long axis if
    that raises purity by ``LEAST_GAIN`` and leaves two parts that are wider than ``width``; parts
    below ``least_area`` or of few pixels go, and if none stays the polygon stays whole. Fields
    without a pixel are too small to judge. Pixels are gathered by field for the cuts of mixed
    fields only.
    """
    per = pixels.groupBy("field_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("crop").alias("k"))
    known = fields.select("field_id", "ring").join(per, "field_id", "left").na.fill(0, ["n", "k"]).withColumn("f", F.try_divide(F.col("k").cast("double"), F.col("n")))
    few = F.col("n") < LEAST_PIXELS
    clean = (F.col("f") >= HIGH) | (F.col("f") <= LOW)
    mixed = known.where(~few & ~clean)
    axes = mixed.select("field_id", vector.rectangle("ring").alias("b")).select("field_id", F.array("b.theta", F.col("b.theta") + F.pi() / 2).alias("axes"))
    inside = pixels.select("field_id", "x", "y", "crop").join(axes, "field_id")
    cuts = spatial.best_cut(inside, "field_id", "crop", "x", "y", F.col("axes"), LEAST_PIXELS).select("field_id", "theta", "offset", "purity")
    gain = F.coalesce(F.col("purity"), F.lit(0.0)) - F.greatest(F.col("f"), 1 - F.col("f"))
    tried = mixed.join(cuts, "field_id", "left").withColumn("earns", gain >= LEAST_GAIN).withColumn("h", F.when(F.col("earns"), vector.halves(F.col("ring"), F.col("theta"), F.col("offset"))))
    tried = tried.select("*", F.col("h.above").alias("above"), F.col("h.below").alias("below"))
    tried = materialized(tried.withColumn("wide", vector.field_like("above", width) & vector.field_like("below", width)).drop("h"), "cuts")
    above = spatial.along(F.col("x"), F.col("y"), F.col("theta")) > F.col("offset")
    sides = pixels.join(tried.where("wide").select("field_id", "theta", "offset"), "field_id").groupBy("field_id", above.alias("_up")).agg(F.count(F.lit(1)).alias("pixels"), F.avg(F.col("crop").cast("double")).alias("crop_fraction"))
    parts = tried.where("wide").select("field_id", "purity", F.explode(F.array(F.struct(F.lit(True).alias("_up"), F.col("above").alias("ring")), F.struct(F.lit(False).alias("_up"), F.col("below").alias("ring")))).alias("p")).select("field_id", "purity", "p.*")
    kept = materialized(parts.join(sides, ["field_id", "_up"]).where((F.col("pixels") >= LEAST_PIXELS) & (vector.ring_measures("ring")[0] >= least_area)), "parts")
    bar = F.format_number(F.least(F.floor(F.col("purity") * 10) / 10, F.lit(0.9)), 1)
    cut = kept.select("field_id", F.when(F.col("_up"), 1).otherwise(2).alias("part"), "ring", "pixels", "crop_fraction", F.lit("split").alias("origin"), F.concat(F.lit("cut, purity "), bar, F.lit("+")).alias("decision"))
    whole = lambda rows, decision: rows.select("field_id", F.lit(0).alias("part"), "ring", F.col("n").alias("pixels"), F.when(~few, F.col("f")).alias("crop_fraction"), F.lit("delineation").alias("origin"), decision.alias("decision"))
    made = cut.select("field_id").distinct().withColumn("_made", F.lit(True))
    left = tried.join(made, "field_id", "left").where("_made is null")
    why = F.when(~F.col("earns"), "mixed, majority label").when(~F.col("wide"), "mixed, cut would leave a sliver").otherwise("mixed, cut failed")
    return whole(known.where(few | clean), F.when(few, "too small to judge").otherwise("clean")).unionByName(whole(left, why)).unionByName(cut)
