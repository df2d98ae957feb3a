"""Classifier scores, thresholds, folds and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.spectral import confusion_scores
from ..sources.sinks import shared_folder


def confusion(frame: DataFrame, keys: list[str], actual: Column, predicted: Column) -> DataFrame:
    """Counts and precision, recall, F1 per group; rows without a prediction take no part."""
    rows = frame.where(predicted.isNotNull()).groupBy(*keys).agg(F.count_if(actual & predicted).alias("tp"), F.count_if(~actual & predicted).alias("fp"), F.count_if(actual & ~predicted).alias("fn"), F.count_if(~actual & ~predicted).alias("tn"))
    p, r, f = confusion_scores(F.col("tp"), F.col("fp"), F.col("fn"))
    return rows.select(*keys, "tp", "fp", "fn", "tn", p.alias("precision"), r.alias("recall"), f.alias("f1"))


def score_steps(frame: DataFrame, keys: list[str], actual: Column, prob: str) -> DataFrame:
    """Positives and negatives at each distinct score: all that curves and areas need, one row a score."""
    return frame.where(F.col(prob).isNotNull()).groupBy(*keys, prob).agg(F.count_if(actual).alias("pos"), F.count_if(~actual).alias("neg"))


def roc_auc(frame: DataFrame, keys: list[str], actual: Column, prob: str) -> DataFrame:
    """Area under the ROC curve per group by average ranks; NULL with one class."""
    below = Window.partitionBy(*keys).orderBy(prob).rowsBetween(Window.unboundedPreceding, -1)
    steps = score_steps(frame, keys, actual, prob).withColumn("_below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    got = steps.groupBy(*keys).agg(F.sum(F.col("pos") * (F.col("_below") + F.col("neg") / 2)).alias("_u"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return got.select(*keys, F.try_divide("_u", (F.col("_p") * F.col("_n")).cast("double")).alias("auc"))


def running_totals(steps: DataFrame, prob: str, names: list[str]) -> DataFrame:
    """``steps`` with sums of ``names`` over all rows of at least the row's score (run_*), and over all rows (all_*).

    Rows are dealt by range of the score; each range adds what the ranges above it hold, so no
    task has all scores.
    """
    path = shared_folder(steps.sparkSession, "scores")
    steps.repartitionByRange(F.desc(prob)).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    ranged = steps.sparkSession.read.parquet(path)
    parts = ranged.groupBy("_part").agg(*[F.sum(n).alias(n) for n in names])  # a row a range
    above = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", *[F.coalesce(F.sum(n).over(above), F.lit(0)).alias(f"_{n}") for n in names], *[F.sum(n).over(Window.partitionBy()).alias(f"all_{n}") for n in names])
    upto = Window.partitionBy("_part").orderBy(F.desc(prob)).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.withColumns({f"run_{n}": F.sum(n).over(upto) for n in names}).join(F.broadcast(parts), "_part").withColumns({f"run_{n}": F.col(f"run_{n}") + F.col(f"_{n}") for n in names}).drop("_part", *[f"_{n}" for n in names])


def pr_curve(frame: DataFrame, actual: Column, prob: str) -> DataFrame:
    """Precision, recall, true- and false-positive rate at each distinct threshold."""
    steps = running_totals(score_steps(frame, [], actual, prob), prob, ["pos", "neg"])
    steps = steps.select(prob, "pos", F.col("run_pos").alias("tp"), F.col("run_neg").alias("fp"), F.col("all_pos").alias("_p"), F.col("all_neg").alias("_n"))
    return steps.select(prob, "tp", "fp", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.try_divide("tp", "_p").alias("recall"), F.try_divide("fp", "_n").alias("fpr"), F.try_divide("pos", "_p").alias("gained"))


def average_precision(curve: DataFrame, prob: str) -> DataFrame:
    """Sum of precision times the recall that each threshold adds."""
    return curve.agg(F.sum(F.col("gained") * F.col("precision")).alias("average_precision"))


def threshold_table(frame: DataFrame, actual: Column, prob: str, grid: list[float]) -> DataFrame:
    """Scores at every threshold of a short grid (predicted: prob >= t): one count for each gap of the grid, summed from the top."""
    cuts = F.array(*[F.lit(float(t)) for t in sorted(grid)])
    gap = F.size(F.filter(cuts, lambda t: t <= F.col(prob)))
    gaps = score_steps(frame, [], actual, prob).groupBy(gap.alias("g")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    every = frame.sparkSession.range(len(grid) + 1).select(F.col("id").cast("int").alias("g"))
    full = every.join(F.broadcast(gaps), "g", "left").na.fill(0, ["pos", "neg"])  # a row a threshold
    top, whole = Window.orderBy(F.desc("g")).rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    rows = full.select("g", F.sum("pos").over(top).alias("tp"), F.sum("neg").over(top).alias("fp"), F.sum("pos").over(whole).alias("_p")).where("g > 0")
    rows = rows.select(F.element_at(cuts, F.col("g")).alias("t"), "tp", "fp", (F.col("_p") - F.col("tp")).alias("fn"))
    p, r, f = confusion_scores(F.col("tp"), F.col("fp"), F.col("fn"))
    return rows.select("t", "tp", "fp", "fn", p.alias("precision"), r.alias("recall"), f.alias("f1"))


def best_threshold(table: DataFrame, objective: str = "f1") -> DataFrame:
    """Threshold of the largest objective; the lowest wins a tie."""
    return table.agg(F.max_by(F.struct("t", objective), F.struct(F.col(objective), -F.col("t"))).alias("x")).select("x.t", f"x.{objective}")


def recall_at_precision(curve: DataFrame, least: float) -> DataFrame:
    return curve.where(F.col("precision") >= least).agg(F.coalesce(F.max("recall"), F.lit(0.0)).alias("recall"))


def threshold_at_floor(table: DataFrame, floor: float) -> DataFrame:
    """Lowest cut that removes the most while keeping at least ``floor`` of the others; 1.0 if none does.

    ``table`` has t, removed and kept_share.
    """
    ok = table.where((F.col("kept_share") >= floor) & (F.col("removed") > 0))
    best = ok.agg(F.max_by("t", F.struct("removed", -F.col("t"))).alias("t"))
    return best.select(F.coalesce("t", F.lit(1.0)).alias("t"))


def stratified_cap(frame: DataFrame, strata: list[str], k: int, order: list[Column]) -> DataFrame:
    """At most ``k`` rows of each stratum in a hash order; the limit is applied before the shuffle too."""
    w = Window.partitionBy(*strata).orderBy(*order)
    return frame.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= k)


def hash_ranks(frame: DataFrame, stratum: str, key: str, digits: int = 3) -> DataFrame:
    """Adds _pos (from 1) in the order of the key's MD5 within the stratum, and the stratum's size _n.

    Ranks are exact without one task per stratum: rows are ranked within (stratum, hash prefix), and
    the counts of the earlier prefixes are added.
    """
    rows = frame.withColumn("_h", F.md5(F.col(key).cast("string").cast("binary"))).withColumn("_b", F.substring("_h", 1, digits))
    counts = rows.groupBy(stratum, "_b").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy(stratum)
    counts = counts.select(stratum, "_b", F.coalesce(F.sum("_c").over(whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_c").over(whole).alias("_n"))
    pos = F.col("_before") + F.row_number().over(Window.partitionBy(stratum, "_b").orderBy("_h"))
    return rows.join(counts, [stratum, "_b"]).withColumn("_pos", pos).drop("_h", "_b", "_before")


def stratified_split(frame: DataFrame, stratum: str, key: str, share: float, digits: int = 3) -> DataFrame:
    """Adds ``train``: the first ``share`` of each stratum in the order of the key's MD5."""
    return hash_ranks(frame, stratum, key, digits).withColumn("train", F.col("_pos") <= F.col("_n") * F.lit(share)).drop("_pos", "_n")


def stratified_folds(frame: DataFrame, stratum: str, key: str, folds: int, digits: int = 3) -> DataFrame:
    """Adds ``fold`` from 0: each stratum is dealt over the folds in the order of the key's MD5."""
    return hash_ranks(frame, stratum, key, digits).withColumn("fold", ((F.col("_pos") - 1) % folds).cast("int")).drop("_pos", "_n")


def fold_sizes(frame: DataFrame, group: str, actual: Column, least: int = 1000) -> DataFrame:
    """Leave-one-group-out folds: sizes and whether a fold can be scored."""
    per = frame.groupBy(group).agg(F.count(F.lit(1)).alias("n_test"), F.count_if(actual).alias("n_pos"))
    per = per.withColumn("n_train", F.sum("n_test").over(Window.partitionBy()) - F.col("n_test"))
    return per.withColumn("eligible", (F.col("n_test") >= least) & (F.col("n_train") > 0) & (F.col("n_pos") > 0) & (F.col("n_pos") < F.col("n_test")))


def leave_one_group_out(frame: DataFrame, group: str, actual: Column, fit_predict, least: int = 1000) -> DataFrame:
    """Scores of every eligible fold by ``fit_predict(train, test) -> test with prob``, folds united."""
    folds = [r[group] for r in fold_sizes(frame, group, actual, least).where("eligible").orderBy(group).collect()]
    out = None
    for g in folds:
        scored = fit_predict(frame.where(F.col(group) != g), frame.where(F.col(group) == g)).withColumn("held_out", F.lit(g))
        out = scored if out is None else out.unionByName(scored)
    return out if out is not None else frame.limit(0).withColumns({"prob": F.lit(0.0), "held_out": F.lit(None).cast(frame.schema[group].dataType)})


def gradient_boosted(frame: DataFrame, features: list[str], label: Column, weight_positive: float | None = None, rounds: int = 20, depth: int = 4):
    """Fit a boosted-tree classifier with balanced classes; (model, assembler)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    rows = frame.withColumn("_y", label.cast("double")).dropna(subset=features)
    if weight_positive is None:
        n = rows.groupBy().agg(F.sum("_y").alias("p"), F.count(F.lit(1)).alias("n")).first()
        weight_positive = (n["n"] - n["p"]) / n["p"] if n["p"] else 1.0
    rows = assembler.transform(rows.withColumn("_w", F.when(F.col("_y") == 1, float(weight_positive)).otherwise(1.0)))
    model = GBTClassifier(featuresCol="features", labelCol="_y", weightCol="_w", maxIter=rounds, maxDepth=depth, seed=7).fit(rows.select("features", "_y", "_w"))
    return model, assembler


def predict(frame: DataFrame, model, assembler) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(assembler.transform(frame))
    return scored.withColumn("prob", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def stratified_share(frame: DataFrame, strata: list[str], keys: list[str], share: float) -> DataFrame:
    """Rows whose key's MD5 falls into the first ``share``: the same share of every stratum, the same rows in every run.

    ``strata`` only says which groups the share holds for; no shuffle is needed.
    """
    cut = f"{round(share * 65536):04x}"
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).cast("binary"))
    return frame.dropna(subset=strata).where(F.lit(True) if share >= 1 else F.substring(digest, 1, 4) < cut)


def ablation(train: DataFrame, test: DataFrame, arms: dict[str, list[str]], label: Column, rounds: int = 5, depth: int = 3) -> DataFrame:
    """(arm, features, auc): one fit per feature set, all scored on the same rows."""
    out = None
    for arm, features in arms.items():
        model, assembler = gradient_boosted(train, features, label, rounds=rounds, depth=depth)
        row = roc_auc(predict(test, model, assembler), [], label, "prob").select(F.lit(arm).alias("arm"), F.lit(",".join(features)).alias("features"), "auc")
        out = row if out is None else out.unionByName(row)
    return out


def tuned_boosted(frame: DataFrame, features: list[str], label: Column, depths: tuple[int, ...] = (3, 5), rates: tuple[float, ...] = (0.1, 0.3), rounds: int = 20, folds: int = 3):
    """(table of depth, rate, auc and best; model, assembler): boosted trees by cross-validated area, refitted on all rows."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    rows = assembler.transform(frame.withColumn("_y", label.cast("double")).dropna(subset=features)).select("features", "_y")
    trees = GBTClassifier(featuresCol="features", labelCol="_y", maxIter=rounds, seed=7)
    grid = ParamGridBuilder().addGrid(trees.maxDepth, list(depths)).addGrid(trees.stepSize, list(rates)).build()
    judge = BinaryClassificationEvaluator(labelCol="_y", metricName="areaUnderROC")
    found = CrossValidator(estimator=trees, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=7, parallelism=2).fit(rows)
    top = max(found.avgMetrics)
    table = [(p[trees.maxDepth], p[trees.stepSize], float(m), bool(m == top)) for p, m in zip(grid, found.avgMetrics)]
    return frame.sparkSession.createDataFrame(table, "depth int, rate double, auc double, best boolean"), found.bestModel, assembler


def tuned_forest(frame: DataFrame, features: list[str], label: Column, depths: tuple[int, ...] = (5, 8, 12), trees: tuple[int, ...] = (50, 100), folds: int = 3) -> DataFrame:
    """(depth, trees, accuracy, best) of every setting of a random forest by cross-validation."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    rows = assembler.transform(frame.withColumn("_y", label.cast("double")).dropna(subset=features)).select("features", "_y")
    forest = RandomForestClassifier(featuresCol="features", labelCol="_y", seed=7)
    grid = ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).addGrid(forest.numTrees, list(trees)).build()
    judge = MulticlassClassificationEvaluator(labelCol="_y", metricName="accuracy")
    found = CrossValidator(estimator=forest, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, seed=7, parallelism=2).fit(rows)
    top = max(found.avgMetrics)
    table = [(p[forest.maxDepth], p[forest.numTrees], float(m), bool(m == top)) for p, m in zip(grid, found.avgMetrics)]
    return frame.sparkSession.createDataFrame(table, "depth int, trees int, accuracy double, best boolean")
