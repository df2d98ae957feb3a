"""Structured Streaming forms: windowed composites, running counts, sliding and session windows, batch sinks.

The functions take and give streaming DataFrames (or batch ones); ``run_available`` drives a
stream over what is there and returns its result table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import shared_folder


def read_table(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """A Parquet file or folder as a stream, with the schema of what is there.

    The path is given as a pattern, since a stream takes a plain path for a folder. Times without
    a zone are read in the session's zone: watermarks need instants.
    """
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path[:-1]}[{path[-1]}]")
    plain = [f.name for f in schema if f.dataType.typeName() == "timestamp_ntz"]
    return rows.withColumns({n: F.col(n).cast("timestamp") for n in plain}) if plain else rows


def window_composite(obs: DataFrame, ts: str, keys: list[str], bands: list[str], keep: Column, days: int, offset_days: int, delay: str = "2 days") -> DataFrame:
    """Median of each band per key and tumbling window; later rows than ``delay`` behind the newest are dropped.

    The state of a key and window holds one count for each distinct value, so medians are exact.
    """
    win = F.window(ts, f"{days} days", f"{days} days", f"{offset_days} days")
    cols = [F.percentile(F.when(keep, F.col(b)), F.lit(0.5)).alias(b) for b in bands]
    out = obs.withWatermark(ts, delay).groupBy(*keys, win.alias("_w")).agg(*cols, F.count_if(keep).alias("n_valid"), F.count(F.lit(1)).alias("n_scenes"))
    return out.select(*keys, F.to_date("_w.start").alias("begins"), *bands, "n_valid", "n_scenes")


def running_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Row counts per key; in update mode only the keys that a batch has changed are sent on."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def sliding_counts(rows: DataFrame, ts: str, keys: list[str], size: str, slide: str, delay: str = "2 days") -> DataFrame:
    out = rows.withWatermark(ts, delay).groupBy(*keys, F.window(ts, size, slide).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.col("_w.start").alias("begins"), "n")


def sessions(rows: DataFrame, ts: str, keys: list[str], gap: str, delay: str = "2 days") -> DataFrame:
    """Sessions of a key: runs of rows that follow each other by less than ``gap``."""
    out = rows.withWatermark(ts, delay).groupBy(*keys, F.session_window(ts, gap).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.col("_w.start").alias("begins"), "n")


def batch_writer(path: str):
    """Sink for ``foreachBatch``: a batch that is run again replaces its own folder and adds no row twice."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def process_new(spark: SparkSession, folder: str, schema, out: str, work) -> None:
    """Run ``work(batch)`` over the files of ``folder`` that no earlier call has seen, and add the result below ``out``."""
    write = batch_writer(f"{out}/rows")
    rows = spark.readStream.schema(schema).parquet(folder)
    sink = rows.writeStream.option("checkpointLocation", f"{out}/progress").trigger(availableNow=True)
    sink.foreachBatch(lambda batch, number: write(work(batch), number)).start().awaitTermination()


def run_available(stream: DataFrame, mode: str, name: str) -> DataFrame:
    """Run a stream over the files present and read the result: all batches, or the last of a complete stream."""
    spark = stream.sparkSession
    path = shared_folder(spark, name)
    run = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).foreachBatch(batch_writer(f"{path}/rows")).start()
    run.awaitTermination()
    out = spark.read.parquet(f"{path}/rows")
    if mode == "complete":
        out = out.where(F.col("batch") == out.agg(F.max("batch")).first()[0])
    return out.drop("batch")
