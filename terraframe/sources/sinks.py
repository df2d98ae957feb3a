"""Sinks: partitioned tables, reports, tiles with a manifest, and runs that can be resumed."""

from __future__ import annotations

import hashlib
import tempfile
import time
import uuid
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; without that setting, a temporary one of a local master only."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="terraframe-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` written to a fresh folder and read back, for results that several branches need."""
    path, schema = shared_folder(df.sparkSession, name), df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file system has ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def discover(spark: SparkSession, folder: str, patterns: dict[str, tuple[str, ...]], optional: tuple[str, ...] = ()) -> dict[str, str | None]:
    """The first path by name of each artifact, by its patterns in turn; None for an optional one, else an error."""
    jvm, out = spark.sparkContext._jvm, {}
    base = jvm.org.apache.hadoop.fs.Path(folder)
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, globs in patterns.items():
        hits = (sorted(str(s.getPath()) for s in files.globStatus(jvm.org.apache.hadoop.fs.Path(base, g)) or ()) for g in globs)
        out[name] = next((h[0] for h in hits if h), None)
        if out[name] is None and name not in optional:
            raise FileNotFoundError(f"no {' or '.join(globs)} in {folder}")
    return out


class Stages:
    """Outcome and seconds of named stages, appended to a table as each ends; an error is recorded and raised."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @contextmanager
    def stage(self, name: str):
        began, status = time.monotonic(), "failed"
        try:
            yield
            status = "done"
        finally:
            row = [(name, status, round(time.monotonic() - began, 1))]
            self.spark.createDataFrame(row, "stage string, status string, seconds double").coalesce(1).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def first_that_opens(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first of several tables that can be read; an error that names all of them if none can."""
    failed = []
    for path in paths:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            failed.append(f"{path}: {str(e).splitlines()[0]}")
    raise FileNotFoundError("; ".join(failed))


def cached(spark: SparkSession, folder: str, key: tuple, make) -> DataFrame:
    """The table of ``make()``, written once below ``folder`` for a key (source, time, bounds, version) and read from then on."""
    path = f"{folder}/{hashlib.sha1(repr(key).encode()).hexdigest()}"
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_partitioned(df: DataFrame, path: str, keys: list[str], mode: str = "errorifexists") -> DataFrame:
    """Write one folder a key and read the table back; rows are not gathered by key first."""
    df.write.mode(mode).option("compression", "snappy").partitionBy(*keys).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> DataFrame:
    """Write a report as CSV with a header and read it back with the same types."""
    df.write.mode(mode).option("header", True).csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


def write_missing(df: DataFrame, path: str, key: str) -> DataFrame:
    """Append the rows of keys that ``path`` has not finished yet, and read all of it back.

    A key counts as finished when the manifest beside the table lists it; the manifest is written after
    the rows. Rows of a key that a stopped run left without its manifest are not read: every run
    writes a folder of its own that its manifest rows name.
    """
    spark, manifest, run = df.sparkSession, f"{path}/manifest", uuid.uuid4().hex
    there = exists(spark, manifest)
    todo = df.join(spark.read.parquet(manifest).select(key), key, "left_anti") if there else df
    todo.write.parquet(f"{path}/rows/run={run}")
    done = spark.read.schema(df.schema).parquet(f"{path}/rows/run={run}").groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    done.withColumn("run", F.lit(run)).write.mode("append").parquet(manifest)
    kept = spark.read.parquet(manifest).select(key, "run")
    rows = spark.read.option("basePath", f"{path}/rows").schema(StructType([*df.schema, StructField("run", StringType())])).parquet(f"{path}/rows")
    return rows.join(kept, [key, "run"], "left_semi").select(*df.columns)
