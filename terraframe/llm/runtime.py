"""Shared scratch space: cutting lineage and exchanging files between executors.

Everything that must outlive a task goes to the folder that the cluster names in
``spark.checkpoint.dir``, which all executors and the driver can reach. Machine-local
temporary folders are used only when that setting is absent (tests, one machine).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_ROOTS: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def scratch_root(spark: SparkSession) -> str:
    """URI of this application's own folder below ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    if sc not in _ROOTS:
        base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="terraframe-")
        root = f"{base.rstrip('/')}/terraframe-{uuid.uuid4().hex}"
        _ROOTS[sc] = root
        atexit.register(_remove, weakref.ref(spark), root)
    return _ROOTS[sc]


def _remove(session_ref, root: str) -> None:
    spark = session_ref()
    if spark is None or spark.sparkContext._jsc is None:
        return
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the JVM may be gone at interpreter exit
        pass


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh URI below the scratch root; nothing is created yet."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    The result has no lineage, survives lost executors, and (unlike ``checkpoint``) carries no
    partitioning, so a later join shuffles both sides and the planner may split skewed keys.
    """
    path = scratch(df.sparkSession, name)
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def open_shared(uri: str, mode: str):
    """Open a file of the shared folder from the driver or an executor (``rb`` or ``wb``)."""
    if uri.startswith("file:") or "://" not in uri:
        path = uri.removeprefix("file:")
        path = "/" + path.lstrip("/")
        if "w" in mode:
            os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, mode)
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if "w" in mode:
        store.create_dir(os.path.dirname(path), recursive=True)
        return store.open_output_stream(path)
    return store.open_input_file(path)
