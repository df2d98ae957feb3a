"""Rasters as block tables: one row holds one tile's cells as packed numbers, so a window reads only its tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIDE = 256
KINDS = {"uint8": 255, "uint16": 0, "float32": float("nan")}


def write_blocks(cells: DataFrame, path: str, value: str, kind: str = "uint16", side: int = SIDE) -> None:
    """Write cells (r, c, value) as blocks of ``side`` by ``side``; missing cells hold the kind's nodata value."""
    nodata = KINDS[kind]

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        tr, tc = int(frame["tr"].iloc[0]), int(frame["tc"].iloc[0])
        block = np.full((side, side), nodata, kind)
        there = frame["v"].notna().to_numpy()
        block[frame["r"].to_numpy()[there] - tr * side, frame["c"].to_numpy()[there] - tc * side] = frame["v"].to_numpy()[there]
        return pd.DataFrame({"tr": [tr], "tc": [tc], "kind": [kind], "side": [side], "data": [block.astype("<" + np.dtype(kind).str[1:]).tobytes()]})

    tile = lambda x: F.floor(F.col(x) / side).cast("bigint").alias(f"t{x}")
    rows = cells.select(F.col("r").cast("bigint").alias("r"), F.col("c").cast("bigint").alias("c"), F.col(value).cast("double").alias("v")).select("*", tile("r"), tile("c"))
    packed = rows.groupBy("tr", "tc").applyInPandas(pack, "tr bigint, tc bigint, kind string, side int, data binary")  # a tile has side * side cells
    packed.sortWithinPartitions("tr", "tc").write.parquet(path)


def _met(spark: SparkSession, path: str, rows: tuple[int, int], cols: tuple[int, int], side: int) -> DataFrame:
    """The tiles that a window meets."""
    met = [F.col(t).between(a // side, (b - 1) // side) for t, (a, b) in (("tr", rows), ("tc", cols))]
    return spark.read.parquet(path).where(met[0] & met[1])


def read_layers(spark: SparkSession, paths: dict[str, str], rows: tuple[int, int], cols: tuple[int, int], side: int = SIDE) -> DataFrame:
    """(r, c, a column for each name) of the cells of a window that all of several block tables of one side hold.

    Packed tiles are joined and then unpacked. The join is sorted: the size of a packed file does not tell that of its cells.
    """
    names = list(paths)
    tiles = None
    for i, path in enumerate(paths.values()):
        layer = _met(spark, path, rows, cols, side).select("tr", "tc", "side", F.col("kind").alias(f"kind{i}"), F.col("data").alias(f"data{i}"))
        tiles = layer if tiles is None else tiles.join(layer.hint("merge"), ["tr", "tc", "side"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                tr, tc, n, *packed = (batch.column(i)[k].as_py() for i in range(batch.num_columns))
                layers = [(kind, np.frombuffer(data, np.dtype(kind).newbyteorder("<")).reshape(n, n)) for kind, data in zip(packed[::2], packed[1::2])]
                keep = np.logical_and.reduce([~np.isnan(block) if kind == "float32" else block != KINDS[kind] for kind, block in layers])
                y, x = np.nonzero(keep)
                inside = (y + tr * n >= rows[0]) & (y + tr * n < rows[1]) & (x + tc * n >= cols[0]) & (x + tc * n < cols[1])
                y, x = y[inside], x[inside]
                yield pa.RecordBatch.from_arrays([pa.array(y + tr * n), pa.array(x + tc * n), *[pa.array(block[y, x].astype(float)) for _, block in layers]], ["r", "c", *names])

    return tiles.mapInArrow(unpack, "r bigint, c bigint, " + ", ".join(f"`{n}` double" for n in names))


def read_window(spark: SparkSession, path: str, rows: tuple[int, int], cols: tuple[int, int], side: int = SIDE) -> DataFrame:
    """(r, c, v) of the cells in half-open ranges of rows and columns; only tiles that the window meets are read."""
    return read_layers(spark, {"v": path}, rows, cols, side)
