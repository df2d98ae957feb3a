"""Vector shards: bounded blocks of rows as files of the shared folder, named by small rows.

A shard holds at most ``rows`` vectors of one length from one input partition, so building shards
shuffles nothing and no label or key decides their size. Shards are written once; what is joined and
shuffled afterwards are names, and a task loads the shards that its rows name, one at a time.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import open_shared


def clean_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v ARRAY<DOUBLE>) of rows with an id and a non-empty vector of finite components."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return table.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)


def save(folder: str, value: object) -> str:
    """Write ``value`` to a file of its own; a lost task's file is named by no row."""
    path = f"{folder}/{uuid.uuid4().hex}"
    with open_shared(path, "wb") as file:
        file.write(pickle.dumps(value, 5))
    return path


def load(path: str) -> dict:
    with open_shared(path, "rb") as file:
        return pickle.loads(file.read())


def shards(vectors: DataFrame, rows: int, build: Callable[[np.ndarray, np.ndarray], tuple]) -> DataFrame:
    """(path STRING, dim INT, n INT, centre ARRAY<DOUBLE>, radius DOUBLE) for up to ``rows`` rows each.

    ``build(ids, matrix)`` writes a shard and gives its path, centre and radius.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def emit(dim: int) -> pa.RecordBatch:
            ids, matrix = (np.concatenate(x) for x in zip(*held.pop(dim)))
            path, centre, radius = build(ids, matrix)
            columns = [pa.array([path]), pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([centre], pa.list_(pa.float64())), pa.array([radius], pa.float64())]
            return pa.RecordBatch.from_arrays(columns, ["path", "dim", "n", "centre", "radius"])

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            dims = np.diff(offsets)
            for dim in np.unique(dims).tolist():
                mine = np.nonzero(dims == dim)[0]
                matrix = flat[(offsets[mine][:, None] + np.arange(dim)).ravel()].reshape(len(mine), dim)
                at = 0
                while at < len(mine):
                    room = rows - sum(len(x) for x, _ in held.get(dim, []))
                    held.setdefault(dim, []).append((ids[mine[at : at + room]], matrix[at : at + room]))
                    at += room
                    if at <= len(mine):
                        yield emit(dim)
        for dim in sorted(held):
            yield emit(dim)

    return vectors.select("id", "v").mapInArrow(run, "path string, dim int, n int, centre array<double>, radius double")
