"""Connected components over link tables, without collecting links or labels.

Each round hooks every vertex to its smallest neighbour, shortens the resulting forest by
pointer jumping and contracts the links, so the number of rounds is logarithmic in practice.
All per-vertex reductions are ``groupBy().min``, which combine before the shuffle, so a vertex
with very many links is no hot spot; label tables are broadcast only while their counted size
is below ``BROADCAST_ROWS`` and shuffled beyond that.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import materialize

BROADCAST_ROWS = 200_000


def star_edges(n: int, u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars (member, smallest member) of the graph on ``0..n-1`` with edges u-v."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if (label == before).all():
            break
    member = np.nonzero(label != np.arange(n))[0]
    return member, label[member]


def _lookup(df: DataFrame, column: str, table: DataFrame, small: bool) -> DataFrame:
    """Replace ``column`` by ``table``'s ``parent`` where there is one."""
    table = table.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
    joined = df.join(F.broadcast(table) if small else table, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_parent", column)).drop("_node", "_parent")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every vertex of ``edges``; component = smallest vertex reachable.

    Null ends and self-links are ignored; an empty table gives an empty result. Vertices may be
    of any orderable type.
    """
    links = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    links = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_low"))
        parent = materialize(parent.select("node", F.least("node", "_low").alias("parent")), "parent")
        small = parent.count() <= BROADCAST_ROWS
        while True:
            jumped = _lookup(parent.withColumn("_was", F.col("parent")), "parent", parent, small)
            jumped = materialize(jumped, "jump")
            changed = not jumped.where("parent <> _was").isEmpty()
            parent = jumped.drop("_was")
            if not changed:
                break
        if labels is None:
            labels = parent
        else:
            labels = materialize(_lookup(labels, "parent", parent, small), "labels")
        links = _lookup(_lookup(links, "a", parent, small), "b", parent, small).where("a <> b")
        links = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels.select("node", F.col("parent").alias("component"))
