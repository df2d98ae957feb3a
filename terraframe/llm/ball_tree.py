"""Exact top-k inner products by ball trees: one tree per shard, branch and bound.

Components are floor(scale * x), so scores are exact integers. A tree node keeps the mean of its
rows and their largest distance from it; no row below it can score more than q.c + |q| r. A block
of queries walks a tree together: nodes are taken from a queue in the order of their best upper
bound over the block, and a query leaves a node as soon as its bound is under the query's k-th
score so far (equal bounds stay, for ties). A task has one block and the names and root balls of
a group of trees: it visits them in the order of their bounds, hands the current k-th scores from tree
to tree, and reads no tree whose root ball is out of reach. Groups are searched in waves of growing
number, and each wave starts from the k-th scores of all waves before it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import materialize, scratch
from .vectors import clean_vectors, load, save, shards

SHARD_ROWS = 8192
QUERY_ROWS = 256
LEAF_ROWS = 256
GROUP_TREES = 16
NONE = -(1 << 63)


def quantise(matrix: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) as int64, or as Python integers where products could leave int64."""
    whole = np.floor(matrix * scale)
    peak = float(np.abs(whole).max(initial=0))
    if peak * peak * matrix.shape[1] < 2.0**62:
        return whole.astype(np.int64)
    out = np.empty(whole.shape, object)
    out[:] = [[int(x) for x in row] for row in whole]
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T; float64 where it can't round, Python integers clipped to int64 beyond."""
    if a.dtype == object or b.dtype == object:
        return np.clip(a.astype(object) @ b.astype(object).T, -(2**63) + 1, 2**63 - 1).astype(np.int64)
    peak = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if peak < 2.0**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if peak < 2.0**62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -(2**63) + 1, 2**63 - 1).astype(np.int64)


def build_tree(ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF_ROWS) -> dict:
    """Tree over integer rows: halves by the coordinate of largest spread; arrays of nodes."""
    points, order = rows.astype(np.float64), np.arange(len(rows))
    nodes: list[tuple[int, int, int, int]] = []
    centres, radii = [], []
    stack = [(0, len(rows), -1, 0)]
    while stack:
        a, b, parent, side = stack.pop()
        part = points[order[a:b]]
        centre = part.mean(axis=0)
        at = len(nodes)
        nodes.append((a, b, -1, -1))
        centres.append(centre)
        radii.append(float(np.sqrt(((part - centre) ** 2).sum(axis=1).max())))
        if parent >= 0:
            x = nodes[parent]
            nodes[parent] = (x[0], x[1], at, x[3]) if side == 0 else (x[0], x[1], x[2], at)
        if b - a > leaf:
            axis = int(np.argmax(np.ptp(part, axis=0)))
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, axis], mid)]
            stack += [(a, a + mid, at, 0), (a + mid, b, at, 1)]
    return {"ids": ids[order], "rows": rows[order], "nodes": nodes, "centres": np.array(centres), "radii": np.array(radii)}


def root_bound(queries: np.ndarray, centre: np.ndarray, radius: float) -> np.ndarray:
    """Upper bound of each query's score in a ball, with room for the rounding of float64."""
    q = queries.astype(np.float64)
    dot, norm = q @ centre, np.sqrt((q * q).sum(axis=1))
    return dot + norm * radius + 1e-9 * (np.abs(dot) + norm * (radius + np.abs(centre).sum())) + 1e-6


def search(tree: dict, qids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(len(queries), k) ids and scores, best first, ties to the smaller id; -1 and NONE where fewer.

    ``floor`` has a known lower bound of each query's k-th score; results under it may be missing.
    """
    n = len(queries)
    best = np.full((n, k), NONE, np.int64)
    who = np.full((n, k), np.iinfo(np.int64).max, np.int64)
    kth = floor.copy()
    q = queries.astype(np.float64)
    norm = np.sqrt((q * q).sum(axis=1))
    dot = q @ tree["centres"].T
    # Room for the rounding of bounds in float64.
    bound = dot + norm[:, None] * tree["radii"][None, :]
    bound += 1e-9 * (np.abs(dot) + norm[:, None] * (tree["radii"] + np.abs(tree["centres"]).sum(axis=1))[None, :]) + 1e-6
    queue = [(-bound[:, 0].max(initial=-np.inf), 0)]
    while queue:
        _, node = heapq.heappop(queue)
        live = np.nonzero(bound[:, node] >= kth)[0]
        if not len(live):
            continue
        a, b, low, high = tree["nodes"][node]
        if low >= 0:
            for child in (low, high):
                heapq.heappush(queue, (-bound[live, child].max(), child))
            continue
        got = scores(queries[live], tree["rows"][a:b])
        ids = tree["ids"][a:b]
        got[qids[live][:, None] == ids[None, :]] = NONE
        keep = got >= kth[live][:, None]
        some = keep.any(axis=1)
        live, got = live[some], got[some]
        if not len(live):
            continue
        all_scores = np.concatenate([best[live], got], axis=1)
        all_ids = np.concatenate([who[live], np.broadcast_to(ids, got.shape)], axis=1)
        rank = np.lexsort((all_ids, -np.maximum(all_scores, NONE + 1)), axis=1)[:, :k]
        best[live], who[live] = np.take_along_axis(all_scores, rank, 1), np.take_along_axis(all_ids, rank, 1)
        kth[live] = np.maximum(kth[live], best[live, k - 1])
    return np.where(best == NONE, -1, who), best


def _search_groups(work: DataFrame, k: int) -> DataFrame:
    """(block, row, query_id, vec_id, score) over rows of (block, trees, known)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, trees, known in zip(*(batch.column(i).to_pylist() for i in range(3))):
                block = load(name)
                ids, rows, n = block["ids"], block["rows"], len(block["ids"])
                floor = np.full(n, NONE, np.int64)
                for x in known or []:
                    floor[x["row"]] = x["kth"]
                who, best = np.full((n, k), -1, np.int64), np.full((n, k), NONE, np.int64)
                bounds = [root_bound(rows, np.array(t["centre"]), t["radius"]) for t in trees]
                for i in sorted(range(len(trees)), key=lambda i: -bounds[i].max(initial=-np.inf)):
                    live = np.nonzero(bounds[i] >= floor)[0]
                    if not len(live):
                        continue
                    got_ids, got = search(load(trees[i]["path"]), ids[live], rows[live], floor[live], k)
                    every, scored = np.concatenate([who[live], got_ids], axis=1), np.concatenate([best[live], got], axis=1)
                    rank = np.lexsort((every, -np.maximum(scored, NONE + 1)), axis=1)[:, :k]
                    who[live], best[live] = np.take_along_axis(every, rank, 1), np.take_along_axis(scored, rank, 1)
                    floor[live] = np.maximum(floor[live], best[live, k - 1])
                there = best > NONE
                of = np.nonzero(there)[0]
                columns = [pa.array([name] * len(of), pa.string()), pa.array(of, pa.int32()), pa.array(ids[of]), pa.array(who[there]), pa.array(best[there])]
                yield pa.RecordBatch.from_arrays(columns, ["block", "row", "query_id", "vec_id", "score"])

    return work.select("block", "trees", "known").mapInArrow(run, "block string, row int, query_id bigint, vec_id bigint, score bigint")


def top_k(queries: DataFrame, table: DataFrame, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS, group_trees: int = GROUP_TREES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best other rows of ``table``.

    Rows with the query's own id are no candidates. Rows that repeat an id are queries and candidates
    each: a repeated query has its ranks once for each of its rows. Vectors that are null, empty or
    hold null or non-finite components take no part, and vectors of different length don't meet.
    Fewer than ``k`` candidates give fewer rows, an empty table none. Scores beyond int64 are
    clipped to it.
    """
    spark = table.sparkSession
    folder = scratch(spark, "trees")

    def pack(ids: np.ndarray, matrix: np.ndarray) -> tuple:
        return save(folder, {"ids": ids, "rows": quantise(matrix, scale)}), [], 0.0

    def plant(ids: np.ndarray, matrix: np.ndarray) -> tuple:
        tree = build_tree(ids, quantise(matrix, scale))
        return save(folder, tree), tree["centres"][0].tolist(), float(tree["radii"][0])

    blocks = materialize(shards(clean_vectors(queries, id_col, vector_col).coalesce(_few(queries)), query_rows, pack), "queries")
    blocks = blocks.select(F.col("path").alias("block"), "dim")
    trees = materialize(shards(clean_vectors(table, id_col, vector_col), shard_rows, plant), "trees")
    n_groups = max(1, -(-trees.count() // group_trees))
    dealt = trees.withColumn("g", F.pmod(F.xxhash64("path"), F.lit(n_groups)))
    groups = materialize(dealt.groupBy("g", "dim").agg(F.collect_list(F.struct("path", "centre", "radius")).alias("trees")), "groups")  # about group_trees names
    found, low, high = None, 0, 1
    while low < n_groups:
        work = blocks.join(groups.where((F.col("g") >= low) & (F.col("g") < high)), "dim")
        if found is None:
            work = work.withColumn("known", F.lit(None).cast("array<struct<row:int,kth:bigint>>"))
        else:
            scored = found.groupBy("block", "row").agg(F.sort_array(F.collect_list("score"), False).alias("s")).where(F.size("s") >= k)  # k a wave at most
            known = scored.groupBy("block").agg(F.collect_list(F.struct("row", F.element_at("s", k).alias("kth"))).alias("known"))  # a block's rows
            work = work.join(known, "block", "left")
        work = materialize(work.select("block", "trees", "known"), "work")
        got = materialize(_search_groups(work.repartition(max(1, min(work.count(), 20_000))), k), "found")
        found = got if found is None else found.unionByName(got)
        low, high = high, 4 * high
    order = Window.partitionBy("block", "row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _few(queries: DataFrame) -> int:
    """Partitions for the query blocks: about one for each 4 default tasks, as they are fewer rows."""
    return max(1, queries.sparkSession.sparkContext.defaultParallelism // 4)


def op1_ball_tree(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(table.where("vec_id % 50 = 0"), table)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
