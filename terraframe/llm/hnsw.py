"""Embedding near-duplicates by hierarchical navigable small-world graphs, one per shard.

Equal vectors are one node with a weight. Every two shards meet once: the vectors of one, in
slices, query the graph of the other (and every shard its own), all queries of a step advancing
through the graph together. A search is a greedy descent through the upper layers, a beam over
layer 0, and then a widening of the beam over everything connected above the link threshold minus
a margin, so the number of links of a vector is not limited by the beam. Each slice is audited
against brute force over the shard with some of its own rows and with planted near copies of the
shard's rows, so that no audit is empty; beam and margin grow until the mean recall of the audited
queries passes, and brute force takes over where the widest beam fails. Every link is verified
by cosine in double precision. Graphs are files of the shared folder and pairs are rows of names,
so little is shuffled. Tasks return link counts per vector, spanning stars of their links and what
their audits measured; the components are united across tasks (``components``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components, star_edges
from .runtime import materialize, scratch
from .vectors import load, save, shards

SHARD_ROWS = 32768
SLICE_ROWS = 8192
LINKS = 16
BEAM_BUILD = 40
BEAM = 16
MARGIN = 0.1
AUDITED = 32
PLANTED = 16
RECALL = 0.99
STEP = 1024
SALTS = 16


class Graph:
    """Layered graph over unit vectors; rows are inserted upper layers first, in batches."""

    def __init__(self, unit: np.ndarray, links: int = LINKS, beam: int = BEAM_BUILD, seed: int = 7):
        n = len(unit)
        self.x = unit.astype(np.float32)
        draw = np.random.default_rng(seed).random(n)
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(links)).astype(int), 4)
        self.order = np.lexsort((np.arange(n), -level))
        self.x = self.x[self.order]
        level = level[self.order]
        self.layers: list[np.ndarray] = []
        # Rows of layer l are the first size[l]; the top layer is never empty.
        sizes = [int((level >= l).sum()) for l in range(int(level.max(initial=0)), -1, -1)]
        for size in sizes:
            width = 2 * links
            table = np.full((size, width), -1, np.int32)
            done = min(size, 256)
            self._join(table, np.arange(done), self._exact(np.arange(done), np.arange(done), beam), links)
            while done < size:
                batch = np.arange(done, min(size, done + max(256, min(STEP, done))))
                found = self._beam(table, self.x[batch], self._descend(self.x[batch], done), beam, done)[0]
                near = self._exact(batch, batch, beam // 2)
                self._join(table, batch, np.concatenate([found, near], axis=1), links)
                done = int(batch[-1]) + 1
            self.layers.append(table)

    def _exact(self, rows: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
        sim = self.x[rows] @ self.x[among].T
        sim[rows[:, None] == among[None, :]] = -np.inf
        k = min(k, len(among))
        top = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        out = among[top]
        out[np.take_along_axis(sim, top, 1) == -np.inf] = -1
        return out

    def _select(self, rows: np.ndarray, candidates: np.ndarray, keep: int) -> np.ndarray:
        """Up to ``keep`` diverse neighbours of each row, then its nearest others in the space left."""
        candidates = np.where(candidates == rows[:, None], -1, candidates)
        candidates = np.sort(candidates, axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        vectors = self.x[np.maximum(candidates, 0)]
        sim = np.matmul(vectors, self.x[rows][:, :, None])[:, :, 0]
        sim[candidates < 0] = -np.inf
        rank = np.argsort(-sim, axis=1, kind="stable")[:, : 3 * keep]
        candidates, sim = np.take_along_axis(candidates, rank, 1), np.take_along_axis(sim, rank, 1)
        vectors = np.take_along_axis(vectors, rank[:, :, None], 1)
        mutual = np.matmul(vectors, vectors.transpose(0, 2, 1))
        chosen = np.zeros(candidates.shape, bool)
        closest = np.full(candidates.shape, -np.inf, np.float32)
        for c in range(candidates.shape[1]):
            take = (candidates[:, c] >= 0) & (sim[:, c] > closest[:, c]) & (chosen.sum(axis=1) < (3 * keep) // 4)
            chosen[:, c] = take
            closest = np.where(take[:, None], np.maximum(closest, mutual[:, c]), closest)
        score = np.where(candidates < 0, -np.inf, sim + 4 * chosen)
        best = np.argsort(-score, axis=1, kind="stable")[:, :keep]
        return np.where(np.take_along_axis(score, best, 1) == -np.inf, -1, np.take_along_axis(candidates, best, 1)).astype(np.int32)

    def _join(self, table: np.ndarray, rows: np.ndarray, candidates: np.ndarray, links: int) -> None:
        picked = self._select(rows, candidates, links)
        table[rows, : picked.shape[1]] = picked
        src = np.repeat(rows, picked.shape[1])[picked.ravel() >= 0]
        dst = picked.ravel()[picked.ravel() >= 0]
        if not len(dst):
            return
        by = np.lexsort((-np.einsum("ij,ij->i", self.x[src], self.x[dst]), dst))
        src, dst = src[by], dst[by]
        nodes, first, of = np.unique(dst, return_index=True, return_inverse=True)
        place = np.arange(len(dst)) - first[of]
        room = place < 2 * table.shape[1]
        extra = np.full((len(nodes), int(place[room].max()) + 1), -1, np.int32)
        extra[of[room], place[room]] = src[room]
        wide = np.concatenate([table[nodes], extra], axis=1)
        for at in range(0, len(nodes), STEP):
            part = slice(at, at + STEP)
            new = self._select(nodes[part], wide[part], table.shape[1])
            table[nodes[part], : new.shape[1]] = new
            table[nodes[part], new.shape[1] :] = -1

    def _descend(self, q: np.ndarray, limit: int) -> np.ndarray:
        """Entry rows for a layer of which ``limit`` rows exist: greedy through the layers above."""
        at = np.zeros(len(q), np.int32)
        for table in self.layers:
            at = self._beam(table, q, at, 1, min(limit, len(table)))[0][:, 0]
        return at

    def _beam(self, table: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, similarities) of each query's ``width`` best reached, -1 where fewer."""
        n = len(q)
        width = min(width, limit)
        seen = np.zeros((n, limit), bool)
        ids = np.full((n, width), -1, np.int32)
        sim = np.full((n, width), -np.inf, np.float32)
        opened = np.zeros((n, width), bool)
        ids[:, 0], sim[:, 0] = entry, np.einsum("ij,ij->i", q, self.x[entry])
        seen[np.arange(n), entry] = True
        live = np.arange(n)
        while len(live):
            waiting = np.where(opened[live] | (ids[live] < 0), -np.inf, sim[live])
            pick = waiting.argmax(axis=1)
            go = waiting[np.arange(len(live)), pick] > -np.inf
            live, pick = live[go], pick[go]
            if not len(live):
                break
            opened[live, pick] = True
            near = table[ids[live, pick]]
            fresh = (near >= 0) & (near < limit)
            safe = np.where(fresh, near, 0)
            fresh &= ~seen[live[:, None], safe]
            seen[np.broadcast_to(live[:, None], near.shape)[fresh], near[fresh]] = True
            got = np.matmul(self.x[safe], q[live][:, :, None])[:, :, 0]
            got[~fresh] = -np.inf
            all_sim = np.concatenate([sim[live], got], axis=1)
            all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
            all_open = np.concatenate([opened[live], np.zeros(near.shape, bool)], axis=1)
            top = np.argpartition(-all_sim, width - 1, axis=1)[:, :width]
            ids[live], sim[live], opened[live] = (np.take_along_axis(x, top, 1) for x in (all_ids, all_sim, all_open))
        return ids, sim

    def neighbours(self, q: np.ndarray, least: float, width: int, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) candidates with similarity of about ``least`` or more; rows in the caller's order."""
        us, vs = [], []
        base, part = self.layers[-1], q.astype(np.float32)
        at = np.zeros(len(part), np.int32)
        for table in self.layers[:-1]:
            at = self._beam(table, part, at, 1, len(table))[0][:, 0]
        ids, sim = self._beam(base, part, at, width, len(base))
        for i in np.nonzero(sim.max(axis=1) >= least - margin)[0].tolist():
            front = ids[i][sim[i] >= least - margin]
            seen = np.zeros(len(base), bool)
            seen[ids[i][ids[i] >= 0]] = True
            rows = [front]
            while len(front):
                near = np.unique(base[front])
                near = near[near >= 0]
                near = near[~seen[near]]
                seen[near] = True
                front = near[self.x[near] @ part[i] >= least - margin]
                rows.append(front)
            found = np.concatenate(rows)
            found = found[self.x[found] @ part[i] >= least - 1e-4]
            us.append(np.full(len(found), i))
            vs.append(self.order[found])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *us]), np.concatenate([none, *vs])


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; scaled by their largest component first."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def audit_rows(queries: np.ndarray, rows: np.ndarray, least: float) -> np.ndarray:
    """Some of the queries, and near copies planted at some of the rows, about halfway to the threshold."""
    own = queries[np.unique(np.linspace(0, len(queries) - 1, AUDITED).astype(int))]
    near = rows[np.unique(np.linspace(0, len(rows) - 1, PLANTED).astype(int))]
    side = np.random.default_rng(len(rows)).normal(size=near.shape)
    side -= (side * near).sum(axis=1, keepdims=True) * near
    length = np.sqrt((side * side).sum(axis=1, keepdims=True))
    turn = np.arccos(min(1.0, max(-1.0, least))) / 2
    return np.concatenate([own, np.where(length > 1e-9, np.cos(turn) * near + np.sin(turn) * side / np.maximum(length, 1e-9), near)])


def tune(queries: np.ndarray, graph: Graph, rows: np.ndarray, least: float) -> tuple[int, float, float, int]:
    """(beam, margin, mean recall of the audited queries, their number); beam 0 asks for brute force."""
    sample = audit_rows(queries, rows, least)
    truth = sample @ rows.T >= least
    some = truth.any(axis=1)
    width, margin = BEAM, MARGIN
    while True:
        got = np.zeros(truth.shape, bool)
        u, v = graph.neighbours(sample, least, width, margin)
        got[u, v] = True
        recall = float(((got & truth).sum(axis=1)[some] / truth.sum(axis=1)[some]).mean()) if some.any() else 1.0
        if recall >= RECALL:
            return width, margin, recall, int(some.sum())
        if width >= len(rows):
            return 0, margin, 1.0, int(some.sum())
        width, margin = 2 * width, margin + 0.05


def links_of(queries: np.ndarray, graph: Graph, rows: np.ndarray, least: float, width: int, margin: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified (query, row) links, some queries at a time."""
    step = STEP if width else max(1, (1 << 24) // len(rows))
    for at in range(0, len(queries), step):
        part = queries[at : at + step]
        u, v = graph.neighbours(part, least, width, margin) if width else np.nonzero(part @ rows.T >= least)
        near = np.concatenate([np.zeros(0, bool), *(np.einsum("ij,ij->i", part[u[a : a + 65536]], rows[v[a : a + 65536]]) >= least for a in range(0, len(u), 65536))])
        yield u[near] + at, v[near]


def _task(pairs: DataFrame, least: float) -> DataFrame:
    """kind 0: (vector, weight linked); kind 1: (member, root) of the task's links; kind 2: (millionths of recall, audited)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, held = ("", ""), ({}, {})
        for batch in batches:
            for left, right, low in zip(*(batch.column(i).to_pylist() for i in range(3))):
                held = tuple(x if n == m else load(m) for n, m, x in zip(names, (left, right), held))
                names = (left, right)
                q, s = held
                own, n = left == right, len(s["ids"])
                unit, weight = q["unit"][low : low + SLICE_ROWS], q["weight"][low : low + SLICE_ROWS]
                qids = q["ids"][low : low + SLICE_ROWS]
                width, margin, recall, audited = tune(unit, s["graph"], s["unit"], least)
                ours, theirs = np.zeros(len(unit)), np.zeros(n)
                member, root = np.arange(0), np.arange(0)
                for u, v in links_of(unit, s["graph"], s["unit"], least, width, margin):
                    if own:  # the other end queries this graph as well
                        u, v = u[u + low != v], v[u + low != v]
                    else:
                        theirs += np.bincount(v, weight[u], n)
                    ours += np.bincount(u, s["weight"][v], len(unit))
                    a, b = (u + low, v) if own else (u + n, v)
                    member, root = star_edges(n + len(unit), np.concatenate([member, a]), np.concatenate([root, b]))
                both = s["ids"] if own else np.concatenate([s["ids"], qids])
                ids = np.concatenate([qids, s["ids"]])
                linked = np.concatenate([ours, theirs]).astype(np.int64)
                some = np.nonzero(linked)[0]
                kinds = np.repeat([0, 1, 2], [len(some), len(member), 1])
                columns = [pa.array(kinds, pa.int32()), pa.array(np.concatenate([ids[some], both[member], [round(recall * 1e6)]])), pa.array(np.concatenate([linked[some], both[root], [audited]]))]
                yield pa.RecordBatch.from_arrays(columns, ["kind", "a", "b"])

    return pairs.select("left", "right", "low").mapInArrow(run, "kind int, a bigint, b bigint")


def slice_pairs(graphs: DataFrame) -> DataFrame:
    """(left, right, low): every two shards of one dimension once, the left one in slices; rows of names."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    a = graphs.select(F.col("path").alias("left"), "dim", "n", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int").alias("salt"))
    b = graphs.select(F.col("path").alias("right"), "dim", salts.alias("salt"))
    met = a.join(b, ["dim", "salt"]).where("left <= right")
    return met.select("left", "right", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(SLICE_ROWS))).alias("low"))


def near_duplicates(table: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id_col, n_links, component_id, kept, recall) of every row of ``table``.

    n_links counts the other rows at cosine >= ``least``, copies included; component_id is the
    smallest id reachable; recall is the mean over all audited queries of the whole run. Vectors
    that are null, empty, zero or hold null or non-finite components have no links and are their
    own component, as have rows with a null id (component null, kept). Vectors of different length
    don't meet. Repeated ids count as one vector each.
    """
    v = F.col(vector_col).cast("array<double>")
    sound = v.isNotNull() & F.col(id_col).isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.when(sound, F.transform(v, lambda x: x + 0.0)).alias("v"))
    # Equal vectors share a key of 128 bits; later joins carry the key, not the vector.
    rows = rows.withColumns({"h": F.when(F.col("v").isNotNull(), F.xxhash64("v")), "g": F.xxhash64(F.lit("g"), "v")})
    groups = materialize(rows.where("v is not null").groupBy("h", "g").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v")), "vectors")
    spread = groups.repartition(max(1, -(-groups.count() // shard_rows)))
    weighted = spread.select("id", F.concat(F.array(F.col("weight").cast("double")), "v").alias("v"))
    folder = scratch(table.sparkSession, "graphs")

    def build(ids: np.ndarray, matrix: np.ndarray) -> tuple:
        unit = unit_rows(matrix[:, 1:])
        return save(folder, {"ids": ids, "weight": matrix[:, 0], "unit": unit, "graph": Graph(unit)}), [], 0.0

    pairs = materialize(slice_pairs(materialize(shards(weighted, shard_rows, build), "graphs")), "pairs")
    tasks = max(1, min(pairs.count(), 20_000))
    found = materialize(_task(pairs.repartitionByRange(tasks, "right", "left", "low").sortWithinPartitions("right", "left", "low"), least), "found")
    audit = found.where("kind = 2").agg(F.sum(F.col("a") * F.col("b")).alias("r"), F.sum("b").alias("n")).first()
    recall = audit["r"] / audit["n"] / 1e6 if audit["n"] else 1.0
    counts = found.where("kind = 0").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("linked"))
    parts = connected_components(found.where("kind = 1").select("a", "b")).select(F.col("node").alias("id"), "component")
    known = groups.select("id", "h", "g", "weight").join(counts, "id", "left").join(parts, "id", "left")
    known = materialize(known.select("h", "g", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component")), "known")
    kind = table.schema[id_col].dataType
    out = rows.select("id", "h", "g").join(known, ["h", "g"], "left").select(F.col("id").cast(kind).alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True))).withColumn("recall", F.lit(recall))


def op9_hnsw(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("recall")


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT vec_id AS n, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.n),
c AS (SELECT n, min(c) AS c FROM r GROUP BY n),
k AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, c.c AS component_id, e.vec_id = c.c AS kept FROM embeddings e JOIN c ON e.vec_id = c.n LEFT JOIN k ON e.vec_id = k.a
"""
