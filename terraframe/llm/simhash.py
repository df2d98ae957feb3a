"""SimHash near-duplicates with bit-sliced distance evaluation.

A text is lower-cased in A-Z, cut into words ``[^\\x20\\x09-\\x0D]+`` and 3-word shingles (repeats
count; a shorter text is one shingle), each hashed by XXH64 with seed 42. A fingerprint bit is 1
if it is set in more than half of the hashes. Null, empty and white-space texts have fingerprint
0 and take part like any other. Fingerprints at Hamming distance <= ``radius`` (2) are linked.

Candidates are exact: cut into ``radius + 2`` parts, two fingerprints within the radius agree on
at least two whole parts, so bucketing by every pair of parts loses nothing. Buckets work on
distinct fingerprints (copies never multiply) and a bucket above ``BLOCK`` rows is dealt out as
pairs of sub-blocks, so no task holds an unbounded bucket.

In a task, differences are kept as vertical bit planes (one machine word holds one bit of 64
pairs). Two carry-save counter planes and a sticky overflow plane are updated plane by plane, and
a block of pairs is abandoned as soon as every lane has overflowed the radius. Each block emits
spanning stars of its links, never all of them.

The pipeline's stage (``keep_distinct``) is wider than that contract: two texts are near copies if
the sets of their 5-word shingles have Jaccard similarity >= 0.8. Candidates agree on one of
``BANDS`` bands of ``ROWS`` minima (a pair at 0.8 is missed with probability 0.0004, above it less
often); a bit-sliced distance of the sets' SimHashes up to ``WIDE_RADIUS`` and exact set arithmetic
decide. At 0.8 the mean distance is 10 of 64 bits, so no radius that exact buckets can serve covers it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components, star_edges
from .runtime import materialize

BLOCK = 512
LANES = 4096
SLICE = 1 << 16
SEED = 42
WIDTH = 5
BANDS, ROWS = 20, 5
WIDE_RADIUS = 24
MULTIPLIERS = np.random.default_rng(SEED).integers(1, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """64-bit SimHash of UTF-8 bytes, unsigned."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    width = min(width, len(words))
    total, ones = len(words) - width + 1, np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, SLICE):
        end = min(total, at + SLICE)
        if width == 3:
            hashes = [digest(b"%b %b %b" % x, SEED) for x in zip(words[at:end], words[at + 1 : end + 1], words[at + 2 : end + 2])]
        else:
            hashes = [digest(b" ".join(words[i : i + width]), SEED) for i in range(at, end)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp BIGINT): the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            values = np.fromiter((fingerprint(x.as_py()) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, fp bigint")


def planes(diff: np.ndarray) -> np.ndarray:
    """Transpose (lanes,) uint64 to (64, words) uint64: row p holds bit p of every lane."""
    pad = -len(diff) % 64
    if pad:
        diff = np.concatenate([diff, np.full(pad, ~np.uint64(0))])
    bits = np.unpackbits(diff.view(np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Boolean mask of lanes whose Hamming distance is at most ``radius``."""
    if radius > 3:
        return _within_wide(left, right, radius)
    out = np.zeros(len(left), bool)
    full = ~np.uint64(0)
    for at in range(0, len(left), LANES):
        rows = planes(left[at : at + LANES] ^ right[at : at + LANES])
        one = np.zeros(rows.shape[1], np.uint64)
        two, over = one.copy(), one.copy()
        for p in range(64):
            carry = one & rows[p]
            one ^= rows[p]
            over |= two & carry
            two ^= carry
            if radius < 3 and p % 8 == 7:
                exceeded = over | (two & one if radius == 2 else two if radius == 1 else two | one)
                if (exceeded == full).all():
                    break
        exceeded = over if radius == 3 else over | (two & one if radius == 2 else two if radius == 1 else two | one)
        lanes = np.unpackbits(exceeded.view(np.uint8), bitorder="little")[: min(LANES, len(left) - at)]
        out[at : at + LANES] = lanes == 0
    return out


def _within_wide(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """``within`` with as many counter planes as the radius needs."""
    out = np.zeros(len(left), bool)
    full = ~np.uint64(0)
    for at in range(0, len(left), LANES):
        rows = planes(left[at : at + LANES] ^ right[at : at + LANES])
        count = [np.zeros(rows.shape[1], np.uint64) for _ in range(radius.bit_length())]
        over = np.zeros(rows.shape[1], np.uint64)
        for p in range(64):
            carry = rows[p]
            for plane in count:
                up = plane & carry
                plane ^= carry
                carry = up
            over |= carry
            if p % 8 == 7:
                exceeded, equal = over.copy(), np.full(rows.shape[1], full)
                for i in range(len(count) - 1, -1, -1):
                    if radius >> i & 1:
                        equal &= count[i]
                    else:
                        exceeded |= equal & count[i]
                        equal &= ~count[i]
                if (exceeded == full).all():
                    break
        lanes = np.unpackbits(exceeded.view(np.uint8), bitorder="little")[: min(LANES, len(left) - at)]
        out[at : at + LANES] = lanes == 0
    return out


def _block_links(key: np.ndarray, side: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning stars of the links inside runs of equal ``key`` (sorted); sides 0/1 meet only across."""
    n, us, vs, shift = len(key), [], [], 1
    code = fp.view(np.uint64)
    lane = np.arange(n - 1)
    while len(lane):
        lane = lane[lane + shift < n]
        lane = lane[key[lane] == key[lane + shift]]
        a, b = lane, lane + shift
        meet = (side[a] < 0) | (side[a] != side[b])
        a, b = a[meet], b[meet]
        near = within(code[a], code[b], radius)
        us.append(a[near])
        vs.append(b[near])
        shift += 1
    if not us:
        return fp[:0], fp[:0]
    u, v = star_edges(n, np.concatenate(us), np.concatenate(vs))
    return fp[u], fp[v]


def bucket_keys(fp: Column, radius: int) -> Column:
    """Array of (table, part values) keys; two codes within ``radius`` share at least one."""
    parts = radius + 2
    cut = [64 * i // parts for i in range(parts + 1)]
    piece = [F.shiftrightunsigned(fp, cut[i]).bitwiseAND(F.lit((1 << (cut[i + 1] - cut[i])) - 1)) for i in range(parts)]
    return F.array(*[F.struct(F.lit(t).alias("t"), piece[i].alias("x"), piece[j].alias("y")) for t, (i, j) in enumerate(combinations(range(parts), 2))])


def fingerprint_links(codes: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """(a, b) links that connect exactly the distinct ``fp`` values within ``radius`` (<= 3)."""
    rows = codes.select("fp", F.explode(bucket_keys(F.col("fp"), radius)).alias("k")).select("fp", "k.t", "k.x", "k.y")
    rows = materialize(rows, "buckets")
    sizes = materialize(rows.groupBy("t", "x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "sizes")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks.cast("bigint")).cast("int")
    dealt = (
        rows.join(sizes, ["t", "x", "y"])
        .select("fp", "t", "x", "y", mine.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        .select("fp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "t", "x", "y", "own")
        .select("fp", F.xxhash64("t", "x", "y", "i", "j").alias("key"), F.when(F.col("i") == F.col("j"), -1).when(F.col("own") == F.col("i"), 0).otherwise(1).alias("side"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)]
        for batch in batches:
            got = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 0)]
            rest = [np.concatenate(x) for x in zip(rest, got)]
            cut = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0
            if cut:
                u, v = _block_links(rest[0][:cut], rest[1][:cut], rest[2][:cut], radius)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["a", "b"])
                rest = [x[cut:] for x in rest]
        u, v = _block_links(*rest, radius)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["a", "b"])

    return dealt.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "a bigint, b bigint").distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """(id_col, fp, component): component is the smallest id reachable over links, itself included.

    Rows with a null id take no part in naming components. Repeated ids keep all their rows.
    """
    codes = materialize(fingerprints(docs, id_col, text_col), "codes")
    classes = materialize(codes.groupBy("fp").agg(F.min(id_col).alias("rep")), "classes")
    members = connected_components(fingerprint_links(classes.select("fp"), radius)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    linked = materialize(classes.join(members, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")), "linked")
    lowest = materialize(linked.groupBy("root").agg(F.min("rep").alias("component")), "lowest")
    named = materialize(linked.join(lowest, "root").select("fp", "component"), "named")
    return codes.join(named, "fp", "left").select(id_col, "fp", "component")


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = simhash_groups(docs)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """Rows of ``docs`` without those whose component has a smaller id; all columns are kept.

    Rows with a null id stay, as do all rows that share the smallest id.
    """
    extra = simhash_groups(docs, id_col, text_col, radius).where(F.col(id_col) != F.col("component")).select(F.col(id_col).alias("_extra"))
    return docs.join(extra, docs[id_col] == extra["_extra"], "left_anti")


def shingle_set(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct XXH64 hashes of the shingles; a shorter text is one, an empty text has none."""
    words = text.lower().split() if text else []
    width, digest = min(width, len(words)), xxhash.xxh64_intdigest
    if not words:
        return np.zeros(0, np.uint64)
    return np.unique(np.fromiter((digest(b" ".join(words[i : i + width]), SEED) for i in range(len(words) - width + 1)), np.uint64))


def set_code(items: np.ndarray) -> tuple[int, int]:
    """(name, SimHash) of a shingle set as signed longs; equal sets have equal names."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(items), SLICE):
        ones += np.unpackbits(items[at : at + SLICE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    fp = np.packbits(ones * 2 > len(items), bitorder="little").view("<i8")[0]
    return int(np.uint64(xxhash.xxh64_intdigest(items.tobytes(), SEED)).astype(np.int64)), int(fp)


def band_keys(items: np.ndarray) -> np.ndarray:
    """Key of each band as a signed long: a hash of the band's minima over the set."""
    low = np.full(BANDS * ROWS, ~np.uint64(0))
    mixed = items ^ items >> np.uint64(29)
    for at in range(0, len(items), LANES):
        low = np.minimum(low, (mixed[at : at + LANES, None] * MULTIPLIERS[0]).min(axis=0))
    key = (low * MULTIPLIERS[1]).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)
    return ((key ^ key >> np.uint64(31)) * MULTIPLIERS[1][:BANDS]).view(np.int64)


def _set_links(key: np.ndarray, side: np.ndarray, band: np.ndarray, node: np.ndarray, fp: np.ndarray, keys: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, inside runs of equal ``key`` (sorted), all sets of Jaccard >= 0.8; sides 0/1 meet only across.

    A pair is compared in the first band it agrees on, and left out once its ends are connected.
    """
    n, us, vs, shift = len(key), [], [], 1
    code, size, lane = fp.view(np.uint64), np.array([len(x) for x in sets], np.int64), np.arange(max(0, n - 1))
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    while len(lane):
        lane = lane[lane + shift < n]
        lane = lane[key[lane] == key[lane + shift]]
        a, b = lane, lane + shift
        near = ((side[a] < 0) | (side[a] != side[b])) & (5 * np.minimum(size[a], size[b]) >= 4 * np.maximum(size[a], size[b]))
        a, b = a[near], b[near]
        first = ~((keys[a] == keys[b]) & (np.arange(BANDS) < band[a, None])).any(axis=1)
        a, b = a[first], b[first]
        near = within(code[a], code[b], WIDE_RADIUS)
        for i, j in zip(a[near].tolist(), b[near].tolist()):
            x, y = find(i), find(j)
            if x != y and 9 * len(np.intersect1d(sets[i], sets[j], assume_unique=True)) >= 4 * (len(sets[i]) + len(sets[j])):
                root[y] = x
                us.append(i)
                vs.append(j)
        shift += 1
    return node[us], node[vs]


def _named_sets(docs: DataFrame, id_col: str, text_col: str, whole: bool) -> DataFrame:
    """(id_col, node, fp, keys) of each row's shingle set and, if ``whole``, the set itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingle_set(x.as_py()) for x in part.column(1).cast(pa.binary())]
                codes = [set_code(x) for x in sets]
                keys = pa.array([band_keys(x).tobytes() for x in sets], pa.binary())
                out = [part.column(0), pa.array([c[0] for c in codes], pa.int64()), pa.array([c[1] for c in codes], pa.int64()), keys]
                names = [id_col, "node", "fp", "keys"]
                if whole:
                    out, names = [*out, pa.array([x.tobytes() for x in sets], pa.binary())], [*names, "items"]
                yield pa.RecordBatch.from_arrays(out, names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, f"`{id_col}` {kind}, node bigint, fp bigint, keys binary" + ", items binary" * whole)


def _exploded(classes: DataFrame) -> DataFrame:
    """(node, t, x): one row for each band of a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            node = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS)
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n)), pa.array(keys)], ["node", "t", "x"])

    return classes.select("node", "keys").mapInArrow(run, "node bigint, t int, x bigint")


def set_links(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, block: int = BLOCK) -> DataFrame:
    """(a, b) links that connect the classes whose shingle sets have Jaccard >= 0.8."""
    rows = materialize(_exploded(classes), "bands")
    sizes = rows.groupBy("t", "x").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("who")).where("n > 1")
    # Bands that gather the same nodes: the first is enough.
    sizes = materialize(sizes.groupBy("n", "who").agg(F.min(F.struct("t", "x")).alias("k")).select("k.t", "k.x", "n"), "sizes")
    members = materialize(rows.join(sizes, ["t", "x"]), "members")
    wanted = materialize(classes.join(members.select("node").distinct(), "node").select(F.col("rep").alias("_rep")).distinct(), "wanted")
    texts = docs.join(wanted, docs[id_col] == wanted["_rep"], "left_semi")
    sets = materialize(_named_sets(texts, id_col, text_col, True).drop(id_col).dropDuplicates(["node"]), "sets")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("node"), blocks.cast("bigint")).cast("int")
    dealt = (
        members.select("node", "t", "x", mine.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        .select("node", "t", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "x", "own")
        .select("node", "t", F.xxhash64("t", "x", "i", "j").alias("key"), F.when(F.col("i") == F.col("j"), -1).when(F.col("own") == F.col("i"), 0).otherwise(1).alias("side"))
        .join(sets, "node")
        .select("key", "side", "t", "node", "fp", "keys", "items")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, BANDS), np.int64)]
        sets: list[np.ndarray] = []
        for batch in batches:
            got = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            got.append(np.frombuffer(b"".join(batch.column(5).to_pylist()), np.int64).reshape(-1, BANDS))
            rest = [np.concatenate(x) for x in zip(rest, got)]
            sets += [np.frombuffer(x, np.uint64) for x in batch.column(6).to_pylist()]
            cut = int(np.searchsorted(rest[0], rest[0][-1])) if len(rest[0]) else 0
            if cut:
                u, v = _set_links(*[x[:cut] for x in rest], sets[:cut])
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["a", "b"])
                rest, sets = [x[cut:] for x in rest], sets[cut:]
        u, v = _set_links(*rest, sets)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["a", "b"])

    return dealt.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "a bigint, b bigint").distinct()


def shingle_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(id_col, component): smallest id reachable over texts whose 5-word shingles have Jaccard >= 0.8.

    Rows with a null id are left out. Null, empty and white-space texts are copies of each other.
    """
    docs = docs.where(F.col(id_col).isNotNull())
    codes = materialize(_named_sets(docs, id_col, text_col, False), "codes")
    classes = materialize(codes.groupBy("node").agg(F.min(id_col).alias("rep"), F.first("keys").alias("keys")), "classes")
    members = connected_components(set_links(docs, classes, id_col, text_col, block)).select("node", F.col("component").alias("root"))
    linked = materialize(classes.join(members, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root")), "linked")
    lowest = materialize(linked.groupBy("root").agg(F.min("rep").alias("component")), "lowest")
    named = materialize(linked.join(lowest, "root").select("node", "component"), "named")
    return codes.join(named, "node").select(id_col, "component")


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without those that ``shingle_groups`` links to a smaller id; all columns are kept.

    Rows with a null id stay, as do all rows that share the smallest id.
    """
    extra = shingle_groups(docs, id_col, text_col).where(F.col(id_col) != F.col("component")).select(F.col(id_col).alias("_extra")).distinct()
    return docs.join(extra, docs[id_col] == extra["_extra"], "left_anti")
