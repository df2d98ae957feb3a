"""Canonical length-limited Huffman files of token ids, decoded in independent blocks.

Code lengths (at most ``MAX_BITS``) come from the counts of all ids by package-merge; codes are
canonical, so a file needs only the lengths. A block holds the ids of whole consecutive documents
(a document above ``BLOCK_IDS`` has a block of its own) and can be decoded alone: its header has the
length table, every ``STRIDE`` ids a checkpoint of the bit offset, and per document id, global
start and count. Decoding is table driven: one 2^MAX_BITS table gives id and length of the next
code, and all strides of a block advance together as lanes of one vector.

Block layout, little-endian: magic ``THB1``, uint32 documents, uint64 ids, uint32 distinct ids,
uint32 checkpoints, uint64 payload bytes, then int64 document ids (``NO_ID`` for null), int64
starts, int64 counts, uint32 symbols, uint8 lengths, uint64 bit offsets, payload.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .runtime import materialize, open_shared, scratch
from .token_counts import vocabulary
from .word_tokens import shared_tokenizer

MAX_BITS = 16
STRIDE = 512
BLOCK_IDS = 1 << 20
MAGIC = b"THB1"
HEAD = struct.Struct("<4sIQIIQ")
END_ID = 1
READ_BLOCKS = 4
MAX_READ_TASKS = 20_000
NO_ID = -(1 << 63)


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths <= ``max_bits`` for positive counts (package-merge); one symbol gets 1 bit.

    Each level keeps, per item, how many of the cheapest original symbols it contains; the chosen
    items of a level are a prefix, so only their number is tracked on the way back.
    """
    n = len(counts)
    if n > 1 << max_bits:
        raise ValueError("more symbols than codes")
    if n <= 1:
        return np.ones(n, np.uint8)
    order = np.argsort(counts, kind="stable")
    leaf = counts[order].astype(np.float64)
    levels, items = [], leaf
    is_leaf = np.ones(n, bool)
    for _ in range(max_bits - 1):
        levels.append(is_leaf)
        half = len(items) // 2
        packed = items[: 2 * half].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaf, packed])
        rank = np.argsort(merged, kind="stable")
        items, is_leaf = merged[rank], rank < n
    levels.append(is_leaf)
    lengths, take = np.zeros(n, np.int64), 2 * (n - 1)
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out = np.zeros(n, np.uint8)
    out[order] = lengths
    return out


def canonical(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Canonical codes in the order of (length, symbol)."""
    order = np.lexsort((symbols, lengths))
    sizes = lengths[order].astype(np.int64)
    step = np.concatenate([[0], np.cumsum(np.int64(1) << (MAX_BITS - sizes))[:-1]]) if len(order) else np.zeros(0, np.int64)
    codes = np.zeros(len(order), np.int64)
    codes[order] = step >> (MAX_BITS - sizes)
    return codes


def pack(ids: np.ndarray, code_of: np.ndarray, bits_of: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bit string of ``ids`` and the bit offset of every ``STRIDE``-th id."""
    bits = bits_of[ids].astype(np.int64)
    ends = np.cumsum(bits)
    begin = ends - bits
    total = int(ends[-1]) if len(ends) else 0
    spread = code_of[ids] << (24 - (begin & 7) - bits)
    at = begin >> 3
    size = (total >> 3) + 3
    out = np.zeros(size, np.float64)
    for k, shift in enumerate((16, 8, 0)):
        out += np.bincount(at + k, (spread >> shift) & 255, size)[:size]
    return out.astype(np.uint8)[: (total + 7) >> 3].tobytes(), begin[::STRIDE]


def write_block(doc_ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """One self-contained block; ``lengths`` maps every id to its code length (0: never occurs)."""
    symbols = np.nonzero(lengths)[0]
    code_of = np.zeros(len(lengths), np.int64)
    code_of[symbols] = canonical(symbols, lengths[symbols])
    payload, offsets = pack(ids, code_of, lengths)
    head = HEAD.pack(MAGIC, len(doc_ids), len(ids), len(symbols), len(offsets), len(payload))
    parts = (doc_ids.astype("<i8"), starts.astype("<i8"), counts.astype("<i8"), symbols.astype("<u4"), lengths[symbols].astype("u1"), offsets.astype("<u8"))
    return head + b"".join(p.tobytes() for p in parts) + payload


@lru_cache(maxsize=2)
def decoding_table(symbols: bytes, lengths: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Id and bits of the code that begins each window of ``MAX_BITS`` bits; one for all blocks of a file."""
    symbols, lengths = np.frombuffer(symbols, "<u4"), np.frombuffer(lengths, "u1")
    order = np.lexsort((symbols, lengths))
    table = np.repeat(order, np.int64(1) << (MAX_BITS - lengths[order].astype(np.int64)))
    table = np.concatenate([table, np.zeros((1 << MAX_BITS) - len(table), table.dtype)])
    if not len(symbols):
        return np.zeros(1 << MAX_BITS, np.uint32), np.zeros(1 << MAX_BITS, np.int64)
    return symbols[table], lengths[table].astype(np.int64)


def read_block(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, starts, counts, ids) of a block."""
    magic, n_docs, n_ids, n_symbols, n_offsets, n_payload = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a block")
    at = HEAD.size
    got = []
    for kind, n in (("<i8", n_docs), ("<i8", n_docs), ("<i8", n_docs), ("<u4", n_symbols), ("u1", n_symbols), ("<u8", n_offsets)):
        got.append(np.frombuffer(data, kind, n, at))
        at += got[-1].nbytes
    doc_ids, starts, counts, symbols, lengths, offsets = got
    payload = np.frombuffer(data[at : at + n_payload] + bytes(4), np.uint8).astype(np.uint32)
    next_id, next_bits = decoding_table(symbols.tobytes(), lengths.tobytes())
    window = payload[:-3] << 16 | payload[1:-2] << 8 | payload[2:-1]
    ids = np.zeros(n_offsets * STRIDE, np.uint32)
    lanes, bit = np.arange(n_offsets) * STRIDE, offsets.astype(np.int64)
    for k in range(STRIDE):
        if n_offsets and lanes[-1] + k >= n_ids:  # only the last lane can be short
            lanes, bit = lanes[:-1], bit[:-1]
            n_offsets -= 1
        if not n_offsets:
            break
        code = (window[bit >> 3] >> (8 - (bit & 7))) & 0xFFFF
        ids[lanes + k] = next_id[code]
        bit = bit + next_bits[code]
    return doc_ids, starts, counts, ids[:n_ids]


def encode_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int | None = END_ID) -> DataFrame:
    """(part, doc_id, before, n, ids): ids of every text in ascending ``id_col`` order.

    Ids are integers. Rows are dealt by range of the id; ``part`` is the range's number, ``before``
    the ids of the part's earlier rows. Null texts are empty; rows with a null id come first, and
    rows that repeat an id stand next to each other in any order. The last row of a part has
    ``n`` of -1 and the part's counts in ``ids``: pairs of id and count as int64.
    """
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must hold integers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, before, part = shared_tokenizer(path or vocabulary()), 0, TaskContext.get().partitionId()
        end, kind = b"" if end_id is None else end_id.to_bytes(4, "little"), pa.int64()
        total, held, waiting = np.zeros(0, np.int64), [], 0
        for batch in batches:
            kind = batch.column(0).type
            rows, size = ([], [], [], []), 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(encoder.encode(text.as_py()) + end, "<u4")
                held.append(ids)
                waiting += len(ids)
                if waiting > 1 << 18:
                    total, held, waiting = _added(total, held), [], 0
                small = ids.astype("<u2").tobytes() if not len(ids) or ids.max() < 1 << 16 else b"\0" + ids.tobytes()
                for column, value in zip(rows, (doc, before, len(ids), small)):
                    column.append(value)
                before += len(ids)
                size += len(small)
                if size > 1 << 24:
                    yield _ids_batch(part, rows, kind)
                    rows, size = ([], [], [], []), 0
            yield _ids_batch(part, rows, kind)
        total = _added(total, held)
        used = np.nonzero(total)[0]
        yield _ids_batch(part, ([None], [before], [-1], [np.stack([used, total[used]], axis=1).astype("<i8").tobytes()]), kind)

    ranged = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ranged.mapInArrow(run, f"part int, doc_id {docs.schema[id_col].dataType.simpleString()}, before bigint, n bigint, ids binary")


def _added(total: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    """Counts by id with those of ``parts`` added."""
    more = np.bincount(np.concatenate([np.zeros(0, np.uint32), *parts]), minlength=len(total))
    more[: len(total)] += total
    return more


def _ids_batch(part: int, rows: tuple[list, list, list, list], kind: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array([part] * len(rows[0]), pa.int32()), pa.array(rows[0], kind), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "before", "n", "ids"])


def _unpack(ids: bytes, n: int) -> np.ndarray:
    """uint16 ids, or a zero byte and uint32 ids."""
    return np.frombuffer(ids, "<u2") if len(ids) == 2 * n else np.frombuffer(ids, "<u4", offset=1)


def id_counts(encoded: DataFrame) -> DataFrame:
    """(id, n) over all parts, from the counts that each part has in its last row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for counts in batch.column(0):
                table = np.frombuffer(counts.as_buffer(), "<i8").reshape(-1, 2)
                if len(table) and table[-1, 0] >= len(total):
                    total = np.concatenate([total, np.zeros(int(table[-1, 0]) + 1 - len(total), np.int64)])
                total[table[:, 0]] += table[:, 1]
        used = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    few = max(1, encoded.sparkSession.sparkContext.defaultParallelism)  # parts are many and their counts short
    return encoded.where("n < 0").select("ids").coalesce(few).mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(encoded: DataFrame, folder: str) -> DataFrame:
    """Write all rows of ``encode_ids`` as blocks below ``folder``; (file, at, size) of every block.

    The counts collected to build the code are one row per id of the vocabulary. A file's name holds
    the task attempt, so a lost attempt leaves a file that no returned row names.
    """
    counts = id_counts(encoded).orderBy("id").collect()
    lengths = np.zeros(1 + max((r["id"] for r in counts), default=0), np.uint8)
    if counts:
        lengths[[r["id"] for r in counts]] = code_lengths(np.array([r["n"] for r in counts], np.int64))
    parts = encoded.where("n < 0").select("part", F.col("before").alias("total"))
    encoded = encoded.where("n >= 0")
    ahead = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", ahead.alias("ahead"))  # one row per range partition
    rows = encoded.join(F.broadcast(parts), "part").select("doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = f"{folder}/ids-{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}.thb"
        index: list[tuple[int, int]] = []
        held: list[tuple] = []
        size = at = 0
        file = None

        def flush():
            nonlocal at, file, held, size
            if held:
                file = file or open_shared(name, "wb")
                docs, starts, ns, ids = zip(*held)
                block = write_block(np.array(docs, np.int64), np.array(starts, np.int64), np.array(ns, np.int64), np.concatenate(ids), lengths)
                file.write(block)
                index.append((at, len(block)))
                at += len(block)
            held, size = [], 0

        for batch in batches:
            for doc, start, n, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if size + n > BLOCK_IDS or (held and held[-1][1] + held[-1][2] != start):
                    flush()
                held.append((NO_ID if doc is None else doc, start, n, _unpack(ids, n)))
                size += n
        flush()
        if file:
            file.close()
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(index), pa.string()), pa.array([a for a, _ in index], pa.int64()), pa.array([b for _, b in index], pa.int64())], ["file", "at", "size"])

    return materialize(rows.mapInArrow(run, "file string, at bigint, size bigint"), "id-blocks")


def read_files(blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) decoded from the listed blocks, any block by any task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, at, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with open_shared(name, "rb") as file:
                    file.seek(at)
                    docs, starts, counts, ids = read_block(file.read(size))
                ids, ends = ids.astype("<u4"), np.cumsum(counts)
                crc = [zlib.crc32(ids[e - n : e]) for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(docs, mask=docs == NO_ID), pa.array(starts), pa.array(counts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # A number, so that small rows aren't coalesced.
    spread = blocks.repartition(max(1, min(-(-blocks.count() // READ_BLOCKS), MAX_READ_TASKS)), "file", "at")
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op3_huffman_ids(spark, sf_dir: str) -> DataFrame:
    encoded = materialize(encode_ids(spark.read.parquet(f"{sf_dir}/documents.parquet")), "ids")
    return read_files(write_files(encoded, scratch(spark, "huffman")))
