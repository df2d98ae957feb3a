"""Language identification by prediction by partial matching (PPM).

One variable-order byte context tree per language (orders ``MAX_ORDER`` down to 0, then uniform)
is counted on a bounded sample of labelled rows and frozen. A text's code length under a language
is the exact PPM code length under those frozen counts: in a context seen T times with D distinct
followers, a follower seen c times costs log2((T + D) / c) bits and the escape log2((T + D) / D);
after an escape the followers of the longer context are excluded from the shorter one. Since the
followers of a context also follow all its suffixes, the exclusion of a chain of escapes depends
only on the last context left, so it folds into one escape cost per context:

    E(ctx) = log2((T + D) / D) - log2((T' + D') / (T' + D' - X))

where the suffix context has T', D', and X of its occurrences are of followers of ctx. Below order
0 a byte costs log2(256 - D). Contexts start afresh (zero bytes) at each text.

Every (context, byte) pair seen in any language is stored with its cost under every language, so
scoring needs one hash probe per byte for nearly all bytes; the rest walk down the orders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ORDER = 4
#: Bound of the training sample: labelled rows per language, and bytes of a row that is used.
ROWS_PER_LANG = 400
ROW_BYTES = 1 << 16
CHUNK = 1 << 18
UNDETERMINED = "und"
#: A text that costs more bits a byte than this in every language is in none of them.
REJECT_BITS = 7.0

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Open-addressing hash table from non-negative int64 keys to row numbers."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.key = np.full(1 << self.bits, -1, np.int64)
        self.row = np.zeros(1 << self.bits, np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(left):
            free = self.key[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            take = np.nonzero(free)[0][first]
            self.key[slot[take]], self.row[slot[take]] = keys[left[take]], left[take]
            stay = np.ones(len(left), bool)
            stay[take] = False
            left, slot = left[stay], (slot[stay] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where there is none."""
        slot = self._slot(keys)
        there = self.key[slot]
        out = np.where(there == keys, self.row[slot], np.int32(-1))
        todo = np.nonzero((there != keys) & (there >= 0))[0]
        while len(todo):
            slot_t = (slot[todo] + 1) & ((1 << self.bits) - 1)
            slot[todo] = slot_t
            there = self.key[slot_t]
            hit = there == keys[todo]
            out[todo[hit]] = self.row[slot_t[hit]]
            todo = todo[~hit & (there >= 0)]
        return out


def _padded(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts behind ``order`` zero bytes each, and the mask of their own bytes."""
    pad = bytes(order)
    data = np.frombuffer(b"".join(x for t in texts for x in (pad, t)), np.uint8)
    own = np.ones(len(data), bool)
    starts = np.cumsum([0, *[len(t) + order for t in texts[:-1]]]) if texts else np.zeros(0, int)
    for k in range(order):
        own[starts + k] = False
    return data, own


def _keys(data: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """order | context bytes | byte for the positions ``at``."""
    key = np.zeros(len(at), np.int64)
    for back in range(order, -1, -1):
        key <<= 8
        key |= data[at - back]
    return key | np.int64(order) << 40


class Model:
    """Frozen context trees of several languages."""

    def __init__(self, samples: dict[str, list[bytes]], order: int = MAX_ORDER):
        self.langs, self.order = sorted(samples), order
        count = {}
        for lang in self.langs:
            data, own = _padded(samples[lang], order)
            at = np.nonzero(own)[0]
            count[lang] = [np.unique(_keys(data, at, k), return_counts=True) for k in range(order + 1)]
        n_langs = len(self.langs)
        joint = [np.unique(np.concatenate([count[x][k][0] for x in self.langs] or [np.zeros(0, np.int64)])) for k in range(order + 1)]
        contexts = [np.unique(j >> 8) for j in joint]
        self.base = np.full(n_langs, 8.0)
        cost, escape = [], []
        for k in range(order + 1):
            bits = np.zeros((len(joint[k]), n_langs))
            esc = np.zeros((len(contexts[k]), n_langs))
            for col, lang in enumerate(self.langs):
                keys, n = count[lang][k]
                ctx, first, of = np.unique(keys >> 8, return_index=True, return_inverse=True)
                if not len(ctx):
                    continue
                total, distinct = np.add.reduceat(n, first), np.bincount(of)
                rows = np.searchsorted(joint[k], keys)
                escaped = np.log2((total + distinct) / distinct)
                if k:
                    lower, m = count[lang][k - 1]
                    low_ctx, low_first = np.unique(lower >> 8, return_index=True)
                    low_total, low_distinct = np.add.reduceat(m, low_first), np.diff(np.append(low_first, len(lower)))
                    excluded = np.bincount(of, m[np.searchsorted(lower, _suffix(keys, k))])
                    up = np.searchsorted(low_ctx, _suffix(ctx << 8, k) >> 8)
                    whole = low_total[up] + low_distinct[up]
                    escaped -= np.log2(whole / (whole - excluded))
                else:
                    self.base[col] = np.log2(max(1, 256 - distinct[0])) + escaped[0]
                esc[np.searchsorted(contexts[k], ctx), col] = escaped
                bits[rows, col] = np.log2((total + distinct)[of] / n)
                missing = np.ones(len(joint[k]), bool)
                missing[rows] = False
                if k == 0:
                    bits[missing, col] = self.base[col]
                else:
                    miss = np.nonzero(missing)[0]
                    at = np.searchsorted(contexts[k], joint[k][miss] >> 8)
                    bits[miss, col] = esc[at, col] + cost[k - 1][np.searchsorted(joint[k - 1], _suffix(joint[k][miss], k)), col]
            cost.append(bits)
            escape.append(esc)
        self.keys, self.cost = np.concatenate(joint), np.concatenate(cost).astype(np.float32)
        self.contexts, self.escape = np.concatenate(contexts), np.concatenate(escape).astype(np.float32)
        self.tables: tuple[Table, Table] | None = None

    def __getstate__(self):
        return {**self.__dict__, "tables": None}

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages) code lengths in bits; memory is bounded by ``CHUNK`` bytes of text."""
        out = np.zeros((len(texts), len(self.langs)))
        piece: list[bytes] = []
        where: list[tuple[int, bytes]] = []
        size = 0
        for i, t in enumerate(texts):
            for a in range(0, len(t), CHUNK):
                where.append((i, t[max(0, a - self.order) : a].rjust(self.order, b"\0")))
                piece.append(t[a : a + CHUNK])
                size += len(piece[-1])
                if size >= CHUNK:
                    self._add(out, piece, where)
                    piece, where, size = [], [], 0
        if piece:
            self._add(out, piece, where)
        return out

    def _add(self, out: np.ndarray, piece: list[bytes], where: list[tuple[int, bytes]]) -> None:
        if self.tables is None:
            self.tables = Table(self.keys), Table(self.contexts)
        k = self.order
        data = np.frombuffer(b"".join(x for (_, before), t in zip(where, piece) for x in (before, t)), np.uint8)
        ends = np.cumsum([len(t) + k for t in piece])
        own = np.ones(len(data), bool)
        begins = ends - [len(t) + k for t in piece]
        for j in range(k):
            own[begins + j] = False
        at = np.nonzero(own)[0]
        key = _keys(data, at, k)
        row = self.tables[0].find(key)
        cost = self.cost[np.maximum(row, 0)] if len(self.cost) else np.zeros((len(at), len(self.langs)), np.float32)
        left = np.nonzero(row < 0)[0]
        cost[left] = 0
        key = key[left]
        while len(left):
            ctx = self.tables[1].find(key >> 8)
            seen = ctx >= 0
            cost[left[seen]] += self.escape[ctx[seen]]
            if k == 0:
                cost[left] += (self.base - (self.escape[0] if len(self.escape) else 0)).astype(np.float32)
                break
            key, k = _suffix(key, k), k - 1
            row = self.tables[0].find(key)
            hit = row >= 0
            cost[left[hit]] += self.cost[row[hit]]
            left, key = left[~hit], key[~hit]
        lengths = [len(t) for t in piece]
        totals = np.add.reduceat(cost, np.cumsum([0, *lengths[:-1]]), axis=0, dtype=np.float64)
        np.add.at(out, [i for i, _ in where], totals)


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    """Keys of ``order`` with the oldest context byte dropped."""
    return (keys & ((np.int64(1) << (8 * order)) - 1)) | np.int64(order - 1) << 40


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows_per_lang: int = ROWS_PER_LANG, row_bytes: int = ROW_BYTES) -> Model:
    """Fit on about ``rows_per_lang`` rows of each language, chosen by a hash of the id.

    Only rows with text of 1 to ``row_bytes`` bytes and a label take part. The sample's size does
    not depend on the input's, and all languages get the same share.
    """
    usable = labelled.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.octet_length(text_col).between(1, row_bytes))
    counts = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}
    if not counts:
        return Model({})
    share = F.element_at(F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, rows_per_lang / n))]), F.col(lang_col))
    uniform = F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("ppm")), F.lit(1 << 30)) / float(1 << 30)
    rows = usable.where(uniform < share).select(F.col(lang_col).alias("lang"), F.col(text_col).cast("binary").alias("text"), F.xxhash64(F.col(id_col).cast("string")).alias("h")).collect()
    samples: dict[str, list[bytes]] = {}
    for lang, text, _ in sorted(rows, key=lambda r: (r["lang"], r["h"], bytes(r["text"]))):
        samples.setdefault(str(lang), []).append(bytes(text))
    return Model(samples)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score, bits_per_byte) of every row, whole texts.

    A null text or one without a letter is ``und`` with score 0, as is every text if the model has
    no language. score is the posterior 2^-bits / sum under equal priors (ties: the first name in
    order). bits_per_byte is the code length under the predicted language, null where ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = shared.value
        names = np.array([*frozen.langs, UNDETERMINED], object)
        for batch in batches:
            texts = [x.as_py() or b"" for x in batch.column(1)]
            known = np.array([bool(x.as_py()) for x in batch.column(2)]) & bool(frozen.langs)
            pick, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            rate = np.full(len(texts), np.nan)
            if frozen.langs and len(texts):
                rows = np.nonzero(known)[0]
                bits = frozen.bits([texts[i] for i in rows])
                best = bits.argmin(axis=1)
                low = bits[np.arange(len(rows)), best]
                pick[rows], score[rows] = best, 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(axis=1)
                rate[rows] = low / np.array([len(texts[i]) for i in rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[pick], pa.string()), pa.array(score), pa.array(rate, mask=~known)], [id_col, "lang_pred", "score", "bits_per_byte"])

    kind = docs.schema[id_col].dataType.simpleString()
    letters = F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(id_col, F.col(text_col).cast("binary").alias("_t"), letters.alias("_l"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double, bits_per_byte double")


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def train_on(docs: DataFrame) -> Model:
    return fit(docs.where(~held_out()))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs.select("doc_id", "text"), train_on(docs))
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def keep_identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those in no known language: ``und``, or above ``REJECT_BITS`` in all."""
    found = identify(docs, model, id_col, text_col)
    rejected = found.where((F.col("lang_pred") == UNDETERMINED) | (F.col("bits_per_byte") > REJECT_BITS)).select(F.col(id_col).alias("_rejected"))
    return docs.join(rejected, docs[id_col] == rejected["_rejected"], "left_anti")
