"""SentencePiece encoding and decoding; giant documents by a max-plus scan over chunks.

Encoding runs over the normalized text (blanks become U+2581, one is put in front). Byte pair
encoding has a lattice form: a sequence of pieces is the encoding of its text exactly if each
adjacent pair is the encoding of its own text. So edges of the lattice carry the score of the
next piece where the pair is compatible and minus infinity where it isn't. The vocabulary is a
byte-pair model, so of all segmentations only one has a finite score: the scan finds the library's
own result, which a plain best-sum search over piece scores would not.

A giant document is cut every ``CHUNK_CHARS`` characters, whatever stands there. The states of a
boundary are the pieces that cover the character before it, and a chunk becomes a matrix of best
scores from every state at its left boundary to every state at its right one. Matrices are combined by
the associative (max, +) product; the scan gives each chunk the states it is entered and left
by, and the chunks are then backtraced through their own lattices, independently of each other.

Between two characters that stand side by side in no piece of the vocabulary (a blank and what is
before it, letters and most marks) all paths of the lattice meet in one state, a *hard* place. The
lattice between two such places, a word, is searched once per distinct word and worker; its
best score and path are kept in a bounded table. Documents of one chunk have no boundary states,
and the library encodes their words.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import materialize
from .token_counts import vocabulary

CHUNK_CHARS = 8192
GIANT_CHARS = 4 * CHUNK_CHARS
MAX_WORDS = 80_000
MAX_PATHS = 150_000
MAX_PAIRS = 250_000
LONG_WORD = 64
NO_PIECE = -1
START = -2
BLANK = "▁"
MODEL = "piece_bpe_32k.model"
NEVER = -np.inf
#: A character that is in no piece but a byte one, so that nothing merges with it.
GUARD = "\n"


class Pieces:
    """Vocabulary, word table and lattice of one model file."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.max_words = max_words
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.ids: dict[str, int] = {}
        self.bytes: list[bytes] = []
        for i in range(self.sp.get_piece_size()):
            piece = self.sp.id_to_piece(i)
            if self.sp.is_byte(i):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.sp.is_control(i) or self.sp.is_unknown(i):
                self.bytes.append(b"" if self.sp.is_control(i) else " ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.bytes.append(piece.replace(BLANK, " ").encode())
        self.longest = max(map(len, self.ids))
        #: Id of a piece, or NO_PIECE for what only begins one.
        self.begins = {p[:n]: NO_PIECE for p in self.ids for n in range(1, len(p))} | self.ids
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.joined_codes = np.sort(pair_codes("".join(self.joined))[::2]) if self.joined else np.zeros(1, np.int64)
        self.scores = [float(self.sp.get_score(i)) for i in range(len(self.bytes))]
        self.blank = self.ids.get(BLANK)
        self.paths: dict[str, tuple[float, bytes]] = {}
        self.pairs: dict[int, bool] = {}
        self.whole: dict[str, bool] = {}
        self.skip = len(self.sp.encode(GUARD))

    # Words

    def encode_words(self, keys: list[str]) -> list[bytes]:
        """Ids (uint32 bytes) of words, each given without its first blank."""
        table = self.words
        new = {k for k in keys if k not in table}
        if new:
            if len(table) + len(new) > self.max_words:
                self.older, self.words = table, {}
                table, new = self.words, set(keys)
            fresh = []
            for k in new:
                got = self.older.get(k)
                if got is not None:
                    table[k] = got
                else:
                    fresh.append(k)
            for k, ids in zip(fresh, self.sp.encode(fresh, num_threads=1)):
                table[k] = array("I", ids if k else [self.blank]).tobytes()
        return [table[k] for k in keys]

    def encode(self, text: str | None) -> bytes:
        """All ids of a text as little-endian uint32 bytes; null and empty texts have none."""
        return b"".join(self.encode_words(word_keys(text))) if text else b""

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids of a whole document; the blank put in front is taken off."""
        table = self.bytes
        text = b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text.removeprefix(" ")

    # Lattice

    def hard(self, normal: str, at: int) -> bool:
        """Whether all paths meet before the character at ``at``."""
        return at in (0, len(normal)) or normal[at - 1 : at + 1] not in self.joined

    def hard_places(self, normal: str, begin: int, end: int) -> list[int]:
        """Hard places between ``begin`` and ``end``, both left out."""
        codes = pair_codes(normal[begin:end])
        at = np.searchsorted(self.joined_codes, codes)
        there = self.joined_codes[np.minimum(at, len(self.joined_codes) - 1)] == codes
        return (np.nonzero(~there)[0] + begin + 1).tolist()

    def stable(self, piece: str) -> bool:
        """Whether ``piece`` can stand in an encoding; characters outside the vocabulary always do."""
        got = self.whole.get(piece)
        if got is None:
            got = len(piece) == 1 or self._alone(piece) == [self.ids[piece]]
            self.whole[piece] = got
        return got

    def _alone(self, normal: str) -> list[int]:
        return self.sp.encode(GUARD + normal.replace(BLANK, " "))[self.skip :]

    def compatible(self, a: str, b: str) -> bool:
        return self._fits(self.ids.get(a, NO_PIECE), self.ids.get(b, NO_PIECE), a, b)

    def _fits(self, i: int, j: int, a: str, b: str) -> bool:
        """Whether piece ``j`` (text ``b``) may follow piece ``i``; characters outside the vocabulary merge with nothing."""
        if j == NO_PIECE:
            return True
        if i < 0:
            return self.stable(b)
        key = i << 20 | j
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            got = self.pairs[key] = self._alone(a + b) == [i, j]
        return got

    def piece_ids(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        return [i] if i is not None else self._alone(piece)

    def score(self, piece: str) -> float:
        i = self.ids.get(piece)
        return self.scores[i] if i is not None else 0.0

    def starting(self, normal: str, at: int, end: int) -> list[int]:
        """Ends of all pieces of ``normal`` that start at ``at``, none beyond ``end``."""
        out = [at + 1] if at < end else []
        for e in range(at + 2, min(at + self.longest, end) + 1):
            found = self.begins.get(normal[at:e])
            if found is None:
                break
            if found != NO_PIECE and self.stable(normal[at:e]):
                out.append(e)
        return out

    def word_path(self, word: str) -> tuple[float, bytes]:
        """Score and ids of the best path through the lattice of one normalized word, from its first place to its last."""
        got = self.paths.get(word)
        if got is not None:
            return got
        # Nodes by the place they end at: (score, node before, piece's id, its text).
        n, begins, pairs, scores, fits = len(word), self.begins, self.pairs, self.scores, self._fits
        ending: list[list[tuple] | None] = [None] * (n + 1)
        ending[0] = [(0.0, None, START, "")]
        for at in range(n):
            before = ending[at]
            if before is None:
                continue
            for e in range(at + 1, min(at + self.longest, n) + 1):
                piece = word[at:e]
                j = begins.get(piece)
                if j is None or j == NO_PIECE:
                    if e > at + 1:
                        if j is None:
                            break
                        continue
                    j = NO_PIECE
                best = None
                for node in before:
                    ok = pairs.get(node[2] << 20 | j) if node[2] >= 0 <= j else None
                    if ok is None:
                        ok = fits(node[2], j, node[3], piece)
                    if ok and (best is None or node[0] > best[0]):
                        best = node
                if best is not None:
                    new = (best[0] + scores[j] if j >= 0 else best[0], best, j, piece)
                    if ending[e] is None:
                        ending[e] = [new]
                    else:
                        ending[e].append(new)
        node = max(ending[n], key=lambda node: node[0])
        score, ids = node[0], []
        while node[1] is not None:
            ids.append([node[2]] if node[2] >= 0 else self._alone(node[3]))
            node = node[1]
        got = score, array("I", [i for part in reversed(ids) for i in part]).tobytes()
        if len(self.paths) > MAX_PATHS:
            self.paths.clear()
        if n <= LONG_WORD:
            self.paths[word] = got
        return got


@lru_cache(maxsize=2)
def shared_pieces(path: str) -> Pieces:
    """This process's tables of a model file: a Python worker keeps them from task to task."""
    return Pieces(path)


def word_keys(text: str) -> list[str]:
    """Words of the text behind its added blank, each without its first blank."""
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [w[1:] for w in re.findall(r" +[^ ]+| +\Z", " " + text)]


def pair_codes(text: str) -> np.ndarray:
    """One number for each two adjacent characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return codes[:-1] << 21 | codes[1:]


def cuts_of(normal: str, chunk: int) -> list[int]:
    """Boundaries ``chunk`` characters apart."""
    return [*range(0, len(normal), chunk), len(normal)]


def states_at(pieces: Pieces, normal: str, at: int) -> list[tuple[int, int]]:
    """(start, end) of every piece that may cover the character before a boundary."""
    if pieces.hard(normal, at):
        return [(at, at)]
    low = max(0, at - pieces.longest)
    low = max((i for i in range(low, at) if pieces.hard(normal, i)), default=low)
    high = next((i for i in range(at + 1, min(len(normal), at + pieces.longest) + 1) if pieces.hard(normal, i)), len(normal))
    return [(s, e) for s in range(low, at) for e in pieces.starting(normal, s, high) if e >= at]


class Chunk:
    """The lattice between two boundaries of a text, entered by the states of the left one."""

    def __init__(self, pieces: Pieces, normal: str, begin: int, end: int, entries: list[tuple[int, int]] | None = None):
        self.pieces, self.normal, self.begin, self.end = pieces, normal, begin, end
        self.entries = states_at(pieces, normal, begin) if entries is None else entries
        self.exits = states_at(pieces, normal, end)
        self.inner = pieces.hard_places(normal, begin, end)
        #: First and last hard place of the chunk, its ends included.
        places = [begin] * pieces.hard(normal, begin) + self.inner + [end] * pieces.hard(normal, end)
        self.first, self.last = (places[0], places[-1]) if places else (None, None)

    def _walk(self, begin: int, sources: list[tuple[int, int]], end: int, limit: int):
        """Best scores from each source to each lattice node that starts in the span; back pointers.

        ``begin`` hard: one source that is followed by any piece. Nodes are (start, end).
        """
        n = len(sources)
        best: dict[tuple[int, int], np.ndarray] = {}
        back: dict[tuple[int, int], list] = {}
        ending: dict[int, list[tuple[int, int]]] = {}
        for k, s in enumerate(sources):
            vec = np.full(n, NEVER)
            vec[k] = 0.0
            best[s] = vec
            ending.setdefault(s[1], []).append(s)
        text, pieces = self.normal, self.pieces
        for at in range(begin, end):
            before = ending.pop(at, None)
            if not before:
                continue
            for e in pieces.starting(text, at, limit):
                piece = text[at:e]
                vec, origin = np.full(n, NEVER), np.full(n, -1)
                used = []
                for p in before:
                    if p[0] == p[1] or pieces.compatible(text[p[0] : p[1]], piece):
                        better = best[p] > vec
                        vec = np.where(better, best[p], vec)
                        origin = np.where(better, len(used), origin)
                        used.append(p)
                if used and vec.max() > NEVER:
                    best[at, e] = vec + pieces.score(piece)
                    back[at, e] = [used[o] if o >= 0 else None for o in origin]
                    ending.setdefault(e, []).append((at, e))
        return best, back

    def _limit(self, at: int) -> int:
        return next((i for i in range(at, min(len(self.normal), at + self.pieces.longest) + 1) if self.pieces.hard(self.normal, i)), len(self.normal))

    def matrix(self) -> np.ndarray:
        """(entries, exits) best scores over the chunk."""
        if self.first is None:
            return self._part(self.begin, self.entries, self.end, self.exits)
        left = np.zeros((1, 1)) if self.pieces.hard(self.normal, self.begin) else self._part(self.begin, self.entries, self.first, [(self.first, self.first)])
        right = np.zeros((1, 1)) if self.pieces.hard(self.normal, self.end) else self._part(self.last, [(self.last, self.last)], self.end, self.exits)
        return max_plus(left + sum(self.pieces.word_path(w)[0] for w in self._words()), right)

    def _words(self) -> list[str]:
        """Normalized words between the first and the last hard place."""
        marks = [self.first, *(i for i in self.inner if i > self.first)]
        if self.last > marks[-1]:
            marks.append(self.last)
        return [self.normal[a:b] for a, b in zip(marks, marks[1:])]

    def _part(self, begin: int, sources: list, end: int, exits: list) -> np.ndarray:
        limit = self._limit(end)
        best, _ = self._walk(begin, sources, end, limit)
        out = np.full((len(sources), len(exits)), NEVER)
        for j, x in enumerate(exits):
            if x[0] == x[1]:  # hard: any node that ends here
                rows = [v for k, v in best.items() if k[1] == x[0]]
                if rows:
                    out[:, j] = np.max(rows, axis=0)
            elif x in best:
                out[:, j] = best[x]
        return out

    def inside(self) -> bytes:
        """Ids between the first and the last hard place, which all paths share."""
        return b"" if self.first is None else b"".join(self.pieces.word_path(w)[1] for w in self._words())

    def rest(self) -> tuple[str, int, int]:
        """(text, begin, end) of the chunk with a guard for what ``inside`` covers: all that the boundary states decide on."""
        if self.first is None:
            return self.normal, self.begin, self.end
        return self.normal[: self.first] + GUARD + self.normal[self.last :], self.begin, self.end - (self.last - self.first) + 1

    def backtrace(self, entry: tuple[int, int], leave: tuple[int, int], inside: bytes | None = None) -> bytes:
        """Ids of the pieces after ``entry`` up to and with ``leave``; ``inside`` is known where this is the ``rest``."""
        if entry == leave:
            return inside or b""
        if self.first is None:
            return self._path(self.begin, entry, self.end, leave)
        out = [] if self.pieces.hard(self.normal, self.begin) else [self._path(self.begin, entry, self.first, (self.first, self.first))]
        out.append(self.inside() if inside is None else inside)
        if not self.pieces.hard(self.normal, self.end):
            out.append(self._path(self.last, (self.last, self.last), self.end, leave))
        return b"".join(out)

    def _path(self, begin: int, source: tuple[int, int], end: int, leave: tuple[int, int]) -> bytes:
        if source == leave:
            return b""
        best, back = self._walk(begin, [source], end, self._limit(end))
        if leave[0] == leave[1]:
            leave = max((k for k in best if k[1] == leave[0] and k[0] < k[1]), key=lambda k: best[k][0])
        path = []
        while leave != source:
            path.append(leave)
            leave = back[leave][0]
        ids = [i for s, e in reversed(path) for i in self.pieces.piece_ids(self.normal[s:e])]
        return array("I", ids).tobytes()


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def scan(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """Inclusive (max, +) products of all prefixes, by the associative halving scheme."""
    if len(matrices) <= 1:
        return matrices
    pairs = [max_plus(a, b) for a, b in zip(matrices[::2], matrices[1::2])]
    done = scan(pairs)
    out = [matrices[0]]
    for i in range(1, len(matrices)):
        out.append(done[i // 2] if i % 2 else max_plus(done[i // 2 - 1], matrices[i]))
    return out


def best_states(matrices: list[np.ndarray]) -> list[int]:
    """State at every boundary of the best path from the first boundary's only state."""
    prefix = scan(matrices)
    state = int(np.argmax(prefix[-1][0]))
    out = [state]
    for k in range(len(matrices) - 1, -1, -1):
        ahead = prefix[k - 1][0] if k else np.zeros(1)
        state = int(np.argmax(ahead + matrices[k][:, state]))
        out.append(state)
    return out[::-1]


def normalized(text: str) -> str:
    return BLANK + text.replace(" ", BLANK)


def encode_by_scan(pieces: Pieces, text: str, chunk: int) -> bytes:
    """The whole scan in one process, as the distributed form does it."""
    normal = normalized(text)
    cuts = cuts_of(normal, chunk)
    chunks = [Chunk(pieces, normal, a, b) for a, b in zip(cuts, cuts[1:])]
    states = best_states([c.matrix() for c in chunks])
    return b"".join(c.backtrace(c.entries[s], c.exits[e]) for c, s, e in zip(chunks, states, states[1:]))


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, chunk: int = CHUNK_CHARS, giant: int = GIANT_CHARS) -> DataFrame:
    """(id_col, text, ids BINARY of little-endian uint32) of every row; null and empty texts have no ids.

    U+2581 in a text is encoded as a blank, as by the library, and decoded as one. Documents of up to ``giant`` characters are one chunk. Larger ones are cut in chunks that all
    tasks share; only matrices and state numbers of a document meet in one task. Ids of a document
    are joined in chunk order. Repeated rows are encoded each.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    large = F.coalesce(F.length("text") > giant, F.lit(False))

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared_pieces(path or vocabulary(MODEL))
        pieces.paths, pieces.pairs = {}, {}  # of giants only
        for batch in (b.slice(at, 1000) for b in batches for at in range(0, b.num_rows, 1000)):
            ids = [pieces.encode(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], [id_col, "text", "ids"])

    near = rows.where(~large).mapInArrow(small, f"`{id_col}` {kind}, text string, ids binary")
    far = _encode_giants(rows.where(large), id_col, kind, path, chunk)
    return near.unionByName(far)


def _encode_giants(rows: DataFrame, id_col: str, kind: str, path: str | None, chunk: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin = 2 * shared_pieces(path or vocabulary(MODEL)).longest + 2
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(2)):
                normal = normalized(text.as_py())
                cuts = cuts_of(normal, chunk)
                for k in range(len(cuts) - 1):
                    low = max(0, cuts[k] - margin)
                    part = normal[low : cuts[k + 1] + margin]
                    columns = [[key], [k], [part], [cuts[k] - low], [cuts[k + 1] - low], [low == 0], [low + len(part) == len(normal)]]
                    kinds = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["row", "k", "part", "a", "b", "head", "tail"])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared_pieces(path or vocabulary(MODEL))
        pieces.words, pieces.older = {}, {}
        for batch in (b.slice(at, 100) for b in batches for at in range(0, b.num_rows, 100)):
            chunks = [_chunk(pieces, *x) for x in zip(*(batch.column(i).to_pylist() for i in range(2, 7)))]
            out = [c.matrix() for c in chunks]
            rest = [c.rest() for c in chunks]
            columns = [pa.array([m.shape[0] for m in out], pa.int32()), pa.array([m.ravel().tolist() for m in out], pa.list_(pa.float64()))]
            columns += [pa.array([r[i] for r in rest], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
            columns.append(pa.array([c.inside() for c in chunks], pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["row", "k", "n", "m", "rest", "a", "b", "inside"])

    def choose(table: pa.Table) -> pa.Table:
        table = table.sort_by("k")
        states = best_states([np.array(m).reshape(n, -1) for n, m in zip(table["n"].to_pylist(), table["m"].to_pylist())])
        return pa.table({"row": table["row"], "k": table["k"], "s": pa.array(states[:-1], pa.int32()), "e": pa.array(states[1:], pa.int32())})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared_pieces(path or vocabulary(MODEL))
        for batch in batches:
            out = []
            for rest, a, b, inside, s, e in zip(*(batch.column(i).to_pylist() for i in range(2, 8))):
                c = Chunk(pieces, rest, a, b)
                out.append(c.backtrace(c.entries[s], c.exits[e], inside))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["row", "k", "ids"])

    keyed = materialize(rows.select(F.monotonically_increasing_id().alias("row"), id_col, "text"), "giants")
    spread = max(1, keyed.sparkSession.sparkContext.defaultParallelism)
    parts = keyed.select("row", id_col, "text").mapInArrow(cut, "row bigint, k int, part string, a bigint, b bigint, head boolean, tail boolean")
    parts = materialize(parts.repartition(spread * 4, "row", "k"), "chunks")
    solved = materialize(parts.mapInArrow(matrices, "row bigint, k int, n int, m array<double>, rest string, a bigint, b bigint, inside binary"), "matrices")
    states = materialize(solved.select("row", "k", "n", "m").groupBy("row").applyInArrow(choose, "row bigint, k int, s int, e int"), "states")
    traced = solved.drop("n", "m").join(states, ["row", "k"]).select("row", "k", "rest", "a", "b", "inside", "s", "e").mapInArrow(trace, "row bigint, k int, ids binary")
    ids = traced.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("k", F.hex("ids").alias("h")))).alias("c"))  # one document's chunks
    ids = ids.select("row", F.unhex(F.concat_ws("", "c.h")).alias("ids"))
    return keyed.join(ids, "row").select(id_col, "text", "ids")


def _chunk(pieces: Pieces, part: str, a: int, b: int, head: bool, tail: bool) -> Chunk:
    """Chunk of a document part: outside the document's ends, a neutral character keeps ends soft."""
    left, right = "" if head else GUARD, "" if tail else GUARD
    return Chunk(pieces, left + part + right, a + len(left), b + len(left))


def describe(encoded: DataFrame, id_col: str, path: str | None = None) -> DataFrame:
    """(id_col, n_pieces, ids_crc32, round_trip): the ids decoded again must give the text."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared_pieces(path or vocabulary(MODEL))
        for batch in batches:
            n, crc, same = [], [], []
            for text, ids in zip(batch.column(1), batch.column(2)):
                data = ids.as_buffer() or b""
                n.append(len(data) // 4)
                crc.append(zlib.crc32(data))
                same.append(pieces.decode(np.frombuffer(data, "<u4")) == (text.as_py() or ""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same)], [id_col, "n_pieces", "ids_crc32", "round_trip"])

    return encoded.select(id_col, "text", "ids").mapInArrow(run, f"`{id_col}` {kind}, n_pieces bigint, ids_crc32 bigint, round_trip boolean")


def op4_piece_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return describe(encode(docs), "doc_id")
