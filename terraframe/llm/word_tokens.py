"""Exact token ids and prefix token counts for the word-end BPE vocabulary.

The vocabulary's normalizer composes and lower-cases, and its pre-tokenizer cuts the text into pieces
(runs of letters, single digits, runs of other characters, English endings) and drops white space. So
a text's ids are the concatenation of the ids of its pieces, whatever their neighbours. Words between
blanks are looked up whole: each distinct word is cut into pieces, and each distinct piece merged by
the library's BPE model, once per worker; the table of known words and pieces is bounded by
``MAX_WORDS`` and only saves time.

Prefix dynamic programming, in three layers:

* over words: ``PrefixCounts`` holds the tokens before every word of the text (int64, one a word);
* inside the word that a cut falls into: the tokens before each of its pieces;
* inside a piece: a sequence of tokens is the BPE encoding of its text exactly if each adjacent pair
  is, so one last token closes the encoding of each prefix, and

      open[n] = open[n - len(t)] + 1    with t the token that ends at n and fits the one before it

  (``PieceTable``). A prefix that ends a word takes its last token among those with the word-end mark.

A cut then needs the piece it falls into and a table look-up, so any prefix, truncation or budget
question is answered without encoding the text again, and in time linear in the piece.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from bisect import bisect_left, bisect_right
from functools import lru_cache
from itertools import accumulate

import numpy as np
import regex

MAX_WORDS = 500_000
#: Longer words are not kept in the table, and prefixes of longer pieces are counted by ``PieceTable``.
LONG = 48
MAX_PAIRS = 1_000_000

# The pre-tokenizer's pattern in the vocabulary file, its special tokens and word-end mark.
# White space is spelled out as the library's engine has it.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\t-\r \x85\p{Z}\p{L}\p{N}]+"
SPECIALS = ("<|startoftext|>", "<|endoftext|>")
WORD_END = "</w>"
#: The same pattern in the classes of ``re``; right for characters that ``plain`` accepts.
PLAIN_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|[_\x1c-\x1f])+"
SPACES = re.compile(r"[\t-\r \x85\xa0  -     　]")


ASCII_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_alphabet() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, others follow from 256."""
    kept = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    spare = iter(range(256, 512))
    return {b: chr(b if b in kept else next(spare)) for b in range(256)}


def plain(c: str) -> bool:
    """Whether ``re`` and the library's engine put the character into the same class."""
    kind = unicodedata.category(c)
    if kind == "Cn":
        return False
    letter, digit, space = c.isalnum() and not c.isdecimal(), c.isdecimal(), c.isspace() and not "\x1c" <= c <= "\x1f"
    return (letter, digit, space) == (kind[0] == "L", kind[0] == "N", SPACES.match(c) is not None)


@lru_cache(maxsize=1)
def trailing() -> frozenset[str]:
    """Characters that may compose with, or be reordered against, what stands before them."""
    found = {chr(c) for c in [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]}
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if unicodedata.combining(chr(code)):
            found.add(chr(code))
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
    return frozenset(found)


class Known(dict):
    """Ids of normalized words and pieces as uint32 bytes; a missing one is computed, and kept if it is short."""

    def __init__(self, encoder: WordTokenizer):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, word: str) -> bytes:
        if word.isalpha():
            ids = self.encoder.piece(word)
        else:
            body = word.rstrip(ASCII_MARKS)
            if body.isalpha():
                ids = self[body] + self[word[len(body) :]]
            else:
                pieces = self.encoder.matcher(word).findall(word)
                ids = self.encoder.piece(word) if pieces == [word] else b"".join([self[p] for p in pieces])
        if len(word) <= LONG:
            self[word] = ids
        return ids


class WordTokenizer:
    """Encoder with a bounded word table around a ``tokenizers`` file; results equal the library's."""

    def __init__(self, path: str, max_words: int = MAX_WORDS):
        from tokenizers import Tokenizer

        self.path, self.max_words = path, max_words
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.alphabet, self.known = byte_alphabet(), Known(self)
        self.find, self.find_plain = regex.compile(PIECES), re.compile(PLAIN_PIECES)
        self.special = {s: array("I", [self.tokenizer.token_to_id(s)]).tobytes() for s in SPECIALS}
        self.cut = re.compile("(" + "|".join(map(re.escape, SPECIALS)) + ")")
        self.same: dict[str, bool] = {}
        self.fits: dict[str, bool] = {}

    def symbols(self, piece: str) -> str:
        """Piece in the byte-level alphabet."""
        return piece.encode().decode("latin-1").translate(self.alphabet)

    def piece(self, piece: str) -> bytes:
        """Ids of one piece, computed by the library's model."""
        symbols = piece if piece.isascii() and piece.isprintable() else self.symbols(piece)
        return array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()

    def _ours(self, c: str) -> bool:
        """Whether Python normalizes the character as the library does."""
        ok = self.same.get(c)
        if ok is None:
            ok = unicodedata.category(c) != "Cn" and (c.isspace() or self.normalizer.normalize_str(c) == _normal(c))
            self.same[c] = ok
        return ok

    def _plain(self, c: str) -> bool:
        ok = self.fits.get(c)
        if ok is None:
            ok = self.fits[c] = plain(c)
        return ok

    def normalize(self, text: str) -> str:
        """Composed and lower-cased text; white space is left, as it belongs to no piece."""
        if text.isascii():
            return text.lower()
        if all(map(self._ours, set(text))):
            return _normal(text)
        return self.normalizer.normalize_str(text)

    def matcher(self, normal: str):
        """The pattern that finds the pieces of a normalized text."""
        return self.find_plain if normal.isascii() or all(map(self._plain, set(normal))) else self.find

    def segments(self, text: str) -> list[str]:
        """Text between special tokens at even places, the special tokens at odd ones."""
        return self.cut.split(text) if "<|" in text else [text]

    def encode_words(self, text: str) -> list[bytes]:
        """Ids (little-endian uint32 bytes) of each word of a text without special tokens, as ``words_of`` cuts it."""
        if len(self.known) > self.max_words:
            self.known = Known(self)
        return list(map(self.known.__getitem__, words_of(self.normalize(text))))

    def encode(self, text: str | None) -> bytes:
        """All ids of ``text`` as little-endian uint32 bytes; null is empty."""
        if not text:
            return b""
        parts = [self.special[s] if k % 2 else b"".join(self.encode_words(s)) for k, s in enumerate(self.segments(text))]
        return b"".join(parts)

    def prefix_counts(self, text: str | None) -> PrefixCounts:
        return PrefixCounts(self, text or "")

    @property
    def merges(self) -> Merges:
        return merges_of(self.path)


def words_of(normal: str) -> list[str]:
    """Words that end at a blank, a newline or a tab."""
    return normal.replace("\n", " ").replace("\t", " ").split(" ")


def _normal(text: str) -> str:
    # A capital sigma is lowered alike at the end of a word, as characters are lowered one by one.
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


@lru_cache(maxsize=2)
def shared_tokenizer(path: str) -> WordTokenizer:
    """This process's encoder of a file: a Python worker keeps its word table from task to task."""
    return WordTokenizer(path)


class Merges:
    """The merges of a vocabulary file, and which tokens may follow each other."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.rank = {pair: i for i, pair in enumerate(pairs)}
        self.vocabulary = frozenset(model["vocab"])
        self.ends = frozenset(t[i:] for t in self.vocabulary for i in range(len(t)))
        self.longest = max(len(t.removesuffix(WORD_END)) for t in self.vocabulary)
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """Tokens of a short sequence: the pair of lowest rank is joined, leftmost first, until none is left."""
        parts, rank = list(symbols), self.rank
        while len(parts) > 1:
            best, at = min((rank.get(pair, len(rank)), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if best == len(rank):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def follows(self, before: str, token: str) -> bool:
        """Whether ``token`` may stand behind ``before`` (empty: at the start) in an encoding."""
        ok = self.pairs.get((before, token))
        if ok is None:
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            body = token.removesuffix(WORD_END)
            last = [body[-1] + WORD_END] if len(body) < len(token) else [body[-1]]
            ok = self.merged([*before, *body[:-1], *last]) == ([before, token] if before else [token])
            self.pairs[before, token] = ok
        return ok


@lru_cache(maxsize=2)
def merges_of(path: str) -> Merges:
    return Merges(path)


def agreement(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return low


class PieceTable:
    """Token counts of the prefixes of one piece, filled as far as they are asked for."""

    def __init__(self, merges: Merges, symbols: str):
        self.merges, self.symbols = merges, symbols
        #: Tokens of the first n symbols without a word end, and the length of the last of them.
        self.counts, self.last = array("q", [0]), array("q", [0])

    def _closing(self, symbols: str, n: int, counts: array, last: array, mark: str) -> int:
        """Length of the token that ends at ``n``."""
        m = self.merges
        for size in range(1, n + 1):
            token = symbols[n - size : n] + mark
            if token not in m.ends:
                break
            start = n - size
            if token in m.vocabulary and m.follows(symbols[start - last[start] : start], token):
                return size
        raise ValueError("no token ends here")

    def _extend(self, symbols: str, n: int, counts: array, last: array) -> None:
        for at in range(len(counts), n + 1):
            size = self._closing(symbols, at, counts, last, "")
            counts.append(counts[at - size] + 1)
            last.append(size)

    def open(self, n: int) -> int:
        """Tokens of the first ``n`` symbols if the word goes on; no longer prefix has fewer than the least of the last ones."""
        self._extend(self.symbols, n, self.counts, self.last)
        return self.counts[n]

    def closed(self, symbols: str) -> int:
        """Tokens of a piece that shares all but its end with this one."""
        shared = min(agreement(symbols, self.symbols), len(symbols) - 1)
        self._extend(self.symbols, shared, self.counts, self.last)
        counts, last = self.counts, self.last
        if shared < len(symbols) - 1:
            first = max(0, shared - self.merges.longest)  # all that a later token can look back to, twice over
            first = max(0, first - self.merges.longest)
            counts, last = counts[first : shared + 1], last[first : shared + 1]
            symbols = symbols[first:]
            self._extend(symbols, len(symbols) - 1, counts, last)
        size = self._closing(symbols, len(symbols), counts, last, WORD_END)
        return counts[len(symbols) - size] + 1

    def beyond(self, budget: int) -> int:
        """A number of symbols such that every longer prefix has more than ``budget`` tokens."""
        reach = self.merges.longest
        for n in range(len(self.symbols) + 1):
            if self.open(n) >= budget and min(self.counts[max(0, n - reach + 1) : n + 1]) >= budget:
                return n
        return len(self.symbols)


class Word:
    """Tokens before every piece of one word."""

    def __init__(self, encoder: WordTokenizer, text: str):
        self.encoder, self.text, self.normal = encoder, text, encoder.normalize(text)
        spans = [m.span() for m in encoder.matcher(self.normal).finditer(self.normal)]
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]
        self.before = [0, *accumulate(len(encoder.known[self.normal[a:b]]) >> 2 for a, b in spans)]
        self.tables: dict[tuple[int, int], PieceTable] = {}

    def _table(self, k: int, i: int = 0, piece: str = "") -> PieceTable:
        """Table of piece ``k``; for ``i`` > 0 of a piece that cutting made behind it."""
        if (k, i) not in self.tables:
            self.tables[k, i] = PieceTable(self.encoder.merges, self.encoder.symbols(piece if i or k < 0 else self.normal[self.starts[k] : self.ends[k]]))
        return self.tables[k, i]

    def _safe(self, cut: int) -> tuple[int, int]:
        """The last place up to ``cut`` before which characters are normalized alone, here and in the normalized word."""
        if self.text.isascii():
            return cut, cut
        if cut >= len(self.text):
            return cut, len(self.normal)
        loose = trailing()
        while cut and self.text[cut] in loose:
            cut -= 1
        return cut, len(self.encoder.normalize(self.text[:cut]))

    def count(self, cut: int) -> int:
        """Tokens of the first ``cut`` characters."""
        at, place = self._safe(cut)
        begun = self.encoder.normalize(self.text[at:cut])
        k = bisect_left(self.starts, place) - 1
        if k >= 0 and not begun and place >= self.ends[k]:
            return self.before[k + 1]
        if k > 0 and self.normal[self.starts[k] - 1] == "'":
            k -= 1  # letters that are cut may be an English ending with the quote before them
        tail = (self.normal[self.starts[k] : place] if k >= 0 else "") + begun
        done = self.before[k] if k >= 0 else 0
        for i, piece in enumerate(self.encoder.matcher(tail).findall(tail)):
            done += len(self.encoder.known[piece]) >> 2 if len(piece) <= LONG else self._table(k, i, piece).closed(self.encoder.symbols(piece))
        return done

    def _most(self, budget: int) -> int:
        """A place such that all prefixes that reach over it have more than ``budget`` (0 or more) tokens.

        A prefix that reaches into piece k + 1 has the tokens of all pieces before it, and one more,
        or one less where the end of piece k, a quote, and cut letters are an English ending.
        """
        k = bisect_left(self.before, budget + 1) - 1
        if k >= len(self.starts):
            return len(self.normal)
        if self.ends[k] - self.starts[k] > LONG and self.before[k + 1] > budget:
            reach = self._table(k).beyond(max(0, budget - self.before[k]))
            piece = self.normal[self.starts[k] : self.ends[k]]
            return self.starts[k] + max(2, len(piece.encode()[:reach].decode("utf-8", "ignore")))
        return self.starts[k + 1] if k + 1 < len(self.starts) else len(self.normal)

    def cut_for(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        most = self._most(budget)
        low, high = 0, len(self.text)
        while low < high:  # the last cut that agrees with the word no farther
            mid = (low + high + 1) // 2
            low, high = (mid, high) if agreement(self.encoder.normalize(self.text[:mid]), self.normal) <= most else (low, mid - 1)
        while low and self.count(low) > budget:
            low -= 1
        return low


class Segment:
    """Tokens before every word of a text without special tokens."""

    def __init__(self, encoder: WordTokenizer, text: str):
        self.encoder, self.text = encoder, text
        ids = encoder.encode_words(text) if text else []
        self.before = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) >> 2, out=self.before[1:])
        self.begin: np.ndarray | None = None
        self.inside: dict[int, Word] = {}

    @property
    def total(self) -> int:
        return int(self.before[-1])

    def _word(self, k: int) -> Word:
        if k not in self.inside:
            self.inside[k] = Word(self.encoder, self.text[int(self.begin[k]) : int(self.begin[k + 1]) - 1])
        return self.inside[k]

    def _place(self) -> None:
        if self.begin is None:
            words = words_of(self.text)
            self.begin = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=self.begin[1:])

    def count(self, cut: int) -> int:
        """Tokens of the first ``cut`` characters."""
        if cut <= 0 or cut >= len(self.text):
            return self.total if cut > 0 else 0
        self._place()
        k = int(np.searchsorted(self.begin, cut, "right")) - 1
        return int(self.before[k]) + self._word(k).count(cut - int(self.begin[k]))

    def cut_for(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if self.total <= budget:
            return len(self.text)
        self._place()
        k = int(np.searchsorted(self.before, budget, "right")) - 1  # the first word that does not fit whole
        return int(self.begin[k]) + self._word(k).cut_for(budget - int(self.before[k]))


class PrefixCounts:
    """Exact token counts of every prefix of one text."""

    def __init__(self, encoder: WordTokenizer, text: str):
        self.encoder, self.text = encoder, text
        self.parts = encoder.segments(text)
        self.segments = [Segment(encoder, s) if k % 2 == 0 else None for k, s in enumerate(self.parts)]
        tokens = [s.total if s else 1 for s in self.segments]
        self.begin = [0, *accumulate(map(len, self.parts))]
        self.before = [0, *accumulate(tokens)]

    @property
    def total(self) -> int:
        return self.before[-1]

    def count(self, cut: int) -> int:
        """Tokens of ``text[:cut]``."""
        cut = max(0, min(cut, len(self.text)))
        k = bisect_right(self.begin, cut) - 1
        if k >= len(self.parts) or cut == self.begin[k]:
            return self.before[min(k, len(self.parts))]
        if self.segments[k] is not None:
            return self.before[k] + self.segments[k].count(cut - self.begin[k])
        # A special token that is cut is text of the segment before it.
        return self.before[k - 1] + (len(self.encoder.encode(self.text[self.begin[k - 1] : cut])) >> 2)

    def cut_for(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if self.total <= budget:
            return len(self.text)
        for k in range(len(self.parts) - 1, -1, -1):
            if self.before[k] > budget + (self.segments[k] is None):
                continue  # a special token more than the budget may still be cut back to ordinary text
            if self.segments[k] is None:
                for cut in range(self.begin[k + 1], self.begin[k], -1):
                    if self.count(cut) <= budget:
                        return cut
            elif self.before[k] <= budget:
                return self.begin[k] + self.segments[k].cut_for(budget - self.before[k])
        return 0
