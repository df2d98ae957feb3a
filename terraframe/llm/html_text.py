"""Main text of web pages by nearest-URL page differencing.

A page becomes a sequence of lines (blocks of text between block-level tags). Pages are ordered by
host, URL path and id, and each is paired with the nearest page of its host whose text differs: the
one of its two neighbours in that order whose path shares the longer prefix. The line sequences
of a pair are aligned by longest common subsequence, and shared lines are deleted. Inside the
page's own content element (article, main, or the like), where two articles may well quote the same
sentence, a line goes only if the neighbour on the other side shares it too. Of what is left, the larger
part stays: the content element's lines, or, where most of the page's own text stands outside, all.

Markup alone deletes what is never main text: scripts, styles, menus, forms' controls, hidden
elements, and elements that name such a role. Pages with the same text are copies; they are no
witness against each other, so their neighbours are the pages before and after all of them.

Neighbours don't depend on partitions: a first pass over keys and text hashes finds the pages at the
ends of each range, and these are handed to the adjoining range as well.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .runtime import materialize

DIRECT_CELLS = 1 << 26

# HTML element sets and the words that mark a region's role in class, id or role.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "xmp", "noembed", "noframes"}
DROPPED = {"nav", "header", "footer", "aside", "button", "select", "dialog", "menu", "head", "object", "canvas", "audio", "video", "fieldset"}
CONTENT = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar"}
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "header", "masthead", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related", "recommended", "comment", "comments", "disqus", "replies", "reply", "widget", "toolbar", "pagination", "pager", "skip",
}
#: Words that may stand beside a mark in a class without changing its meaning.
GLUE = {
    "area", "articles", "bar", "block", "body", "bottom", "box", "btn", "button", "buttons", "container", "content", "form", "global", "group", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "media", "outer", "panel", "posts", "primary", "right", "row", "section", "site", "slot", "stories", "thread", "to", "top", "unit", "wrap", "wrapper",
}
HEAD_TAGS = {"title", "meta", "link", "script", "style", "base", "noscript", "template"}
#: Elements that end when another of their group opens beside them.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BODY_MARKS = {"articlebody", "post-content", "entry-content", "article-content", "article-body", "main-content"}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*)(?:>|\Z)", re.S)
WORD_BREAK = re.compile(r"[-_]+")
ATTRIBUTE = re.compile(r"(class|id|role|hidden|style|itemprop|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)


def _kind(tag: str, attributes: str, inside_content: bool) -> int:
    """What an element is by its markup: 1 furniture, 2 content, 3 in-content header, 0 neither."""
    if tag in ("html", "body"):
        return 0
    if tag in CONTENT:
        kind = 2
    elif tag == "header" and inside_content:
        kind = 3
    elif tag in DROPPED:
        return 1
    else:
        kind = 0
    if not attributes or attributes.isspace():
        return kind
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return 1
        if name == "role":
            if value in ROLES:
                return 1
            if value in ("main", "article"):
                kind = 2
        elif name == "itemprop" and value == "articlebody":
            kind = 2
        elif name in ("class", "id") and kind != 2:
            for token in value.split():
                if token in BODY_MARKS:
                    kind = 2
                    break
                words = WORD_BREAK.split(token)
                if words[0] in ("has", "with", "no", "page", "layout"):
                    continue
                if inside_content and words[-1] in ("header", "masthead") and all(w in MARKS or w in GLUE or w in ("article", "post", "entry", "page") for w in words):
                    kind = 3
                elif any(w in MARKS for w in words) and all(w in MARKS or w in GLUE for w in words):
                    return 1
    return kind


def lines_of(source: str | None) -> list[tuple[str, int]]:
    """(line, region) of a page in order; region 2 inside its content element, 1 furniture, 0 else.

    A form is furniture, unless it holds most of the page's text or the content element.
    """
    if not source:
        return []
    out: list[tuple[str, int]] = []
    text: list[str] = []
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}
    blocks: list[int] = []  # places of the elements that are not inline
    inline: list[dict[str, int]] = [{}]  # open inline elements in each of them
    bad = good = head = heading = form = 0

    def end_line() -> None:
        nonlocal text
        if text:
            line = "".join(text)
            line = " ".join((html.unescape(line) if "&" in line else line).split())
            text = []
            if line:
                out.append((line, 1 if bad or (head and not heading) else 2 if good else 3 if form else 0))

    def close(depth: int) -> None:
        """End all elements from ``depth`` of the stack on."""
        nonlocal bad, good, head, heading, form
        if any(kind for _, kind in stack[depth:]):
            end_line()
        first = len(stack)
        while blocks and blocks[-1] >= depth:
            first = blocks.pop()
            inline.pop()
        for name, _ in stack[depth:first]:  # in the scope that stays open
            inline[-1][name] -= 1
        for name, kind in stack[depth:]:
            opened[name] -= 1
            bad -= kind == 1
            good -= kind == 2
            head -= kind == 3
            form -= kind == 4
            heading -= name in HEADINGS
        del stack[depth:]

    def write(words: str) -> None:
        if stack and stack[-1][0] == "head" and not words.isspace():
            close(len(stack) - 1)
        text.append(words)

    at, size = 0, len(source)
    while at < size:
        found = TOKEN.search(source, at)
        if found is None:
            write(source[at:])
            break
        if found.start() > at:
            write(source[at : found.start()])
        at = found.end()
        tag = found[2]
        if tag is None:
            if found[0].startswith("<![CDATA["):
                write(html.escape(found[0][9:].removesuffix("]]>"), quote=False))
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        closing = bool(found[1])
        if tag not in INLINE:
            end_line()
        if not closing and opened.get("head") and stack[-1][0] == "head" and tag not in HEAD_TAGS:
            close(len(stack) - 1)
        if not closing and tag in RAW:
            if not found[3].endswith("/"):
                end = re.compile(rf"</{tag}\s*[^>]*>", re.I).search(source, at)
                at = end.end() if end else size
            continue
        if tag in VOID:
            continue
        if not closing:
            if tag not in INLINE and blocks and (stack[blocks[-1]][0] == "p" or stack[blocks[-1]][0] in ENDS.get(tag, ())):
                close(blocks[-1])
            kind = 0 if found[3].endswith("/") and tag not in INLINE else 4 * (tag == "form") or _kind(tag, found[3], good > 0)
            if kind == 4 and good:
                kind = 1
            if kind:
                end_line()
            if tag in INLINE:
                inline[-1][tag] = inline[-1].get(tag, 0) + 1
            else:
                blocks.append(len(stack))
                inline.append({})
            stack.append((tag, kind))
            opened[tag] = opened.get(tag, 0) + 1
            bad += kind == 1
            good += kind == 2
            head += kind == 3
            form += kind == 4
            heading += tag in HEADINGS
            continue
        if (inline[-1] if tag in INLINE else opened).get(tag):
            close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
    end_line()
    formed, free = (sum(len(line) for line, region in out if region in kinds) for kinds in ((3,), (0, 2)))
    return [(line, region if region != 3 else 0 if formed > free else 1) for line, region in out]


def common_lines(a: list, b: list) -> list[int]:
    """Positions in ``a`` of one longest common subsequence with ``b``.

    Common ends are cut off, then bit-parallel rows (one integer of len(b) bits per line of ``a``)
    are walked back; long pairs are first halved by row lengths, so memory stays bounded.
    """
    lo, end_a, end_b = 0, len(a), len(b)
    while lo < min(end_a, end_b) and a[lo] == b[lo]:
        lo += 1
    while min(end_a, end_b) > lo and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    ends = [*range(lo), *range(end_a, len(a))]
    shared = set(a[lo:end_a]) & set(b[lo:end_b])
    at = [i for i in range(lo, end_a) if a[i] in shared]
    y = [x for x in b[lo:end_b] if x in shared]
    if not at:
        return ends
    x = [a[i] for i in at]
    return sorted(ends + [at[i] for i in _align(x, y)])


def _rows(x: list, y: list) -> Iterator[int]:
    """For each prefix of ``x``: integer whose zero bits mark where the common length with y grows."""
    where: dict = {}
    for j, line in enumerate(y):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(y)) - 1
    row = full
    for line in x:
        match = row & where.get(line, 0)
        row = ((row + match) | (row - match)) & full
        yield row


def _align(x: list, y: list) -> list[int]:
    if not x or not y:
        return []
    if len(x) == 1:
        return [0] if x[0] in y else []
    if len(x) * len(y) <= DIRECT_CELLS:
        rows, out, j = list(_rows(x, y)), [], len(y)
        for i in range(len(x) - 1, -1, -1):
            # Row i grows at some column <= j that row i-1 does not reach: x[i] is matched there.
            mask = (1 << j) - 1
            here = j - (rows[i] & mask).bit_count()
            above = j - (rows[i - 1] & mask).bit_count() if i else 0
            if here > above:
                out.append(i)
                while j and y[j - 1] != x[i] or j and (j - 1 - (rows[i] & ((1 << (j - 1)) - 1)).bit_count()) >= here:
                    j -= 1
                j -= 1
        return out[::-1]
    mid = len(x) // 2
    *_, head = _rows(x[:mid], y)
    *_, tail = _rows(x[mid:][::-1], y[::-1])

    def reach(row: int) -> np.ndarray:
        bits = np.unpackbits(np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(y)]
        return np.concatenate([[0], np.cumsum(bits == 0)])

    cut = int(np.argmax(reach(head) + reach(tail)[::-1]))
    return _align(x[:mid], y[:cut]) + [mid + i for i in _align(x[mid:], y[cut:])]


def shared_lines(lines: list[tuple[str, int]], other: list[tuple[str, int]] | None) -> set[int]:
    """Positions of the lines that the alignment with another page shares."""
    return set(common_lines([line for line, _ in lines], [line for line, _ in other])) if other else set()


def main_text(lines: list[tuple[str, int]], near: set[int], far: set[int]) -> str:
    """Text of a page: blocks joined by an empty line.

    ``near`` has the lines shared with the nearest page, ``far`` those shared with the neighbour on
    the other side.
    """
    own = [(line, region) for i, (line, region) in enumerate(lines) if (region == 0 and i not in near) or (region == 2 and not (i in near and i in far))]
    inside, outside = (sum(len(line) for line, region in own if region == kind) for kind in (2, 0))
    return "\n\n".join(line for line, region in own if region == 2 or inside < outside or not inside)


def text_hash(lines: list[tuple[str, int]]) -> int:
    """Signed hash of all text that markup leaves; equal pages are copies."""
    return xxhash.xxh64_intdigest("\n".join(line for line, region in lines if region != 1).encode("utf-8", "surrogatepass")) - (1 << 63)


def _near(a: str, b: str) -> int:
    """Length of the common prefix of two paths."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


class Run:
    """Copies that follow each other in URL order, and their lines."""

    def __init__(self, host: str, code: int, lines: list[tuple[str, int]]):
        self.host, self.code, self.lines, self.members = host, code, lines, []

    def texts(self, before: Run | None, after: Run | None) -> Iterator[tuple]:
        """(page_id, url, text) of each copy that is no witness only."""
        sides = [run if run and run.host == self.host else None for run in (before, after)]
        shared = [shared_lines(self.lines, run.lines if run else None) for run in sides]
        made: dict[bool, str] = {}
        for page, url, path, witness in self.members:
            if not witness:
                left, right = (_near(run.members[end][2], path) if run else -1 for run, end in zip(sides, (-1, 0)))
                first = left >= right
                if first not in made:
                    made[first] = main_text(self.lines, *(shared if first else shared[::-1]))
                yield page, url, made[first]


def _keys(pages: DataFrame) -> DataFrame:
    """Rows with host, path and a hash of the html that orders rows with the same id."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://[^/?#]*([^?#]*)", 1)
    source = F.col("html").cast("string")
    return pages.select("page_id", F.col("url").cast("string").alias("url"), source.alias("html"), host.alias("host"), path.alias("path"), F.coalesce(F.xxhash64(source), F.lit(0)).alias("tie"))


def _ends(keyed: DataFrame, n: int) -> list[list[tuple]]:
    """For each range in turn: its first key, and the first and last runs of copies at both ends.

    Each range gives five rows at most.
    """
    key = keyed.schema["page_id"].dataType.simpleString()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [lines_of(x.as_py()) for x in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([text_hash(x) if x else None for x in lines], pa.int64())], ["host", "path", "page_id", "tie", "code"])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, runs, first = TaskContext.get().partitionId(), [], None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                first = first or row
                if row[4] is None:
                    continue
                if runs and (runs[-1][0][0], runs[-1][0][4]) == (row[0], row[4]):
                    runs[-1][1] = row
                else:
                    runs.append([row, row])
                    del runs[2:-2]
        if first:
            found = [(0, first), *((1, run[0]) for run in runs[:2]), *((2, run[1]) for run in runs[-2:])]
            columns = [pa.array([part] * len(found), pa.int32()), pa.array([k for k, _ in found], pa.int32())]
            columns += [pa.array([row[i] for _, row in found], batch.column(i).type) for i in range(5)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "k", "host", "path", "page_id", "tie", "code"])

    slim = materialize(keyed.select("host", "path", "page_id", "tie", "html").mapInArrow(hashes, f"host string, path string, page_id {key}, tie bigint, code bigint"), "page-keys")
    order = ["host", "path", "page_id", "tie"]
    ranged = slim.repartitionByRange(n, *order[:3]).sortWithinPartitions(*order)
    rows = ranged.mapInArrow(ends, f"part int, k int, host string, path string, page_id {key}, tie bigint, code bigint").collect()
    parts: dict[int, list[tuple]] = {}
    for r in rows:  # in the order in which the ranges gave them
        parts.setdefault(r["part"], []).append((r["k"], (r["host"], r["path"], r["page_id"], r["tie"], r["code"])))
    return [parts[p] for p in sorted(parts)]


def _sortable(host: str, path: str, page) -> tuple:
    return host, path, page is not None, page if page is not None else 0


def _witnesses(parts: list[list[tuple]]) -> dict[tuple, list[int]]:
    """Ranges besides its own in which a page, named by (host, path, id, tie), is needed as a neighbour."""
    wanted: dict[tuple, list[int]] = {}
    for step in (1, -1):
        seen: list[tuple] = []  # the last two runs before the range
        for b in range(len(parts))[::step]:
            for row in seen:
                wanted.setdefault(row[:4], []).append(b)
            for row in [row for k, row in parts[b] if k == (2 if step > 0 else 1)][::step]:
                seen = [x for x in seen if (x[0], x[4]) != (row[0], row[4])][-1:] + [row]
    return wanted


def extract(pages: DataFrame, ranges: int | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row; null or empty html has an empty text.

    Rows are dealt by ranges of (host, path, page_id), ``ranges`` of them (the session's shuffle
    partitions by default), which splits a host of any size between tasks; results are the same for
    any number. URLs without a host share the empty host. Pages without text are nobody's
    neighbours. Repeated rows are copies of each other and keep their texts.
    """
    keyed = _keys(pages)
    n = ranges or int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = _ends(keyed, n)
    bounds = [_sortable(*row[:3]) for part in parts for k, row in part if k == 0]
    wanted = _witnesses(parts)
    n, numbers = max(1, len(bounds)), isinstance(pages.schema["page_id"].dataType, IntegralType)

    @F.pandas_udf("array<int>")
    def places(host: pd.Series, path: pd.Series, page: pd.Series, tie: pd.Series) -> pd.Series:
        """Twice the number of the own range, and for each range that needs the page its number twice and one."""
        out = []
        for h, p, i, t in zip(host, path, page, tie):
            i = i if i is None or not numbers else int(i)
            own = max(0, bisect_right(bounds, _sortable(h, p, i)) - 1)
            out.append([2 * own, *(2 * b + 1 for b in wanted.get((h, p, i, t), ()) if b != own)])
        return pd.Series(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        bucket, before, here, key = -1, None, None, pa.int64()

        def packed() -> pa.RecordBatch:
            nonlocal rows
            got, rows = rows, []
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in got], kind) for i, kind in enumerate((key, pa.string(), pa.string()))] + [pa.array([len(r[2]) for r in got], pa.int64())], ["page_id", "url", "text", "n_chars"])

        def end(after: Run | None) -> Iterator[pa.RecordBatch]:
            for row in here.texts(before, after) if here else ():
                rows.append(row)
                if len(rows) >= 500:
                    yield packed()

        for batch in batches:
            key = batch.column(1).type
            places, ids, urls, hosts, paths = (batch.column(i).to_pylist() for i in range(5))
            for place, page, url, host, path, source in zip(places, ids, urls, hosts, paths, batch.column(5)):
                lines = lines_of(source.as_py())
                if place >> 1 != bucket:
                    yield from end(None)
                    bucket, before, here = place >> 1, None, None
                if not lines:
                    if not place & 1:
                        rows.append((page, url, ""))
                    continue
                code = text_hash(lines)
                if here is None or (here.host, here.code) != (host, code):
                    found = Run(host, code, lines)
                    found.members.append((page, url, path, place & 1))
                    yield from end(found)
                    before, here = here, found
                else:
                    here.members.append((page, url, path, place & 1))
                if len(rows) >= 500:
                    yield packed()
        yield from end(None)
        yield packed()

    placed = keyed.withColumn("place", F.explode(places("host", "path", F.col("page_id").cast("string"), "tie")))
    dealt = placed.repartitionById(n, F.shiftright("place", 1))
    ordered = dealt.sortWithinPartitions(F.shiftright("place", 1), "host", "path", "page_id", "tie").select("place", "page_id", "url", "host", "path", "html")
    kind = pages.schema["page_id"].dataType.simpleString()
    return ordered.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")


def op2_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
