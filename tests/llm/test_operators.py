"""Corpus operators against brute force, exact round trips and held-out accuracy; edge cases of each."""

import base64
import hashlib
import io
import math
import random
import zlib

import numpy as np
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from terraframe.llm import ball_tree, components, hnsw, html_text, huffman, mixing, piece_scan, ppm, simhash, token_counts, warc
from terraframe.llm.runtime import scratch
from terraframe.llm.word_tokens import WordTokenizer

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, fp string, component string, _t int, n int, ids int"
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two"), (6, "alpha beta gamma delta " * 3000), (7, "alpha beta gamma delta " * 3000), (8, "Ünï 中文 🙂\x00 <|endoftext|> it's"), (9, "one"), (9, "one"), (None, "no id")]


def odd(spark):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2, 3) for i, t in ODD], DOCS)


def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# 1


def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (300, 6)) / 8
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)] + [(900, None, "c"), (901, [float("nan")] * 6, "c"), (902, [1.0, 2.0], "c"), (903, [None] * 6, "c"), (904, [], "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string").repartition(3)
    got = ball_tree.top_k(table.where("vec_id % 7 = 0"), table, 4, shard_rows=40, query_rows=16).orderBy("query_id", "rank").collect()
    q = np.floor(256 * x.astype(np.float32).astype(float)).astype(int)
    want = []
    for i in range(0, 300, 7):
        best = sorted((-int(q[i] @ q[j]), j) for j in range(300) if j != i)[:4]
        want += [(i, k, j, -s) for k, (s, j) in enumerate(best, 1)]
    assert [tuple(r) for r in got] == want
    again = ball_tree.top_k(table.where("vec_id % 7 = 0"), table, 4, shard_rows=40, query_rows=16, group_trees=1).orderBy("query_id", "rank").collect()
    assert again == got, "waves of one tree a group"
    twice = table.where("vec_id < 40").unionByName(table.where("vec_id = 3"))
    got = ball_tree.top_k(twice.where("vec_id = 3"), twice, 2).collect()
    assert len(got) == 4 and all(r["vec_id"] != 3 for r in got) and {r["rank"] for r in got} == {1, 2}
    got = [r["vec_id"] for r in ball_tree.top_k(twice.where("vec_id = 5"), twice, 40).collect()]
    assert got.count(3) == 2 and len(got) == 40
    assert ball_tree.top_k(table.limit(0), table).count() == 0
    assert ball_tree.top_k(table.where("vec_id = 902"), table).count() == 0


def test_scores_beyond_int64_are_clipped():
    a = ball_tree.quantise(np.array([[1e30, -1e30]]), 256.0)
    assert ball_tree.scores(a, a)[0, 0] == 2**63 - 1


# 2


PAGE = "<html><head><title>t</title></head><body><header>Site</header><nav><a>Menu</a></nav>{}<footer>foot</footer></body></html>"


def text_of(source):
    return html_text.main_text(html_text.lines_of(source), set(), set())


def test_html_structure():
    page = PAGE.format("<div class='cookie-banner'>We use cookies</div><article><header><h1>A &amp; B</h1><p>by me</p></header><p>one<br>two   <b>bold</b><p>x &lt; y<script>var a='</p>';</script><aside>side</aside><form><input>go</form><section id=comments><p>first!</p></section></article><div class='ad'>buy</div>")
    assert text_of(page) == "A & B\n\none two bold\n\nx < y"
    assert html_text.lines_of(None) == [] and html_text.lines_of("") == []
    assert text_of("plain <b>text") == "plain text"
    assert text_of('<p>a<a title="broken>b</p>c').startswith("a")
    assert text_of("<html><head><title>t</title><body><p>hello world") == "hello world", "head ends where the body begins"
    assert text_of("<html><head><title>t</title><p>hello") == "hello"
    assert text_of("<body><form action=x><nav>m</nav><p>A page inside one form</p><input></form>") == "A page inside one form"
    assert text_of("<body><form><div>Search</div></form><p>A page beside its form</p>") == "A page beside its form"
    assert text_of("<body><form><label>Name</label><main><p>Text</p></main></form>") == "Text"
    kept = "<article><div class='share-price'>a</div><section class='related-work'>b</section><p class='notice-board'>c</p><div class='share-buttons'>x</div><ul class='related-posts'><li>y</ul></article>"
    assert text_of(kept) == "a\n\nb\n\nc"
    assert text_of("<ul><li>a<li>b<li>c</ul><dl><dt>d<dd>e</dl>") == "a\n\nb\n\nc\n\nd\n\ne"


@pytest.mark.parametrize("source", ["<div>" * 50_000 + "</x>" * 50_000, "<b>" + "<div>" * 50_000 + "</b>" * 50_000, "<p><b>a" * 50_000, "<i>" * 50_000 + "a" + "</i>" * 50_000, "<ul>" + "<li>" * 100_000])
def test_html_of_many_tags(source):
    import time

    began = time.process_time()
    text_of(source)
    assert time.process_time() - began < 3


def test_page_differencing(spark):
    body = lambda own: f"<p>Shared line above</p><p>{own} and a good deal of text of its own</p><p>Shared line below</p>"
    rows = [(1, "http://h.org/a/1", PAGE.format(body("First")), 1), (2, "http://h.org/a/2", PAGE.format(body("Second")), 1), (3, "http://other.org/a/1", PAGE.format(body("Third")), 1), (4, None, None, 1), (5, "", "", 1), (6, "http://c.org/x", PAGE.format(body("Same")), 1), (7, "http://c.org/x", PAGE.format(body("Same")), 1), (None, None, PAGE.format(body("Lone")), 1), (7, "http://c.org/x", PAGE.format(body("Same")), 1)]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host int")).collect()}
    assert got[1] == "First and a good deal of text of its own"
    assert got[3].count("\n\n") == 2, "no neighbour on its host"
    assert got[6] == got[7] != "", "copies keep their text"
    assert got[4] == got[5] == ""
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def common_by_table(a, b):
    """Positions in ``a`` of a longest common subsequence, from the plain table."""
    size = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            size[i + 1, j + 1] = size[i, j] + 1 if a[i] == b[j] else max(size[i, j + 1], size[i + 1, j])
    i, j, out = len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            out.add(i)
        elif size[i - 1, j] >= size[i, j - 1]:
            i -= 1
        else:
            j -= 1
    return out


def test_differencing_against_brute_force(spark):
    rng = random.Random(17)
    pages, texts = [], []
    for page in range(260):
        host = rng.choice(["a.org", "a.org", "a.org", "b.org", "c.org"])
        path = "/" + "/".join(rng.choice("xyz") for _ in range(rng.randrange(3)))
        if texts and rng.random() < 0.3:
            lines = rng.choice(texts)  # copies, next to each other or not
        else:
            inside = [f"Own line {page} {k} of some length" for k in range(rng.randrange(4))]
            lines = [("menu of " + host, 0)] + [(x, 2) for x in ["Lead of " + host] * (rng.random() < 0.7) + inside + ["Quoted by many"] * (rng.random() < 0.3)] + [("foot of " + host, 0)] * (rng.random() < 0.8) + [(f"Outside {page}", 0)] * (rng.random() < 0.2)
            texts.append(lines)
        out = "".join(f"<p>{x}</p>" for x, r in lines if r == 0 and x.startswith("menu")) + "<article>" + "".join(f"<p>{x}</p>" for x, r in lines if r == 2) + "</article>" + "".join(f"<p>{x}</p>" for x, r in lines if r == 0 and not x.startswith("menu"))
        pages.append((page, f"http://{host}{path}", out, host, path, lines))
    pages.sort(key=lambda p: (p[3], p[4], p[0]))
    want = {}
    for i, (page, _, _, host, path, lines) in enumerate(pages):
        near = []
        for step in (-1, 1):
            j = i + step
            while 0 <= j < len(pages) and pages[j][3] == host and pages[j][5] == lines:
                j += step
            near.append(pages[j] if 0 <= j < len(pages) and pages[j][3] == host else None)
        score = [-1 if p is None else next((k for k, (x, y) in enumerate(zip(p[4], path)) if x != y), min(len(p[4]), len(path))) for p in near]
        if score[1] > score[0]:
            near.reverse()
        shared = [common_by_table([x for x, _ in lines], [x for x, _ in p[5]]) if p else set() for p in near]
        own = [(x, r) for k, (x, r) in enumerate(lines) if (r == 0 and k not in shared[0]) or (r == 2 and not (k in shared[0] and k in shared[1]))]
        inside, outside = (sum(len(x) for x, r in own if r == kind) for kind in (2, 0))
        want[page] = "\n\n".join(x for x, r in own if r == 2 or inside < outside or not inside)
    frame = spark.createDataFrame([p[:3] for p in pages], "page_id long, url string, html string").repartition(5)
    for ranges in (1, 4, 64):
        assert {r["page_id"]: r["text"] for r in html_text.extract(frame, ranges).collect()} == want
    assert len({t for t in want.values()}) > 100 and not all("Lead of" in t for t in want.values())


def test_common_lines(monkeypatch):
    rng = random.Random(5)
    for cells in (1 << 26, 6):
        monkeypatch.setattr(html_text, "DIRECT_CELLS", cells)
        for _ in range(300):
            a, b = ([rng.randrange(4) for _ in range(rng.randrange(11))] for _ in range(2))
            table = np.zeros((len(a) + 1, len(b) + 1), int)
            for i in range(len(a)):
                for j in range(len(b)):
                    table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
            got = html_text.common_lines(a, b)
            rest = iter(b)
            assert len(set(got)) == len(got) == table[-1, -1] and all(a[i] in rest for i in got)


# 3


def test_code_lengths_and_blocks():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 50, 3000):
        counts = np.maximum(1, (rng.pareto(0.3, n) * 10).clip(0, 1e12)).astype(np.int64)
        lengths = huffman.code_lengths(counts).astype(int)
        assert lengths.max() <= huffman.MAX_BITS and (2.0**-lengths).sum() <= 1
        ids = rng.choice(n, 2000, p=counts / counts.sum())
        block = huffman.write_block(np.array([5, 7]), np.array([0, 900]), np.array([900, 1100]), ids, lengths)
        doc_ids, starts, sizes, back = huffman.read_block(block)
        assert (back == ids).all() and doc_ids.tolist() == [5, 7] and starts.tolist() == [0, 900] and sizes.tolist() == [900, 1100]
    assert huffman.code_lengths(np.array([1, 1, 2, 4])).tolist() == [3, 3, 2, 1]


def reference_ids(texts):
    from tokenizers import Tokenizer

    return [t.ids for t in Tokenizer.from_file(token_counts.vocabulary()).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_huffman_files(spark):
    rows = docs(spark).unionByName(odd(spark).where("doc_id < 9").select((F.col("doc_id") + 10**6).alias("doc_id"), "text"), allowMissingColumns=True)
    blocks = huffman.write_files(huffman.materialize(huffman.encode_ids(rows), "ids"), scratch(spark, "t"))
    got = {r["doc_id"]: r for r in huffman.read_files(blocks).collect()}
    at = 0
    source = sorted(map(tuple, rows.select("doc_id", "text").collect()))
    for (doc, _), ids in zip(source, reference_ids([t for _, t in source])):
        ids = np.array([*ids, 1], "<u4")
        assert (got[doc]["start"], got[doc]["n_tokens"], got[doc]["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    none = huffman.write_files(huffman.materialize(huffman.encode_ids(rows.limit(0)), "ids"), scratch(spark, "t"))
    assert huffman.read_files(none).count() == 0
    clash = "doc_id long, text string, part int, n int, ids int, before int, start int"
    some = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in [*ODD, (-5, "below zero"), (None, None)]], clash)
    back = huffman.read_files(huffman.write_files(huffman.materialize(huffman.encode_ids(some), "ids"), scratch(spark, "t"))).orderBy("start").collect()
    assert [r["doc_id"] for r in back] == [None, None, -5, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9]
    assert [r["start"] for r in back] == [sum(x["n_tokens"] for x in back[:k]) for k in range(len(back))]
    with pytest.raises(TypeError):
        huffman.encode_ids(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


# 4


def test_piece_scan_equals_library():
    pieces = piece_scan.Pieces(token_counts.vocabulary(piece_scan.MODEL))
    rng = random.Random(3)
    texts = ["a" * 200, "International" * 20, "x" + " " * 90 + "y" * 60, "0123456789" * 20, " lead and trail ", "\n", "▁", "🙂é中" * 30]
    texts += ["".join(rng.choice(["in", "ter", "na", "tion", "  ", "e", " ", "\n", "一"]) for _ in range(150)) for _ in range(6)]
    for text in texts:
        want = pieces.sp.encode(text)
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == want
        for chunk in (16, 45, 120):
            assert np.frombuffer(piece_scan.encode_by_scan(pieces, text, chunk), "<u4").tolist() == want
        assert pieces.decode(np.array(want, int)) == text.replace("▁", " ")


def test_scan_carries_states():
    """Cuts fall inside words, so that boundaries have several states, and chunks' own lattices give the library's ids."""
    pieces = piece_scan.Pieces(token_counts.vocabulary(piece_scan.MODEL))
    rng = random.Random(8)
    text = " ".join("".join(rng.choice(["in", "ter", "na", "tion", "al", "ed", "é"]) for _ in range(rng.randrange(1, 5))) for _ in range(3000))
    normal = piece_scan.normalized(text)
    cuts = piece_scan.cuts_of(normal, 512)
    chunks = [piece_scan.Chunk(pieces, normal, a, b) for a, b in zip(cuts, cuts[1:])]
    matrices = [c.matrix() for c in chunks]
    assert sum(not pieces.hard(normal, c) for c in cuts) > len(cuts) // 2
    assert sum(min(m.shape) > 1 for m in matrices) > len(matrices) // 4
    words = pieces.words
    pieces.encode_words = None  # the library encodes no word here
    states = piece_scan.best_states(matrices)
    whole = b"".join(c.backtrace(c.entries[s], c.exits[e]) for c, s, e in zip(chunks, states, states[1:]))
    rest = [(piece_scan.Chunk(pieces, *c.rest()), c.inside()) for c in chunks]
    assert b"".join(c.backtrace(c.entries[s], c.exits[e], i) for (c, i), s, e in zip(rest, states, states[1:])) == whole
    assert not words and np.frombuffer(whole, "<u4").tolist() == pieces.sp.encode(text)
    score = sum(pieces.sp.get_score(i) for i in pieces.sp.encode(text))
    assert piece_scan.scan(matrices)[-1].max() == pytest.approx(score), "the product of all matrices is the score of the text"


def test_scan_is_associative():
    rng = np.random.default_rng(0)
    mats = [rng.integers(0, 9, (a, b)).astype(float) for a, b in zip([1, 3, 2, 4, 2, 5], [3, 2, 4, 2, 5, 1])]
    one = mats[0]
    for m, whole in zip(mats[1:], piece_scan.scan(mats)[1:]):
        one = piece_scan.max_plus(one, m)
        assert (one == whole).all()


def test_piece_documents(spark):
    pieces = piece_scan.Pieces(token_counts.vocabulary(piece_scan.MODEL))
    giant = [(100, "ab" * 3000), (101, "word " * 1500 + "x" * 700)]
    rows = odd(spark).select("doc_id", "text").unionByName(spark.createDataFrame(giant, "doc_id long, text string"))
    got = piece_scan.encode(rows, chunk=400, giant=1000).collect()
    assert len(got) == rows.count()
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == (pieces.sp.encode(r["text"]) if r["text"] else [])
    assert piece_scan.describe(piece_scan.encode(odd(spark)), "doc_id").where("not round_trip").count() == 0
    assert not piece_scan.describe(piece_scan.encode(spark.createDataFrame([(1, "a▁b")], "doc_id long, text string")), "doc_id").first()["round_trip"]
    assert piece_scan.encode(odd(spark).limit(0)).count() == 0


# 5


def brute_print(text):
    words = regex.findall(rb"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "").encode())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_groups(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_simhash_against_brute_force(spark):
    rows = docs(spark).select("doc_id", "text").unionByName(odd(spark).where("doc_id < 9").select((F.col("doc_id") + 10**6).alias("doc_id"), "text"))
    source = {r[0]: brute_print(r[1]) for r in rows.collect()}
    pairs = [(a, b) for a in source for b in source if a < b and (source[a] ^ source[b]).bit_count() <= 2]
    want = brute_groups(source, pairs)
    got = simhash.simhash_groups(rows).collect()
    assert {r["doc_id"]: (r["fp"] % 2**64, r["component"]) for r in got} == {d: (source[d], want[d]) for d in source}
    kept = simhash.keep_first(odd(spark))
    assert kept.columns == odd(spark).columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 4, 5, 6, 8, None}
    assert simhash.keep_first(odd(spark).limit(0)).count() == 0


def jaccard_sets(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline_drops_near_copies(spark):
    import corpus_pipeline

    rng = random.Random(11)
    texts = {k: " ".join(str(rng.randrange(5000)) for _ in range(rng.choice([60, 200, 700]))) for k in range(30)}
    for k in range(30):
        words = texts[k].split()
        for copy in (1, 2, 3, 4):
            changed = list(words)
            for _ in range(rng.randrange(1, len(words) // 40 + 2)):
                changed[rng.randrange(len(words))] = "new"
            texts[100 * copy + k] = " ".join(changed)
    texts |= {5000 + k: t for k, t in ODD if k is not None and k < 9}
    sets = {k: jaccard_sets(t) for k, t in texts.items()}
    like = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
    pairs = [(a, b) for a in sets for b in sets if a < b and like(sets[a], sets[b])]
    assert sum(0.8 <= len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b])) <= 0.95 for a, b in pairs) > 50
    label = brute_groups(texts, pairs)
    frame = spark.createDataFrame([*texts.items(), (None, texts[0])], "doc_id long, text string")
    for block in (simhash.BLOCK, 2):
        assert {r[0]: r[1] for r in simhash.shingle_groups(frame, block=block).collect()} == label
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, SF)
    assert {r["doc_id"] for r in kept.collect()} == {*label.values(), None}
    assert corpus_pipeline.drop_near_duplicates(spark, frame.limit(0), SF).count() == 0


@pytest.mark.parametrize("radius", [4, 7, 24])
def test_wide_distances(radius):
    rng = np.random.default_rng(radius)
    a = rng.integers(0, 1 << 63, 5000, dtype=np.uint64)
    b = a ^ (rng.integers(0, 1 << 63, 5000, dtype=np.uint64) & rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    assert simhash.within(a, b, radius).tolist() == [int(x ^ y).bit_count() <= radius for x, y in zip(a, b)]


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_lose_nothing(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(4)]
    codes = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1) for b in base for _ in range(60)}
    assert simhash.within(np.array(sorted(codes), np.uint64), np.full(len(codes), base[0], np.uint64), radius).tolist() == [(c ^ base[0]).bit_count() <= radius for c in sorted(codes)]
    signed = [c - 2**64 if c >= 2**63 else c for c in codes]
    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= radius]
    links = simhash.fingerprint_links(spark.createDataFrame([(c,) for c in signed], "fp long"), radius, block=16)
    found = {r[0]: r[1] for r in components.connected_components(links).collect()}
    want = brute_groups(signed, pairs)
    assert all(found.get(c, c) == want[c] for c in signed)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (5, 5), (None, 3)] + [(200, i) for i in range(201, 260)]
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert {got[i] for i in range(41)} == {0} and got[101] == 100 and {got[i] for i in range(200, 260)} == {200}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# 6


def test_warc(spark):
    rows = [(1, "u1", "<p>same</p>"), (2, "u2", "<p>same</p>"), (9, "u9", "<p>same</p>"), (3, None, None), (4, "u4", ""), (5, "a\nb", "é" * 50000), (6, "u6", "x\r\n\r\nWARC/1.1\r\n")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    index = warc.write_bundles(warc.with_revisits(pages), scratch(spark, "t"), frame_bytes=200)
    got = {r["page_id"]: r for r in warc.read_frames(index).collect()}
    for i, _, html in rows:
        data = (html or "").encode()
        assert got[i]["payload_bytes"] == len(data) and got[i]["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert {i: r["refers_to"] for i, r in got.items()} == {1: 9, 2: 9, 9: None, 3: 4, 4: None, 5: None, 6: None}
    assert {r["record_type"] for i, r in got.items() if i in (1, 2, 3)} == {"revisit"}
    assert warc.lookup(index, "urn:page:5")[1].decode() == "é" * 50000
    assert warc.read_frames(warc.write_bundles(warc.with_revisits(pages.limit(0)), scratch(spark, "t"))).count() == 0
    again = pages.unionByName(pages.where("page_id = 9")).unionByName(pages.limit(1).withColumn("page_id", F.lit(None).cast("long")))
    kinds = warc.read_frames(warc.write_bundles(warc.with_revisits(again), scratch(spark, "t"))).where("payload_bytes = 11").collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in kinds) == [(1, "revisit", 9), (2, "revisit", 9), (9, "response", None), (9, "response", None)]
    assert {r["refers_to"] for r in warc.with_revisits(pages, 5).where("page_id in (3, 4)").collect()} == {None}


def test_seek_table():
    import zstandard

    file = io.BytesIO()
    file.close = lambda: None
    writer = warc.BundleWriter(file, 100)
    for i in range(9):
        writer.add(str(i), bytes([i]) * 60)
    writer.flush()
    writer.close()
    table = warc.seek_table(file, len(file.getvalue()))
    assert len(table) == 5
    data = b"".join(zstandard.ZstdDecompressor().decompress(file.getvalue()[a : a + n]) for a, n in table)
    assert data == b"".join(bytes([i]) * 60 for i in range(9))


# 7


def test_token_counts(spark):
    rows = docs(spark).select("doc_id", "text").unionByName(odd(spark).select("doc_id", "text"))
    source = rows.collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(i)) for r, i in zip(source, reference_ids([r[1] for r in source])))
    got = token_counts.token_counts(rows).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)


    clash = spark.createDataFrame([(1, "one two", 1, 2, 3)], "doc_id long, text string, n_tokens int, cut_chars int, over_limit int")
    assert token_counts.token_counts(clash, limit=1).collect()[0].asDict() == {"doc_id": 1, "n_bytes": 7, "n_tokens": 2, "over_limit": True, "cut_chars": 4}
    assert token_counts.token_counts(clash.limit(0)).count() == 0


def library_count(encoder, text):
    return len(encoder.tokenizer.encode(text, add_special_tokens=False).ids)


def test_every_prefix_count():
    encoder = WordTokenizer(token_counts.vocabulary(), max_words=3)
    rng = random.Random(4)
    parts = ["a", "th", "in", "'", "'s", "'re", "<|endoftext|>", "<|", "!", "e\u0301", "é", "\u0301", "中文", "ΑΣ", "  ", "\n", "1", "²", "İ", "한국", "\u11a8", "_", "\x1f", "🙂", "ll", "\u3000"]
    texts = ["Hello wörld it's 123 <|endoftext|>foo  \n\tZZ'll é ΑΣ", "", "  ", "a b c d e f g a b c", "'re\u0301 'l", "x" * 70 + "'re\u0301"]
    for k in range(120):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        long = rng.choice(["thein", "中文日", "!?", "%"]) * rng.randrange(60) if k % 3 else "".join(rng.choice("abcdetinghrs") for _ in range(90))
        texts.append(long + text)
    for text in texts:
        counts = encoder.prefix_counts(text)
        want = [len(i) for i in reference_ids([text[:n] for n in range(len(text) + 1)])]
        assert [counts.count(n) for n in range(len(text) + 1)] == want
        for budget in (0, 1, 3, 20):
            assert encoder.prefix_counts(text).cut_for(budget) == max(n for n, w in enumerate(want) if w <= budget)


def test_long_words():
    encoder, rng = WordTokenizer(token_counts.vocabulary()), random.Random(2)
    for text in ("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(200_000)), "ab" * 200_000, "e" + "\u0301" * 20_000, "?" * 300_000):
        counts = encoder.prefix_counts(text)
        cut = counts.cut_for(2048)
        assert counts.total == library_count(encoder, text) > 2048
        assert library_count(encoder, text[:cut]) <= 2048 < min(library_count(encoder, text[: cut + n]) for n in (1, 2, 3, 40))


# 8


def solved_rates(n, p, targets, most):
    """The rates of the stated least-squares problem, by many plain projected gradient steps."""
    share = n / n.sum()
    want = np.array(targets) / sum(targets)
    mass = share @ p
    goal = want * min(m / w for m, w in zip(mass, want) if w > 0)
    weight, r = 1 / np.maximum(mass, 1e-6), np.ones(len(n))
    r = np.minimum(r, most)
    for _ in range(40_000):
        r = np.clip(r - 0.3 * (p @ (weight * ((share * r) @ p - goal)) + mixing.RIDGE * (r - 1)), 0, most)
    return r, goal * n.sum()


@pytest.mark.parametrize("most", [math.inf, 1.0])
def test_mixing(spark, most):
    rng = random.Random(1)
    words = {"good": ["river", "stone", "leaf"], "poor": ["zz%%", "qq$$", "xx##"], "toxic": ["scum", "idiot", "moron"]}
    text = lambda d: " ".join(rng.choice(words[d if rng.random() < 0.6 else "good"]) for _ in range(rng.randint(20, 60)))
    kinds = [rng.choices(list(words), [6, 3, 1])[0] for _ in range(400)]
    rows = [(i, text(k)) for i, k in enumerate(kinds)] + [(900, None), (901, ""), (None, "river"), (902, "river 河 " * 100_000), (903, "scum " * 300), (903, "scum " * 300)]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, p int, rate int")
    labels = spark.createDataFrame([(i, int(k != "poor"), int(k == "toxic")) for i, k in enumerate(kinds) if i % 2] + [(None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    targets = {"good": 0.8, "poor": 0.2}
    out = mixing.mix(frame, frame, labels, mixing.label_domain(), targets, most=most).collect()
    assert len(out) == len(rows) and all(0 <= r["rate"] <= most for r in out)
    got = {r["doc_id"]: r for r in out}
    names, priors, table = mixing.fit(frame, labels, mixing.label_domain())
    for i, text in rows:
        found = [w for w in (text or "").lower().split(" ") if w]
        assert got[i]["n_tokens"] == -(-len((text or "").encode()) // 4)
        signed = [(x := xxhash.xxh64_intdigest(w, 42)) - (x >> 63 << 64) for w in found]
        scores = [p + sum(row[h % mixing.BUCKETS] - table[0][h % mixing.BUCKETS] for h in signed) / max(1, len(found)) ** 0.5 for p, row in zip(priors, table)]
        odds = np.exp(np.array(scores) - max(scores))
        assert got[i]["p"] == pytest.approx((odds / odds.sum()).tolist(), abs=1e-6)
    n, p = np.array([r["n_tokens"] for r in out], float), np.array([r["p"] for r in out])
    rates, wanted = solved_rates(n, p, [targets.get(d, 0) for d in names], most)
    assert [r["rate"] for r, x in zip(out, n) if x] == pytest.approx(rates[n > 0].tolist(), abs=0.03)
    assert out[0]["wanted"] == pytest.approx(wanted.tolist(), rel=1e-6)
    assert out[0]["reached"] == pytest.approx(((n * [r["rate"] for r in out]) @ p).tolist(), rel=1e-6, abs=1e-3)
    kept = mixing.keep_mixed(frame, labels, mixing.label_domain(), targets)
    assert kept.columns == frame.columns and 0 < kept.count() < len(rows)
    assert mixing.mix(frame, frame, labels.limit(0), mixing.label_domain(), {"good": 1}).where("rate = 1").count() == len(rows)
    assert mixing.mix(frame.limit(0), frame, labels, mixing.label_domain(), {"good": 1}).count() == 0


def test_mixing_says_when_it_does_not_settle(spark):
    rows = spark.createDataFrame([(1, 10, [0.6, 0.4]), (2, 30, [0.1, 0.9])], "doc_id long, n_tokens long, p array<double>")
    with pytest.raises(RuntimeError):
        mixing.solve_rates(rows, [0.9, 0.1], steps=2)


def test_rate_steps_have_small_plans(spark, monkeypatch):
    """A step names the one before: with all of them spelt out, plans of 16,000 characters filled the driver's memory."""
    rng, sizes = random.Random(2), []
    rows = [(k, rng.randrange(1, 500), [x := rng.random(), (1 - x) * (y := rng.random()), (1 - x) * (1 - y)]) for k in range(300)]
    frame = spark.createDataFrame(rows, "k int, n_tokens long, p array<double>")
    agg = type(frame).agg

    def spy(self, *columns):
        out = agg(self, *columns)
        sizes.append(len(out._jdf.queryExecution().optimizedPlan().toString()))
        return out

    monkeypatch.setattr(type(frame), "agg", spy)
    found, _, reached = mixing.solve_rates(frame, [0.9, 0.1, 0.0], most=1.0)
    assert len(sizes) > mixing.STEPS_A_WRITE + 2 and max(sizes) < 5000
    assert found.columns == [*frame.columns, "rate"]
    assert reached == pytest.approx([sum(r["n_tokens"] * r["p"][d] * r["rate"] for r in found.collect()) for d in range(3)])


# 9


def test_near_duplicates_against_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(30, 16))
    x = np.concatenate([base, base[:5].repeat(12, 0) + rng.normal(size=(60, 16)) * 0.12, base[:2].repeat(6, 0), rng.normal(size=(200, 16))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("inf")] * 16), (903, [1.0]), (904, [])]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<double>, v string")
    got = {r["vec_id"]: r for r in hnsw.near_duplicates(frame, shard_rows=90).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    label = brute_groups(range(len(x)), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])
    assert [got[i]["n_links"] for i in range(len(x))] == (near.sum(axis=1) - 1).tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == [label[i] for i in range(len(x))]
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] and got[i]["component_id"] == i for i in (900, 901, 902, 903, 904))
    assert hnsw.near_duplicates(frame.limit(0)).count() == 0
    assert {r["recall"] for r in got.values()} == {1.0}


def test_audits_are_never_empty():
    rng = np.random.default_rng(6)
    rows = hnsw.unit_rows(rng.normal(size=(900, 24)))
    graph = hnsw.Graph(rows)
    width, _, recall, audited = hnsw.tune(hnsw.unit_rows(rng.normal(size=(50, 24))), graph, rows, 0.9)
    assert width and recall >= hnsw.RECALL and audited >= hnsw.PLANTED
    blind = hnsw.Graph(rows)
    blind.layers = [np.full_like(x, -1) for x in blind.layers]
    assert hnsw.tune(rows[:40], blind, rows, 0.9)[0] == 0, "a graph without edges is left for brute force"
    found = {(a, b) for u, v in hnsw.links_of(rows[:40], blind, rows, 0.9, 0, 0.1) for a, b in zip(u.tolist(), v.tolist())}
    assert found == {(i, i) for i in range(40)}


# 10


def test_code_length_is_exact():
    sample = {"a": [b"abracadabra", b"abba"], "b": [b"xyzzy xyz"], "c": [b"a"]}
    model = ppm.Model(sample, 2)
    for lang in sample:
        # Followers of every context, counted apart from the model.
        seen: dict = {}
        for text in sample[lang]:
            padded = b"\0\0" + text
            for i in range(2, len(padded)):
                for k in range(3):
                    seen.setdefault(padded[i - k : i], {}).setdefault(padded[i], 0)
                    seen[padded[i - k : i]][padded[i]] += 1
        for text in (b"abra", b"xyq", b"", b"\xff\x00a"):
            padded, bits = b"\0\0" + text, 0.0
            for i in range(2, len(padded)):
                gone: set = set()
                for k in (2, 1, 0):
                    here = seen.get(padded[i - k : i])
                    if here is None:
                        continue
                    total = sum(n for s, n in here.items() if s not in gone) + len(here)
                    if padded[i] in here:
                        bits -= np.log2(here[padded[i]] / total)
                        break
                    bits -= np.log2(len(here) / total)
                    gone = set(here)
                else:
                    bits += np.log2(256 - len(gone))
            assert model.bits([text])[0, model.langs.index(lang)] == pytest.approx(bits, abs=1e-3)


def test_language_accuracy_and_edges(spark):
    rows = docs(spark)
    model = ppm.train_on(rows)
    found = ppm.identify(rows, model).join(rows.select("doc_id", "lang"), "doc_id").where(ppm.held_out())
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.95
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in ppm.identify(odd(spark), model).collect()]
    assert len(got) == len(ODD) and all(p == "und" and s == 0 for i, p, s in got if i in (1, 2, 3)) and all(0 <= s <= 1 for _, _, s in got)
    assert ppm.identify(odd(spark), ppm.Model({})).where("lang_pred <> 'und'").count() == 0
    assert ppm.identify(odd(spark).limit(0), model).count() == 0
    assert ppm.keep_identified(odd(spark), model).columns == odd(spark).columns
    long = b"the " * 200000
    assert model.bits([long])[0].min() == pytest.approx(sum(model.bits([long[:400000], long[400000:]])).min(), rel=1e-3)


# Pipeline


def test_pipeline_against_its_steps(spark):
    import corpus_pipeline

    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    source = {r["doc_id"]: r["text"] for r in docs(spark).collect()}
    assert 0 < len(out) < len(source)
    prints = [brute_print(source[i]) for i in out]
    assert all((a ^ b).bit_count() > 2 for k, a in enumerate(prints) for b in prints[:k])
    pieces = piece_scan.Pieces(token_counts.vocabulary(piece_scan.MODEL))
    for i, r in out.items():
        assert np.frombuffer(r["ids"], "<u4").tolist() == pieces.sp.encode(source[i])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs(spark), SF).columns == docs(spark).columns


def test_pipeline_of_odd_rows(spark):
    """Null ids and texts, repeats and clashing names pass through; an empty table gives an empty result."""
    import corpus_pipeline

    source = docs(spark)
    clash = {n: F.lit(7) for n in ("_t", "_id", "n", "ids", "p", "rate", "kept", "n_tokens", "component", "fp", "score", "lang_pred", "n_pieces")}
    more = [(i, t) for i, t in ODD if i is not None] + [(None, "no id, but a text of several english words"), (None, None)]
    odd_rows = spark.createDataFrame([(None if i is None else i + 10**6, t) for i, t in more], "doc_id long, text string")
    rows = source.unionByName(odd_rows, allowMissingColumns=True).withColumns(clash)
    folder = scratch(spark, "odd")
    rows.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    stage_rows = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, stage_rows, folder).columns == rows.columns
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "n_pieces", "ids"]
    got = [r["doc_id"] for r in out.collect()]
    dropped = {10**6 + i for i in (1, 2, 3)}  # no letters
    assert not dropped & set(got) and len({10**6 + 6, 10**6 + 7} & set(got)) <= 1
    assert len(got) > 0.5 * source.count()
    empty = scratch(spark, "empty")
    source.limit(0).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
