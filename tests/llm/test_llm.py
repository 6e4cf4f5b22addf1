"""Each operator against its contract restated the plain way, on small tables with the awkward rows."""

import hashlib
import math
import os
import re

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martwright.llm import chat, licences, mixing, neighbours, packing, pages, quality, simhash, substrings, wavelet
from martwright.llm.common import components, word_count
from martwright.llm.tokens import Encoder, encoder, forget_encoder, vocabulary

TINY = "/root/testdata/sf0.001"
DDL = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "b", 0),
    (3, " \t\n", "en", "", 3),
    (4, LONG, "en", "a", 0),
    (5, LONG, "en", "a", 0),
    (6, f"one two {PASSAGE} three", "en", "c", 0),
    (7, f"four {PASSAGE} five six {PASSAGE}", "en", None, 0),
    (8, "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a", "en", "c", 0),
    (9, "Three Words only", "en", "c", 0),
    (10, "three words ONLY", "en", "c", 0),
    (11, "é ß   x  y\r\nz </s> <|endoftext|> # # 12,5", "en", "d", 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{TINY}/documents.parquet").where("doc_id < 120")
    odd = spark.createDataFrame([(1000 + i, *rest) for i, *rest in ODD], DDL)
    return real.select("doc_id", "text", "lang", "source", "n_chars").union(odd).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DDL)


def test_mix_takes_what_the_targets_say(docs, texts, empty):
    rows = mixing.mix(docs.withColumn("size", word_count(F.col("text"))).withColumn("copies", F.lit("clash"))).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    sizes = {}
    for r in rows:
        assert r["size"] == len(brute.words(texts[r["doc_id"]])) and 0 <= r["copies"] <= 2
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    wanted = brute.targets(sizes)
    for source, target in wanted.items():
        mine = [r for r in rows if r["source"] == source]
        assert all(math.isclose(r["target"], target, rel_tol=1e-9, abs_tol=1e-9) for r in mine)
        taken = sum(r["copies"] * r["size"] for r in mine)
        assert abs(taken - target) <= 1.5 * max(r["size"] for r in mine) + 1
    assert mixing.mix(empty.withColumn("size", F.lit(0).cast("long"))).isEmpty()


def test_targets_share_the_excess_again(spark):
    for sizes in ({"a": 10, "b": 1, "c": 1000, None: 5}, {"a": 0}, {"x": 7}, {s: 3 ** i for i, s in enumerate("abcdefg")}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        want = brute.targets(sizes)
        assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in sizes)


def test_embedding_links(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    rows = [(i, (base[i % 40] + rng.normal(size=16) * 0.12 * (i % 3)).tolist(), i % 2) for i in range(240)]
    rows += [(500 + i, rows[0][1], 0) for i in range(30)]
    odd = [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1.0, 2.0]]
    rows += [(700 + i, v, 0) for i, v in enumerate(odd)] + [(800, rows[0][1], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r[0]: tuple(r)[1:] for r in neighbours.near_duplicates(df, leaf=40, block=24).collect()}
    valid = {i: (np.array(v), k) for i, v, k in rows if k is not None and v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)}
    pairs = [
        (a, b)
        for a, (x, k) in valid.items()
        for b, (y, m) in valid.items()
        if a < b and k == m and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93
    ]
    count = dict.fromkeys((r[0] for r in rows), 0)
    for a, b in pairs:
        count[a] += 1
        count[b] += 1
    assert all(got[i][0] <= n for i, n in count.items())
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(count.values())
    roots = brute.roots(list(count), pairs)
    assert sum(got[i][1] == roots[i] for i in roots) >= 0.97 * len(roots)
    assert all(got[i][2] == (got[i][1] == i) for i in got)
    assert neighbours.near_duplicates(df.where("false")).isEmpty()


def test_components_of_a_path_a_hub_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute.roots({n for e in edges for n in e}, edges)
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="site-header"><a href="/">Home</a> Our site</header><nav><ul><li><a href=1>One</a><li><a href=2>Two</a></ul></nav>
<div id="cookie-notice">We use cookies. Accept them all now please.</div>
<div class="post-content"><h1>The &amp; title</h1><p>First   para<b>graph</b> of
text &eacute;&#8211;x.<p>Short.<div class="ad">Buy this now for little money.</div><p>Second paragraph goes on.</p>
<script>var t="</p><p>no</p>";</script><form>Name <input> <button>Send</button></form><!-- <p>no</p> --></div>
<aside class=sidebar><p>Related things to read here today.</p></aside>
<section id="comments"><p>I think this is a very good article indeed.</p></section>
<footer><p>&copy; 2020 Us, all rights reserved.</p></footer></body></html>"""


def test_page_text(spark):
    want = "The & title First paragraph of text é–x. Short. Second paragraph goes on."
    assert pages.main_text(PAGE) == want
    assert pages.main_text("<p>") == pages.main_text(None) == pages.main_text("") == ""
    rows = [(1, "u", PAGE, "clash"), (1, "u", PAGE, "clash"), (2, None, None, None), (3, "v", "<article><p>" + "word " * 200_000 + "</article>", "c")]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r["page_id"], r["n_chars"]) for r in got) == [(1, len(want)), (1, len(want)), (2, 0), (3, 999_999)]


def test_page_text_in_wrappers_links_and_lists():
    story = "The first paragraph of the story goes on for quite a few plain words."
    body = f"<p>{story}</p><p>{story}</p>"
    want = f"{story} {story}"
    for wrapper in ("layout has-sidebar", "page with-header", "no-comments", "layout sidebar-left", "header-fixed"):
        assert pages.main_text(f'<div class="{wrapper}"><article>{body}</article></div>') == want, wrapper
        assert pages.main_text(f'<div class="{wrapper}"><main>{body}</main></div>') == want, wrapper
    assert pages.main_text(f'<form id="all"><article>{body}</article></form>') == want
    assert pages.main_text(f'<div class="layout has-sidebar"><div class="content">{body}</div></div>') == want
    for part in ('<div class="comment-list">', '<div class="sidebar">', '<div class="related-posts">', "<aside>", "<footer>"):
        assert pages.main_text(f"{part}<article>{body}</article>") == "", part
    link = '<article><p>See <a title="the hidden cost of x">this long report</a> on what all of it costs us.</p></article>'
    assert pages.main_text(link) == "See this long report on what all of it costs us."
    assert pages.main_text(f'<article><section data-title="a hidden gem here">{body}</section></article>') == want
    for mark in ("hidden", 'hidden=""', "hidden=hidden", 'class="x" hidden id=y'):
        assert pages.main_text(f"<article><div {mark}>{body}</div></article>") == ""
    items = "<p>The duty covers these:</p><ul><li>(a) the first tax;<li>(b) the second tax;<li>(c) any other tax;</ul>"
    got = pages.main_text(f"<article>{items}</article>")
    assert got == "The duty covers these: (a) the first tax; (b) the second tax; (c) any other tax;"
    for end in ("(c) 2020 Us", "(c) Acme Media, 2021.", "(c) Acme Inc.", "(c) Copyright by us", "© Us"):
        assert pages.main_text(f"<article>{body}<div>{end}</div></article>") == want, end


def test_min_cut_is_minimal():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(1, 9))
        terminals = rng.normal(size=n).round(2).tolist()
        edges = {(i, j): float(rng.random().__round__(2)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}

        def cost(labels):
            return sum(abs(t) for t, x in zip(terminals, labels) if (t > 0) != x) + sum(w for (i, j), w in edges.items() if labels[i] != labels[j])

        best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(2**n))
        assert math.isclose(cost(pages.min_cut(terminals, edges)), best, abs_tol=1e-7)


def test_simhash(docs, texts, empty):
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    fps = {i: brute.simhash(t) for i, t in texts.items()}
    assert {i: r["fp"] % 2**64 for i, r in got.items()} == fps
    assert {i: r["component_id"] for i, r in got.items()} == brute.simhash_components(fps)
    assert simhash.near_duplicates(empty).isEmpty()


@pytest.mark.parametrize("shared", [2, 3, 4])
@pytest.mark.parametrize("block", [8, 4096])
def test_simhash_links_connect_all_close_fingerprints(spark, shared, block):
    rng = np.random.default_rng(1)
    fps = {int(rng.integers(2**63))}
    while len(fps) < 150:
        x = rng.choice(sorted(fps)).item()
        fps.add(x ^ sum(1 << int(b) for b in rng.integers(0, 62, int(rng.integers(1, 12)))))
    rows = [(f, i) for i, f in enumerate(sorted(fps))]
    links = simhash.near_links(spark.createDataFrame(rows, "fp long, rep long"), shared, block)
    found = {r["node"]: r["root"] for r in components(links).collect()}
    assert {i: found.get(i, i) for _, i in rows} == brute.simhash_components({i: f for f, i in rows})


def test_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e", "x"), (1, "f g h i j", "x"), (2, "f g h i j", "y"), (None, "a b c d e", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted(((r["doc_id"] or -1), r["component_id"]) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, None), (1, 1), (1, 1), (2, 1)]
    kept = simhash.one_row_per_id(df).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept) == [(-1, "a b c d e"), (1, "a b c d e"), (2, "f g h i j")]


def test_quality(docs, texts, empty):
    rows = quality.score(docs.withColumn("kept", F.lit("clash"))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute.quality(texts[r["doc_id"]])
        text = (texts[r["doc_id"]] or "").encode()
        assert r["kept"] == (not r["base_failed"] and not any(f(text, quality.counts(text)) for f in quality.RULES.values()))
    assert quality.score(empty).isEmpty()
    order = quality.cascade({"slow": (1.0, 0.5), "quick": (0.1, 0.5), "idle": (0.01, 0.0)})
    assert order == ["quick", "slow", "idle"]


def test_substrings(docs, texts, empty):
    got = {r["doc_id"]: tuple(r)[1:] for r in substrings.without_repeats(docs, digest=True).collect()}
    want = brute.without_repeats(texts)
    assert got == want
    spans = substrings.repeated_spans(docs)
    assert not spans.isEmpty() and substrings.verify_spans(spans, docs).isEmpty()
    rows = {r["doc_id"]: r for r in substrings.without_repeats(docs).collect()}
    for i, text in texts.items():
        if want[i][1]:
            assert hashlib.sha256(rows[i]["text"].encode()).hexdigest() == want[i][2] and rows[i]["n_chars"] == len(rows[i]["text"])
        else:
            assert rows[i]["text"] == text
    assert substrings.without_repeats(empty, digest=True).isEmpty()


def test_substrings_of_repeated_ids_and_clashing_names(spark):
    first, second, other = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("p", 40), ("q", 30), ("r", 60)))
    rows = [(1, first), (2, first), (2, other), (2, other), (3, f"{other} {second}"), (None, first), (4, None), (4, second)]
    clash = "row int, at int, spans string, repeats string, doc string, of_doc string, n_chars int"
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.selectExpr("*", *(f"CAST(7 AS {x.split()[1]}) AS {x.split()[0]}" for x in clash.split(", ")))
    got = substrings.without_repeats(df)
    assert got.schema == df.schema
    kept = sorted(((r["doc_id"] or -1, r["text"] or "") for r in got.collect()))
    assert {tuple(r)[2:8] for r in got.collect()} == {(7, 7, "7", "7", "7", "7")}
    # the two rows of id 2 that agree are one document and keep its text; second is first met in document 3
    assert kept == sorted([(1, first), (2, ""), (2, other), (2, other), (3, second), (-1, first), (4, ""), (4, "")])
    assert {r["n_chars"] for r in got.where("doc_id IS NULL OR doc_id = 1").collect()} == {7}
    digests = substrings.without_repeats(df, digest=True).where("doc_id = 2").collect()
    assert sorted((r["n_words"], r["n_removed"]) for r in digests) == [(40, 40), (60, 0), (60, 0)]


def test_substrings_removes_only_words_that_agree(spark, monkeypatch):
    """A span that hashes alone would give stays, if its words differ."""
    a, b = (" ".join(f"{x}{i}" for i in range(50)) for x in "ab")
    spans = spark.createDataFrame([(2, 0, 0, 50, 1, 0, 0)], "doc_id long, row long, at int, end int, from_doc long, from_row long, from_at int")
    monkeypatch.setattr(substrings, "_repeats", lambda texts: spans)
    df = spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")
    assert {tuple(r) for r in substrings.without_repeats(df).collect()} == {(1, a), (2, b)}
    df = spark.createDataFrame([(1, a), (2, a)], "doc_id long, text string")
    assert {tuple(r) for r in substrings.without_repeats(df).collect()} == {(1, a), (2, "")}


def _ids(texts, name, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(name))
    return {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, end] for i, t in texts.items()}


@pytest.mark.parametrize("name, glued", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_equals_the_library(texts, name, glued):
    odd = ["", " ", "a", "a  b", "a\n", "\n", "a\n\nb c d", " a b", "a b ", "a \nb c d", "x é́ ý ́q r", "İ ΑΣ foo K", "don't 'll 12,345. b c", "a\x1c b c <|endoftext|> z", "x !. y. z, w  v q"]
    odd += [f"k {x} m" for x in odd]
    wanted = dict(enumerate([*odd, *texts.values()]))
    got = Encoder(vocabulary(name), glued).encode(list(wanted.values()))
    assert [g.tolist() for g in got] == [i[:-1] for i in _ids(wanted, name, 0).values()]


@pytest.mark.parametrize("name, glued", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_pieces_met_again_outlast_a_full_table(name, glued, monkeypatch):
    """A word of every text is learned once, however often the table of pieces fills up."""
    path, learned = vocabulary(name), []
    of = Encoder(path, glued)
    of.remember, together = 20, of._learn_together
    monkeypatch.setattr(of, "_learn_together", lambda pieces: learned.extend(pieces) or together(pieces))
    texts = [f"start common {' '.join(f'w{k}x{i}' for i in range(12))} common, end" for k in range(30)]
    got = [of.encode([t])[0].tolist() for t in texts]
    assert got == [i[:-1] for i in _ids(dict(enumerate(texts)), name, 0).values()]
    assert learned.count("common") == 1 and len(of.known) + len(of.older) < 60


@pytest.mark.parametrize(("name", "glued"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_learning_looks_older_pieces_up_and_does_not_walk_them(name, glued):
    class Unwalked(dict):
        def __iter__(self):
            raise AssertionError("all older pieces were read")

    of = Encoder(vocabulary(name), glued)
    of.encode(["a one two, three. é"])
    of.older, of.known = Unwalked(of.known), {}
    texts = ["a two three. \n\t four, four. ß. one!! é, x"]
    whole = of.tokenizer.encode(texts[0], add_special_tokens=False).ids
    assert [x.tolist() for x in of.encode(texts)] == [whole]


def test_an_encoder_is_given_back():
    path = vocabulary("word_bpe_49k.json")
    held = encoder(path, False)
    assert encoder(path, False) is held
    forget_encoder(path, False)
    forget_encoder(path, False)
    assert encoder(path, False) is not held


def test_packing(docs, texts, empty):
    rows = [tuple(r) for r in packing.pack_documents(docs, task_pieces=60).collect()]
    ids = _ids(texts, "byte_bpe_50k.json", 0)
    used = brute.check_packing(rows, ids)
    sizes = np.array([r[3] for r in rows])
    assert packing.lower_bound(sizes) <= used <= packing.lower_bound(sizes) + 3
    assert packing.pack_documents(empty).isEmpty()


def test_lower_bound_never_exceeds_a_packing():
    rng = np.random.default_rng(2)
    for _ in range(50):
        sizes = rng.integers(1, 101, int(rng.integers(1, 60)))
        bins, offsets = packing.best_fit(sizes, 100)
        assert np.bincount(bins, sizes).max() <= 100
        assert packing.lower_bound(sizes, 100) <= bins.max() + 1
    assert packing.lower_bound(np.array([51] * 7), 100) == 7


@pytest.mark.parametrize("seed", range(3))
def test_word_encoder_on_odd_characters(seed):
    """Capitals whose lower case ends in a mark, composed letters, controls, blanks of many kinds."""
    import random

    from tokenizers import Tokenizer

    path, draw = vocabulary("word_bpe_49k.json"), random.Random(seed)
    odd = [*"aBz09.,' \n\t\r\x0b\x1c\x00\x7f<>/ \xa0\u2028", *"\u0130\u00e9e\u0301\u00df\u4e2d\u0958\U0001f600", "'s", "</w>", "<unk>"]
    texts = ["".join(draw.choices(odd, k=draw.randrange(60))) for _ in range(2000)]
    texts += ["\u0130, \u0130.", "\u0958, \u0958.", "plain words, and more.", None, ""]
    library = Tokenizer.from_file(path)
    got = Encoder(path, False).encode(texts)
    for text, ids in zip(texts, got):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_words_are_learned_without_what_stands_around_them(monkeypatch):
    """A word is learned once, whatever signs and digits follow it, also in a later call; in parts, as in one."""
    from tokenizers import Tokenizer

    from martwright.llm import tokens

    path, learned = vocabulary("word_bpe_49k.json"), []
    monkeypatch.setattr(tokens, "TOGETHER", 3)
    of = Encoder(path, False)
    together = of._learn_together
    monkeypatch.setattr(of, "_learn_together", lambda pieces: learned.extend(pieces) or together(pieces))
    texts = ["zebrine zebrine, zebrine. Zebrine### zebrine'll zebrine7 (zebrine)", None, "", "z\u00e9brine ZEBRINE!? <|endoftext|>"]
    texts += ["zebrine&&& it's na\u00efve, \u00c9t\u00e9 \u5b57 \ua7dca\ua7dc x\u0301,", "\n \n", "zebrine;\tzebrine"]
    library = Tokenizer.from_file(path)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for calls in ([texts], [[t] for t in texts]):
        assert [x.tolist() for part in calls for x in of.encode(part)] == want
    assert learned.count("zebrine") == 1 and not any("zebrine" in p and p[-1] in ".,#&7!" for p in learned)
    column = pa.array(["left out", *texts, "left out"]).slice(1, len(texts))
    assert [np.frombuffer(x, "<u2").tolist() for x in of.encode_words(column).to_pylist()] == want


def test_each_index_file_is_a_page(spark):
    """Parquet looks at the size of a page once in a hundred rows, unless told not to; each row holds a file."""
    docs = spark.createDataFrame([(1, "the " * 600_000)] * 3, "doc_id long, text string")
    files = wavelet.write_index(docs)
    hadoop, parquet = spark._jvm.org.apache.hadoop.fs, spark._jvm.org.apache.parquet.hadoop
    pages = 0
    for path in files.inputFiles():
        file = parquet.util.HadoopInputFile.fromPath(hadoop.Path(path), spark._jsc.hadoopConfiguration())
        reader = parquet.ParquetFileReader.open(file)
        for block in reader.getFooter().getBlocks():
            pages += reader.readOffsetIndex(block.getColumns()[3]).getPageCount()
        reader.close()
    assert pages == files.count() == 3


def test_wavelet_index(docs, texts, empty):
    ids, at = _ids(texts, "word_bpe_49k.json", 2), 0
    got = {r["doc_id"]: tuple(r)[1:] for r in wavelet.read_index(wavelet.write_index(docs, file_ids=5000)).collect()}
    assert len(got) == len(ids)
    for i in sorted(ids):
        assert got[i] == (at, len(ids[i]), brute.crc32(ids[i]))
        at += len(ids[i])
    assert wavelet.read_index(wavelet.write_index(empty)).isEmpty()


def test_planes_are_parted_in_blocks(monkeypatch):
    monkeypatch.setattr(wavelet, "MOVED", 7)
    rng = np.random.default_rng(4)
    for n in (0, 1, 6, 7, 8, 700):
        ids = rng.integers(0, 49_408, n).astype("<u2")
        now, matrix = ids, wavelet.WaveletMatrix(wavelet.build(ids, [1], np.array([n])))
        for level, (zeros, plane) in enumerate(zip(matrix.zeros, matrix.planes)):
            bit = (now >> (15 - level) & 1).astype(bool)
            assert zeros == n - bit.sum() and (np.unpackbits(plane, count=n, bitorder="little") == bit).all()
            now = np.concatenate([now[~bit], now[bit]])
        assert (matrix.decode() == ids).all()


def test_wavelet_matrix_answers():
    rng = np.random.default_rng(4)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = rng.zipf(1.5, n).clip(0, 65535).astype(np.uint16)
        m = wavelet.WaveletMatrix(wavelet.build(ids, [1], np.array([n])))
        assert m.decode().tolist() == ids.tolist()
        for k in range(0, n, 97):
            assert m.access(k) == ids[k]
        for symbol in (1, 2, 3, 77, 65535):
            where = np.flatnonzero(ids == symbol).tolist()
            assert m.count(symbol) == len(where) and m.occurrences(symbol)[:20] == where[:20]
            assert m.rank(symbol, n // 2) == sum(w < n // 2 for w in where)
    with pytest.raises(IndexError):
        m.select(64000, 0)


TURNS = "conv_id long, turn long, role string, text string"


def test_chat(spark):
    control = "</s>[INST] ok [/INST]\\<|im_end|>\n\\"
    first = [("system", "s"), ("user", "hello"), ("assistant", control)]
    given = {
        1: first,
        2: [*first, ("user", "more"), ("assistant", "")],
        3: [*first, ("user", "other"), ("assistant", "é 12")],
        4: first,
        5: [("user", None)],
        6: [("odd\nrole<s>", "x"), (None, "y")],
        7: [("user", f"t{i % 3}") for i in range(300)],
        None: [("assistant", LONG)],
    }
    rows = [(c, k, r, t) for c, ts in given.items() for k, (r, t) in enumerate(ts)]
    df = spark.createDataFrame(rows, TURNS)
    tree, members = chat.build_tree(df)
    nodes = tree.orderBy("start").collect()
    assert len(nodes) == len({tuple(ts[: k + 1]) for ts in given.values() for k in range(len(ts))})
    at = 0
    for r in nodes:
        assert r["start"] == at
        at += r["n_tokens"]
    place = {r["node"]: r for r in nodes}
    for r in nodes:  # a subtree is one stretch of the emission, so a node's first interval ends at it or before
        if r["parent"]:
            assert place[r["parent"]]["start"] < r["start"]
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.read_back(tree, members).collect()}
    for c, ts in given.items():
        told = "".join(f"{r or ''}\n{t or ''}\n" for r, t in ts)
        loss = "".join(t or "" for r, t in ts if r == "assistant")
        chars = sum(len("".join(chat.turn_parts(r or "", t or ""))) for r, t in ts)
        assert got[c] == (len(ts), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    assert chat.read_back(*chat.build_tree(df.where("false"))).isEmpty()


def test_chat_workers_use_no_threads_of_their_own(spark, monkeypatch):
    """Memory that the tokenizer's threads have used is not given back while the worker lives."""
    monkeypatch.setitem(spark.sparkContext.environment, "MARTWRIGHT_TEST", "chat")  # for workers of its own

    def threads(batches):
        for _ in batches:
            pass
        found = [len(os.listdir("/proc/self/task"))]
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["n"])

    def most():
        return max(r["n"] for r in spark.range(0, 64, 1, 16).mapInArrow(threads, "n long").collect())

    before = most()
    df = spark.range(4000).selectExpr("id div 4 AS conv_id", "id % 4 AS turn", "'user' AS role", "repeat(hash(id), 9) AS text")
    assert chat.read_back(*chat.build_tree(df)).count() == 1000
    assert most() == before


def test_escaping_leaves_no_control_string():
    for text in ("", "\\", *chat.CONTROLS, "".join(chat.CONTROLS) * 2, "[\\INST]", "<<s>", "\\<s>\\\\"):
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in chat.CONTROLS)
        assert chat.parse_turn("".join(chat.turn_parts(text, text))) == (text, text)


def test_licences(spark):
    rows = [
        ("a/LICENSE", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
        ("a/b/c/x.py", "# code\nimport x"),
        ("a/b/LICENSE", "Released under the MIT License.\nLicensed under the Apache License, Version 2.0."),
        ("a/b/y.py", "// Licensed under CC BY-NC 4.0.\nrest"),
        ("z/q.py", None),
        ("top.py", ""),
        (None, "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/c/x.py", "# code\nimport x"),
        ("m/" + "d/" * 50 + "f", "a license to say nothing " + LONG),
    ]
    df = spark.createDataFrame(rows, "path string, text string").withColumn("license", F.lit("clash"))
    found = licences.inherit(df)
    names = ["path", "own_license", "license", "inherited_from"]
    assert brute.multiset(found.select(*names).collect()) == brute.multiset(
        [
            ("a/LICENSE", "MIT", "MIT", None),
            ("a/b/LICENSE", "Apache-2.0", "Apache-2.0", None),
            ("a/b/c/x.py", None, "Apache-2.0", "a/b"),
            ("a/b/c/x.py", None, "Apache-2.0", "a/b"),
            ("a/b/y.py", "CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
            ("z/q.py", None, None, None),
            ("top.py", None, None, None),
            (None, "GPL-3.0", "GPL-3.0", None),
            ("m/" + "d/" * 50 + "f", None, None, None),
        ]
    )
    plan = found._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert licences.inherit(df.where("false")).isEmpty()


HEADERS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Apache-2.0": """Copyright 2020 The Authors

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0""",
}


def test_wrapped_licence_headers_above_code(spark):
    code = "\n".join(f"value_{i} = compute(alpha_{i}, beta_{i % 7})  # step {i}" for i in range(60))
    wrap = {
        "hash": lambda h: "\n".join(f"# {x}" for x in h.split("\n")),
        "star": lambda h: "/*\n" + "\n".join(f" * {x}" for x in h.split("\n")) + "\n */",
        "plain": lambda h: h,
        "rem": lambda h: "\r\n".join(f"REM {x}" for x in h.split("\n")),
    }
    rows = [(f"{n}/{w}/COPYING.py", f(h) + "\n" + code) for n, h in HEADERS.items() for w, f in wrap.items()]
    rows += [(f"{n}/{w}/sub/x.py", code) for n in HEADERS for w in wrap] + [("none/x.py", code)]
    df = spark.createDataFrame(rows, "path string, text string")
    got = {r["path"]: (r["license"], r["inherited_from"]) for r in licences.inherit(df).collect()}
    for n in HEADERS:
        for w in wrap:
            assert got[f"{n}/{w}/COPYING.py"] == (n, None)
            assert got[f"{n}/{w}/sub/x.py"] == (n, f"{n}/{w}")
    assert got["none/x.py"] == (None, None)


def test_pipeline_stages_keep_columns_and_clean_documents(spark, docs, texts, tmp_path):
    import corpus_pipeline

    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        now = spark.createDataFrame(now.collect(), docs.schema)
        seen[name] = [r.asDict() for r in now.collect()]
    good = {i for i, t in texts.items() if not quality.counts((t or "").encode()).base_failed}
    kept = {r["doc_id"] for r in seen["quality_rules"]}
    assert kept <= good
    fps = brute.simhash_components({i: brute.simhash(texts[i]) for i in kept})
    left = {r["doc_id"] for r in seen["simhash_near_dedup"]}
    assert left == {i for i in kept if fps[i] == i}
    want = brute.without_repeats({i: texts[i] for i in left})
    for r in seen["substring_dedup"]:
        assert len(brute.words(r["text"])) == want[r["doc_id"]][0] - want[r["doc_id"]][1]
    taken = [r["doc_id"] for r in seen["mix_sources"]]
    assert set(taken) <= left and max(map(taken.count, taken)) <= 2
    rows = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sum(r[1] == 0 for r in rows) == len(taken)


def test_pipeline_stages_keep_clashing_columns_and_repeated_ids(spark, tmp_path):
    import corpus_pipeline

    plain = [" ".join(f"{x}{i}word" for i in range(40)) + "." for x in ("alpha", "beta", "gamma")]
    rows = [(1, plain[0], "en", "a", 0), (1, plain[1], "en", "a", 0), (2, plain[0], "en", "b", 0), (2, plain[2], "en", "b", 0), (None, plain[0], "en", "b", 0)]
    names = ["kept", "size", "copies", "copy", "doc", "key", "target", "source_size", "n_words", "mix_rank", "row", "spans"]
    df = spark.createDataFrame(rows, DDL).select("*", *(F.lit(f"own {n}").alias(n) for n in names))
    wanted = {1: {plain[0], plain[1]}, 2: {plain[2]}, None: {plain[0]}}
    now = df
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = spark.createDataFrame(stage(spark, now, str(tmp_path)).collect(), df.schema)
        found = now.collect()
        assert now.columns == df.columns and all(r[n] == f"own {n}" for r in found for n in names), name
        got = {i: {r["text"] for r in found if r["doc_id"] == i} for i in wanted}
        if name in ("simhash_near_dedup", "substring_dedup"):
            assert got == wanted
        if name == "simhash_near_dedup":
            assert len(found) == 4
    nothing = spark.createDataFrame([], df.schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, nothing, str(tmp_path)).isEmpty(), name
