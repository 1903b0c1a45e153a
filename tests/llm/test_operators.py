"""The operators of staylens/llm on small frames, against brute-force versions."""

from __future__ import annotations

import hashlib
import random
import resource
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from staylens.llm import base, bpe, huffman, jaccard, mixing, pivots, projections, quality, repeats, texts, warc, wrappers
from staylens.llm.queries import ORACLES, QUERIES

public_tokenizers = pytest.importorskip("public_tokenizers")
regex = pytest.importorskip("regex")

LONG = "word " * 4_000
NAMES = "doc_id long, text string, source string, size int, block int, root int, id int"
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again and again until the evening comes down", "a", 1, 1, 1, 1),
    (2, "the quick brown fox jumps over the lazy dog again and again until the evening comes down", "a", 2, 1, 1, 1),
    (3, None, "b", 3, 1, 1, 1),
    (4, "", None, 4, 1, 1, 1),
    (5, LONG, "a", 5, 1, 1, 1),
    (6, "don't  stop\n\n'tis été 中文 🙂 123abc", "c", 6, 1, 1, 1),
    (6, "don't  stop\n\n'tis été 中文 🙂 123abc", "c", 6, 1, 1, 1),
    (7, "PREFIX the quick brown fox jumps over the lazy dog again and again until the evening comes SUFFIX", "b", 7, 1, 1, 1),
    (None, "two words", "b", None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, NAMES)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], NAMES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    found = duck.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(result.columns)
    expected = sorted(map(str, found.fetchall()))
    assert sorted(str(tuple(r)) for r in result.select(*columns).collect()) == expected


def test_pieces_are_the_patterns_matches():
    pattern = regex.compile(public_tokenizers.PATTERN)
    letters = list("ab1é '  '\n\tslrevdmtLL!.- 　中٣🙂ſ'")
    rng = random.Random(1)
    rows = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(2_000)] + [None]
    flat = texts.Texts(pa.array(rows, pa.string()))
    cuts, first = texts.pattern_pieces(flat)
    raw = flat.data.tobytes()
    pieces = [raw[a:b].decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for row, a, b in zip(rows, first[:-1], first[1:], strict=True):
        assert pattern.findall(row or "") == pieces[a:b]


def test_bpe_equals_tiktoken(docs, no_docs):
    tiktoken = pytest.importorskip("tiktoken")
    ranks = bpe.multi_ranks()
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = bpe.encode_decode(docs, ranks).collect()
    expected = Counter((r[0], tuple(encoding.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in ROWS)
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), bytes(r["decoded"])) for r in found) == expected
    assert bpe.encode_decode(no_docs, ranks).count() == 0


def test_bpe_keeps_entries_that_merging_misses(spark):
    tiktoken = pytest.importorskip("tiktoken")
    entries = [*(bytes([byte]) for byte in range(256)), b"ab", b"bc", b"abcd", b"bcd", b"xyz", b"abab"]
    ranks = {entry: rank for rank, entry in enumerate(entries)}
    assert bpe.last_pairs(ranks)[1].keys() == {b"abcd", b"xyz"}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    rows = ["abcd", "xyz", "bcd", "ababab", "a" * 300, *("".join(rng.choice("abcdxyz ") for _ in range(rng.randint(0, 30))) for _ in range(300))]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for row in bpe.encode_decode(docs, ranks).collect():
        assert np.frombuffer(row["ids"], "<u4").tolist() == encoding.encode_ordinary(rows[row["doc_id"]])
        assert bytes(row["decoded"]).decode() == rows[row["doc_id"]]


@pytest.mark.parametrize("kept", [0, 2_000, huffman.CACHED_BYTES])
def test_kept_and_forgotten_words_give_the_library_s_ids(monkeypatch, kept):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(huffman, "CACHED_BYTES", kept)
    encoder, library, rng = huffman.Encoder(path), Tokenizer.from_file(path), random.Random(4)
    letters = "abcdefgh ijklé中🙂'1 "
    for _ in range(12):
        rows = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(20)] + [None, "", "over the lazy dog"]
        ids, at = huffman.encode_texts(pa.array(rows), encoder)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [library.encode(t or "", add_special_tokens=False).ids for t in rows]
    assert (np.diff(encoder.keys.astype(object)) > 0).all()


def test_huffman_codes_are_optimal_and_decode():
    rng = np.random.default_rng(0)
    counts = np.zeros(300, np.int64)
    counts[:40] = np.cumsum(np.arange(1, 41) ** 6)
    lengths = huffman.code_lengths(counts)
    assert lengths.max() <= huffman.LONGEST and (2.0 ** -lengths[lengths > 0].astype(float)).sum() == 1
    ids = rng.integers(0, 40, 5_000)
    at = np.array([0, 0, 1, 1300, 1300, 5_000])
    words, word_at, points, point_at = huffman.pack(ids, at, lengths, huffman.canonical_codes(lengths))
    back = huffman.unpack(words, word_at, np.diff(at), points, point_at, huffman.decode_table(lengths))
    assert (back == ids).all()
    assert huffman.code_lengths(np.array([0, 9])).tolist() == [0, 1]


def test_token_files_round_trip(docs):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = tokenizers.Tokenizer.from_file(path)
    found = huffman.huffman_round_trip(docs, tokenizer=path, vocabulary=50_257).orderBy("start").collect()
    start = 0
    for row in found:
        assert row["start"] == start
        start += row["n_tokens"]
    expected = Counter((r[0], (*model.encode(r[1] or "", add_special_tokens=False).ids, 2)) for r in ROWS)
    assert Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in found) == expected
    ids = [r["doc_id"] for r in found if r["doc_id"] is not None]
    assert ids == sorted(ids)


def test_added_tokens_have_their_own_ids(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = tokenizers.Tokenizer.from_file(path)
    words = sorted({t.content for t in model.get_added_tokens_decoder().values()})
    rows = ["a<|endoftext|>b", "plain", None, "", "<|endof", "text|>", *words, *(f"x {w}{w} é" for w in words), "end"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string").coalesce(1)
    found = huffman.huffman_round_trip(docs, tokenizer=path, vocabulary=50_257).orderBy("doc_id").collect()
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in found] == [[*model.encode(t or "", add_special_tokens=False).ids, 2] for t in rows]
    assert found[0]["n_tokens"] == 4
    with pytest.raises(ValueError, match="16 bits"):
        huffman.huffman_round_trip(docs, tokenizer=path, vocabulary=65_537)


def test_mix_keeps_near_targets(spark, docs, no_docs):
    rows = [(i, " ".join(["w"] * (1 + i % 97)), "abc"[i % 3] if i % 11 else None) for i in range(6_000)]
    mixed = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    by_source = mixed.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most"))
    for row in by_source.collect():
        assert abs(row["taken"] - row["target"]) <= 200 and row["most"] <= 3
    assert mixing.mix_sources(docs).count() == len(ROWS) and mixing.mix_sources(no_docs).count() == 0


VECTORS = "vec_id long, embedding array<float>, score int"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(8).tolist(), 0) for i in range(400)]
    rows += [(500, rows[0][1], 0), (501, rows[0][1], 0), (502, None, 0), (503, [1.0, None] + [0.0] * 6, 0), (504, [float("nan")] * 8, 0), (505, [], 0), (506, [0.0] * 8, 0)]
    return spark.createDataFrame(rows, VECTORS), rows


def best(rows, query_ids, k, whole):
    use = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in rows if v and None not in v and np.isfinite(v).all()]
    use = [(i, np.floor(1024 * v) if whole else v) for i, v in use if whole or v.any()]
    out = {}
    for i, v in use:
        if i in query_ids:
            out[i] = [c for _, c in sorted((-float(w @ v), c) for c, w in use if c != i)][:k]
    return out


def test_pivot_search_is_exact(spark, vectors):
    frame, rows = vectors
    found = defaultdict(list)
    for r in pivots.top_k(frame.where("vec_id % 50 = 0"), frame, 7).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    assert dict(found) == best(rows, {i for i, _, _ in rows if i % 50 == 0}, 7, True)
    assert pivots.top_k(frame.limit(0), frame.limit(0), 7).count() == 0


def test_projected_search_recall(spark, vectors):
    frame, rows = vectors
    expected = best(rows, {i for i, _, _ in rows if i % 20 == 0}, 10, False)
    hits = sum(r["vec_id"] in expected[r["query_id"]] for r in projections.nearest(frame.where("vec_id % 20 = 0"), projections.build_index(frame), 10).collect())
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_repeats_equal_brute_force(docs, no_docs):
    first, expected = {}, {}
    raw = {r[0]: (r[1] or "").encode() for r in ROWS}
    for i in sorted(raw, key=lambda x: (x is None, x or 0)):
        for k in range(len(raw[i]) - 49):
            first.setdefault(raw[i][k : k + 50], i)
    for i, b in raw.items():
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            f = first[b[k : k + 50]]
            if f is not None and (i is None or f < i):
                gone[k : k + 50] = b"\1" * 50
        expected[i] = (len(b), bytes(x for x, g in zip(b, gone, strict=True) if not g))
    found = repeats.removed_spans(docs).collect()
    assert len(found) == len(ROWS)
    for r in found:
        assert (r["n_bytes"], bytes(r["kept"])) == expected[r["doc_id"]]
    assert repeats.removed_spans(no_docs).count() == 0


def test_hot_anchors_equal_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    line = "Licensed under the terms that stand in the file next to this one, without any warranty."
    rows = [(i, f"{rng.random()} {rng.random()} {line} {rng.random()} {rng.random()}"[rng.randrange(9) :]) for i in range(300)]
    rows += [(300 + i, text) for i, (_, text) in enumerate(rows[:20])] + [(400, line + line), (401, line[:60]), (402, "é" + line)]
    first, expected = {}, {}
    for i, text in rows:
        b = text.encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 49):
            if first.setdefault(b[k : k + 50], i) < i:
                gone[k : k + 50] = b"\1" * 50
        expected[i] = bytes(x for x, g in zip(b, gone, strict=True) if not g)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for places, blocks in ((256, 64), (4, 64), (256, 2), (1, 1)):
        monkeypatch.setattr(repeats, "HOT_PLACES", places)
        monkeypatch.setattr(repeats, "HOT_BLOCKS", blocks)
        met = spark.sparkContext.accumulator(0)
        merge = repeats.repeated_strings

        def counted(contents, least, met=met, merge=merge):
            met.add(len(contents))
            return merge(contents, least)

        with monkeypatch.context() as patch:
            patch.setattr(repeats, "repeated_strings", counted)
            assert {r["doc_id"]: bytes(r["kept"]) for r in repeats.removed_spans(docs).collect()} == expected
        # Anchors whose surroundings are the same everywhere need no sort.
        assert met.value > 0 if (places, blocks) == (256, 64) else met.value == 0 or places > 1


def test_kept_text_is_decoded_where_the_bytes_are(spark):
    """One Python step after the blocks are read, not two, and the text of the kept bytes: halves of characters go."""
    line = "a passage of more than fifty bytes that stands in several of these documents "
    rows = [(1, "é" + line + "x"), (2, "ñ" + line + "y"), (3, None), (None, line + "中"), (4, "Ã©" + line[:60] + "é" + line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeats.whole_characters(repeats.removed_spans(docs, whole=True))
    plain = repeats.removed_spans(docs).collect()
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    expected = [(r["doc_id"], bytes(r["kept"]).decode(errors="ignore")) for r in plain]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    assert sorted(map(tuple, repeats.whole_characters(repeats.removed_spans(docs)).collect()), key=str) == sorted(expected, key=str)


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def test_jaccard_tells_texts_of_one_id_apart(spark):
    """Two texts under one id: each row is linked by its own text, and both classes are named by the id."""
    a, b = (" ".join(f"{name}{i}" for i in range(40)) for name in "ab")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, a + " z"), (1, a)]
    found = sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == [(1, 1, 1), (1, 1, 3), (1, 1, 3), (2, 1, 3), (3, 1, 1), (4, 1, 3)]


def test_jaccard_equals_brute_force(spark, docs, no_docs):
    rng = random.Random(2)
    rows = []
    for group in range(30):
        words = [f"w{rng.randint(0, 500)}" for _ in range(rng.randint(3, 60))]
        for _ in range(rng.randint(1, 6)):
            copy = list(words)
            if rng.random() < 0.7:
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((len(rows), " ".join(copy)))
    sets = {i: shingles(t) for i, t in rows}
    links = {i: {j for j in sets if j != i and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} for i in sets}
    root = {i: i for i in sets}
    for _ in sets:
        for i in sets:
            root[i] = min([root[i], *(root[j] for j in links[i])])
    found = jaccard.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in found} == {(i, root[i], len(links[i])) for i in sets}
    small = {(r["doc_id"], r["class_id"]) for r in jaccard.jaccard_join(docs).collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 4), (None, None)} <= small
    assert jaccard.jaccard_join(no_docs).count() == 0


def test_quality_on_held_out_rows(spark, sf_dir):
    labels = base.table(spark, sf_dir, "labels")
    found = QUERIES["op9_quality"](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in found) >= 0.85 * len(found)


def test_quality_scores_every_text(docs, no_docs):
    model = quality.train(["good text here"] * 4 + ["BAD!! TEXT!!"] * 4, np.array([1] * 4 + [0] * 4))
    found = quality.score(docs, model).collect()
    assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
    assert quality.score(no_docs, model).count() == 0


def test_archives_revisit_equal_payloads(spark):
    rows = [(1, "http://a b/x", "<p>é</p>", 1), (2, None, "<p>é</p>", 1), (3, "u", None, 1), (4, "u", "", 1), (5, "v", "WARC/1.0\r\n\r\n", 1)]
    found = {r["page_id"]: r for r in warc.archive_pages(spark.createDataFrame(rows, "page_id long, url string, html string, record int")).collect()}
    assert {k: (r["record_type"], r["refers_to"]) for k, r in found.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None),
    }
    assert bytes(found[2]["payload"]).decode() == "<p>é</p>" and found[5]["payload_bytes"] == 12
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_main_text_leaves_the_frame_out(spark):
    page = (
        "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href='/'>menu</a></nav><!-- x --><div class='ad'>buy</div>"
        "<article><h1>Head&amp;line</h1><p><b>One   two<br>three<p>four <i>five</i></p><div class='comments'><p>first!</p></div></article><footer>&copy; me</footer>"
    )
    rows = [(1, "http://h/1", page, 1), (2, "http://h/2", None, 1), (3, None, "", 1), (4, "http://h/3", "plain < text", 1)]
    found = {r["page_id"]: r["text"] for r in wrappers.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, host int")).collect()}
    assert found == {1: "Head&line\nOne two three\nfour five", 2: "", 3: "", 4: "plain < text"}


def main_texts(spark, pages):
    frame = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in wrappers.extract_text(frame).orderBy("page_id").collect()]


def sentence(seed, n=12):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeioustrn") for _ in range(6)) for _ in range(n))


def test_main_text_of_each_template_of_a_host(spark):
    frame = "<div class='top'><a>Home</a></div>{}<div class='low'>Made by us</div>"
    named = [(f"http://h/a{i}", "<body>" + frame.format(f"<article><h1>{sentence(i, 3)}</h1><p>{sentence(i)}</p></article>")) for i in range(4)]
    plain = [(f"http://h/b{i}", "<body>" + frame.format(f"<div class='story'><h1>{sentence(9 + i, 3)}</h1><p>{sentence(9 + i)}</p></div>")) for i in range(4)]
    teasers = [("http://t/1", f"<div class='story'><p>{sentence(30, 90)}</p></div><article><p>See also</p></article>")]
    found = main_texts(spark, [*named, *plain, *teasers, ("http://h/c", "plain < text"), ("http://h/d", None)])
    assert found == [*(f"{sentence(i, 3)}\n{sentence(i)}" for i in (*range(4), *range(9, 13))), sentence(30, 90), "plain < text", ""]


def test_main_text_without_article_is_whole(spark):
    extra = ["<h2>Only here</h2>", "<ul><li>one</li><li>two</li></ul>", "<blockquote>said once</blockquote>", "", "<table><tr><td>cell</td></tr></table>"]
    text = ["Only here\n", "one\ntwo\n", "said once\n", "", "cell\n"]
    frame = "<body><div class='top'><a>Home</a> <a>About</a></div><div class='page'><h1>{}</h1><p>{}</p>{}<p>{}</p><p class='tail'>All rights kept</p></div>"
    pages = [(f"http://h/{i}", frame.format(sentence(i, 3), sentence(20 + i), x, sentence(40 + i, 60))) for i, x in enumerate(extra)]
    found = main_texts(spark, [*pages, ("http://one/", frame.format("Head", "Start", extra[1], sentence(99, 40)))])
    assert found[:5] == [f"{sentence(i, 3)}\n{sentence(20 + i)}\n{x}{sentence(40 + i, 60)}" for i, x in enumerate(text)]
    assert found[5] == f"Head\nStart\none\ntwo\n{sentence(99, 40)}\nAll rights kept"


def test_side_words_do_not_empty_the_page(spark):
    pages = [
        ("http://a/", f"<body class='single right-sidebar'><div class='share'>tell all</div><div class='text'><p>{sentence(1, 30)}</p></div>"),
        ("http://b/", f"<body><article class='post no-comments'><p>{sentence(2)}</p><div class='comments'>first!</div></article>"),
        ("http://c/", f"<html class='has-menu'><body><main id='search-results'><p>{sentence(3)}</p></main>"),
        ("http://d/", f"<body><div class='with-sidebar'><div class='text'><p>{sentence(4, 30)}</p></div><div class='sidebar'>side</div></div>"),
        ("http://e/", f"<form id='f'><div class='text'><p>{sentence(5, 30)}</p></div></form>"),
        ("http://f/", f"<article><p>short</p></article><div class='comments'>{sentence(6, 30)}</div>"),
    ]
    expected = [sentence(1, 30), sentence(2), sentence(3), sentence(4, 30), sentence(5, 30), "short"]
    assert main_texts(spark, pages) == expected


def test_names_of_article_parts_do_not_cost_text(spark):
    """Part of a class name is no proof inside an article, much text overrules a whole one, and a header there has the headline."""
    s = [sentence(50 + i, 25) for i in range(8)]
    pages = [
        ("http://a/", f"<nav>menu</nav><article><div class='ad-hoc'><p>{s[0]}</p><p>{s[1]}</p></div><p>{s[2]}</p></article>"),
        ("http://b/", f"<article><p>{s[0]}</p><p>{s[1]}</p><p>{s[2]}</p><p>{s[3]}</p><section class='share-prices'><p>{s[4]}</p></section><p>{s[5]}</p><p>{s[6]}</p></article>"),
        ("http://c/", f"<header>Site</header><article><header><h1>The headline</h1><nav>menu</nav></header><p>{s[0]}</p><footer>by me</footer></article>"),
        ("http://d/", f"<article><div class='share'><p>{s[0]}</p><p>{s[1]}</p><p>{s[2]}</p></div><p>{s[3]}</p><div class='ad'>{s[4]}</div></article>"),
        ("http://e/", f"<article><p>{s[0]}</p><div class='related-posts'><a>{s[1]}</a> <a>{s[2]}</a></div><div class='post-comments'><p>{s[3]}</p><p>{s[4]}</p></div><div class='ad-slot'>Buy now</div></article>"),
        ("http://f/", f"<div class='main-nav'>{s[0]}</div><main><p>{s[1]}</p></main><div class='site-footer'>{s[2]}</div>"),
    ]
    expected = ["\n".join(s[:3]), "\n".join(s[:7]), f"The headline\n{s[0]}", "\n".join(s[:4]), s[0], s[1]]
    assert main_texts(spark, pages) == expected


def test_main_text_of_empty_tables_repeats_and_long_pages(spark):
    frame = spark.createDataFrame([], "page_id long, url string, html string, host string, roles string")
    assert wrappers.extract_text(frame).count() == 0
    long = f"<body><nav>menu</nav><article>{''.join(f'<p>{sentence(i, 40)}</p>' for i in range(2_000))}</article>"
    rows = [(1, "http://h/", long, "x", "y")] * 2 + [(None, None, "<p>", "x", "y"), (2, "http://h/", "<p" * 50_000, "x", "y")]
    found = wrappers.extract_text(spark.createDataFrame(rows, frame.schema)).collect()
    text = "\n".join(sentence(i, 40) for i in range(2_000))
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in found if r["page_id"] != 2) == [(0, 0), (1, len(text)), (1, len(text))] and len(found) == 4
    assert all(r["text"] == text for r in found if r["page_id"] == 1)


def test_wrapper_finds_slots_and_repeats():
    pages = [f"<div><ul>{'<li>x</li>' * n}</ul><p>text {n}</p>{'<em>extra</em>' if n > 2 else ''}</div>" for n in (1, 2, 3)]
    whole = wrappers.page_items(pages[0])
    for page in pages[1:]:
        whole = wrappers.align(whole, wrappers.page_items(page))
    inside = {i.label: i for i in whole[0].inside}
    assert inside["ul"].inside[0].repeated and inside["p"].inside[0].value is None and inside["em"].optional


def test_pipeline_stages(spark, sf_dir):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = base.table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = base.staged(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == columns and docs.count() > 0
    texts_ = Counter(hashlib.sha256(r["text"].encode()).hexdigest() for r in docs.select("text").collect())
    assert Counter(r["decoded_sha256"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()) == texts_
    assert "pipeline" in __spark_entry__.queries()


def test_word_numbers_take_two_arrays():
    rng, known, numbers = np.random.default_rng(5), bpe.Known(), {}
    for _ in range(40):
        keys = np.unique(rng.integers(0, 3_000, 200, np.uint64) << np.uint64(rng.integers(0, 53)))
        before = len(numbers)
        expected = [numbers.setdefault(k, len(numbers)) for k in keys.tolist()]
        assert known.number(keys).tolist() == expected
        assert len(known.keys) == len(numbers) >= before
    assert known.keys.nbytes + known.numbers.nbytes == 12 * len(numbers)
    assert known.number(np.zeros(0, np.uint64)).tolist() == []


def test_class_table_takes_little_memory_to_build():
    texts.classes.cache_clear()
    tracemalloc.start()
    try:
        texts.classes()
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()


def test_workers_give_memory_back():
    """What a task freed goes back although something above it is still held."""
    held = []

    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * resource.getpagesize() >> 20

    def run(batches):
        some = [np.ones(60_000, np.uint8) for _ in range(3_000)]
        held.append(np.ones(60_000, np.uint8))
        del some
        yield from batches

    before, batch = resident(), pa.record_batch({"id": [1, 2]})
    assert list(base.leanly(run)(iter([batch]))) == [batch]
    assert resident() < before + 40
    assert base.given_back(batch) is batch


def test_bpe_reads_files_in_shares_and_keeps_every_text(spark, tmp_path, monkeypatch):
    rows = [(i, f"word{i % 7} ülang{i % 5} {i}") for i in range(4_000)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(80).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        files = spark.read.parquet(path)
        parts = files.rdd.getNumPartitions()
        shared = bpe.sharing(files)
        cores = spark.sparkContext.defaultParallelism
        assert parts > 2 * cores and shared.rdd.getNumPartitions() == max(-(-parts // bpe.SHARED), 2 * cores)
        assert bpe.sharing(files.limit(0)).count() == 0
        found = {r["doc_id"]: bytes(r["decoded"]).decode() for r in bpe.encode_decode(shared, bpe.multi_ranks()).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == dict(rows)


def test_coded_words_are_found_by_number():
    coded = bpe.Coded(bpe.pieces({b"a": 0, b"b": 1, b"ab": 3}))
    coded.add(np.array([3, 0, 1], np.uint32), np.array([0, 1, 3]))
    coded.add(np.zeros(0, np.uint32), np.array([0]))
    coded.add(np.array([1] * 5_000, np.uint32), np.array([0, 0, 5_000]))
    assert coded.id_at.all().tolist() == [0, 1, 3, 3, 5_003] and coded.byte_at.all().tolist() == [0, 2, 4, 4, 5_004]
    assert coded.ids.all().tolist() == [3, 0, 1, *[1] * 5_000] and coded.bytes.all().tobytes() == b"abab" + b"b" * 5_000
