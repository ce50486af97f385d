"""Packing, language, toxicity, quality and extraction."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from behavio.llm import html_text, langid, packing, quality, toxicity
from behavio.llm.catalogue import tokenizer_path
from llm_data import EDGES, corpus, frame


def encoder():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("rows,capacity,block", [(corpus(21), 64, 500), (EDGES, 1024, 1 << 22), (EDGES, 16, 1), ([], 64, 100),
                                                 ([(1, "a  b \n c"), (2, "  x"), (3, "y  "), (4, "<|endoftext|> it's")], 4, 10)])
def test_packing_round_trip(spark, rows, capacity, block):
    code = encoder()
    got = packing.pack(frame(spark, rows), tokenizer_path(), capacity=capacity, block_tokens=block).collect()
    docs = {}
    for r in got:
        docs.setdefault(r.doc_id, []).append((r.start, r.length, bytes(r.ids), r.doc_tokens))
    exp = {}
    for i, t in rows:
        exp.setdefault(i, []).append(np.array(code(t), "<u4").tobytes())
    assert set(docs) == set(exp)
    for i, pieces in docs.items():
        if len(exp[i]) == 1:
            pieces.sort()
            assert b"".join(p[2] for p in pieces) == exp[i][0]
            assert [p[0] for p in pieces] == [sum(q[1] for q in pieces[:k]) for k in range(len(pieces))]
            assert {p[3] for p in pieces} == {len(exp[i][0]) // 4}
        else:  # repeated rows are documents of their own
            assert sum(p[1] for p in pieces) == sum(len(e) for e in exp[i]) // 4
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length, r.sequence_tokens))
    for pieces in seqs.values():
        pieces.sort()
        assert [p[0] for p in pieces] == [sum(q[1] for q in pieces[:k]) for k in range(len(pieces))]
        n = sum(p[1] for p in pieces)
        assert n == pieces[0][2] <= capacity and (n == capacity or n & (n - 1) == 0)  # no padding


def test_packing_holds_few_texts_at_a_time():
    """Of a large Arrow batch, only a run of texts and one block's ids are Python values."""
    import tracemalloc

    import pyarrow as pa
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                        ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_tokens", pa.int64())])

    class Lengths:
        def encode(self, text):
            return bytes(4 * (len(text) // 1000))
    frame = pa.RecordBatch.from_arrays([pa.array(range(3000), pa.int64()), pa.array(["x" * 8000] * 2999 + [None])], ["doc_id", "text"])
    tracemalloc.start()
    try:
        n = sum(pa.compute.sum(out["length"]).as_py() for out in packing._pieces(iter([frame]), Lengths(), schema, 0, 1024, 0, 1.0, 0.001, 4096))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 2999 * 9 + 1
    assert peak < 8 << 20  # the batch has 24 MB


def test_packing_codes_texts_in_slices_and_not_word_by_word(monkeypatch):
    """The ids are those of the tokenizer, whatever white space, long words and cuts there are; a text is one call, not one a word."""
    encoder = packing.WordEncoder(tokenizer_path())
    rnd = random.Random(8)
    some = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u3000", "\u200b", "word", "'s", "É", "漢字", "12", "!?", "x" * 250,
            "<|endoftext|>", "a b", "\U0001F600"]
    texts = ["".join(rnd.choice(some) for _ in range(rnd.randrange(14))) for _ in range(2000)]
    for size in (packing.SLICE_CHARS, 5):
        monkeypatch.setattr(packing, "SLICE_CHARS", size)
        assert all(encoder.encode(t) == encoder.known.slow(t) for t in texts)
    monkeypatch.undo()
    calls, by_rank = [], encoder.known.by_rank
    encoder.known.by_rank = lambda t: calls.append(t) or by_rank(t)
    text = " ".join(f"new{i}word" for i in range(5000))
    assert encoder.encode(text) == encoder.known.slow(text)
    assert len(calls) == 1


def test_quality_features_hold_arrays_of_few_characters(monkeypatch):
    """The same rows as of all texts at once, in less memory than arrays over all characters take."""
    import tracemalloc
    classes = quality.class_table()
    texts = [f"Text {i} has SOME words, words and  blanks.\n" * (i % 7 * 15) for i in range(3000)]
    tracemalloc.start()
    try:
        x = quality.features(texts, classes)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(map(len, texts)) > 5_000_000 and peak < 64 << 20
    monkeypatch.setattr(quality, "FEATURE_CHARS", 1 << 40)
    assert (x == quality.features(texts, classes)).all()


def test_packing_goes_to_the_lowest_cost_sequence():
    rnd = random.Random(1)
    for _ in range(50):
        lengths = [rnd.randrange(1, 90) for _ in range(rnd.randrange(1, 40))]
        pieces, sizes = packing.assign(lengths, 32, 1.0, 0.1)
        assert sum(sizes) == sum(lengths) == sum(p[2] for p in pieces)
        cost, free = [0.0] * len(sizes), list(sizes)
        for d, start, n, seq, offset in pieces:
            assert offset == sizes[seq] - free[seq]
            if n < 32:
                fits = [cost[s] for s in range(len(sizes)) if free[s] >= n and sizes[s] != n or s == seq]
                assert cost[seq] <= min(fits) + 1e-9 or free[seq] == n
            cost[seq] += n + 0.1 * n * n
            free[seq] -= n
            assert free[seq] >= 0


def languages(n=400, seed=1):
    rnd = random.Random(seed)
    syll = {"en": ["th", "ing", "er", "and", "sh"], "de": ["sch", "ung", "ein", "keit", "ä"], "ru": ["ст", "ко", "на", "ий"]}
    say = lambda l, k: " ".join("".join(rnd.choice(syll[l]) for _ in range(rnd.randrange(1, 4))) for _ in range(k))
    rows = [(i, say(l, rnd.randrange(3, 60)), l) for i in range(n) for l in [rnd.choice(list(syll))]]
    return rows, say


def test_language_accuracy_and_spans(spark):
    rows, say = languages()
    train = spark.createDataFrame(rows[:300] + [(900, "no label", None), (None, "x", "en")], "doc_id long, text string, lang string")
    mixed = f"{say('en', 30)} {say('ru', 40)}"
    docs = spark.createDataFrame(rows[300:] + [(5000, mixed, None)], "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = {r.doc_id: r for r in langid.identify(docs, train).collect()}
    assert np.mean([got[i].lang_pred == l for i, _, l in rows[300:]]) > 0.97
    m = got[5000]
    assert m.lang_pred == "ru" and [s.lang for s in m.spans] == ["en", "ru"] and 0.3 < m.score < 0.9
    assert mixed[m.spans[1].start:m.spans[1].end] == mixed[m.spans[0].end + 1:]


def test_rare_languages_are_learnt(spark):
    rows, say = languages(2000, 3)
    rows = [r for r in rows if r[2] != "ru"]
    train = spark.createDataFrame(rows + [(9000 + k, say("ru", 40), "ru") for k in range(3)], "doc_id long, text string, lang string")
    docs = spark.createDataFrame([(k, say(x, 30), x) for k, x in enumerate(["ru", "en", "de"] * 20)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, train, sample_rows=60).collect()}
    assert np.mean([got[r.doc_id] == r.lang for r in docs.collect()]) > 0.97
    assert langid.train(train, 60)[1] == ["de", "en", "ru"]


def test_more_languages_than_a_byte_counts():
    scores = np.zeros((4, 300), np.float32)
    scores[:, 290] = 50
    assert langid.viterbi(scores, np.array([0]), np.array([4]), 2.0).tolist() == [290] * 4


def test_language_viterbi_brute_force():
    rng = np.random.default_rng(1)
    import itertools
    length = np.array([5, 0, 3, 5])
    first = np.concatenate(([0], np.cumsum(length)))[:-1]
    scores = rng.normal(0, 3, (length.sum(), 3)).astype(np.float32)
    label = langid.viterbi(scores, first, length, 2.0)
    for f, n in zip(first, length):
        best = lambda p: sum(scores[f + k, x] for k, x in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        if n:
            top = max(itertools.product(range(3), repeat=int(n)), key=best)
            assert best(tuple(label[f:f + n])) == pytest.approx(best(top), abs=1e-4)


def test_language_edges(spark):
    rows, _ = languages(60)
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(frame(spark, EDGES), train).collect()
    assert len(got) == len(EDGES)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].spans == [] for i in (1, 2, 3))
    assert by[9].lang_pred != "und" and 0 <= by[9].score <= 1
    assert langid.identify(frame(spark, []), train).collect() == []
    assert {r.lang_pred for r in langid.identify(frame(spark, EDGES), train.where("lang IS NULL")).collect()} == {"und"}


def test_toxicity_gradients():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in toxicity.new_net().items()}
    x = rng.normal(0, 1, (9, toxicity.WORD_DIM + toxicity.CHAR_DIM))
    ids = rng.integers(0, 9, (toxicity.WINDOW, 4))
    valid = np.arange(toxicity.WINDOW)[:, None] < np.array([24, 7, 1, 15])
    target = np.array([1, 0, 1, 0], np.float64)

    def loss():
        z = toxicity.window_logits(net, x, ids, valid).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(-z)) * target + np.log1p(np.exp(z)) * (1 - target)))
    g, dx = toxicity.gradients(net, x, ids, valid, target)
    for name, value, grad in [*((k, net[k], g[k]) for k in g), ("x", x, dx)]:
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            old = value[at]
            value[at] = old + 1e-2
            up = loss()
            value[at] = old - 1e-2
            down = loss()
            value[at] = old
            assert (up - down) / 2e-2 == pytest.approx(grad[at], abs=3e-4, rel=0.05), name


def test_toxicity_finds_words_anywhere(spark):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 6)))

    def text(bad, n):
        w = [word() for _ in range(n)]
        for _ in range(2 if bad else 0):
            w[rnd.randrange(len(w))] = rnd.choice(["moron", "idiot", "scum"])
        return " ".join(w)
    rows = [(i, text(i % 4 == 0, rnd.randrange(5, 80))) for i in range(700)]
    long = [(9000, text(False, 3000) + " idiot scum " + text(False, 3000)), (9001, text(False, 6000))]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows[:500]] + [(None, 1), (3, None)], "doc_id long, label int")
    got = {r.doc_id: r.score for r in toxicity.score(frame(spark, rows + long), labels).collect()}
    assert np.mean([(got[i] >= 0.5) == (i % 4 == 0) for i, _ in rows[500:]]) > 0.95
    assert got[9000] > 0.5 > got[9001]
    assert all(0 <= s <= 1 for s in got.values())


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (11, 0)], "doc_id long, label int")
    got = toxicity.score(frame(spark, EDGES), labels).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.score(frame(spark, []), labels).collect() == []
    one = {r.score for r in toxicity.score(frame(spark, EDGES), labels.where("label = 0")).collect()}
    assert len(one) == 1  # one class teaches nothing


def junk(rnd):
    w = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 7)))
    good = lambda: ". ".join(" ".join(w() for _ in range(rnd.randrange(4, 14))).capitalize() for _ in range(rnd.randrange(2, 9))) + "."
    bad = lambda: rnd.choice([lambda: " ".join([w()] * 60), lambda: " ".join(w().upper() + "!!" for _ in range(50)),
                              lambda: " | ".join(w() for _ in range(60)), lambda: " ".join(w() + "%%%" for _ in range(60))])()
    return good, bad


def test_quality_from_positives_and_unlabelled_text(spark):
    rnd = random.Random(6)
    good, bad = junk(rnd)
    rows = [(i, bad() if i % 5 == 0 else good()) for i in range(1500)]
    positives = spark.createDataFrame([(i,) for i in range(600) if i % 5] + [(None,)], "doc_id long")
    got = {r.doc_id: r.score for r in quality.score(frame(spark, rows), positives).collect()}
    assert np.mean([(got[i] >= 0.5) == (i % 5 != 0) for i in range(600, 1500)]) > 0.95
    assert all(0 <= s <= 1 for s in got.values())


def test_quality_prior_is_estimated():
    rng = np.random.default_rng(2)
    pos = rng.normal(1, 1, (2000, 5))
    unl = np.concatenate([rng.normal(1, 1, (1400, 5)), rng.normal(-2, 1, (600, 5))])
    x = np.concatenate([pos, unl])
    assert quality.estimate_prior(x, np.arange(2000), np.arange(2000, 4000)) == pytest.approx(0.7, abs=0.08)


def test_quality_edges(spark):
    some = spark.createDataFrame([(5,), (6,), (4,)], "doc_id long")
    got = quality.score(frame(spark, EDGES), some).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.score(frame(spark, EDGES), some.where("doc_id < 0")).collect()} == {0.5}
    assert quality.score(frame(spark, []), some).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/x">menu {k}</a></li></ul></nav><!-- ad {k} --><div class="ad">Buy {k}</div>{body}
<div class="comments"><p>First!</p></div><form><p>Sign in</p></form><footer>&copy; {host}</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "1 AS row", "2 AS key")


def test_article_keeps_what_recurs_in_it(spark):
    rows, exp = [], {}
    for k in range(40):
        body = (f"<article><h1>Head {k}</h1><p><b>One &lt;{k}&gt;<br>line.<p>A line that all have.<ul><li>item {k}<li>last</ul>"
                "<div class='share'>share me</div><div><span>inner </span>\n\n text &eacute;</div><div>Read more on this site</div></article>")
        rows.append((k, f"https://a.example/{k}", PAGE.format(k=k, body=body, host="a")))
        exp[k] = "\n\n".join([f"Head {k}", f"One <{k}> line.", "A line that all have.", f"item {k}", "last", "inner text é"])
    got = {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()}
    assert got == {k: (v if k is None else v) for k, v in exp.items()} or got == {k: v.replace("\n\ninner text é", "") for k, v in exp.items()}


def test_site_template_goes_without_an_article_element(spark):
    rows = []
    for k in range(30):
        body = f"<div id=top><p>Welcome to the site</p><p>Since 1999</p></div><div><h2>Story {k}</h2><p>Text {k} of it.</p></div>"
        rows.append((k, f"http://B.example:80/{k}", PAGE.format(k=k, body=body, host="b")))
        rows.append((100 + k, f"http://c{k}.example/", PAGE.format(k=k, body=body, host="c")))
    rows += [(500 + k, "http://d.example/same", PAGE.format(k=0, body="<div><p>Copied story.</p></div>", host="d")) for k in range(30)]
    got = {r.page_id: r.text for r in html_text.main_text(pages(spark, rows)).collect()}
    for k in range(30):
        assert got[k] == f"Story {k}\n\nText {k} of it."
        # one page of a host has no template, and copies of a page make none
        assert got[100 + k] == f"Welcome to the site\n\nSince 1999\n\nStory {k}\n\nText {k} of it."
        assert got[500 + k] == "Copied story."


@pytest.mark.parametrize("element", ['<i class="icon-share" aria-hidden="true"></i>', '<ins class="ad">Buy <b>now</b></ins>',
                                     '<strong class="alert">Buy <strong>now</strong> all</strong>', '<em hidden>no</em>', '<x-card role="banner">no</x-card>',
                                     '<label class="search">no</label>', '<i class="share"/>', '<small class="promo">a <i class="ad">b</i> c</small>'])
def test_inline_elements_end_where_they_end(element):
    between = f"<article>{element}<p>one</p>{element}<p>two</p><div>three</div></article>"
    inside = f"<article><p>one {element}more</p><p>two <i>and</i> three{element}</p><ul><li>{element}four<li>five</ul></article>"
    text = lambda page: " ".join(t for t, _ in html_text.read_page(page)[0])
    assert text(between) == "one two three"
    assert text(inside) == "one more two and three four five"


def test_what_recurs_on_few_pages_of_a_large_host_stays(spark):
    rows = []
    for k in range(60):
        quoted = "<h2>Ingredients</h2><p>A quotation.</p>" if k % 4 == 0 else ""
        rows.append((k, f"http://a.example/{k}", f"<div><p>Site line</p></div><div><h1>Dish {k}</h1>{quoted}</div>"))
        rows.append((100 + k, f"http://b.example/{k}", f"<article><div class=body><section><h1>Dish {k}</h1><h2>Ingredients</h2><p>A <a href=x>line</a>"
                     "<ul><li>salt<li><div>oil</div></ul></section></div><div>Read on</div></article>"))
    got = {r.page_id: r.text.split("\n\n") for r in html_text.main_text(pages(spark, rows)).collect()}
    for k in range(60):
        assert got[k] == [f"Dish {k}"] + (["Ingredients", "A quotation."] if k % 4 == 0 else [])
        assert got[100 + k] == [f"Dish {k}", "Ingredients", "A line", "salt", "oil"]


def test_html_edges(spark):
    rows = [(1, None, None), (2, "x", ""), (3, "http://e/", "plain & text"), (4, "http://e/", "<p>cut <a href='"), (5, "http://e/", "<p>&am"),
            (5, "http://e/", "<p>&am"), (None, None, "<article><p>a</article><p>b"), (6, "", "<div " * 3000), (7, "", "<div>" * 3000 + "deep"),
            (8, "", "<p>" + "long " * 100_000), (9, "", "<script>x"), (10, "", "<p>a<!-- b <p>c")]
    got = sorted(((r.page_id or 0), r.text) for r in html_text.main_text(pages(spark, rows)).collect())
    exp = [(0, "a"), (1, ""), (2, ""), (3, "plain & text"), (4, "cut"), (5, "&am"), (5, "&am"), (6, ""), (7, "deep"),
           (8, ("long " * 100_000).strip()), (9, ""), (10, "a")]
    assert got == exp
    assert html_text.main_text(pages(spark, [])).collect() == []


def test_folds(spark):
    from behavio.llm.common import fold_mod
    df = spark.createDataFrame([(i,) for i in (0, 1, 17, 123456789)] + [(None,)], "doc_id long")
    got = {r.doc_id: r.f for r in df.select("doc_id", fold_mod("doc_id", 5).alias("f")).collect()}
    assert got == {i: (zlib.crc32(str(i).encode()) % 5 if i is not None else 0) for i in got}


@pytest.mark.parametrize("page", [
    '<body class="post no-sidebar"><article><p>x</p></article></body>',
    '<body class="has-sidebar"><article><p>x</p></article></body>',
    '<body class="with-banner nav-open"><article><p>x</p></article></body>',
    '<body><div class="main-content no-sidebar"><article><p>x</p></article></div></body>',
    '<article><h2 id="search-algorithms">x</h2></article>',
    '<article><h2 id="related-work">x</h2></article>',
    '<article><p id="comment-5">x</p></article>',
    '<article><p title="a hidden gem">x</p></article>',
    '<article><p data-id="menu">x</p></article>',
    '<article><p title="see id=ad">x</p></article>',
    '<article><p>x</p><p hidden>y</p><p class="advert">y</p><div id="comments">y</div><div role="navigation">y</div></article>',
    '<article><p>x</p><p style="color: red; display : none">y</p><div aria-hidden="true">y</div><div class="post-sidebar">y</div></article>',
])
def test_html_names_count_by_attribute_and_element(page):
    assert [t for t, _ in html_text.read_page(page)[0]] == ["x"]
