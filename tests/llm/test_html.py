"""Template removal against a brute-force count over whole trees; deep and long pages."""

import random
import time
from collections import defaultdict

import pytest

from behavio.llm import html_text

SCHEMA = "page_id long, url string, html string"


def _tree(rng, depth, shared):
    """A random element as (tag, children), children being texts or elements."""
    if shared and rng.random() < 0.4:
        return rng.choice(shared)
    if depth == 0 or rng.random() < 0.3:
        return ("p", (f"w{rng.randrange(30)}",))
    return ("div", tuple(_tree(rng, depth - 1, shared) for _ in range(rng.randint(1, 3))))


def _html(node):
    return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(_html, node[1]))}</{node[0]}>"


def _blocks(node):
    return [node] if isinstance(node, str) else [b for c in node[1] for b in _blocks(c)]


def _subtrees(node):
    return set() if isinstance(node, str) else {node}.union(*map(_subtrees, node[1]))


def _kept(node, gone):
    if isinstance(node, str):
        return [node]
    return [] if node in gone else [b for c in node[1] for b in _kept(c, gone)]


@pytest.mark.parametrize("seed", range(3))
def test_templates_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    pages = []
    for host in range(3):
        shared = [_tree(rng, 2, []) for _ in range(3)]
        for _ in range(rng.randint(5, 25)):
            page = ("div", tuple(_tree(rng, 3, shared) for _ in range(rng.randint(1, 4))))
            pages += [(host, page)] * rng.choice((1, 1, 1, 3))  # copies count once
    different, seen = defaultdict(set), defaultdict(set)
    for host, page in pages:
        key = tuple(_blocks(page))
        different[host].add(key)
        for s in _subtrees(page):
            seen[host, s].add(key)
    expect = {}
    for i, (host, page) in enumerate(pages):
        gone = {s for s in _subtrees(page) if len(seen[host, s]) >= max(4, len(different[host]) * 0.5) and len(different[host]) >= 4}
        expect[i] = "\n\n".join(_kept(page, gone))
    rows = [(i, f"http://h{host}/{i}", f"<html><body>{_html(page)}</body></html>") for i, (host, page) in enumerate(pages)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.page_id: r.text for r in html_text.main_text(df, min_pages=4).collect()}
    assert got == expect
    plain = {r.page_id: r.text for r in html_text.main_text(df, min_pages=10 ** 9).collect()}
    assert sum(plain[i] != got[i] for i in got) > len(got) // 2  # it is the counts that remove


def test_unmarked_menus_go_by_counts_alone(spark):
    menu = "<div><div>home</div><div>about</div></div>"
    rows = [(i, f"http://a/{i}", f"<body>{menu}<div><p>text {i}</p></div><div>all rights</div></body>") for i in range(12)]
    rows += [(100 + i, f"http://few/{i}", f"<body>{menu}<p>text {i}</p></body>") for i in range(3)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(got[i] == f"text {i}" for i in range(12))
    assert got[100] == "home\n\nabout\n\ntext 0"


@pytest.mark.parametrize("page", ["<div>" * 60_000 + "x", "<div>x" * 60_000, "<ul><li><ul>" + "<div>" * 20_000 + "</li><li>x" * 20_000,
                                  "<p>x<b>" * 60_000, "<table><tr><td>" * 20_000 + "x"])
def test_deep_pages_are_linear(page):
    began = time.process_time()
    blocks, spans, subtrees = html_text.read_page(page)
    assert time.process_time() - began < 4
    assert blocks and len(spans) <= 60_010 and len(subtrees) <= 60_010


def test_deep_page_with_a_template_through_spark(spark):
    rows = [(i, f"http://a/{i}", "<div>" * 5_000 + f"<p>menu</p><p>text {i}</p>") for i in range(12)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"text {i}" for i in range(12)}


def test_long_page_of_many_template_blocks(spark):
    menu = "".join(f"<div>m{j}</div>" for j in range(20_000))
    rows = [(i, f"http://a/{i}", f"<body>{menu}<div>text {i}</div>{menu}</body>") for i in range(10)]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: f"text {i}" for i in range(10)}
