from __future__ import annotations

import itertools

import numpy as np
import pytest

from sievecraft.llm import pages

LONG = "A sentence that is long enough, with a comma and a stop. Another one follows it, so that the text is long. "
BOILER = [
    '<nav><ul><li><a href="/a">Home page</a><li><a>About us</a></ul></nav>',
    "<header><a href='/'>Name of the site</a></header>",
    f'<div class="cookie-notice">{LONG}</div>',
    f'<aside class="related"><p>{LONG}</p></aside>',
    '<div id="ad1" class="ad">Buy it now, it is cheap.</div>',
    f"<footer><p>&copy; All rights reserved. {LONG}</p></footer>",
    "<form><p>Sign up</p><input><button>Go</button></form>",
]
MAIN = f"<h1>A &amp; B</h1><p>{LONG}<p>Second\n <b>bold&#33;</b> text.<ul><li>one, two.<li>three</ul><blockquote>Said so.</blockquote>"
WANTED = "\n".join(["A & B", LONG.strip(), "Second bold! text.", "one, two.", "three", "Said so."])


def page(main, around=BOILER):
    return f"<html><head><title>T</title><style>p{{}}</style></head><body>{''.join(around[:3])}{main}{''.join(around[3:])}</body></html>"


@pytest.fixture(scope="module")
def model(spark):
    rows = [(k, "u", page(f"<article>{MAIN}</article>", BOILER[k % 7 :] + BOILER[: k % 7])) for k in range(40)]
    return pages.learned(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_main_text(spark, model):
    comments = f'<section class="comments"><p>{LONG}</p></section>'
    html = [
        page(f"<article>{MAIN}</article>"),
        page(f'<div class="wrap"><div id="main-content">{MAIN}</div>{comments}</div>'),
        page(f"<article><header><p>By me</p></header>{MAIN}{BOILER[3]}{comments}</article>"),
        page(f'<article>{MAIN}<script>var t="</article><p>no</p>";</script><!-- <p>no</p> --></article>'),
        None,
        "",
        "<article><p>" + LONG * 20_000,
        "<a <b >> & &bogus; </div></p>",
    ]
    rows = spark.createDataFrame([(k, f"u{k}", x, "t", 1) for k, x in enumerate(html)], "page_id long, url string, html string, text string, label int")
    found = {r["page_id"]: r for r in pages.extracted(rows, model).collect()}
    assert [found[k]["text"] for k in range(4)] == [WANTED] * 4
    assert [found[k]["text"] for k in (4, 5)] == ["", ""]
    assert found[6]["text"] == (LONG * 20_000).strip()
    assert all(r["n_chars"] == len(r["text"]) and r["url"] == f"u{k}" for k, r in found.items())


def test_empty_table(spark, model):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages.extracted(empty, pages.learned(empty)).count() == 0


def test_marginals_like_brute_force():
    random_ = np.random.default_rng(1)
    for _ in range(20):
        n = int(random_.integers(1, 7))
        parent = np.array([-1, *(random_.integers(0, k) for k in range(1, n))])
        depth = np.zeros(n, int)
        for k in range(1, n):
            depth[k] = depth[parent[k]] + 1
        node, pair = random_.normal(size=(n, 3)), np.log(random_.dirichlet(np.ones(3), 3))
        total, share = 0.0, np.zeros((n, 3))
        for states in itertools.product(range(3), repeat=n):
            if states[0]:
                continue
            weight = np.exp(sum(node[k, s] for k, s in enumerate(states)) + sum(pair[states[parent[k]], states[k]] for k in range(1, n)))
            total += weight
            for k, s in enumerate(states):
                share[k, s] += weight
        assert np.allclose(pages.marginals(parent, depth, node, pair), share / total)


@pytest.mark.parametrize(
    "html, want",
    [
        ('<p>one <svg class="i"/> two</p><p>three</p>', ["one two", "three"]),
        ('<p>one <svg><title/><path d="x"/><text>no</text></svg> two</p>', ["one two"]),
        ("<div><p>one <button>go <p>two</p></div><p>three</p>", ["one go", "two", "three"]),
        ("<div><button>a <p>two</p></div><div><button>no</button> three</div>", ["a", "two", "three"]),
        ("<p>one <button>x <button>no</button> two</p>", ["one x two"]),
        ("<p>one <select><option>no<option>no</select> two <canvas>no <b>no</b></canvas></p>", ["one two"]),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds <math/> here</p>", ["so x=1 holds here"]),
        ("<head><title>no</title><meta charset=x><style>no</style><p>one</p><p>two", ["one", "two"]),
        ("<head><title>no</title> one <b>two</b><p>three", ["one two", "three"]),
        ("<head><title>no</title><img src=x> one</p>", ["one"]),
        ("<p>one</p><script>no <p>no</p>", ["one"]),
        ("<p>one</p><div><svg><g>two</div><p>three</p>", ["one", "two", "three"]),
    ],
)
def test_nothing_else_is_left_out(html, want):
    assert [x for x in pages.parsed(html).text if x is not None] == want


@pytest.mark.parametrize("page", [
    "<div>x" * 100_000,
    "<div>" * 30_000 + "</p>" * 30_000 + "t",
    "<ul><li>a" * 30_000,
    "<button><div>" * 20_000,
    "<li>a<b>" * 40_000,
])
def test_deep_pages_take_time_in_proportion(page):
    """Minutes, were any step to go through the open elements for each tag."""
    import time

    start = time.perf_counter()
    pages.main_texts([page], pages.potentials({}, {}))
    assert time.perf_counter() - start < 30


def test_repeated_pages(spark):
    rows = [(1, "u", "<article><p>One text of some length, that is read.</p></article>")] * 2
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = pages.extracted(table, pages.learned(table)).collect()
    assert [r["text"] for r in found] == ["One text of some length, that is read."] * 2
