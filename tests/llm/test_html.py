import html as references
import itertools
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.llm import html_extraction as extraction
from medallion.llm.html_tree import parse

PAGES = "/root/testdata/sf0.01"
PROSE = "It was a long day in the harbour town, and the ships came in one by one while people watched. " * 2


def shown(html):
    return [n.text for n in parse(html) if not n.tag]


def article_of(html):
    """The given pages' article, by its tags."""
    inner = html[html.index("<article>") + 9:].split("</article>")[0]
    blocks = [re.sub(r"\s+", " ", references.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def model(spark):
    held = sorted(r["html"] for r in spark.read.parquet(f"{PAGES}/pages.parquet").where("page_id % 2 = 0").collect())
    return extraction.fit(held)


@pytest.mark.parametrize("html, texts", [
    ("<p>a<p>b<b>c</b> d<br>e<p>f", ["a", "bc d e", "f"]), ("<ul><li>1<li>2<ul><li>3</ul><li>4</ul>z", ["1", "2", "3", "4", "z"]),
    ("<p title='a>b' class=\"x>y\">x</p>", ["x"]), ("a<!-- b", ["a"]), ("a<scr", ["a"]), ('<script>var a="</p>"</script>q', ["q"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>4", ["1", "2", "3", "4"]), ("a &lt;b&gt; &amp &am", ["a <b> & &am"]), ("a < b &nbsp; c", ["a < b c"]),
    ("<style>p</style><title>t</title><textarea>u</textarea><svg><text>v</text></svg>w", ["w"]), ("</p></div>x</b>", ["x"]), ("", []), (" \n ", []),
])
def test_blocks(html, texts):
    assert shown(html) == texts and shown(html.upper().replace("X", "x")) is not None


def test_long_and_broken_pages_take_linear_time():
    for part in ("<div>", '<a ">', "<p>'", '<i a="', "<li>", "<!--", "</div>", "<td><li>", "a & b <", '<p a="1" b="2" c="3">x'):
        start = time.perf_counter()
        parse(part * 40_000)
        assert time.perf_counter() - start < 12
    assert len(shown("<p>" + "word " * 300_000 + "<p>x")) == 2


def test_marginals_are_those_of_all_labellings():
    draw = np.random.default_rng(0)
    for html in ("<div><p>a</p><ul><li>b<li>c</ul></div><p>d", "<p>x", ""):
        nodes = parse(html)
        weights, edges = draw.standard_normal(extraction.SLOTS), draw.standard_normal((extraction.OTHER + 1, 2, 2))
        # twice in one forest, so that trees do not mix
        forest = extraction.Forest([extraction.features(nodes)] * 2)
        content, pair = forest.marginals(weights, edges)
        parent, _, kind, slots, counts = extraction.features(nodes)
        own = np.bincount(np.repeat(np.arange(len(nodes)), counts), weights[slots], len(nodes))
        total, node, couple = 0.0, np.zeros(len(nodes)), np.zeros((len(nodes), 2, 2))
        for labels in itertools.product((0, 1), repeat=len(nodes)):
            mass = np.exp(sum(own[i] * y for i, y in enumerate(labels)) + sum(edges[kind[i], labels[parent[i]], y] for i, y in enumerate(labels) if i))
            total += mass
            node += mass * np.array(labels)
            for i in range(1, len(nodes)):
                couple[i, labels[parent[i]], labels[i]] += mass
        assert np.allclose(content, np.tile(node / total, 2))
        assert np.allclose(pair[1:len(nodes)], couple[1:] / total)


def test_the_slope_is_that_of_the_likelihood():
    """True less expected counts, against finite differences of the log-likelihood."""
    html = "<article><p>one two. <p>three</article><nav><ul><li><a>x</a></ul></nav>"
    nodes = parse(html)
    y, trees = extraction.review(nodes), extraction.features(nodes)
    forest, draw = extraction.Forest([trees]), np.random.default_rng(1)
    weights, edges = 0.1 * draw.standard_normal(extraction.SLOTS), draw.standard_normal((extraction.OTHER + 1, 2, 2))

    def mass(w, labels):
        own = np.bincount(forest.node, w[forest.slots], len(nodes))
        return sum(own[i] * v for i, v in enumerate(labels)) + sum(edges[forest.kind[i], labels[forest.parent[i]], v] for i, v in enumerate(labels) if i)

    def likelihood(w):
        return mass(w, y) - np.logaddexp.reduce([mass(w, labels) for labels in itertools.product((0, 1), repeat=len(nodes))])

    p = forest.marginals(weights, edges)[0]
    slope = np.bincount(forest.slots, (y - p)[forest.node], extraction.SLOTS)
    for s in np.unique(forest.slots)[:4]:
        step = np.zeros(extraction.SLOTS)
        step[s] = 1e-5
        assert abs((likelihood(weights + step) - likelihood(weights - step)) / 2e-5 - slope[s]) < 1e-6


def test_articles_of_given_pages(spark):
    rows = extraction.op12_html_extraction(spark, PAGES).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{PAGES}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == article_of(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_articles_of_pages_not_learned_from(spark, model):
    held = [r["html"] for r in spark.read.parquet(f"{PAGES}/pages.parquet").where("page_id % 2 = 1").collect()]
    assert [t for t, *_ in extraction.texts(held, *model)] == [article_of(h) for h in held]


@pytest.mark.parametrize("html, text", [
    (f'<html><body><div class="site-header"><a href="/">Home</a></div><div class="content"><h1>Title here</h1><p>{PROSE}</p><p>{PROSE}</p></div>'
     f'<div class="sidebar"><h3>Recent</h3><p>{PROSE}</p></div><div class="comments"><h3>Comments</h3><p>{PROSE}</p></div></body></html>', ["Title here", PROSE, PROSE]),
    (f'<ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul><div><h1>Title here</h1><p>{PROSE}</p><p>{PROSE}</p></div>'
     f'<div><a href=q>terms</a> | <a href=z>privacy</a></div>', ["Title here", PROSE, PROSE]),
    (f'<header><h1>Site</h1></header><main><h1>Title here</h1><p>{PROSE}</p><div class="ad"><p>Buy now {PROSE}</p></div><p>Second {PROSE}</p></main>'
     f'<section id="comments"><article class="comment"><p>I like it. {PROSE}</p></article></section><div id="cookieBanner">We use cookies</div>'
     f'<form><label>Mail</label><input><button>Go</button></form>', ["Title here", PROSE, f"Second {PROSE}"]),
    (f'<article><h1>Title</h1><p>{PROSE}</p><form><p>Sign up here</p></form><ul><li>point one of it</li><li>point two</li></ul>'
     f'<blockquote>{PROSE}</blockquote><table><tr><td>1</td><td>2</td></tr></table><p>short</p></article><noscript>enable js</noscript>',
     ["Title", PROSE, "point one of it", "point two", PROSE, "1", "2", "short"]),
])
def test_pages_of_other_forms(model, html, text):
    assert extraction.texts([html], *model)[0][0].split("\n") == [t.strip() for t in text]


def test_review_and_remade_pages(spark):
    html = spark.read.parquet(f"{PAGES}/pages.parquet").orderBy("page_id").first()["html"]
    import random
    forms = {extraction.remade(html, random.Random(n)) for n in range(30)}
    assert len(forms) == 30
    for form in forms:
        nodes = parse(form)
        labels = extraction.review(nodes)
        assert 0 < labels.sum() and all(labels[n.parent] for n, y in zip(nodes, labels) if y and n.parent >= 0)
    assert extraction.review(parse("<div><p>x</div>")) is None


def test_odd_pages(spark):
    odd = [(0, None, None), (1, "u", ""), (2, "u", " "), (None, None, "<article><p>x y z</article>"), (3, "u", "plain text"), (3, "u", "plain text"),
           (4, "u", "<article><p>" + "word " * 200_000 + "</article><nav>m</nav>"), (5, "u", "<" * 1000), (6, "u", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame(odd, "page_id long, url string, html string").withColumns(
        {c: F.lit("x") for c in ("text", "n_chars", "weights", "edges", "key", "_one")}).repartition(3)
    rows = extraction.extract(df).collect()
    assert len(rows) == len(odd)
    by = {(r["page_id"], r["url"]): r for r in rows}
    assert by[0, None]["text"] == by[1, "u"]["text"] == by[2, "u"]["text"] == "" and by[None, None]["text"] == "x y z"
    assert by[4, "u"]["n_chars"] == 5 * 200_000 - 1
    assert extraction.extract(df.limit(0)).collect() == []
