"""Main text of web pages by a tree-structured graphical model over their DOM.

A node (a block element, or the text of a block) is content or not.  A node's potential is a log-linear one of its
tag, its class words, lengths, shares of link text and place; a parent and its child share a potential that depends on
the child's kind.  Messages passed from the leaves to the root and back (sum-product; exact, as the graph is a tree)
give each node's marginal, and the texts of at least ``KEEP`` are the page's text, one a line.

The weights maximise the likelihood of labelled pages.  Labels are those that ``review`` reads from pages whose
elements name their role; copies of these pages, in which roles are renamed, left out or planted, teach the model
what unnamed content and unnamed boilerplate look like.  Names that ``review`` knows start at ``PRIOR``, which holds
where no page tells better, and the weights are drawn to that start.

A null or empty page has an empty text.  Scripts, styles, form controls and other elements that show no text of the
page have no nodes.  Pages are rows of their own, also with equal or null ids; other columns are ignored.
"""

from __future__ import annotations

import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm.common import arrow_map, stored, table
from medallion.llm.html_tree import Node, parse
from medallion.llm.registry import query

KEEP = 0.5
# Bound of the labelled sample: pages (chosen by a hash) and characters of a page.
MAX_TRAIN_PAGES, MAX_TRAIN_CHARS = 400, 60_000
SLOTS, STEPS, RATE, PULL, PRIOR = 1 << 15, 120, 0.3, 2e-3, 3.0

# What elements and names say about their role.
APART = frozenset("nav aside form footer menu dialog fieldset".split())
HEADS = frozenset(["header"])  # a page's; one inside an article belongs to it
MAIN = frozenset("article main".split())
APART_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navigation navbar breadcrumb "
    "breadcrumbs footer header masthead comment comments disqus reply replies respond cookie cookies consent gdpr notice alert popup modal "
    "overlay newsletter subscribe signup login search share sharing social related recommended widget toolbar copyright legal "
    "pagination pager contentinfo complementary".split())
MAIN_NAMES = frozenset("article post entry story main".split())
KINDS = {kind: n for n, kinds in enumerate([
    [""], ["p", "blockquote", "pre", "address"], ["h1", "h2", "h3", "h4", "h5", "h6"], ["ul", "ol", "dl", "menu"], ["li", "dt", "dd"],
    ["div", "center", "figure", "figcaption", "details", "summary"], ["section"], ["article", "main"], ["nav"], ["aside"], ["header"],
    ["footer"], ["form", "fieldset", "dialog"], ["table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"], ["html", "body", "#page"]]) for kind in kinds}
OTHER = len(set(KINDS.values()))


# ---- features ------------------------------------------------------------------------------------------------------

@lru_cache(1 << 16)
def slot(kind: str, value) -> int:
    return zlib.crc32(f"{kind}:{value}".encode()) % SLOTS


def features(nodes: list[Node]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parents, depths and kinds of the nodes, then slots of features and the number of them that each node has."""
    found, counts, seen = [], [], 0
    whole = max(nodes[0].texts, 1)
    for n in nodes:
        share = 4 * n.linked // n.chars if n.chars else -1
        size = n.chars.bit_length()
        if n.tag:
            own = [slot("tag", n.tag), slot("size", size), slot("links", share),
                   slot("texts", min(n.texts, 9).bit_length()), *[slot("name", w) for w in n.names]]
        else:
            end = n.text[-1]
            own = [slot("text", nodes[n.parent].tag), slot("text size", size), slot("text links", share),
                   slot("words", n.text.count(" ").bit_length()), slot("place", 4 * seen // whole),
                   slot("end", "stop" if end in ".!?…。" else "letter" if end.isalnum() else "sign"),
                   slot("sign", "©" in n.text or "|" in n.text or "·" in n.text)]
            seen += 1
        found += own
        counts.append(len(own))
    return (np.array([n.parent for n in nodes]), np.array([n.depth for n in nodes]),
            np.array([KINDS.get(n.tag, OTHER) for n in nodes]), np.array(found), np.array(counts))


class Forest:
    """Trees of several pages, for work on all nodes of a depth at once."""

    def __init__(self, held: list[tuple]):
        sizes = np.array([len(h[0]) for h in held])
        self.starts = np.cumsum(sizes) - sizes
        self.parent = np.concatenate([np.where(h[0] < 0, -1, h[0] + s) for h, s in zip(held, self.starts, strict=True)])
        depth, self.kind = (np.concatenate([h[k] for h in held]) for k in (1, 2))
        self.slots, self.counts = (np.concatenate([h[k] for h in held]) for k in (3, 4))
        order = np.lexsort((self.parent, depth))  # children of one parent stand together
        self.levels = []
        for level in np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max() + 1)))[1:]:
            p = self.parent[level]
            first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]]) if len(p) else p
            self.levels.append((level, p, first, p[first]))
        self.node = np.repeat(np.arange(len(depth)), self.counts)

    def marginals(self, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of content of each node, and of the four states of (parent, node).

        ``weights``: of the feature slots, for content; ``edges``: kind x parent's state x child's state.
        """
        n = len(self.parent)
        own = np.zeros((n, 2))
        own[:, 1] = np.bincount(self.node, weights[self.slots], n)
        between = edges[self.kind]
        below, up = own.copy(), np.zeros((n, 2))  # log potentials of subtrees; messages to parents
        for level, _, first, parents in reversed(self.levels):
            up[level] = found = np.logaddexp.reduce(between[level] + below[level][:, None, :], axis=2)
            below[parents] += np.add.reduceat(found, first, axis=0)
        above = np.zeros((n, 2))  # messages from parents
        pair = np.zeros((n, 2, 2))
        for level, p, _, _ in self.levels:
            rest = above[p] + below[p] - up[level]  # the parent without this child
            joint = rest[:, :, None] + between[level]
            above[level] = np.logaddexp.reduce(joint, axis=1)
            above[level] -= above[level].max(axis=1, keepdims=True)
            pair[level] = joint + below[level][:, None, :]
        belief = above + below
        content = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
        pair -= pair.max(axis=(1, 2), keepdims=True)
        pair = np.exp(pair)
        return content, pair / pair.sum(axis=(1, 2), keepdims=True)


# ---- labelled pages --------------------------------------------------------------------------------------------------

def review(nodes: list[Node]) -> np.ndarray | None:
    """Labels of a page whose elements name their role: 1 for texts of an article and what holds them; None of others."""
    state, found = [], np.zeros(len(nodes), np.int64)
    for n in nodes:
        before = state[n.parent] if n.parent >= 0 else ""
        if before == "apart" or n.mark == "0" or n.tag in APART or n.tag in HEADS and before != "main" or not APART_NAMES.isdisjoint(n.names):
            now = "apart"
        elif n.mark == "1" or n.tag in MAIN or not MAIN_NAMES.isdisjoint(n.names):
            now = "main"
        else:
            now = before
        state.append(now)
    if "main" not in state:
        return None
    for i in range(len(nodes) - 1, 0, -1):
        if not nodes[i].tag:
            found[i] = state[i] == "main"
        if found[i]:
            found[nodes[i].parent] = 1
    return found


# What is planted, with the role it has by construction.  {prose}: a paragraph of the page; {links}: a list of links.
PLANTED = {
    "before": ['<header><h2>{short}</h2><p>{prose}</p></header>', '<div data-mark=0><ul>{links}</ul></div>', '<div class="cookie-notice"><p>{prose}</p></div>',
               '<form action="/s"><p>{short}</p><p>{prose}</p></form>', '<div class="top-menu">{links}</div>', '<div role="alert">{prose}</div>'],
    "inside": ['<div class="advert"><p>{prose}</p></div>', '<aside><h3>{short}</h3><p>{prose}</p></aside>', '<div class="share-buttons">{links}</div>',
               '<form><p>{short}</p></form>', '<div data-mark=0><ul>{links}</ul></div>'],
    "after": ['<section class="comments"><h3>{short}</h3><div class="comment"><p>{prose}</p></div><div class="comment"><p>{prose}</p></div></section>',
              '<div id="comments"><ol><li><p>{short}</p><p>{prose}</p></li></ol></div>', '<aside class="sidebar"><h3>{short}</h3><ul>{links}</ul><p>{prose}</p></aside>',
              '<div class="related"><h4>{short}</h4><p>{prose}</p></div>', '<div class="newsletter"><p>{prose}</p></div>', '<div data-mark=0>&copy; {short}</div>',
              '<div class="sidebar"><div class="widget"><p>{prose}</p></div></div>'],
}
# Parts of the article itself.
OWN = ['<ul><li>{prose}</li><li>{short}</li><li>{short}</li></ul>', '<ol><li>{short}</li><li><p>{prose}</p></li></ol>', '<blockquote><p>{prose}</p></blockquote>',
       '<table><tr><td>{short}</td><td>{prose}</td></tr></table>', '<table><tbody><tr><td>{short}</td><td>1</td></tr></tbody></table>', '<h2>{short}</h2><p>{prose}</p>',
       '<header><h2>{short}</h2><p>{short}</p></header>', '<div><div><p>{prose}</p></div></div>', '<section><h3>{short}</h3><p>{prose}</p></section>',
       '<figure><figcaption>{short}</figcaption></figure>', '<p>{short} <a href="/x">{short}</a></p>', '<pre>{prose}</pre>', '<dl><dt>{short}</dt><dd>{prose}</dd></dl>',
       '<div>{prose}</div>', '<p>{short}</p>']
ARTICLES = ['<article>', '<main>', '<div class="post">', '<div class="entry">', '<section data-mark=1>', '<div data-mark=1>']
_ARTICLE, _PARAGRAPH = re.compile(r"<article[^>]*>(.*?)(?:</article>|\Z)", re.S | re.I), re.compile(r"<p[^>]*>([^<]+)", re.I)


def remade(html: str, draw: random.Random) -> str:
    """The page with a part of its article in another element, and parts of known role around and inside it."""
    found = _ARTICLE.search(html)
    if not found:
        return html
    paragraphs = _PARAGRAPH.findall(found[1]) or ["..."]
    words = found[1].split()

    def grown(forms, n):
        def fill(m):
            if m[1] == "links":
                return "".join(f'<li><a href="/x">{draw.choice(words or ["x"])[:12].strip("<>/")}</a></li>' for _ in range(draw.randint(2, 8)))
            return draw.choice(paragraphs)[:30 if m[1] == "short" else 2000]

        return "".join(re.sub(r"\{(\w+)\}", fill, t) for t in draw.sample(forms, n))

    opening = draw.choice(ARTICLES)
    body = [b for b in found[1].split("</p>") if b.strip()]
    body = body[:draw.randint(1, len(body))] if body else [""]  # articles of all lengths
    body = [part for b in body for part in (f"{b}</p>", grown(OWN, draw.randint(0, 1)) if draw.random() < 0.4 else "")]
    body.insert(draw.randint(1, len(body)), grown(PLANTED["inside"], draw.randint(0, 2)))
    closing = "</" + re.match(r"<(\w+)", opening)[1] + ">"
    head, tail = (html[:found.start()], html[found.end():]) if draw.random() < 0.7 else ("<html><body>", "</body></html>")
    return (head + grown(PLANTED["before"], draw.randint(0, 3)) + opening + "".join(body) + closing
            + grown(PLANTED["after"], draw.randint(0, 3)) + tail)


def prior() -> np.ndarray:
    weights = np.zeros(SLOTS)
    for kind, held, value in (("tag", APART | HEADS, -PRIOR), ("name", APART_NAMES, -PRIOR), ("tag", MAIN, PRIOR), ("name", MAIN_NAMES, PRIOR / 2)):
        for word in sorted(held):
            weights[slot(kind, word)] = value
    return weights


def fit(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and edge potentials learned from the pages that can be labelled, and from remade copies of them."""
    weights, edges = prior(), np.tile(np.array([[1.0, -1.0], [0.0, 1.0]]), (OTHER + 1, 1, 1))
    start, trees, labels = (weights.copy(), edges.copy()), [], []
    for n, html in enumerate(pages):
        for turn in range(4):
            nodes = parse(html if turn == 0 else remade(html, random.Random(7 * n + turn)))
            if (found := review(nodes)) is not None:
                trees.append(features(nodes))
                labels.append(found)
    if not trees:
        return weights, edges
    forest, y = Forest(trees), np.concatenate(labels)
    inner = np.flatnonzero(forest.parent >= 0)
    kind, shape = forest.kind[inner], edges.shape
    real = np.bincount(4 * kind + 2 * y[forest.parent[inner]] + y[inner], minlength=edges.size).reshape(shape)
    place = (4 * kind[:, None] + np.arange(4)).ravel()
    truth = np.bincount(forest.slots, y[forest.node], SLOTS)
    pace, pace_of_edges = np.full(SLOTS, 1e-8), np.full_like(edges, 1e-8)
    for _ in range(STEPS):  # Adagrad on the log-likelihood, whose slope is true less expected counts
        p, pair = forest.marginals(weights, edges)
        slope = (truth - np.bincount(forest.slots, p[forest.node], SLOTS)) / len(trees) - PULL * (weights - start[0])
        held = np.bincount(place, pair[inner].ravel(), edges.size).reshape(shape)
        slope_of_edges = (real - held) / len(trees) - PULL * (edges - start[1])
        pace += slope**2
        pace_of_edges += slope_of_edges**2
        weights += RATE * slope / np.sqrt(pace)
        edges += RATE * slope_of_edges / np.sqrt(pace_of_edges)
    return weights, edges


def train(pages: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Weights learned from at most about ``MAX_TRAIN_PAGES`` pages of at most ``MAX_TRAIN_CHARS``, in one task."""
    pages = pages.select(F.col("html").cast("string").alias("html")).where(F.col("html").isNotNull())
    n = pages.count()
    share = MAX_TRAIN_PAGES / max(n, MAX_TRAIN_PAGES)
    key = F.xxhash64("html")
    sample = stored(pages.where(F.pmod(key, F.lit(1_000_000)) < round(1_000_000 * share)).where(F.length("html") <= MAX_TRAIN_CHARS).distinct())

    def learn(batches):
        held = sorted(h for batch in batches for h in batch.column("html").to_pylist())
        weights, edges = fit(held)
        yield pa.record_batch({"weights": pa.array([weights.tobytes()], pa.binary()), "edges": pa.array([edges.tobytes()], pa.binary())})

    row = sample.repartition(1).mapInArrow(learn, "weights binary, edges binary").collect()  # the bounded sample only
    if not row:
        return fit([])
    return np.frombuffer(row[0]["weights"]), np.frombuffer(row[0]["edges"]).reshape(OTHER + 1, 2, 2)


# ---- extraction --------------------------------------------------------------------------------------------------------

def texts(htmls: list[str | None], weights: np.ndarray, edges: np.ndarray) -> list[tuple[str, int, int, float]]:
    """Of each page: its text, its blocks, those kept, and the least sure marginal of a block (0.5 to 1)."""
    held = [parse(h) for h in htmls]
    forest = Forest([features(nodes) for nodes in held])
    content, found = forest.marginals(weights, edges)[0], []
    for nodes, first in zip(held, forest.starts, strict=True):
        leaves = [(n.text, content[first + i]) for i, n in enumerate(nodes) if not n.tag]
        keep = [t for t, p in leaves if p >= KEEP]
        found.append(("\n".join(keep), len(leaves), len(keep), min((max(p, 1 - p) for _, p in leaves), default=1.0)))
    return found


def extract(pages: DataFrame, trained_on: DataFrame | None = None) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks, n_kept, least_sure`` of every row of ``pages``."""
    model = pages.sparkSession.sparkContext.broadcast(train(pages if trained_on is None else trained_on))  # SLOTS numbers

    def work(batch):
        weights, edges = model.value
        htmls, found, first = batch.column("html").to_pylist(), [], 0
        while first < len(htmls):  # runs of pages, so that the trees of a batch are not all held at once
            end, size = first, 0
            while end < len(htmls) and size < 1 << 19:
                size += len(htmls[end] or "")
                end += 1
            found += texts(htmls[first:end], weights, edges)
            first = end
        text, blocks, kept, sure = zip(*found, strict=True)
        return pa.table({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(text, pa.string()),
                         "n_chars": pa.array([len(t) for t in text], pa.int64()), "n_blocks": pa.array(blocks, pa.int64()),
                         "n_kept": pa.array(kept, pa.int64()), "least_sure": pa.array(sure, pa.float64())})

    columns = [F.col("page_id").cast("long").alias("page_id"), *[F.col(c).cast("string").alias(c) for c in ("url", "html")]]
    return arrow_map(pages.select(*columns), work, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long, least_sure double")


@query()
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
