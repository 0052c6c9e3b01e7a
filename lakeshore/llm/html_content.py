"""Main text of web pages: a tree-structured graphical model over the page's blocks.

A page becomes a tree of block elements; inline markup belongs to its block.
Every node has a binary label, main text or not.  Node potentials come from a
logistic model of the node's tag, name hints (its own and inherited), text
length, link share and sentences; parent-child potentials say how often labels
follow each other down the tree.  Sum-product messages go up the tree once and
down once and give each node its exact marginal.  The blocks whose marginal
exceeds one half are joined in page order.

Both potentials are trained on labelled pages: a documented generator varies
the page layouts, and every node it writes knows its label.

Defined cases: NULL or empty html: empty text, 0 characters; broken, unclosed or
cut markup is repaired as browsers do (an unfinished tag is dropped); repeated
rows are extracted alike; a NULL id or url stays NULL; other columns are
ignored.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeshore.llm.common import text_list

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<([a-zA-Z][^\s/>]*+)([^>]*+)>|<[a-zA-Z][^>]*+\Z|([^<]+|<)", re.S)
NAME = re.compile(r"(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
LABEL = re.compile(r'data-main="([01])"')
PART = re.compile(r"[a-z]+|[A-Z][a-z]*")

#: Fixed values of the HTML standard.
RAW = frozenset("script style title textarea noscript template iframe svg annotation annotation-xml object select option button".split())
TO_END = frozenset("script style title textarea".split())
CONTROLS = frozenset("select option button".split())
BLOCKS = frozenset(("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
                    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody "
                    "td tfoot th thead tr ul").split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SPACES = frozenset(("br", "img", "input", "wbr", "td", "th"))

#: Names in class, id and role that tell of a block's purpose, by purpose.
HINTS = {h: kind for kind, names in {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager toc skip tabs",
    "head": "header masthead banner logo hero",
    "foot": "footer foot bottom copyright legal colophon contentinfo",
    "side": "sidebar side aside widget rail related recommended trending popular complementary",
    "ad": "ad ads advert advertisement adverts promo promotion sponsor sponsored advertising",
    "note": "notice cookie cookies consent gdpr alert modal popup overlay newsletter subscribe signup paywall",
    "share": "share sharing social follow",
    "talk": "comment comments reply replies discussion disqus respond feedback reviews",
    "form": "form login search contact survey",
    "main": "article content post entry story main body text articlebody prose maincontent",
}.items() for h in names.split()}


@dataclass
class Page:
    """Block nodes in document order (a parent comes before its children) and the runs of text between block edges."""

    tags: list[str] = field(default_factory=lambda: ["#root"])
    parents: list[int] = field(default_factory=lambda: [-1])
    hints: list[frozenset] = field(default_factory=lambda: [frozenset()])
    labels: list[int] = field(default_factory=lambda: [0])
    own: list[int] = field(default_factory=lambda: [0])
    linked: list[int] = field(default_factory=lambda: [0])
    stops: list[int] = field(default_factory=lambda: [0])
    runs: list[tuple[int, str]] = field(default_factory=list)


def _hints(attributes: str) -> frozenset:
    if "=" not in attributes:
        return frozenset()
    found = set()
    for m in NAME.finditer(attributes):
        value = m.group(1) or m.group(2) or m.group(3) or ""
        found.update(HINTS[p] for p in map(str.lower, PART.findall(value)) if p in HINTS)
    return frozenset(found)


def _element_ends(html: str, name: str) -> dict[int, int]:
    """Where the elements of a name end, by where their opening tag's name starts; unclosed ones are left out."""
    ends, open_ = {}, []
    for m in re.compile(rf"<(/?)({re.escape(name)})(?![^\s/>])(?:[^<>]*>)?", re.I).finditer(html):
        if not m.group(1):
            open_.append(m.start(2))
        elif open_:
            ends[open_.pop()] = m.end()
    return ends


def parse(html: str) -> Page:
    """The page's blocks and runs of text.

    What a raw element holds is skipped up to its own closing tag.  One that is
    never closed holds nothing, but that an unclosed control's label goes, and
    that script, style, title and textarea reach to the end.  Time is linear in
    the page's length, however deep its blocks nest.
    """
    page = Page()
    stack, inside_links, buffer, linked = [0], 0, [], 0
    # Where in the stack the open blocks of a tag are; where raw elements end, by name.
    depths: defaultdict[str, list[int]] = defaultdict(list)
    ends: dict[str, dict[int, int]] = {}

    def close_run() -> None:
        nonlocal buffer, linked
        if buffer:
            text = " ".join(html_lib.unescape("".join(buffer)).split())
            if text:
                node = stack[-1]
                page.runs.append((node, text))
                page.own[node] += len(text)
                page.linked[node] += min(linked, len(text))
                page.stops[node] += len(re.findall(r"[.!?](?:\s|$)", text))
            buffer, linked = [], 0

    def innermost(names: tuple[str, ...]) -> int:
        return max((depths[n][-1] for n in names if depths[n]), default=0)

    def pop_from(k: int) -> None:
        close_run()
        while len(stack) > k:
            depths[page.tags[stack.pop()]].pop()

    def pop_to(names: tuple[str, ...], limit: tuple[str, ...] = ()) -> None:
        k = innermost(names)
        if k and k > innermost(limit):
            pop_from(k)

    at, end = 0, len(html)
    while at < end and (m := TOKEN.match(html, at)):
        at = m.end()
        closing, opening, attributes, opening2, attributes2, text = m.groups()
        if text is not None:
            buffer.append(text)
            if inside_links:
                linked += len(text)
            continue
        name = (opening or opening2 or "").lower()
        if name:
            attributes = attributes if opening else attributes2
            if name in RAW:
                if name in TO_END and not attributes.endswith("/"):
                    shut = re.compile(rf"</{name}\b[^<>]*+>", re.I).search(html, at)
                    at = shut.end() if shut else end
                elif not attributes.endswith("/"):
                    if name not in ends:
                        ends[name] = _element_ends(html, name)
                    unclosed = html.find("<", at) if name in CONTROLS else at
                    at = max(at, ends[name].get(m.start(2 if opening else 4), unclosed if unclosed >= 0 else end))
                buffer.append(" ")
            elif name in BLOCKS:
                pop_to(("p",), ("td", "th", "button", "object"))
                if name in HEADINGS and page.tags[stack[-1]] in HEADINGS:
                    pop_from(len(stack) - 1)
                if name in CLOSES:
                    pop_to(CLOSES[name], ("ul", "ol", "menu", "dl", "table"))
                close_run()
                if name == "hr" or attributes.endswith("/"):
                    continue
                inside_links = 0
                label = LABEL.search(attributes)
                page.tags.append(name)
                page.parents.append(stack[-1])
                page.hints.append(_hints(attributes))
                page.labels.append(int(label.group(1)) if label else page.labels[stack[-1]])
                page.own.append(0)
                page.linked.append(0)
                page.stops.append(0)
                depths[name].append(len(stack))
                stack.append(len(page.tags) - 1)
            elif name == "a":
                inside_links = 1
            elif name in SPACES:
                buffer.append(" ")
        elif closing:
            name = closing.lower()
            if name == "a":
                inside_links = 0
            elif name in BLOCKS:
                pop_to((name,))
                close_run()
    close_run()
    return page


def _bin(n: int) -> int:
    return min(10, int(n).bit_length())


def node_features(page: Page) -> list[list[str]]:
    """Binary features of every node."""
    n = len(page.tags)
    total, links, stops = page.own[:], page.linked[:], page.stops[:]
    for k in range(n - 1, 0, -1):
        p = page.parents[k]
        total[p] += total[k]
        links[p] += links[k]
        stops[p] += stops[k]
    inherited: list[frozenset] = [frozenset()] * n
    out = []
    for k in range(n):
        p = page.parents[k]
        tag = page.tags[k]
        if p >= 0:
            tag_kind = {"nav": "menu", "footer": "foot", "header": "head", "aside": "side", "form": "form", "article": "main",
                        "main": "main"}.get(page.tags[p])
            inherited[k] = inherited[p] | page.hints[p] | ({tag_kind} if tag_kind else frozenset())
        share = int(4 * links[k] / total[k] + 0.5) if total[k] else -1
        f = [f"tag={tag}", f"len={_bin(total[k])}", f"own={_bin(page.own[k])}", f"link={share}", f"stops={_bin(stops[k])}"]
        f += [f"is={h}" for h in sorted(page.hints[k])] + [f"in={h}" for h in sorted(inherited[k])]
        if not page.hints[k] and not inherited[k]:
            f.append("plain")
        out.append(f)
    return out


@dataclass
class TreeModel:
    weights: dict[str, float]
    bias: float
    edge: np.ndarray  # log potential of (parent label, child label)
    root: np.ndarray  # log potential of the root's label

    def marginals(self, page: Page) -> list[float]:
        """P(main text) of every node by sum-product up and down the tree."""
        node = [self.bias + sum(self.weights.get(f, 0.0) for f in fs) for fs in node_features(page)]
        (a, b), (c, d) = self.edge.tolist()
        n = len(node)
        up0, up1 = [0.0] * n, node[:]
        up0[0] += float(self.root[0])
        up1[0] += float(self.root[1])
        to0, to1 = [0.0] * n, [0.0] * n
        for k in range(n - 1, 0, -1):
            p = page.parents[k]
            to0[k] = _add(up0[k] + a, up1[k] + b)
            to1[k] = _add(up0[k] + c, up1[k] + d)
            up0[p] += to0[k]
            up1[p] += to1[k]
        belief = [(up0[0], up1[0])]
        for k in range(1, n):
            p0, p1 = belief[page.parents[k]]
            r0, r1 = p0 - to0[k], p1 - to1[k]
            belief.append((up0[k] + _add(r0 + a, r1 + c), up1[k] + _add(r0 + b, r1 + d)))
        return [1 / (1 + math.exp(max(-700.0, min(700.0, x - y)))) for x, y in belief]

    def extract(self, html: str) -> str:
        page = parse(html)
        if not page.runs:
            return ""
        p = self.marginals(page)
        return "\n".join(text for node, text in page.runs if p[node] > 0.5)


def _add(x: float, y: float) -> float:
    """log(exp(x) + exp(y))"""
    return x + math.log1p(math.exp(y - x)) if x > y else y + math.log1p(math.exp(x - y))


def labelled_pages(count: int = 240, seed: int = 11) -> list[str]:
    """Training pages in varied layouts; ``data-main`` marks a node (and what it holds) as main text or not."""
    rng = random.Random(seed)
    words = lambda n: " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(n))
    prose = lambda: ". ".join(words(rng.randint(3, 25)).capitalize() for _ in range(rng.choice((1, 1, 2, 4, 7)))) + "."
    link = lambda: f'<a href="/{words(1)}">{words(rng.randint(1, 3))}</a>'
    pick = rng.choice
    off = 'data-main="0"'

    def paragraph() -> str:
        kind = rng.random()
        if kind < 0.72:
            return f"<p>{prose()}" + pick(("</p>", "</p>", "", f" {link()} {words(6)}.</p>"))
        if kind < 0.8:
            return f"<h{pick('2234')}>{words(rng.randint(1, 7))}</h2>"
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{words(rng.randint(1, 14))}</li>" for _ in range(rng.randint(2, 6))) + "</ul>"
        if kind < 0.91:
            return f"<blockquote><p>{prose()}</p></blockquote>"
        if kind < 0.95:
            return f"<p>{words(rng.randint(1, 4))}.</p>"
        return "<table>" + "".join(f"<tr><td>{words(2)}</td><td>{words(3)}</td></tr>" for _ in range(3)) + "</table>"

    def clutter() -> str:
        kind = pick(("ad", "notice", "share", "form", "related", "ad"))
        body = {"ad": prose(), "notice": f"<p>{prose()}</p>", "share": " ".join(link() for _ in range(4)),
                "form": f"<label>{words(3)}</label><input><p>{prose()}</p>", "related": f"<h3>{words(2)}</h3><ul><li>{link()}</li><li>{link()}</li></ul>"}[kind]
        name = {"ad": pick(("ad", "advert", "ads-box", "sponsored", "promo")), "notice": pick(("notice", "cookie-banner", "newsletter", "alert")),
                "share": pick(("share", "social")), "form": pick(("login", "search", "subscribe")), "related": pick(("related", "sidebar", "widget"))}[kind]
        tag = pick(("form", "div")) if kind == "form" else pick(("aside", "div", "div", "section"))
        return f'<{tag} {off} {pick(("class", "id"))}="{name}">{body}</{tag}>'

    def menu() -> str:
        items = "".join(f"<li>{link()}</li>" for _ in range(rng.randint(3, 9)))
        return pick((f"<nav><ul>{items}</ul></nav>", f'<div class="{pick(("menu", "navbar", "nav"))}"><ul>{items}</ul></div>', f"<ul>{items}</ul>"))

    def talk() -> str:
        inner = "".join(f'<{pick(("div", "li", "article"))} class="comment"><p>{words(1)}</p><p>{prose()}</p></div>' for _ in range(rng.randint(1, 5)))
        return f'<{pick(("section", "div"))} {off} {pick(("class", "id"))}="{pick(("comments", "discussion", "replies"))}"><h3>{words(1)}</h3>{inner}</div>'

    pages = []
    for _ in range(count):
        parts = [paragraph() for _ in range(rng.randint(1, 14))]
        if rng.random() < 0.35:
            parts.insert(rng.randint(0, len(parts)), clutter())
        main = f"<h1>{words(rng.randint(2, 9))}</h1>" + "".join(parts)
        tag, name = pick((("article", ""), ("article", ""), ("main", ""), ("div", ' class="content"'), ("div", ' id="main"'),
                          ("div", ' class="post-body"'), ("section", ' class="entry"'), ("div", "")))
        main = f'<{tag}{name} data-main="1">{main}</{tag}>'
        if tag == "article" and rng.random() < 0.3:
            main = f"<main>{main}</main>"
        head = pick(("", f"<header><h2>{words(2)}</h2>{menu()}</header>", f'<div class="header"><p>{words(3)}</p></div>'))
        foot = pick((f"<footer>&copy; {words(2)} {prose()}</footer>", f"<footer><p>{words(5)}</p>{link()}</footer>",
                     f'<div class="footer"><p>&copy; {prose()}</p></div>', ""))
        before = [x for x in (head, menu(), clutter(), clutter()) if rng.random() < 0.6]
        after = [x for x in (talk(), clutter(), clutter()) if rng.random() < 0.45]
        pages.append(f"<html><head><title>{words(3)}</title></head><body>{''.join(before)}{main}{''.join(after)}{foot}</body></html>")
    return pages


def train(pages: list[str], epochs: int = 12, rate: float = 0.2, shrink: float = 1e-4) -> TreeModel:
    """Node potentials by logistic regression, parent-child potentials from label counts along the edges."""
    parsed = [parse(p) for p in pages]
    nodes = [(f, y) for p in parsed for f, y in zip(node_features(p)[1:], p.labels[1:])]
    pairs = np.ones((2, 2))
    for p in parsed:
        for k in range(1, len(p.tags)):
            pairs[p.labels[p.parents[k]], p.labels[k]] += 1
    share = pairs / pairs.sum()
    edge = np.log(share / np.outer(share.sum(1), share.sum(0)))
    weights: dict[str, float] = {}
    bias, rng = 0.0, random.Random(3)
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for k in rng.sample(range(len(nodes)), len(nodes)):
            f, y = nodes[k]
            z = bias + sum(weights.get(x, 0.0) for x in f)
            g = step * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y)
            bias -= 0.1 * g
            for x in f:
                weights[x] = weights.get(x, 0.0) * (1 - step * shrink) - g
    # The root stands for the page, which is never itself main text.
    return TreeModel(weights, bias, edge, np.array([0.0, -4.0]))


def extract(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    model = model or train(labelled_pages())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.extract(h) if h else "" for h in text_list(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return pages.select("page_id", "url", "html").mapInArrow(run, f"{kinds}, text string, n_chars long")
