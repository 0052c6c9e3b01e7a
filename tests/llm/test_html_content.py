"""Main text of pages: the parser against a plain stack search, hostile pages, the registered query."""

import html as html_lib
import os
import random
import re
import time

import pytest

from lakeshore.llm import html_content as h
from lakeshore.llm import queries

SF = "/root/testdata/sf0.001"


def runs(html):
    return [t for _, t in h.parse(html).runs]


def plain_tree(tokens):
    """(tag, parent) of every block, by searching the whole stack from its top at each tag."""
    nodes, stack = [("#root", -1)], [0]

    def pop_to(names, limit=()):
        for k in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[k]][0]
            if tag in names:
                del stack[k:]
                return
            if tag in limit:
                return

    for t in tokens:
        name = t.strip("</>")
        if t.startswith("</"):
            pop_to((name,))
        elif t.startswith("<"):
            pop_to(("p",), ("td", "th", "button", "object"))
            if name in h.HEADINGS and nodes[stack[-1]][0] in h.HEADINGS:
                stack.pop()
            if name in h.CLOSES:
                pop_to(h.CLOSES[name], ("ul", "ol", "menu", "dl", "table"))
            nodes.append((name, stack[-1]))
            stack.append(len(nodes) - 1)
    return nodes


def test_tree_as_by_searching_the_stack():
    rng = random.Random(1)
    names = ["div", "p", "ul", "li", "table", "tr", "td", "th", "dl", "dt", "dd", "h1", "h2", "section"]
    for _ in range(400):
        tokens = [rng.choice(("<%s>", "<%s>", "</%s>")) % rng.choice(names) if rng.random() < 0.8 else "x" for _ in range(rng.randint(0, 60))]
        page = h.parse("".join(tokens))
        assert list(zip(page.tags, page.parents)) == plain_tree(tokens)
        assert "".join(re.findall("x", "".join(tokens))) == "".join(t for _, t in page.runs)


def test_formulas_stay_and_controls_go():
    assert runs("<p>Energy is <math><mi>E</mi> = <mi>m</mi></math> as known.</p>") == ["Energy is E = m as known."]
    assert runs('<p><math><semantics><mi>E</mi><annotation encoding="tex">E_{}</annotation></semantics></math></p>') == ["E"]
    assert runs("<p>One <button class='x'>Share</button> two <select><option>A<option>B</select> three</p>") == ["One two three"]


@pytest.mark.parametrize("name", ["button", "select", "option"])
def test_unclosed_control_swallows_no_block(name):
    assert runs(f"<div><{name}>Go<p>Whole paragraph.</p><{name}>Stop</{name}><p>Next.</p></div>") == ["Whole paragraph.", "Next."]


@pytest.mark.parametrize("name", ["noscript", "svg", "object", "template", "iframe"])
def test_unclosed_raw_element_swallows_no_block(name):
    assert runs(f"<{name}><p>Whole paragraph.</p><{name}>gone<p>gone</p></{name}><p>Next.</p>") == ["Whole paragraph.", "Next."]
    assert runs(f"<p>a<{name}>x<{name}>y</{name}>z</{name.upper()} >b</p>") == ["a b"]


def test_unclosed_script_reaches_the_end():
    assert runs("<p>a</p><script>var x = '<p>b</p>'") == ["a"]


def test_label_attribute_of_the_trainer_is_no_hint():
    assert h.parse('<div data-main="article">x</div>').hints[1] == frozenset()


@pytest.mark.parametrize("unit", ["<div>", "<div><p>x", "</section>", "<div></section>", "<ul><li>x", "<button>", "<svg>", "<p><table><td><div>",
                                  "</svg", "<svg a='", "<b"])
def test_a_megabyte_of_one_tag_takes_seconds(unit):
    text = "<p><section><td>" + unit * (1_000_000 // len(unit))
    start = time.perf_counter()
    h.parse(text)
    assert time.perf_counter() - start < 20


def test_registered_query(spark):
    """Every page once, with the text the operator gives for its html; no text that isn't on the page."""
    pages = spark.read.parquet(os.path.join(SF, "pages.parquet")).select("page_id", "url", "html").collect()
    got = {r.page_id: r for r in queries.QUERIES["op9_html_main_text"](spark, SF).collect()}
    assert len(got) == len(pages)
    kept = 0
    for p in pages:
        r = got[p.page_id]
        assert (r.url, r.n_chars) == (p.url, len(r.text))
        shown = " ".join(html_lib.unescape(re.sub(r"<[^>]*>", " ", p.html or "")).split()).replace(" ", "")
        assert all("".join(line.split()) in shown for line in r.text.split("\n"))
        kept += bool(r.text)
    assert kept > 0.9 * len(pages)


def test_empty_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<div></div>"), (1, "u", None)]
    got = h.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text, r.n_chars) for r in got) == [(0, "u", "", 0), (1, "u", "", 0), (1, "u", "", 0), (2, "", "", 0)]
    assert h.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
