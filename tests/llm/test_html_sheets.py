"""Drawings, formulas and a page's own style sheets; the registered query against a plain text parser."""

import re
from html.parser import HTMLParser

import pytest

from pitmark.llm.html_text import visible_text as render
from pitmark.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("source", "want"), [
    ("<svg><text>svgtext</text></svg>", "svgtext"), ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "x=2"),
    ("<p>a<svg><title>tip</title><defs><text>no</text></defs><path d='M0'/><text>b</text><text>c</text></svg>d</p>", "a\nb\nc\nd"),
    ("<math><semantics><mi>y</mi><annotation>y tex</annotation></semantics></math>", "y"),
    ("<style>.h{display:none}</style><p class=h>no<p class='x h'>no<p>yes", "yes"), ("<p class=h>no<p>yes<style>/* late */ p.h , #k { color: red; DISPLAY : none }</style>", "yes"),
    ("<style>#k{visibility:hidden}</style><p id=k>no <b style='visibility:visible'>yes</b></p>", "yes"),
    ("<style>.h{display:none}p{display:block}</style><p class=h>no</p>a", "a"), ("<style>.h{display:none} .h{display:block}</style><p class=h>yes</p>", "yes"),
    ("<style>.h{display:none}</style><p class=h style='display:block'>yes</p>", "yes"), ("<style>.h{display:none!important}</style><p class=h style='display:block'>no</p>a", "a"),
    ("<style>@media print{.h{display:none}} @import 'x'; .g{display:none}</style><p class=h>yes</p><p class=g>no</p>", "yes"),
    ("<style>div .h{display:none} .h:hover{display:none} a>b{display:none}</style><p class=h>yes</p>", "yes"), ("<style>}{.h{display:none</style><p class=h>yes</p>", "yes"),
    ("<style>[hidden]{display:block}.s{display:block}</style><p hidden>no</p><p hidden class=s>yes</p>", "yes"),
])
def test_pages(source, want):
    assert render(source) == want


class _Words(HTMLParser):
    """Words of all text outside elements that are never seen, and outside hidden ones, in order; tags must be in pairs."""

    def __init__(self):
        super().__init__()
        self.hidden, self.words = [], []

    def handle_starttag(self, tag, attributes):
        a = dict(attributes)
        if tag not in ("br", "img", "hr", "input", "meta", "link"):
            unseen = tag in ("script", "style", "title", "head", "template", "noscript") or "hidden" in a or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style") or "")
            self.hidden.append((tag, bool(unseen)))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.hidden):
            while self.hidden.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(h for _, h in self.hidden):
            self.words += data.split()


def test_the_registered_query_keeps_the_words_of_a_plain_parser(spark):
    pages = {r.page_id: r.html or "" for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in QUERIES["op3_html_text"](spark, SF).collect()}
    assert got.keys() == pages.keys()
    said = 0
    for page, source in pages.items():
        parser = _Words()
        parser.feed(source)
        # marks of lists and cells are the layout's own
        said_here = re.sub(r"(?m)^\s*\d+\.\s", " ", got[page])
        assert re.findall(r"\w", said_here) == re.findall(r"\w", "".join(parser.words)), page
        said += len(parser.words)
    assert said > 5_000
