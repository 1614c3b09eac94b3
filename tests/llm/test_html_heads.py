"""Pages without the tags that HTML lets one leave out, and very deep ones."""

import time

import pytest

from pitmark.llm import html_text

seen = html_text.visible_text


@pytest.mark.parametrize("tag", "font strong em i label button x-app a span div p u small code section svg-box".split())
@pytest.mark.parametrize("head", ["<head><title>t</title>", "<html><head><meta charset=x><title>t</title><link rel=y>", "<head><style>q</style><noscript>w</noscript><template>v</template><base><script>u</script>", "<title>t</title>"])
def test_first_element_closes_an_open_head(head, tag):
    assert seen(f"{head}<{tag}>one <p>two</p> three</{tag}> four").split() == ["one", "two", "three", "four"]


def test_heads():
    assert seen("<head><title>t</title></head><body><p>a</body>") == "a"
    assert seen("<p>a</p><head><title>t</title>b<p>c") == "a\n\nb\n\nc"
    assert seen("<html><head>a<title>t</title></head>b").split() in (["ab"], ["a", "b"])


def deep(inner, n=400):
    return "<div>" * n + inner + "</div>" * n + "after"


def test_end_tags_and_hiding_apply_below_the_depth():
    assert seen("<ul><li>" + deep("<ul><li>x</ul>") + "<li>z</ul>").split() == ["-", "x", "after", "-", "z"]
    hidden = "<section hidden>no" + "<b>no</b><p>no</p><img><br>" + "</section>"
    assert seen(deep(f"a{hidden}b<p style='display:none'>no<span>no</span></p>c")).split() == ["a", "b", "c", "after"]
    assert seen("<div hidden>" + "<div>" * 400 + "no" + "</div>" * 400 + "no</div>yes") == "yes"
    assert seen("<blockquote>" + "<b>" * 300 + "x" + "</b>" * 300 + "y</blockquote>z") == "  xy\n\nz"
    assert seen(deep("<table><tr><td>a<td>b</table><script>no</script><textarea>c</textarea>")).split() == ["a", "|", "b", "c", "after"]


def test_deep_pages_take_time_by_their_size():
    began = time.time()
    assert seen("<p><button>" + "<i>" * 100_000 + "<div>" * 100_000 + "x").split() == ["x"]
    assert time.time() - began < 20
