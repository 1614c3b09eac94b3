"""Layout rules against literal pages and a plain table model, and pages with broken tags."""

import random
import time

import pytest

from pitmark.llm import html_text

seen = html_text.visible_text


def test_rowspan_and_colspan():
    assert seen("<table><tr><td rowspan=2>A<td>b<tr><td>c<tr><td>D<td>e</table>") == "A | b\n  | c\nD | e"
    assert seen("<table><tr><td>a<td rowspan=0>b<td>c<tr><td>d<td>e<tr><td>f<td>g</table>") == "a | b | c\nd     | e\nf     | g"
    assert seen("<table><tr><td colspan=1000>a<td>b<tr><td>c<td>d</table>") == "a     | b\nc | d"
    assert seen("<table><tr><td colspan=2>a wide one<td>x<tr><td>b<td>c<td>y</table>") == "a wide one | x\nb | c      | y"
    assert seen("<table><tbody><tr><td rowspan=9>a<td>b</tbody><tbody><tr><td>c<td>d</table>") == "a | b\nc | d"
    assert seen("<table><tfoot><tr><td>z<tbody><tr><td>b<thead><tr><td>a</table>") == "a\nb\nz"
    assert seen("<table><tr><td>a<table><tr><td>x<td>y<tr><td>z</table><td>b</table>") == "a     | b\nx | y |\nz     |"


def grid(rows):
    """The standard's table model, slot by slot, for rows of (text, columns, rows)."""
    taken = {}
    for y, row in enumerate(rows):
        x = 0
        for text, columns, down in row:
            while (y, x) in taken:
                x += 1
            for i in range(columns):
                for j in range(down):
                    taken.setdefault((y + j, x + i), (text, y, x))
            x += columns
    return taken


@pytest.mark.parametrize("seed", range(25))
def test_cells_stand_where_the_table_model_has_them(seed):
    rng = random.Random(seed)
    rows = [[(f"c{y}_{x}" + "m" * rng.randint(0, 5), rng.choice([1, 1, 1, 2, 3]), rng.choice([1, 1, 1, 2])) for x in range(rng.randint(1, 4))] for y in range(rng.randint(1, 5))]
    page = "<table>" + "".join("<tr>" + "".join(f"<td colspan={c} rowspan={d}>{t}" for t, c, d in r) for r in rows) + "</table>"
    lines = seen(page).split("\n")
    assert len(lines) == len(rows)
    at = {}
    for text, y, x in {v for v in grid(rows).values()}:
        column = lines[y].index(text)
        assert at.setdefault(x, column) == column, page
    assert [c for _, c in sorted(at.items())] == sorted(set(at.values()))


def test_styles():
    assert seen("<p style='display:none; display:block'>a") == "a"
    assert seen("<p style='display:block; display:none'>a</p>b") == "b"
    assert seen("<p style='display:none !important; display:block'>a</p>b") == "b"
    assert seen("<p hidden style='display:inline'>a</p><p hidden>b") == "a"
    assert seen("<p style='/* display:none */ color:red'>a") == "a"
    assert seen("<div style='visibility:hidden'>a<b style='visibility:visible'>b</b>c</div>d") == "b\nd"
    assert seen("<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>") == "- b"
    assert seen("<table style='visibility:hidden'><tr><td>a<td style='visibility:visible'>b</table>").split() == ["|", "b"]
    assert seen("<div style='display:none'><p style='visibility:visible'>a</div>b") == "b"


def test_pre_and_options():
    assert seen("<pre>\nx <b>q</b>\n\n\n  r\n</pre>s") == "x q\n\n\n  r\n\ns"
    assert seen("<pre>a<ul><li>x<li>q</ul>r</pre>") == "a\n\n- x\n- q\n\nr"
    assert seen("one<select><option>o1<option>o2</select>two") == "one\no1\no2\ntwo"
    assert seen("a<br>b<br><br>c") == "a\nb\n\nc"


def test_hiding_at_any_depth():
    for n in (10, 148, 149, 150, 5000):
        assert seen("<div>" * n + "<div hidden>SECRET<p>x</div>yes" + "</div>" * n) == "yes"
        assert seen("<b>" * n + "<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>x<td>y</table>") == "- a\n- b\n  - c\n\nx | y"


@pytest.mark.parametrize("part", ["<a ", "<a b='", '<a b="', "<!", "<!--", "</", "</a ", "<script>", "<a b = ", "<textarea>", "<", "&", "&#", "<a b==", "<td>", "<table>", "<li>", "x<br>", "<script></script "])
def test_broken_pages_take_time_by_their_size(part):
    began = time.time()
    seen("seen" + part * (1_000_000 // len(part) // (1 if part.startswith("<a") else 4)))
    assert time.time() - began < (2 if part == "<a " else 20)


def test_broken_tags():
    assert seen("a<a b = >c") == "ac" and seen("a<a title=it's>b</a>c") == "abc" and seen("x<a href='>'>b") == "xb"
    assert seen("a<!>b<!doctype html>c</>d<!-->e<!-- f --!>g") == "abcdeg"
    assert seen("1 < 2 <3 & 4") == "1 < 2 <3 & 4"
    assert seen("a<a b") == "a" and seen("a<p title=\"b>c") == "a\n\nc"
