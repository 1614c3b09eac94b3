"""Rows of tables whose cells are inside other elements."""

from html.parser import HTMLParser

import pytest

from pitmark.llm import html_text

CELLS = ["<td>alpha<td>beta", "<th>alpha</th><td>beta</td>", "<td><p>alpha</p><b>beta</b>", "<a>alpha</a><td>beta", "alpha<td>beta <i>gamma</i>", "<td>alpha<table><tr><form><td>beta<td>gamma</form></table>"]
AROUND = ["{}", "<form>{}</form>", "<center>{}</center>", "<font>{}", "<div><form>{}</form></div>", "<span><b>{}</b></span>"]


def words(page):
    said = []
    p = HTMLParser()
    p.handle_data = lambda data: said.extend(data.split())
    p.feed(page)
    p.close()
    return said


@pytest.mark.parametrize("around", AROUND)
@pytest.mark.parametrize("cells", CELLS)
@pytest.mark.parametrize("row", ["<tr>{}</tr>", "<tbody><tr>{}", "{}"])
def test_misnested_rows_keep_every_word(row, cells, around):
    for page in (f"<table>{row.format(around.format(cells))}</table>end", f"<table>{around.format(row.format(cells))}</table>end"):
        assert sorted(w for w in html_text.visible_text(page).split() if w != "|") == sorted(words(page)), page


def test_misnested_rows_stand_in_columns():
    assert html_text.visible_text("<table><tr><form><td>a<td>b</form><tr><td>cc<td>d</table>") == "a  | b\ncc | d"
    assert html_text.visible_text("<table><tr><font>x</font><td>y</table>") == "x | y"
    assert html_text.visible_text("<table><form><td>a<td>b</form></table>") == "a | b"
    assert html_text.visible_text("<table><tr><form hidden><td>a</form><td>b</table>") == "b"
    assert html_text.visible_text("<table><tr><td>|</table>") == "|"
