"""Visible text of web pages: a tree with implied tags, rendered with layout."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from pitmark.llm.common import batch, texts_of

_OUT = pa.schema([("page_id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64())])
#: Comments and the like, tags, and a tag that the page ends in. No part is read twice, so broken pages take no longer.
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?>[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+|=)*+)>"
    r"|<(?=/?[a-zA-Z]).*+",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_DECLARATION = re.compile(r"\s*(display|visibility)\s*:\s*([a-z -]*[a-z])\s*(!\s*important)?\s*", re.I)
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_SPACE = re.compile(r"[ \t\n\r\f]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_UNSEEN = frozenset("head script style title template noscript iframe object audio video canvas datalist noembed noframes".split())
#: Parts of drawings and formulas that only describe or define.
_UNDRAWN = frozenset("defs desc metadata symbol clippath mask pattern marker filter lineargradient radialgradient annotation annotation-xml".split())
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+(?:>|\Z)", re.I) for t in _RAW}
#: Elements set off by a blank line, and those that only begin a line.
_APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr".split())
_BLOCK = _APART | frozenset("html body div article section nav header footer main aside address form li dt dd tr caption figcaption details summary legend center hgroup search menu dir option optgroup text".split())
#: A start tag ends an open element of these, looking no further up than the bounds.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"})),
}
_SCOPE = frozenset("table td th caption html button".split())
#: Lists and quotations are moved to the right by no more than this.
_INDENT = 80
_CELL, _ROW = 1, 2


_SELECTOR = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#]-?[a-zA-Z_][\w-]*)*)")


class Sheet:
    """Rules of a page's own style sheets for ``display`` and ``visibility``.

    Selectors count if they are an element, classes and ids, or all of these at
    once; others, as those of descendants or states, and blocks of at-rules, as
    those for print, are left out.
    """

    def __init__(self) -> None:
        self.rules: dict[str, list[tuple]] = defaultdict(list)
        self.n = 0

    def add(self, source: str) -> None:
        source, depth, at, selector = _CSS_COMMENT.sub(" ", source), 0, 0, ""
        for m in re.finditer("[{};]", source):
            if m[0] == "{":
                if depth == 0:
                    selector, body = source[at : m.start()].strip(), m.end()
                depth += 1
            elif m[0] == "}" and depth:
                depth -= 1
                if depth == 0:
                    if not selector.startswith("@"):
                        self.rule(selector, source[body : m.start()])
                    at = m.end()
            elif depth == 0:  # the end of an at-rule without a block
                at = m.end()

    def rule(self, selectors: str, body: str) -> None:
        said = [m for part in body.split(";") if (m := _DECLARATION.fullmatch(part))]
        for one in selectors.split(",") if said else ():
            m = _SELECTOR.fullmatch(one.strip())
            if not m or not m[0]:
                continue
            tag, names = (m[1] or "*").lower(), re.findall("[.#][^.#]+", m[2])
            ids, classes = {x[1:] for x in names if x[0] == "#"}, {x[1:] for x in names if x[0] == "."}
            key = f"#{min(ids)}" if ids else f".{min(classes)}" if classes else tag
            for d in said:
                self.n += 1
                self.rules[key].append((d[1].lower(), (bool(d[3]), len(ids), len(classes), tag != "*", self.n), d[2].lower(), tag, ids, classes))

    def style(self, node: Node, name: str) -> tuple[str | None, bool]:
        """Value of the strongest rule that fits, and whether it is marked important."""
        if not self.rules:
            return None, False
        own, classes = node.get("id"), set((node.get("class") or "").split())
        keys = [node.tag, "*", *[f".{c}" for c in classes], *([f"#{own}"] if own else [])]
        fits = [r for k in keys for r in self.rules.get(k, ()) if r[0] == name and r[3] in ("*", node.tag) and r[4] <= {own} and r[5] <= classes]
        best = max(fits, key=lambda r: r[1], default=None)
        return (best[2], best[1][0]) if best else (None, False)


_NO_SHEET = Sheet()


class Node:
    __slots__ = ("_found", "attributes", "children", "holds", "sheet", "tag")

    def __init__(self, tag: str, attributes: str = "", sheet: Sheet = _NO_SHEET):
        self.tag, self.attributes, self.children, self.sheet = tag, attributes, [], sheet
        #: Cells and rows below, but not those in a table of their own.
        self.holds = 0
        self._found: dict[str, str] | None = None if attributes and not attributes.isspace() else {}

    def get(self, name: str) -> str | None:
        """An attribute's value, empty if it has none, None if it is absent; the first of a name counts."""
        if self._found is None:
            self._found = {}
            for m in _ATTRIBUTE.finditer(self.attributes):
                self._found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        return self._found.get(name)

    def number(self, name: str, default: int, least: int = -(10**9), most: int = 10**9) -> int:
        m = re.match(r"\s*([+-]?\d{1,9})", self.get(name) or "")
        return default if m is None or int(m[1]) < least else min(most, int(m[1]))

    def style(self, name: str) -> str | None:
        """Value of a style property: the element's last declaration, else the page's rules; any marked important before others."""
        value, strong = None, False
        ruled, stronger = self.sheet.style(self, name)
        if "style" not in self.attributes.lower():
            return ruled
        for part in _CSS_COMMENT.sub(" ", self.get("style") or "").split(";"):
            m = _DECLARATION.fullmatch(part)
            if m and m[1].lower() == name and (m[3] or not strong):
                value, strong = m[2].lower(), bool(m[3])
        return ruled if value is None or (stronger and not strong) else value

    def shown(self) -> bool:
        """False if the element makes no box: by its kind, its display, or its attributes where display doesn't say."""
        if self.tag in _UNSEEN or self.tag in _UNDRAWN:
            return False
        display = self.style("display")
        if display is not None:
            return display != "none"
        return self.get("hidden") is None and (self.tag != "dialog" or self.get("open") is not None)


class Tree:
    """Elements and texts in document order; ends that are left out are put in.

    A head is no element here: what it may hold is unseen by itself, and the
    first other thing closes it.
    """

    def __init__(self, source: str):
        self.sheet = Sheet()
        self.root = Node("html")
        self.stack = [self.root]
        #: Places in the stack of the open elements of each tag.
        self.open: dict[str, list[int]] = defaultdict(list)
        at = 0
        while m := _TOKEN.search(source, at):
            if m.start() > at:
                self.text(source[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self.end(tag)
                continue
            self.start(tag, m[3])
            if tag in _RAW:
                close = _RAW_END[tag].search(source, at)
                stop = close.start() if close else len(source)
                if tag == "textarea":
                    self.text(source[at:stop])
                elif tag == "style":
                    self.sheet.add(source[at:stop])
                at = close.end() if close else len(source)
                self.end(tag)
        if at < len(source):
            self.text(source[at:])

    def text(self, said: str) -> None:
        self.stack[-1].children.append(html.unescape(said))

    def close(self, tags: set, bounds: frozenset | set) -> None:
        last = lambda names: max((self.open[t][-1] for t in names if self.open[t]), default=0)
        at = last(tags)
        if not at or at < last(bounds):
            return
        while len(self.stack) > at:
            self.open[self.stack.pop().tag].pop()

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "head") or (tag == "body" and self.open[tag]):
            return
        if tag in _ENDS:
            self.close(*_ENDS[tag])
        elif tag in _BLOCK and tag not in ("body", "text"):
            self.close({"p"}, _SCOPE)
        if tag in ("td", "th") and self.stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self.push(Node("tr"), True)
        drawn = self.open["svg"] or self.open["math"]
        self.push(Node(tag, attributes, self.sheet), tag not in _VOID and not (drawn and attributes.endswith("/")))

    def push(self, node: Node, stays: bool) -> None:
        self.stack[-1].children.append(node)
        kind = _CELL if node.tag in ("td", "th") else _ROW if node.tag == "tr" else 0
        if kind:
            for above in reversed(self.stack):
                if above.tag == "table" or above.holds & kind:
                    break
                above.holds |= kind
        if stays:
            self.open[node.tag].append(len(self.stack))
            self.stack.append(node)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.push(Node("br"), False)
        elif tag == "p" and not self.open["p"]:
            self.push(Node("p"), False)
        elif tag not in _VOID:
            self.close({tag}, set() if tag in ("table", "body", "html") else {"table"} - {tag})


class Cell(NamedTuple):
    lines: list[str]
    columns: int = 1
    #: Rows the cell reaches over; 0 for all that are left of its section.
    rows: int = 1


def unwind(task: Iterator) -> object:
    """Run a walk whose steps yield the walks below them: pages nested at any depth need no deeper Python stack."""
    stack, value = [task], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as e:
            stack.pop()
            value = e.value
    return value


class Page:
    """Lines of a box; blank lines are held back until text follows. Its walks are for ``unwind``."""

    def __init__(self, hidden: bool = False) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = self.blank = 0
        self.indent, self.mark = "", ""
        self.hidden, self.exact = hidden, 0

    def inline(self, said: str) -> None:
        if self.hidden:
            return
        if self.exact:
            first, *rest = said.expandtabs().split("\n")
            self.now.append(first)
            for line in rest:
                self.newline()
                self.now.append(line)
            return
        said = _SPACE.sub(" ", said)
        if not self.now or self.now[-1][-1:] == " ":
            said = said.lstrip(" ")
        if said:
            self.now.append(said)

    def line(self) -> str:
        said = "".join(self.now).rstrip(" ")
        self.now = []
        return said

    def newline(self) -> None:
        """A line end that counts, also where nothing stands before it."""
        if line := self.line():
            self.put(line)
        elif self.lines:
            self.blank += 1

    def line_end(self) -> None:
        """What ``br`` does: a second one in a row leaves a blank line."""
        if self.exact:
            self.newline()
        elif line := self.line():
            self.put(line)
        elif self.lines:
            self.gap = max(self.gap, 1)

    def break_(self, gap: int = 0) -> None:
        """End the line; the next one comes after ``gap`` blank lines at least."""
        if line := self.line():
            self.put(line)
        self.gap = max(self.gap, gap)

    def put(self, line: str) -> None:
        if self.lines:
            self.lines += [""] * (self.gap + self.blank)
        self.gap = self.blank = 0
        self.lines.append(self.indent + self.mark + line)
        self.mark = " " * len(self.mark)

    def further(self, by: int) -> str:
        return " " * min(_INDENT, len(self.indent) + by)

    def walk(self, node: Node) -> Iterator:
        for child in node.children:
            if isinstance(child, str):
                self.inline(child)
            elif child.shown():
                yield self.element(child)
            elif child.tag in _BLOCK and not self.exact:
                self.inline(" ")  # what stands before and after a block without a box are not one word

    def element(self, node: Node) -> Iterator:
        tag, hidden = node.tag, self.hidden
        seen = node.style("visibility")
        if seen is not None:
            self.hidden = seen in ("hidden", "collapse")
        if tag == "br":
            self.line_end()
        elif tag not in _BLOCK:
            yield self.walk(node)
        else:
            yield self.block(node)
        self.hidden = hidden

    def block(self, node: Node) -> Iterator:
        tag = node.tag
        gap = int(tag in _APART and not (tag in ("ul", "ol") and self.indent + self.mark))
        self.break_(gap)
        if tag == "table":
            yield self.table(node)
        elif tag == "pre":
            if node.children and isinstance(node.children[0], str):
                node.children[0] = node.children[0].removeprefix("\r").removeprefix("\n")
            self.exact += 1
            yield self.walk(node)
            self.exact -= 1
            self.break_()
            self.blank = 0
        elif tag in ("ul", "ol", "menu", "dir"):
            yield self.items(node)
        elif tag in ("dd", "blockquote"):
            self.indent, kept = self.further(2), self.indent
            yield self.walk(node)
            self.break_()
            self.indent = kept
        elif tag == "details" and node.get("open") is None:
            for child in node.children:
                if isinstance(child, Node) and child.tag == "summary":
                    yield self.walk(child)
                    break
        else:
            yield self.walk(node)
        self.break_(gap)

    def items(self, node: Node) -> Iterator:
        n = node.number("start", 1)
        for child in node.children:
            if isinstance(child, str):
                if child.strip() or not self.exact:
                    self.inline(child)
            elif not child.shown():
                continue
            elif child.tag != "li":
                yield self.element(child)
            else:
                self.break_()
                n = child.number("value", n)
                kept = self.indent, self.mark
                self.indent = self.further(len(self.mark))
                seen = child.style("visibility")
                hidden = self.hidden if seen is None else seen != "visible"
                mark = f"{n}. " if node.tag == "ol" else "- "
                self.mark = " " * len(mark) if hidden else mark
                n += 1
                yield self.element(child)
                self.break_()
                self.indent, self.mark = kept[0], " " * len(kept[1])

    def table(self, node: Node) -> Iterator:
        """Rows on lines, columns as wide as their widest cell; a caption before them."""
        rows: list[tuple[int, Node | None, list[Cell]]] = []
        todo, loose = [(iter(node.children), None)], None
        while todo:
            children, section = todo[-1]
            place = {"thead": 0, "tfoot": 2}.get(section.tag if section else "", 1)
            child = next(children, None)
            if child is None:
                todo.pop()
            elif isinstance(child, str):
                if child.strip():
                    self.inline(child)
                    self.break_()
                continue
            elif not child.shown():
                continue
            elif child.tag == "tr":
                rows.append((place, section, (yield self.cells(child))))
            elif child.tag in ("td", "th"):
                # a cell that something misnested keeps from its row: it goes on with the cell before it
                cell = yield self.cell(child)
                if loose is children:
                    rows[-1][2].append(cell)
                else:
                    rows.append((place, section, [cell]))
                loose = children
                continue
            elif child.tag in ("thead", "tbody", "tfoot") or child.holds:
                todo.append((iter(child.children), child if child.tag in ("thead", "tbody", "tfoot") else section))
            else:
                yield self.element(child)
                self.break_()
            loose = None
        for line in laid_out(sorted(rows, key=lambda r: r[0])):
            self.put(line)

    def cell(self, node: Node) -> Iterator:
        seen = node.style("visibility")
        box = Page(self.hidden if seen is None else seen != "visible")
        yield box.walk(node)
        box.break_()
        return Cell(box.lines, node.number("colspan", 1, 1, 1000), node.number("rowspan", 1, 0, 65534))

    def cells(self, row: Node) -> Iterator:
        """The cells of a row, also those inside other elements; anything else that is seen is a cell of its own."""
        found: list[Cell] = []
        for c in row.children:
            if isinstance(c, str):
                if c.strip() and not self.hidden:
                    found.append(Cell([_SPACE.sub(" ", c).strip()]))
            elif not c.shown():
                continue
            elif c.tag in ("td", "th"):
                found.append((yield self.cell(c)))
            elif c.holds & _CELL:
                found += yield self.cells(c)
            else:
                box = Page(self.hidden)
                yield box.element(c)
                box.break_()
                if box.lines:
                    found.append(Cell(box.lines))
        return found


def laid_out(rows: list[tuple[int, Node | None, list[Cell]]]) -> Iterator[str]:
    """Lines of a table. A cell takes the next columns that no cell from above reaches into.

    Columns in which no cell begins take no room. A cell over several columns
    widens the last of them if it must.
    """
    placed: list[list[tuple[int, Cell]]] = []
    reach: dict[int, int] = {}  # column -> first row that is free again
    section: Node | None = None
    for y, (_, group, cells) in enumerate(rows):
        if y and group is not section:
            reach = {}
        section, x, out = group, 0, []
        for cell in cells:
            while reach.get(x, 0) > y:
                x += 1
            out.append((x, cell))
            if cell.rows != 1:
                stop = y + cell.rows if cell.rows else len(rows)
                reach.update(dict.fromkeys(range(x, x + cell.columns), stop))
            x += cell.columns
        placed.append(out)
    used = sorted({x for out in placed for x, _ in out})
    number = {x: i for i, x in enumerate(used)}
    spans = [[(number[x], bisect_left(used, x + cell.columns), cell.lines) for x, cell in out] for out in placed]
    widths = [0] * len(used)
    for first, stop, lines in sorted((s for out in spans for s in out), key=lambda s: s[1] - s[0]):
        room = sum(widths[first:stop]) + 3 * (stop - first - 1)
        widths[stop - 1] += max(0, max(map(len, lines), default=0) - room)
    starts = [0, *accumulate(w + 3 for w in widths)]
    for out in spans:
        for k in range(max((len(lines) for _, _, lines in out), default=0)):
            if any(lines[k:] and lines[k].strip() for _, _, lines in out):
                line = ""
                for first, _, lines in out:
                    line = line.ljust(starts[first] - 3) + " | " if first else line
                    line += lines[k] if k < len(lines) else ""
                yield line.rstrip()


def visible_text(source: str) -> str:
    page = Page()
    unwind(page.walk(Tree(source).root))
    page.break_()
    return "\n".join(page.lines)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row: page_id, text (what a reader would see), n_lines.

    Unseen are elements that hide their content, ``display: none``, and the
    ``hidden`` attribute unless a display style says otherwise; the last
    declaration of a style counts, important ones first. The page's own style
    sheets are read for display and visibility, as ``Sheet`` says; linked ones,
    and rules on descendants, states and media, are not. The text of drawings
    and formulas is seen, without what only describes or defines them. A hidden
    ``visibility`` passes to what is below until something there is visible.
    Paragraphs, headings, lists and tables are set apart by a blank line; list
    items carry their mark and depth (moved right by 80 columns at most);
    options stand on lines of their own; ``pre`` keeps its spaces and lines.
    Table cells stand in columns, with colspan up to 1000 and rowspan up to
    65534, as the HTML standard has it; what spans several rows is printed in
    the first, the rows of thead first and of tfoot last. Pages may be nested
    at any depth; time grows with the length of the page, also where tags are
    broken. A tag that the page ends in is no text. There is no shuffle.

    Null and blank html give empty text; a null id stays null; repeated rows
    get a row each; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [visible_text(t) for t in texts_of(b.column(1))]
            yield batch(_OUT, page_id=b.column(0), text=texts, n_lines=[t.count("\n") + 1 if t else 0 for t in texts])

    return pages.select(pages[id_col].cast("long").alias("id"), pages[html_col].alias("html")).mapInArrow(run, "page_id long, text string, n_lines long")
