"""Layout-aware text of HTML pages.

A tree builder with implied tags (a new ``li`` ends the open one, a block ends an
open ``p``, a row opens its table body, ...) turns markup into a tree; a renderer
emits all visible text of it: blocks on lines of their own with blank lines around
paragraphs and headings, list items with markers and indentation, ``pre`` as it
stands, and tables with cells padded to the width of their column, where a cell that
spans columns or rows leaves the places it covers empty.  Hidden are ``head`` content,
scripts, styles, templates, closed dialogs, closed details but for their summary, what
a drawing defines without drawing it, and elements that are hidden by attribute or
inline style.

Defined results: null and empty pages give an empty text; unclosed and stray tags
never lose text; elements nest to any depth (the tree is built and rendered with
stacks of its own); numbers of any length are read as HTML does, spans are at most
1 000 columns and 65 534 rows, list numbers within 32 bits, and a character reference
beyond Unicode is U+FFFD; repeated rows are extracted alike; other columns pass through.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript title iframe object embed noembed noframes datalist annotation annotation-xml".split())
#: What an svg element holds without showing it.
UNDRAWN = frozenset("defs desc metadata symbol clippath mask marker pattern".split())
BLOCKS = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary "
                    "table tbody td tfoot th thead tr caption ul").split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset".split())
CLOSES_P = BLOCKS - frozenset("body html td th tr tbody thead tfoot caption li dd dt option optgroup legend summary".split())
#: A start tag ends open elements of these names, up to the nearest of the names that bound it.
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist", "optgroup")), "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "caption"), ("table",)), "thead": (("tbody", "thead", "tfoot", "caption"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption"), ("table",)), "body": (("head",), ("html",)),
}

TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?:!|\?)[^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s\"'>]+))?")
WHITE = re.compile(r"[ \t\n\r\f]+")
INTEGER = re.compile(r"[ \t\n\f\r]*([+-]?)0*([0-9]*)")
ZEROS = re.compile(r"(&#[xX]?)0+(?=[0-9a-fA-F])")
TOO_HIGH = re.compile(r"&#(?:[xX][0-9a-fA-F]{7,}|[0-9]{8,});?")  # beyond 10FFFF
NO_DISPLAY = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag, attrs=None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


def integer(text: str, default: int, low: int, high: int) -> int:
    """The number that ``text`` starts with, moved into the range; any number of digits."""
    m = INTEGER.match(text)
    if not m[0].strip(" \t\n\f\r+-"):
        return default
    size = int(m[2] or 0) if len(m[2]) < 12 else 10 ** 12
    return min(high, max(low, -size if m[1] == "-" else size))


def unescape(text: str) -> str:
    if "&" not in text:
        return text
    if "&#" in text:
        text = TOO_HIGH.sub("\ufffd", ZEROS.sub(r"\1", text))
    return entities.unescape(text)


def attributes(text: str) -> dict:
    out = {}
    for m in ATTR.finditer(text):
        v = m[2] or ""
        if v[:1] in "\"'" and v:
            v = v[1:-1] if len(v) > 1 and v[-1] == v[0] else v[1:]
        out.setdefault(m[1].lower(), unescape(v))
    return out


def parse(markup: str) -> Node:
    root = Node("#root")
    stack = [root]
    places: dict[str, list[int]] = {}  # where open elements of each name stand in the stack

    def last(names) -> int:
        return max((places[x][-1] for x in names if places.get(x)), default=0)

    def cut_at(i):
        while len(stack) > i:
            places[stack.pop().tag].pop()

    def close(names, bounds):
        """Ends the outermost open element of ``names`` above the nearest of ``bounds``."""
        if any(places.get(x) for x in names):
            bound = last(bounds)
            above = [at[k] for x in names if (at := places.get(x)) and (k := bisect(at, bound)) < len(at)]
            if above:
                cut_at(min(above))

    def open_(tag, attrs=None):
        if tag in UNDRAWN and places.get("svg"):
            attrs = {**(attrs or {}), "hidden": ""}
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        places.setdefault(tag, []).append(len(stack))
        stack.append(node)
        return node

    def add_text(text):
        if text:
            stack[-1].children.append(unescape(text))

    at, n = 0, len(markup)
    while at < n:
        m = TOKEN.search(markup, at)
        if m is None:
            add_text(markup[at:])
            break
        add_text(markup[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "br":
                stack[-1].children.append(Node("br"))
            elif tag not in VOID:
                bounds = ("table",) if tag not in ("table", "html", "body") else ()
                if last((tag,)) > last(bounds):
                    cut_at(last((tag,)))
            continue
        attrs = attributes(m[3]) if m[3] and not m[3].isspace() else None
        if tag in CLOSES_P:
            close(("p",), ("table", "td", "th", "button", "caption", "li", "blockquote", "div", "article", "section", "body"))
        if tag in IMPLIED_END:
            close(*IMPLIED_END[tag])
        elif tag in BLOCKS and places.get("head"):
            close(("head",), ("html",))
        if tag in ("td", "th") and stack[-1].tag != "tr" and places.get("table"):
            open_("tr")
        if tag in VOID:
            stack[-1].children.append(Node(tag, attrs))
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(markup, at)
            node = Node(tag, attrs)
            stack[-1].children.append(node)
            body = markup[at:end.start() if end else n]
            at = end.end() if end else n
            node.children.append(entities.unescape(body) if tag in ("title", "textarea") else body)
        else:
            open_(tag, attrs)
    return root


def is_hidden(node: Node) -> bool:
    if node.tag in HIDDEN:
        return True
    a = node.attrs
    if node.tag == "dialog" and "open" not in a:
        return True
    if not a:
        return False
    return "hidden" in a or (node.tag == "input" and a.get("type", "").lower() == "hidden") or bool(NO_DISPLAY.search(a.get("style", "")))


def shown(node: Node) -> list:
    """The children, of closed details the first summary only."""
    if node.tag != "details" or "open" in node.attrs:
        return node.children
    return [c for c in node.children if not isinstance(c, str) and c.tag == "summary"][:1]


class Lines:
    """Collects text into lines; ``gap`` is the number of blank lines owed before the next text."""

    def __init__(self):
        self.lines, self.line, self.gap, self.space = [], "", 0, False

    def text(self, s: str):
        words = WHITE.sub(" ", s)
        if words == " " or not words:
            self.space = self.space or (bool(words) and bool(self.line))
            return
        lead = words[0] == " " and self.line
        if (lead or self.space) and self.line and not self.line.endswith(" "):
            self.line += " "
        self.line += words.strip(" ")
        self.space = words[-1] == " "

    def end_line(self):
        if self.line.strip(" "):
            if self.lines:
                self.lines += [""] * self.gap
            self.lines.append(self.line.rstrip(" "))
            self.gap = 0
        self.line, self.space = "", False

    def block(self, gap: int = 0):
        self.end_line()
        self.gap = max(self.gap, gap)

    def raw_lines(self, lines):
        self.end_line()
        while lines and not lines[0].strip():
            lines = lines[1:]
        while lines and not lines[-1].strip():
            lines = lines[:-1]
        if lines:
            if self.lines:
                self.lines += [""] * self.gap
            self.lines += lines
            self.gap = 0

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


def _run(step):
    """Runs a generator that yields generators to be run in its place: calls of any depth without recursion."""
    steps = [step]
    while steps:
        inner = next(steps[-1], None)
        if inner is None:
            steps.pop()
        else:
            steps.append(inner)


def _pre_text(node: Node) -> str:
    out, open_ = [], [iter(node.children)]
    while open_:
        c = next(open_[-1], None)
        if c is None:
            open_.pop()
        elif isinstance(c, str):
            out.append(c)
        elif c.tag == "br":
            out.append("\n")
        elif not is_hidden(c):
            open_.append(iter(shown(c)))
    return "".join(out)


def _rows(table: Node):
    """The rows of a table's own (not of a table within it): captions, then lists of cells."""
    open_ = [iter(table.children)]
    while open_:
        c = next(open_[-1], None)
        if c is None:
            open_.pop()
        elif isinstance(c, str):
            if c.strip():
                yield [c]
        elif is_hidden(c):
            continue
        elif c.tag == "tr":
            yield [x for x in c.children if (x.strip() if isinstance(x, str) else not is_hidden(x))]
        elif c.tag in ("tbody", "thead", "tfoot"):
            open_.append(iter(c.children))
        else:
            yield [c]


def _spans(cell) -> tuple[int, int]:
    """Columns and rows that a cell covers; a rowspan of 0 covers all rows that follow."""
    if isinstance(cell, str):
        return 1, 1
    rows = integer(cell.attrs.get("rowspan", ""), 1, -1, 65534)
    columns = integer(cell.attrs.get("colspan", ""), 1, 0, 1000)
    return max(columns, 1), 65534 if rows == 0 else max(rows, 1)


def _table(node: Node, out: Lines):
    rows: list[tuple[int, dict[int, list[str]]]] = []  # columns of a row, and the lines of its cells by column
    covered: dict[int, int] = {}  # rows that cells above still cover, by column
    for cells in _rows(node):
        row, at, above = {}, 0, covered
        covered = {k: n - 1 for k, n in above.items() if n > 1}
        for c in cells:
            while at in above:
                at += 1
            lines = Lines()
            if isinstance(c, str):
                lines.text(c)
            else:
                yield _children(c, lines)
            row[at] = lines.result() or [""]
            columns, deep = _spans(c)
            if deep > 1:
                covered |= dict.fromkeys(range(at, at + columns), deep - 1)
            at += columns
        while at in above:
            at += 1
        if any(any(x) for x in row.values()):
            rows.append((at, row))
    widths: dict[int, int] = {}
    for size, row in rows:
        if size > 1:
            for k, cell in row.items():
                widths[k] = max(widths.get(k, 0), max(map(len, cell)))
    text = []
    for size, row in rows:
        for i in range(max(map(len, row.values()))):
            cells = [row[k][i] if k in row and i < len(row[k]) else "" for k in range(size)]
            text.append(" | ".join(c.ljust(widths.get(k, 0)) for k, c in enumerate(cells)).rstrip() if size > 1 else cells[0])
    out.raw_lines(text)


def _list(node: Node, out: Lines):
    number = integer(node.attrs.get("start", ""), 1, -(1 << 31), (1 << 31) - 1)
    for c in node.children:
        if isinstance(c, str):
            out.text(c)
            continue
        if is_hidden(c):
            continue
        if c.tag != "li":
            yield _render(c, out)
            continue
        mark = f"{number}. " if node.tag == "ol" else "- "
        number += 1
        item = Lines()
        yield _children(c, item)
        lines = item.result()
        if lines:
            pad = " " * len(mark)
            out.raw_lines([mark + lines[0]] + [pad + x if x else x for x in lines[1:]])


def _children(node: Node, out: Lines):
    for c in shown(node):
        if isinstance(c, str):
            out.text(c)
        else:
            yield _render(c, out)


def _render(node: Node, out: Lines):
    tag = node.tag
    if is_hidden(node):
        return
    if tag == "br":
        out.end_line()
    elif tag == "hr":
        out.block(0)
        out.raw_lines(["---"])
    elif tag == "img":
        out.text(node.attrs.get("alt", ""))
    elif tag == "text":  # a piece of a drawing stands by itself
        out.text(" ")
        yield _children(node, out)
        out.text(" ")
    elif tag == "pre":
        out.block(1)
        out.raw_lines([x.rstrip() for x in _pre_text(node).split("\n")])
        out.block(1)
    elif tag == "table":
        out.block(1)
        yield _table(node, out)
        out.block(1)
    elif tag in ("ul", "ol", "menu", "dir"):
        inside = bool(out.line)
        out.block(0 if inside else 1)
        yield _list(node, out)
        out.block(0 if inside else 1)
    elif tag in BLOCKS:
        gap = 1 if tag in SPACED else 0
        out.block(gap)
        if tag in ("dd", "blockquote"):
            inner = Lines()
            yield _children(node, inner)
            out.raw_lines(["  " + x if x else x for x in inner.result()])
        else:
            yield _children(node, out)
        out.block(gap)
    else:
        yield _children(node, out)


def visible_text(markup: str | None) -> str:
    if not markup:
        return ""
    out = Lines()
    _run(_children(parse(markup.replace("\r\n", "\n")), out))
    return "\n".join(out.result())


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """Replace ``html_col`` by ``out_col``, the page's visible text."""
    keep = [f for f in pages.schema.fields if f.name not in (html_col, out_col)]
    names = [f.name for f in keep]

    def run(batches):
        for batch in batches:
            for at, texts in slices(batch, html_col):
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(i) for i in range(len(names))]
                                                 + [pa.array([visible_text(x) for x in texts], pa.string())], names + [out_col])

    return (pages.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{html_col}`"))
            .mapInArrow(run, T.StructType(keep + [T.StructField(out_col, T.StringType())])))
