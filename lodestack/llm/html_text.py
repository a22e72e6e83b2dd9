"""HTML extraction by layout-aware rendering.

A tree builder supplies implied tags (ends of paragraphs, list items, rows and cells, and rows left out);
visibility rules drop what a browser does not show; rendering emits all visible text with block spacing, list
marks and indents, preformatted text as it is, and tables as aligned columns, cells that span rows or columns too.
Rules are those of elements, attributes and inline styles; style sheets are not applied.

Defined results: a null html gives null, an empty one an empty text; elements without an end are closed at the end,
however deep; a tag that is cut off takes the rest of the page, as in browsers; a page without tags is its own text.
Cells wider than ``WIDEST_PAD`` are not padded to. An existing column named by ``out`` is replaced.
"""

from __future__ import annotations

import html
import re
import sys
import unicodedata
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDEST_PAD = 400

#: Element names.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
_HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas datalist area dialog annotation annotation-xml defs symbol metadata title".split())
_SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure form fieldset hr xmp address".split())
_BLOCK = _SPACED | frozenset("html body div section article aside header footer main nav li dt dd tr td th caption thead tbody tfoot figcaption details summary center legend search hgroup".split())
_CLOSES_P = _SPACED | frozenset("div section article aside header footer main nav details center hgroup search".split())
_ENDED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}
_SECTIONS = frozenset("thead tbody tfoot".split())

#: Where a token begins, and a token from there; only a tag can be cut off.
_OPENS = re.compile(r"<(?:[!?]|/?[a-zA-Z])")
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)", re.I)
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "inner")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.inner = tag, attrs, []


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def tree(page: str) -> Node:
    """The element tree of a page, text as strings among the children."""
    root = Node("#root", {})
    open_, held, at, n = [root], Counter(), 0, len(page)

    def close(names: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> None:
        if not any(held[x] for x in names):
            return
        for i in range(len(open_) - 1, 0, -1):
            if open_[i].tag in until:
                return
            if open_[i].tag in names:
                held.subtract(x.tag for x in open_[i:])
                del open_[i:]
                return

    def push(tag: str, attrs: dict[str, str]) -> None:
        node = Node(tag, attrs)
        open_[-1].inner.append(node)
        open_.append(node)
        held[tag] += 1

    while at < n:
        start = _OPENS.search(page, at)
        stop = start.start() if start else n
        if stop > at:
            open_[-1].inner.append(html.unescape(page[at:stop]))
        m = _TOKEN.match(page, stop) if start else None
        if m is None:  # the end, or a tag without one
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                open_[-1].inner.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not held["p"]:
                open_[-1].inner.append(Node("p", {}))
            elif tag == "br":
                open_[-1].inner.append(Node("br", {}))
            else:
                close({tag}, {"table"} if tag not in ("table", "html", "body") else set())
            continue
        if tag in _CLOSES_P:
            close({"p"}, {"table", "td", "th", "button"})
        if tag in _ENDED_BY:
            names, until = _ENDED_BY[tag]
            close(names, until)
            if tag == "tr":
                close({"tr"}, {"table"})
        if tag in _SECTIONS:
            close(_SECTIONS, {"table"})
        if tag == "body":
            close({"head"}, set())
        if tag in ("td", "th") and open_[-1].tag in _SECTIONS | {"table"}:
            push("tr", {})
        attrs = _attributes(m[3]) if m[3] else {}
        if tag in _VOID:
            open_[-1].inner.append(Node(tag, attrs))
        elif tag in _RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            node, stop = Node(tag, attrs), end.start() if end else n
            node.inner.append(html.unescape(page[at:stop]) if tag in ("title", "textarea") else page[at:stop])
            open_[-1].inner.append(node)
            at = end.end() if end else n
        elif m[3].endswith("/") and (held["svg"] or held["math"]):  # only there a tag can end itself
            open_[-1].inner.append(Node(tag, attrs))
        else:
            push(tag, attrs)
    return root


def visible(node: Node) -> bool:
    a = node.attrs
    if node.tag in _HIDDEN:
        return node.tag == "dialog" and "open" in a
    return not (a and ("hidden" in a or (node.tag == "input" and a.get("type", "").lower() == "hidden") or _UNSEEN.search(a.get("style", ""))))


def settle_visibility(root: Node) -> None:
    """Takes away what ``visibility`` hides. It is inherited, so a visible child of a hidden element stays, in its place."""
    order: list[tuple[Node, Node | None, bool]] = [(root, None, False)]
    for node, _, hidden in order:  # grows while it is read
        for child in node.inner:
            if not isinstance(child, str):
                told = _VISIBILITY.search(child.attrs.get("style", "")) if child.attrs else None
                order.append((child, node, told[1].lower() != "visible" if told else hidden))
    shown: set[int] = set()
    for node, parent, hidden in reversed(order):
        if hidden:
            node.inner = [c for c in node.inner if not isinstance(c, str) and id(c) in shown]
        if parent is not None and (not hidden or node.inner):
            shown.add(id(node))
            if hidden and node.tag in ("li", "img", "input"):
                node.tag, node.attrs = "div" if node.tag == "li" else "span", {}
    for node, _, hidden in order:
        if not hidden:
            node.inner = [c for c in node.inner if isinstance(c, str) or id(c) in shown]


def _width(text: str) -> int:
    """Columns that a text takes on a screen: wide letters two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 1 + (unicodedata.east_asian_width(c) in "WF") for c in text)


class _Flow:
    """Lines of one block container, with inline text gathered and blank lines between spaced blocks."""

    def __init__(self, pre: bool = False):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap, self.pre = 0, pre

    def text(self, s: str) -> None:
        self.inline.append(s if self.pre else _BLANKS.sub(" ", s))

    def flush(self) -> None:
        whole = "".join(self.inline)
        self.inline = []
        if self.pre:
            lines = [x.rstrip() for x in whole.split("\n")]
        else:
            lines = [re.sub(" {2,}", " ", x).strip(" ") for x in whole.split("\n")]
        while lines and not lines[0]:
            lines.pop(0)
        while lines and not lines[-1]:
            lines.pop()
        self.add([x.replace("\xa0", " ") for x in lines], 1)

    def add(self, lines: list[str], space: int) -> None:
        """``space``: 1 for a new line, 2 for a blank line before and after."""
        if lines:
            if self.lines and max(space, self.gap) > 1:
                self.lines.append("")
            self.lines += lines
            self.gap = space


def _table(node: Node) -> list[str]:
    rows: list[list[tuple[list[str], int, int]]] = []  # lines, first column and columns of each cell
    taken: dict[int, int] = {}  # columns that cells of earlier rows still take, and for how many rows
    captions: list[str] = []
    stack = [iter(node.inner)]
    loose = _Flow()

    def span(cell: Node, name: str, most: int) -> int:
        value = cell.attrs.get(name, "").strip()
        return max(1, min(most, int(value))) if value.isascii() and value.isdecimal() else 1

    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, str):
            loose.text(child)
        elif not visible(child):
            continue
        elif child.tag == "caption":
            captions += _lines(child)
        elif child.tag == "tr":
            other, row, at, reach = Node("div", {}), [], 0, {}
            for c in child.inner:
                if isinstance(c, str) or c.tag not in ("td", "th"):
                    other.inner.append(c)
                elif visible(c):
                    while taken.get(at, 0):
                        at += 1
                    wide, tall = span(c, "colspan", 1000), span(c, "rowspan", 65534)
                    row.append((_lines(c), at, wide))
                    if tall > 1:
                        reach.update(dict.fromkeys(range(at, at + wide), tall - 1))
                    at += wide
            loose.add(_lines(other), 1)
            taken = {k: v - 1 for k, v in taken.items() if v > 1} | reach
            rows.append(row)
        elif child.tag in _SECTIONS:
            stack.append(iter(child.inner))
            taken = {}
        else:
            loose.add(_lines(child), 1)
    loose.flush()
    widths: dict[int, int] = {}
    for row in rows:
        for lines, at, wide in row:
            if wide == 1:
                widths[at] = max(widths.get(at, 0), min(WIDEST_PAD, max(map(_width, lines), default=0)))
    last = max((at + wide for row in rows for _, at, wide in row), default=0)
    begins = [0]
    for i in range(last):
        begins.append(begins[-1] + (widths[i] + 2 if i in widths else 0))  # a column without a cell of its own has no width
    out = loose.lines + captions
    for row in rows:
        for k in range(max((len(lines) for lines, _, _ in row), default=0)):
            line = ""
            for lines, at, _ in row:
                if k < len(lines) and lines[k]:
                    line += "  " if line else ""
                    line += " " * (begins[at] - _width(line)) + lines[k]
            out.append(line.rstrip())
    return out


def _lines(node: Node, pre: bool = False) -> list[str]:
    """All visible lines of a block, top down."""
    flow = _Flow(pre)
    ordered = node.tag == "ol"
    number = int(node.attrs["start"]) if ordered and re.fullmatch(r"-?\d{1,9}", node.attrs.get("start", "")) else 1
    stack = [iter(node.inner)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
            continue
        if isinstance(child, str):
            flow.text(child)
            continue
        if not visible(child):
            continue
        tag = child.tag
        if tag == "br":
            flow.inline.append("\n")
        elif tag == "img":
            flow.text(child.attrs.get("alt", ""))
        elif tag == "input":
            flow.text(child.attrs.get("value", "") if child.attrs.get("type", "text").lower() in ("text", "button", "submit", "search", "reset") else "")
        elif tag == "select":
            options = [c for x in child.inner if not isinstance(x, str) for c in ([x] if x.tag == "option" else x.inner) if not isinstance(c, str) and c.tag == "option" and visible(c)]
            chosen = [c for c in options if "selected" in c.attrs] or (options if "multiple" in child.attrs else options[:1])
            for c in chosen:
                flow.text(" ")
                flow.text(" ".join(_lines(c)))
            flow.text(" ")
        elif tag == "details" and "open" not in child.attrs:
            shown = Node("div", {})
            shown.inner = [c for c in child.inner if not isinstance(c, str) and c.tag == "summary"]
            flow.flush()
            flow.add(_lines(shown), 1)
        elif tag in _BLOCK or tag == "textarea":
            flow.flush()
            if tag == "table":
                flow.add(_table(child), 2)
            elif tag == "li":
                mark = f"{number}. " if ordered else "- "
                number += 1
                own = _lines(child, pre)
                flow.add([(mark if not i else " " * len(mark)) + x if x else x for i, x in enumerate(own)], 1)
            elif tag in ("dd", "blockquote"):
                flow.add(["  " + x if x else x for x in _lines(child, pre)], 2 if tag == "blockquote" else 1)
            else:
                flow.add(_lines(child, pre or tag in ("pre", "textarea", "xmp")), 2 if tag in _SPACED and not (tag in ("ul", "ol") and node.tag == "li") else 1)
        else:
            stack.append(iter(child.inner))
    flow.flush()
    return flow.lines


def _depth(root: Node) -> int:
    level, depth = [root], 0
    while level:
        level, depth = [c for x in level for c in x.inner if not isinstance(c, str)], depth + 1
    return depth


def render(page: str | None) -> str | None:
    """All visible text of a page as laid out lines."""
    if page is None:
        return None
    root = tree(page)
    if "visibility" in page.lower():
        settle_visibility(root)
    # A block is laid out inside its parent's call; these calls take no room on the machine's own stack.
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 3 * _depth(root) + 1000))
    return "\n".join(_lines(root))


def extracted(pages: DataFrame, source: str = "html", out: str = "text") -> DataFrame:
    """Adds ``out``: the rendered text of each whole page."""

    @F.pandas_udf("string")
    def rendered(values: pd.Series) -> pd.Series:
        return pd.Series([render(v) for v in values], dtype=object)

    return pages.withColumn(out, rendered(F.col(source)))
