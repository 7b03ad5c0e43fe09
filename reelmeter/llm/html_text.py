"""Layout-aware text of web pages.

A small tree builder supplies the tags that HTML lets authors leave out; a
renderer walks the tree and emits all visible text: blocks on lines of their own,
paragraphs and headings with a blank line around them, list items with
marks and indents, table cells in aligned columns, preformatted text as it is.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template noscript iframe noembed noframes object audio video canvas datalist "
    "textarea select title meta link".split()
)
#: Unseen in svg and math.
FOREIGN_UNSEEN = frozenset("desc metadata defs symbol annotation annotation-xml".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr".split())
BLOCK = SPACED | frozenset(
    "html body address article aside details dialog dd div dt fieldset figcaption footer form header hgroup li "
    "main menu nav section summary tr caption thead tbody tfoot legend center".split()
)
#: A start tag ends the open elements named here, up to the border that scopes them.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr"}, {"table"}),
}
#: An end tag does not reach beyond these.
SCOPES = frozenset("table td th caption body html template".split())
#: End tags of a table and its parts reach out of cells, but not out of the table.
TABLE_PARTS = frozenset("table caption thead tbody tfoot tr td th".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.IGNORECASE)
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def attribute(self, name: str) -> str | None:
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return html.unescape((m[2] or "").strip("\"'"))
        return None

    @property
    def visible(self) -> bool:
        if self.tag in UNSEEN:
            return False
        if not self.attributes:
            return True
        if self.attribute("hidden") is not None or (self.tag == "dialog" and self.attribute("open") is None):
            return False
        return not _HIDDEN.search(self.attribute("style") or "")


def tree(page: str) -> Node:
    """The document as nodes and strings; ends that are missing are supplied, stray ones ignored."""
    root = Node("html")
    stack = [root]
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            if page[m.start()] != "<" or m[0] == "<":
                stack[-1].children.append(html.unescape(m[0]) if "&" in m[0] else m[0])
            continue
        name = name.lower()
        if m[1]:
            _close(stack, name)
            continue
        if name in ("html", "body"):  # the root is there, and attributes of its parts do not matter but to hide
            if name == "body" and m[3]:
                root.attributes = m[3]
            _close(stack, "head")
            continue
        if name in BLOCK and name != "head":
            _close(stack, "p")
            if stack[-1].tag == "head":
                stack.pop()
        if name in ENDS:
            _end(stack, *ENDS[name])
        if name in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            _open(stack, Node("tr"))
        node = Node(name, m[3])
        stack[-1].children.append(node)
        if name in FOREIGN_UNSEEN and _foreign(stack):
            node.attributes += " hidden"
        if name in VOID or m[3].endswith("/") and (name in ("svg", "math", "path") or _foreign(stack)):
            continue
        if name in RAW:  # text up to the end tag, whatever it looks like
            stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            text, at = (page[at : stop.start()], stop.end()) if stop else (page[at:], n)
            node.children.append(html.unescape(text))
            continue
        stack.append(node)
    return root


def _foreign(stack: list[Node]) -> bool:
    return any(n.tag in ("svg", "math") for n in stack)


def _open(stack: list[Node], node: Node) -> None:
    stack[-1].children.append(node)
    stack.append(node)


def _close(stack: list[Node], name: str) -> None:
    borders = {"table"} if name in TABLE_PARTS else SCOPES
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == name:
            del stack[k:]
            return
        if stack[k].tag in borders:
            return


def _end(stack: list[Node], tags: set[str], border: set[str]) -> None:
    """Ends the outermost open element of ``tags`` that no border stands before."""
    found = None
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in border:
            break
        if stack[k].tag in tags:
            found = k
    if found:
        del stack[found:]


def width(text: str) -> int:
    """Columns that a text takes on a terminal: wide characters take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 1 + (unicodedata.east_asian_width(c) in "WF") for c in text)


class _Lines:
    """Lines under way: white space is folded, blank lines between blocks are not repeated."""

    def __init__(self, in_item: bool = False):
        self.in_item = in_item
        self.lines: list[str] = []
        self.now = ""
        self.gap = 0
        self.blank = False
        self.mark = ""

    def text(self, value: str) -> None:
        value = _BLANK.sub(" ", value)
        if self.now == "" or self.now.endswith(" "):
            value = value.lstrip(" ")
        self.now += value

    def line(self, gap: int = 0) -> None:
        """End the line; ``gap`` blank lines stand before the next at least."""
        if self.now.strip(" "):
            self.put(self.now.rstrip(" "))
        self.now = ""
        self.gap = max(self.gap, gap)

    def put(self, value: str) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.lines.append(self.mark + value)
        self.gap, self.mark = 0, ""


def _finished(step: Generator):
    """What a renderer returns. Renderers yield the renderers they need, so pages of any depth fit Python's stack."""
    steps, value = [step], None
    while steps:
        try:
            step = steps[-1].send(value)
        except StopIteration as end:
            steps.pop()
            value = end.value
        else:
            steps.append(step)
            value = None
    return value


def _render(node: Node, out: _Lines) -> Generator:
    for child in node.children:
        if isinstance(child, str):
            out.text(child)
            continue
        tag = child.tag
        if tag == "br":
            if out.now.strip(" "):
                out.line()
            elif out.lines:
                out.gap = max(out.gap, 1)
        elif tag == "hr":
            out.line(1)
            out.put("---")
            out.line(1)
        elif tag in VOID or not child.visible:
            continue
        elif tag == "pre":
            out.line(1)
            for x in (yield _raw(child)).strip("\n").split("\n"):
                out.put(x.rstrip())
            out.line(1)
        elif tag in ("ul", "ol", "menu"):
            yield _list(child, out)
        elif tag == "table":
            out.line(1)
            for x in (yield _table(child)):
                out.put(x)
            out.line(1)
        elif tag in BLOCK:
            gap = 1 if tag in SPACED else 0
            out.line(gap)
            yield _render(child, out)
            out.line(gap)
        else:
            yield _render(child, out)
            if tag in ("td", "th"):  # cells outside a table
                out.text(" ")


def _raw(node: Node) -> Generator:
    parts = []
    for c in node.children:
        if isinstance(c, str):
            parts.append(c)
        elif c.tag == "br":
            parts.append("\n")
        elif c.visible:
            parts.append((yield _raw(c)))
    return "".join(parts)


def _inner(node: Node) -> Generator:
    lines = _Lines(in_item=node.tag == "li")
    yield _render(node, lines)
    lines.line()
    return lines.lines


def _list(node: Node, out: _Lines) -> Generator:
    gap = 0 if out.in_item else 1  # lists in items stand close
    out.line(gap)
    start = node.attribute("start") if node.tag == "ol" and node.attributes else None
    number = int(start) if start and re.fullmatch(r"-?\d{1,9}", start) else 1
    loose = Node("li")

    def item(li: Node, mark: str) -> Generator:
        lines = yield _inner(li)
        for k, x in enumerate(lines):
            out.put((mark if k == 0 else " " * len(mark)) + x if x else "")

    for child in [*node.children, None]:
        if isinstance(child, Node) and child.tag == "li":
            if child.visible:
                yield item(child, f"{number}. " if node.tag == "ol" else "- ")
                number += 1
        elif child is not None and (not isinstance(child, str) or child.strip()):
            loose.children = [child]  # text or elements outside of items
            yield item(loose, "  ")
    out.line(gap)


def _table(node: Node) -> Generator:
    rows: list[list[list[str]]] = []
    before: list[str] = []

    def walk(part: Node) -> Generator:
        held: dict[int, int] = {}  # columns that cells above take, and for how many rows
        for child in part.children:
            if isinstance(child, str):
                if child.strip():
                    before.append(_BLANK.sub(" ", child).strip(" "))
            elif not child.visible:
                continue
            elif child.tag == "tr":
                cells = []
                below = {k: n - 1 for k, n in held.items() if n > 1}
                for cell in child.children:
                    if not isinstance(cell, str) and cell.visible or isinstance(cell, str) and cell.strip():
                        while len(cells) in held:
                            cells.append([])
                    if isinstance(cell, str):
                        if cell.strip():
                            cells.append([_BLANK.sub(" ", cell).strip(" ")])
                    elif cell.visible:
                        wrapped = cell if cell.tag in ("td", "th") else Node("td")
                        if wrapped is not cell:
                            wrapped.children = [cell]
                        first = len(cells)
                        cells.append((yield _inner(wrapped)))
                        span = cell.attribute("colspan") if cell.attributes else None
                        cells += [[]] * (min(int(span), 100) - 1 if span and re.fullmatch(r"[1-9]\d{0,3}", span) else 0)
                        down = cell.attribute("rowspan") if cell.attributes else None
                        if down and re.fullmatch(r"\d{1,5}", down) and int(down) != 1:  # 0: to the end of the part
                            below |= dict.fromkeys(range(first, len(cells)), int(down) - 1 if int(down) else 1 << 30)
                while len(cells) in held:
                    cells.append([])
                held = below
                if any(cells):
                    rows.append(cells)
            elif child.tag in ("thead", "tbody", "tfoot"):
                yield walk(child)
            else:  # captions, and what does not belong in a table
                before.extend((yield _inner(child)))

    yield walk(node)
    widths = [0] * max(map(len, rows), default=0)
    for cells in rows:
        for k, cell in enumerate(cells):
            widths[k] = max([widths[k], *map(width, cell)])
    lines = before
    for cells in rows:
        for y in range(max(map(len, cells))):
            parts = [cell[y] if y < len(cell) else "" for cell in cells]
            padded = [p + " " * (w - width(p)) for p, w in zip(parts, widths)]
            lines.append(" | ".join(padded).rstrip(" "))
    return lines


def rendered(page: str | None) -> str:
    """The visible text of a page; empty for a null one."""
    if not page:
        return ""
    root = tree(page)
    return "\n".join(_finished(_inner(root))) if root.visible else ""


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([rendered(x.as_py()) for x in batch["__html"]], pa.string())
        yield pa.RecordBatch.from_arrays(
            [texts if name == "__html" else column for name, column in zip(batch.schema.names, batch.columns)],
            names=batch.schema.names,
        )


def extract_text(pages: DataFrame, html_column: str = "html", output: str = "text") -> DataFrame:
    """``pages`` with ``output``, the text of ``html_column``, in its place.

    Other columns stay, one named like ``output`` is replaced. Null and empty
    pages give empty texts, broken markup what a lenient reader would see; rows are
    independent of each other, so nothing is shuffled.
    """
    others = [c for c in pages.columns if c not in (html_column, output)]
    rows = pages.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{html_column}`").alias("__html"))
    return rows.mapInArrow(_texts, rows.schema).withColumnRenamed("__html", output)
