"""All visible text of a web page, laid out: a small tree builder with implied tags, then a renderer.

The scanner cuts a page into tags, comments and text; raw-text elements
(script, style, ...) run to their own end tag.  The builder closes what HTML
lets authors leave open (paragraphs, list items, table cells, options), opens
what it lets them leave out (rows of a table), and ignores end tags without a
start.  The renderer skips what is not shown (head matter, scripts, hidden
and ``display:none`` elements, closed templates), collapses white space
outside ``pre``, keeps blocks apart by line breaks or blank lines, numbers or
bullets list items by their depth, and aligns the cells of a table in
columns.
"""

from __future__ import annotations

import html
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import longs, map_batches, texts

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head script style template noscript noframes noembed iframe title datalist audio video canvas object "
                   "desc metadata defs annotation annotation-xml".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form header hgroup html legend li main menu nav ol optgroup option search section summary table tbody td tfoot "
                  "th thead tr ul caption".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 pre hr blockquote".split())
#: A start tag of the first kind closes an open element of the second, unless one of the third lies between.
CLOSES = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "tr", "td", "th", "caption"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup", "datalist"])),
}
CLOSES["thead"] = CLOSES["tfoot"] = CLOSES["tbody"]
LAID_APART = BLOCK | SPACED
ENDS_PARAGRAPH = (BLOCK | SPACED) - frozenset("body html option optgroup td th tr tbody thead tfoot caption".split())
#: An end tag never closes an element beyond one of these.
SCOPE = frozenset(["table", "td", "th", "caption", "html", "template"])

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
                   r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$))*+)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
SPACES = re.compile(r"[ \t\n\r\f]+")
RAW_END = {name: re.compile("</" + name, re.I) for name in RAW}
#: Nesting that is laid out.  What is open beyond it still pairs up with its end tags and hides what it hides; what it
#: shows is set, block by block, in the last element that is laid out.
DEPTH = 200


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str] | None = None):
        self.name, self.attributes, self.children = name, attributes or {}, []


def attributes_of(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def build(page: str) -> Node:
    """The element tree of a page; text nodes are strings."""
    root = Node("html")
    stack, inside = [root], [root]  # the open elements, and where the text of each goes
    open_: Counter[str] = Counter()

    def push(node: Node) -> None:
        deep = len(stack) >= DEPTH and (visible(node) or not visible(inside[-1]))
        stack.append(node)
        inside.append(inside[-1] if deep else node)
        open_[node.name] += 1

    def shut(i: int) -> None:
        for node, place in zip(stack[i:], inside[i:]):
            open_[node.name] -= 1
            if place is not node and node.name in LAID_APART:
                place.children.append(Node("div"))
        del stack[i:], inside[i:]

    def close_to(names: frozenset, until: frozenset) -> None:
        while any(open_[x] for x in names):
            i = len(stack) - 1
            while i and stack[i].name not in names:
                if stack[i].name in until:
                    return
                i -= 1
            if not i:
                return
            shut(i)

    def text(chunk: str) -> None:
        if chunk:
            inside[-1].children.append(html.unescape(chunk) if "&" in chunk else chunk)

    at = 0
    while True:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            return root
        text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:-3] if m[0].endswith("]]>") else m[0][9:])
            continue
        name = m[2].lower()
        if m[1]:
            i = len(stack) - 1 if open_[name] else 0
            while i and stack[i].name != name:
                if stack[i].name in SCOPE and name not in SCOPE and name not in ("tr", "tbody", "thead", "tfoot"):
                    break
                i -= 1
            if i and stack[i].name == name:
                shut(i)
            elif not i and name == "br":
                inside[-1].children.append(Node("br"))
            continue
        if name in ENDS_PARAGRAPH:
            close_to(frozenset(["p"]), SCOPE | {"button"})
        if name in CLOSES:
            close_to(*CLOSES[name])
        if name in ("td", "th") and stack[-1].name in ("table", "tbody", "thead", "tfoot"):
            row = Node("tr")
            inside[-1].children.append(row)
            push(row)
        if name in ("html", "body"):
            root.attributes.update(attributes_of(m[3]) if name == "body" else {})
            continue
        node = Node(name, attributes_of(m[3]) if m[3] else None)
        inside[-1].children.append(node)
        if name in VOID or m[3].endswith("/") and name in ("svg", "path", "g", "use"):
            continue
        if name in RAW:
            found = RAW_END[name].search(page, at)
            end = found.start() if found else -1
            body = page[at:end] if found else page[at:]
            node.children.append(html.unescape(body) if name in ("title", "textarea") else body)
            at = len(page) if end < 0 else page.find(">", end) + 1 or len(page)
            continue
        push(node)


def visible(node: Node) -> bool:
    a = node.attributes
    return not (node.name in HIDDEN or "hidden" in a or "style" in a and NOT_SHOWN.search(a["style"])
                or node.name == "input" and a.get("type", "").lower() == "hidden")


class Lines:
    """Lines of text with the blank lines and the space still owed before the next word."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False
        self.blank = False

    def word(self, text: str, space: bool) -> None:
        if self.line and (self.gap or space):
            self.line.append(" ")
        self.gap = False
        self.line.append(text)

    def flow(self, text: str) -> None:
        parts = SPACES.split(text)
        if not any(parts):
            self.gap = self.gap or bool(text)
            return
        first = True
        for part in parts:
            if part:
                self.word(part, not first)
            elif first:
                self.gap = True
            first = False
        self.gap = parts[-1] == ""

    def end(self) -> None:
        if self.line:
            if self.blank and self.lines:
                self.lines.append("")
            self.lines.append("".join(self.line))
            self.line, self.blank = [], False
        self.gap = False

    def spaced(self) -> None:
        self.end()
        self.blank = True

    def raw(self, lines: list[str]) -> None:
        self.end()
        for x in lines:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.append(x)


def render(node: Node) -> list[str]:
    out = Lines()
    for child in node.children:
        _render(child, out)
    out.end()
    return out.lines


def _nested(node: Node, first: str, rest: str) -> list[str]:
    """The lines of an element, the first behind a mark and the others below it."""
    lines = render(node)
    return [(first if i == 0 else rest if x else "") + x for i, x in enumerate(lines)] or [first.rstrip()]


def _render(node: Node | str, out: Lines) -> None:
    if isinstance(node, str):
        out.flow(node)
        return
    name = node.name
    if name == "br":
        if out.line:
            out.end()
        else:
            out.blank = True
        return
    if not visible(node):
        return
    if name == "img":
        alt = node.attributes.get("alt", "")
        if alt.strip():
            out.flow(alt)
        return
    if name == "table":
        out.spaced()
        out.raw(_table(node))
        out.spaced()
    elif name in ("ul", "ol", "menu", "dir"):
        out.end()
        out.raw(_list(node))
        out.end()
    elif name == "pre":
        out.spaced()
        out.raw([x.rstrip() for x in _plain(node).strip("\n").split("\n")])
        out.spaced()
    elif name == "blockquote":
        out.spaced()
        out.raw(["> " + x if x else ">" for x in render(node)])
        out.spaced()
    elif name == "select":
        options = [x for x in _inside(node) if x.name == "option"]
        for child in [x for x in options if "selected" in x.attributes or "multiple" in node.attributes] or options[:1]:
            _render(child, out)
    elif name == "details" and "open" not in node.attributes:
        out.end()
        for child in [x for x in node.children if isinstance(x, Node) and x.name == "summary"][:1]:
            _render(child, out)
    elif name == "dd":
        out.raw(["  " + x if x else x for x in render(node)])
    elif name in SPACED or name in BLOCK:
        (out.spaced if name in SPACED else out.end)()
        for child in node.children:
            _render(child, out)
        (out.spaced if name in SPACED else out.end)()
    else:
        for child in node.children:
            _render(child, out)


def _inside(node: Node) -> list[Node]:
    own = [x for x in node.children if isinstance(x, Node)]
    return own + [y for x in own for y in _inside(x)]


def _plain(node: Node | str) -> str:
    if isinstance(node, str):
        return node
    if node.name == "br":
        return "\n"
    return "".join(map(_plain, node.children)) if visible(node) else ""


def _list(node: Node) -> list[str]:
    lines, number = [], node.attributes.get("start", "1")
    number = int(number) if re.fullmatch(r"-?\d{1,9}", number) else 1
    for child in node.children:
        if isinstance(child, str) or not visible(child):
            if isinstance(child, str) and child.strip():
                lines.append(" ".join(SPACES.split(child.strip(" \t\n\r\f"))))
            continue
        if child.name == "li":
            mark = f"{number}. " if node.name == "ol" else "- "
            number += 1
            lines += _nested(child, mark, " " * len(mark))
        else:
            lines += ["  " + x for x in render_one(child)]
    return lines


def render_one(node: Node) -> list[str]:
    out = Lines()
    _render(node, out)
    out.end()
    return out.lines


def _span(cell: Node) -> int:
    text = cell.attributes.get("colspan", "1").strip()
    return max(1, min(int(text), 1000)) if re.fullmatch(r"\d{1,4}", text) else 1


def _table(table: Node) -> list[str]:
    """Caption, then the rows with cells padded to their column's width; anything else inside comes before."""
    before, rows, after = [], [], []

    def gather(node: Node, into: list[list[tuple[int, list[str]]]]) -> None:
        for child in node.children:
            if isinstance(child, str):
                if child.strip():
                    before.append(" ".join(SPACES.split(child.strip(" \t\n\r\f"))))
            elif not visible(child):
                continue
            elif child.name in ("tbody", "thead", "tfoot"):
                gather(child, after if child.name == "tfoot" else into)
            elif child.name == "tr":
                cells = [(_span(c), [x for x in render(c) if x]) for c in child.children
                         if isinstance(c, Node) and c.name in ("td", "th") and visible(c)]
                other = [c for c in child.children if isinstance(c, str) and c.strip()
                         or isinstance(c, Node) and c.name not in ("td", "th")]
                for c in other:
                    before.extend(render_one(c) if isinstance(c, Node) else [" ".join(c.split())])
                if cells:
                    into.append(cells)
            else:
                before.extend(render_one(child))

    gather(table, rows)
    rows += after
    widths: dict[int, int] = {}
    for cells in rows:
        column = 0
        for span, lines in cells:
            if span == 1:
                widths[column] = max(widths.get(column, 0), max(map(len, lines), default=0))
            column += span
    out = list(before)
    for cells in rows:
        for k in range(max(1, max(len(lines) for _, lines in cells))):
            line, column = [], 0
            for span, lines in cells:
                width = sum(widths.get(c, 0) + 3 for c in range(column, column + span)) - 3
                line.append((lines[k] if k < len(lines) else "").ljust(width))
                column += span
            out.append(" | ".join(line).rstrip())
    return [x for x in out if x]


def page_title(root: Node) -> str:
    todo = [root]
    while todo:
        node = todo.pop()
        if node.name == "title":
            return " ".join("".join(x for x in node.children if isinstance(x, str)).split())
        if node.name not in ("svg", "math"):
            todo += [x for x in reversed(node.children) if isinstance(x, Node)]
    return ""


def extract(page: bytes) -> tuple[str, str]:
    """(title, visible text) of a page; bytes that are not UTF-8 become replacement characters."""
    root = build(page.decode("utf-8", "replace").replace("\x00", "�"))
    return page_title(root), "\n".join(render(root)) if visible(root) else ""


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: (id, title, text).

    Null and empty pages give an empty title and text, a page without markup
    gives its text with white space collapsed.  Ids are passed through, null
    or repeated.  Only the two named columns are read.
    """
    source = pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))

    def run(batch):
        found = [extract(t) for t in texts(batch, "html")]
        return {"id": longs(batch, "id"), "title": [a for a, _ in found], "text": [b for _, b in found]}

    kind = source.schema["id"].dataType.simpleString()
    out = map_batches(source, run, f"id {kind}, title string, text string")
    return out.select(F.col("id").alias(id_col), "title", "text")
