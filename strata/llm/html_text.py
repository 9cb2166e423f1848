"""Visible text of HTML pages, laid out as a reader sees it.

A tokenizer feeds a tree builder that supplies the tags authors may leave out
(paragraphs, list items, table parts, definitions, options) and drops stray end
tags.  A walk over the tree leaves out what is not shown (scripts, styles,
templates, the head, ``hidden``, inline or simple style-sheet ``display: none``
and ``visibility: hidden``, closed details) and emits all other text.  Style
rules inside conditions (print, narrow screens, ``@supports``) do not count; of
the others that match, importance, the kind of selector and order decide.
Formulas are text within the line, with a stroke in fractions; of drawings the
text elements are shown.  Blocks are on their own lines, a blank line around paragraphs, headings, lists and tables,
list items with their marks and indents, table cells padded to the width of
their column, white space kept in ``pre``.

Null pages give null, empty pages the empty text; long pages are rendered
whole and nesting may be of any depth; repeated rows render alike; an empty
table gives an empty table.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.words import bounded_batches, release

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes noembed iframe".split())
#: Elements whose content is never shown as text.
HIDDEN = frozenset(
    "head script style template noscript iframe object canvas audio video datalist noframes noembed title".split()
)
#: Elements of drawings and formulas that are not shown where they stand.
_SVG_HIDDEN = frozenset("defs symbol desc metadata clippath mask pattern marker".split())
_MATH_HIDDEN = frozenset(("annotation", "annotation-xml"))
_SVG_TEXT = frozenset(("text", "foreignobject"))
_MATH_LEAF = frozenset("mi mn mo mtext ms".split())
#: Elements with a blank line around them, and those on lines of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside header footer nav main address form li dt dd figcaption details summary "
    "dialog legend center caption menu dir option optgroup".split()
)
_SECTION = frozenset("thead tbody tfoot".split())
#: A start tag on the left closes the open elements on the right, up to a scope limit.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
    "tr": ("tr", "td", "th", "caption", "colgroup"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"),
    "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"),
    "tfoot": ("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"),
}
_LIMIT = {
    "li": frozenset(("ul", "ol", "menu", "dir")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)),
    "option": frozenset(("select", "datalist")), "optgroup": frozenset(("select", "datalist")),
}
_TABLE_LIMIT = frozenset(("table",))
_P_CLOSERS = BLOCK - frozenset("html body option optgroup legend caption".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_SHOWING = re.compile(r"(?i)(?:^|[;\s])(display|visibility)\s*:\s*([\w-]+)[^;!]*(!\s*important)?")
_BRACE = re.compile(r"[{}]")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
#: Media queries that hold for a reader at a screen.
_SCREEN = re.compile(r"(?i)(?:^|,)\s*(?:only\s+)?(?:all|screen)\s*(?:,|$)")
_SIMPLE = re.compile(r"([a-zA-Z][\w-]*)?(?:([.#])([\w-]+))?$")
_SPACE = re.compile(r"[ \t\n\f\r]+")


@dataclass(eq=False)
class Node:
    tag: str
    raw: str = ""
    children: list = field(default_factory=list)

    def attributes(self) -> dict[str, str]:
        found: dict[str, str] = {}
        for name, a, b, c in _ATTRIBUTE.findall(self.raw):
            found.setdefault(name.lower(), html.unescape(a or b or c))
        return found


#: By simple selector: property, (important, kind of selector, order), and whether it hides.
Rules = dict[tuple[str, str, str], list[tuple[str, tuple[bool, int, int], bool]]]


def parse(page: str) -> tuple[Node, Rules]:
    """The tree of a page and what its style sheets show and hide by simple selectors."""
    root = Node("html")
    open_nodes = [root]
    sheets: list[str] = []
    # where the open elements of each tag stand in the stack, so nothing is searched for
    where: dict[str, list[int]] = {}
    at, size = 0, len(page)

    def pop_to(index: int) -> None:
        while len(open_nodes) > index:
            where[open_nodes.pop().tag].pop()

    def push(tag: str, raw: str) -> Node:
        node = Node(tag, raw)
        open_nodes[-1].children.append(node)
        where.setdefault(tag, []).append(len(open_nodes))
        open_nodes.append(node)
        return node

    def innermost(tags: frozenset[str] | tuple[str, ...]) -> int:
        return max((where[t][-1] for t in tags if where.get(t)), default=0)

    def close_open(tags: tuple[str, ...], limit: frozenset[str]) -> None:
        """Close the outermost of ``tags`` that is open inside the innermost limit."""
        edge = innermost(limit)
        found = [w[k] for t in tags if (w := where.get(t)) and (k := bisect_right(w, edge)) < len(w)]
        if found:
            pop_to(min(found))

    while at < size:
        lt = page.find("<", at)
        if lt != at:
            text = page[at : lt if lt >= 0 else size]
            open_nodes[-1].children.append(html.unescape(text) if "&" in text else text)
            if lt < 0:
                break
        following = page[lt + 1 : lt + 2]
        if following in ("!", "?"):
            end = page.find("-->", lt + 4) + 3 if page.startswith("<!--", lt) else page.find(">", lt) + 1
            at = end if end > lt + 1 and end >= 3 else size
            continue
        m = _TAG.match(page, lt)
        if m is None and (following.isascii() and following.isalpha() or following == "/"):
            m = _LOOSE_TAG.match(page, lt)
            if m is None:
                end = page.find(">", lt)  # a broken tag, or one that the page's end cuts off
                at = end + 1 if end >= 0 else size
                continue
        if m is None:
            open_nodes[-1].children.append("<")
            at = lt + 1
            continue
        at = m.end()
        tag, raw = m[2].lower(), m[3]
        if m[1]:
            # table parts and inline elements close nothing outside their table
            limit = _TABLE_LIMIT if tag in ("td", "th", "tr") or tag not in BLOCK else ()
            if tag != "table" and innermost((tag,)) > innermost(limit) or tag == "table" and where.get(tag):
                pop_to(where[tag][-1])
            continue
        if tag in ("html", "body"):
            open_nodes[0].raw += raw if tag == "body" else ""
            if where.get("head"):
                close_open(("head",), frozenset())
            continue
        if where.get("head") and tag in BLOCK:
            close_open(("head",), frozenset())
        if where.get("p") and tag in _P_CLOSERS:
            close_open(("p",), frozenset(("td", "th", "table", "li", "button")) if tag != "li" else _LIMIT["li"])
        if tag in CLOSES:
            close_open(CLOSES[tag], _LIMIT.get(tag, _TABLE_LIMIT))
            inside = open_nodes[-1].tag
            if tag in ("td", "th") and inside in _SECTION | {"table"}:
                push("tr", "")
        closed = raw.endswith("/") and (tag in ("svg", "math") or where.get("svg") or where.get("math"))
        if tag in VOID or closed:
            open_nodes[-1].children.append(Node(tag, raw))
            continue
        node = push(tag, raw)
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            content = page[at : close.start() if close else size]
            if tag == "style":
                media = node.attributes().get("media", "").strip()
                sheets += [content] if not media or _SCREEN.search(media) else []
            elif tag in ("textarea", "title"):
                node.children.append(html.unescape(content))
            pop_to(len(open_nodes) - 1)
            end = page.find(">", close.end()) if close else -1
            at = end + 1 if end >= 0 else size
    return root, _rules(sheets)


def _declared(body: str) -> dict[str, tuple[bool, bool]]:
    """For display and visibility: whether it is important and whether it hides; the last one of equal weight counts."""
    found: dict[str, tuple[bool, bool]] = {}
    for name, value, important in _SHOWING.findall(body):
        name, hides = name.lower(), value.lower() in ("none", "hidden", "collapse")
        if important or not found.get(name, (False,))[0]:
            found[name] = (bool(important), hides)
    return found


def _unconditional(sheet: str) -> list[tuple[str, str]]:
    """Selectors and body of each rule that holds whatever the medium."""
    found: list[tuple[str, str]] = []
    sheet = _COMMENT.sub("", sheet)
    at, prelude = 0, ""
    inside: list[bool] = []  # for each open block: whether the rules in it hold
    for brace in _BRACE.finditer(sheet):
        text, at = sheet[at : brace.start()], brace.end()
        if brace[0] == "{":
            prelude = text.rpartition(";")[2].strip()
            name, _, condition = prelude.partition(" ")
            name, _, more = name.lower().partition("(")
            holds = name == "@layer" or name == "@media" and not more and bool(_SCREEN.search(condition.strip()))
            inside.append(holds if prelude.startswith("@") else not prelude)
            continue
        if inside:
            inside.pop()
            if prelude and not prelude.startswith("@") and all(inside):
                found.append((prelude, text))
        prelude = ""
    return found


def _rules(sheets: list[str]) -> Rules:
    rules: Rules = {}
    order, hiding = 0, False
    for selectors, body in (rule for sheet in sheets for rule in _unconditional(sheet)):
        for name, (important, hides) in _declared(body).items():
            for selector in selectors.split(","):
                m = _SIMPLE.match(selector.strip())
                if m and selector.strip():
                    key = (m[1].lower() if m[1] else "", m[2] or "", m[3] or "")
                    weight = {"#": 100, ".": 10}.get(key[1], 0) + bool(key[0])
                    rules.setdefault(key, []).append((name, (important, weight, order), hides))
                    order, hiding = order + 1, hiding or hides
    return rules if hiding else {}


def _shown(node: Node, rules: Rules, drawing: bool = False) -> bool:
    if node.tag in HIDDEN:
        return False
    if not node.raw and not rules:
        return node.tag != "dialog"
    given = node.attributes()
    if "hidden" in given:
        return False
    if node.tag == "dialog" and "open" not in given:
        return False
    decided: dict[str, tuple[tuple[bool, int, int], bool]] = {}
    if drawing:
        for name in ("display", "visibility"):
            if given.get(name, "").strip().lower() in ("none", "hidden", "collapse"):
                decided[name] = ((False, -1, -1), True)
    if rules:
        named = [(".", name) for name in given.get("class", "").split()]
        named += [("#", given["id"])] if "id" in given else []
        keys = {(tag, *kind) for tag in ("", node.tag) for kind in (("", ""), *named)}
        for key in keys:
            for name, weight, hides in rules.get(key, ()):
                if name not in decided or weight > decided[name][0]:
                    decided[name] = (weight, hides)
    for name, (important, hides) in _declared(given.get("style", "")).items():
        weight = (important, 1000, 0)
        if name not in decided or weight > decided[name][0]:
            decided[name] = (weight, hides)
    return not any(hides for _, hides in decided.values())


class Flow:
    """Lines of text that grow downwards; ``indent`` starts every line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.indent: list[str] = []
        self.mark = ""
        self.blank = False

    def text(self, value: str, keep_space: bool) -> None:
        if keep_space:
            first, *others = value.split("\n")
            self._add(first)
            for part in others:
                self.break_line(True)
                self._add(part)
            return
        value = _SPACE.sub(" ", value)
        if value.startswith(" ") and (not self.line or self.line[-1].endswith(" ")):
            value = value[1:]
        self._add(value)

    def _add(self, value: str) -> None:
        if value:
            self.line.append(value)

    def break_line(self, always: bool = False) -> None:
        value = "".join(self.line).rstrip(" ")
        if value or always:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            start = "".join(self.indent)
            if self.mark:
                start, self.mark = start[: len(start) - len(self.mark)] + self.mark, ""
            self.lines.append((start + value).rstrip(" "))
        self.line = []

    def space(self) -> None:
        self.break_line()
        self.blank = True

    def finish(self) -> list[str]:
        self.break_line()
        return self.lines


def _number(value: str | None, default: int) -> int:
    return int(value) if value and re.fullmatch(r"-?\d{1,6}", value.strip()) else default


def _table_lines(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Cells padded to the width of their columns; a spanning cell takes several."""
    widths: list[int] = []
    for row in rows:
        column = 0
        for lines, span in row:
            widths.extend([0] * (column + span - len(widths)))
            if span == 1:
                widths[column] = max([widths[column], *map(len, lines)])
            column += span
    for row in rows:
        column = 0
        for lines, span in row:
            missing = max([0, *map(len, lines)]) - sum(widths[column : column + span]) - 2 * (span - 1)
            widths[column + span - 1] += max(missing, 0)
            column += span
    out = []
    for row in rows:
        for k in range(max([0, *(len(lines) for lines, _ in row)])):
            cells, column = [], 0
            for lines, span in row:
                width = sum(widths[column : column + span]) + 2 * (span - 1)
                cells.append((lines[k] if k < len(lines) else "").ljust(width))
                column += span
            out.append("  ".join(cells).rstrip(" "))
    return out


def render(page: str) -> str:
    """The visible text of a page."""
    root, rules = parse(page)
    flow, flows = Flow(), []
    tables: list[list[list[tuple[list[str], int]]]] = []
    counters: list[int | None] = []
    kept = 0
    # open drawings and text elements in them, open formulas and their tokens
    svg = labels = math = tokens = 0
    # each entry: a node to enter or leave, or a piece of text
    todo: list[tuple[bool, Node | str]] = [(True, root)]
    while todo:
        entering, node = todo.pop()
        if isinstance(node, str):
            # white space between the tokens of a formula is none, and of drawings only text elements are shown
            if (not math or tokens or node.strip()) and (not svg or labels):
                flow.text(node, kept > 0)
            continue
        tag = node.tag
        if entering:
            if not _shown(node, rules, svg > 0):
                continue
            if svg and tag in _SVG_HIDDEN or math and tag in _MATH_HIDDEN:
                continue
            svg, math = svg + (tag == "svg"), math + (tag == "math")
            labels, tokens = labels + (svg > 0 and tag in _SVG_TEXT), tokens + (math > 0 and tag in _MATH_LEAF)
            if svg and tag in _SVG_TEXT or math and tag == "mtd":
                flow.text(" ", False)
            if tag == "br":
                flow.break_line(True)
                continue
            if tag == "hr":
                flow.space()
                flow.text("----", False)
                flow.space()
                continue
            if tag == "input" or tag in VOID:
                continue
            if tag in SPACED and not (tag in ("ul", "ol") and counters):
                flow.space()
            elif tag in BLOCK:
                flow.break_line()
            if tag in ("ul", "ol", "menu", "dir"):
                counters.append(_number(node.attributes().get("start"), 1) if tag == "ol" else None)
            elif tag == "li":
                mark = "- "
                if counters and counters[-1] is not None:
                    value = _number(node.attributes().get("value"), counters[-1])
                    counters[-1] = value + 1
                    mark = f"{value}. "
                flow.indent.append(" " * len(mark))
                flow.mark = mark
            elif tag in ("dd", "blockquote"):
                flow.indent.append("  ")
            elif tag in ("pre", "textarea"):
                kept += 1
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                flows.append(flow)
                flow = Flow()
            todo.append((False, node))
            children = node.children
            if tag == "details" and "open" not in node.attributes():
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
            if tag in ("table", "tr", *_SECTION):  # white space between the parts of a table is none
                children = [c for c in children if not isinstance(c, str) or c.strip()]
            if math and tag == "mfrac":
                parts = [c for c in children if not isinstance(c, str) or c.strip()]
                children = [x for c in parts for x in ("/", c)][1:]
            todo.extend((True, c) for c in reversed(children))
            continue
        labels, tokens = labels - (svg > 0 and tag in _SVG_TEXT), tokens - (math > 0 and tag in _MATH_LEAF)
        if svg and tag in _SVG_TEXT or math and tag == "mtd":
            flow.text(" ", False)
        svg, math = svg - (tag == "svg"), math - (tag == "math")
        if tag in ("td", "th") and tables:
            span = min(max(_number(node.attributes().get("colspan"), 1), 1), 100) if node.raw else 1
            tables[-1][-1].append((flow.finish(), span))
            flow = flows.pop()
            continue
        if tag == "table":
            for line in _table_lines(tables.pop()):
                flow.text(line, True)
                flow.break_line(True)
        elif tag in ("pre", "textarea"):
            kept -= 1
        elif tag in ("ul", "ol", "menu", "dir"):
            flow.break_line()
            counters.pop()
        if tag in SPACED and not (tag in ("ul", "ol") and counters):
            flow.space()
        elif tag in BLOCK:
            flow.break_line()
        if tag in ("li", "dd", "blockquote") and flow.indent:
            flow.break_line()
            flow.indent.pop()
            flow.mark = ""
    return "\n".join(flow.finish())


@F.arrow_udf(T.StringType())
def _render(column: pa.Array) -> pa.Array:
    out = pa.array([None if page is None else render(page) for page in column.to_pylist()], pa.string())
    release()
    return out


def visible_text(page: Column) -> Column:
    """The visible text of a column of HTML pages."""
    return _render(page)


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """All columns of ``pages`` and the text; a column named like it is replaced."""
    bounded_batches(pages.sparkSession)
    return pages.withColumn(text_col, visible_text(F.col(html_col)))
