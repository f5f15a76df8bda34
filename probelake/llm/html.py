"""Layout-aware text of HTML pages.

A page is read into a tree, with the elements that HTML implies (paragraphs, list items, rows and cells that end
where another begins; void elements; raw text), and the tree is laid out as text: what style or element type
hides is left out, blocks stand on lines of their own with the blank lines of their margins, list items get
their marks and indents, and the cells of a table stand in aligned columns, in tables within tables too.

Style sheets of the page hide elements by rules on a tag, classes and an id together (``p.note``, ``#menu``), in the order
of specificity and place, with style attributes behind them and what is important last. Rules on the place of an element
in others, and those for some media only, are not read.
"""

from __future__ import annotations

import re
import sys
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probelake.llm.common import map_texts, record, texts

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style title template iframe noembed noframes object audio video canvas svg math datalist map".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p plaintext pre"
    " search section summary table tbody tfoot thead tr td th caption ul xmp".split()
)
MARGINS = frozenset("blockquote dl dir figure h1 h2 h3 h4 h5 h6 hr listing menu ol p pre table ul xmp fieldset".split())
LISTS = frozenset("ul ol menu dir".split())
PREFORMATTED = frozenset("pre listing xmp textarea plaintext".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr listing main menu nav ol p plaintext pre search section summary table ul xmp li dd dt".split()
)
#: What a start tag ends, and the elements beyond which it ends nothing.
ENDS = {
    "li": (frozenset(["li"]), LISTS | {"table"}),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl", "table"])),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup", "datalist", "table"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select", "table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
}
PARTS = frozenset("tr td th tbody thead tfoot caption colgroup col".split())

#: Cells are padded to the widest of their column, but for those wider than this.
ALIGNED = 40
#: The most columns that a cell spans, as in HTML.
MOST_COLUMNS = 1000

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"?|'[^']*'?|[^\s>]+))?""")
SPACES = re.compile(r"[ \t\n\r\f]+")
DISPLAY = re.compile(r"(?<![-\w])display\s*:\s*([a-z-]+)", re.I)
VISIBILITY = re.compile(r"(?<![-\w])visibility\s*:\s*(hidden|collapse|visible)", re.I)
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
#: A rule, or a block that holds rules.
RULE = re.compile(r"([^{}]*)\{([^{}]*)\}|[^{}]*\{|\}")
SELECTOR = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+)*)")
IMPORTANT = re.compile(r"!\s*important", re.I)


class Node:
    """An element; ``children`` are nodes and texts."""

    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def attributes_of(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        value = m[2] or ""
        if value[:1] in "\"'" and value:
            value = value[1:-1] if len(value) > 1 and value[-1] == value[0] else value[1:]
        found.setdefault(m[1].lower(), unescape(value) if "&" in value else value)
    return found


class Builder:
    """Builds the tree; ``open`` counts the open elements by tag."""

    def __init__(self):
        self.root = Node("html", {})
        self.stack = [self.root]
        self.open: dict[str, int] = {}
        self.sheets: list[str] = []
        self.deepest = 0  # tables within tables

    def pop(self) -> None:
        self.open[self.stack.pop().tag] -= 1

    def close(self, tags: frozenset[str] | set[str], barriers: frozenset[str]) -> bool:
        """End the innermost open element of ``tags`` and what is in it, unless a barrier lies between."""
        if not any(self.open.get(t) for t in tags):
            return False
        for depth in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[depth].tag
            if tag in tags:
                while len(self.stack) > depth:
                    self.pop()
                return True
            if tag in barriers:
                return False
        return False

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body") and not self.open.get("head"):
            return
        if self.open.get("head") and tag not in ("base", "link", "meta", "title", "style", "script", "noscript", "template"):
            self.close({"head"}, frozenset())
            if tag in ("html", "body"):
                return
        if self.open.get("p") and tag in ENDS_PARAGRAPH:
            self.close({"p"}, frozenset(["td", "th", "caption", "button", "object", "table"]))
        if tag in PARTS and not self.open.get("table"):
            return  # parts of a table outside of one are ignored
        if tag in ENDS:
            self.close(*ENDS[tag])
        if tag in ("td", "th") and self.stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self.push("tr", {})
        self.push(tag, attributes)
        if tag in VOID:
            self.pop()

    def push(self, tag: str, attributes: dict[str, str]) -> None:
        node = Node(tag, attributes)
        self.stack[-1].children.append(node)
        self.stack.append(node)
        self.open[tag] = self.open.get(tag, 0) + 1
        if tag == "table":
            self.deepest = max(self.deepest, self.open[tag])

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag == "p" and not self.open.get("p"):
            self.start("p", {})
            self.end("p")
        elif tag in PARTS or tag == "table":
            self.close({tag}, frozenset() if tag == "table" else frozenset(["table"]))
        else:
            self.close({tag}, frozenset(["td", "th", "caption", "table"]))

    def text(self, text: str) -> None:
        if text:
            self.stack[-1].children.append(text)


class Rules:
    """What style sheets say of display and visibility, by what a selector names first: an id, a class or a tag."""

    def __init__(self, sheets: list[str]):
        self.of: dict[str, list[tuple]] = {}
        for sheet in sheets:
            depth = 0
            for m in RULE.finditer(COMMENT.sub(" ", sheet) + "}"):  # the end of a sheet ends a rule
                if m[1] is None:
                    depth = max(0, depth + (1 if m[0].endswith("{") else -1))
                elif depth == 0:
                    self._add(m[1].rpartition(";")[2], m[2])

    def _add(self, selectors: str, declarations: str) -> None:
        said = [d for d in declarations.split(";") if DISPLAY.search(d) or VISIBILITY.search(d)]
        for selector in selectors.split(",") if said else ():
            if not selector.strip() or not (m := SELECTOR.fullmatch(selector.strip())):
                continue
            tag = "" if m[1] in (None, "*") else m[1].lower()
            names = re.findall(r"[.#][\w-]+", m[2])
            ids, classes = [n[1:] for n in names if n[0] == "#"], [n[1:] for n in names if n[0] == "."]
            key = f"#{ids[0]}" if ids else f".{classes[0]}" if classes else tag
            rank = (len(ids), len(classes), bool(tag), sum(map(len, self.of.values())))
            self.of.setdefault(key, []).append((rank, tag, set(ids), set(classes), said))

    def apply(self, node: Node) -> None:
        """Put what the rules say of a node into its style attribute."""
        a = node.attributes
        classes, id_ = a.get("class", "").split(), a.get("id", "")
        found = [r for key in {"", node.tag, f"#{id_}", *(f".{c}" for c in classes)} for r in self.of.get(key, ())]
        found = [r for r in found if r[1] in ("", node.tag) and r[2] <= {id_} and r[3] <= set(classes)]
        if not found:
            return
        said = [d for r in sorted(found, key=lambda r: r[0]) for d in r[4]] + a.get("style", "").split(";")
        a["style"] = ";".join(sorted(said, key=lambda d: IMPORTANT.search(d) is not None))


def last(pattern: re.Pattern, style: str) -> str | None:
    """The value of a property, of several the last."""
    found = pattern.findall(style)
    return found[-1].lower() if found else None


def parse(page: str) -> Node:
    """The tree of a page; what has no end tag ends where HTML lets it end, at the end of the page at last."""
    builder = build(page)
    rules = Rules(builder.sheets)
    work = [builder.root] if rules.of else []
    while work:
        node = work.pop()
        rules.apply(node)
        work += [c for c in node.children if isinstance(c, Node)]
    return builder.root


def build(page: str) -> Builder:
    builder, at, ends = Builder(), 0, {}
    while (m := TAG.search(page, at)) is not None:
        builder.text(unescape(page[at : m.start()]))
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            builder.end(tag)
            continue
        builder.start(tag, attributes_of(m[3]) if m[3] and not m[3].isspace() else {})
        if tag in RAW and builder.stack[-1].tag == tag:
            if tag not in ends:
                ends[tag] = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I)
            close = ends[tag].search(page, at)
            raw = page[at : close.start() if close else len(page)]
            builder.text(unescape(raw) if tag in ("textarea", "title") else raw)
            if tag == "style":
                builder.sheets.append(raw)
            builder.end(tag)
            at = close.end() if close else len(page)
    builder.text(unescape(page[at:]))
    # A table within a table is laid out by a call within a call.
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 10 * builder.deepest))
    return builder


class Lines:
    """Lines under construction: collapsed spaces, pending margins, indents."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.blank = 0
        self.indents: list[str] = []
        self.mark = ""

    def flush(self) -> None:
        text = "".join(self.line).rstrip(" ")
        self.line, self.space = [], False
        if text or self.mark:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = 0
            indent = "".join(self.indents)
            if self.mark:
                indent = indent[: len(indent) - len(self.mark)] + self.mark
                self.mark = ""
            self.lines.append((indent + text).rstrip(" "))

    def margin(self) -> None:
        self.flush()
        self.blank = 1

    def add(self, text: str) -> None:
        collapsed = SPACES.sub(" ", text)
        if collapsed[:1] == " ":
            self.space = True
            collapsed = collapsed[1:]
        if not collapsed:
            return
        if self.space and self.line:
            self.line.append(" ")
        self.space = collapsed[-1] == " "
        self.line.append(collapsed.rstrip(" ").replace("\xa0", " "))

    def verbatim(self, text: str) -> None:
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self.line.append(first)
        for line in rest:
            self.newline()
            self.line.append(line)

    def newline(self) -> None:
        if "".join(self.line).strip() or self.mark:
            self.flush()
        elif self.lines and not self.blank:
            self.line, self.space = [], False
            self.lines.append("")

    def whole(self, lines: list[str]) -> None:
        """Lines that are laid out already."""
        for line in lines:
            self.flush()
            self.line = [line]
        self.flush()


def hidden(node: Node) -> bool:
    a = node.attributes
    if node.tag in HIDDEN or "hidden" in a:
        return True
    if node.tag == "input":
        return a.get("type", "").lower() not in ("submit", "button", "reset")
    if node.tag == "dialog" and "open" not in a:
        return True
    return "style" in a and last(DISPLAY, a["style"]) == "none"


def lay_out(root: Node) -> list[str]:
    """The lines of a node. Elements are walked with a stack, so depth costs no recursion but for tables."""
    out = Lines()
    # (node, visible, preformatted, list: [kind, next number] or what to undo, leaving)
    work: list[tuple] = [(root, True, False, None, False)]
    while work:
        node, visible, pre, of, leaving = work.pop()
        if isinstance(node, str):
            if visible:
                out.verbatim(node) if pre else out.add(node)
            continue
        tag, a = node.tag, node.attributes
        if leaving:
            if tag in MARGINS and of != "nested":
                out.margin()
            elif tag in BLOCKS:
                out.flush()
            if of == "indent":
                if out.mark and tag == "li":
                    out.flush()
                out.indents.pop()
            continue
        if hidden(node):
            continue
        if "style" in a and (said := last(VISIBILITY, a["style"])):
            visible = said == "visible"
        if tag == "br":
            out.newline()
            continue
        if tag == "input":
            if visible:
                out.add(a.get("value", ""))
            continue
        if tag == "hr":
            out.margin()
            if visible:
                out.whole(["-" * 20])
            out.margin()
            continue
        if tag in MARGINS and not (tag in LISTS and of is not None):
            out.margin()
        elif tag in BLOCKS:
            out.flush()
        if tag == "table":
            out.whole(table_lines(node, visible))
            out.margin()
            continue
        pre = pre or tag in PREFORMATTED
        left, inner = None, of
        if tag in LISTS:
            left, start = "nested" if of is not None else None, a.get("start", "1")
            inner = ["ol" if tag == "ol" else "ul", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1]
        elif tag == "li":
            mark = "- "
            if of and of[0] == "ol":
                if re.fullmatch(r"-?\d{1,9}", a.get("value", "")):
                    of[1] = int(a["value"])
                mark = f"{of[1]}. "
                of[1] += 1
            if visible:
                out.mark = mark
            out.indents.append(" " * len(mark))
            left = "indent"
        elif tag in ("blockquote", "dd"):
            out.indents.append("  ")
            left = "indent"
        elif tag in ("td", "th"):
            out.add(" ")
        children = node.children
        if tag == "details" and "open" not in a:
            summaries = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
            children = summaries[:1]
        work.append((node, visible, pre, left, True))
        work.extend((c, visible, pre, inner, False) for c in reversed(children))
    out.flush()
    return out.lines


def number_of(text: str, least: int, most: int) -> int:
    return min(max(int(text), least), most) if re.fullmatch(r"\d{1,6}", text) else 1


def table_lines(table: Node, visible: bool) -> list[str]:
    """Rows with their cells in columns; a cell takes the columns and rows that it spans."""
    captions: list[str] = []
    rows: list[list[Node]] = []
    work = list(reversed([c for c in table.children if isinstance(c, Node)]))
    loose = Node("div", {})
    loose.children = [c for c in table.children if isinstance(c, str) and not c.isspace()]
    while work:
        node = work.pop()
        if hidden(node):
            continue
        if node.tag == "caption":
            captions += lay_out(_as_block(node, visible))
        elif node.tag == "tr":
            rows.append([c for c in node.children if isinstance(c, Node) and c.tag in ("td", "th") and not hidden(c)])
            loose.children += [c for c in node.children if not (isinstance(c, Node) and c.tag in ("td", "th"))]
        elif node.tag in ("tbody", "thead", "tfoot"):
            work.extend(reversed([c for c in node.children if isinstance(c, Node)]))
            loose.children += [c for c in node.children if isinstance(c, str)]
        elif node.tag not in ("col", "colgroup"):
            loose.children.append(node)
    # What stands between the cells is shown before the table.
    before = lay_out(_as_block(loose, visible)) if any(not isinstance(c, str) or c.strip() for c in loose.children) else []
    grid: list[list[tuple[int, int, list[str]]]] = []
    taken: dict[int, int] = {}
    for row in rows:
        cells, column = [], 0
        for cell in row:
            while taken.get(column, 0) > 0:
                column += 1
            wide = number_of(cell.attributes.get("colspan", ""), 1, MOST_COLUMNS)
            high = number_of(cell.attributes.get("rowspan", ""), 1, len(rows))
            cells.append((column, wide, lay_out(_as_block(cell, visible))))
            if high > 1:
                for c in range(column, column + wide):
                    taken[c] = max(taken.get(c, 0), high)
            column += wide
        grid.append(cells)
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
    widths: dict[int, int] = {}
    for cells in grid:
        for column, wide, lines in cells:
            width = max(map(len, lines), default=0)
            widths[column] = max(widths.get(column, 0), 0 if wide > 1 or width > ALIGNED else width)
    starts, used = {}, 0
    for column in sorted(widths):
        starts[column] = used
        used += widths[column] + 2 if widths[column] else 0
    out = before + captions
    for cells in grid:
        for i in range(max((len(lines) for _, _, lines in cells), default=0)):
            line = ""
            for column, _, lines in cells:
                if i < len(lines) and lines[i]:
                    line = line.ljust(starts[column])
                    line += ("  " if line and not line.endswith("  ") else "") + lines[i]
            if line.strip() or i:
                out.append(line.rstrip())
    return out


def _as_block(node: Node, visible: bool) -> Node:
    block = Node("div", {k: v for k, v in node.attributes.items() if k == "style"})
    if not visible and not VISIBILITY.search(block.attributes.get("style", "")):
        block.attributes["style"] = "visibility:hidden"
    block.children = node.children
    return block


def rendered(page: str) -> str:
    """The visible text of a page."""
    return "\n".join(lay_out(parse(page))).strip("\n")


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, text, n_chars, n_lines.

    A null or empty page gives an empty text with 0 lines; text without any tag is laid out as it is; rows with null
    or equal ids are laid out each; an empty table gives an empty result; other columns are not read.
    """

    def work(piece: pa.RecordBatch):
        found = [rendered(t) for t in texts(piece, "text")]
        kinds = [("page_id", pa.int64()), ("text", pa.string()), ("n_chars", pa.int64()), ("n_lines", pa.int64())]
        lines = [t.count("\n") + 1 if t else 0 for t in found]
        yield record(kinds, [piece.column("page_id"), found, list(map(len, found)), lines])

    rows = pages.select(F.col("page_id").cast("long"), F.col("html").alias("text"))
    return map_texts(rows, work, "page_id long, text string, n_chars long, n_lines long")
