"""Visible text of HTML pages, laid out as a reader would see it.

A tolerant tree builder closes and opens the elements that HTML implies, and a
renderer walks the tree: hidden elements give nothing, blocks stand on lines of
their own with blank lines where a page has margins, list items are marked and
indented, and the cells of a table are padded to the widths of their columns.
"""

from __future__ import annotations

import html
import re
import sys
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessile.llm.words import chunks

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/<>]*+)|[^<]+|<", re.S)
#: What moves a tag on: a quoted value, or its end.
_STEP = re.compile(r"""=\s*+(?:"[^"]*"|'[^']*')|>""")
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_BLANK = re.compile(r"[ \t\r\n\f]+")

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style template noscript head title iframe noembed noframes object audio video canvas datalist desc metadata defs annotation annotation-xml".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table text tr ul".split()
)
#: Blocks with a blank line above and below.
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul menu".split())
#: A start tag ends these open elements, up to the nearest of the scope.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
IN_HEAD = frozenset("base link meta title style script template noscript".split())
#: What a table is made of, and those of it that hold no text of their own.
TABLE_PARTS = frozenset("caption colgroup col tbody thead tfoot tr td th".split())
TABLE_FRAME = frozenset("table tbody thead tfoot tr colgroup".split())
MOST_COLUMNS, MOST_ROWS = 1000, 65534
#: Columns that lines are indented by at most; parts that lie deeper stand there, too.
MOST_INDENT = 400


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None) -> None:
        self.tag, self.attrs = tag, attrs or {}
        self.children: list[Node | str] = []


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(source)} if source.strip("/ \n\t") else {}


class _Tags:
    """Ends of the tags of a page; every stretch of it is searched a few times at most."""

    def __init__(self, source: str) -> None:
        self.source, self.last, self.dead = source, source.rfind(">"), set()

    def end(self, at: int) -> int:
        """Place after the tag whose name ends at ``at``; 0 if nothing closes it.

        Quotes of a value hide a ``>``; where they don't pair up, the first
        ``>`` counts.
        """
        if at > self.last:
            return 0
        place, seen = at, []
        while m := _STEP.search(self.source, place):
            if m[0] == ">":
                return m.end()
            place = m.end()
            if place in self.dead:
                break
            seen.append(place)
        self.dead.update(seen)
        return self.source.find(">", at) + 1


class _Tree:
    """Elements that are open, and where in the stack those of each tag are, so that nothing is looked for by walking it."""

    def __init__(self) -> None:
        self.root = Node("html")
        self.stack, self.places = [self.root], defaultdict(list, {"html": [0]})
        #: Where the blocks are, and the cells.
        self.blocks: list[int] = []
        self.cells: list[int] = []

    @property
    def top(self) -> Node:
        return self.stack[-1]

    def last(self, tag: str) -> int:
        """Place of the innermost open element of a tag; -1 without one."""
        found = self.places.get(tag)
        return found[-1] if found else -1

    def nearest(self, tags: Iterable[str]) -> int:
        return max(map(self.last, tags), default=-1)

    def cut(self, at: int) -> None:
        """Close the elements from place ``at`` on."""
        for node in reversed(self.stack[at:]):
            self.places[node.tag].pop()
        del self.stack[at:]
        for places in (self.blocks, self.cells):
            while places and places[-1] >= at:
                places.pop()

    def place(self, child: Node | str, tag: str | None) -> None:
        """Add a child; what has no place in a table's frame goes in front of the table."""
        if self.top.tag in TABLE_FRAME and (at := self.last("table")) >= 0 and tag not in TABLE_PARTS and tag not in UNSEEN and (tag or str(child).strip()):
            around = self.stack[at - 1].children
            k = len(around) - 1
            while k >= 0 and around[k] is not self.stack[at]:
                k -= 1
            around.insert(max(k, 0), child)
        else:
            self.top.children.append(child)

    def push(self, tag: str, attrs: dict[str, str]) -> None:
        if tag == "form" and self.top.tag in TABLE_FRAME:
            return
        node = Node(tag, attrs)
        self.place(node, tag)
        if tag not in VOID:
            at = len(self.stack)
            self.stack.append(node)
            self.places[tag].append(at)
            if tag in BLOCK:
                self.blocks.append(at)
            if tag in ("td", "th"):
                self.cells.append(at)

    def close(self, tags: set[str], scope: set[str]) -> None:
        """Close the elements of ``tags`` that are open within the nearest of ``scope``, and what they hold."""
        limit = max(0, self.nearest(scope))
        inner = [found[k] for t in tags if (found := self.places.get(t)) and (k := bisect_right(found, limit)) < len(found)]
        if inner:
            self.cut(min(inner))

    def within(self, tag: str, scope: str) -> bool:
        return self.last(tag) > self.last(scope)

    def to_frame(self) -> None:
        """Back to the table's frame, if nothing but stray elements lies between."""
        if self.last("table") >= 0:
            at = self.nearest(TABLE_FRAME)
            if at >= max(1, self.nearest(("td", "th", "caption"))):
                self.cut(at + 1)

    def end(self, name: str) -> None:
        """Close the innermost element of a name; a stray end tag doesn't reach out of a cell, and an inline one not out of a block."""
        at = self.last(name)
        if at > 0:
            beyond = -1
            if name not in ("table", "tr", "tbody", "thead", "tfoot") and self.cells:
                beyond = self.cells[-1]
            if name not in BLOCK and name not in ("td", "th", "tbody", "thead", "tfoot", "select") and self.blocks:
                beyond = max(beyond, self.blocks[-1])
            if at >= beyond:
                self.cut(at)


def build(source: str) -> Node:
    """Tree of a page, with the tags that its author left out."""
    tree, tags, at = _Tree(), _Tags(source), 0
    raw_closed: dict[str, re.Pattern] = {}
    while m := _TOKEN.match(source, at):
        at, name = m.end(), (m["name"] or "").lower()
        if name and not (end := tags.end(at)):
            # Never closed: its text is text.
            name = ""
        if not name:
            if not m[0].startswith(("<!", "<?")):
                if tree.top.tag == "head" and m[0].strip():
                    tree.cut(len(tree.stack) - 1)
                tree.place(html.unescape(m[0]), None)
            continue
        attrs, at = source[at : end - 1], end
        if m["end"]:
            if name == "br":
                tree.push("br", {})
            elif name == "p" and not tree.within("p", ""):
                tree.push("p", {})
                tree.cut(len(tree.stack) - 1)
            elif name not in ("html", "body"):
                tree.end(name)
            continue
        if name == "html" or (name == "body" and tree.within("body", "")):
            tree.root.attrs.update(_attributes(attrs))
            continue
        if tree.top.tag == "head" and name not in IN_HEAD:
            tree.cut(len(tree.stack) - 1)
        if name in IMPLIED_END:
            tree.close(*IMPLIED_END[name])
        if name in TABLE_PARTS:
            tree.to_frame()
        if name in BLOCK and name not in ("option", "li", "dd", "dt") and tree.within("p", "table"):
            tree.close({"p"}, {"table", "td", "th"})
        if name in ("td", "th") and not tree.within("tr", "table"):
            tree.push("tr", {})
        tree.push(name, _attributes(attrs))
        if name in RAW and tree.top.tag == name:
            if name not in raw_closed:
                raw_closed[name] = re.compile(rf"</{name}[\s/>]", re.I)
            found = raw_closed[name].search(source, at)
            stop = found.start() if found else len(source)
            text = source[at:stop]
            tree.top.children.append(html.unescape(text) if name in ("textarea", "title") else text)
            at = stop
    return tree.root


def _shown(node: Node) -> bool:
    """Whether an element takes part in the layout at all."""
    a = node.attrs
    return not (node.tag in UNSEEN or "hidden" in a or (node.tag == "dialog" and "open" not in a) or (node.tag == "input") or ("style" in a and _NOT_SHOWN.search(a["style"])))


def _seen(node: Node, seen: bool) -> bool:
    """Whether its own text is visible, by its own style or its parent's."""
    own = _VISIBILITY.findall(node.attrs.get("style", ""))
    return own[-1].lower() == "visible" if own else seen


class _Lines:
    """Text laid out so far: finished lines, the line being written, and the margin due before more.

    An indented part (a list item, a quotation) writes to the same finished
    lines as what is around it; its ``mark`` stands before its first line, and
    as many blanks before the others.
    """

    def __init__(self, outer: _Lines | None = None, mark: str = "", always: bool = False) -> None:
        self.outer, self.mark, self.always = outer, mark, always
        self.done: list[str] = [] if outer is None else outer.done
        #: Parts, from the outermost on, whose mark is due, and those with a margin due.
        self.due: list[_Lines] = [] if outer is None else outer.due
        self.margins: list[_Lines] = [] if outer is None else outer.margins
        self.base, self.start = len(self.done), 0 if outer is None else outer.indent
        self.indent = min(MOST_INDENT, self.start + len(mark))
        self.line, self.blank = "", False
        if always:
            self.due.append(self)

    def text(self, value: str, keep: bool) -> None:
        if keep:
            first, *more = value.split("\n")
            self._add(first)
            for x in more:
                self.end(keep=True)
                self._add(x)
        else:
            value = _BLANK.sub(" ", value)
            if not self.line or self.line.endswith((" ", "\n")):
                value = value.lstrip(" ")
            if value:
                self._add(value)

    def _add(self, value: str) -> None:
        if value:
            if self.blank:
                self._settle(self)
            self.line += value

    def _settle(self, part: _Lines) -> None:
        """The margin due in a part: a blank line, if it has a line already."""
        part.blank = False
        self.margins.remove(part)
        if len(self.done) > part.base:
            self.done.append("")

    def _write(self, line: str) -> None:
        # A line that is not blank, or has a mark, ends the margins of what is around.
        within = self.due[-1].outer if self.due and not line else self if line else None
        if within is not None:
            for part in [m for m in self.margins if m is not self and m.indent <= within.indent and m.base <= within.base]:
                self._settle(part)
        before = ""
        for part in self.due:
            before = before.ljust(part.start) + part.mark
        self.due.clear()
        self.done.append((before.ljust(self.indent) + line).rstrip())

    def end(self, keep: bool = False) -> None:
        if self.line.strip() or keep:
            self._write(self.line.rstrip())
        self.line = ""

    def margin(self) -> None:
        self.end()
        if not self.blank:
            self.blank = True
            self.margins.append(self)

    def close(self, shown: bool) -> None:
        """The end of an indented part; its mark stands alone where it has no line, if it is ``shown``."""
        self.end()
        if self.blank:
            self.blank = False
            self.margins.remove(self)
        if self.due and self.due[-1] is self:
            if shown:
                self._write("")
            else:
                self.due.pop()

    def lines(self) -> list[str]:
        self.end()
        return self.done


def _span(cell: Node, name: str, most: int) -> int:
    """A span as HTML reads it: digits, at most ``most``; 1 for anything else. A rowspan of 0 reaches down to the end."""
    m = re.match(r"\s*([0-9]{1,9})", cell.attrs.get(name, ""))
    n = int(m[1]) if m else 1
    return min(n, most) if n else most if name == "rowspan" else 1


def _table(node: Node, seen: bool) -> list[str]:
    """Lines of a table: caption, then rows with their cells padded to the columns' widths.

    A cell that spans rows takes its columns in all of them, its text stands in
    the first.  Columns in which no cell begins have no width.
    """
    caption: list[str] = []
    rows: list[list[tuple[int, int, str]]] = []
    taken: dict[int, int] = {}

    def add(row: Node, seen: bool) -> None:
        nonlocal taken
        cells, column, still = [], 0, {c: n - 1 for c, n in taken.items() if n > 1}
        for cell in row.children:
            if isinstance(cell, Node) and cell.tag in ("td", "th") and _shown(cell):
                while column in taken:
                    column += 1
                wide, deep = _span(cell, "colspan", MOST_COLUMNS), _span(cell, "rowspan", MOST_ROWS)
                cells.append((column, column + wide, " ".join(y for y in (z.strip() for z in layout(cell, _seen(cell, seen))) if y)))
                if deep > 1:
                    still.update(dict.fromkeys(range(column, column + wide), deep - 1))
                column += wide
        taken = still
        rows.append(cells)

    def walk(parent: Node, seen: bool) -> None:
        nonlocal taken
        for x in parent.children:
            if isinstance(x, Node) and _shown(x):
                now = _seen(x, seen)
                if x.tag == "caption":
                    caption.extend(layout(x, now))
                elif x.tag == "tr":
                    add(x, now)
                else:
                    taken = {}
                    walk(x, now)

    walk(node, seen)
    starts = sorted({first for row in rows for first, _, _ in row})
    # Among these columns, the first one of each cell and the one after its last.
    ranked = [[(bisect_left(starts, a), bisect_left(starts, b), text) for a, b, text in row] for row in rows]
    widths = [0] * len(starts)
    for row in ranked:
        for a, b, text in row:
            if b - a == 1:
                widths[a] = max(widths[a], len(text))
    ahead = [0, *accumulate(widths)]
    out = caption
    for row in ranked:
        line, at = "", 0
        for a, b, text in row:
            if a > at:
                line += (" | " if at else "") + " " * (ahead[a] - ahead[at] + 3 * (a - at - 1))
            line += (" | " if a else "") + text.ljust(ahead[b] - ahead[a] + 3 * (b - a - 1))
            at = b
        if line.strip(" |"):
            out.append(line.rstrip())
    return out


def layout(node: Node, seen: bool = True) -> list[str]:
    """Lines that the inside of ``node`` is seen as."""

    def part(x: Node, out: _Lines, mark: str, always: bool, now: bool) -> None:
        inner = _Lines(out, mark, always)
        walk(x, False, _seen(x, now), inner, x)
        inner.close(now)

    def walk(parent: Node, keep: bool, seen: bool, out: _Lines, top: Node) -> None:
        number, shut = 0, parent.tag == "details" and "open" not in parent.attrs
        for x in parent.children:
            if isinstance(x, str):
                if not shut and seen:
                    out.text(x, keep)
                continue
            if not _shown(x) or (shut and x.tag != "summary"):
                continue
            now = _seen(x, seen)
            if x.tag == "br":
                if seen:
                    out.end(keep=True)
            elif x.tag == "hr":
                out.margin()
            elif x.tag in BLOCK:
                edge = out.margin if x.tag in SPACED and not (x.tag in ("ul", "ol", "menu") and top.tag == "li") else out.end
                edge()
                if x.tag == "table":
                    for line in _table(x, now):
                        out.text(line, True)
                        out.end()
                elif x.tag == "li":
                    number += 1
                    part(x, out, f"{number}. " if parent.tag == "ol" else "- ", True, now)
                elif x.tag in ("blockquote", "dd"):
                    part(x, out, "  ", False, now)
                else:
                    walk(x, keep or x.tag == "pre", now, out, top)
                edge()
            elif x.tag in ("td", "th"):
                if now:
                    out.text(" ", keep)
                walk(x, keep, now, out, top)
            else:
                walk(x, keep, now, out, top)

    out = _Lines()
    walk(node, False, _seen(node, seen), out, node)
    return out.lines()


def visible_text(source: str | None) -> str:
    """Text of a page; a null or empty page has none. At most one blank line stands between lines."""
    if not source:
        return ""
    # A frame of Python for each open element: as many as the page has tags, at most.
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 3 * source.count("<")))
    text = "\n".join(layout(build(source.replace("\r\n", "\n").replace("\r", "\n").replace("\0", ""))))
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n")


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "html"):
            text = [visible_text(x) for x in part["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([part["page_id"], pa.array(text, pa.string())], names=["page_id", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id`` and ``text`` of every row of ``pages``; other columns but ``html`` are not read.

    A null or empty page has an empty text; null ids stay null, repeated rows
    are rows of their own, an empty table gives no rows.
    """
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html")).mapInArrow(_rendered, "page_id long, text string")
