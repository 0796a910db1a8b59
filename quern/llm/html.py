"""Operator 2: visible text of HTML pages, laid out.

One pass over a page's tags builds the tree with implied end tags and renders
each block as it closes: blocks on lines of their own, paragraphs apart, list
items marked and indented, table cells aligned.  Nothing visible is left out.
Time and memory grow with the page, however deep it nests or broken it is.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.store import table

_MARK = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|[!?/])")
_TAIL = re.compile(r"""(?:[^>=]++|=[ \t\n\r\f]*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+>""")  # a tag's attributes; quotes count after "=" alone
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_COMMENT_END = re.compile(r"--!?>")


def _set(names: str) -> frozenset[str]:
    return frozenset(names.split())


# Classes of elements.
_VOID = _set("area base br col embed hr img input link meta param source track wbr")
_RAW = _set("script style title textarea xmp noembed noframes iframe")
_UNSEEN = _set("script style template noembed noframes iframe head title datalist noscript object audio video canvas")
_IN_HEAD = _set("html head base basefont bgsound link meta title noscript noframes style script template")
_SPACED = _set("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset hr")
_BLOCK = _SPACED | _set("html body address article aside center dd details dialog dir div dt figcaption footer form header hgroup legend li main menu nav option optgroup search section select summary textarea xmp caption thead tbody tfoot tr td th")
_ENDS_P = _BLOCK - _set("html body caption thead tbody tfoot tr td th option optgroup")
_SCOPE = _set("html table td th caption template object button")
_CELLS = _set("td th")
_PARTS = _set("table tr thead tbody tfoot")
_INDENTED = _set("li blockquote dd")
_READ = _set("img input ol td th dialog")  # whose own attributes count
#: a start tag closes these, as far up as the second set
_IMPLIED = {
    "p": (_set("p"), _SCOPE),
    "li": (_set("li"), _set("ul ol menu dir") | _SCOPE),
    "dt": (_set("dt dd"), _set("dl") | _SCOPE),
    "dd": (_set("dt dd"), _set("dl") | _SCOPE),
    "option": (_set("option"), _set("select datalist") | _SCOPE),
    "optgroup": (_set("option optgroup"), _set("select") | _SCOPE),
    "tr": (_set("tr td th caption"), _set("table html template")),
    "td": (_CELLS, _set("tr table html template")),
    "th": (_CELLS, _set("tr table html template")),
    **{k: (_set("thead tbody tfoot tr td th caption colgroup"), _set("table html template")) for k in ("thead", "tbody", "tfoot", "caption", "colgroup")},
    "body": (_set("head"), _set("html")),
}
_SHOWN = _set("block inline inline-block flex inline-flex grid inline-grid table table-row table-cell table-row-group list-item contents flow-root")

MOST_INDENTS = 32  # nested lists and quotes that are indented
MOST_TABLES = 16  # nested tables that are laid out; the cells of further ones follow each other
MOST_ALIGNED = 240  # characters of a table's row within which cells stand in columns


class _Box:
    """An open element; a block holds its finished lines and the text of its last line."""

    __slots__ = ("name", "block", "gone", "veiled", "lines", "inline", "gap", "pre", "kind", "rows", "cells", "span", "level")

    def __init__(self, name: str, block: bool, gone: bool, veiled: bool, pre: bool, level: int):
        self.name, self.block, self.gone, self.veiled, self.pre, self.level = name, block, gone, veiled, pre, level
        self.lines: deque[str] | tuple = ()
        self.inline: list[str] | None = [] if block else None
        self.gap = False  # an empty line is due before the next block
        self.kind, self.span = None, (1, 1)
        if name in _PARTS:
            self.rows: list[list[tuple]] = []
            self.cells: list[tuple] = []  # lines, columns, rows of each

    def flush(self) -> None:
        if not self.inline:
            return
        text = "".join(self.inline)
        self.inline = []
        if self.pre:
            found = deque(text.split("\n"))
            if not self.lines and not found[0]:
                found.popleft()  # the line break right after the tag
        else:
            found = deque(_BLANKS.sub(" ", x).strip(" ") for x in text.split("\x00"))
            while found and not found[-1]:
                found.pop()
            while found and not found[0]:
                found.popleft()
        self.add(found, False)

    def add(self, lines: deque[str] | tuple, spaced: bool) -> None:
        """Appends lines; the shorter of the two runs is the one that moves."""
        if not lines:
            return
        if not self.lines:
            self.lines, self.gap = lines, spaced
            return
        if spaced or self.gap:
            self.lines.append("")
        self.gap = spaced
        if len(lines) > len(self.lines):
            lines.extendleft(reversed(self.lines))
            self.lines = lines
        else:
            self.lines.extend(lines)


def _placed(rows: list[list[tuple]]) -> list[list[tuple[int, int, deque]]]:
    """Each row's cells as (column, columns, lines): a cell of several rows keeps its columns free below."""
    out, held = [], {}  # held: column -> rows below that it is taken for
    for row in rows:
        taken, held = held, {c: n - 1 for c, n in held.items() if n > 1}
        at, cells = 0, []
        for lines, (wide, high) in row:
            while at in taken:
                at += 1
            cells.append((at, wide, lines))
            if high > 1 and at < MOST_ALIGNED // 3:
                held |= dict.fromkeys(range(at, min(at + wide, MOST_ALIGNED // 3)), high - 1)
            at += wide
        out.append(cells)
    return out


def _grid(rows: list[list[tuple]]) -> deque[str]:
    """Rows of cells in aligned columns; a cell of several lines makes its row as high.

    Columns are aligned as far as MOST_ALIGNED characters; what lies beyond follows
    behind single bars, so that the text grows with the page and not with its square.
    """
    placed = _placed(rows)
    width = [0] * (MOST_ALIGNED // 3)
    for cells in placed:
        for at, wide, lines in cells:
            if wide == 1 and at < len(width) and lines:
                width[at] = min(MOST_ALIGNED, max(width[at], *map(len, lines)))
    start = [0]
    for w in width:
        start.append(start[-1] + w + 3)
    out: deque[str] = deque()
    for cells in placed:
        near = [c for c in cells if c[0] < len(width) and start[c[0]] <= MOST_ALIGNED]
        far = [c for c in cells[len(near) :]]
        for i in range(max((len(lines) for _, _, lines in cells), default=0)):
            line, column = [], 0
            size = 0
            for at, wide, lines in near:
                for free in range(column, at):  # columns that a cell above takes
                    line.append(" " * width[free] + " | ")
                text = lines[i] if i < len(lines) else ""
                line.append(text)
                column = at + wide
                room = start[min(column, len(width))] - start[at] - 3
                line.append(" " * min(room - len(text), MOST_ALIGNED) + " | ")
            if i == 0:
                line += [f"{lines[0] if lines else ''} | " for _, _, lines in far]
            else:
                far = [c for c in far if len(c[2]) > i]
                line += [f"{lines[i]} | " for _, _, lines in far]
            whole = "".join(line)
            out.append(whole[: -3 if whole.endswith(" | ") else None].rstrip(" "))
    return out


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return out


def _style(text: str) -> dict[str, str]:
    """The properties of a style attribute: the last counts, an important one before others."""
    out: dict[str, tuple[bool, str]] = {}
    for part in text.lower().split(";"):
        name, _, value = part.partition(":")
        value = value.strip()
        strong = value.endswith("important")
        if strong:
            value = value.rpartition("!")[0].strip()
        name = name.strip()
        known = name == "display" and value in _SHOWN | {"none"} or name == "visibility" and value in ("visible", "hidden", "collapse")
        if known and out.get(name, (False, ""))[0] <= strong:
            out[name] = strong, value
    return {name: value for name, (_, value) in out.items()}


def _number(text: str | None, default: int) -> int:
    return int(text) if text and text.isdecimal() and len(text) <= 6 else default


class Page:
    """Renders one page: ``title`` and ``text``, in time linear in the source."""

    def __init__(self, source: str):
        root = _Box("#root", True, False, False, False, 0)
        self.stack = [root]
        self.blocks = [root]  # the open blocks, innermost last
        self.places: dict[str, list[int]] = {}  # where in the stack elements of a name are
        self.title = ""
        self.begun = False  # whether the body has
        self._read(source)
        while len(self.stack) > 1:
            self._close()
        root.flush()
        self.text = "\n".join(root.lines)

    def _read(self, source: str) -> None:
        at, last, quotes = 0, source.rfind(">"), True
        while True:
            m = _MARK.search(source, at)
            if m is None or m.start() > last and not m[3]:  # nothing closes a tag any more
                self._text(source[at:])
                return
            if m.start() > at:
                self._text(source[at : m.start()])
            at = m.end()
            if m[3]:
                if source.startswith((">", "->"), at):  # an empty comment
                    at = source.index(">", at) + 1
                    continue
                end = _COMMENT_END.search(source, at)
                if end is None:
                    return
                at = end.end()
            elif not m[2]:
                at = source.index(">", at) + 1
            else:
                tail = _TAIL.match(source, at) if quotes else None
                if tail is None:  # a quote never closes: from here on quotes mean nothing
                    quotes = False
                    end = source.index(">", at)
                else:
                    end = tail.end() - 1
                rest, at, name = source[at:end], end + 1, m[2].lower()
                if m[1]:
                    self._end(name)
                else:
                    self._start(name, rest)
                    if name in _RAW:
                        at = self._raw(source, at, name)

    def _raw(self, source: str, at: int, name: str) -> int:
        """Takes the text up to the end tag of an element that holds no others; where it ends."""
        end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
        body = source[at : end.start() if end else len(source)]
        if name == "title" and not self.title:
            self.title = _BLANKS.sub(" ", html.unescape(body)).strip(" ")
        if name in ("textarea", "xmp"):
            self._text(body)
        self._end(name)
        close = source.find(">", end.end()) if end else -1
        return close + 1 if close >= 0 else len(source)

    def _innermost(self, names: frozenset[str]) -> int:
        """Place in the stack of the innermost open element of these names, or 0."""
        return max((p[-1] for n in names if (p := self.places.get(n))), default=0)

    def _text(self, text: str) -> None:
        if self.stack[-1].name == "head" and text.strip():  # text belongs to the body
            self._close()
        top = self.stack[-1]
        if top.gone or top.veiled:
            return
        block = self.blocks[-1]
        if block.name in _PARTS and not text.strip():
            return
        self.begun = self.begun or bool(text.strip())
        text = html.unescape(text) if "&" in text else text
        block.inline.append(text.replace("\r\n", "\n") if block.pre else text.replace("\x00", ""))

    def _close_to(self, names: frozenset[str], limit: frozenset[str]) -> bool:
        """Closes the innermost of ``names`` and all within it, unless one of ``limit`` lies between."""
        at = self._innermost(names)
        if at == 0 or at < self._innermost(limit):
            return False
        while len(self.stack) > at:
            self._close()
        return True

    def _implied(self, name: str) -> None:
        if self.stack[-1].name == "head" and name not in _IN_HEAD:
            self._close()
        if name in _ENDS_P:
            self._close_to(*_IMPLIED["p"])
        closes, limit = _IMPLIED.get(name, (None, None))
        while closes and self._close_to(closes, limit):
            pass

    def _start(self, name: str, rest: str) -> None:
        if name == "head" and (self.begun or self.places.get("head")):
            return  # a second head
        self._implied(name)
        self.begun = self.begun or name not in _IN_HEAD
        parent = self.stack[-1]
        seen = not parent.gone and not parent.veiled
        if name == "br":
            if seen:
                self.blocks[-1].inline.append("\n" if self.blocks[-1].pre else "\x00")
            return
        low = rest.lower()
        attributes = _attributes(rest) if name in _READ or "hidden" in low or "style" in low else {}
        style = _style(attributes["style"]) if "style" in attributes else {}
        closed = "hidden" in attributes or name == "dialog" and "open" not in attributes
        gone = parent.gone or name in _UNSEEN or style.get("display", "none" if closed else "") == "none"
        veiled = style["visibility"] != "visible" if "visibility" in style else parent.veiled
        if name in _VOID:
            if not gone and not veiled:
                self._void(name, attributes)
            return
        block, up = name in _BLOCK, self.blocks[-1]
        box = _Box(name, block, gone, veiled, name in ("pre", "xmp", "textarea") or block and up.pre, up.level + (name in _INDENTED))
        if block and not gone:
            up.flush()
        if name == "ol":
            box.kind = _number(attributes.get("start"), 1)
        elif name in _CELLS:
            high = _number(attributes.get("rowspan"), 1)
            box.span = max(1, min(_number(attributes.get("colspan"), 1), 100)), high or 1 << 30  # 0: all rows below
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append(box)
        if block:
            self.blocks.append(box)

    def _void(self, name: str, attributes: dict[str, str]) -> None:
        said = ""
        if name == "hr":
            self.blocks[-1].flush()
            self.blocks[-1].add(deque(["-" * 3]), True)
        elif name == "img":
            said = attributes.get("alt", "")
        elif name == "input" and attributes.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number"):
            said = attributes.get("value", "")
        if said:
            self.blocks[-1].inline.append(said)

    def _end(self, name: str) -> None:
        if name == "br":
            self._start("br", "")
        elif name in ("table", "html", "body"):
            self._close_to(frozenset((name,)), frozenset())
        elif name in _PARTS | _CELLS | {"caption"}:
            self._close_to(frozenset((name,)), _set("table"))
        else:
            self._close_to(frozenset((name,)), _set("table td th"))

    def _close(self) -> None:
        box = self.stack.pop()
        self.places[box.name].pop()
        if not box.block:
            return
        self.blocks.pop()
        if box.gone:
            return
        box.flush()
        up, name = self.blocks[-1], box.name
        if name in _CELLS:
            home = self.stack[self._innermost(_set("tr table"))]
            if home.name == "#root" or len(self.places.get("table", ())) > MOST_TABLES:
                up.add(box.lines, False)
            else:
                home.cells.append((box.lines, box.span))
        elif name == "tr":
            home = self.stack[self._innermost(_set("table"))]
            home.add(box.lines, False)  # text that stands in a row but in no cell
            if home.name == "#root":
                up.add(_grid([box.cells]), False)
            elif box.cells:
                home.rows.append(box.cells)
        elif name == "table":
            if box.cells:
                box.rows.append(box.cells)
            box.gap = False
            box.add(_grid(box.rows), False)
            up.add(box.lines, True)
        elif name in _INDENTED:
            mark = ""
            if name == "li":
                mark = "- "
                if up.name == "ol":
                    mark, up.kind = f"{up.kind}. ", up.kind + 1
            if box.lines:
                pad = " " * len(mark) or "  "
                first = mark + box.lines.popleft() if mark else None
                if box.level <= MOST_INDENTS:
                    box.lines = deque(pad + x if x else x for x in box.lines)
                if first is not None:
                    box.lines.appendleft(first)
            up.add(box.lines, name == "blockquote")
        else:
            nested = name in ("ul", "ol", "dl") and up.name in ("li", "dd")
            up.add(box.lines, name in _SPACED and not nested)


def render(source: str | None) -> tuple[str, str]:
    """(title, text) of a page."""
    page = Page(source or "")
    return page.title, page.text


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [render(x.as_py()) for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([t for t, _ in found], pa.string()), pa.array([x for _, x in found], pa.string())], names=["page_id", "title", "text"])


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row for each row of ``pages``: page_id, title, text.

    * null or empty html: empty title and text.  Broken markup: tags that never
      open or close are mended as browsers do in the common cases; a '<' that
      begins no tag is text, and what is not of the head ends an open head.
    * hidden: the hidden attribute, display:none, visibility:hidden (but not what is
      visible again inside), dialogs that are not open, and elements that are never
      shown (scripts, styles, templates, head).  Closed details are shown.
    * very long pages: the whole page is rendered; beyond 32 nested lists and quotes
      lines are indented no further, beyond 16 nested tables and 240 characters of a row cells are not aligned.
    * repeated rows and null ids are kept; an empty table gives no rows; further
      columns are ignored.  No shuffle.
    """
    return pages.select(F.col(id_col), F.col(html_col).cast("string")).mapInArrow(_render, "page_id long, title string, text string")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
