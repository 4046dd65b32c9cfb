"""One-pass HTML reading as an Arrow-batched function (H01). Everything after it is DataFrame work."""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable
from html import unescape
from html.parser import HTMLParser
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from gidlake.functions.text import collapse_spaces

# Executors get this module with the function itself, so they need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What a reading may collect.
PARTS = ("elements", "tables", "lines")

VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE_TAGS = {"a", "abbr", "b", "code", "em", "i", "label", "mark", "q", "s", "small", "span", "strong", "sub",
               "sup", "u"}
HIDDEN_TAGS = {"script", "style", "head", "template", "noscript", "title"}

# The ids and classes that rules look for around an element; no others are kept in its scope.
SCOPE_MARKS = {"#right-sider", "#modal-nav-buttons", "#modal_nav_buttons", ".properties-wrapper-table", ".main-profile-container"}

# The ids whose elements carry project and company links.
LINK_IDS = {"company-news-btn", "project-news-btn", "project-map", "company_profile"}

# Class of the blocks whose rows are read as one table, whatever element they are.
BLOCK_MARK = ".properties-wrapper-table"

LINK_DDL = "struct<texts: array<string>, href: string, onclick: string>"
CELL_DDL = f"struct<tag: string, texts: array<string>, links: array<{LINK_DDL}>>"

# Every node is a place in page-wide lists, which are in page order. What lies below a node is a range of a list: texts t0 to
# t1, visible text v0 to v1, links l0 to l1, cells c0 to c1, rows r0 to r1, html start to end. Ranges of nested nodes nest.
PAGE_DDL = """struct<
  texts: array<string>, visible: array<string>,
  elements: array<struct<pos: int, tag: string, id: string, href: string, onclick: string, src: string,
                         data_url: string, scope: array<string>, t0: int, t1: int, v0: int, v1: int>>,
  tables: array<struct<table_no: int, tag: string, marks: array<string>, scope: array<string>, start: int, end: int, r0: int, r1: int,
                       l0: int, l1: int>>,
  rows: array<struct<table_no: int, row_no: int, c0: int, c1: int, l0: int, l1: int>>,
  cells: array<struct<table_no: int, row_no: int, col_no: int, tag: string, t0: int, t1: int, l0: int, l1: int>>,
  links: array<struct<href: string, onclick: string, t0: int, t1: int>>,
  lines: array<struct<scope: array<string>, text: string>>>"""

_text, _place = pa.string(), pa.int32()
_texts = pa.list_(_text)


def _nodes(**fields: pa.DataType) -> pa.DataType:
    return pa.list_(pa.struct(list(fields.items())))


def _places(*names: str) -> dict[str, pa.DataType]:
    return {n: _place for n in names}


_page = pa.struct([
    ("texts", _texts), ("visible", _texts),
    ("elements", _nodes(pos=_place, tag=_text, id=_text, href=_text, onclick=_text, src=_text, data_url=_text, scope=_texts, **_places("t0", "t1", "v0", "v1"))),
    ("tables", _nodes(table_no=_place, tag=_text, marks=_texts, scope=_texts, **_places("start", "end", "r0", "r1", "l0", "l1"))),
    ("rows", _nodes(**_places("table_no", "row_no", "c0", "c1", "l0", "l1"))),
    ("cells", _nodes(**_places("table_no", "row_no", "col_no"), tag=_text, **_places("t0", "t1", "l0", "l1"))),
    ("links", _nodes(href=_text, onclick=_text, **_places("t0", "t1"))),
    ("lines", _nodes(scope=_texts, text=_text)),
])

_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_CELLS, _SECTIONS = {"td", "th"}, {"tbody", "thead", "tfoot"}
_ROW, _TABLE, _ROW_OR_TABLE = {"tr"}, {"table"}, {"tr", "table"}
# Elements that an anchor outside of them does not reach into.
_ANCHOR_SCOPES = {"td", "th", "table", "caption", "template", "object"}

# Tags as nearly all pages write them: an end tag, or a start tag with quoted attributes. All others are left to HTMLParser.
_TAG = re.compile(r'<(?:/([a-zA-Z][a-zA-Z0-9]*)|([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n]+[a-zA-Z][a-zA-Z0-9_:-]*="[^"<>]*")*)[ \t\r\n]*)>')
_ATTRIBUTE = re.compile(r'([a-zA-Z][a-zA-Z0-9_:-]*)="([^"<>]*)"')
# Text whose character references all have an end; how others are read is HTMLParser's.
_REFERENCES = re.compile(r"(?:[^&]|&(?:[a-zA-Z][a-zA-Z0-9]*|#[0-9]+);)*")
# Elements whose content may not be markup, and content that is plain text either way.
_RAW = {"script", "style", "title", "textarea", "iframe", "noembed", "noframes", "xmp", "plaintext"}
_RAW_TEXT = re.compile(r"[^<&]*</([a-zA-Z]+)>")
# Tags that a batch of pages remembers.
_KNOWN_TAGS = 4096
# What a tag does: open an element and nothing else, open a cell or a row, more than that, or end an element.
_NOTHING, _CELL, _LINE, _MORE, _END = range(5)
_DOES_MORE = VOID_TAGS | HIDDEN_TAGS | _HEADINGS | _SECTIONS | _ANCHOR_SCOPES | {"a"}
# Nodes are lists: the values of their fields in the order of _page, then what only the reader needs. These are the places of
# what ends with a node, as (place in the node, place in _PageReader._upto).
_ELEMENT_ENDS, _TABLE_ENDS, _ROW_ENDS, _CELL_ENDS, _LINK_ENDS = ((9, 0), (11, 1)), ((5, 5), (7, 4), (9, 2)), ((3, 3), (5, 2)), ((5, 0), (7, 2)), ((3, 0),)
# Of a row its end and its number of cells, of a table its number of rows and its last row.
_C1, _N_CELLS, _N_ROWS, _ROW_OF = 3, 6, 10, 11


class _TagReader(HTMLParser):
    """The attributes of one start tag as HTMLParser reads them."""

    def __init__(self, text: str):
        super().__init__(convert_charrefs=True)
        self.attrs: list[tuple[str, str | None]] = []
        self.feed(text)

    def handle_starttag(self, tag, attrs):
        self.attrs = attrs


def _described(attrs: list[tuple[str, str | None]]) -> tuple[dict[str, str], list[str]]:
    """Attributes by name, the first of a name, and the element's id and classes as marks."""
    attr = {k: v or "" for k, v in reversed(attrs)}
    marks = [f"#{attr['id']}"] if attr.get("id") else []
    return attr, marks + [f".{c}" for c in attr.get("class", "").split()]


class _Tag:
    """A tag as read, with what follows from its text alone. The pages of a batch share their tags."""

    __slots__ = ("name", "does", "attr", "marks", "known_marks", "is_raw", "breaks", "opened")

    def __init__(self, name: str, is_end: bool, attr: dict[str, str], marks: list[str]):
        self.name, self.attr, self.marks = name, attr, marks
        self.known_marks = [m for m in marks if m in SCOPE_MARKS]
        self.is_raw, self.breaks = name in _RAW and not is_end, name not in INLINE_TAGS
        if is_end:
            self.does = _END
        elif self.known_marks or BLOCK_MARK in marks or attr.get("id") in LINK_IDS:
            self.does = _MORE
        else:
            self.does = _CELL if name in _CELLS else _LINE if name == "tr" else _MORE if name in _DOES_MORE else _NOTHING
        self.opened = [name, _NOTHING]


def _plain_tag(text: str) -> _Tag | None:
    """A plain tag, given without its "<"; none for any other piece, which HTMLParser reads."""
    text = f"<{text}"
    found = _TAG.fullmatch(text)
    if found is None:
        return None
    closed, opened, attributes = found.groups()
    attrs = []
    if attributes:
        attrs = [(k.lower(), unescape(v)) for k, v in _ATTRIBUTE.findall(attributes)] if _REFERENCES.fullmatch(text) else _TagReader(text).attrs
    return _Tag((closed or opened).lower(), closed is not None, *_described(attrs))


class _TagTable(dict):
    """Plain tags by their text; read anew once there are too many."""

    def __missing__(self, text: str) -> _Tag | None:
        if len(self) >= _KNOWN_TAGS:
            self.clear()
        tag = self[text] = _plain_tag(text)
        return tag


class _PageReader(HTMLParser):
    """Labels headings, links, tables, rows and cells with the ranges of what lies below them; collects visible text lines.

    Every piece of text is kept once and every node is a few numbers, so what is kept and the time taken grow with the page and
    not with its nesting. End tags that a page may leave out are implied: of cells, rows and sections by their next, of an
    anchor by the next anchor, of a heading by a heading right inside it; a cell without a row opens one.

    Plain tags are told apart here; from the first piece that is none (a comment, an odd tag) HTMLParser reads on. Most tags only
    open or end an element, a cell or a row: _take does these by itself, as a call for each would cost more than the work.

    An open element is a list: its tag and what that does; of a cell its node and the anchor around it; of a row its node; where it does
    more its nodes with their ends, its known marks, whether it is a heading, and the anchor around it.
    """

    def __init__(self, html: str, parts: frozenset[str], plain_tag: Callable = _plain_tag):
        super().__init__(convert_charrefs=True)
        self.html, self.plain_tag = html, plain_tag
        self.want_elements, self.want_tables, self.want_lines = (p in parts for p in PARTS)
        self.open: list[list] = []
        self.open_tags: defaultdict[str, int] = defaultdict(int)
        self.around: Counter[str] = Counter()
        self.anchor: list | None = None
        self.tables_open: list[list] = []
        self.texts: list[str] = []
        self.visible: list[str] = []
        self.elements: list[list] = []
        self.tables: list[list] = []
        self.rows: list[list] = []
        self.cells: list[list] = []
        self.links: list[list] = []
        self.lines: list[tuple] = []
        self.line: list[str] = []
        self.hidden = self.in_headings = 0
        self.at: int | None = 0  # the place of the tag being read, none while HTMLParser reads
        rest = self._read_plain(html)
        if rest < len(html):
            self.at, self.starts = None, [rest]
            for line in html[rest:].split("\n"):
                self.starts.append(self.starts[-1] + len(line) + 1)
            self.feed(html[rest:])
            self.close()
        while self.open:
            self._close_top(len(html))
        self._end_line()

    def _read_plain(self, html: str) -> int:
        """Read text and plain tags from the start of a page; where they end."""
        first, *pieces = html.split("<")
        if not pieces or first and self.plain_tag(pieces[0][:pieces[0].find(">") + 1]) is None:
            return 0
        if first:
            self.handle_data(unescape(first))
        return self._take(pieces, len(first))

    def _take(self, pieces: list[str], here: int) -> int:
        """Read tags from a place on, each without its "<" and with the text behind it, up to one that is not plain; where that begins."""
        elements, counts, tables, texts, links, cells = self.open, self.open_tags, self.tables_open, self.texts, self.links, self.cells
        want_lines, want_texts, plain_tag = self.want_lines, self.want_elements or self.want_tables, self.plain_tag
        for piece in pieces:
            size = piece.find(">") + 1
            tag = plain_tag(piece[:size])
            if tag is None:
                return here
            end = here + 1 + size
            name, does = tag.name, tag.does
            if tag.is_raw:
                content = _RAW_TEXT.match(self.html, end)
                if content is None or content[1].lower() != name or name == "plaintext":
                    return here
            if does == _END:
                top = elements[-1] if elements else None
                if top is None or top[0] != name:
                    self.at = here
                    self.handle_endtag(name)
                elif top[1] == _MORE:
                    self._close_top(end)
                else:
                    if self.line and tag.breaks:
                        self._end_line()
                    elements.pop()
                    counts[name] -= 1
                    if top[1] == _CELL:
                        if (node := top[2]) is not None:
                            node[5], node[7] = len(texts), len(links)
                        self.anchor = top[3]
                    elif top[1] == _LINE and (node := top[2]) is not None:
                        node[3], node[5] = len(cells), len(links)
            elif does == _MORE:
                self.at = here
                self._start(tag)
            elif does == _NOTHING:
                if tag.breaks and self.line:
                    self._end_line()
                elements.append(tag.opened)
                counts[name] += 1
            else:
                self.at = here
                self._start_in_table(name, does)
            here += 1 + len(piece)
            if here > end:
                text = piece[size:]
                if "&" in text:
                    text = unescape(text)
                if not self.hidden:
                    if want_lines:
                        self.line.append(text)
                    if self.in_headings:
                        self.visible.append(text)
                if want_texts and (text := text.strip()):
                    texts.append(text)
        return here

    def _offset(self) -> int:
        if self.at is not None:
            return self.at
        row, column = self.getpos()
        return self.starts[row - 1] + column

    def _scope(self) -> list[str]:
        return [mark for mark, n in self.around.items() if n]

    def _end_line(self) -> None:
        if not self.line:
            return
        text = " ".join("".join(self.line).split())
        if text:
            self.lines.append((self._scope(), text))
        self.line = []

    def _end(self, nodes: Iterable[tuple[list, tuple]], offset: int) -> None:
        """End the ranges of nodes here; those ended before stay."""
        upto = (len(self.texts), len(self.visible), len(self.links), len(self.cells), len(self.rows), offset)
        for node, ends in nodes:
            for place, of in ends:
                if node[place] is None:
                    node[place] = upto[of]

    def _close_top(self, offset: int) -> None:
        top = self.open.pop()
        tag, does = top[:2]
        if self.line and tag not in INLINE_TAGS:
            self._end_line()
        self.open_tags[tag] -= 1
        if does == _CELL:
            if top[2] is not None:
                self._end(((top[2], _CELL_ENDS),), offset)
            self.anchor = top[3]
        elif does == _LINE:
            if top[2] is not None:
                self._end(((top[2], _ROW_ENDS),), offset)
        elif does == _MORE:
            _, _, nodes, marks, heading, anchor = top
            self._end(nodes, offset)
            for mark in marks:
                self.around[mark] -= 1
            self.in_headings -= heading
            if tag in HIDDEN_TAGS:
                self.hidden -= 1
            if tag in _ANCHOR_SCOPES:
                self.anchor = anchor
            elif top is self.anchor:
                self.anchor = None
            if tag == "table" and self.tables_open:
                self.tables_open.pop()

    def _close_until(self, tags: set[str], stop: set[str]) -> None:
        """An opening cell, row or section ends an unclosed one of the same table."""
        for depth in range(len(self.open) - 1, -1, -1):
            tag = self.open[depth][0]
            if tag in stop:
                return
            if tag in tags:
                offset = self._offset()
                while len(self.open) > depth:
                    self._close_top(offset)
                return

    def _new_row(self) -> list:
        table = self.tables_open[-1]
        row = [table[0], table[_N_ROWS], len(self.cells), None, len(self.links), None, 0]
        table[_N_ROWS] += 1
        table[_ROW_OF] = row
        self.rows.append(row)
        return row

    def _new_cell(self, tag: str) -> list:
        row = self.tables_open[-1][_ROW_OF]
        cell = [row[0], row[1], row[_N_CELLS], tag, len(self.texts), None, len(self.links), None]
        row[_N_CELLS] += 1
        self.cells.append(cell)
        return cell

    def _open_row(self) -> None:
        if self.line:
            self._end_line()
        self.open.append(["tr", _LINE, self._new_row() if self.tables_open else None])
        self.open_tags["tr"] += 1

    def _before_cell(self) -> None:
        """A cell ends the one before it, and opens a row where none is open."""
        if self.open and self.open[-1][0] != "tr":
            self._close_until(_CELLS, _ROW_OR_TABLE)
        if self.tables_open and ((row := self.tables_open[-1][_ROW_OF]) is None or row[_C1] is not None):
            self._open_row()

    def _start_in_table(self, tag: str, does: int) -> None:
        """Open a cell or a row that does nothing else."""
        if does == _LINE:
            if self.open and self.open[-1][0] != "table":
                self._close_until(_ROW, _TABLE)
            self._open_row()
            return
        self._before_cell()
        if self.line:
            self._end_line()
        self.open.append([tag, _CELL, self._new_cell(tag) if self.tables_open else None, self.anchor])
        self.open_tags[tag] += 1
        self.anchor = None

    def handle_starttag(self, tag, attrs):
        read = _Tag(tag, False, *_described(attrs))
        if read.does == _NOTHING:
            if read.breaks:
                self._end_line()
            self.open.append(read.opened)
            self.open_tags[tag] += 1
        elif read.does == _MORE:
            self._start(read)
        else:
            self._start_in_table(tag, read.does)

    def _start(self, read: _Tag) -> None:
        """Open an element that may end others, be a node, hide its content or name a place."""
        tag, attr, marks = read.name, read.attr, read.marks
        if tag in _CELLS:
            self._before_cell()
        elif tag == "tr":
            self._close_until(_ROW, _TABLE)
        elif tag in _SECTIONS:
            self._close_until(_SECTIONS, _TABLE)
            self._close_until(_ROW, _TABLE)
        elif tag == "a" and self.anchor is not None:
            self._end_anchor()
        elif tag in _HEADINGS and self.open and self.open[-1][0] in _HEADINGS:
            self._close_top(self._offset())
        if tag in VOID_TAGS and tag not in INLINE_TAGS:
            self._end_line()
        nodes: list[tuple[list, tuple]] = []
        heading = tag in ("h1", "h3") and self.want_elements
        if tag == "br" and self.in_headings:
            self.visible.append(" ")
        if self.want_elements and (tag in ("h1", "h3", "a") or attr.get("id") in LINK_IDS):
            element = [len(self.elements), tag, attr.get("id"), attr.get("href"), attr.get("onclick"), attr.get("src"), attr.get("data-url"),
                       self._scope(), len(self.texts), None, len(self.visible), None]
            self.elements.append(element)
            nodes.append((element, _ELEMENT_ENDS))
        if self.want_tables and (tag == "table" or BLOCK_MARK in marks):
            block = [len(self.tables), tag, marks, self._scope(), self._offset(), None, len(self.rows), None, len(self.links), None, 0, None]
            self.tables.append(block)
            nodes.append((block, _TABLE_ENDS))
            if tag == "table":
                self.tables_open.append(block)
        if self.tables_open:
            if tag == "tr":
                nodes.append((self._new_row(), _ROW_ENDS))
            elif tag in _CELLS:
                nodes.append((self._new_cell(tag), _CELL_ENDS))
            elif tag == "a":
                link = [attr.get("href"), attr.get("onclick"), len(self.texts), None]
                self.links.append(link)
                nodes.append((link, _LINK_ENDS))
        if tag in VOID_TAGS:
            self._end(nodes, self._offset())
            return
        if self.line and read.breaks:
            self._end_line()
        for mark in read.known_marks:
            self.around[mark] += 1
        self.open.append([tag, _MORE, nodes, read.known_marks, heading, self.anchor])
        self.open_tags[tag] += 1
        self.in_headings += heading
        self.hidden += tag in HIDDEN_TAGS
        if tag in _ANCHOR_SCOPES:
            self.anchor = None
        elif tag == "a":
            self.anchor = self.open[-1]

    def _end_anchor(self) -> None:
        """The open anchor ends where another begins; elements opened inside it stay open."""
        if self.open[-1] is self.anchor:
            self._close_top(self._offset())
            return
        self._end(self.anchor[2], self._offset())
        self.open_tags["a"] -= 1
        self.anchor[0], self.anchor = "", None
        self.open_tags[""] += 1

    def handle_endtag(self, tag):
        if not self.open_tags[tag]:
            return
        depth = len(self.open) - 1
        while self.open[depth][0] != tag:
            depth -= 1
        here = self._offset()
        end = self.html.find(">", here) + 1
        while len(self.open) > depth:
            self._close_top(end if len(self.open) == depth + 1 else here)

    def handle_data(self, data):
        if not self.hidden:
            if self.want_lines:
                self.line.append(data)
            if self.in_headings:
                self.visible.append(data)
        text = data.strip()
        if text and (self.want_elements or self.want_tables):
            self.texts.append(text)


def _read(html: str | None, parts: frozenset[str], plain_tag: Callable = _plain_tag) -> dict[str, list] | None:
    if html is None:
        return None
    page = _PageReader(html, parts, plain_tag)
    return {f.name: getattr(page, f.name) for f in _page}


def _array(items: list[list], kind: pa.DataType) -> pa.Array:
    """A list of nodes or texts for each page as one array; nodes become columns, without a mapping for each."""
    offsets = pa.array(np.cumsum([0, *map(len, items)]), pa.int32())
    flat = list(chain.from_iterable(items))
    if kind == _texts:
        return pa.ListArray.from_arrays(offsets, pa.array(flat, _text))
    fields = list(kind.value_type)
    columns = [pa.array([node[i] for node in flat], f.type) for i, f in enumerate(fields)]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, fields=fields))


def parse_html(html: Column, parts: tuple[str, ...] = PARTS) -> Column:
    """Labelled elements and tables and the visible lines of a page in one struct; parts not asked for stay empty."""
    wanted = frozenset(parts)

    def run(pages: pa.Array) -> pa.Array:
        plain_tag = _TagTable().__getitem__
        read = [_read(h, wanted, plain_tag) for h in pages.to_pylist()]
        columns = [_array([[] if page is None else page[f.name] for page in read], f.type) for f in _page]
        return pa.StructArray.from_arrays(columns, fields=list(_page), mask=pa.array([page is None for page in read], pa.bool_()))

    return arrow_udf(run, PAGE_DDL)(html)


def below(items: Column, first: Column, end: Column) -> Column:
    """The part of a page-wide list that lies below a node."""
    return F.slice(items, first + 1, end - first)


def node_text(page: Column, node: Column) -> Column:
    """Text of a heading or link of a page: the stripped pieces below it run together."""
    return F.array_join(below(page["texts"], node["t0"], node["t1"]), "")


def visible_text(page: Column, heading: Column) -> Column:
    """Text of a heading as a reader sees it: white space of the page and line breaks kept, as one blank each."""
    return collapse_spaces(F.array_join(below(page["visible"], heading["v0"], heading["v1"]), ""))


def block_rows(page: Column, block: Column) -> Column:
    """All rows below a block, those of tables inside its cells too, in page order; of each row all cells below it, with their
    texts and links."""
    def link(a: Column) -> Column:
        return F.struct(below(page["texts"], a["t0"], a["t1"]).alias("texts"), a["href"].alias("href"), a["onclick"].alias("onclick"))

    def cell(c: Column) -> Column:
        return F.struct(c["tag"].alias("tag"), below(page["texts"], c["t0"], c["t1"]).alias("texts"),
                        F.transform(below(page["links"], c["l0"], c["l1"]), link).alias("links"))

    return F.transform(below(page["rows"], block["r0"], block["r1"]), lambda r: F.transform(below(page["cells"], r["c0"], r["c1"]), cell))


def element_text(node: Column) -> Column:
    """Text of a cell or link of block_rows: its stripped pieces run together."""
    return F.array_join(node["texts"], "")


def spaced_text(node: Column) -> Column:
    """Text of a cell with one blank between its pieces."""
    return F.array_join(node["texts"], " ")
