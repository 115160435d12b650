"""Pages to elements.

``shred`` adds two columns to a page table and moves no row: ``elements`` holds every
element of the page in document order (its index is its ``pos``), ``texts`` every text
piece once, with the element that owns it.  An element refers to its parent, its next
sibling and the last of its descendants by position, and to its text by a range of
``texts``, so that nothing is stored twice however deep the page nests.

All later work on a page (first match, attribute, sibling, labelled block) is then a
Spark expression over those arrays, without a shuffle.  ``element_table`` gives the same
content as one row per element.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package installed: the task code travels by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ELEMENTS_TYPE = (
    "array<struct<pos:int,parent:int,next:int,last:int,depth:int,tag:string,"
    "attrs:map<string,string>,text_from:int,text_to:int,classes:array<string>>>"
)
TEXTS_TYPE = "array<struct<owner:int,piece:string>>"
INDEX_TYPE = "map<string,array<int>>"

# Fixed values from the HTML standard.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN_TAGS = frozenset(("script", "style"))
# An opening tag ends an open element of these tags, unless one of the stop tags lies between.
IMPLIED_ENDS = {
    "p": (("p",), ("td", "th", "div", "article", "section", "body")),
    "li": (("li",), ("ul", "ol")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
for _block in ("div", "ul", "ol", "table", "article", "section", "h1", "h2", "h3", "h4", "h5", "h6"):
    IMPLIED_ENDS[_block] = IMPLIED_ENDS["p"]

Page = tuple[list[list], list[tuple[int | None, str]]]
_FLUSH_ELEMENTS = 50_000

# The plain form of most tags, with the text before it: lower case, attributes with values, no references.
# Any other form is left to the base class, which takes these in the same way but in many more steps.
_PLAIN_ATTR = r"""([a-z][a-z0-9_:-]*)=("[^"&]*"|'[^'&]*'|[A-Za-z0-9_:.%#-]+)"""
_PLAIN_TAG = re.compile(
    rf"([^<&]*)<(/?)([a-z][a-z0-9]*)(?:((?:[ \t\n\r\f]+{_PLAIN_ATTR.replace('(', '(?:')})+))?[ \t\n\r\f]*>"
)
_PLAIN_ATTR = re.compile(_PLAIN_ATTR)
# Elements whose content is read in another way.
_OPAQUE = frozenset((*HTMLParser.CDATA_CONTENT_ELEMENTS, *getattr(HTMLParser, "RCDATA_CONTENT_ELEMENTS", ()), "plaintext"))


class _PageReader(HTMLParser):
    """Collects the elements and text pieces of one page; forgives unclosed tags.

    ``open`` holds the open elements, and ``depths`` for each tag the places of its open
    elements in it.  An end tag compares the tops of these stacks and closes what lies above,
    so each element is closed once and the work is linear at any depth.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.elements: list[list] = []
        self.texts: list[tuple[int | None, str]] = []
        self.open: list[int] = []
        self.depths: defaultdict[str, list[int]] = defaultdict(list)
        self.last_child: dict[int, int] = {}

    def updatepos(self, i, j):
        """Line numbers are not asked for."""
        return j

    def parse_starttag(self, i):
        end = self._plain_tags(i)
        return end if end > i else super().parse_starttag(i)

    def parse_endtag(self, i):
        end = self._plain_tags(i) if self.cdata_elem is None else i
        return end if end > i else super().parse_endtag(i)

    def _plain_tags(self, i: int) -> int:
        """Take plain tags and the text between them as far as they go; the place behind the last one."""
        raw, plain = self.rawdata, _PLAIN_TAG.match
        while found := plain(raw, i):
            text, closing, tag, attrs = found.groups()
            if closing:
                if attrs:
                    break
            elif tag in _OPAQUE:
                break
            if text:
                self.handle_data(text)
            if closing:
                self.handle_endtag(tag)
            else:
                pairs = _PLAIN_ATTR.findall(attrs) if attrs else ()
                self.handle_starttag(tag, [(k, v[1:-1] if v[0] in "\"'" else v) for k, v in pairs])
            i = found.end()
        return i

    def handle_starttag(self, tag, attrs):
        ends = IMPLIED_ENDS.get(tag)
        if ends:
            self._close_implied(*ends)
        pos = len(self.elements)
        parent = self.open[-1] if self.open else None
        before = self.last_child.get(-1 if parent is None else parent)
        if before is not None:
            self.elements[before][2] = pos
        self.last_child[-1 if parent is None else parent] = pos
        n = len(self.texts)
        self.elements.append([pos, parent, None, pos, len(self.open), tag, dict(reversed(attrs)), n, n])
        if tag not in VOID_TAGS:
            self.depths[tag].append(len(self.open))
            self.open.append(pos)

    def handle_endtag(self, tag):
        if self.depths[tag]:
            self._close_down_to(self.depths[tag][-1])

    def handle_data(self, data):
        """Text outside any element is kept too, without an owner."""
        owner = self.open[-1] if self.open else None
        if owner is None or self.elements[owner][5] not in HIDDEN_TAGS:
            self.texts.append((owner, data))

    def parse_marked_section(self, i, report=1):
        """Skip ``<![…>``, whatever it holds; the base class refuses unknown ones."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _close_implied(self, closes, stops):
        depths = self.depths
        nearest = -1
        for t in closes:
            if depths[t] and depths[t][-1] > nearest:
                nearest = depths[t][-1]
        if nearest >= 0 and not any(depths[t] and depths[t][-1] >= nearest for t in stops if t not in closes):
            self._close_down_to(nearest)

    def _close_down_to(self, depth):
        last, n_texts = len(self.elements) - 1, len(self.texts)
        for pos in self.open[depth:]:
            element = self.elements[pos]
            self.depths[element[5]].pop()
            element[3], element[8] = last, n_texts
        del self.open[depth:]

    def read(self, html: str | None) -> Page | None:
        """Elements and texts; None for a page the reader cannot take, which is a reject."""
        if html:
            try:
                self.feed(html)
                self.close()
            except (AssertionError, ValueError):
                return None
            self._close_down_to(0)
        return self.elements, self.texts


def _lists(pages: list[Page | None], part: int) -> pa.Array:
    """Offsets of one list per page; a NULL offset is a NULL list."""
    offsets, end = [], 0
    for page in pages:
        offsets.append(None if page is None else end)
        end += 0 if page is None else len(page[part])
    return pa.array([*offsets, end], pa.int32())


def _map_offsets(sizes: list[int]) -> pa.Array:
    return pa.array([*accumulate(sizes, initial=0)], pa.int32())


def _arrow_columns(pages: list[Page | None]) -> list[pa.Array]:
    readable = [p for p in pages if p is not None]
    columns = list(zip(*(e for elements, _ in readable for e in elements), strict=True)) or [()] * 9
    ints = lambda i: pa.array(columns[i], pa.int32())
    attrs = pa.MapArray.from_arrays(
        _map_offsets(list(map(len, columns[6]))),
        pa.array([k for a in columns[6] if a for k in a], pa.string()),
        pa.array([v for a in columns[6] if a for v in a.values()], pa.string()),
    )
    # Class words are split here, once for each element, and not by each rule that asks for one.
    words = [(a.get("class") or "").split() if a else () for a in columns[6]]
    classes = pa.ListArray.from_arrays(_map_offsets(list(map(len, words))), pa.array([c for w in words if w for c in w], pa.string()))
    names = ["pos", "parent", "next", "last", "depth", "tag", "attrs", "text_from", "text_to", "classes"]
    parts = [ints(0), ints(1), ints(2), ints(3), ints(4), pa.array(columns[5], pa.string()), attrs, ints(7), ints(8), classes]
    elements = pa.ListArray.from_arrays(_lists(pages, 0), pa.StructArray.from_arrays(parts, names=names))
    pieces = [t for _, texts in readable for t in texts]
    owners = pa.array([t[0] for t in pieces], pa.int32())
    strings = pa.array([t[1] for t in pieces], pa.string())
    texts = pa.ListArray.from_arrays(
        _lists(pages, 1), pa.StructArray.from_arrays([owners, strings], names=["owner", "piece"])
    )
    return [elements, texts]


def _index_column(pages: list[Page | None]) -> pa.Array:
    """For each page its keys (tag, ``.class``, ``@attribute``) with the positions of their elements."""
    offsets, keys, sizes, places = [], [], [], []
    for page in pages:
        offsets.append(None if page is None else len(keys))
        found: defaultdict[str, list[int]] = defaultdict(list)
        for e in page[0] if page else ():
            found[e[5]].append(e[0])
            for name in e[6]:
                found[f"@{name}"].append(e[0])
            for word in set((e[6].get("class") or "").split()):
                found[f".{word}"].append(e[0])
        keys += found
        for at in found.values():
            sizes.append(len(at))
            places += at
    lists = pa.ListArray.from_arrays(_map_offsets(sizes), pa.array(places, pa.int32()))
    return pa.MapArray.from_arrays(pa.array([*offsets, len(keys)], pa.int32()), pa.array(keys, pa.string()), lists)


def shred(pages: DataFrame, html: str = "html", drop_html: bool = True, index: bool = False) -> DataFrame:
    """Add ``elements`` and ``texts`` to a page table (Arrow batches, map only).

    Both are empty for a page without text, and NULL for one that cannot be read.  With ``index`` also the
    positions of elements by tag, class word and attribute, which rules look up.
    """
    kept = [f for f in pages.schema.fields if not (drop_html and f.name == html)]
    schema = T.StructType(kept)
    parts = {"elements": ELEMENTS_TYPE, "texts": TEXTS_TYPE, **({"index": INDEX_TYPE} if index else {})}
    out = T.StructType(kept + [T.StructField(n, T.DataType.fromDDL(t)) for n, t in parts.items()])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            carried = batch.select(names)
            source = batch.column(html)
            start, done, size = 0, [], 0
            for i in range(batch.num_rows):
                done.append(_PageReader().read(source[i].as_py()))
                size += len(done[-1][0]) if done[-1] else 0
                # Output batches are cut by the number of elements, not of pages.
                if size >= _FLUSH_ELEMENTS or i == batch.num_rows - 1:
                    part = carried.slice(start, len(done))
                    made = _arrow_columns(done) + ([_index_column(done)] if index else [])
                    yield pa.RecordBatch.from_arrays(list(part.columns) + made, names=[*names, *parts])
                    start, done, size = i + 1, [], 0

    return pages.mapInArrow(run, out)


def text_of(texts: Column, element: Column) -> Column:
    """Whole text of an element, its descendants included."""
    pieces = F.slice(texts, element["text_from"] + 1, element["text_to"] - element["text_from"])
    return F.array_join(F.transform(pieces, lambda p: p["piece"]), "")


def own_text_of(texts: Column, element: Column) -> Column:
    """Text pieces that stand directly in an element."""
    pieces = F.slice(texts, element["text_from"] + 1, element["text_to"] - element["text_from"])
    mine = F.filter(pieces, lambda p: p["owner"] == element["pos"])
    return F.array_join(F.transform(mine, lambda p: p["piece"]), "")


def first_piece_of(texts: Column, element: Column) -> Column:
    """The first text piece standing directly in an element."""
    pieces = F.slice(texts, element["text_from"] + 1, element["text_to"] - element["text_from"])
    return F.get(F.filter(pieces, lambda p: p["owner"] == element["pos"]), F.lit(0))["piece"]


def element_table(shredded: DataFrame, *keys: str) -> DataFrame:
    """One row per element, with its own text; ``keys`` name the page columns to keep."""
    rows = shredded.select(*keys, "texts", F.explode("elements").alias("e"))
    return rows.select(
        *keys,
        F.col("e.pos").alias("pos"),
        F.col("e.parent").alias("parent_pos"),
        F.col("e.next").alias("next_pos"),
        F.col("e.last").alias("last_pos"),
        F.col("e.depth").alias("depth"),
        F.col("e.tag").alias("tag"),
        F.col("e.attrs").alias("attrs"),
        own_text_of(F.col("texts"), F.col("e")).alias("own_text"),
    )


class _PageElements:
    """Table function: the elements of a batch of pages, given as (key, html)."""

    def eval(self, pages: pa.RecordBatch):
        read, start, size = [], 0, 0
        for row, html in enumerate(pages.column(1)):
            read.append(_PageReader().read(html.as_py()) or ([], []))
            size += len(read[-1][0])
            # Output is cut by the number of elements, not of pages.
            if size >= _FLUSH_ELEMENTS or row == pages.num_rows - 1:
                yield self._table(pages.column(0).slice(start, len(read)), read)
                read, start, size = [], row + 1, 0

    @staticmethod
    def _table(keys: pa.Array, read: list[Page]) -> pa.Table:
        flat = [e for elements, _ in read for e in elements]
        owners = [row for row, (elements, _) in enumerate(read) for _ in elements]
        texts = []
        for elements, pieces in read:
            own: defaultdict[int | None, list[str]] = defaultdict(list)
            for owner, piece in pieces:
                own[owner].append(piece)
            texts += ["".join(own[e[0]]) for e in elements]
        ints = lambda i: pa.array([e[i] for e in flat], pa.int32())
        attrs = pa.array([list(e[6].items()) for e in flat], pa.map_(pa.string(), pa.string()))
        tags = pa.array([e[5] for e in flat], pa.string())
        return pa.Table.from_arrays(
            [keys.take(pa.array(owners, pa.int64())), ints(0), ints(1), ints(4), tags, attrs, pa.array(texts, pa.string())],
            ["key", "pos", "parent_pos", "depth", "tag", "attrs", "own_text"],
        )


def register_page_elements(spark: SparkSession, name: str = "page_elements", key: str = "bigint") -> None:
    """Make ``select … from page_elements(table(select key, html from pages))`` available to SQL.

    Pages come in Arrow batches, from each task its own; ``key`` is the type of what names a page.
    """
    columns = f"key {key}, pos int, parent_pos int, depth int, tag string, attrs map<string,string>, own_text string"
    spark.udtf.register(name, F.arrow_udtf(_PageElements, returnType=columns))
