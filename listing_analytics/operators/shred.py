"""HTML pages to nodes with pre/post numbering (B1, B2).

One narrow pass turns each page into one row ``(keys, text, nodes, problem)``. The nodes of a page
stay in one array, so everything that is selected from a page later is a narrow expression: page
extraction needs no shuffle at all. :func:`node_table` gives the one-row-per-node form.
"""

from __future__ import annotations

import html.parser
import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_analytics import schemas
from listing_analytics.operators import shred_slice as sl
from listing_analytics.operators.node_index import Wanted
from listing_analytics.session import ship_package

# Elements without content, and elements whose text is not shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(("script", "style", "template"))

_SLICE_BYTES = 1 << 19  # of HTML that is shredded before its nodes leave the worker

_SKIP = 15  # slices read page by page, after one of which less than a fifth could be read together

# The next end tag, start tag with quoted attributes, comment or doctype, as nearly all markup is written. A page with
# anything else is left to the standard parser as a whole; that is not a choice of result, only of speed.
_TOKEN = re.compile(r"""<(?:/([a-zA-Z][a-zA-Z0-9]*)[ \t\n\r\f]*>
    |([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][-a-zA-Z0-9_:]*=(?:"[^"]*"|'[^']*'))*)[ \t\n\r\f]*(/?)>
    |!--(?!>|->)((?:(?!--)[\s\S])*)-->
    |![dD][oO][cC][tT][yY][pP][eE][^<>\[\]]*>)""", re.VERBOSE)
_ATTRIBUTE = re.compile(r"""([a-zA-Z][-a-zA-Z0-9_:]*)=(?:"([^"]*)"|'([^']*)')""")
_RAW_END = {tag: re.compile(rf"</{tag}[ \t\n\r\f]*>", re.IGNORECASE) for tag in HTMLParser.CDATA_CONTENT_ELEMENTS}
_RAW_ODD = {tag: re.compile(rf"</\s*{tag}|<!--", re.IGNORECASE) for tag in HTMLParser.CDATA_CONTENT_ELEMENTS}
_unescape_attribute = getattr(html.parser, "_unescape_attrvalue", unescape)


class _Shredder(HTMLParser):
    """Collects nodes. An end tag closes up to its nearest open match, an unmatched one is ignored,
    what is still open closes at the end of the page."""

    PRE, POST, PARENT, LEVEL, SIB_ORD, TAG, CLS, STRING, START, END, ONLY, NEXT = range(12)

    def __init__(self, wanted: Wanted | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.wanted = wanted
        self.indexed: list[dict[str, list[int]]] = []
        self.rows: list[list] = []
        self.attr_ends: list[int] = [0]
        self.keys: list[str] = []
        self.values: list[str] = []

    def updatepos(self, i, j):
        """Line numbers are not needed."""
        return j

    def page(self, html: str) -> str:
        self._begin()
        if not self._feed_plain(html):
            self.undo()
            self._begin()
            self.feed(html)
            self.close()
        self._flush()
        while self.stack:
            self._close_top()
        if self.wanted is not None:
            self.indexed.append(self.wanted.found())
        return "".join(self.pieces)

    def _begin(self) -> None:
        self.reset()
        self.first = len(self.rows)
        self.posts = self.chars = self.hidden = 0
        self.pieces: list[str] = []
        self.buffer: list[str] = []
        # An open element: its row, children, elements among them, the node with the only string of the last child, the
        # last element among its children.
        self.stack: list[list] = []
        self.open_tags: dict[str, int] = {}
        if self.wanted is not None:
            self.wanted.begin()
        self._open("#document", ())

    def _feed_plain(self, html: str) -> bool:
        """Read a page whose markup is all of the usual form; false, with some nodes made, if it isn't."""
        stack, tag_of, at, pending, raw_end = self.stack, self.TAG, 0, "", None
        while True:
            for token in _TOKEN.finditer(html, at):
                start = token.start()
                if start > at:
                    text = html[at:start]
                    if "<" in text:
                        return False
                    if "&" in text:
                        text = unescape(text)
                    pending = pending + text if pending else text
                at, kind = token.end(), token.lastindex
                if kind is None:  # a doctype, around which text is one
                    continue
                if pending:
                    self._text(pending)
                    pending = ""
                if kind == 1:
                    tag = token[1].lower()
                    if stack[-1][0][tag_of] == tag:
                        self._close_top()
                    else:
                        self.handle_endtag(tag)
                elif kind == 5:
                    self.handle_comment(token[5])
                else:
                    tag, attrs = token[2].lower(), ()
                    if token[3]:
                        attrs = [(name.lower(), _unescape_attribute(a or b) if "&" in (a or b) else a or b)
                                 for name, a, b in _ATTRIBUTE.findall(token[3])]
                    self._open(tag, attrs)
                    if token[4] or tag in VOID:
                        if tag in _RAW_END:
                            return False
                        self._close_top()
                    elif tag in _RAW_END:
                        raw_end = _RAW_END[tag].search(html, at)
                        raw = html[at:raw_end.start()] if raw_end else ""
                        if raw_end is None or _RAW_ODD[tag].search(raw):
                            return False
                        if raw:
                            self._text(raw)
                        self._close_top()
                        at = raw_end.end()
                        break  # what looks like markup in between is none
            else:
                break
        rest = html[at:]
        if "<" in rest:
            return False
        pending += unescape(rest) if "&" in rest else rest
        if pending:
            self._text(pending)
        return True

    def undo(self) -> None:
        """Forget the nodes of a page that could not be read."""
        del self.rows[self.first:]
        del self.attr_ends[self.first + 1:]
        del self.keys[self.attr_ends[-1]:], self.values[self.attr_ends[-1]:]

    def _open(self, tag: str, attrs: Sequence[tuple[str, str | None]]) -> None:
        rows, stack, keys = self.rows, self.stack, self.keys
        at, sib_ord, cls, pre = -1, 0, None, len(rows) - self.first
        if attrs:
            first = len(keys)
            for key, value in dict(attrs).items():
                keys.append(key)
                self.values.append("" if value is None else value)
                if key == "class" and value:
                    cls = " " + " ".join(value.split()) + " "
        if stack:
            parent = stack[-1]
            at = parent[0][0]
            sib_ord = parent[2]
            parent[1] += 1
            parent[2] = sib_ord + 1
            if sib_ord:
                parent[4][self.NEXT] = pre
            row = parent[4] = [pre, -1, at, len(stack), sib_ord, tag, cls, None, self.chars, self.chars, None, None]
            if self.wanted is not None:
                self.wanted.element(pre, tag, cls, keys, self.values, first if attrs else len(keys))
        else:
            row = [pre, -1, at, 0, sib_ord, tag, cls, None, self.chars, self.chars, None, None]
        rows.append(row)
        self.attr_ends.append(len(keys))
        stack.append([row, 0, 0, None, None])
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1
        if tag in HIDDEN:
            self.hidden += 1

    def _close_top(self) -> None:
        row, children, _, holder, _ = self.stack.pop()
        tag = row[self.TAG]
        self.open_tags[tag] -= 1
        if tag in HIDDEN:
            self.hidden -= 1
        if isinstance(holder, str):  # a comment: its parent holds it
            row[self.STRING] = holder if children == 1 else None
            holder = row[self.PRE]
        only = holder if children == 1 else None
        row[self.ONLY] = only
        row[self.END] = self.chars
        row[self.POST] = self.posts
        self.posts += 1
        if self.stack:
            self.stack[-1][3] = only
            if only is not None and self.wanted is not None and self.wanted.strings:
                self.wanted.string(row[self.PRE], self.rows[self.first + only][self.STRING])

    def _flush(self) -> None:
        if self.buffer:
            data = "".join(self.buffer)
            self.buffer = []
            if data:
                self._text(data)

    def _text(self, data: str) -> None:
        top = self.stack[-1]
        top[1] += 1
        if self.hidden:
            top[3] = None
            return
        if data.isspace() and not data.strip(" \n\t\f\r"):
            data = "\n" if "\n" in data else " "
        top[3] = at = len(self.rows) - self.first
        end = self.chars + len(data)
        self.rows.append([at, self.posts, top[0][0], len(self.stack), None, "#text", None, data, self.chars, end, at, None])
        if self.wanted is not None:
            self.wanted.text(at, data)
        self.attr_ends.append(len(self.keys))
        self.posts += 1
        self.pieces.append(data)
        self.chars = end

    def handle_starttag(self, tag, attrs):
        self._flush()
        self._open(tag, attrs)
        if tag in VOID:
            self._close_top()

    def handle_startendtag(self, tag, attrs):
        self._flush()
        self._open(tag, attrs)
        self._close_top()

    def handle_endtag(self, tag):
        self._flush()
        if self.stack[-1][0][self.TAG] != tag:
            if tag in VOID or not self.open_tags.get(tag):
                return
            while self.stack[-1][0][self.TAG] != tag:
                self._close_top()
        self._close_top()

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_comment(self, data):
        self._flush()
        self.stack[-1][1] += 1
        self.stack[-1][3] = data

    def node_arrays(self) -> pa.StructArray:
        columns = list(zip(*self.rows)) or [()] * 12
        fields = {"attrs": pa.MapArray.from_arrays(
            pa.array(self.attr_ends, pa.int32()), pa.array(self.keys, pa.string()), pa.array(self.values, pa.string()))}
        names = ("pre", "post", "parent", "level", "sib_ord", "tag", "cls", "string", "start", "end", "only", "next")
        for name, values in zip(names, columns):
            kind = pa.string() if name in ("tag", "cls", "string") else pa.int32()
            fields[name] = pa.array(values, kind)
        return pa.StructArray.from_arrays([fields[f.name] for f in schemas.NODE.fields], schemas.NODE.fieldNames())


def _index_arrays(pages: list[dict[str, list[int]]]) -> pa.MapArray:
    ends, keys, starts, positions = [0], [], [0], []
    for page in pages:
        for key, found in page.items():
            keys.append(key)
            positions.extend(found)
            starts.append(len(positions))
        ends.append(len(keys))
    lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(positions, pa.int32()))
    return pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.string()), lists)


def _shred_slice(pages: list[str | None], wanted: Wanted | None = None) -> tuple[list, pa.ListArray, list, list[dict]]:
    shredder = _Shredder(wanted)
    texts, problems, ends = [], [], [0]
    for html in pages:
        text = problem = None
        if html is None:
            problem = "page is not valid text"
        else:
            try:
                text = shredder.page(html)
            except Exception as error:  # a page that cannot be read is reported, not fatal
                shredder.undo()
                problem = f"page cannot be parsed: {error}"
        if text is None:
            shredder.indexed.append({})
        texts.append(text)
        problems.append(problem)
        ends.append(len(shredder.rows))
    nodes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), shredder.node_arrays())
    return texts, nodes, problems, shredder.indexed


def _parse_tag(tag: str) -> tuple:
    """(kind, name, attributes, class) of one tag as it is written; odd ones are left to the standard parser."""
    token = _TOKEN.fullmatch(tag)
    if token is None:
        return sl.ODD, "", {}, None
    if token.lastindex is None:
        return sl.DOCTYPE, "", {}, None
    if token.lastindex == 1:
        return sl.END, token[1].lower(), {}, None
    if token.lastindex == 5:
        return sl.COMMENT, "", {"": token[5]}, None
    name, attrs = token[2].lower(), {}
    for key, a, b in _ATTRIBUTE.findall(token[3]):
        attrs[key.lower()] = _unescape_attribute(a or b) if "&" in (a or b) else a or b
    cls = " " + " ".join(attrs["class"].split()) + " " if attrs.get("class") else None
    if token[4] or name in VOID:
        return sl.ODD if name in _RAW_END else sl.VOID, name, attrs, cls
    return sl.START, name, attrs, cls


def _shred_pages(html: pa.StringArray, tags: sl.Tags, only_text: bool = False,
                 onward: dict[str, int] | None = None, fields: Sequence[str] = schemas.NODE.names,
                 ) -> tuple[pa.Array, pa.Array | None, pa.Array, pa.Array | None]:
    """Texts, nodes, problems and index of some pages: those of usual markup together, others one by one. With ``onward``
    pages are reduced to the nodes that the index names (``shred_slice.found_nodes``), which have just these ``fields``."""
    if tags.skip:  # of late hardly any page could be read so
        tags.skip -= 1
        read, texts, nodes, index = np.zeros(0, np.int64), None, None, None
    else:
        read, texts, nodes, index = sl.shred_columns(html, tags, _RAW_END, _RAW_ODD, HIDDEN, only_text, onward, fields)
        tags.skip = _SKIP if len(read) * 5 < len(html) else 0
    problems = pa.nulls(len(read), pa.string())
    if len(read) == len(html):
        return texts, nodes, problems, index
    odd = np.setdiff1d(np.arange(len(html)), read)
    odd_texts, odd_nodes, odd_problems, indexed = _shred_slice(html.take(pa.array(odd)).to_pylist(), tags.wanted)
    odd_index = None if tags.wanted is None else _index_arrays(indexed)
    if onward is not None:
        odd_nodes, odd_index = sl.found_nodes(odd_nodes, odd_index, onward, fields)
    found = [pa.array(odd_texts, pa.string()), None if only_text else odd_nodes, pa.array(odd_problems, pa.string()), odd_index]
    if not len(read):
        return tuple(found)
    order = pa.array(np.argsort(np.r_[read, odd]))
    return tuple(None if b is None else pa.concat_arrays([a, b]).take(order) for a, b in zip((texts, nodes, problems, index), found))


def _slices(html: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of consecutive slices of about ``_SLICE_BYTES``, one page at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(html), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = size = 0
    while start < len(ends):
        row = min(int(np.searchsorted(ends, size + _SLICE_BYTES)), len(ends) - 1)
        yield start, row + 1 - start
        start, size = row + 1, int(ends[row])


def shred(pages: DataFrame, html: str = "html", keep: Sequence[str] | None = None, index: Sequence[str] | None = None,
          nodes: str = "all", onward: dict[str, int] | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """Nodes and visible text of each page, next to the kept columns (B1).

    ``text`` is the text of the whole page, scripts, styles and comments left out (B2). With ``index``, the keys of
    ``node_index.key_of``, a map from those keys to ascending node positions is filled in the same pass.

    All pages are read as a whole; ``nodes`` says what leaves the pass: ``all`` nodes; ``found``, only those that the index
    names (see ``shred_slice.found_nodes``, also for ``onward``), with all members of a node or just the ``fields`` named; or
    ``none``, just the text.
    """
    if fields is not None and nodes != "found":
        raise ValueError("fields are only chosen of found nodes")
    if nodes not in ("all", "found", "none") or (nodes == "found") and index is None or (nodes == "none") and index is not None:
        raise ValueError("nodes must be all, found (with an index) or none (without one)")
    ship_package(pages.sparkSession)
    keep = [c for c in pages.columns if c != html] if keep is None else list(keep)
    wanted = None if index is None else sorted(set(index))
    more = [] if wanted is None else [T.StructField("index", T.MapType(T.StringType(), T.ArrayType(T.IntegerType())))]
    node = schemas.NODE if fields is None else T.StructType([f for f in schemas.NODE.fields if f.name in fields])
    schema = T.StructType(
        [pages.schema[c] for c in keep]
        + [T.StructField("text", T.StringType()), *([] if nodes == "none" else [T.StructField("nodes", T.ArrayType(node))]),
           T.StructField("problem", T.StringType()), *more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tags = sl.Tags(_parse_tag, None if wanted is None else Wanted(wanted))
        for batch in batches:
            for start, size in _slices(batch.column(len(keep))):
                part = batch.slice(start, size)
                text, found, problem, indexed = _shred_pages(
                    part.column(len(keep)).cast(pa.string()), tags, nodes == "none", (onward or {}) if nodes == "found" else None, node.names)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(len(keep))), *(c for c in (text, found, problem, indexed) if c is not None)],
                    names=schema.fieldNames())

    return pages.select(*keep, html).mapInArrow(run, schema)


def node_table(shredded: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per node: the ``dom_nodes`` table with the text of each element (B1).

    ``string`` is the only text of a node, at whatever depth it stands.
    """
    whole = F.transform("nodes", lambda n: n.withField("string", F.get(F.col("nodes"), n["only"])["string"]).dropFields("only", "next"))
    return shredded.select(key, "text", F.explode(whole).alias("n")).select(
        key, "n.*", F.expr("substring(text, n.start + 1, n.`end` - n.start)").alias("full_text"))


def visible_text(shredded: DataFrame, key: str = "page_id") -> DataFrame:
    """Whole-page text (B2)."""
    return shredded.select(key, "text")
