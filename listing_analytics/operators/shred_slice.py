"""Many pages shredded at once, as columns (B1, B2).

Markup of the usual form is cut at its angle brackets over the bytes of all pages of a slice; each different tag is parsed
once, and nesting follows from sorting what the pages hold by depth. Which pages are of that form is found on the way: any
page that isn't, or whose elements do not nest, is handed back to be read tag by tag. That is not a choice of result, only
of speed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from listing_analytics import schemas
from listing_analytics.operators.node_index import FOLLOWING, TEXT, Wanted

# What a tag is, and what stands in a page.
START, END, VOID, COMMENT, DOCTYPE, ODD, WORDS, HIDDEN_WORDS = range(8)
_KNOWN = 1 << 14  # different tags that a worker remembers between slices


class Tags:
    """Every different tag of the pages, parsed once: its kind, name, attributes and the keys of an index that it has."""

    def __init__(self, parse: Callable[[str], tuple], wanted: Wanted | None) -> None:
        self.parse, self.wanted, self.known = parse, wanted, {}
        self.skip = 0  # slices to come that are not worth a try

    def of(self, tag: str) -> tuple:
        found = self.known.get(tag)
        if found is None:
            kind, name, attrs, cls = self.parse(tag)
            keys: list[str] = []
            if self.wanted is not None and kind in (START, VOID):
                self.wanted.begin()
                self.wanted.element(0, name, cls, list(attrs), list(attrs.values()), 0)
                keys = list(self.wanted.positions)
            found = (kind, name, attrs, cls, keys)
            if len(self.known) < _KNOWN:
                self.known[tag] = found
        return found


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of the counts, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(counts)]


def _ints(values: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    return pa.array(values.astype(np.int32), mask=None if valid is None else ~valid)


def _list(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(_ints(_offsets(counts)), values)


class _Cut:
    """The tags of the pages of a slice, and the texts between them."""

    def __init__(self, html: pa.StringArray, tags: Tags, raw_ends: dict, raw_odd: dict) -> None:
        n = len(html)
        edges = np.frombuffer(html.buffers()[1], np.int32)[html.offset:html.offset + n + 1].astype(np.int64)
        data = html.buffers()[2]
        self.bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        here = self.bytes[edges[0]:edges[-1]]
        opens, closes = (np.flatnonzero(here == sign) + edges[0] for sign in (60, 62))
        page = np.repeat(np.arange(n), np.diff(np.searchsorted(opens, edges)))
        if len(opens) == len(closes) and (opens < closes).all() and (closes[:-1] < opens[1:]).all():  # in turn, as nearly always
            end = closes + 1
        else:
            end = np.r_[closes, edges[-1] + 1][np.searchsorted(closes, opens)] + 1
        bad = end > edges[page + 1]
        bad[:-1] |= (opens[1:] < end[:-1]) & (page[1:] == page[:-1])
        self.good = np.ones(n, bool)
        self.good[page[bad]] = False
        if bad.any():
            keep = self.good[page]
            opens, end, page = opens[keep], end[keep], page[keep]

        # Alternating texts and tags: tag k of page p is segment 2k + p + 1.
        self.last = _offsets(np.bincount(page, minlength=n))
        offsets = np.empty(2 * len(opens) + n + 1, np.int64)
        at = 2 * np.arange(len(opens)) + page + 1
        offsets[2 * self.last[:-1] + np.arange(n)] = edges[:-1]
        offsets[at], offsets[at + 1], offsets[-1] = opens, end, edges[-1]
        self.segments = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), data)
        self.lengths = np.diff(offsets)

        coded = self.segments.take(pa.array(at)).dictionary_encode()
        self.tags = [tags.of(t) for t in coded.dictionary.to_pylist()]
        names: dict[str, int] = {}
        self.kind_of = np.array([t[0] for t in self.tags], np.int8)
        self.name_of = np.array([names.setdefault(t[1], len(names)) for t in self.tags], np.int64)
        code = coded.indices.to_numpy().astype(np.int64)
        raw_names = {names[t]: t for t in raw_ends if t in names}
        kind = self.kind_of[code]

        # What looks like markup inside a script or a style sheet is none.
        self.raw = np.zeros(len(self.segments), bool)
        stays = np.ones(len(code), bool)
        name = self.name_of[code]
        raw_starts = np.flatnonzero(((self.kind_of == START) & np.isin(self.name_of, list(raw_names)))[code]) if raw_names else np.zeros(0, np.int64)
        after = -1
        for i in raw_starts.tolist():
            if i < after:
                continue
            limit = int(self.last[page[i] + 1])
            j = i + 1
            while j < limit and not (kind[j] == END and name[j] == name[i]):
                j += 1
            inside = self.bytes[end[i]:opens[j]].tobytes().decode() if j < limit else ""
            if j == limit or (inside and raw_odd[raw_names[int(name[i])]].search(inside)):
                self.good[page[i]] = False
                after = limit
                continue
            stays[i + 1:j] = False
            self.raw[at[j] - 1] = bool(inside)
            after = j
        # A doctype with nothing before it; its text would go on behind it.
        if (self.kind_of == DOCTYPE).any():
            doctype = stays & (kind == DOCTYPE)
            self.good[page[doctype & (self.lengths[at - 1] > 0)]] = False
            stays &= ~doctype
        if (self.kind_of == ODD).any():
            self.good[page[stays & (kind == ODD)]] = False
        if html.null_count:
            self.good[html.is_null().to_numpy(zero_copy_only=False)] = False
        if not self.good.all():
            stays &= self.good[page]

        # Elements that do not nest.
        p, k, m = page, kind, name
        se = stays & (kind <= END)
        if not se.all():
            p, k, m = p[se], k[se], m[se]
        depth = np.cumsum(1 - 2 * k, dtype=np.int64)
        count = np.bincount(p, minlength=n)
        opened = np.r_[0, depth][_offsets(count)]
        depth -= opened[p]
        self.good[p[depth < 0]] = False
        self.good[np.diff(opened) != 0] = False
        level = depth + k
        if not self.good.all():
            ok = self.good[p]
            p, m, level = p[ok], m[ok], level[ok]
        order = _by_depth(level)
        starts, ends = order[::2], order[1::2]
        self.good[p[starts[m[starts] != m[ends]]]] = False

        if not self.good.all():
            stays &= self.good[page]
        if not stays.all():
            code, at, page, kind = code[stays], at[stays], page[stays], kind[stays]
        self.code, self.at, self.page, self.kind = code, at, page, kind
        self.names = names


def _by_depth(depth: np.ndarray) -> np.ndarray:
    return np.argsort(depth.astype(np.uint16) if len(depth) and depth.max() < 1 << 16 else depth, kind="stable")


def shred_columns(html: pa.StringArray, tags: Tags, raw_ends: dict, raw_odd: dict, hidden_names: frozenset[str],
                  only_text: bool = False, onward: dict[str, int] | None = None, fields: Sequence[str] = schemas.NODE.names) -> tuple:
    """(which pages were read, their texts, nodes and index) of a slice; the index is null where none was asked for, the
    nodes where only texts were. With ``onward`` pages come as :func:`found_nodes` reduces them, nodes with these ``fields``."""
    cut = _Cut(html, tags, raw_ends, raw_odd)
    good = np.flatnonzero(cut.good)
    number = np.cumsum(cut.good) - 1
    page, code, at = number[cut.page], cut.code, cut.at
    n = len(good)
    if not n:
        return good, None, None, None
    # In order: the start of a page, then a text and a tag in turn, the last text, its end. Raw texts end at their last part.
    of_page = np.bincount(page, minlength=n)
    sizes = 2 * of_page + 3
    base = _offsets(sizes)[:n]
    events = int(sizes.sum())
    kind = np.full(events, WORDS, np.int8)
    coded = np.full(events, -1, np.int32)
    segment = np.full(events, -1, np.int32)
    place = base[page] + 2 + 2 * (np.arange(len(page)) - _offsets(of_page)[:n][page])
    kind[place], coded[place] = cut.kind, code
    segment[place - 1] = at - 1
    kind[base], kind[base + sizes - 1] = START, END
    segment[base + sizes - 2] = 2 * cut.last[good + 1] + good
    filled = kind != WORDS
    where = np.flatnonzero(~filled)
    filled[where] = (cut.lengths[segment[where]] > 0) | cut.raw[segment[where]]
    kept = np.flatnonzero(filled)
    kind, coded, segment = kind[kept], coded[kept], segment[kept]
    page = np.repeat(np.arange(n), sizes)[kept]

    # Entities stand for characters, or for none.
    words = np.flatnonzero(kind == WORDS)
    texts = cut.segments.take(pa.array(segment[words]))
    entity = pc.match_substring(texts, "&").to_numpy(zero_copy_only=False)
    if entity.any():
        entity &= ~cut.raw[segment[words]]
    if entity.any():
        which = np.flatnonzero(entity)
        plain = [unescape(t) for t in texts.take(pa.array(which)).to_pylist()]
        texts = pc.replace_with_mask(texts, pa.array(entity), pa.array(plain, pa.string()))
        gone = words[which[[not t for t in plain]]]
        if len(gone):
            stay = np.ones(len(kind), bool)
            stay[gone] = False
            texts = texts.filter(pa.array(stay[words]))
            kind, coded, segment, page = kind[stay], coded[stay], segment[stay], page[stay]
            words = np.flatnonzero(kind == WORDS)

    hidden = np.array([t[1] in hidden_names for t in cut.tags] + [False], bool)
    if hidden.any():
        secret = hidden[coded]
        covered = np.cumsum(np.where(secret & (kind == START), 1, 0) - np.where(secret & (kind == END), 1, 0))
        shown = covered[words] == 0
        kind[words[~shown]] = HIDDEN_WORDS
        texts, words = texts.filter(pa.array(shown)), words[shown]
    blank = pc.equal(pc.binary_length(pc.ascii_trim(texts, characters=" \n\t\f\r")), 0)
    if pc.any(blank).as_py():
        texts = pc.if_else(blank, pc.if_else(pc.match_substring(texts, "\n"), "\n", " "), texts)

    whole = pc.binary_join(_list(np.bincount(page[words], minlength=n), _whole(texts)), "")
    if only_text:
        return good, whole, None, None
    if onward is not None:
        return good, whole, *_reduced(cut, kind, coded, page, n, words, _whole(texts), tags.wanted, onward, fields)

    # Nodes, numbered by where they begin and where they end.
    is_start, is_end, is_void, is_words = kind == START, kind == END, kind == VOID, kind == WORDS
    node = is_start | is_void | is_words
    starts_at = np.flatnonzero(is_start & (coded == -1))  # the first of a page
    rank = np.cumsum(node) - 1
    per_page = np.bincount(page[node], minlength=n)
    pre = rank - _offsets(per_page)[:n][page]
    done = is_end | is_void | is_words
    post = np.cumsum(done) - 1 - _offsets(per_page)[:n][page]
    step = is_start.astype(np.int64) - is_end
    depth = np.cumsum(step) - step
    size = np.zeros(len(kind), np.int64)
    size[words] = pc.utf8_length(texts).to_numpy()
    chars = np.cumsum(size)
    chars -= (chars - size)[starts_at][page]

    # Sorted by depth, an element is followed by what lies right inside it and its end.
    event = np.repeat(np.arange(len(kind)), 1 + is_start)
    opener = np.zeros(len(event), bool)
    opener[1:] = event[1:] == event[:-1]
    order = _by_depth(depth[event] + opener)[n:]
    event, opener = event[order], opener[order]
    group = np.cumsum(opener) - 1
    openers = event[opener]
    closing = is_end[event]
    ends = np.empty(len(kind), np.int64)
    ends[openers] = event[closing]
    child = ~opener & ~closing
    ev, gr = event[child], group[child]
    parent = np.full(len(kind), -1, np.int64)
    parent[ev] = pre[openers[gr]]
    children = np.bincount(gr, minlength=len(openers))
    element = is_start[ev] | is_void[ev]
    el, eg = ev[element], gr[element]
    born = np.bincount(eg, minlength=len(openers))
    sib_ord = np.zeros(len(kind), np.int64)
    sib_ord[el] = np.arange(len(el)) - _offsets(born)[:-1][eg]
    following = np.full(len(kind), -1, np.int64)
    following[el[:-1]] = np.where(eg[1:] == eg[:-1], pre[el[1:]], -1)

    # The only string inside: that of the only child, at any depth.
    leads = np.arange(len(kind))
    single = np.zeros(len(kind), bool)
    single[openers] = children == 1
    alone = single[openers[gr]]
    leads[openers[gr[alone]]] = ev[alone]
    comments = np.flatnonzero(is_start & (kind[leads] == COMMENT))
    comment_at = leads[comments]
    leads[comments] = comments
    while True:
        further = leads[leads]
        if (further == leads).all():
            break
        leads = further
    holds = is_words.copy()
    holds[comments] = True
    only = np.where(holds[leads], pre[leads], -1)

    # Columns of the nodes.
    at_node = np.flatnonzero(node)
    starts = is_start[at_node]
    end_of = np.where(starts, np.where(starts, ends[at_node], 0), at_node)
    node_code = coded[at_node]
    words_here = is_words[at_node]
    names = pa.array([*cut.names, "#text", "#document"], pa.string())
    name = np.where(words_here, len(cut.names), np.where(node_code == -1, len(cut.names) + 1, np.r_[cut.name_of, 0][node_code]))
    classes = pa.array([*(t[3] for t in cut.tags), None], pa.string())
    slot = np.where(node_code == -1, len(cut.tags), node_code)
    strings, string_at = texts, words
    if len(comments):
        said = pa.array([cut.tags[c][2][""] for c in coded[comment_at].tolist()], pa.string())
        both = np.argsort(np.r_[words, comments], kind="stable")
        strings, string_at = pa.concat_arrays([_whole(texts), said]).take(pa.array(both)), np.r_[words, comments][both]
    has_string = np.zeros(len(kind), bool)
    has_string[string_at] = True
    string_no = np.cumsum(has_string) - 1
    keys = [k if t[0] in (START, VOID) else [] for t in cut.tags for k in [list(t[2])]]
    counts = np.array([*(len(k) for k in keys), 0], np.int64)
    flat = _ranges(_offsets(counts)[:-1][slot], counts[slot])
    flat_keys = pa.array([x for k in keys for x in k], pa.string()).take(pa.array(flat))
    flat_values = pa.array([x for t, k in zip(cut.tags, keys) if k for x in t[2].values()], pa.string()).take(pa.array(flat))
    begin = chars[at_node] - size[at_node]
    fields = {
        "pre": _ints(pre[at_node]), "post": _ints(post[end_of]), "parent": _ints(parent[at_node]), "level": _ints(depth[at_node]),
        "sib_ord": _ints(sib_ord[at_node], ~words_here), "tag": names.take(pa.array(name)), "cls": classes.take(pa.array(slot)),
        "string": strings.take(_ints(string_no[at_node], has_string[at_node])), "start": _ints(begin), "end": _ints(chars[end_of]),
        "only": _ints(only[at_node], only[at_node] >= 0), "next": _ints(following[at_node], following[at_node] >= 0),
        "attrs": pa.MapArray.from_arrays(_ints(_offsets(counts[slot])), flat_keys, flat_values)}
    nodes = _list(per_page, pa.StructArray.from_arrays([fields[f.name] for f in schemas.NODE.fields], schemas.NODE.fieldNames()))
    if tags.wanted is None:
        return good, whole, nodes, None

    # Positions by key.
    held = np.flatnonzero(holds[leads] & is_start & (coded != -1))
    held_no = string_no[leads[held]]
    word_no = string_no[words]
    wanted, keys, found_key, found_at = tags.wanted, {}, [], []

    def note(key: str, events: np.ndarray) -> None:
        found_key.append(np.full(len(events), keys.setdefault(key, len(keys))))
        found_at.append(events)

    keyed: dict[str, list[int]] = {}
    for c, t in enumerate(cut.tags):
        for key in t[4]:
            keyed.setdefault(key, []).append(c)
    elements = np.flatnonzero((is_start & (coded != -1)) | is_void)
    for key, codes in keyed.items():
        has = np.zeros(len(cut.tags), bool)
        has[codes] = True
        note(key, elements[has[coded[elements]]])
    if wanted.texts:
        note(TEXT, words)
    for part, key in wanted.likes:
        note(key, words[pc.match_substring(texts, part).to_numpy(zero_copy_only=False)])
    if wanted.strings:
        for value, key in wanted.exact.items():
            same = pc.equal(strings, value).to_numpy(zero_copy_only=False)
            note(key, np.r_[words[same[word_no]], held[same[held_no]]])
        for part, key in wanted.parts:
            has = pc.match_substring(strings, part).to_numpy(zero_copy_only=False)
            note(key, held[has[held_no]])
    return good, whole, nodes, _index(keys, found_key, found_at, page, n, lambda which: pre[which])


def _family(kind: np.ndarray, depth: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number among the elements of the same parent, next such element (or -1) and end of every element."""
    tags = np.flatnonzero(kind <= VOID)
    event = np.repeat(tags, 1 + (kind[tags] == START))
    opener = np.zeros(len(event), bool)
    opener[1:] = event[1:] == event[:-1]
    # Sorted by depth, an element is followed by the elements right inside it and its end.
    order = _by_depth(depth[event] + opener)[n:]
    event, opener = event[order], opener[order]
    closing = kind[event] == END
    end = np.arange(len(kind))
    end[event[opener]] = event[closing]
    child = ~opener & ~closing
    event, group = event[child], (np.cumsum(opener) - 1)[child]
    number, following = np.zeros(len(kind), np.int64), np.full(len(kind), -1)
    same = group[1:] == group[:-1]
    number[event] = np.arange(len(event)) - np.flatnonzero(np.r_[True, ~same])[np.cumsum(np.r_[0, ~same])] if len(event) else 0
    following[event[:-1][same]] = event[1:][same]
    return number, following, end


def _reduced(cut: _Cut, kind: np.ndarray, coded: np.ndarray, page: np.ndarray, n: int, words: np.ndarray, texts: pa.StringArray,
             wanted: Wanted, onward: dict[str, int], fields: Sequence[str]) -> tuple[pa.ListArray, pa.MapArray]:
    """Nodes and index of pages as :func:`found_nodes` would reduce them; columns are only made of the nodes that stay."""
    is_start, is_end = kind == START, kind == END
    step = is_start.astype(np.int64) - is_end
    depth = np.cumsum(step) - step
    elements = np.flatnonzero((is_start & (coded != -1)) | (kind == VOID))
    no_start, no_end = np.flatnonzero(~is_start), np.r_[np.flatnonzero(~is_end), len(kind)]

    def holding(inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The elements in which a text or comment is all there is, and which of ``inner`` that is."""
        before = np.r_[-1, no_start][np.searchsorted(no_start, inner)]
        around = np.minimum(inner - before, no_end[np.searchsorted(no_end, inner) + 1] - inner) - 1
        which = np.repeat(np.arange(len(inner)), around)
        found = _ranges(inner - around, around)
        inside = coded[found] != -1
        return found[inside], which[inside]

    # Positions by key.
    keys: dict[str, int] = {}
    found_key, found_at = [], []

    def note(key: str, events: np.ndarray) -> None:
        found_key.append(np.full(len(events), keys.setdefault(key, len(keys))))
        found_at.append(events)

    keyed: dict[str, list[int]] = {}
    for c, t in enumerate(cut.tags):
        for key in t[4]:
            if key != FOLLOWING:
                keyed.setdefault(key, []).append(c)
    having = np.zeros(len(cut.tags), bool)
    having[[c for codes in keyed.values() for c in codes]] = True
    had = elements[having[coded[elements]]]
    for key, codes in keyed.items():
        has = np.zeros(len(cut.tags), bool)
        has[codes] = True
        note(key, had[has[coded[had]]])
    if wanted.texts:
        note(TEXT, words)
    for part, key in wanted.likes:
        note(key, words[pc.match_substring(texts, part).to_numpy(zero_copy_only=False)])
    comments = np.flatnonzero(kind == COMMENT)
    said = pa.array([cut.tags[c][2][""] for c in coded[comments].tolist()], pa.string())
    if wanted.strings:
        for strings, at, shown in ((texts, words, True), (said, comments, False)):
            for value, key in wanted.exact.items():
                same = at[pc.equal(strings, value).to_numpy(zero_copy_only=False)]
                if shown:
                    note(key, same)
                note(key, holding(same)[0])
            for part, key in wanted.parts:
                note(key, holding(at[pc.match_substring(strings, part).to_numpy(zero_copy_only=False)])[0])

    # Which nodes stay, and where paths go on.
    need = np.zeros(len(kind), bool)
    for events in found_at:
        need[events] = True
    number, following, end_of = _family(kind, depth, n)
    followed = np.zeros(len(kind), bool)
    reached = np.zeros(0, np.int64)
    follows = FOLLOWING in wanted.all
    for hop in range(max(onward.values(), default=0)):
        chosen = [a for k, a in zip(found_key, found_at) for key, times in onward.items() if times > hop and len(a) and keys.get(key) == k[0]]
        now = np.unique(np.concatenate([*chosen, reached]))
        to = np.zeros(0, np.int64)
        if follows:
            to = np.r_[elements, len(kind)][np.searchsorted(elements, now, "right")]
            to = to[np.r_[page, n][to] == page[now]]
            followed[to] = True
        sibling = following[now]
        reached = np.r_[to, sibling[sibling >= 0]]
        need[reached] = True
    if follows:
        note(FOLLOWING, np.flatnonzero(followed))

    # The nodes that stay, numbered by where they begin and where they end.
    kept = np.flatnonzero(need)
    of_page, here = np.bincount(page[kept], minlength=n), np.arange(len(kept))
    place = here - _offsets(of_page)[:-1][page[kept]]
    starts, words_here = is_start[kept], kind[kept] == WORDS
    ends = end_of[kept]
    upto = np.cumsum(need)  # nodes that stay up to an event
    level = here - _offsets(np.bincount(ends, minlength=len(kind)))[kept]
    moved = lambda to: np.where((to >= 0) & need[to], place[upto[to] - 1], -1) if len(kept) else to
    word = _offsets(kind == WORDS)  # texts before an event
    slot = np.where(words_here, len(cut.tags), coded[kept])

    # Their columns.
    made: dict[str, Callable[[], pa.Array]] = {}
    made["pre"] = lambda: _ints(place)
    made["post"] = lambda: _ints(place + upto[ends] - here - 1 - level)
    made["level"] = lambda: _ints(level)
    made["sib_ord"] = lambda: _ints(number[kept], ~words_here)
    made["tag"] = lambda: pa.array([*cut.names, "#text"], pa.string()).take(pa.array(np.r_[cut.name_of, len(cut.names)][slot]))
    made["cls"] = lambda: pa.array([*(t[3] for t in cut.tags), None], pa.string()).take(pa.array(slot))

    def parent() -> pa.Array:
        by_level = np.argsort(level, kind="stable")
        above = np.searchsorted(level[by_level] * (len(kept) + 1) + by_level, (level - 1) * (len(kept) + 1) + here) - 1
        return _ints(np.where(level > 0, place[by_level[above]], -1))

    made["parent"] = parent

    def next_element() -> pa.Array:
        to = moved(following[kept])
        return _ints(to, to >= 0)

    made["next"] = next_element

    def holders() -> np.ndarray:
        """The text that is all a node holds, itself where that is a comment, -1 for others."""
        holder = np.where(words_here, kept, -1)
        opening = kept[starts]
        inner = no_start[np.searchsorted(no_start, opening)]
        alone = no_end[np.searchsorted(no_end, inner, "right")] - inner > inner - opening
        holder[starts] = np.where(alone & (kind[inner] == WORDS), inner, np.where(alone & (kind[inner] == COMMENT), inner - 1, -1))
        return holder

    def only() -> pa.Array:
        to = moved(holders())
        return _ints(to, to >= 0)

    made["only"] = only

    def string() -> pa.Array:
        string_no = np.where(words_here, word[kept], -1)
        if len(comments):
            # An element with a comment alone holds it as its string.
            own = starts & (holders() == kept)
            string_no[own] = len(words) + np.searchsorted(comments, kept[own])
        return pa.concat_arrays([texts, said]).take(_ints(string_no, string_no >= 0))

    made["string"] = string

    def attrs() -> pa.Array:
        pairs = [list(t[2].items()) if t[0] in (START, VOID) else [] for t in cut.tags] + [[]]
        counts = np.array([len(a) for a in pairs], np.int64)
        flat = pa.array(_ranges(_offsets(counts)[:-1][slot], counts[slot]))
        return pa.MapArray.from_arrays(_ints(_offsets(counts[slot])), pa.array([k for a in pairs for k, _ in a], pa.string()).take(flat),
                                       pa.array([v for a in pairs for _, v in a], pa.string()).take(flat))

    made["attrs"] = attrs
    chars = _offsets(pc.utf8_length(texts).to_numpy())
    first = chars[_offsets(np.bincount(page[words], minlength=n))[:-1]][page[kept]]
    made["start"] = lambda: _ints(chars[word[kept]] - first)
    made["end"] = lambda: _ints(chars[word[ends + 1]] - first)
    nodes = _list(of_page, pa.StructArray.from_arrays([made[name]() for name in fields], list(fields)))
    return nodes, _index(keys, found_key, found_at, page, n, lambda which: place[upto[which] - 1])


def _index(keys: dict[str, int], found_key: list, found_at: list, page: np.ndarray, n: int, position: Callable) -> pa.MapArray:
    """The positions of events by page and key."""
    which = np.concatenate(found_at) if found_at else np.zeros(0, np.int64)
    key = np.concatenate(found_key).astype(np.int64) if found_key else which
    many, width = max(len(keys), 1), len(page)
    sorted_by = np.sort((page[which] * many + key) * width + which)
    entry, which = sorted_by // max(width, 1), sorted_by % max(width, 1)
    key = entry % many
    new = np.r_[True, entry[1:] != entry[:-1]] if len(entry) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    lists = _list(np.diff(np.r_[first, len(entry)]), _ints(position(which)))
    return pa.MapArray.from_arrays(
        _ints(_offsets(np.bincount(page[which[first]], minlength=n))), pa.array(list(keys), pa.string()).take(pa.array(key[first])), lists)


def found_nodes(nodes: pa.ListArray, index: pa.MapArray, onward: dict[str, int],
                fields: Sequence[str] = schemas.NODE.names) -> tuple[pa.ListArray, pa.MapArray]:
    """Pages reduced to the nodes that the index names.

    They are numbered, and lie inside each other, as if the other elements were not there; the index names their new
    positions. ``onward`` says from the nodes of which keys a path goes on to the next sibling or the element that follows,
    and how often; those are kept, too. What else a node points at is left out.
    """
    n, values = len(nodes), nodes.flatten()
    counts = nodes.value_lengths().to_numpy()
    first, page_end = (np.repeat(edge, counts) for edge in (_offsets(counts)[:-1], _offsets(counts)[1:]))
    column = lambda name: pc.fill_null(values.field(name), -1).to_numpy().astype(np.int64)
    here = np.arange(len(values))
    pointer = lambda name: np.where((to := column(name)) >= 0, to + first, -1)

    entry_ends = index.offsets.to_numpy()
    lists = index.items
    per_entry = lists.value_lengths().to_numpy()
    named = lists.flatten().to_numpy() + np.repeat(np.repeat(_offsets(counts)[:-1], np.diff(entry_ends)), per_entry)
    following = np.repeat(pc.equal(index.keys, FOLLOWING).to_numpy(zero_copy_only=False), per_entry)
    after = np.full(len(values) + 1, len(values))  # the first element from each node on
    after[named[following]] = named[following]
    after = np.minimum.accumulate(after[::-1])[::-1]
    need = np.zeros(len(values), bool)
    need[named[~following]] = True
    followed = np.zeros(len(values), bool)
    sibling = pointer("next")
    for hop in range(max(onward.values(), default=0)):
        keys = pa.array([key for key, times in onward.items() if times > hop], pa.string())
        chosen = np.repeat(pc.is_in(index.keys, keys).to_numpy(zero_copy_only=False), per_entry)
        now = np.unique(np.r_[named[chosen], reached]) if hop else named[chosen]
        to = after[now + 1]
        to = to[to < page_end[now]]
        followed[to] = True
        reached = np.r_[to, sibling[now][sibling[now] >= 0]]
        need[reached] = True
    holder = pointer("only")
    exact = named[np.repeat(pc.starts_with(index.keys, "string:").to_numpy(zero_copy_only=False), per_entry)]
    need[holder[exact]] = True  # a step may also ask what the string contains

    kept = np.flatnonzero(need)
    of_page = np.bincount(np.repeat(np.arange(n), counts)[kept], minlength=n)
    rank = np.cumsum(need)  # kept nodes up to here
    place = rank - 1 - np.repeat(_offsets(of_page)[:-1], counts)
    last = here + column("post") - column("pre") + column("level")
    level = np.cumsum(np.bincount(kept + 1, minlength=len(values) + 1) - np.bincount(last[kept] + 1, minlength=len(values) + 1))
    up = np.where(need, here, pointer("parent"))
    while True:  # the nearest kept node from here up
        further = np.where(up >= 0, up[up], -1)
        if (further == up).all():
            break
        up = further
    parent = pointer("parent")[kept]
    parent = np.where(parent >= 0, up[parent], -1)
    moved = lambda to: np.where(to >= 0, place[to], -1)
    next_at = sibling[kept]
    next_at = np.where((next_at >= 0) & need[next_at], next_at, -1)
    new = {"pre": place[kept], "post": place[kept] + rank[last[kept]] - rank[kept] - level[kept], "level": level[kept],
           "parent": moved(parent)}
    rows = values.take(pa.array(kept))
    made = {name: _ints(to) for name, to in new.items()}
    holder = holder[kept]
    for name, to in (("next", next_at), ("only", np.where((holder >= 0) & need[holder], holder, -1))):
        made[name] = _ints(moved(to), to >= 0)
    reduced = pa.StructArray.from_arrays([made.get(name, rows.field(name)) for name in fields], list(fields))

    stays = ~following | followed[named]
    entry = np.repeat(np.arange(len(lists)), per_entry)[stays]
    positions = _list(np.bincount(entry, minlength=len(lists)), _ints(place[named[stays]]))
    return _list(of_page, reduced), pa.MapArray.from_arrays(index.offsets, index.keys, positions)


def _whole(strings: pa.Array | pa.ChunkedArray) -> pa.Array:
    return strings.combine_chunks() if isinstance(strings, pa.ChunkedArray) else strings
