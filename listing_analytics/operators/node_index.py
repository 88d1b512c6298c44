"""An index of a page's nodes by tag, class, id, style and text, and rules as lookups in it.

The pass that shreds a page notes, for every key that some rule asks for, the ascending positions of the nodes that have
it. A step of a rule then reads a short list of positions instead of testing all nodes: the first match is its first
entry, matches inside an element or after it are those in a range of positions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from listing_analytics.operators import nodes as nd
from listing_analytics.rules.model import Find

ELEMENT, TEXT = "element:", "text:"
FOLLOWING = "following:"  # elements that are only looked for right after another node

_PLAIN = re.compile(r"[^\\.^$|?*+()\[\]{}]+")  # patterns that stand for themselves


def class_key(tag: str | None, cls: str) -> str:
    return f"class:{tag or ''}\n{cls}"


def key_of(find: Find) -> str:
    """The key that narrows a step down most."""
    if find.like is not None:
        return f"like:{find.like}" if _PLAIN.fullmatch(find.like) else TEXT
    if find.string is not None:
        return f"string:{find.string}"
    if find.contains is not None:
        return f"contains:{find.contains}"
    if find.id is not None:
        return f"id:{find.id}"
    if find.style is not None:
        return f"style:{find.style}"
    if find.cls is not None:
        return class_key(find.tag, find.cls)
    if find.tag is not None:
        return f"tag:{find.tag}"
    return FOLLOWING if find.axis == "next" else ELEMENT


def rest_of(find: Find) -> list[nd.Test]:
    """What the key does not cover of a step."""
    key = key_of(find)
    if find.like is not None:
        return [nd.text_matches(find.like)] if key == TEXT else []
    tests: list[nd.Test] = []
    if find.tag is not None and not key.startswith(("tag:", "class:")):
        tests.append(nd.tag_is(find.tag))
    if find.cls is not None and not key.startswith("class:"):
        tests.append(nd.has_class(find.cls))
    if find.style is not None and not key.startswith("style:"):
        tests.append(nd.has_style(find.style))
    if find.id is not None and not key.startswith("id:"):
        tests.append(nd.has_id(find.id))
    if find.contains is not None and not key.startswith("contains:"):
        tests.append(nd.string_contains(find.contains))
    return tests


def fields_of(find: Find) -> set[str]:
    """What the tests of ``rest_of`` look at of a node."""
    key = key_of(find)
    if find.like is not None:
        return {"tag", "string"} if key == TEXT else set()
    fields = {"tag"} if find.tag is not None and not key.startswith(("tag:", "class:")) else set()
    if find.cls is not None and not key.startswith("class:"):
        fields.add("cls")
    if find.style is not None and not key.startswith("style:") or find.id is not None and not key.startswith("id:"):
        fields.add("attrs")
    if find.contains is not None and not key.startswith("contains:"):
        fields |= {"tag", "string", "only"}
    return fields


class Wanted:
    """Collects the positions of one page at a time for the keys asked for."""

    def __init__(self, keys: Iterable[str]) -> None:
        self.texts = False
        self.all: list[str] = []
        self.tags: dict[str, str] = {}
        self.ids: dict[str, str] = {}
        self.styles: dict[str, str] = {}
        self.exact: dict[str, str] = {}
        self.parts: list[tuple[str, str]] = []
        self.likes: list[tuple[str, str]] = []
        # Class names that tell which keys to look at; a key with several names means the whole attribute.
        self.classes: dict[str, list[tuple[str, str, str]]] = {}
        for key in keys:
            kind, _, value = key.partition(":")
            if key in (ELEMENT, FOLLOWING):
                self.all.append(key)
            elif key == TEXT:
                self.texts = True
            elif kind == "class":
                tag, _, cls = value.partition("\n")
                self.classes.setdefault(cls.split(" ")[0], []).append((tag, f" {cls} " if " " in cls else "", key))
            elif kind == "contains":
                self.parts.append((value, key))
            elif kind == "like":
                self.likes.append((value, key))
            else:
                {"tag": self.tags, "id": self.ids, "style": self.styles, "string": self.exact}[kind][value] = key
        self.strings = bool(self.exact or self.parts)
        self.attributes = bool(self.ids or self.styles)

    def begin(self) -> None:
        self.positions: dict[str, list[int]] = {}
        self.unsorted: set[str] = set()

    def _note(self, key: str, pre: int) -> None:
        self.positions.setdefault(key, []).append(pre)

    def element(self, pre: int, tag: str, cls: str | None, names: list[str], values: list[str], first: int) -> None:
        for key in self.all:
            self._note(key, pre)
        if tag in self.tags:
            self._note(self.tags[tag], pre)
        if cls is not None and self.classes:
            for name in dict.fromkeys(cls.split()):
                for wanted_tag, whole, key in self.classes.get(name, ()):
                    if (not wanted_tag or wanted_tag == tag) and (not whole or whole == cls):
                        self._note(key, pre)
        if self.attributes:
            for at in range(first, len(names)):
                if names[at] == "id" and values[at] in self.ids:
                    self._note(self.ids[values[at]], pre)
                elif names[at] == "style" and values[at] in self.styles:
                    self._note(self.styles[values[at]], pre)

    def text(self, pre: int, data: str) -> None:
        if self.texts:
            self._note(TEXT, pre)
        for part, key in self.likes:
            if part in data:
                self._note(key, pre)
        if data in self.exact:
            self._note(self.exact[data], pre)
            self.unsorted.add(self.exact[data])

    def string(self, pre: int, only: str) -> None:
        """The only text of an element, known when it closes."""
        if only in self.exact:
            self._note(self.exact[only], pre)
            self.unsorted.add(self.exact[only])
        for part, key in self.parts:
            if part in only:
                self._note(key, pre)
                self.unsorted.add(key)

    def found(self) -> dict[str, list[int]]:
        for key in self.unsorted:
            self.positions[key].sort()
        return self.positions


def _index() -> Column:
    return F.col("index")


def positions(find: Find, nodes: Column | None = None) -> Column:
    """Ascending positions of all matches of a step on a page, never null on a page that was read."""
    nodes = F.col("nodes") if nodes is None else nodes
    found = F.coalesce(_index()[key_of(find)], F.array().cast("array<int>"))
    rest = rest_of(find)
    return F.filter(found, lambda p: nd.every(*rest)(F.get(nodes, p))) if rest else found


def node_at(position: Column) -> Column:
    return F.get(F.col("nodes"), position)


def first_position(find: Find) -> Column:
    """First match in document order."""
    return F.get(positions(find), F.lit(0))


def lies_in(position: Column, node: Column) -> Column:
    """Whether a position is one of those inside a node: they follow it directly."""
    return (position > node["pre"]) & (position <= node["post"] + node["level"])


def positions_inside(anchor: Column, find: Find) -> Column:
    """Matches inside an element."""
    return nd.let(node_at(anchor), lambda a: F.filter(positions(find), lambda p: lies_in(p, a)))


def inside(node: Column, find: Find) -> Column:
    """Matches inside a node, as nodes; null without one."""
    return nd.let(node, lambda a: F.when(a.isNotNull(), F.transform(
        F.filter(positions(find), lambda p: lies_in(p, a)), node_at)))


def first_inside(anchor: Column, find: Find) -> Column:
    return F.get(positions_inside(anchor, find), F.lit(0))


def first_after(anchor: Column, find: Find) -> Column:
    """First match that opens after an element opened."""
    return nd.let(F.struct(anchor.alias("a")), lambda s: F.get(F.filter(positions(find), lambda p: p > s["a"]), F.lit(0)))


def sibling(anchor: Column) -> Column:
    """Next element with the same parent."""
    return node_at(anchor)["next"]
