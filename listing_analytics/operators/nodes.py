"""Selection inside a page as column expressions over its node array.

Every function takes and returns columns, so a chain of selections runs in the task that holds
the page. ``Test`` is a function from a node column to a boolean column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Test = Callable[[Column], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``, also inside nested lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def every(*tests: Test) -> Test:
    def test(n: Column) -> Column:
        result = tests[0](n)
        for other in tests[1:]:
            result = result & other(n)
        return result

    return test


def is_element(n: Column) -> Column:
    return ~n["tag"].startswith("#")


def tag_is(tag: str) -> Test:
    return lambda n: n["tag"] == tag


def attribute(name: str, value: str) -> Test:
    return lambda n: n["attrs"][name] == value


def has_class(value: str) -> Test:
    """One class of the attribute, or the whole attribute when several are asked for."""
    padded = f" {value} "
    if " " in value:
        return lambda n: n["cls"] == padded
    return lambda n: n["cls"].contains(padded)


def has_id(value: str) -> Test:
    """B5."""
    return attribute("id", value)


def has_style(value: str) -> Test:
    """B6."""
    return attribute("style", value)


def only_string(n: Column, nodes: Column | None = None) -> Column:
    """The only text inside an element of the page whose node array is ``nodes``, null when there is more or none."""
    return F.get(F.col("nodes") if nodes is None else nodes, n["only"])["string"]


def string_is(value: str) -> Test:
    """The only text inside an element equals a value."""
    return lambda n: only_string(n) == value


def text_matches(pattern: str) -> Test:
    """A text node that contains a pattern."""
    return lambda n: (n["tag"] == "#text") & n["string"].rlike(pattern)


def string_contains(value: str) -> Test:
    """An element whose only text contains a value."""
    return lambda n: is_element(n) & only_string(n).contains(value)


def all_of(nodes: Column, test: Test) -> Column:
    """All matches in document order."""
    return F.filter(nodes, test)


def first_of(nodes: Column, test: Test) -> Column:
    """First match in document order, null when there is none."""
    return F.get(F.filter(nodes, test), F.lit(0))


def descendants(a: Column) -> Column:
    """Number of nodes below an element; they follow it directly in the array."""
    return a["post"] - a["pre"] + a["level"]


def next_element(nodes: Column, anchor: Column, test: Test = is_element) -> Column:
    """First element that opens after the anchor opened."""
    return let(anchor, lambda a: first_of(F.slice(nodes, a["pre"] + 2, F.size(nodes)), test))


def next_sibling(nodes: Column, anchor: Column) -> Column:
    """Next element with the same parent."""
    return let(anchor, lambda a: first_of(
        F.slice(nodes, a["pre"] + 2 + descendants(a), F.size(nodes)),
        lambda n: (n["parent"] == a["parent"]) & is_element(n)))


def inside(nodes: Column, anchor: Column, test: Test) -> Column:
    """All matches inside an element, in document order (B14); only its own nodes are looked at."""
    return let(anchor, lambda a: F.filter(F.slice(nodes, a["pre"] + 2, descendants(a)), test))


def first_inside(nodes: Column, anchor: Column, test: Test) -> Column:
    return F.get(inside(nodes, anchor, test), F.lit(0))


def read_attr(node: Column, name: str) -> Column:
    """Attribute of a node, null when absent."""
    return node["attrs"][name]


def text_of(text: Column, node: Column) -> Column:
    """Text of an element: one slice of the page text."""
    return let(node, lambda n: F.substring(text, n["start"] + 1, n["end"] - n["start"]))


def text_without(text: Column, node: Column, removed: Column) -> Column:
    """Text of an element without one of its descendants."""
    return let(F.struct(node.alias("n"), removed.alias("r")), lambda p: F.when(
        p["n"].isNotNull() & p["r"].isNotNull(),
        F.concat(F.substring(text, p["n"]["start"] + 1, p["r"]["start"] - p["n"]["start"]),
                 F.substring(text, p["r"]["end"] + 1, p["n"]["end"] - p["r"]["end"]))))
