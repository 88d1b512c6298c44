"""Vocabulary of the site rules. A new site is a new set of these values, not new code."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Find:
    """One step of a path through a page. Given attributes must all hold.

    ``axis``: ``page`` (first match anywhere), ``inside`` (first match inside the previous node),
    ``next`` (first match that opens after it), ``sibling`` (next element with the same parent).
    """

    axis: str = "page"
    tag: str | None = None
    cls: str | None = None
    id: str | None = None
    style: str | None = None
    string: str | None = None
    contains: str | None = None
    like: str | None = None


@dataclass(frozen=True)
class Field:
    """How one field of a record is read.

    ``take`` names what is read from the node the path ends at (see ``extract.TAKE``), ``arg`` its
    argument. Fields of one name are alternatives in order. ``need`` says when a missing node makes
    the page a reject: ``always``, ``after`` (the step before was found) or never. Fields of one
    ``group`` are blank unless all of them are found.
    """

    name: str
    path: tuple[Find, ...] = ()
    take: str = "strip"
    arg: str | None = None
    default: str | None = ""
    need: str | None = None
    group: str | None = None


@dataclass(frozen=True)
class Reviews:
    """Where reviews are on a page, and how the parts of one review are read.

    ``gate`` must hold digits that do not sum to zero. ``page_fields`` are the same for all reviews
    of a page. The other members describe one review node, see ``extract.review_structs``.
    """

    container: Find
    item: Find
    layout: str
    gate: Find | None = None
    page_fields: tuple[Field, ...] = ()
    author: str | None = None


@dataclass(frozen=True)
class Route:
    """Pages with the marker hold these entities; the first route that fits is taken."""

    entities: tuple[str, ...]
    id: str | None = None
    text: str | None = None


@dataclass(frozen=True)
class Site:
    name: str
    marketplace: str
    routes: tuple[Route, ...]
    product: tuple[Field, ...]
    vendor: tuple[Field, ...]
    reviews: Reviews
    # Which record owns the vendor name of the reviews on the same page.
    owner: tuple[str, str]
    invalid_text: str | None = None
    link_base: str = ""
    positive_icon: str = ""
    extra: dict = field(default_factory=dict)
