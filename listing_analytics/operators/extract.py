"""Site rules evaluated over shredded pages: routing and record extraction.

All rules of a page are column expressions over its nodes and their index, so extraction is one map-only
stage after the shredder, whatever the number of rules.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_analytics import schemas
from listing_analytics.functions import text as tx
from listing_analytics.operators import node_index as ni
from listing_analytics.operators import nodes as nd
from listing_analytics.operators.shred import shred
from listing_analytics.rules.model import Field, Find, Site


def _text() -> Column:
    return F.col("text")


def _cut(node: Column) -> Column:
    """Text of a node that is at hand or just looked up: cheaper than to keep it for reading its members."""
    return F.substring(_text(), node["start"] + 1, node["end"] - node["start"])


def _inside(node: Column, tag: str) -> Column:
    return ni.inside(node, Find(tag=tag))


def _first_inside(node: Column, tag: str) -> Column:
    return F.get(_inside(node, tag), F.lit(0))


# The elements that are looked for inside a review, by layout, and inside a card of the history.
_PARTS = {"table_row": ("img", "p"), "card": ("a", "span", "p")}
_HISTORY_PARTS = ("h3", "span")


def holds(entity: str) -> Column:
    """Whether a page holds an entity, as ``extract_pages`` keeps it."""
    return F.col(f"_has_{entity}")


def step_from(before: Column | None, step: Find) -> Column:
    """Position of the node one step further; null when it finds nothing."""
    if step.axis == "page":
        return ni.first_position(step)
    if step.axis == "inside":
        return ni.first_inside(before, step)
    if step.axis == "next":
        return ni.first_after(before, step)
    return ni.sibling(before)


def _site_steps(site: Site) -> list[Find]:
    steps = [step for path in Page(site).names for step in path]
    steps += [Find(id=route.id) for route in site.routes if route.id is not None]
    steps += [site.reviews.item, *(Find(tag=tag) for tag in _PARTS[site.reviews.layout])]
    steps += [Find(tag=f.arg) for f in (*site.product, *site.vendor, *site.reviews.page_fields) if f.take in ("without", "ratio")]
    steps += [site.extra["history"], *(Find(tag=tag) for tag in _HISTORY_PARTS)] if "history" in site.extra else []
    return [step for step in steps if step.axis != "sibling"]


def site_keys(site: Site) -> list[str]:
    """Keys that the rules of a site look up in the index of a page."""
    return sorted({ni.key_of(step) for step in _site_steps(site)})


def site_fields(site: Site) -> list[str]:
    """Members of a node that the rules of a site read."""
    read = {"pre", "post", "level", "attrs", "start", "end", "next"}.union(*map(ni.fields_of, _site_steps(site)))
    return [name for name in schemas.NODE.names if name in read]


def onward_keys(paths: Iterable[Sequence[Find]]) -> dict[str, int]:
    """Keys from whose nodes a path goes on to a sibling or to whatever element follows, and how often in a row."""
    found: dict[str, int] = {}
    for path in paths:
        key = times = None
        for step in path:
            if step.axis == "sibling" or ni.key_of(step) == ni.FOLLOWING:
                times += 1
                found[key] = max(found.get(key, 0), times)
            else:
                key, times = ni.key_of(step), 0
    return found


class Page:
    """The positions of the nodes that the paths of a site end at, each found once and kept in a column."""

    def __init__(self, site: Site) -> None:
        users: dict[tuple[Find, ...], set[str]] = {}

        def note(entity: str, path: Sequence[Find]) -> None:
            for depth in range(1, len(path) + 1):
                users.setdefault(tuple(path[:depth]), set()).add(entity)

        for entity, fields in (("product", site.product), ("vendor", site.vendor), ("review", site.reviews.page_fields)):
            for f in fields:
                note(entity, f.path)
        note("review", (site.reviews.container,))
        if site.reviews.gate is not None:
            note("review", (site.reviews.gate,))
        if "about" in site.extra:
            note("vendor", site.extra["about"])
        self.site = site
        self.users = users
        self.names = {path: f"_p{i}" for i, path in enumerate(users)}

    def position(self, path: Sequence[Find]) -> Column:
        return F.col(self.names[tuple(path)])

    def select(self, path: Sequence[Find]) -> Column:
        return ni.node_at(self.position(path))

    def stage(self, routed: DataFrame) -> DataFrame:
        """Add the found nodes, step by step; a path is only followed on pages that need it."""
        by_label = lambda path: path[0].contains is not None
        plain = [p for p in self.names if not by_label(p)]
        labels = [p for p in self.names if by_label(p)]
        df = self._steps(routed, plain)
        if "about" not in self.site.extra:
            return self._steps(df, labels)
        # The vendor's own text is taken out before labels are searched: only nodes that neither
        # lie inside it nor contain it remain.
        about = self.select(self.site.extra["about"])
        apart = lambda found: nd.let(F.struct(about.alias("a")), lambda s: F.filter(found, lambda p: nd.let(
            ni.node_at(p), lambda n: s["a"].isNull() | ((n["pre"] < s["a"]["pre"]) == (n["post"] < s["a"]["post"]))
            & (n["pre"] != s["a"]["pre"]))))
        return self._steps(df, labels, apart)

    def _steps(self, df: DataFrame, paths: list[tuple[Find, ...]], apart: Callable[[Column], Column] | None = None) -> DataFrame:
        for depth in range(1, max(map(len, paths), default=0) + 1):
            added = {}
            for path in paths:
                if len(path) == depth:
                    needed = reduce(lambda a, b: a | b, [holds(e) for e in sorted(self.users[path])])
                    if depth == 1 and apart is not None:
                        found = F.get(apart(ni.positions(path[0])), F.lit(0))
                    else:
                        found = step_from(self.position(path[:-1]) if depth > 1 else None, path[-1])
                    added[self.names[path]] = F.when(needed, found)
            df = df.withColumns(added)
        return df


def select_nodes(shredded: DataFrame, find: Find | Sequence[Find], first: bool = True,
                 key: Sequence[str] = ("page_id",)) -> DataFrame:
    """Matches of one rule as rows (B4-B11), with their text; of several rules, those of each in turn.

    The pages must be shredded with the keys of the rules.
    """
    found = [ni.positions(f) for f in ([find] if isinstance(find, Find) else find)]
    chosen = F.concat(*[F.slice(f, 1, 1) if first else f for f in found])
    rows = shredded.select(*key, "text", F.explode(F.transform(chosen, ni.node_at)).alias("n"))
    return rows.select(*key, "n.*", nd.text_of(_text(), F.col("n")).alias("full_text"))


def _parts(text: Column, sep: str) -> Column:
    return F.split(text, "\\Q" + sep + "\\E", -1)


def _two(text: Column, sep: str, at: int) -> Column:
    parts = _parts(text, sep)
    return F.when(F.size(parts) == 2, F.get(parts, F.lit(at)))


def _ratio(field: Field, node: Column) -> Column:
    value = lambda scale: tx.strip(nd.text_without(_text(), node, scale)).try_cast("double")
    return nd.let(_first_inside(node, field.arg), lambda scale: F.try_divide(
        value(scale), tx.all_digits(_cut(scale)).cast("double")).cast("string"))


def _second_of_two(field: Field, node: Column) -> Column:
    found = ni.positions(field.path[-1])
    return F.when(F.size(found) == 2, _cut(ni.node_at(F.get(found, F.lit(1)))))


def _joined(field: Field, node: Column) -> Column:
    return F.array_join(F.transform(
        ni.positions(field.path[-1]), lambda p: F.concat(tx.strip(_cut(ni.node_at(p))), F.lit(" "))), "")


# What can be read from the node at the end of a path.
TAKE: dict[str, Callable[[Field, Column], Column]] = {
    "text": lambda f, n: _cut(n),
    "strip": lambda f, n: tx.strip(_cut(n)),
    "attr": lambda f, n: nd.read_attr(n, f.arg),
    "link": lambda f, n: nd.read_attr(n, f.arg),
    "before": lambda f, n: _two(_cut(n), f.arg, 0),
    "after": lambda f, n: _two(_cut(n), f.arg, 1),
    "first_word": lambda f, n: tx.split_first(_cut(n), " "),
    "number_word": lambda f, n: tx.first_number_word(_cut(n)),
    "without": lambda f, n: tx.strip(nd.text_without(_text(), n, _first_inside(n, f.arg))),
    "ratio": _ratio,
    "second_of_two": _second_of_two,
    "joined": _joined,
}


def _value(page: Page, field: Field) -> Column:
    if field.take == "constant":
        return F.lit(field.default)
    value = TAKE[field.take](field, page.select(field.path))
    return F.concat(F.lit(page.site.link_base), value) if field.take == "link" else value


def _group_structs(page: Page, fields: Sequence[Field]) -> dict[str, Column]:
    """Fields that are blank unless all of their group are found, as one struct per group."""
    groups: dict[str, dict[str, Column]] = {}
    for f in fields:
        if f.group:
            groups.setdefault(f.group, {})[f.name] = _value(page, f)

    def all_or_nothing(values: dict[str, Column]) -> Column:
        complete = lambda s: F.when(reduce(lambda a, b: a & b, [s[n].isNotNull() for n in values]), s)
        return nd.let(F.struct(*[v.alias(n) for n, v in values.items()]), complete)

    return {f"_g_{name}": all_or_nothing(values) for name, values in groups.items()}


def _fields(page: Page, fields: Sequence[Field]) -> dict[str, Column]:
    """Value of every field: alternatives in order, groups all or nothing, then the default."""
    values: dict[str, Column] = {}
    for f in fields:
        value = F.col(f"_g_{f.group}")[f.name] if f.group else _value(page, f)
        if f.name in values:
            values[f.name] = F.coalesce(F.nullif(values[f.name], F.lit("")), value)
        else:
            values[f.name] = value
    defaults = {f.name: f.default for f in fields}
    return {name: v if defaults[name] is None else F.coalesce(v, F.lit(defaults[name]))
            for name, v in values.items()}


def _problems(page: Page, fields: Sequence[Field], entity: str) -> list[Column]:
    """One message per field that a valid page must have and this page has not."""
    found: list[Column] = []
    for f in fields:
        message = F.lit(f"{entity}.{f.name} is missing")
        if f.need == "always":
            found.append(F.when(page.select(f.path).isNull(), message))
        elif f.need == "after":
            found.append(F.when(page.select(f.path[:-1]).isNotNull() & page.select(f.path).isNull(), message))
        if f.take == "link":
            node = page.select(f.path)
            found.append(F.when(node.isNotNull() & nd.read_attr(node, f.arg).isNull(), message))
        if f.take == "before":
            node = page.select(f.path)
            parts = F.size(_parts(_cut(node), f.arg))
            found.append(F.when(node.isNotNull() & (parts != 2), F.lit(f"{entity}.{f.name} cannot be split")))
    return found


def _record(entity: str, values: dict[str, Column]) -> Column:
    names = schemas.RECORDS[entity].fieldNames()
    return F.struct(*[values[n].alias(n) for n in names])


def product_struct(page: Page) -> Column:
    """Product record of a page."""
    site = page.site
    return _record("product", {**_fields(page, site.product), "marketplace": F.lit(site.marketplace)})


def _history(site: Site) -> Column:
    """Map of other markets to sales and rating, from cards with exactly two numbers."""
    empty = F.expr("cast(map() as map<string, struct<sales: string, rating: string>>)")
    if "history" not in site.extra:
        return empty
    spans = lambda card: _inside(card, "span")
    entry = lambda card: nd.let(spans(card), lambda s: F.when(F.size(s) == 2, F.struct(
        tx.strip(nd.text_of(_text(), _first_inside(card, "h3"))).alias("key"),
        F.struct(tx.strip(_cut(F.get(s, F.lit(0)))).alias("sales"),
                 tx.strip(_cut(F.get(s, F.lit(1)))).alias("rating")).alias("value"))))
    entries = F.filter(F.transform(ni.positions(site.extra["history"]), lambda p: entry(ni.node_at(p))),
                       lambda e: e.isNotNull() & e["key"].isNotNull())
    # A market listed twice keeps its last card.
    last = nd.let(entries, lambda all_: F.filter(all_, lambda e, i: ~F.exists(
        F.slice(all_, i + 2, F.size(all_)), lambda later: later["key"] == e["key"])))
    return F.map_from_entries(last)


def vendor_struct(page: Page) -> Column:
    """Vendor record of a page."""
    site = page.site
    values = _fields(page, site.vendor)
    if "no_history_count" in site.extra:
        label = [f for f in site.vendor if f.name == "historic_sale_count"][0].path[:1]
        values["historic_sale_count"] = F.when(
            page.select(label).isNull(), F.lit(site.extra["no_history_count"])
        ).when(values["sale_count"].isNotNull(), values["historic_sale_count"])
    values |= {"marketplace": F.lit(site.marketplace), "marketplace_history": _history(site)}
    return _record("vendor", values)


def _table_row_review(site: Site, page: Column, row: Column) -> Column:
    """Four paragraphs: text, product, "author currency price", date; the icon is the rating."""
    image = _first_inside(row, "img")
    rating = (F.when(image.isNull(), "")
              .when(nd.read_attr(image, "src") == site.positive_icon, "positive").otherwise("negative"))
    part = lambda ps, i: tx.strip(_cut(F.get(ps, F.lit(i))))
    return nd.let(_inside(row, "p"), lambda ps: F.when(F.size(ps) > 0, nd.let(
        F.struct(ps.alias("p"), tx.words(part(ps, 2)).alias("w")), lambda x: F.struct(
            page["vendor"].alias("vendor"), page["product"].alias("product"),
            page["product_link"].alias("product_link"), part(x["p"], 3).alias("datetime"),
            F.get(x["w"], F.lit(0)).alias("author"), rating.alias("rating"), part(x["p"], 0).alias("text"),
            F.get(x["w"], F.lit(2)).alias("price_paid"), F.get(x["w"], F.lit(1)).alias("currency")))))


def _table_row_complete(row: Column) -> Column:
    """Null for a row that is no review."""
    words = lambda ps: tx.words(tx.strip(_cut(F.get(ps, F.lit(2)))))
    return nd.let(_inside(row, "p"), lambda ps: F.when(F.size(ps) > 0, (F.size(ps) == 4) & (F.size(words(ps)) == 3)))


def _card_review(site: Site, page: Column, card: Column) -> Column:
    """First span is the date, last span "price currency", paragraphs are rating and text."""
    text = lambda n: tx.strip(_cut(n))
    parts = F.struct(_inside(card, "span").alias("s"), _inside(card, "p").alias("p"), _first_inside(card, "a").alias("a"))
    return nd.let(parts, lambda x: nd.let(
        F.struct(tx.words(text(F.try_element_at(x["s"], F.lit(-1)))).alias("w")), lambda y: F.struct(
            page["vendor"].alias("vendor"),
            F.when(x["a"].isNull(), "").otherwise(text(x["a"])).alias("product"),
            F.when(x["a"].isNull(), "").otherwise(nd.read_attr(x["a"], "href")).alias("product_link"),
            text(F.get(x["s"], F.lit(0))).alias("datetime"), F.lit(site.reviews.author).alias("author"),
            F.coalesce(text(F.get(x["p"], F.lit(0))), F.lit("")).alias("rating"),
            F.coalesce(text(F.get(x["p"], F.lit(1))), F.lit("")).alias("text"),
            F.coalesce(F.get(y["w"], F.lit(0)), F.lit("")).alias("price_paid"),
            F.coalesce(F.get(y["w"], F.lit(1)), F.lit("")).alias("currency"))))


def _card_complete(card: Column) -> Column:
    return F.exists(ni.positions(Find(tag="span")), lambda p: ni.lies_in(p, card))


def _reviews(page: Page, of_items: Column) -> Column:
    """What is read from the reviews of a page, null where its gate says that there are none."""
    rules = page.site.reviews
    if rules.gate is None:
        return of_items
    gate = _cut(page.select((rules.gate,)))
    return F.when(F.coalesce(tx.digit_sum(gate), F.lit(0)) > 0, of_items)


def _review_items(page: Page) -> Column:
    return ni.inside(page.select((page.site.reviews.container,)), page.site.reviews.item)


def incomplete_review(page: Page) -> Column:
    """Whether a part is missing of some review of a page. No review is worked out for that, so tables of other records
    don't need any."""
    complete = {"table_row": _table_row_complete, "card": _card_complete}[page.site.reviews.layout]
    return _reviews(page, F.exists(_review_items(page), lambda item: ~complete(item)))


def review_structs(page: Page) -> Column:
    """All reviews of a page in order (B23, B24), with the vendor of the page."""
    site, rules = page.site, page.site.reviews
    owner = F.col(site.owner[0])[site.owner[1]]
    shared = {"vendor": owner, "product": F.lit(None).cast("string"), "product_link": F.lit(None).cast("string")}
    shared |= _fields(page, rules.page_fields)
    for f in rules.page_fields:
        if f.name == "vendor":
            # Without the marker in front of the name, the vendor of the page is taken.
            shared["vendor"] = F.when(page.select(f.path[:1]).isNull(), owner).otherwise(shared["vendor"])
    build = {"table_row": _table_row_review, "card": _card_review}[rules.layout]
    return _reviews(page, nd.let(F.struct(*[v.alias(k) for k, v in shared.items()]), lambda p: F.filter(
        F.transform(_review_items(page), lambda item: build(site, p, item)), lambda r: r.isNotNull())))


def page_entities(site: Site) -> Column:
    """Entities a page holds, decided by the first route whose marker is there."""
    rule = None
    for route in site.routes:
        if route.id is not None:
            marker = F.size(ni.positions(Find(id=route.id))) > 0
        else:
            marker = _text().contains(route.text)
        marker = F.coalesce(marker, F.lit(False))
        value = F.array(*[F.lit(e) for e in route.entities])
        rule = F.when(marker, value) if rule is None else rule.when(marker, value)
    return rule.otherwise(F.array().cast("array<string>"))


def route_pages(shredded: DataFrame, site: Site) -> DataFrame:
    """B18. The pages must be shredded with the keys of the site."""
    return shredded.withColumn("entities", page_entities(site))


def valid_page(site: Site) -> Column:
    """Pages that only say that nothing was found are not valid."""
    return F.lit(True) if site.invalid_text is None else ~_text().contains(site.invalid_text)


def extract_pages(pages: DataFrame, site: Site) -> DataFrame:
    """One row per page: its entities, its records, and why it is rejected if it is.

    ``pages`` needs ``page_id`` and ``html``; other columns are kept. This is the map-only core of
    the extraction; the tables of :func:`split_records` are projections of it.
    """
    keep = [c for c in pages.columns if c != "html"]
    page = Page(site)
    routed = route_pages(shred(pages, index=site_keys(site), nodes="found", onward=onward_keys(page.names), fields=site_fields(site)), site).withColumn("entities", F.when(
        F.col("problem").isNull() & valid_page(site), F.col("entities"))).withColumns(
        {f"_has_{entity}": F.array_contains("entities", entity) for entity in schemas.RECORDS})
    groups = {name: F.when(holds("product"), struct) for name, struct in _group_structs(page, site.product).items()}
    staged = page.stage(routed)
    built = (staged.withColumns(groups) if groups else staged).withColumns({
        "product": F.when(holds("product"), product_struct(page)),
        "vendor": F.when(holds("vendor"), vendor_struct(page)),
    }).withColumn("reviews", F.when(holds("review"), review_structs(page)))

    def checked(entity: str, checks: list[Column]) -> Column:
        return F.when(holds(entity), F.coalesce(*checks)) if checks else F.lit(None).cast("string")

    incomplete = F.when(incomplete_review(page), "review is incomplete")
    problem = F.coalesce(
        F.col("problem"),
        F.when(~valid_page(site), "page is not valid for extraction"),
        checked("product", _problems(page, site.product, "product")),
        checked("vendor", _problems(page, site.vendor, "vendor")),
        checked("review", [*_problems(page, site.reviews.page_fields, "review"), incomplete]),
    )
    # Where only some records are read, Spark would move the test for problems to the shredded pages and work out all that
    # it depends on a second time; it doesn't do so with what depends on the partition, which is always there.
    once = F.when(F.spark_partition_id() >= 0, problem)
    return built.select(*keep, "entities", once.alias("problem"), "product", "vendor", "reviews")


def split_records(extracted: DataFrame, key: Sequence[str] = ("page_id",)) -> dict[str, DataFrame]:
    """The output tables of an extraction (B27): records, processed pages and rejects (A10)."""
    good = extracted.filter("problem is null")
    key = list(key)
    # The logs also name the file, where the pages came from files.
    log = [*key, *(["path"] if "path" in extracted.columns and "path" not in key else [])]
    review = good.select(*key, F.posexplode("reviews").alias("review_no", "r")).select(
        *key, "review_no", *[F.col(f"r.{n}").alias(n) for n in schemas.REVIEW.fieldNames()])
    return {
        "product": good.filter("product is not null").select(*key, "product.*"),
        "vendor": good.filter("vendor is not null").select(*key, "vendor.*"),
        "review": review,
        "processed": good.select(*log, "entities"),
        "rejects": extracted.filter("problem is not null").select(*log, F.col("problem").alias("reason")),
    }


def extract_all(pages: DataFrame, site: Site) -> dict[str, DataFrame]:
    """Lazy extraction of all pages. To run it once for all outputs, use :func:`run_extraction`."""
    return split_records(extract_pages(pages, site))


def run_extraction(pages: DataFrame, site: Site, path: str, mode: str = "overwrite") -> dict[str, DataFrame]:
    """Extract each page once into ``path/extracted``, then derive the record tables from it."""
    spark = pages.sparkSession
    extract_pages(pages, site).write.mode(mode).parquet(os.path.join(path, "extracted"))
    return split_records(spark.read.parquet(os.path.join(path, "extracted")))


def with_original_url(pages: DataFrame, originals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """URL of each stored page by its hash, a default when unknown, and the unknown pages.

    A lookup table that adaptive execution measures as small is broadcast. With a large one the pages are shuffled, so
    pass only the columns that are needed, not the page bodies.
    """
    joined = pages.join(originals, "url_hash", "left")
    missing = joined.filter("original is null").select("page_id", F.lit("no original URL").alias("reason"))
    return joined.withColumn("original", F.coalesce("original", F.lit("url-not-saved"))), missing


def attach_page_vendor(reviews: DataFrame, owners: DataFrame, key: str = "page_id") -> DataFrame:
    """Vendor of the page for reviews that carry none, for tables extracted separately."""
    dim = owners.select(key, F.col("vendor").alias("_owner"))
    return reviews.join(dim, key, "left").withColumn(
        "vendor", F.coalesce("vendor", "_owner")).drop("_owner")
