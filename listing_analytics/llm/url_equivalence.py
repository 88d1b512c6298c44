"""URL filters with redirect equivalence.

URLs that redirect to each other or name each other as canonical are aliases. A block rule that fits one alias blocks
all of them; an explicit allow rule on any alias goes first; a URL's own rule goes before both. Aliases are the connected
components of the link edges, found by Spark rounds over the edges (``components``).
"""

from __future__ import annotations

import html as html_text
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics.llm.common import prepare, store, table
from listing_analytics.llm.components import components
from listing_analytics.llm.registry import query

# (verdict, host, path prefix)
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def own_rule(host_col: Column, path_col: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as struct (rule, verdict); null if none does. Of equal lengths an allow goes first."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow", r[1], r[2]))
    kind = "struct<rule:string,verdict:string>"
    chosen = F.lit(None).cast(kind)
    for verdict, name, prefix in reversed(ordered):
        fits = ((host_col == name) | F.endswith(host_col, F.lit("." + name))) & F.startswith(path_col, F.lit(prefix))
        chosen = F.when(fits, F.struct(F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def canonical_key(url: Column) -> Column:
    """What a URL is known by: scheme, fragment, tracking parameters, a final slash and the default port don't count."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    query_part = F.regexp_extract(plain, r"\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query_part, "&"), lambda p: (p != "") & ~F.startswith(p, F.lit("utm_"))), "&")
    bare = F.regexp_replace(F.concat(F.regexp_replace(host(url), ":(80|443)$", ""), path(url)), "/+$", "")
    return F.when(F.contains(url, F.lit("://")), F.concat(bare, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


_URL = re.compile(r"(?s)(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?")
_ATTRIBUTE = re.compile(r"""(?s)([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_REFRESH = re.compile(r"""(?is)\s*[\d.]*\s*[;,]?\s*(?:url\s*=\s*)?(?:"([^"]*)|'([^']*)|(.*))""")


def _without_dots(path: str) -> str:
    """RFC 3986, 5.2.4."""
    out: list[str] = []
    parts = path.split("/")
    for number, part in enumerate(parts):
        if part in (".", ".."):
            if part == ".." and len(out) > (path[:1] == "/"):
                out.pop()
            if number == len(parts) - 1:
                out.append("")
        else:
            out.append(part)
    return "/".join(out)


def resolve(base: str, reference: str) -> str | None:
    """The URL that a reference on a page names (RFC 3986, 5.2); null if it is none with a host.

    A reference with the base's own scheme and no host counts as relative, as in browsers.
    """
    scheme, has_host, rest = base.strip().partition("://")
    authority, path, search = re.match(r"(?s)([^/?#]*)([^?#]*)(?:\?([^#]*))?", rest).groups()
    to_scheme, to_authority, to_path, to_search, to_fragment = _URL.match(reference).groups()
    if to_scheme is not None and to_authority is None and to_scheme.lower() == scheme.lower():
        to_scheme = None
    if to_scheme is not None and to_authority is None or to_scheme is None and not has_host:
        return None
    if to_authority is not None:
        scheme, authority, path, search = to_scheme or scheme, to_authority, _without_dots(to_path), to_search
    elif to_path:
        path = _without_dots(to_path if to_path[0] == "/" else (path[:path.rfind("/") + 1] or "/") + to_path)
        search = to_search
    elif to_search is not None:
        search = to_search
    return (f"{scheme}://{authority}{path}" + ("" if search is None else f"?{search}")
            + ("" if to_fragment is None else f"#{to_fragment}"))


def _attributes(tag: str) -> dict[str, str]:
    """Attributes of a tag, entities decoded; of repeated names the first counts."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(tag, 5):
        found.setdefault(name.lower(), re.sub(r"[\t\n\r]", "", html_text.unescape("".join(values))).strip())
    return found


def targets(url: str, tags: list[str]) -> list[str]:
    """Targets of the canonical links and refreshes among a page's link, meta and base tags."""
    base, named = None, []
    for tag in tags:
        has = _attributes(tag)
        kind = tag[1:5].lower()
        if kind == "base":
            base = has.get("href") if base is None else base
        elif kind == "link" and "canonical" in has.get("rel", "").lower().split():
            named.append(has.get("href", ""))
        elif kind == "meta" and has.get("http-equiv", "").lower() == "refresh":
            named.append("".join(v or "" for v in _REFRESH.match(has.get("content", "")).groups()).strip())
    start = resolve(url, base) or url if base else url
    return [t for t in (resolve(start, n) for n in named if n) if t]


def _targets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = [(url, to) for url, tags in zip(*(c.to_pylist() for c in batch.columns)) for to in targets(url, tags)]
        yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.string()) for k in (0, 1)], ["source", "target"])


def declared_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target) URLs of canonical links and of refreshes in the pages.

    Targets are resolved against the page's URL or its first base tag after decoding entities. Only the tags of pages
    that may declare a link leave Spark.
    """
    prepare(pages.sparkSession)
    html = F.coalesce(F.col(html_col), F.lit(""))
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta|base)\b[^>]*>"), F.lit(0))
    # Letters of the two words may themselves be entities.
    useful = lambda t: F.rlike(t, F.lit(r"(?is)canonical|refresh|&"))
    found = pages.select(F.col(url_col).alias("source"), tags.alias("tags")).filter(F.col("source").isNotNull() & F.exists("tags", useful))
    return found.mapInArrow(_targets, "source string, target string")


def judge(pages: DataFrame, links: DataFrame | None = None, rules: list[tuple[str, str, str]] = RULES,
          default: str = "allow", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A verdict for every row: its own rule's, else its aliases', else ``default``.

    ``links`` has further edges (source, target), such as a redirect log; canonical and refresh links in the pages are
    always used. Returns page_id, host, path, rule (null if none fits), verdict, key, alias_of (least key of the
    component). Aliases need not be pages themselves: rules are also matched on URLs that only occur in links. A null
    URL or one without ``://`` has an empty host and path and no aliases. Repeated rows get the same verdict each; an
    empty table gives an empty result. Only the three named columns are read, so others cannot clash with the result's.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host(url).alias("host"), path(url).alias("path"),
                        canonical_key(url).alias("key"))
    edges = declared_links(pages, url_col, html_col)
    if links is not None:
        edges = edges.union(links.select("source", "target"))
    edges, _ = store(edges.distinct(), "links")
    ends = edges.select(F.explode(F.array("source", "target")).alias("url"))
    said = (rows.select("url", "key").union(ends.select("url", canonical_key(F.col("url")).alias("key")))
            .filter("key is not null").withColumn("own", own_rule(host(F.col("url")), path(F.col("url")), rules))
            .groupBy("key").agg(F.max(F.col("own.verdict") == "allow").alias("allows"), F.max(F.col("own.verdict") == "block").alias("blocks")))
    roots = components(edges.select(canonical_key(F.col("source")).alias("a"), canonical_key(F.col("target")).alias("b")))
    rooted = said.join(roots, said["key"] == roots["node"], "left").withColumn("alias_of", F.coalesce("root", "key"))
    decided = rooted.groupBy("alias_of").agg(F.max("allows").alias("allows"), F.max("blocks").alias("blocks")).select(
        "alias_of", F.when(F.col("allows"), "allow").when(F.col("blocks"), "block").alias("theirs")).filter("theirs is not null")
    by_key = rooted.select("key", "alias_of").join(decided, "alias_of", "left").select("key", "alias_of", "theirs")
    own = own_rule(F.col("host"), F.col("path"), rules)
    return (rows.withColumn("_own", own).join(by_key, "key", "left")
            .select("page_id", "host", "path", F.col("_own.rule").alias("rule"),
                    F.coalesce("_own.verdict", "theirs", F.lit(default)).alias("verdict"), "key", "alias_of"))


def _host_sql(url: str) -> str:
    return f"coalesce(translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '')"


def _path_sql(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '')"


def _key_sql(url: str) -> str:
    parts = f"string_split(regexp_extract(regexp_replace(trim({url}), '#.*$', ''), '\\?(.*)$', 1), '&')"
    kept = f"array_to_string(list_filter({parts}, lambda x: x <> '' and not starts_with(x, 'utm_')), '&')"
    return (f"case when contains({url}, '://') then regexp_replace(regexp_replace({_host_sql(url)}, ':(80|443)$', '') || "
            f"{_path_sql(url)}, '/+$', '') || case when {kept} <> '' then '?' || {kept} else '' end end")


def _rule_sql(url: str, rules: list[tuple[str, str, str]], verdict: bool) -> str:
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow", r[1], r[2]))
    whens = " ".join(
        f"when ({_host_sql(url)} = '{name}' or ends_with({_host_sql(url)}, '.{name}')) and starts_with({_path_sql(url)}, '{prefix}') "
        f"then '{kind if verdict else name + prefix}'" for kind, name, prefix in ordered)
    return f"case {whens} end"


SQL = f"""
with recursive tag as (
  select url as source, unnest(regexp_extract_all(coalesce(html, ''), '(?is)<(?:link|meta)\\b[^>]*>')) as tag from pages),
aim as (
  select source, trim(coalesce(nullif(regexp_extract(tag, '(?is)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1), ''),
                               regexp_extract(tag, '(?is)\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1))) as aim,
         regexp_extract(source, '^(.*?://)', 1) as scheme
  from tag where regexp_matches(tag, '(?is)rel\\s*=\\s*["'']?[^"''>]*\\bcanonical\\b|http-equiv\\s*=\\s*["'']?refresh')),
link as (
  select source, case when contains(aim, '://') then aim when starts_with(aim, '//') then regexp_replace(scheme, '//$', '') || aim
                      when starts_with(aim, '/') then scheme || {_host_sql('source')} || aim end as target from aim),
known as (
  select url from pages union all select source from link where target is not null
  union all select target from link where target is not null),
said as (
  select key, coalesce(bool_or(verdict = 'allow'), false) as allows, coalesce(bool_or(verdict = 'block'), false) as blocks
  from (select {_key_sql('url')} as key, {_rule_sql('url', RULES, True)} as verdict from known) where key is not null group by 1),
edge as (
  select {_key_sql('source')} as a, {_key_sql('target')} as b from link where target is not null),
reach as (
  select key, key as other from said
  union select reach.key, e.b from reach join (select a, b from edge union select b, a from edge) e on reach.other = e.a
  where e.b is not null),
root as (select key, min(other) as alias_of from reach group by 1),
theirs as (
  select alias_of, bool_or(allows) as allows, bool_or(blocks) as blocks from root join said using (key) group by 1)
select page_id, p.host, p.path, p.rule,
       coalesce(p.verdict, case when t.allows then 'allow' when t.blocks then 'block' end, 'allow') as verdict, p.key, r.alias_of
from (select page_id, {_host_sql('url')} as host, {_path_sql('url')} as path, {_key_sql('url')} as key,
             {_rule_sql('url', RULES, False)} as rule, {_rule_sql('url', RULES, True)} as verdict from pages) p
left join root r on r.key = p.key left join theirs t on t.alias_of = r.alias_of"""


@query("op7_url_filter", SQL)
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page."""
    return judge(table(spark, sf_dir, "pages"))
