import hashlib
import random
from collections import deque
from urllib.parse import urljoin

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from listing_analytics.functions.urls import authority, resolve_links, url_key
from listing_analytics.operators import links as lk
from listing_analytics.operators.order import in_order
from listing_analytics.operators.shred import shred
from listing_analytics.operators.visited import VisitedRuns

PAGE = "http://h.test/a/b.html"


def edges_of(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return lk.edges(lk.link_records(lk.internal_links(lk.resolved_links(shred(df))), ["page_id"]))


def test_internal_links(spark):
    html = "".join(f'<a href="{h}">x</a>' for h in ["c", "/d/", "#x", "/d", "http://o.test/", "mailto:q@h.test", "http://h.test:81/q"])
    found = edges_of(spark, [(1, PAGE, "<a name='n'>no target</a>" + html)]).collect()
    assert [r.dst_url for r in found] == [PAGE, "http://h.test/a/c", "http://h.test/d", "http://h.test/a/b.html#x"]


def test_first_record_wins_and_pages_without_links_stay(spark):
    rows = edges_of(spark, [(2, PAGE, "<a href='late'>x</a>"), (1, PAGE, "<a href='early'>x</a>"), (3, "http://h.test/z", "none")]).collect()
    assert {(r.src_url, r.dst_url) for r in rows} == {(PAGE, "http://h.test/a/early"), ("http://h.test/z", None)}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab./?#:=;%é ", max_size=12), min_size=40, max_size=40))
def test_resolution_is_urljoin(spark, hrefs):
    df = spark.createDataFrame([(PAGE, hrefs)], "url string, hrefs array<string>")

    def join(h):
        try:
            return urljoin(PAGE, h).strip("/")
        except ValueError:
            return None

    assert df.select(resolve_links("url", "hrefs").alias("r")).first().r == [join(h) for h in hrefs]


def test_authority(spark):
    urls = ["http://h.test:81/q?x", "https://ü.test", "mailto:a@b", "/path", "http://u@h/|[ ]"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, u string")
    assert [r.a for r in df.select("i", authority(F.col("u")).alias("a")).orderBy("i").collect()] == [
        "h.test:81", "ü.test", "", "", "u@h"]


def plain_queue(links, seeds, visited=()):
    """First seen, first served: (level, position) of every page."""
    out, queue = {}, deque((s, 0) for s in dict.fromkeys(seeds) if s not in visited)
    queued = {s for s, _ in queue}
    while queue:
        page, level = queue.popleft()
        out[page] = (level, len(out))
        for target in (d for _, d in sorted((o, d) for s, d, o in links if s == page and d is not None)):
            if target not in queued and target not in visited:
                queued.add(target)
                queue.append((target, level + 1))
    return out


@pytest.mark.parametrize("seed, pages, degree", [(1, 40, 2), (2, 200, 3), (3, 300, 1)])
def test_queue_order_against_a_queue(spark, seed, pages, degree):
    rng = random.Random(seed)
    key = lambda i: hashlib.md5(str(i).encode()).hexdigest()
    links = [(key(p), key(rng.randrange(pages)), i) for p in range(pages) for i in range(rng.randint(0, 2 * degree))]
    links += [(key(0), key(p), 100 + p) for p in range(5)] + [(key(3), None, 1), (None, key(3), 1)] + links[:20]
    seeds, known = [key(7), key(0), key(7)], {key(1), key(2)}
    df = spark.createDataFrame(links, "src_hash string, dst_hash string, ord int")
    start = spark.createDataFrame(list(zip(seeds, range(3))), "url_hash string, n int")
    visited = spark.createDataFrame([(k,) for k in known] + [(None,)], "url_hash string")
    for earlier, gone in ((None, ()), (visited, known)):
        got = lk.hop_levels(df, start, order="ord", seed_order="n", visited=earlier)
        wanted = plain_queue([x for x in links if x[0]], seeds, gone)
        assert {r.url_hash: (r.level, r.position) for r in got.collect()} == wanted
        assert {r.url_hash for r in lk.budget(got, 10).collect()} == {k for k, (_, at) in wanted.items() if at < 10}


def test_search_leaves_no_tables_and_no_pages_without_seeds(spark):
    links = spark.createDataFrame([("a", "b")], "src_hash string, dst_hash string")
    none = spark.createDataFrame([(None,)], "url_hash string")
    assert lk.hop_levels(links, none).collect() == []
    with pytest.raises(ValueError):
        lk.hop_levels(links, spark.createDataFrame([("a",)], "url_hash string"), max_hops=0)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(("run_", "edges_"))]


def test_candidates_meet_visited_pages_without_a_shuffle_of_those(spark):
    with VisitedRuns(spark, fanout=3) as runs:
        for i in range(11):
            runs.add(spark.range(i * 10, i * 10 + 10).selectExpr("cast(id as string) as url_hash"))
        assert [len(level) for level in runs.levels] == [2, 0, 1]
        new = spark.range(95, 130).selectExpr("cast(id as string) as url_hash").groupBy("url_hash").agg(F.min("url_hash").alias("n"))
        left = runs.missing(new, "n")
        plan = left._jdf.queryExecution().executedPlan().toString()
        # Each join has one run below it; the only exchange is the one of the candidates, which are combined before it.
        assert plan.count("LeftAnti") == 3 and plan.count("Exchange hashpartitioning") == 1 and "Broadcast" not in plan
        assert plan.rindex("LeftAnti") < plan.index("Aggregate") < plan.index("Exchange") < plan.rindex("Aggregate")
        assert sorted(int(r.url_hash) for r in left.collect()) == list(range(110, 130))
        runs.release()
        assert len(runs.made) == 3


def test_places_in_order(spark):
    rows = [(random.Random(i).randrange(50), i) for i in range(500)]
    got = in_order(spark.createDataFrame(rows, "a int, b int").repartition(7), "a", F.desc("b"), start=5).collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == sorted(rows, key=lambda r: (r[0], -r[1]))
    assert sorted(r.position for r in got) == list(range(5, 505))
    assert in_order(spark.createDataFrame([], "a int"), "a").collect() == []


def test_queue(spark):
    links = spark.createDataFrame([("a", "a", "b", "ub", 5), ("a", "a", "c", "uc", 2), ("d", "d", "b", "ub", 1), ("d", "d", None, None, 1)],
                                  "src_hash string, src_url string, dst_hash string, dst_url string, seen int")
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "url_hash string")
    empty = one("zz")
    waiting = lk.frontier(links, empty, empty, "seen")
    assert {tuple(r) for r in waiting.collect()} == {("b", "ub", 1, 0), ("c", "uc", 2, 0)}
    assert [r.url_hash for r in lk.frontier(links, one("b"), empty, "seen").collect()] == ["c"]
    assert [r.url_hash for r in lk.frontier(links, empty, one("c"), "seen").collect()] == ["b"]
    again = lk.requeue(waiting.filter("url_hash = 'c'"), waiting.filter("url_hash = 'b'"))
    assert [r.url_hash for r in again.orderBy("queue_round", "queue_ord").collect()] == ["c", "b"]
    levels = spark.createDataFrame([("x", 1, 2), ("y", 0, 0), ("w", 1, 1)], "url_hash string, level int, position long")
    assert {r.url_hash for r in lk.budget(levels, 2).collect()} == {"y", "w"}


def test_content_types(spark):
    df = spark.createDataFrame([("text/html; charset=x",), ("image/jpg",), ("image/png",), ("text/css",)], "content_type string")
    assert [(r.extension, r.has_links) for r in lk.by_content_type(df).collect()] == [(".html", True), (".jpeg", False), (".png", False)]


def test_url_key(spark):
    assert spark.range(1).select(url_key(F.lit("http://ü")).alias("k")).first().k == hashlib.md5("http://ü".encode()).hexdigest()


def test_hops_have_no_bound_of_their_own(spark):
    chain = spark.range(90).selectExpr("cast(id as string) as src_hash", "cast(id + 1 as string) as dst_hash")
    seed = spark.createDataFrame([("0",)], "url_hash string")
    got = {r.url_hash: r.level for r in lk.hop_levels(chain.filter("cast(src_hash as int) < 70"), seed).collect()}
    assert got == {str(i): i for i in range(71)}
    assert lk.hop_levels(chain.limit(3), seed, max_hops=3).count() == 4
    with pytest.raises(ValueError):
        lk.hop_levels(chain, seed, max_hops=3)
