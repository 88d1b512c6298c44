import random

import pytest
from pyspark.sql import functions as F

from listing_analytics.operators import extract as ex
from listing_analytics.operators import node_index as ni
from listing_analytics.operators import nodes as nd
from listing_analytics.operators.shred import node_table, shred
from listing_analytics.rules.model import Find
from listing_analytics.rules.site_n import site_n
from listing_analytics.rules.site_w import site_w
from listing_analytics.session import store

# Class names, styles, ids and labels of both page layouts, as in the rules.
W_PRODUCT = """<html><head><script>var a = "</p><p>x";</script><style>p{}</style></head><body>
<p id="desc_prod">General <a href="/v/mia"> mia </a></p>
<div class="big tabcontent"><h3> Blue lamp </h3></div><div class="bigimage"><img src="lamp.png"></div>
<div>4 sold since May</div><p class="padp" style="margin-bottom: 10px;"><span>CAD $12.50</span></p>
<p style="word-wrap: break-word; white-space: pre-wrap;"> warm &amp; bright </p>
<table><tr><td>Product Class</td><td>Home</td></tr><tr><td>Ships to</td><td>Canada</td></tr>
<tr><td>Origin Country</td><td>France</td></tr></table><p>Sold by <a href="/v/mia">mia</a></p>
<p class="boldstats"> 12 feedbacks </p><div class="listDes"><h2> Blue lamp </h2></div><a href="lamp?tab=1">Description</a>
<table class="user_feedbackTbl autoshop_table"><tr><th>Text</th></tr>
<tr><td><img src="files/feedback1.png"><p> good </p><p>lamp</p><p> ed  CAD 12.50 </p><p> 1 May </p></td></tr>
<tr><td><img src="files/feedback9.png"><p>bad</p><p>lamp</p><p>al CAD 13</p><p>2 May</p></td></tr>
<tr><td><p>meh</p><p>lamp</p><p>bo CAD 14</p><p>3 May</p></td></tr></table></body></html>"""
W_FALLBACK = """<p id="desc_prod">x</p><h2 style="margin:0px;"> Spare name </h2>
<table><tr><td>Product Class</td><td>Home</td></tr><tr><td>Ships to</td><td>Canada</td></tr></table><p class="boldstats">0 of 0</p>"""
W_VENDOR = """<h1>Vendor Profile</h1><h3 class="user_info_mid_head">mia (gold)</h3><div class="user_info"><b><img src="m.png"></b></div>
<h3>About</h3><p> sells lamps <b>only</b></p><h3>PGP</h3> <pre> KEY </pre><p class="boldstats">has 17 feedbacks 3</p>"""
N_PRODUCT = """<h1 class="text-2xl x"> Red chair </h1><a class="hover:text-base-500 duration-[750ms]">Home</a>
<a class="hover:text-base-500  duration-[750ms]"> Seats </a><a class="image-box" href="c.png"></a>
<dd class="order-first text-sm font-semibold tracking-tight text-green-500"> 40.5 <span> USD </span></dd>
<div id="description-data"><p> soft </p></div><h1 class="font-semibold text-center text-xl text-lime-500"> leo </h1>Add to Cart"""
N_VENDOR = """<h2 class="text-lg">leo</h2><div id="about-data"><p>Sales and Reviews</p></div>Public key<code>a</code><code> K </code>
<div><dt>Sales</dt><dd>7</dd><dt>Historical Sales</dt><dd>9</dd><dt>Reviews</dt><dd> 3 | 44 </dd></div>
<div class="text-xs text-gray-400/80 hover:text-gray-400 font-semibold">4 <span>of 5</span></div>
<div class="px-4 text-gray-700"><h3> Old </h3><span> 10 </span><span> 90% </span></div>
<div class="px-4 text-gray-700"><h3>One</h3><span>1</span></div>
<div class="px-4 text-gray-700"><h3>Old</h3><span>11</span><span>91%</span></div>
<div id="reviews-data"><div class="p-4 flex flex-col h-full"><span> May </span><a href="/p/1"> Red chair </a><p> 5 stars </p><p> nice </p>
<span> 40 USD </span></div><div class="p-4 flex flex-col h-full"><span>June</span><p>1 star</p></div></div>"""
N_MISSING = "<p>Sorry, the page you are looking for could not be found.</p>Add to Cart"
NEITHER = "<p>hello</p>"


def table(spark, pages):
    return spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")


@pytest.fixture(scope="module")
def w(spark):
    broken = W_PRODUCT.replace("<p> 1 May </p>", "")
    tables = ex.extract_all(table(spark, [W_PRODUCT, W_FALLBACK, W_VENDOR, NEITHER, broken, None]), site_w())
    return {k: [r.asDict() for r in v.collect()] for k, v in tables.items()}


@pytest.fixture(scope="module")
def n(spark):
    tables = ex.extract_all(table(spark, [N_PRODUCT, N_VENDOR, N_MISSING, NEITHER, "Add to Cart"]), site_n())
    return {k: [r.asDict(recursive=True) for r in v.collect()] for k, v in tables.items()}


def test_w_product(w):
    assert w["product"][0] == dict(
        page_id=0, name="Blue lamp", category="Home", picture="lamp.png", sold_since=" May", sold_count="4 ", price="12.50",
        currency="CAD ", description="warm & bright", shipped_from="France", shipped_to="Canada", vendor="mia", marketplace="site-w")
    spare = w["product"][1]
    assert (spare["name"], spare["category"], spare["shipped_to"], spare["vendor"]) == ("Spare name", "", "", "")


def test_w_reviews(w):
    assert [(r["review_no"], r["vendor"], r["product"], r["author"], r["rating"], r["text"], r["price_paid"], r["currency"], r["datetime"])
            for r in w["review"]] == [
        (0, "mia", "Blue lamp", "ed", "positive", "good", "12.50", "CAD", "1 May"),
        (1, "mia", "Blue lamp", "al", "negative", "bad", "13", "CAD", "2 May"),
        (2, "mia", "Blue lamp", "bo", "", "meh", "14", "CAD", "3 May")]
    assert w["review"][0]["product_link"] == "http://site-w.example/lamp?tab=1"


def test_w_vendor(w):
    (v,) = w["vendor"]
    assert (v["name"], v["about_text"], v["profile_picture"], v["pgp_key"], v["review_count"], v["rating"]) == (
        "mia", "sells lamps only", "m.png", "KEY", "17", "")


def test_w_logs(w):
    assert {r["page_id"] for r in w["processed"]} == {0, 1, 2, 3}
    assert {r["page_id"]: r["reason"] for r in w["rejects"]} == {4: "review is incomplete", 5: "page is not valid text"}


def test_swapped_shipping(spark):
    (r,) = ex.extract_all(table(spark, [W_PRODUCT]), site_w(swap_shipping=True))["product"].collect()
    assert (r.shipped_from, r.shipped_to) == ("Canada", "France")


def test_n_product(n):
    assert n["product"] == [dict(
        page_id=0, name="Red chair", category="Home Seats ", picture="c.png", sold_since="not-on-nexus", sold_count="not-on-nexus",
        price="40.5", currency="USD", description="soft", shipped_from="not-on-nexus", shipped_to="not-on-nexus", vendor="leo",
        marketplace="site-n")]


def test_n_vendor(n):
    (v,) = n["vendor"]
    assert (v["name"], v["about_text"], v["profile_picture"], v["pgp_key"], v["wallet_address"]) == (
        "leo", "Sales and Reviews", "NA", " K ", "NA")
    assert (v["sale_count"], v["historic_sale_count"], v["review_count"], v["rating"]) == ("7", "9", "3 | 44", "0.8")
    assert v["marketplace_history"] == {"Old": {"sales": "11", "rating": "91%"}}


def test_n_reviews(n):
    assert [(r["vendor"], r["product"], r["product_link"], r["datetime"], r["rating"], r["text"], r["price_paid"], r["currency"])
            for r in n["review"]] == [
        ("leo", "Red chair", "/p/1", "May", "5 stars", "nice", "40", "USD"), ("leo", "", "", "June", "1 star", "", "June", "")]


def test_n_logs(n):
    assert {r["page_id"] for r in n["processed"]} == {0, 1, 3}
    assert {r["page_id"]: r["reason"] for r in n["rejects"]} == {
        2: "page is not valid for extraction", 4: "product.name is missing"}


def test_shredder_recovers(spark):
    html = "<div><p>one<b>two</div>three</i><br>four<p/>five&amp;amp;<!-- no --><p>six"
    rows = node_table(shred(table(spark, [html]))).orderBy("pre").collect()
    assert [(r.tag, r.level) for r in rows if not r.tag.startswith("#")] == [
        ("div", 1), ("p", 2), ("b", 3), ("br", 1), ("p", 1), ("p", 1)]
    assert rows[0].full_text == "onetwothreefourfive&amp;six"
    for a in rows:  # pre/post numbers are those of a tree
        for b in rows:
            assert (b.pre > a.pre and b.post < a.post) == (a.start <= b.start and b.end <= a.end and b.level > a.level
                                                            and b.pre > a.pre and b.post < a.post)
    assert sorted(r.post for r in rows) == list(range(len(rows)))
    by_pre = {r.pre: r for r in rows}
    for r in rows[1:]:
        parent = by_pre[r.parent]
        assert parent.pre < r.pre and parent.post > r.post and parent.level == r.level - 1


def test_only_string_of_an_element(spark):
    html = "<div><span>Sales</span></div><p>a<b>c</b></p><i><!--x--></i><u></u><em> <b>y</b></em>"
    rows = {r.tag: r.string for r in node_table(shred(table(spark, [html]))).collect()}
    assert (rows["div"], rows["span"], rows["p"], rows["i"], rows["u"], rows["em"]) == ("Sales", "Sales", None, "x", None, None)


def test_failed_page_leaves_no_nodes(spark, monkeypatch):
    from listing_analytics.operators import shred as module
    feed = module._Shredder.feed

    def fail(self, html):
        feed(self, html)
        if "boom" in html:
            raise ValueError("boom")

    monkeypatch.setattr(module._Shredder, "feed", fail)
    texts, nodes, problems, _ = module._shred_slice(["<p a=1>x</p>", "<p b=2>boom</p>", "<i c=3>y</i>"])
    assert texts == ["x", None, "y"] and problems[1] == "page cannot be parsed: boom"
    assert [len(n) for n in nodes.to_pylist()] == [3, 0, 3]
    assert [n["attrs"] for n in nodes.to_pylist()[2]] == [[], [("c", "3")], []]


def test_selection(spark):
    html = '<ul id="m"><li class="a  b">1</li><li class="b">2<i>x</i></li></ul><p style="s">3</p>'
    finds = [Find(tag="li", cls="b"), Find(cls="a b"), Find(tag="li"), Find(style="s"), Find(id="m"), Find(tag="li", string="1"),
             Find(like="[23]"), Find(contains="3"), Find()]
    pages = shred(table(spark, [html, None]), index=[ni.key_of(f) for f in finds])
    found = lambda find, first=False: [r.full_text for r in ex.select_nodes(pages, find, first).orderBy("pre").collect()]
    assert found(Find(tag="li", cls="b")) == ["1", "2x"] and found(Find(cls="a b")) == ["1"]
    assert found(Find(tag="li"), True) == ["1"] and found(Find(style="s")) == ["3"] and found(Find(id="m")) == ["12x"]
    assert found(Find(tag="li", string="1")) == ["1"] and found(Find(like="[23]")) == ["2", "3"]
    assert found(Find(contains="3")) == ["3"] and found(Find()) == ["12x", "1", "2x", "x", "3"]
    nodes = F.col("nodes")
    second = F.get(nd.all_of(nodes, nd.tag_is("li")), F.lit(1))
    first_li = nd.first_of(nodes, nd.tag_is("li"))
    row = pages.filter("page_id = 0").select(
        nd.next_element(nodes, second)["tag"].alias("a"), nd.next_sibling(nodes, first_li)["attrs"]["class"].alias("b"),
        nd.next_sibling(nodes, second).isNull().alias("c"), nd.text_without(F.col("text"), second, nd.next_element(nodes, second)).alias("d"),
        nd.only_string(nd.next_element(nodes, second, nd.tag_is("p"))).alias("e")).first()
    assert tuple(row) == ("i", "b", True, "2", "3")


TESTS = {"tag": nd.tag_is, "cls": nd.has_class, "id": nd.has_id, "style": nd.has_style, "string": nd.string_is,
         "contains": nd.string_contains, "like": nd.text_matches}


def test_lookups_are_what_testing_all_nodes_finds(spark):
    """Every step over many pages, from every node: by the index and by a test of each node."""
    rng = random.Random(12)
    piece = lambda: rng.choice(["<p>", "</p>", '<p class="a b">', "<b class='b'>", "</b>", "<i id=x>", "<i style='s' class=a>", "</i>", "x", " y ",
                                "xy", "<br>", "<!-- x -->", "</u>"])
    pages = table(spark, ["".join(piece() for _ in range(rng.randint(0, 40))) for _ in range(60)])
    finds = [Find(tag="p"), Find(tag="p", cls="a"), Find(cls="b"), Find(cls="a b"), Find(tag="i", id="x"), Find(tag="i", style="s", cls="a"),
             Find(tag="b", string="x"), Find(contains="x"), Find(tag="p", contains="y"), Find(like="^x"), Find()]
    shredded = store(shred(pages, index=[ni.key_of(f) for f in finds]), "pages")
    nodes, wrong = F.col("nodes"), []
    for find in finds:
        given = {k: v for k, v in vars(find).items() if v is not None and k != "axis"}
        tests = [TESTS[k](v) for k, v in given.items()]
        # A text alone on a page is not an element of it.
        test = nd.every(lambda n: n["tag"] != "#document", *tests) if tests else nd.is_element
        at = lambda found: F.transform(found, lambda n: n["pre"])
        each = F.sequence(F.lit(0), F.size("nodes") - 1)
        pairs = [(ni.positions(find), at(nd.all_of(nodes, test))), (ni.first_position(find), nd.first_of(nodes, test)["pre"])]
        pairs += [(F.transform(each, lambda p: f(p)), F.transform(each, lambda p: g(ni.node_at(p)))) for f, g in (
            (lambda p: ni.first_inside(p, find), lambda n: nd.first_inside(nodes, n, test)["pre"]),
            (lambda p: ni.first_after(p, find), lambda n: nd.next_element(nodes, n, test)["pre"]))]
        wrong += shredded.filter(F.size("nodes") > 0).select("page_id", *[a.eqNullSafe(b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]).filter(
            "not (c0 and c1 and c2 and c3)").collect()
    elements = F.transform(F.filter(nodes, nd.is_element), lambda n: F.struct(n["next"], nd.next_sibling(nodes, n)["pre"].alias("b")))
    assert wrong == [] and shredded.filter(F.exists(elements, lambda e: ~e["next"].eqNullSafe(e["b"]))).count() == 0


def test_plain_pages_are_read_as_the_parser_reads_them(monkeypatch):
    """Pages of usual markup, odd markup and both, with and without the short way."""
    from listing_analytics.operators import shred as module
    rng = random.Random(5)
    usual = ["<p>", "</p>", '<A href="/x?a=1&amp;b=2&c" Title=\'q>"\'>', "</a >", "<br/>", "<hr />", "text &amp; &lt;more&gt; &eacute ", "\n ",
             "<script>var a = '<p></p>';</script>", "<STYLE>p{}</style>", "<!-- note -->", "<!DOCTYPE html>", "<title>A &amp; B</title>", "<x1>", "</x1>",
             '<img src="" alt="a">', "<template>t</template>"]
    odd = ["<p a>", "<p a=b>", "< b", "<!-- a -- b -->", "<!-->", "<script>'</ script>", "<script><!-- </script>", "<script>", "<?php x ?>", "<p a='1'b='2'>", "</p x>", "<a.b>",
           "<![CDATA[x]]>", "&", "&#65", "<", "</>", "<!x>", "<p / a='1'>", "<p a = 'b'>", "<script/>"]
    pages = ["".join(rng.choice(usual if rng.random() < 0.95 or i % 2 else odd) for _ in range(rng.randint(0, 25))) for i in range(3000)]
    pages += [W_PRODUCT, W_VENDOR, N_PRODUCT, N_VENDOR]
    plain = 0

    def rows(page):
        shredder = module._Shredder()
        return shredder.page(page), shredder.rows, shredder.keys, shredder.values, shredder.attr_ends

    short = [rows(p) for p in pages]
    feed = module._Shredder._feed_plain
    plain = sum(feed(s, p) for p in pages if (s := module._Shredder())._begin() is None)
    monkeypatch.setattr(module._Shredder, "_feed_plain", lambda self, html: False)
    assert [rows(p) for p in pages] == short and plain > 1500


def test_original_url_and_owner(spark):
    pages = spark.createDataFrame([(1, "h1"), (2, "h2")], "page_id long, url_hash string")
    known = spark.createDataFrame([("h1", "http://a")], "url_hash string, original string")
    joined, missing = ex.with_original_url(pages, known)
    assert {r.page_id: r.original for r in joined.collect()} == {1: "http://a", 2: "url-not-saved"}
    assert [tuple(r) for r in missing.collect()] == [(2, "no original URL")]


def test_run_extraction_writes_once(spark, tmp_path):
    out = ex.run_extraction(table(spark, [N_PRODUCT, N_VENDOR]), site_n(), str(tmp_path))
    assert {k: v.count() for k, v in out.items()} == {"product": 1, "vendor": 1, "review": 2, "processed": 2, "rejects": 0}
    assert "PythonMapInArrow" not in out["review"]._jdf.queryExecution().toString()


def test_extraction_does_not_shuffle(spark):
    plan = ex.extract_pages(table(spark, [N_PRODUCT]), site_n())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "MapInArrow" in plan


def test_unmatched_end_tags_take_linear_time():
    import time

    from listing_analytics.operators.shred import _Shredder
    start = time.process_time()
    _Shredder().page("<p>x" * 100_000 + "</x>" * 100_000)
    assert time.process_time() - start < 20


def test_slices_are_bounded_by_bytes(monkeypatch):
    import pyarrow as pa

    from listing_analytics.operators import shred as sh
    monkeypatch.setattr(sh, "_SLICE_BYTES", 10)
    assert list(sh._slices(pa.array(["aaaa", None, "b" * 30, "c", "d"]))) == [(0, 3), (3, 2)]
    assert list(sh._slices(pa.array([], pa.string()))) == []


def test_nodes_do_not_grow_with_depth():
    from listing_analytics.operators.shred import _Shredder
    stored = []
    for depth in (1, 200):
        shredder = _Shredder()
        shredder.page("<div>" * depth + "x" * 100_000 + "</div>" * depth)
        stored.append(sum(len(row[shredder.STRING] or "") for row in shredder.rows))
    assert stored == [100_000, 100_000]


def _nested(pick, depth=0):
    """A page whose elements nest, of random content."""
    out = ""
    for _ in range(pick.randrange(4)):
        if pick.random() < .45 or depth > 5:
            out += pick.choice([" ", "x", "&amp;", "\n", '<i id="m"/>', "<!--c-->", "Sales", "\xe9", "<br>", "&#1;", "Product Class", ">"])
            continue
        tag, attr = pick.choice(["p", "b", "td", "template", "script"]), pick.choice(["", ' class="a  b"', ' class="a"', ' style="s"', " id='m'"])
        inside = pick.choice(["", "x", '"<p>"', "<b>x</b>", "&#1;", "a<b"]) if tag == "script" else _nested(pick, depth + 1)
        out += f"<{tag}{attr}>{inside}</{tag}>"
    return out


def test_pages_read_together_are_as_those_read_alone():
    import random

    import pyarrow as pa
    from listing_analytics.operators import shred as sh
    from listing_analytics.operators import shred_slice as sl
    from listing_analytics.operators.node_index import Wanted
    pick = random.Random(3)
    pieces = ["<p>", "</p>", "<b class='a b'>", "</b>", "<br>", " ", "x", "&amp;", "\n", "<!--c-->", "<td>", "</td>", "Sales", "\xe9",
              "<script>", "</script>", "<template>", "</template>", ">", "<!DOCTYPE html>", "&#1;", "<p title='a>b'>", "</br>", "<p CLASS=x>"]
    pages = [W_PRODUCT, W_FALLBACK, W_VENDOR, N_PRODUCT, N_VENDOR, None, "", "a &lt; b", "<!DOCTYPE html>\n<p>x</p>", "a<!DOCTYPE html>b",
             '<script>a</script>b<script>"</scriptx>"</script>', "<u><i><!--z--></i></u>", '<a x="1" x="2">t</a>', "<style></style >"]
    pages += ["".join(pick.choice(pieces) for _ in range(pick.randrange(12))) for _ in range(1000)] + [_nested(pick) for _ in range(3000)]
    pick.shuffle(pages)
    html = pa.array(["before"] + pages, pa.string()).slice(1)
    keys = ["element:", "text:", "tag:p", "class:\na", "class:b\na b", "id:m", "style:s", "string:Product Class", "string:c", "contains:Sales", "contains:c"]
    for wanted in (None, keys):
        texts, nodes, problems, indexed = sh._shred_slice(pages, wanted and Wanted(wanted))
        tags = sl.Tags(sh._parse_tag, wanted and Wanted(wanted))
        found = sh._shred_pages(html, tags)
        assert found[0].to_pylist() == texts and found[1].to_pylist() == nodes.to_pylist() and found[2].to_pylist() == problems
        assert wanted is None or [dict(m) for m in found[3].to_pylist()] == indexed
    read = sl.shred_columns(html, tags, sh._RAW_END, sh._RAW_ODD, sh.HIDDEN)[0]
    assert len(read) > 0.6 * len(pages)  # most are read together
    usual = pa.array([W_PRODUCT, N_PRODUCT, N_VENDOR] * 5)
    assert len(sl.shred_columns(usual, tags, sh._RAW_END, sh._RAW_ODD, sh.HIDDEN)[0]) >= 10
    none = sh._shred_pages(pa.array([None, "<p>"], pa.string()), tags)
    assert none[2].to_pylist() == ["page is not valid text", None]


def test_exact_text_is_found_on_every_page(spark, sf_dir):
    from listing_analytics.plans import page_queries, roles
    found = page_queries.b7(spark, sf_dir)
    assert found.filter("found = 'Ships to'").count() == roles.listing(spark, sf_dir).count()
    assert found.filter("found = 'EUROPE'").count() == roles.listing(spark, sf_dir).filter("marketplace = 'EUROPE'").count()


def test_page_vendor_needs_no_pages_shuffled(spark, sf_dir):
    from listing_analytics.plans import page_queries, roles
    found = page_queries.b26(spark, sf_dir)
    assert "html" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 2 * roles.listing(spark, sf_dir).count()


def test_slices_that_cannot_be_read_together_are_not_tried_again_at_once(monkeypatch):
    import pyarrow as pa
    from listing_analytics.operators import shred as sh
    from listing_analytics.operators import shred_slice as sl
    tags, tried, read = sl.Tags(sh._parse_tag, None), [], sl.shred_columns
    monkeypatch.setattr(sl, "shred_columns", lambda *a: tried.append(1) or read(*a))
    for i in range(18):
        texts, nodes, problems, index = sh._shred_pages(pa.array(["<p>x", "<b>y"] if i < 16 else ["<p>x</p>", "<b>y</b>"]), tags)
        assert texts.to_pylist() == ["x", "y"] and problems.null_count == 2 and index is None and len(nodes) == 2
    assert len(tried) == 3  # the first, and those after 15 others


def test_pages_reduced_to_found_nodes(spark):
    """Rules read the same from the nodes that the index names as from whole pages; other nodes do not leave the pass."""
    pages = [
        '<div id="a"><p>x<b>Total</b></p><span>1</span></div><dl><dt>Sales</dt><dd>7</dd><dd>8</dd></dl><h3>About</h3><i>me</i>',
        '<div id="a"><p>x<span>2</span></div></b><h3>About</h3><p><dt>Sales</dt><dd>9', "<p>no</p>", "", None]
    label, about, box = Find(contains="Sales"), Find(tag="h3", string="About"), Find(tag="div", id="a")
    following, span = Find("next"), Find("inside", tag="span")
    paths = [(label, Find("sibling")), (label, Find("sibling"), Find("sibling")), (about, following), (box, span), (box, Find("inside", tag="p"))]
    keys = [ni.key_of(f) for f in (label, about, following, box, span, Find(tag="p"))]
    text = lambda p: nd.text_of(F.col("text"), ni.node_at(p))

    def found(**how):
        df = shred(table(spark, pages), index=keys, **how)
        values = [text(ex.step_from(ex.step_from(None, p[0]), p[1]) if len(p) == 2 else ni.sibling(ni.sibling(ni.first_position(label)))) for p in paths]
        inner = F.transform(ni.inside(ni.node_at(ni.first_position(box)), Find(tag="p")), lambda n: nd.text_of(F.col("text"), n))
        rows = df.select("page_id", "text", F.transform(ni.positions(label), text).alias("labels"), inner.alias("inner"),
                         *[v.alias(f"v{i}") for i, v in enumerate(values)], F.size("nodes").alias("n"))
        return sorted(rows.collect(), key=lambda r: r.page_id)

    whole, reduced = found(), found(nodes="found", onward=ex.onward_keys(paths))
    assert [r[:-1] for r in whole] == [r[:-1] for r in reduced]
    assert [r.v1 for r in reduced] == ["8", None, None, None, None]
    assert [r.n for r in whole[:3]] != [r.n for r in reduced[:3]] and all(a.n >= b.n for a, b in zip(whole, reduced))
    texts = shred(table(spark, pages), nodes="none")
    assert texts.columns == ["page_id", "text", "problem"]
    assert sorted(r.text or "" for r in texts.collect()) == sorted(r.text or "" for r in whole)


def test_pages_read_together_make_only_nodes_that_stay(monkeypatch):
    """What the index doesn't name is left out before any column of nodes is made, with the same result as afterwards."""
    import random

    import pyarrow as pa
    from listing_analytics.operators import shred as sh
    from listing_analytics.operators import shred_slice as sl
    from listing_analytics.operators.node_index import Wanted
    pick = random.Random(5)
    pages = pa.array([W_PRODUCT, W_VENDOR, N_PRODUCT, N_VENDOR] + [_nested(pick) for _ in range(1500)], pa.string())
    keys = ["following:", "text:", "tag:p", "class:\na", "id:m", "style:s", "string:Product Class", "string:c", "contains:Sales", "contains:c", "like:x"]
    filled = lambda index: [[(k, v) for k, v in page if v] for page in index.to_pylist()]
    for wanted in [[k] for k in keys] + [pick.sample(keys, 4) for _ in range(8)]:
        onward = {k: pick.randrange(1, 4) for k in wanted[::2] if k != "following:"}
        read = lambda *more: sl.shred_columns(pages, sl.Tags(sh._parse_tag, Wanted(wanted)), sh._RAW_END, sh._RAW_ODD, sh.HIDDEN, *more)
        good, texts, nodes, index = read()
        after = sl.found_nodes(nodes, index, onward)
        at_once = read(False, onward)
        assert len(good) > 1000 and at_once[0].tolist() == good.tolist() and at_once[1].equals(texts)
        assert at_once[2].to_pylist() == after[0].to_pylist()
        assert [dict(p) for p in filled(at_once[3])] == [dict(p) for p in filled(after[1])]
    monkeypatch.setattr(sl, "found_nodes", None)
    usual = pa.array([W_PRODUCT, N_PRODUCT, N_VENDOR] * 5)
    readable = usual.take(pa.array(sl.shred_columns(usual, sl.Tags(sh._parse_tag, None), sh._RAW_END, sh._RAW_ODD, sh.HIDDEN)[0]))
    assert len(sh._shred_pages(readable, sl.Tags(sh._parse_tag, Wanted(["tag:p"])), False, {})[1]) >= 10


def test_records_need_no_reviews_to_be_worked_out(spark):
    """Whether reviews are whole is seen from their nodes: tables of other records hold no part of a review."""
    bare = N_VENDOR.replace("<span>June</span>", "")
    none = N_VENDOR.replace('<div class="p-4 flex flex-col h-full"><span>June</span><p>1 star</p></div>', "")
    out = ex.extract_all(table(spark, [N_VENDOR, bare, none, N_VENDOR.replace("p-4", "p-5")]), site_n())
    assert "price_paid" not in out["vendor"]._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.page_id for r in out["vendor"].select("page_id").collect()) == [0, 2, 3]
    assert [tuple(r) for r in out["rejects"].collect()] == [(1, "review is incomplete")]
    assert sorted(r.page_id for r in out["review"].collect()) == [0, 0, 2]


def test_found_nodes_with_the_members_that_rules_read(spark):
    """Pages of both ways of reading give nodes with the members asked for alone, otherwise as those with all."""
    pages = [N_VENDOR, N_PRODUCT, W_PRODUCT, "<p>x", None, '<div id="about-data"><p>a<p>b</div></i>']
    keys, names = ex.site_keys(site_n()), ex.site_fields(site_n())
    rows = lambda *more: sorted(map(tuple, shred(table(spark, pages), index=keys, nodes="found", **dict(more)).select(
        "page_id", "text", "index", F.to_json(F.transform("nodes", lambda n: F.struct(*[n[f] for f in names])))).collect()))
    assert {"parent", "sib_ord", "cls", "string", "only"}.isdisjoint(names)
    assert rows(("fields", names)) == rows()
    with pytest.raises(ValueError):
        shred(table(spark, pages), fields=["pre"])
