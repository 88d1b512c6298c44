"""Pages in both site layouts, written by Spark from the listings of the order tables.

Extraction must give back the values the pages were made from, which SQL can state directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listing_analytics.plans import roles


# Fixed values, here and in the tests of pages: class names, styles, ids and labels of both layouts, as in ``rules``.


def _page(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _amount() -> Column:
    return F.floor("price_usd").cast("bigint").cast("string")


def w_product() -> Column:
    """Product page of site W with two reviews and a header row without paragraphs."""
    review = lambda icon, text, author, date: (
        '<tr><td><img src="', icon, '"></td><td><p> ', text, "</p><p>", F.col("name"), "</p><p>", author, " USD ",
        _amount(), "</p><p>", date, "</p></td></tr>")
    return _page(
        '<!DOCTYPE html><html><head><title>Shop</title><script>var t="</p>";</script></head><body>',
        '<p id="desc_prod">General<a href="/u"> ', F.col("vendor"), " </a></p>",
        '<div class="tabcontent wide"><h3> ', F.col("name"), " </h3></div>",
        '<div class="bigimage"><a href="/big"><img src="img/', F.col("category"), '.png"></a></div>',
        "<p>", _amount(), " sold since ", F.col("main_business"), "</p>",
        '<p class="padp" style="margin-bottom: 10px;">Price <span>USD $', _amount(), "</span></p>",
        '<p style="word-wrap: break-word; white-space: pre-wrap;"> Salt &amp; ', F.col("name"), "\nsecond line </p>",
        "<table><tr><td>Product Class</td> <td> ", F.col("category"), " </td></tr>",
        "<tr><td>Ships to</td><td>", F.col("marketplace"), "</td></tr>",
        "<tr><td>Origin Country</td><td>", F.col("main_business"), "</td></tr></table>",
        "<p>Sold by <b><a href='/v'>", F.col("vendor"), "</a></b></p>",
        '<p class="boldstats">', "10", ' feedbacks</p><div class="listDes"><h2>', F.col("name"), "</h2></div>",
        '<a href="item?id=1">Description</a>',
        '<table class="user_feedbackTbl autoshop_table"><tr><th>Feedback</th></tr>',
        *review("files/feedback1.png", "very good ", "ann", "today"),
        *review("files/feedback2.png", "not &lt;so&gt; good", "bob", "yesterday"),
        "</table></body></html>")


def w_vendor() -> Column:
    return _page(
        "<html><body><h1>Vendor Profile</h1><h3 class='user_info_mid_head'>", F.col("vendor"), " (online)</h3>",
        "<div class='user_info'><img src='face/", F.col("category"), ".png'></div>",
        "<h3>About</h3><div> sells <b>", F.col("name"), "</b> </div>",
        "<h3>PGP</h3>\n<pre> KEY ", F.col("category"), "</pre>",
        "<p class='boldstats'> Feedback ", _amount(), " total 7</p></body></html>")


def n_product() -> Column:
    return _page(
        '<html><body><h1 class="text-2xl font-bold"> ', F.col("name"), "</h1>",
        '<a class="hover:text-base-500 duration-[750ms]" href="/c">', F.col("main_business"), "</a>",
        '<a class="hover:text-base-500 duration-[750ms]" href="/d"> ', F.col("category"), "</a>",
        '<a class="image-box" href="img/', F.col("category"), '.png"><img src="small.png"></a>',
        '<dl><dd class="order-first text-sm font-semibold tracking-tight text-green-500"> ', _amount(),
        " <span> CAD</span></dd></dl>",
        '<div id="description-data"><p> about ', F.col("name"), " &copy;</p><p>more</p></div>",
        '<h1 class="font-semibold text-center text-xl text-lime-500"> ', F.col("vendor"), "</h1>",
        "<button>Add to Cart</button></body></html>")


def n_vendor() -> Column:
    """Vendor page of site N with its history on another market and two reviews."""
    card = lambda text, stars: (
        '<div class="p-4 flex flex-col h-full"><span>3 days ago</span><a href="/p/', F.col("category"), '"> ',
        F.col("name"), "</a><p>", stars, "</p><p>", text, "</p><div><span> ", _amount(), " EUR</span></div></div>")
    return _page(
        '<html><body><h2 class="text-lg">', F.col("vendor"), "</h2>",
        '<div id="about-data"><p>Sales of ', F.col("name"), "</p></div>",
        "<h4>Public key</h4><code>id</code><code>KEY ", F.col("category"), "</code>",
        "<dl><dt>Sales</dt> <dd>", _amount(), "</dd><dt>Historical Sales</dt><dd>9</dd><dt>Reviews</dt><dd> ",
        _amount(), " | 4 </dd></dl>",
        '<div class="text-xs text-gray-400/80 hover:text-gray-400 font-semibold">',
        (F.floor("price_usd").cast("bigint") % 5).cast("string"), '.5 <span>/ 5</span></div>',
        '<div class="px-4 text-gray-700"><h3> ', F.col("marketplace"), "</h3><span>", _amount(),
        "</span><span> 4.9</span></div>",
        '<div class="px-4 text-gray-700"><h3>empty</h3><span>1</span></div>',
        '<div id="reviews-data">', *card("fine", "5 stars"), *card("late", "2 stars"), "</div></body></html>")


def n_missing() -> Column:
    return _page("<html><body><p>Sorry, the page you are looking for could not be found.</p><i>",
                 F.col("vendor"), "</i></body></html>")


def pages_of(spark, sf_dir: str, html: Column) -> DataFrame:
    """One page per listing.

    The slim listings are spread over all tasks before they grow into pages.
    """
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return roles.listing(spark, sf_dir).repartition(slots, "vendor", "name", "price_usd").select(F.monotonically_increasing_id().alias("page_id"), "*", html.alias("html"))


def mixed_w() -> Column:
    return (F.when(F.col("main_business") == "Digital", w_product())
            .when(F.col("main_business") == "Physical", w_vendor())
            .otherwise(_page("<p>Welcome, ", F.col("vendor"), "</p>")))


def mixed_n() -> Column:
    return (F.when(F.col("main_business") == "Digital", n_product())
            .when(F.col("main_business") == "Physical", n_vendor()).otherwise(n_missing()))


def variants_w() -> Column:
    """Product pages of site W: whole ones; ones without reviews, a labelled cell and the usual place of the name, with
    end tags too many and too few; and ones with an incomplete review."""
    bare = _page('<p id="desc_prod">x</b></p></td><h2 style="margin:0px;"><i> ', F.col("name"), " </h2>",
                 "<table><tr><td>Product Class</td><td> ", F.col("category"), "</td></tr><tr><td>Ships to</td><td>",
                 F.col("marketplace"), '</table></span><p class="boldstats">0 of 0')
    return (F.when(F.col("main_business") == "Digital", w_product()).when(F.col("main_business") == "Physical", bare)
            .otherwise(F.replace(w_product(), F.lit("<p>yesterday</p>"), F.lit(""))))
