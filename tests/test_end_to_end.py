"""Saved page files of both sites to marts, through every stage."""

from test_pages import N_MISSING, N_PRODUCT, N_VENDOR, W_PRODUCT, W_VENDOR

from listing_analytics import fixed, schemas
from listing_analytics.operators import classify, clean, marts, serve
from listing_analytics.operators.extract import run_extraction
from listing_analytics.rules.site_n import site_n
from listing_analytics.rules.site_w import site_w
from listing_analytics.sources.pages import read_page_files
from listing_analytics.sources.sinks import overwrite

W2 = W_PRODUCT.replace("Blue lamp", "Notes").replace("Home", "Digital E-Books")
W3 = W_PRODUCT.replace("Blue lamp", "Plant").replace("Home", "Ecstasy Pills").replace("12.50", "300")
N2 = N_PRODUCT.replace(" Seats ", " E-Books ").replace(">Home<", ">Digital<").replace("soft", "paper story")


def save(folder, pages):
    folder.mkdir()
    for i, html in enumerate(pages):
        (folder / f"{i}.html").write_text(html)
    return str(folder)


def test_pages_to_marts(spark, tmp_path):
    w = run_extraction(read_page_files(spark, save(tmp_path / "w", [W_PRODUCT, W2, W3, W2, W_VENDOR])), site_w(), str(tmp_path / "ow"))
    n = run_extraction(read_page_files(spark, save(tmp_path / "n", [N_PRODUCT, N2, N_VENDOR, N_MISSING])), site_n(), str(tmp_path / "on"))
    (reject,) = n["rejects"].collect()
    assert reject.path.endswith("3.html") and reject.reason == "page is not valid for extraction"

    rates = spark.createDataFrame([("CAD", 1.47), ("USD", 1.08)], schemas.FX_RATES)
    products = clean.clean_products([n["product"], w["product"]], rates, ["page_id"])
    # Equal names count once per site: two listings of N have one name.
    assert {(r.name, r.marketplace) for r in products.collect()} == {
        ("Red chair", "site-n"), ("Blue lamp", "site-w"), ("Notes", "site-w"), ("Plant", "site-w")}
    assert {r.name: r.price_usd for r in products.collect()}["Plant"] == 220.41

    vendors = clean.clean_vendors([n["vendor"], w["vendor"]], ["page_id"])
    assert {r.name: (r.review_count, r.review_count_normalized) for r in vendors.collect()} == {"leo": (44, 1.0), "mia": (17, 0.0)}
    reviews = clean.clean_reviews(w["review"], n["review"], rates)
    assert reviews.count() == 14 and reviews.filter("rating = 'negative'").count() == 5

    mapping = spark.createDataFrame(list(fixed.CATEGORY_MAP.items()), "key string, value string")
    overwrite(classify.classify(products, mapping, []), str(tmp_path / "products"))
    listings = marts.relabel(marts.main_business(spark.read.parquet(str(tmp_path / "products"))))
    rows = {r.name: r for r in listings.collect()}
    assert (rows["Notes"].broad_category, rows["Plant"].main_business) == ("Digital Knowledge Products", "Drugs")
    assert rows["Blue lamp"].is_predicted and not rows["Notes"].is_predicted
    grouped = marts.products_grouped(listings)
    assert grouped.groupBy().sum("product_count").first()[0] == 4
    assert tuple(serve.totals(listings, vendors, reviews).first()) == (4, 2, 14)
    assert serve.review_matrix(listings, reviews).count() >= 1
