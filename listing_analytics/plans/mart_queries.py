"""Queries over the mart operators (G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from listing_analytics.operators import clean, marts
from listing_analytics.functions import text as tx
from listing_analytics.plans import roles
from listing_analytics.plans.registry import query
from listing_analytics.plans.clean_queries import _USD_SQL
from listing_analytics.plans.roles import BANDS, CATEGORIES, GROUPS, LISTING_SQL, REVIEW_SQL, VENDOR_SQL, table

_L = f"with {LISTING_SQL}"
_R = f"with {REVIEW_SQL}"
_V = f"with {VENDOR_SQL}"

BAND_SQL = """case when price_usd >= 0 and price_usd < 500 then 'low'
  when price_usd >= 500 and price_usd < 2000 then 'middle' when price_usd >= 2000 then 'high' end"""

# A short list of frequent words, used as the stop-word parameter of the term queries.
EVERYDAY_WORDS = ["the", "of", "and", "to", "in", "is", "for", "on", "with", "as", "that", "this", "la", "le", "de",
                  "les", "et", "der", "die", "und", "el", "los", "que"]
_WORDS_SQL = ", ".join(f"'{w}'" for w in EVERYDAY_WORDS)


@query("G1_main_business", f"{_L} select name, vendor, price_usd, main_business from listing")
def g1(spark, sf):
    rows = roles.listing(spark, sf).drop("main_business")
    return marts.main_business(rows, GROUPS).select("name", "vendor", "price_usd", "main_business")


@query("G2_vendors_per_business", f"{_L} select main_business, count(distinct vendor) as n_vendors from listing group by 1")
def g2(spark, sf):
    return marts.distinct_by(roles.listing(spark, sf), ["main_business"], "vendor", "n_vendors")


_MATRIX = ", ".join(f"count(*) filter (category = '{c}') as \"{c}\"" for c in CATEGORIES)


@query("G3_count_matrix", f"{_L} select vendor, {_MATRIX} from listing group by 1")
def g3(spark, sf):
    return marts.count_matrix(roles.listing(spark, sf), "vendor", "broad_category", CATEGORIES)


_FLAGS = (f"{LISTING_SQL}, flags as (select vendor, bool_or(main_business = 'Digital') as in_first, "
          "bool_or(main_business = 'Physical') as in_second from listing group by 1)")


def _flags(spark, sf):
    return marts.activity_flags(roles.listing(spark, sf), "Digital", "Physical")


@query("G4_activity_flags", f"with {_FLAGS} select * from flags")
def g4(spark, sf):
    return _flags(spark, sf)


@query("G5_overlap", f"with {_FLAGS} select count(*) as n_both from flags where in_first and in_second")
def g5(spark, sf):
    return marts.overlap(_flags(spark, sf))


_SHARES = f"""with {_FLAGS}, c as (select count(*) filter (in_first) as n_first, count(*) filter (in_second) as n_second,
    count(*) filter (in_first and in_second) as n_both from flags),
  s as (select *, n_both * 100.0::double / n_first as pct_first, n_both * 100.0::double / n_second as pct_second from c)"""


@query("G6_overlap_share", f"{_SHARES} select * from s")
def g6(spark, sf):
    return marts.overlap_share(_flags(spark, sf))


@query("G7_statements", f"""{_SHARES}
  select unnest(['digital vendors', 'physical vendors', 'vendors of both', 'share of digital vendors', 'share of physical vendors']) as key,
         unnest([n_first || ' vendors mainly sell digital products', n_second || ' vendors mainly sell physical products',
                 n_both || ' vendors sell both kinds of products',
                 printf('%.2f%%', pct_first) || ' of the vendors of digital products sell physical products, too',
                 printf('%.2f%%', pct_second) || ' of the vendors of physical products sell digital products, too']) as statement from s""")
def g7(spark, sf):
    return marts.statements(marts.overlap_share(_flags(spark, sf)), "digital", "physical")


@query("G8_products_per_category", f"{_L} select broad_category, count(*) as n from listing group by 1")
def g8(spark, sf):
    return marts.count_by(roles.listing(spark, sf), ["broad_category"], ordered=True)


@query("G9_top_vendors", f"""{_L} select vendor, {_MATRIX}, count(*) as "Total Products" from listing
  group by 1 order by "Total Products" desc, vendor limit 20""")
def g9(spark, sf):
    matrix = marts.count_matrix(roles.listing(spark, sf), "vendor", "broad_category", CATEGORIES, "Total Products")
    return marts.top_k(matrix, "Total Products", ["vendor"], 20)


def _histogram_sql(source: str, col: str, bins: int) -> str:
    return f"""b as (select min({col})::double as lo, max({col})::double as hi,
      (max({col})::double - min({col})::double) / {bins} as w from {source}),
    c as (select least(cast(floor(({col}::double - lo) / w) as bigint), {bins - 1}) as id, count(*) as n
          from {source}, b group by 1)
    select cast(i + 1 as int) as bin, lo + i * w as bin_from, lo + (i + 1) * w as bin_to, coalesce(n, 0) as n
    from b, range({bins}) as r(i) left join c on c.id = i"""


@query("G10_price_histogram", f"{_L}, {_histogram_sql('listing', 'price_usd', 50)}")
def g10(spark, sf):
    return marts.histogram(roles.listing(spark, sf), "price_usd", 50)


def _density_sql(source: str, col: str, bins: int) -> str:
    return f"""s as (select min({col}) as lo, max({col}) as hi, count(*)::double as n,
    stddev_samp({col}) * pow(count(*)::double, -0.2) as h, (max({col}) - min({col})) / 199 as w from {source}),
  g as (select i as point, lo + i * w as x, n, h, w, lo, hi from s, range(200) as r(i)),
  d as (select point, any_value(x) as x, any_value(n) as n, any_value(hi - lo) as span,
          sum(exp(-0.5 * ((x - {col}) / h) * ((x - {col}) / h))) / any_value(n * h * sqrt(2 * pi())) as density
        from g, {source} group by 1)
  select cast(point as int) as point, round(x, 6) as x, round(density, 12) as density,
         round(density * n * (span / {bins}), 6) as scaled from d"""


@query("G11_review_density", f"with {VENDOR_SQL}, v as (select review_count::double as reviews from vendors), {_density_sql('v', 'reviews', 20)}")
def g11_reviews(spark, sf):
    curve = marts.density(roles.vendor(spark, sf), "review_count", 200, bins=20)
    return curve.select("point", F.round("x", 6).alias("x"), F.round("density", 12).alias("density"),
                        F.round("scaled", 6).alias("scaled"))


@query("G11_price_density", f"{_L}, {_density_sql('listing', 'price_usd', 50)}")
def g11(spark, sf):
    curve = marts.density(roles.listing(spark, sf), "price_usd", 200, bins=50)
    return curve.select("point", F.round("x", 6).alias("x"), F.round("density", 12).alias("density"),
                        F.round("scaled", 6).alias("scaled"))


@query("G12_null_out", f"""{_L} select name, vendor, price_usd,
  case when category not in ('SMALL', 'LARGE') then category end as category from listing""")
def g12(spark, sf):
    return marts.null_out(roles.listing(spark, sf), "category", ["SMALL", "LARGE"]).select(
        "name", "vendor", "price_usd", "category")


def _top_sql(item: str, k: int) -> str:
    return f"""{_L}, c as (select main_business, {item}, count(*) as n from listing group by 1, 2),
    t as (select *, cast(row_number() over (partition by main_business order by n desc, {item}) as int) as rank
          from c qualify rank <= {k})"""


@query("G13_top_categories", f"{_top_sql('name', 5)} select * from t")
def g13(spark, sf):
    return marts.top_k_per_group(roles.listing(spark, sf), "main_business", "name", 5)


@query("G14_share_in_top", f"""{_top_sql('name', 5)}
  select *, n * 100.0::double / cast(sum(n) over (partition by main_business) as double) as share from t""")
def g14(spark, sf):
    return marts.top_k_per_group(roles.listing(spark, sf), "main_business", "name", 5, share="share")


@query("G15_mean_price", f"{_L} select broad_category, round(avg(price_usd), 6) as mean_price from listing group by 1")
def g15(spark, sf):
    means = marts.mean_by(roles.listing(spark, sf), ["broad_category"], "price_usd", "mean_price")
    return means.withColumn("mean_price", F.round("mean_price", 6))


@query("G16_relabel", f"""{_L} select case main_business when 'Physical' then 'Goods' else main_business end as main_business,
  count(*) as n from listing group by 1""")
def g16(spark, sf):
    return marts.count_by(marts.relabel(roles.listing(spark, sf), {"Physical": "Goods"}), ["main_business"])


@query("G17_listing_view", f"{_L} select name, main_business, vendor, category, price_usd, broad_category from listing")
def g17(spark, sf):
    return marts.listing_view(roles.listing(spark, sf))


@query("G18_price_band", f"""{_L} select name, vendor, price_usd, {BAND_SQL} as price_range,
  case {BAND_SQL} when 'low' then 0 when 'middle' then 1 when 'high' then 2 end as band_order from listing""")
def g18(spark, sf):
    return marts.price_band(roles.listing(spark, sf), BANDS).select(
        "name", "vendor", "price_usd", "price_range", "band_order")


@query("G19_band_counts", f"""{_L}, c as (select {BAND_SQL} as price_range, count(*) as n from listing group by 1)
  select cast(o as int) as band_order, l as price_range, coalesce(n, 0) as n
  from (values (0, 'low'), (1, 'middle'), (2, 'high')) as b(o, l) left join c on c.price_range = l""")
def g19(spark, sf):
    return marts.band_counts(roles.listing(spark, sf), BANDS)


GROUPED_SQL = f"""{LISTING_SQL}, grouped as (select main_business, broad_category as category, {BAND_SQL} as price_range,
  count(*) as product_count from listing group by 1, 2, 3)"""


def grouped(spark, sf):
    return marts.products_grouped(roles.listing(spark, sf), BANDS)


@query("G20_products_grouped", f"with {GROUPED_SQL} select * from grouped")
def g20(spark, sf):
    return grouped(spark, sf)


@query("G21_market_share", f"""{_top_sql('vendor', 10)}
  select *, n * 100.0::double / cast(sum(n) over (partition by main_business) as double) as share from t""")
def g21(spark, sf):
    return marts.top_k_per_group(roles.listing(spark, sf), "main_business", "vendor", 10, share="share")


@query("G22_rating_distribution", f"{_R} select rating, count(*) as n from review where rating is not null group by 1")
def g22(spark, sf):
    return marts.count_by(roles.review(spark, sf), ["rating"], ordered=True)


@query("G23_top_reviewed_vendors", f"{_R} select vendor, count(*) as n from review group by 1 order by n desc, vendor limit 20")
def g23(spark, sf):
    return marts.top_k(marts.count_by(roles.review(spark, sf), ["vendor"]), "n", ["vendor"], 20)


@query("G24_dearest_products", f"""
  with {REVIEW_SQL}, p as (select *, cast(regexp_extract(price_paid, '([0-9]+)', 1) as double) as paid from review),
  u as (select product, {_USD_SQL} as usd from p)
  select product, round(m, 6) as mean_paid from (select product, avg(usd) as m from u where usd is not null group by 1)
  order by m desc, product limit 20""")
def g24(spark, sf):
    paid = roles.review(spark, sf).withColumn("paid", tx.first_integer(F.col("price_paid")))
    usd = clean.to_usd(paid, "paid", "currency", roles.rates(spark), "price_paid_usd")
    return marts.mean_paid_per_product(usd).withColumn("mean_paid", F.round("mean_paid", 6))


def _terms_sql(table_name: str, col: str) -> str:
    return f"""select term, count(*) as n from (select unnest(regexp_extract_all(lower({col}), '[\\p{{L}}\\p{{N}}_]{{2,}}'))
    as term from {table_name}) where term not in ({_WORDS_SQL}) group by 1 order by n desc, term limit 200"""


@query("G25_review_terms", _terms_sql("documents", "text"))
def g25(spark, sf):
    return marts.term_counts(table(spark, sf, "documents"), "text", EVERYDAY_WORDS)


@query("G26_vendor_terms", _terms_sql("conversations", "text"))
def g26(spark, sf):
    return marts.term_counts(table(spark, sf, "conversations"), "text", EVERYDAY_WORDS)


@query("G27_review_count_histogram", f"{_V}, {_histogram_sql('vendors', 'review_count', 30)}")
def g27(spark, sf):
    return marts.histogram(roles.vendor(spark, sf), "review_count", 30)


@query("G28_vendors_per_marketplace", f"{_V} select marketplace, count(*) as n from vendors group by 1")
def g28(spark, sf):
    return marts.count_by(roles.vendor(spark, sf), ["marketplace"], ordered=True)
