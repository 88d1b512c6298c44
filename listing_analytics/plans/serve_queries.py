"""Queries over the dashboard lookups (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from listing_analytics.operators import serve
from listing_analytics.plans import roles
from listing_analytics.plans.mart_queries import GROUPED_SQL, grouped
from listing_analytics.plans.registry import query
from listing_analytics.plans.roles import BANDS, LISTING_SQL, REVIEW_SQL, VENDOR_SQL, table
from listing_analytics.session import scratch_path

_L = f"with {LISTING_SQL}"
_V = f"with {VENDOR_SQL}"
_G = f"with {GROUPED_SQL}"
_LR = f"with {LISTING_SQL}, {REVIEW_SQL}"
_PAIRS = "listing l join review r on l.vendor is not distinct from r.vendor and l.name = r.product"
_ORDER_SQL = "case price_range when 'low' then 0 when 'middle' then 1 when 'high' then 2 end"


@query("H1_totals", f"""with {LISTING_SQL}, {VENDOR_SQL} select (select count(*) from listing) as total_products,
  (select count(*) from vendors) as total_vendors, (select count(*) from review) as total_reviews""")
def h1(spark, sf):
    return serve.totals(roles.listing(spark, sf), roles.vendor(spark, sf), roles.review(spark, sf))


@query("H2_listing_reviews", f"{_LR} select l.*, r.product, r.rating, r.price_paid, r.currency from {_PAIRS}")
def h2(spark, sf):
    return serve.listing_reviews(roles.listing(spark, sf), roles.review(spark, sf))


_MATRIX = f"""{_LR}, m as (select main_business, count(*) filter (rating = 'positive') as positive,
  count(*) filter (rating = 'negative') as negative from {_PAIRS} where rating is not null group by 1)"""


def _matrix(spark, sf):
    return serve.review_matrix(roles.listing(spark, sf), roles.review(spark, sf))


@query("H3_review_matrix", f"{_MATRIX} select * from m")
def h3(spark, sf):
    return _matrix(spark, sf)


@query("H4_share_of_total", f"""{_G} select *, round(cast(product_count as double) * 100
  / (select cast(sum(product_count) as double) from grouped), 2) as percentage from grouped""")
def h4(spark, sf):
    return serve.share_of_total(grouped(spark, sf))


@query("H5_rollup_totals", f"""{_G} select main_business, category, cast(sum(product_count) as bigint) as product_count,
  cast(grouping(main_business, category) as bigint) as level_id from grouped group by rollup (main_business, category)""")
def h5(spark, sf):
    return serve.rollup_totals(grouped(spark, sf))


_FULL_ORDER = ["price_usd", "vendor", "name", "marketplace"]


@query("H6_find_listings", f"""{_L} select * from listing where broad_category = 'PROMO'
  and price_usd between {10.0 ** 2.5!r} and {10.0 ** 3.5!r} order by price_usd, vendor, name, marketplace limit 10""")
def h6(spark, sf):
    return serve.find_listings(roles.listing(spark, sf), "PROMO", (2.5, 3.5), 10, _FULL_ORDER)


@query("H7_find_vendors", f"""{_V} select name, about_text, review_count, marketplace from vendors
  where marketplace = 'ASIA' and review_count between {10.0 ** 0.5!r} and {10.0 ** 1.5!r} order by name limit 10""")
def h7(spark, sf):
    return serve.find_vendors(roles.vendor(spark, sf), "ASIA", (0.5, 1.5), 10, ["name"])


def _clustered(spark, rows, by, value, wanted):
    path = scratch_path(spark, "mart")
    serve.write_mart(rows, path, by, value)
    return serve.read_mart(spark, path, rows.schema, by, wanted)


@query("H6_find_in_mart", f"""{_L} select * from listing where broad_category = 'PROMO'
  and price_usd between {10.0 ** 2.5!r} and {10.0 ** 3.5!r} order by price_usd, vendor, name, marketplace limit 10""")
def h6_mart(spark, sf):
    rows = _clustered(spark, roles.listing(spark, sf), "broad_category", "price_usd", "PROMO")
    return serve.find_listings(rows, "PROMO", (2.5, 3.5), 10, _FULL_ORDER)


@query("H7_find_in_mart", f"""{_V} select name, about_text, review_count, marketplace from vendors
  where marketplace = 'ASIA' and review_count between {10.0 ** 0.5!r} and {10.0 ** 1.5!r} order by name limit 10""")
def h7_mart(spark, sf):
    rows = _clustered(spark, roles.vendor(spark, sf), "marketplace", "review_count", "ASIA")
    return serve.find_vendors(rows, "ASIA", (0.5, 1.5), 10, ["name"])


@query("H8_choices", f"{_L} select distinct broad_category from listing")
def h8(spark, sf):
    return serve.choices(roles.listing(spark, sf), "broad_category")


@query("H9_log_ticks", f"""{_L}, b as (select log10(min(price_usd)) as lo, log10(max(price_usd)) as hi from listing)
  select round(lo + i * 0.5, 9) as tick, cast(floor(pow(10.0, lo + i * 0.5)) as bigint) as label
  from b, range(100) as r(i) where i < ceil((hi + 0.1 - lo) / 0.5)""")
def h9(spark, sf):
    return serve.log_ticks(roles.listing(spark, sf), "price_usd").withColumn("tick", F.round("tick", 9))


@query("H9_review_ticks", f"""with {VENDOR_SQL}, b as (select log10(min(review_count) + 1) as lo, log10(max(review_count)) as hi from vendors)
  select round(lo + i * 0.5, 9) as tick, cast(floor(pow(10.0, lo + i * 0.5)) as bigint) as label
  from b, range(100) as r(i) where i < ceil((hi + 0.1 - lo) / 0.5)""")
def h9_reviews(spark, sf):
    return serve.log_ticks(roles.vendor(spark, sf), "review_count", shift=1).withColumn("tick", F.round("tick", 9))


@query("H10_by_business", f"{_G} select main_business, cast(sum(product_count) as bigint) as product_count from grouped group by 1")
def h10(spark, sf):
    return serve.by_business(grouped(spark, sf))


@query("H11_drill_down", f"""{_G} select category, cast(sum(product_count) as bigint) as product_count from grouped
  where main_business = 'Physical' group by 1""")
def h11(spark, sf):
    return serve.drill_down(grouped(spark, sf), "Physical/SMALL")


@query("H12_band_by_business", f"""{_G} select price_range, main_business, cast(sum(product_count) as bigint) as product_count,
  {_ORDER_SQL} as band_order from grouped group by 1, 2""")
def h12(spark, sf):
    return serve.band_by_business(grouped(spark, sf), BANDS)


@query("H13_band_by_category", f"""{_G} select price_range, category, cast(sum(product_count) as bigint) as product_count,
  {_ORDER_SQL} as band_order from grouped where main_business = 'Digital' group by 1, 2""")
def h13(spark, sf):
    return serve.band_by_category(grouped(spark, sf), "Digital", BANDS)


@query("H14_describe", f"""{_G}, d as (select p_type as category, 'sold as ' || min(p_brand) as description from part
    where p_type <> 'SMALL' group by 1 union all select 'Digital', 'sent by wire')
  select g.*, coalesce(s.description, 'No specific information available for this subcategory.') as sub_description,
         coalesce(d.description, 'No specific information available for this category.') as description
  from grouped g left join d as s on s.category = g.category left join d on d.category = g.main_business""")
def h14(spark, sf):
    texts = (table(spark, sf, "part").filter("p_type <> 'SMALL'").groupBy(F.col("p_type").alias("category"))
             .agg(F.concat(F.lit("sold as "), F.min("p_brand")).alias("description")))
    main = spark.range(1).select(F.lit("Digital").alias("category"), F.lit("sent by wire").alias("description"))
    return serve.describe_levels(grouped(spark, sf), texts.unionByName(main))


@query("H15_review_long", f"""{_MATRIX} select main_business, 'negative' as rating, negative as n from m""")
def h15(spark, sf):
    return serve.review_long(_matrix(spark, sf), "negative")


@query("H16_business_summary", f"""{_L}, v as (select main_business, count(distinct vendor) as n_vendors from listing group by 1),
  o as (select count(*) as k from (select vendor from listing where main_business = 'Digital'
        intersect select vendor from listing where main_business = 'Physical'))
  select main_business, n_vendors, case when main_business <> 'Other' then k end as side_count,
         case when main_business <> 'Other' then k * 100.0::double / n_vendors end as side_pct from v, o""")
def h16(spark, sf):
    return serve.business_summary(roles.listing(spark, sf), "Digital", "Physical")
