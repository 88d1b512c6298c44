"""Explicit schemas; nothing is inferred at load time."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


PAGE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

# Column order of the three record tables.
PRODUCT = _strings("name", "category", "picture", "sold_since", "sold_count", "price", "currency",
                   "description", "shipped_from", "shipped_to", "vendor", "marketplace")
VENDOR = _strings("name", "about_text", "profile_picture", "pgp_key", "wallet_address",
                  "review_count", "rating", "sale_count", "historic_sale_count", "marketplace",
                  "marketplace_history")
REVIEW = _strings("vendor", "product", "product_link", "datetime", "author", "rating", "text",
                  "price_paid", "currency")

RECORDS = {"product": PRODUCT, "vendor": VENDOR, "review": REVIEW}

LINK_MAP = T.MapType(
    T.StringType(),
    T.StructType([
        T.StructField("original", T.StringType()),
        T.StructField("children", T.MapType(T.StringType(), T.StringType())),
    ]),
)

EDGE = _strings("src_hash", "src_url", "dst_hash", "dst_url")

FX_RATES = T.StructType([
    T.StructField("currency", T.StringType()),
    T.StructField("per_eur", T.DoubleType()),
])

# One node of a page, in document order: ``pre`` is its position in the node array, and it has
# ``post - pre + level`` descendants, which follow it directly. ``start``/``end`` are character offsets into ``text``, so the
# text of any element is one substring and is never stored twice.
NODE = T.StructType([
    T.StructField("pre", T.IntegerType()),
    T.StructField("post", T.IntegerType()),
    T.StructField("parent", T.IntegerType()),
    T.StructField("level", T.IntegerType()),
    T.StructField("sib_ord", T.IntegerType()),
    T.StructField("tag", T.StringType()),
    # Class names with one blank before, between and after them.
    T.StructField("cls", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    # The text of a text node, or the comment that is all an element holds.
    T.StructField("string", T.StringType()),
    # Where an element holds nothing but one text, at any depth: the node whose ``string`` that is.
    T.StructField("only", T.IntegerType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    # The next element with the same parent.
    T.StructField("next", T.IntegerType()),
])
