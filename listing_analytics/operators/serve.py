"""Parameterised lookups behind the dashboard (H1-H16). Selections are arguments, never state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_analytics import fixed
from listing_analytics.operators import marts

RATINGS = ("positive", "negative")


def totals(products: DataFrame, vendors: DataFrame, reviews: DataFrame) -> DataFrame:
    """Row counts of the three tables in one row (H1)."""
    n = lambda df, name: df.select(F.count(F.lit(1))).scalar().alias(name)
    return products.sparkSession.range(1).select(
        n(products, "total_products"), n(vendors, "total_vendors"), n(reviews, "total_reviews"))


def listing_reviews(listings: DataFrame, reviews: DataFrame) -> DataFrame:
    """Listings with the reviews of the same vendor and product, many to many (H2).

    Null vendors match each other. Both conditions are join keys, so the vendor-by-vendor product
    is never formed; hot keys are split by adaptive skew handling. For counts use
    :func:`review_matrix`, which joins pre-aggregated sides instead.
    """
    left, right = listings.alias("l"), reviews.alias("r")
    keys = F.col("l.vendor").eqNullSafe(F.col("r.vendor")) & (F.col("l.name") == F.col("r.product"))
    extra = [F.col(f"r.`{c}`") for c in reviews.columns if c != "vendor"]
    return left.join(right, keys).select("l.*", *extra)


def review_matrix(listings: DataFrame, reviews: DataFrame, ratings: Sequence[str] = RATINGS) -> DataFrame:
    """Joined listing-review pairs per main business and rating, zero-filled (H3).

    Equals counting the rows of H2. Both sides are counted per key first and the counts are
    multiplied, so a pair of hot keys costs one row instead of all its combinations.
    """
    left = (listings.filter("name is not null and main_business is not null")
            .groupBy("vendor", "name", "main_business").agg(F.count(F.lit(1)).alias("_l")))
    right = (reviews.filter(F.col("product").isNotNull() & F.col("rating").isin(*ratings))
             .groupBy("vendor", "product").pivot("rating", list(ratings)).count().na.fill(0)
             .withColumnRenamed("vendor", "_vendor"))
    pairs = left.join(right, F.col("vendor").eqNullSafe(F.col("_vendor")) & (F.col("name") == F.col("product")))
    summed = pairs.groupBy("main_business").agg(
        *[F.sum(F.col("_l") * F.col(r)).cast("bigint").alias(r) for r in ratings])
    # A business all of whose pairs carry other ratings has no row in the matrix either.
    any_pair = F.lit(False)
    for rating in ratings:
        any_pair = any_pair | (F.col(rating) > 0)
    return summed.filter(any_pair)


def review_long(matrix: DataFrame, rating: str | None = None, ratings: Sequence[str] = RATINGS) -> DataFrame:
    """The matrix as (main_business, rating, n), optionally one rating only."""
    long = matrix.unpivot("main_business", list(ratings), "rating", "n")
    return long if rating is None else long.filter(F.col("rating") == rating)


def share_of_total(df: DataFrame, col: str = "product_count", digits: int = 2, out: str = "percentage") -> DataFrame:
    """Each row as percentage of the column total (H4). The total is a scalar subquery."""
    whole = df.select(F.sum(col)).scalar().cast("double")
    return df.withColumn(out, F.round(F.try_divide(F.col(col).cast("double") * 100, whole), digits))


def rollup_totals(df: DataFrame, levels: Sequence[str] = ("main_business", "category"),
                  col: str = "product_count") -> DataFrame:
    """Totals on every level of the treemap; ``level_id`` tells subtotals from null keys (H5)."""
    return df.rollup(*levels).agg(F.sum(col).alias(col), F.grouping_id().cast("bigint").alias("level_id"))


def _in_log_range(df: DataFrame, col: str, log_range: tuple[float, float] | None) -> DataFrame:
    if log_range is None:
        return df
    return df.filter(F.col(col).between(10.0 ** log_range[0], 10.0 ** log_range[1]))


def write_mart(df: DataFrame, path: str, by: str, value: str) -> None:
    """Store a mart for lookups by ``by`` and ranges of ``value``: a folder per ``by``, its files in order of ``value``.

    The rows are dealt by ranges of both, so a ``by`` with many rows has many files, each of them sorted. ``by`` stays a
    column inside the files, too, so that it keeps its type and its nulls.
    """
    (df.withColumn("part", F.col(by)).repartitionByRange("part", value).sortWithinPartitions("part", value)
     .write.mode("overwrite").partitionBy("part").parquet(path))


def read_mart(spark: SparkSession, path: str, schema: T.StructType, by: str, wanted: str | None) -> DataFrame:
    """The rows of one ``by`` of a stored mart, or all; the files of others are not opened."""
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("part", T.StringType())])).parquet(path)
    return (rows if wanted is None else rows.filter((F.col("part") == wanted) & (F.col(by) == wanted))).drop("part")


def find_listings(df: DataFrame, category: str | None = None, log_range: tuple[float, float] | None = None,
                  n: int = 10, order: Sequence[str] = ("row_ord",)) -> DataFrame:
    """First listings of a broad category within a price range given as powers of ten (H6).

    Over a mart of :func:`write_mart` by category and price both conditions reach the files.
    """
    if category is not None:
        df = df.filter(F.col("broad_category") == category)
    return _in_log_range(df, "price_usd", log_range).orderBy(*order).limit(n)


def find_vendors(df: DataFrame, marketplace: str | None = None, log_range: tuple[float, float] | None = None,
                 n: int = 10, order: Sequence[str] = ("row_ord",)) -> DataFrame:
    """First vendors of a marketplace within a review-count range given as powers of ten (H7).

    Over a mart of :func:`write_mart` by marketplace and review count both conditions reach the files.
    """
    if marketplace is not None:
        df = df.filter(F.col("marketplace") == marketplace)
    return (_in_log_range(df, "review_count", log_range).orderBy(*order).limit(n)
            .select("name", "about_text", "review_count", "marketplace"))


def choices(df: DataFrame, col: str) -> DataFrame:
    """Different values of a selector (H8)."""
    return df.select(col).distinct().orderBy(col)


def log_ticks(df: DataFrame, col: str, step: float = 0.5, shift: int = 0) -> DataFrame:
    """Slider marks between the logarithms of minimum and maximum (H9).

    ``shift`` is added to the minimum, so that counts starting at zero have a logarithm.
    """
    low = F.log10(df.select((F.min(col) + shift).cast("double")).scalar())
    high = F.log10(df.select(F.max(col).cast("double")).scalar())
    marks = F.ceil((high + 0.1 - low) / step).cast("int")
    position = F.col("i") * step
    return (df.sparkSession.range(1)
            .select(F.explode(F.sequence(F.lit(0), marks - 1)).alias("i"))
            .select((low + position).alias("tick"),
                    F.floor(F.pow(F.lit(10.0), low + position)).cast("bigint").alias("label")))


def by_business(grouped: DataFrame) -> DataFrame:
    """Listings per main business from the grouped mart."""
    return grouped.groupBy("main_business").agg(F.sum("product_count").alias("product_count"))


def drill_down(grouped: DataFrame, path: str | None) -> DataFrame:
    """Categories of the main business that starts a selection path ``main/sub``."""
    if not path:
        return by_business(grouped).select(F.col("main_business").alias("category"), "product_count")
    chosen = path.split("/")[0]
    return (grouped.filter((F.col("main_business") == chosen) & (F.col("product_count") > 0))
            .groupBy("category").agg(F.sum("product_count").alias("product_count")))


def _banded(grouped: DataFrame, keys: Sequence[str], bands) -> DataFrame:
    order = F.array_position(F.array(*[F.lit(label) for label, _, _ in bands]), F.col("price_range"))
    return grouped.groupBy("price_range", *keys).agg(F.sum("product_count").alias("product_count")).withColumn(
        "band_order", (order - 1).cast("int"))


def band_by_business(grouped: DataFrame, bands=tuple(fixed.PRICE_BANDS)) -> DataFrame:
    """Listings per band and main business."""
    return _banded(grouped, ["main_business"], bands)


def band_by_category(grouped: DataFrame, business: str, bands=tuple(fixed.PRICE_BANDS)) -> DataFrame:
    """Listings per band and category of one main business."""
    return _banded(grouped.filter(F.col("main_business") == business), ["category"], bands)


def describe(df: DataFrame, descriptions: DataFrame, key: str = "category",
             default: str = fixed.NO_CATEGORY_TEXT) -> DataFrame:
    """Description text of a category, or a default."""
    dim = descriptions.select(F.col("category").alias("_key"), F.col("description").alias("_text"))
    return df.join(dim, F.col(key) == F.col("_key"), "left").withColumn(
        "description", F.coalesce("_text", F.lit(default))).drop("_key", "_text")


def describe_levels(df: DataFrame, descriptions: DataFrame, category: str = "main_business", subcategory: str = "category") -> DataFrame:
    """Description texts of a category and of its subcategory, each with its own default."""
    with_sub = describe(df, descriptions, subcategory, fixed.NO_SUBCATEGORY_TEXT).withColumnRenamed("description", "sub_description")
    return describe(with_sub, descriptions, category)


def business_summary(listings: DataFrame, first: str = "Data", second: str = "Drug") -> DataFrame:
    """Vendors per main business, those with the other business on the side, and their share."""
    both = marts.overlap(marts.activity_flags(listings, first, second)).scalar()
    counted = marts.distinct_by(listings, ["main_business"], "vendor", "n_vendors")
    side = F.when(F.col("main_business").isin(first, second), both)
    return counted.withColumn("side_count", side).withColumn(
        "side_pct", F.try_divide(side.cast("double") * 100, F.col("n_vendors").cast("double")))
