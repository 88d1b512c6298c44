"""Cleaning of the record tables (E1-E14). Everything is a built-in expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_analytics import fixed
from listing_analytics.functions import text as tx


def normalise_nulls(df: DataFrame, tokens: Sequence[str] = tuple(fixed.NA_TOKENS),
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Missing-value texts become null, NaN doubles too."""
    fixes = {}
    for field in df.schema.fields:
        if columns is not None and field.name not in columns:
            continue
        col = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            fixes[field.name] = F.when(~col.isin(*tokens), col)
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            fixes[field.name] = F.when(~F.isnan(col), col)
    return df.withColumns(fixes) if fixes else df


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """First row per key in ``order``; null keys form one group.

    Catalyst turns ``row_number = 1`` into a group limit that runs before the shuffle, so a key
    holding a large part of the rows sends one row per task, not all of them.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def union_sites(*frames: DataFrame) -> DataFrame:
    """Row-wise union by column name."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def project(df: DataFrame, spec: dict[str, str] | Sequence[str]) -> DataFrame:
    """Keep the named columns; a mapping also renames them."""
    if isinstance(spec, dict):
        return df.select([F.col(old).alias(new) for old, new in spec.items()])
    return df.select(*spec)


def to_usd(df: DataFrame, price: str, currency: str, rates: DataFrame, out: str = "price_usd") -> DataFrame:
    """Convert by the daily rates, rounded to cents; a price in exact ``USD`` passes as it is (E5).

    The conversion runs in decimals, because binary rounding differs between engines. A currency
    without a rate gives null, see :func:`unknown_currency`.
    """
    per_eur = rates.select(F.col("currency").alias("_code"), F.col("per_eur").alias("_rate"))
    usd = rates.filter(F.col("currency") == "USD").select(F.max("per_eur")).scalar()
    value = F.col(price).try_cast("double")
    factor = F.try_divide(usd, F.col("_rate"))
    exact = F.round(value.try_cast("decimal(30,8)") * factor.try_cast("decimal(18,12)"), 2).cast("double")
    # Beyond 10^22 a double has no cents left to round.
    cents = F.coalesce(exact, value * factor)
    joined = df.withColumn("_cur", tx.strip(F.col(currency))).join(
        per_eur, F.col("_cur") == F.col("_code"), "left")
    return joined.withColumn(
        out, F.when(F.col(currency) == "USD", value).otherwise(cents)
    ).drop("_cur", "_code", "_rate")


def unknown_currency(converted: DataFrame, price: str, currency: str, out: str = "price_usd") -> DataFrame:
    """Rejected amounts of :func:`to_usd`: number of rows per currency without a rate."""
    lost = F.col(price).isNotNull() & F.col(currency).isNotNull() & F.col(out).isNull()
    return converted.filter(lost).groupBy(currency).agg(F.count(F.lit(1)).alias("n"))


def fill(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace nulls by constants."""
    return df.na.fill(values)


def safe_cast(col: Column, to: str) -> Column:
    """Cast that gives null instead of failing the job."""
    return col.try_cast(to)


def min_max(df: DataFrame, col: str, out: str) -> DataFrame:
    """Scale to [0, 1] over the whole table; a constant column gives null.

    Both bounds are scalar subqueries that Catalyst merges into one aggregate: no window without
    a partition key, no cross join.
    """
    low = df.select(F.min(col)).scalar()
    high = df.select(F.max(col)).scalar()
    value = F.col(col).cast("double")
    return df.withColumn(out, F.try_divide(value - low.cast("double"),
                                           high.cast("double") - low.cast("double")))


# Order of rows of record files; extracted tables have ``page_id`` instead.
FILE_ORDER = ("source_file", "row_ord")


def clean_products(sites: Sequence[DataFrame], rates: DataFrame, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """Raw product tables of the sites to one priced table."""
    firsts = [dedup_keep_first(normalise_nulls(s), ["name"], order) for s in sites]
    merged = union_sites(*firsts).select(
        "name", "category", "price", "currency", "description", "vendor", "marketplace")
    return to_usd(merged, "price", "currency", rates).select(
        "name", "category", "price_usd", "description", "vendor", "marketplace")


def clean_vendors(sites: Sequence[DataFrame], order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """Raw vendor tables of the sites to one table with a scaled review count."""
    firsts = [dedup_keep_first(normalise_nulls(s), ["name"], order) for s in sites]
    merged = fill(union_sites(*firsts), {"review_count": "0"}).select(
        "name",
        tx.blank_placeholder(F.col("about_text")).alias("about_text"),
        tx.last_number(F.col("review_count")).alias("review_count"),
        "marketplace",
    )
    return min_max(merged, "review_count", "review_count_normalized")


def clean_reviews(with_words: DataFrame, with_stars: DataFrame, rates: DataFrame) -> DataFrame:
    """Raw review tables (one with sentiment words, one with stars) to one table."""
    stars = normalise_nulls(with_stars)
    merged = union_sites(
        normalise_nulls(with_words),
        stars.withColumn("rating", tx.star_to_sentiment(F.col("rating"))),
    ).withColumn("price_paid", tx.first_integer(F.col("price_paid")))
    return to_usd(merged, "price_paid", "currency", rates, "price_paid_usd").select(
        "vendor", "product", "rating", "text", "price_paid_usd")
