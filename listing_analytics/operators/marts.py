"""Aggregate tables over listings, vendors and reviews.

Groupings leave out null keys, as the consumers of these tables expect.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listing_analytics import fixed
from listing_analytics.functions import text as tx


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def main_business(df: DataFrame, groups: dict[str, Sequence[str]] = fixed.BUSINESS_GROUPS,
                  category: str = "broad_category", out: str = "main_business",
                  other: str = fixed.OTHER_BUSINESS) -> DataFrame:
    """Main business of a listing from its broad category; unknown and null are ``Other`` (G1)."""
    names = list(groups)
    rule = F.when(F.col(category).isin(*groups[names[0]]), names[0])
    for name in names[1:]:
        rule = rule.when(F.col(category).isin(*groups[name]), name)
    return df.withColumn(out, rule.otherwise(other))


def relabel(df: DataFrame, labels: dict[str, str] = fixed.BUSINESS_LABELS, col: str = "main_business") -> DataFrame:
    """Rename single values of a column."""
    return df.replace(labels, subset=[col])


def null_out(df: DataFrame, col: str = "category", values: Sequence[str] = tuple(fixed.VAGUE_CATEGORIES)) -> DataFrame:
    """Values that carry no information become null."""
    return df.withColumn(col, F.when(~F.col(col).isin(*values), F.col(col)))


def band_column(value: Column, bands: Sequence[tuple[str, float, float]] = tuple(fixed.PRICE_BANDS)) -> Column:
    """Position of the left-closed band a value falls in; outside, infinite, null give null."""
    inside = [(value >= lo) & (value < hi) & ~F.isnan(value) for _, lo, hi in bands]
    rule = F.when(inside[0], 0)
    for position, test in enumerate(inside[1:], start=1):
        rule = rule.when(test, position)
    return rule


def price_band(df: DataFrame, bands: Sequence[tuple[str, float, float]] = tuple(fixed.PRICE_BANDS),
               col: str = "price_usd", out: str = "price_range") -> DataFrame:
    """Band label and ``band_order`` of a price."""
    labels = F.array(*[F.lit(label) for label, _, _ in bands])
    return df.withColumn("band_order", band_column(F.col(col), bands)).withColumn(
        out, F.get(labels, F.col("band_order")))


def listing_view(df: DataFrame) -> DataFrame:
    """Columns the dashboard reads."""
    return df.select("name", "main_business", "vendor", "category", "price_usd", "broad_category")


def distinct_by(df: DataFrame, keys: Sequence[str], col: str, out: str = "n", approx: bool = False) -> DataFrame:
    """Number of different values per group, exact or as a sketch."""
    count = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return _known(df, [*keys]).groupBy(*keys).agg(count.alias(out))


def count_matrix(df: DataFrame, row: str, col: str, values: Sequence[str], total: str | None = None) -> DataFrame:
    """Counts as a matrix with one column per listed value, zero-filled (G3); the row total counts all values.

    A row whose values are all unlisted stays, with zeros.
    """
    counts = [F.count_if(F.col(col) == value).alias(value) for value in values]
    every = [] if total is None else [F.count(F.lit(1)).alias(total)]
    return _known(df, [row, col]).groupBy(row).agg(*counts, *every)


def activity_flags(df: DataFrame, first: str = "Data", second: str = "Drug") -> DataFrame:
    """Per vendor: active in the first and in the second business."""
    return _known(df, ["vendor", "broad_category"]).groupBy("vendor").agg(
        F.bool_or(F.col("main_business") == first).alias("in_first"),
        F.bool_or(F.col("main_business") == second).alias("in_second"),
    )


def overlap(flags: DataFrame) -> DataFrame:
    """Number of vendors active in both businesses."""
    return flags.filter("in_first and in_second").agg(F.count(F.lit(1)).alias("n_both"))


def overlap_share(flags: DataFrame) -> DataFrame:
    """Vendors per business, in both, and the overlap as percentage of each, in one pass."""
    counted = flags.agg(
        F.count_if("in_first").alias("n_first"),
        F.count_if("in_second").alias("n_second"),
        F.count_if(F.expr("in_first and in_second")).alias("n_both"),
    )
    share = lambda total: F.try_divide(F.col("n_both").cast("double") * 100, F.col(total).cast("double"))
    return counted.withColumns({"pct_first": share("n_first"), "pct_second": share("n_second")})


def statements(shares: DataFrame, first: str, second: str) -> DataFrame:
    """The overlap summary as sentences, one row each (G7). ``first`` and ``second`` name the products of the businesses."""
    lines = {
        f"{first} vendors": F.format_string(f"%d vendors mainly sell {first} products", "n_first"),
        f"{second} vendors": F.format_string(f"%d vendors mainly sell {second} products", "n_second"),
        "vendors of both": F.format_string("%d vendors sell both kinds of products", "n_both"),
        f"share of {first} vendors": F.format_string(f"%.2f%% of the vendors of {first} products sell {second} products, too", "pct_first"),
        f"share of {second} vendors": F.format_string(f"%.2f%% of the vendors of {second} products sell {first} products, too", "pct_second"),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("statement")) for k, v in lines.items()])
    return shares.select(F.inline(rows))


def count_by(df: DataFrame, keys: Sequence[str], out: str = "n", ordered: bool = False) -> DataFrame:
    """Rows per group (G8, G20, G22, G28); optionally largest first."""
    counted = _known(df, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return counted.orderBy(F.desc(out), *keys) if ordered else counted


def mean_by(df: DataFrame, keys: Sequence[str], col: str, out: str) -> DataFrame:
    """Mean per group; groups without any value stay, as null."""
    return _known(df, keys).groupBy(*keys).agg(F.avg(col).alias(out))


def top_k(df: DataFrame, by: str, ties: Sequence[str], k: int) -> DataFrame:
    """The ``k`` largest rows without a full sort."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def mean_paid_per_product(reviews: DataFrame, k: int = 20) -> DataFrame:
    """Dearest products by mean price paid; rows without a price are left out first."""
    means = mean_by(reviews.na.drop(subset=["price_paid_usd"]), ["product"], "price_paid_usd", "mean_paid")
    return top_k(means, "mean_paid", ["product"], k)


def top_k_per_group(df: DataFrame, group: str, item: str, k: int, share: str | None = None) -> DataFrame:
    """Most frequent items of each group (G13), optionally with their share of that top.

    Counts are combined before the shuffle and the rank filter is pushed below it, so a group
    with most of the items still sends only ``k`` rows per task.
    """
    counted = count_by(df, [group, item])
    ranked = counted.withColumn("rank", F.row_number().over(
        Window.partitionBy(group).orderBy(F.desc("n"), item))).filter(F.col("rank") <= k)
    if share is None:
        return ranked
    whole = F.sum("n").over(Window.partitionBy(group)).cast("double")
    return ranked.withColumn(share, F.col("n").cast("double") * 100 / whole)


def band_counts(df: DataFrame, bands: Sequence[tuple[str, float, float]] = tuple(fixed.PRICE_BANDS)) -> DataFrame:
    """Rows per band in band order; empty bands stay with 0."""
    counted = price_band(df, bands).filter("band_order is not null").groupBy("band_order").agg(
        F.count(F.lit(1)).alias("_n"))
    rows = F.array(*[F.struct(F.lit(i).alias("band_order"), F.lit(label).alias("price_range"))
                     for i, (label, _, _) in enumerate(bands)])
    every = df.sparkSession.range(1).select(F.inline(rows))
    return every.join(counted, "band_order", "left").select(
        "band_order", "price_range", F.coalesce("_n", F.lit(0)).alias("n")).orderBy("band_order")


def products_grouped(df: DataFrame, bands: Sequence[tuple[str, float, float]] = tuple(fixed.PRICE_BANDS)) -> DataFrame:
    """Listings per (main business, broad category, band), no zero rows."""
    banded = price_band(df, bands).select(
        "main_business", F.col("broad_category").alias("category"), "price_range")
    return count_by(banded, ["main_business", "category", "price_range"], "product_count")


def _finite(df: DataFrame, col: str) -> DataFrame:
    value = F.col(col).cast("double")
    return df.select(value.alias("_x")).filter(
        F.col("_x").isNotNull() & ~F.isnan("_x") & (F.abs("_x") != float("inf")))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram between minimum and maximum, last bin closed, empty bins kept."""
    data = _finite(df, col)
    low, high = data.select(F.min("_x")).scalar(), data.select(F.max("_x")).scalar()
    # A constant column gets a range of width one around its value.
    lo = F.when(low == high, low - 0.5).otherwise(low)
    hi = F.when(low == high, high + 0.5).otherwise(high)
    width = (hi - lo) / bins
    slot = F.least(F.floor((F.col("_x") - lo) / width), F.lit(bins - 1).cast("bigint"))
    counted = data.groupBy(slot.alias("id")).agg(F.count(F.lit(1)).alias("_n"))
    return df.sparkSession.range(bins).join(counted, "id", "left").select(
        (F.col("id") + 1).cast("int").alias("bin"),
        (lo + F.col("id") * width).alias("bin_from"),
        (lo + (F.col("id") + 1) * width).alias("bin_to"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


_MOMENTS = 13  # of a cell; the next term is at most 1e-17 of a kernel's peak


def density(df: DataFrame, col: str, points: int = 200, bins: int | None = None) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid from minimum to maximum.

    Values are gathered into cells of a quarter of a bandwidth, of which only moments are kept: sums of powers of the
    distance from the middle. The kernel around the middle is a series in those powers; with ``_MOMENTS`` of them what is
    left out is below double precision. So a value costs some products, and only the cells meet the grid. With ``bins``
    the curve is also scaled to the counts of that histogram. Fewer than two different values have no curve.
    """
    data = _finite(df, col)
    stat = lambda column: data.select(column).scalar()
    low, high, n = stat(F.min("_x")), stat(F.max("_x")), stat(F.count("_x").cast("double"))
    bandwidth = F.nullif(stat(F.stddev_samp("_x")) * F.pow(n, F.lit(-0.2)), F.lit(0.0))
    step = (high - low) / (points - 1)
    cell = F.floor((F.col("_x") - low) / bandwidth * 4)
    placed = data.select(cell.alias("cell"), ((F.col("_x") - low) / bandwidth - (cell + 0.5) / 4).alias("d")).filter("cell is not null")
    powers = [F.lit(1.0)]
    for _ in range(_MOMENTS):
        powers.append(powers[-1] * F.col("d"))
    cells = placed.groupBy("cell").agg(*[F.sum(p).alias(f"m{k}") for k, p in enumerate(powers)])
    series = [reduce(lambda a, b: a + b, terms) for terms in _series()]
    cells = cells.select(((F.col("cell") + 0.5) / 4).alias("middle"), *[c.alias(f"c{j}") for j, c in enumerate(series)])
    # Farther away than 39 bandwidths the kernel is zero in double precision.
    wide = step / bandwidth
    near = F.sequence(F.greatest(F.lit(0), F.ceil((F.col("middle") - 39) / wide)).cast("int"),
                      F.least(F.lit(points - 1), F.floor((F.col("middle") + 39) / wide)).cast("int"))
    met = cells.filter(F.ceil((F.col("middle") - 39) / wide) <= F.floor((F.col("middle") + 39) / wide)).withColumn(
        "point", F.explode(near)).withColumn("u", F.col("point") * wide - F.col("middle"))
    polynomial = reduce(lambda done, j: done * F.col("u") + F.col(f"c{j}"), range(_MOMENTS - 1, -1, -1), F.col(f"c{_MOMENTS}"))
    sums = met.groupBy("point").agg(F.sum(F.exp(F.col("u") * F.col("u") * -0.5) * polynomial).alias("_s"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point")).filter(bandwidth.isNotNull())
    value = F.coalesce("_s", F.lit(0.0)) / (n * bandwidth * F.sqrt(2 * F.pi()))
    curve = grid.join(sums, "point", "left").select("point", (low + F.col("point") * step).alias("x"), value.alias("density"))
    if bins is None:
        return curve
    return curve.withColumn("scaled", F.col("density") * n * ((high - low) / bins))


def _series() -> list[list[Column]]:
    """For each power of the distance from a cell its terms: moment k over k! times the k-th Hermite polynomial."""
    hermite = [[1], [0, 1]]
    for k in range(1, _MOMENTS):
        hermite.append([(hermite[k][j - 1] if j else 0) - k * (hermite[k - 1][j] if j < len(hermite[k - 1]) else 0) for j in range(k + 2)])
    return [[F.col(f"m{k}") * (float(hermite[k][j]) / math.factorial(k)) for k in range(j, _MOMENTS + 1) if hermite[k][j]]
            for j in range(_MOMENTS + 1)]


def term_counts(df: DataFrame, col: str, stop_words: Sequence[str] | None = None, k: int | None = 200) -> DataFrame:
    """Most frequent terms of all texts without stop words.

    The default stop words are the English list that ships with Spark.
    """
    if stop_words is None:
        from pyspark.ml.feature import StopWordsRemover

        stop_words = StopWordsRemover.loadDefaultStopWords("english")
    terms = df.select(F.explode(tx.tokens(F.col(col))).alias("term"))
    if stop_words:
        terms = terms.filter(~F.col("term").isin(*stop_words))
    counted = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return counted if k is None else top_k(counted, "n", ["term"], k)
