"""The link map: JSON export form and the ``edges`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics import schemas
from listing_analytics.sources.pieces import Step, read_groups


def _objects(value: Column) -> Step:
    """What stands before a closing bracket: quotes that no backslash precedes, and opening brackets outside of them."""
    plain = F.regexp_replace(value, r"\\.", "")
    odd = (F.length(plain) - F.length(F.replace(plain, F.lit('"'), F.lit("")))) % 2
    opened = lambda text: F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))
    outside = F.regexp_replace(plain, r'"[^"]*(?:"|\z)', "")
    after = F.regexp_replace(F.regexp_replace(plain, r'\A[^"]*(?:"|\z)', ""), r'"[^"]*(?:"|\z)', "")
    # The bracket that ends the piece closes one unless it is in quotes itself.
    return Step(odd == 1, odd == 0, opened(outside) - F.when(odd == 0, 1).otherwise(0), opened(after) - F.when(odd == 1, 1).otherwise(0))


def read_linkmap(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    """Edges of link-map JSON files: one object in lines of any kind or in a single one, or one object per line.

    A parent without links has one row with a null target, so no page is lost. Text that is no entry of a link map goes to
    the ``rejects`` folder as (source_file, value); without one the read fails. Files are cut at closing brackets, so one
    of any size is read by many tasks; an entry is what lies between two places at the depth of entries.
    """
    groups = read_groups(spark, path, "}", _objects, lambda state, depth: (state == 0) & (depth <= 1))
    # Between entries there are commas, blanks and the brackets of the objects that hold them.
    entries = groups.withColumn("value", F.regexp_replace("value", r"\A[\s,{}]+", "")).filter("value <> ''")
    parsed = entries.withColumn("m", F.from_json(F.concat(F.lit("{"), "value", F.lit("}}")), schemas.LINK_MAP))
    # A cut entry is read as far as it goes: as a page of which nothing is known.
    whole = F.col("m").isNotNull() & ~F.exists(F.map_values("m"), lambda p: p["original"].isNull() & p["children"].isNull())
    bad = parsed.filter(~F.coalesce(whole, F.lit(False))).select("source_file", F.regexp_replace("value", r"\s+\z", "").alias("value"))
    if rejects is not None:
        bad.write.mode("append").parquet(rejects)
    elif not bad.isEmpty():
        raise ValueError(f"not a link map: {bad.first().source_file}")
    parents = parsed.filter(whole).select(F.explode("m").alias("src_hash", "page"))
    return parents.select(
        "src_hash", F.col("page.original").alias("src_url"),
        F.explode_outer("page.children").alias("dst_hash", "dst_url"))


def linkmap_lines(edges: DataFrame) -> DataFrame:
    """One JSON object per parent page: ``{hash: {original, children: {hash: url}}}``.

    The links of one page are bounded by that page, so they may be gathered in one row; the map
    as a whole is never gathered.
    """
    child = F.when(F.col("dst_hash").isNotNull(), F.struct("dst_hash", "dst_url"))
    grouped = edges.groupBy("src_hash", "src_url").agg(
        F.map_from_entries(F.array_sort(F.collect_set(child))).alias("children"))
    page = F.struct(F.col("src_url").alias("original"), "children")
    return grouped.select(F.to_json(F.create_map(F.col("src_hash"), page)).alias("value"))


def write_linkmap(edges: DataFrame, path: str) -> None:
    """Export the link map as JSON lines (A9); each line is itself a valid map."""
    linkmap_lines(edges).write.mode("overwrite").text(path)


def original_urls(edges: DataFrame) -> DataFrame:
    """(url_hash, original) lookup table; of several URLs for one hash the smallest is kept."""
    return edges.groupBy(F.col("src_hash").alias("url_hash")).agg(F.min("src_url").alias("original"))
