"""Page corpora (A1, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listing_analytics.functions.urls import url_key


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages of a Parquet table as (page_id, url, url_hash, html)."""
    return spark.read.parquet(path).select("page_id", "url", url_key(F.col("url")).alias("url_hash"), "html")


def read_page_files(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Saved ``*.html`` files named by URL hash as (page_id, path, url_hash, html, modified).

    ``html`` is null where the bytes are not valid in the encoding; extraction rejects such pages.
    ``page_id`` is a hash of the path, so that it does not depend on the layout of the scan.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.html")
             .option("recursiveFileLookup", "true").load(path))
    if encoding.upper() in ("UTF-8", "UTF8"):
        html = F.try_validate_utf8(F.col("content").cast("string"))
    else:
        html = F.decode(F.col("content"), encoding)
    return files.select(
        F.xxhash64("path").alias("page_id"),
        "path",
        F.regexp_extract("path", r"([^/]+)\.html\z", 1).alias("url_hash"),
        html.alias("html"),
        F.col("modificationTime").alias("modified"),
    )


def read_labelled(spark: SparkSession, path: str, fmt: str = "binaryFile", text: str = "text") -> DataFrame:
    """Labelled corpus whose label is the name of the directory a file lies in (A4).

    ``fmt`` is ``binaryFile`` for one page per file, or a table format holding a ``text`` column.
    """
    reader = spark.read.format(fmt).option("recursiveFileLookup", "true")
    if fmt == "binaryFile":
        files = reader.option("pathGlobFilter", "*.html").load(path)
        body = F.try_validate_utf8(F.col("content").cast("string"))
    else:
        files = reader.load(path)
        body = F.col(text)
    label = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+\z", 1)
    return files.select(body.alias("text"), label.alias("label"))
