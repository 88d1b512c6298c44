"""Record tables and the category dictionary (A3, A5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_analytics.session import store
from listing_analytics.sources.pieces import Step, read_groups

# A cell: in quotes with doubled quotes inside (what follows the last quote belongs to it), plain, or empty. All loops
# keep what they have taken, so lines of any length need no stack.
_REST = r'[^"]*+(?:""[^"]*+)*+"[^,]*+'
_CELL = rf'(?:"{_REST}|[^",][^,]*+)?+'
_WHOLE = rf"\A{_CELL}(?:,{_CELL})*+\z"
_WHOLE_FROM_INSIDE = rf"\A{_REST}(?:,{_CELL})*+\z"


def _lines(value: Column) -> Step:
    """A line ends inside quotes unless all of its cells are whole."""
    none = F.lit(0)
    return Step(~value.rlike(_WHOLE), ~value.rlike(_WHOLE_FROM_INSIDE), none, none)


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Record CSV files with doubled quotes and line breaks inside cells (A3).

    A file is read by as many tasks as it has blocks; ``source_file`` and ``row_ord`` give the order of its rows. Rows are
    what the built-in reader makes of them: empty lines and the first row with content are left out, short rows end in
    nulls, a line break in quotes is part of the cell, as it is written. Rows may end in line feeds with or without carriage returns. A quote
    that is never closed makes one row of the rest of its file, but for its last line break.
    """
    groups = read_groups(spark, path, "\n", _lines, lambda state, depth: state == 0)
    rows = groups.withColumn("value", F.regexp_replace("value", r"\r\z", "")).filter("value <> ''")
    header = F.broadcast(store(rows.groupBy("source_file").agg(F.min("row_ord").alias("row_ord")), "headers"))  # a row per file
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("value", ddl, {"quote": '"', "escape": '"', "multiLine": "true"})
    return rows.join(header, ["source_file", "row_ord"], "left_anti").select(
        parsed.alias("r"), "source_file", "row_ord").select("r.*", "source_file", "row_ord")


def read_mapping(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    """JSON object(s) of texts as (key, value) rows (A5).

    A file that holds no such object goes to the ``rejects`` folder; without one the read fails.
    """
    parsed = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("source_file")).withColumn(
        "m", F.from_json("value", "map<string,string>"))
    bad = parsed.filter("m is null").select("source_file", "value")
    if rejects is not None:
        bad.write.mode("append").parquet(rejects)
    elif not bad.isEmpty():
        raise ValueError(f"not a dictionary: {bad.first().source_file}")
    return parsed.filter("m is not null").select(F.explode("m").alias("key", "value"))
