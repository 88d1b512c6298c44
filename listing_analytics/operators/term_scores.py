"""Scoring texts by weights of their terms, for vocabularies of any size.

A model is a table with a row per term. Terms of each text are counted in the task that reads it and stored as lists; heavy
terms, of which there are never more than ``HEAVY``, get their weights by a broadcast and are summed per text before anything
is moved, all others by a join on the term. Nothing of the size of the vocabulary or of the texts meets in one place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_analytics.functions import text as tx
from listing_analytics.session import ship_package, store

HEAVY = 1 << 16  # a term is heavy if it makes up one of HEAVY parts of all (text, term) pairs


def text_name(text: Column) -> Column:
    """Name of a text; equal texts are scored once, and rows need no key of their own. A null text counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def terms_of(df: DataFrame, keys: Sequence[str], text: str, stop_words: Sequence[str] = ()) -> DataFrame:
    """(keys, term, tf): how often each term is in a text."""
    terms = df.select(*keys, F.explode(tx.tokens(F.col(text))).alias("term"))
    if stop_words:
        terms = terms.filter(~F.col("term").isin(*stop_words))
    return terms.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


_ROWS = 1024  # texts whose terms are counted at once


def _count(words: pa.ListArray, stop_words: Sequence[str]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Number of different terms of each text, these terms, and how often each is there."""
    lengths = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
    coded = words.flatten().dictionary_encode()
    code, row = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(words)), lengths)
    if stop_words:
        stays = ~pc.is_in(coded.dictionary, pa.array(stop_words, pa.string())).to_numpy(zero_copy_only=False)[code]
        code, row = code[stays], row[stays]
    size = max(len(coded.dictionary), 1)
    pairs, tf = np.unique(row * size + code, return_counts=True)
    return np.bincount(pairs // size, minlength=len(words)), coded.dictionary.take(pa.array(pairs % size)), tf


def term_lists(df: DataFrame, keys: Sequence[str], text: str, stop_words: Sequence[str] = ()) -> DataFrame:
    """(keys, terms): the different terms of every row with how often each is there, counted without a shuffle.

    Unlike :func:`terms_of`, rows of equal keys stay apart. A null text has no terms.
    """
    ship_package(df.sparkSession)
    words = df.select(*keys, tx.tokens(F.col(text)).alias("words"))
    item = T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
    schema = T.StructType([*(words.schema[k] for k in keys), T.StructField("terms", T.ArrayType(item))])
    stop_words = list(stop_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                counts, terms, tf = _count(part.column(len(keys)), stop_words)
                pairs = pa.StructArray.from_arrays([terms, pa.array(tf.astype(np.int64))], ["term", "tf"])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pairs)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keys))), lists], names=schema.fieldNames())

    return words.mapInArrow(run, schema)


def stored_lists(df: DataFrame, text: str = "text", stop_words: Sequence[str] = ()) -> DataFrame:
    """(name, row, terms) of every row's text, written once, by the tasks that read the texts.

    ``row`` tells copies of a text apart.
    """
    texts = df.select(text_name(F.col(text)).alias("name"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    return store(term_lists(texts, ["name", "row"], "text", stop_words), "text-terms")


def stored_terms(df: DataFrame, text: str = "text", stop_words: Sequence[str] = ()) -> DataFrame:
    """(name, row, term, tf) of every row's text, from stored lists."""
    return stored_lists(df, text, stop_words).select("name", "row", F.inline("terms"))


def join_weights(terms: DataFrame, weights: DataFrame) -> DataFrame:
    """Stored ``terms`` (term and other columns) with the columns of ``weights`` (term, ...); unknown terms go.

    The heavy terms are counted in what is scored, not in what the weights come from.
    """
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("_n"))
    heavy = store(counts.filter(F.col("_n") * HEAVY >= terms.count()).select("term"), "heavy-terms")
    hot = store(weights.join(F.broadcast(heavy), "term"), "heavy-weights")
    near = terms.join(F.broadcast(hot), "term")
    far = terms.join(F.broadcast(heavy), "term", "left_anti").join(weights, "term")
    return near.unionByName(far)


def score_texts(df: DataFrame, weights: DataFrame, sums: dict[str, Column], text: str = "text",
                stop_words: Sequence[str] = ()) -> DataFrame:
    """``df`` with aggregates ``sums`` over the known terms of each row's text; null without any.

    ``sums`` may use ``tf`` and the columns of ``weights``. Rows keep their columns; repeated and null texts get the same
    aggregates each. ``df`` is read twice.
    """
    lists = stored_lists(df, text, stop_words)
    # Pairs are known by their row, a number; the names of texts, which are longer than most terms, are joined to the sums.
    summed = join_weights(lists.select("row", F.inline("terms")), weights).groupBy("row").agg(
        *[value.alias(name) for name, value in sums.items()])
    found = lists.select("name", "row").join(summed, "row").drop("row").dropDuplicates(["name"])
    return df.withColumn("_name", text_name(F.col(text))).join(
        found.withColumnRenamed("name", "_name"), "_name", "left").drop("_name")
