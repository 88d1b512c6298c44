"""Challenge-page detection.

The model is complement naive Bayes over word counts: a table of weights per word, with which pages are scored by a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listing_analytics import fixed
from listing_analytics.functions import text as tx
from listing_analytics.operators.term_scores import score_texts, terms_of
from listing_analytics.session import store
from listing_analytics.sources.sinks import split_accept_reject

CHALLENGE = "captcha"


def match_phrases(df: DataFrame, col: str, phrases: Sequence[str] = tuple(fixed.CHALLENGE_PHRASES)) -> DataFrame:
    """Flag rows that contain any phrase, upper or lower case."""
    lowered = F.lower(F.col(col))
    hit = reduce(lambda a, b: a | b, [lowered.contains(p.lower()) for p in phrases])
    return df.withColumn("hit", F.coalesce(hit, F.lit(False)))


def word_counts(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Bag of words per row as (key, token, tf)."""
    return terms_of(df, [key], text).withColumnRenamed("term", "token")


def term_weights(corpus: DataFrame, smoothing: float = 1.0) -> DataFrame:
    """Complement naive Bayes weights (term, w_challenge, w_content) of a labelled corpus (D3).

    The weight of a class is ``-ln`` of the smoothed share a word has in the *other* class.
    """
    is_challenge = (F.col("label") == CHALLENGE).cast("bigint")
    counts = store(corpus.select(is_challenge.alias("_c"), F.explode(tx.tokens(F.col("text"))).alias("term")).groupBy(
        "term").agg(F.sum("_c").alias("n_challenge"), F.sum(1 - F.col("_c")).alias("n_content")), "term-counts")
    total = lambda col: counts.select(
        F.sum(col).cast("double") + smoothing * F.count(F.lit(1)).cast("double")).scalar()
    weight = lambda col: -F.log((F.col(col).cast("double") + smoothing) / total(col))
    return counts.select("term", weight("n_content").alias("w_challenge"), weight("n_challenge").alias("w_content"))


def score_by_weights(df: DataFrame, weights: DataFrame, text: str = "text") -> DataFrame:
    """Add ``is_challenge`` (D4): the columns of ``df`` and one row for each of its rows.

    Rows are judged by their text, so repeated and null keys stay apart. Without any known word it is true.
    """
    sums = {"_c": F.sum(F.col("tf") * F.col("w_challenge")), "_n": F.sum(F.col("tf") * F.col("w_content"))}
    scored = score_texts(df, weights, sums, text)
    return scored.withColumn("is_challenge", F.coalesce("_c", F.lit(0.0)) >= F.coalesce("_n", F.lit(0.0))).drop("_c", "_n")


def detect(df: DataFrame, corpus: DataFrame) -> DataFrame:
    """Score rows with the weights of a labelled corpus, all of whose rows and words count."""
    return score_by_weights(df, store(term_weights(corpus), "term-weights"))


def split_challenges(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(content, challenge) pages of one scoring."""
    return split_accept_reject(scored, ~F.col("is_challenge"), "challenge page")
