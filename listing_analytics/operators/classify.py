"""Broad category of a listing: dictionary first, text classifier for the rest."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from listing_analytics.functions import text as tx
from listing_analytics.operators.order import part_starts, place
from listing_analytics.operators.regression import RowMatrix, TermMatrix, fit_by_rows, fit_by_terms, idf_of, own_class
from listing_analytics.operators.term_scores import score_texts, term_lists, terms_of
from listing_analytics.session import store


def bounded(labelled: DataFrame, max_rows: int) -> DataFrame:
    """All labelled rows, or those ``max_rows`` whose contents have the smallest hashes; no query and no model here uses it.

    The greatest hash that stays is found digit by digit, by counts of at most 65,536 groups; rows of that one hash are
    copies of each other, of which as many stay as are wanted.
    """
    order = F.xxhash64(*labelled.columns).bitwiseXOR(F.lit(-(1 << 63)))  # ascending as an unsigned number
    hashes = store(labelled.select(order.alias("h")), "label-hashes")
    if hashes.count() <= max_rows:
        return labelled
    digit = lambda level: F.shiftrightunsigned("h", 48 - 16 * level).bitwiseAND(F.lit(0xFFFF))
    cut, wanted, left = 0, max_rows, hashes
    for level in range(4):
        counts = left.groupBy(digit(level).alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()
        for d, n in sorted((r["d"], r["n"]) for r in counts):
            if wanted <= n:
                break
            wanted -= n
        left, cut = left.filter(digit(level) == d), cut << 16 | d
    last = F.lit(cut - (1 << 64) if cut >> 63 else cut)
    signed = lambda h: h.bitwiseXOR(F.lit(-(1 << 63)))
    copies = labelled.filter(order == last).limit(1).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(wanted)))).drop("_copy")
    return labelled.filter(signed(order) < signed(last)).unionByName(copies)


def map_category(df: DataFrame, mapping: DataFrame, category: str = "category") -> DataFrame:
    """Broad category by the title-cased category, null when unknown (F2).

    Keys that are equal after title-casing count once; the last value in key order wins. Different categories are
    title-cased once each. The joins carry no hint: adaptive execution broadcasts a side that it has measured as small.
    """
    dim = (mapping.select(tx.title_case(F.col("key")).alias("_key"), "key", "value")
           .groupBy("_key").agg(F.max_by("value", "key").alias("broad_category")))
    named = df.select(F.col(category).alias("_category")).filter("_category is not null").distinct().withColumn(
        "_key", tx.title_case(F.col("_category"))).join(dim, "_key").select("_category", "broad_category")
    return df.join(named, F.col(category) == F.col("_category"), "left").drop("_category")


def split_labelled(df: DataFrame, label: str = "broad_category") -> tuple[DataFrame, DataFrame]:
    """Rows with and without a label."""
    return df.filter(F.col(label).isNotNull()), df.filter(F.col(label).isNull())


@dataclass(frozen=True)
class CategoryModel:
    """Labels in order, an intercept per score and a stored table (term, idf, coefficients) with a coefficient per score.

    Two labels have one score, that of the second; one label has none.
    """

    labels: list[str]
    intercepts: list[float]
    terms: DataFrame
    stop_words: tuple[str, ...]


def _weighed(tf: DataFrame, n: Column, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(keys, term, weight) and (term, idf) of term counts, with idf = ln((1+n)/(1+df)) + 1 and rows of length one."""
    idf = tf.groupBy("term").agg((F.log((n + 1) / (F.count(F.lit(1)) + 1)) + 1).alias("idf"))
    raw = tf.join(idf, "term").select(*keys, "term", (F.col("tf") * F.col("idf")).alias("raw"))
    length = raw.groupBy(*keys).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length"))
    return raw.join(length, list(keys)).select(*keys, "term", (F.col("raw") / F.col("length")).alias("weight")), idf


def default_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def fit_category_model(labelled: DataFrame, stop_words: Sequence[str] | None = None,
                       text: str = "text", label: str = "broad_category",
                       tol: float = 1e-7, max_passes: int = 1000) -> CategoryModel:
    """TF-IDF and logistic regression with the same objective as C = 1 (F5, F6, F7), fitted on all labelled rows.

    Two categories give the binomial form, more the multinomial one. The search works in the space of the rows or in that
    of the terms, whichever is smaller; the driver holds some vectors of that length for each category, and the rows and
    terms themselves stay in tables. The search ends when the mean gradient is no longer than ``tol``.
    """
    stop_words = default_stop_words() if stop_words is None else list(stop_words)
    known = labelled.select(F.col(label).alias("label"), F.col(text).alias("text")).filter("label is not null")
    rows = store(term_lists(known.withColumn("row_id", F.monotonically_increasing_id()), ["row_id", "label"], "text", stop_words), "category-rows")
    counts = rows.groupBy("label", F.shiftright("row_id", 33).alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    if not counts:
        raise ValueError("no labelled rows")
    labels, n = sorted({r["label"] for r in counts}), sum(r["n"] for r in counts)
    scores = len(labels) if len(labels) > 2 else len(labels) - 1
    rows = rows.withColumn("label", F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label")) - 1)
    # Only where the search works depends on the estimate.
    words = rows.select(F.explode("terms.term").alias("term")).agg(F.approx_count_distinct("term")).first()[0]
    found = _fit_by_rows(rows, counts, scores, tol, max_passes) if n <= words else _fit_by_terms(rows, n, scores, tol, max_passes)
    return CategoryModel(labels, found[1].tolist(), found[0], tuple(stop_words))


def _fit_by_rows(rows: DataFrame, counts: list[Row], scores: int, tol: float, max_passes: int) -> tuple[DataFrame, np.ndarray]:
    parts: Counter[int] = Counter()
    for r in counts:
        parts[r["part"]] += r["n"]
    row = place(part_starts(sorted(parts.items()))).cast("int").alias("row")
    kinds = rows.select(row, F.col("label").cast("int").alias("label")).toArrow()
    at = np.empty(kinds.num_rows, np.int32)
    at[kinds.column("row").to_numpy()] = kinds.column("label").to_numpy()
    with TermMatrix(rows.select(row, F.inline("terms")), len(at)) as matrix:
        alpha, intercepts = fit_by_rows(matrix.product, own_class(at, scores), tol, max_passes)
        return store(matrix.transposed(alpha), "category-terms"), intercepts


def _fit_by_terms(rows: DataFrame, n: int, scores: int, tol: float, max_passes: int) -> tuple[DataFrame, np.ndarray]:
    count = rows.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n")).toArrow().combine_chunks()
    term, idf = pa.concat_arrays(count.column("term").chunks or [pa.array([], pa.string())]).cast(pa.string()), idf_of(count.column("n").to_numpy(), n)
    with RowMatrix(rows, term, idf, scores) as matrix:
        coefficients, intercepts = fit_by_terms(matrix.slopes, len(term), scores, n, tol, max_passes)
    ends = pa.array(np.arange(len(term) + 1, dtype=np.int32) * scores)
    table = pa.table({"term": term, "idf": pa.array(idf), "coefficients": pa.ListArray.from_arrays(ends, pa.array(coefficients.ravel()))})
    return store(rows.sparkSession.createDataFrame(table, "term string, idf double, coefficients array<double>"), "category-terms"), intercepts


def category_scores(df: DataFrame, model: CategoryModel, text: str = "text", out: str = "scores") -> DataFrame:
    """``df`` with its scores per label, null terms and unknown words counting nothing (F8)."""
    w = F.col("tf") * F.col("idf")
    sums = {"_length": F.sqrt(F.sum(w * w))} | {
        f"_s{i}": F.sum(w * F.col("coefficients")[i]) for i in range(len(model.intercepts))}
    scored = score_texts(df, model.terms, sums, text, model.stop_words)
    score = [F.coalesce(F.col(f"_s{i}") / F.col("_length"), F.lit(0.0)) + b for i, b in enumerate(model.intercepts)]
    score = [F.lit(0.0)] * (len(model.labels) - len(score)) + score
    return scored.withColumn(out, F.array(*score)).drop(*sums)


def predict_category(df: DataFrame, model: CategoryModel, text: str = "text") -> DataFrame:
    """Add ``predicted_broad_category``, the first label with the greatest score (F8)."""
    name = F.array(*[F.lit(x) for x in model.labels])
    best = F.array_position("_scores", F.array_max("_scores")).cast("int")
    return category_scores(df, model, text, "_scores").withColumn("predicted_broad_category", F.element_at(name, best)).drop("_scores")


def classify(df: DataFrame, mapping: DataFrame, stop_words: Sequence[str] | None = None) -> DataFrame:
    """Every listing with its broad category and whether it was predicted (F9). ``df`` is read more than once."""
    mapped = map_category(df, mapping).withColumn(
        "text", tx.listing_text(F.col("name"), F.col("description")))
    model = fit_category_model(split_labelled(mapped)[0], stop_words)
    return predict_category(mapped, model).select(
        *[c for c in df.columns if c != "broad_category"],
        F.coalesce("broad_category", "predicted_broad_category").alias("broad_category"),
        F.col("broad_category").isNull().alias("is_predicted"))


def tfidf_weights(df: DataFrame, key: str, text: str = "text", stop_words: Sequence[str] = ()) -> DataFrame:
    """TF-IDF weights as (key, term, weight), for a vocabulary of any size."""
    n = df.select(F.count(F.lit(1)).cast("double")).scalar()
    return _weighed(terms_of(df, [key], text, stop_words), n, [key])[0]
