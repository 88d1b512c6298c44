"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance; the covariance is shrunk towards the diagonal of the pooled one, so a statistic
that never varies in one class cannot decide alone. The Cholesky factors are inverted once, when the model is fitted; a
score is the logistic of the difference of Mahalanobis log-densities plus the prior log-odds.

Fitting needs only counts, sums and products of the statistics per class, which Spark sums over all labelled rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_analytics.llm.common import as_bytes, prepare, store, table, texts
from listing_analytics.llm.registry import query

SHRINKAGE = 0.05
THRESHOLD = 0.7
NAMES = ["words", "word_length", "distinct", "commonest", "repeats", "upper", "digits", "symbols", "pipes",
         "exclamations", "stops", "high_bytes", "line_length", "repeated_lines"]
D = len(NAMES)

_UPPER, _LOWER, _DIGITS = slice(65, 91), slice(97, 123), slice(48, 58)
_SYMBOLS = np.frombuffer(b"#$%&*+<=>@\\^_`{}~", dtype=np.uint8)


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of a text, in the order of ``NAMES``; of an empty text all are zero."""
    size = len(text)
    if not size:
        return [0.0] * D
    seen = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    words = text.split()
    counts, n = Counter(words), max(1, len(words))
    lines = text.split(b"\n")
    letters = max(1, int(seen[_UPPER].sum() + seen[_LOWER].sum()))
    return [
        math.log1p(len(words)),
        math.log1p(size / n),
        len(counts) / n,
        math.sqrt(max(counts.values(), default=0) / n),
        math.sqrt(sum(map(eq, words, words[1:])) / n),
        math.sqrt(seen[_UPPER].sum() / letters),
        math.sqrt(seen[_DIGITS].sum() / size),
        math.sqrt(seen[_SYMBOLS].sum() / size),
        math.sqrt(seen[124] / size),
        math.sqrt((seen[33] + seen[63]) / size),
        math.sqrt((seen[44] + seen[46]) / size),
        math.sqrt(seen[128:].sum() / size),
        math.log1p(size / len(lines)),
        math.sqrt(1 - len(set(lines)) / len(lines)),
    ]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([statistics(text) for text in as_bytes(column)], dtype=np.float64).reshape(-1, D)


def _lists(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, D, dtype=np.int32)), pa.array(values.ravel()))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists(_matrix(batch.column(1)))], ["doc_id", "stats"])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and stats (array of double) of every row; a null text counts as empty."""
    prepare(docs.sparkSession)
    return texts(docs, id_col, text_col).mapInArrow(_statistics, "doc_id long, stats array<double>")


@dataclass
class Discriminant:
    """Means, inverted Cholesky factors and log-determinants of both classes; ``prior`` is the log-odds of label 1."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    logdets: list[float]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        odds = np.full(len(x), self.prior)
        for sign, mean, factor, logdet in zip((-1, 1), self.means, self.factors, self.logdets):
            z = (x - mean) @ factor.T
            odds -= sign * 0.5 * ((z * z).sum(axis=1) + logdet)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def from_moments(counts: list[float], sums: list[np.ndarray], products: list[np.ndarray], shrinkage: float) -> Discriminant:
    """The model of both classes. With under two rows in a class nothing separates them: every score is the prior's."""
    n = np.array(counts)
    prior = float(np.log((n[1] + 1) / (n[0] + 1)))
    if n.min() < 2:
        return Discriminant([], [], [], prior)
    means = [s / k for s, k in zip(sums, n)]
    scatters = [p - k * np.outer(m, m) for p, k, m in zip(products, n, means)]
    middle = (sums[0] + sums[1]) / n.sum()
    spread = np.diag((products[0] + products[1]) / n.sum()) - middle ** 2
    target = np.diag(np.maximum(spread, 1e-6))
    factors, logdets = [], []
    for scatter, k in zip(scatters, n):
        lower = np.linalg.cholesky((1 - shrinkage) * scatter / k + shrinkage * target)
        factors.append(np.linalg.inv(lower))
        logdets.append(float(2 * np.log(np.diag(lower)).sum()))
    return Discriminant(means, factors, logdets, prior)


def fit(stats: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """Fit on all rows of ``stats`` (doc_id, stats) that ``labels`` (doc_id, quality) marks with 0 or 1.

    Null ids and labels are left out; a document with several labels takes the smallest.
    """
    marks = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality")))
    x = [F.col("stats")[i] for i in range(D)]
    rows = stats.join(marks, "doc_id").groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(v) for v in x]).alias("s"),
        F.array(*[F.sum(x[i] * x[j]) for i in range(D) for j in range(D)]).alias("p")).collect()  # two rows at most
    found = {r["quality"]: r for r in rows}
    counts = [float(found[k]["n"]) if k in found else 0.0 for k in (0, 1)]
    sums = [np.array(found[k]["s"]) if k in found else np.zeros(D) for k in (0, 1)]
    products = [np.array(found[k]["p"]).reshape(D, D) if k in found else np.zeros((D, D)) for k in (0, 1)]
    return from_moments(counts, sums, products, shrinkage)


def score_statistics(stats: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id and score of stored statistics."""
    prepare(stats.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(flat.reshape(-1, D)))], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double")


def score_documents(docs: DataFrame, model: Discriminant, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` plus the score, in one pass without a shuffle."""
    prepare(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(at).fill_null("")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(_matrix(text)))],
                                             [*batch.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def held_out(doc_id) -> "F.Column":
    """Rows that no label may be learnt from: crc32 of the id's decimal text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> tuple[Discriminant, DataFrame]:
    """The model of all labelled rows that aren't held out, and the stored statistics of every document."""
    stats, _ = store(document_statistics(docs), "document-statistics")
    return fit(stats.filter(~held_out(F.col("doc_id"))), labels, shrinkage), stats


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that a model trained on them scores at ``threshold`` or more.

    Without labels of both classes nothing separates good from bad, and all rows stay. Statistics are computed a second
    time for scoring: storing them with the texts took more of an executor's memory than it saved time.
    """
    model, _ = train(docs, labels)
    if not model.means:
        return docs
    name = "_score"
    while name in docs.columns:
        name += "_"
    return score_documents(docs, model, score_col=name).filter(F.col(name) >= threshold).drop(name)


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its score, and whether it was held out."""
    model, stats = train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return score_statistics(stats, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
