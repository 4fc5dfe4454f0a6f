"""Quality classifier: regularised quadratic discriminant analysis.

1. *Statistics* of the whole text (lengths, line and word shape, character
   classes, repetition), transformed: log1p of counts, square root of shares.
   The text is read once; the statistics of all documents are stored.
2. *Moments*: count, sums and sums of products per class, over all labelled
   training rows, as partial sums per task (2 classes x (1 + d + d^2) numbers
   reach the driver, whatever the input).
3. *Fit*: each class covariance is shrunk toward the pooled one (``to_pooled``)
   and then toward the diagonal of the pooled one (``to_diagonal``), which keeps
   it positive definite; its inverse Cholesky factor and log determinant are
   computed once and cached in the model.
4. *Score*: the difference of the classes' log densities (Mahalanobis distance
   through the cached factor) plus the log prior odds, as a probability.

Inputs of a score are the statistics alone: no label, language, source or id.

Defined cases: null and empty texts have all statistics 0 and are scored like
any other; rows without a document id count as the empty id in the fold and
never carry a label; null labels do not train; a document with several label
rows trains with each; if one class has no training row, every score is the
smoothed share of the other class (0.5 without any label); an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored

TO_POOLED = 0.1
TO_DIAGONAL = 0.05
KEEP_AT = 0.3

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = b"0123456789"
_STOP = b".,;:"
_SHOUT = b"!?"
_SIGNS = b"#$%&*+/<=>@\\^_`|~{}[]()"


def statistics(data: bytes | None) -> list[float]:
    """Transformed statistics of one UTF-8 text."""
    t = data or b""
    words, lines = t.split(), t.split(b"\n")
    n, n_words, n_lines = len(t), len(words), len(lines)
    share = lambda x, of: math.sqrt(x / of) if of else 0.0
    held = lambda chars: n - len(t.translate(None, chars))
    white = n - sum(map(len, words))
    distinct = set(words)
    signs = held(_SIGNS)
    return [
        math.log1p(n),
        math.log1p(n_words),
        math.log1p(n_lines - 1),
        math.log1p((n - white) / n_words) if n_words else 0.0,
        math.log1p(max(map(len, words), default=0)),
        math.log1p(n_words / n_lines),
        share(held(_UPPER), n),
        share(held(_LOWER), n),
        share(held(_DIGIT), n),
        share(held(_STOP), n),
        share(held(_SHOUT), n),
        share(signs, n),
        share(t.count(b"|"), n_words),
        share(sum(map(bytes.isalpha, words)), n_words),
        share(sum(map(eq, words, words[1:])), n_words),
        share(len(distinct), n_words),
        share(n_lines - len(set(lines)), n_lines),
    ] if n else [0.0] * 17


def statistics_of(text: Column) -> Column:
    """``statistics`` as a column."""
    @F.pandas_udf("array<double>")
    def of(series: pd.Series) -> pd.Series:
        return pd.Series([statistics(x) for x in series], dtype=object)

    return of(text.cast("binary"))


@dataclass(frozen=True)
class Qda:
    mean: np.ndarray  # class x d
    root: np.ndarray  # class x d x d, inverse Cholesky factors
    log_det: np.ndarray
    log_prior: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        side = []
        for k in (0, 1):
            z = (x - self.mean[k]) @ self.root[k].T
            side.append(self.log_prior[k] - 0.5 * (self.log_det[k] + (z * z).sum(axis=1)))
        return side[1] - side[0]


def moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """(count, sum, sum of products) per class of (label int, stats)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            label = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.array(batch.column(1).to_pylist(), dtype=float)
            x = np.hstack([np.ones((len(x), 1)), x])
            for k in np.unique(label).tolist():
                own = x[label == k]
                total[k] = total.get(k, 0) + own.T @ own
        for k, m in total.items():
            flat = m.ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(flat), pa.int32()), pa.array(range(len(flat)), pa.int32()), pa.array(flat)], names=["label", "at", "value"])

    sums = rows.select("label", "stats").mapInArrow(run, "label int, at int, value double").groupBy("label", "at").agg(F.sum("value").alias("value"))
    out: dict[int, dict[int, float]] = {}
    for label, at, value in sums.collect():
        out.setdefault(label, {})[at] = value
    result = {}
    for k, cells in out.items():
        d = math.isqrt(len(cells))
        m = np.array([cells[i] for i in range(d * d)]).reshape(d, d)
        result[k] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return result


def fit(rows: DataFrame, to_pooled: float = TO_POOLED, to_diagonal: float = TO_DIAGONAL) -> Qda | float:
    """Model of (label int 0/1, stats), or the constant score when a class is missing."""
    m = moments(rows)
    if not (0 in m and 1 in m):
        n = {k: m[k][0] for k in m}
        return (n.get(1, 0) + 1) / (sum(n.values()) + 2)
    total = m[0][0] + m[1][0]
    mean = {k: m[k][1] / m[k][0] for k in (0, 1)}
    scatter = {k: m[k][2] - m[k][0] * np.outer(mean[k], mean[k]) for k in (0, 1)}
    pooled = (scatter[0] + scatter[1]) / total
    diagonal = np.diag(np.maximum(np.diag(pooled), 1e-6))
    roots, dets = [], []
    for k in (0, 1):
        cov = (1 - to_pooled) * scatter[k] / m[k][0] + to_pooled * pooled
        cov = (1 - to_diagonal) * cov + to_diagonal * diagonal
        factor = np.linalg.cholesky((cov + cov.T) / 2)
        roots.append(np.linalg.inv(factor))
        dets.append(2 * np.log(np.diag(factor)).sum())
    return Qda(np.array([mean[0], mean[1]]), np.array(roots), np.array(dets), np.log([m[0][0] / total, m[1][0] / total]))


def score(stats: Column, model: Qda | float) -> Column:
    """Probability of label 1."""
    if not isinstance(model, Qda):
        return F.lit(float(model))
    @F.pandas_udf("double")
    def of(series: pd.Series) -> pd.Series:
        if not len(series):
            return pd.Series([], dtype=float)
        odds = model.log_odds(np.stack(series.to_numpy()))
        return pd.Series(1 / (1 + np.exp(-np.clip(odds, -700, 700))))

    return of(stats)


def train(stats: DataFrame, labels: DataFrame, doc: str = "doc_id", label: str = "quality") -> Qda | float:
    """Model from (doc, stats) of the training documents and the labels table."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc).isNotNull()).select(F.col(doc).alias("_d"), F.col(label).cast("int").alias("label"))
    return fit(stats.join(known, F.col(doc) == F.col("_d")).select("label", "stats"))


def measured(docs: DataFrame, trains: Column, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, trains, stats) of every document row, stored."""
    return stored(docs.select(F.col(doc), trains.alias("trains"), statistics_of(F.col(text)).alias("stats")), "quality-stats")


def classify(docs: DataFrame, labels: DataFrame, trains: Column, doc: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """(doc, trains, score) of every document row.  Labels are used only where
    the boolean ``trains`` holds."""
    stats = measured(docs, trains, doc, text)
    model = train(stats.filter("trains"), labels, doc, label)
    return stats.select(doc, "trains", score(F.col("stats"), model).alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame, trains: Column, doc: str = "doc_id", text: str = "text", label: str = "quality",
              keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that score at least ``keep_at``, all columns."""
    model = train(measured(docs, trains, doc, text).filter("trains"), labels, doc, label)
    return docs.filter(score(statistics_of(F.col(text)), model) >= keep_at)
