"""Quality classifier: regularised quadratic discriminant over transformed counts of whole texts.

Each class is a Gaussian with its own covariance, shrunk toward the pooled covariance and toward its diagonal
(Friedman's regularised discriminant). The fit needs only sums per class, so it is one aggregate over all labelled
rows; the driver sees a fixed number of sums. The Cholesky factor of each covariance is computed once and travels with
the model; a score is the logistic function of the difference of the two log densities plus the log odds of the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from gaugeworks.llm.stats import NAMES

POOLED, DIAGONAL = 0.02, 0.02
#: Least rows of a class for a fit.
LEAST_ROWS = 5
_CLIP = 30.0


def features(stats: np.ndarray) -> np.ndarray:
    """Rows of counts (in the order of ``stats.NAMES``) to rows of features of similar, bounded spread: lengths go
    through a logarithm, shares through a square root, which steadies the spread of counts."""
    c = dict(zip(NAMES, stats.astype(float).T))
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    letters, chars = np.maximum(c["n_upper"] + c["n_lower"], 1), np.maximum(c["word_chars"], 1)
    share = {
        "symbols": c["n_symbols"] / words, "exclaim": c["n_exclaim"] / words, "upper": c["n_upper"] / letters,
        "digits": c["n_digits"] / chars, "points": c["n_points"] / words, "capital": c["n_capital"] / words,
        "repeated": c["n_repeat_words"] / words, "same": c["n_same_next"] / words, "dup_lines": c["n_dup_lines"] / lines,
        "distinct": 1 - c["n_distinct"] / words, "other": c["n_other"] / chars,
    }
    return np.column_stack([np.log1p(c["n_words"]), np.log1p(words / lines), np.log1p(c["word_chars"] / words),
                            *(np.sqrt(np.maximum(v, 0)) for v in share.values())])


N_FEATURES = 14


@dataclass
class Gaussian:
    mean: np.ndarray
    factor: np.ndarray  # inverse of the lower Cholesky factor
    offset: float  # log prior minus half the log determinant


@dataclass
class Model:
    """``good`` and ``bad`` are None where a class has too few rows; then every score is ``share``."""
    share: float
    good: Gaussian | None = None
    bad: Gaussian | None = None

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.good is None:
            return np.full(len(stats), self.share)
        x = features(stats)
        z = np.clip(_density(self.good, x) - _density(self.bad, x), -_CLIP, _CLIP)
        return np.round(1 / (1 + np.exp(-z)), 9)


def _density(g: Gaussian, x: np.ndarray) -> np.ndarray:
    return g.offset - 0.5 * (((x - g.mean) @ g.factor.T) ** 2).sum(axis=1)


def model_from_sums(n: np.ndarray, s: np.ndarray, ss: np.ndarray, pooled: float = POOLED,
                    diagonal: float = DIAGONAL) -> Model:
    """The model from counts, sums and sums of products of both classes (0 first)."""
    total = n.sum()
    if n.min() < LEAST_ROWS:
        return Model(float(n[1] / total) if total else 0.5)
    means = s / n[:, None]
    covs = [ss[c] / n[c] - np.outer(means[c], means[c]) for c in range(2)]
    common = (n[0] * covs[0] + n[1] * covs[1]) / total
    found = []
    for c in range(2):
        cov = (1 - pooled) * covs[c] + pooled * common
        cov = (1 - diagonal) * cov + diagonal * np.diag(np.diag(cov)) + 1e-6 * np.eye(len(cov))
        low = np.linalg.cholesky(cov)
        found.append(Gaussian(means[c], np.linalg.inv(low), float(np.log(n[c] / total) - np.log(np.diag(low)).sum())))
    return Model(float(n[1] / total), found[1], found[0])


def fit(labelled: DataFrame, label: str, pooled: float = POOLED, diagonal: float = DIAGONAL) -> Model:
    """Fit on all rows of ``labelled``: the columns of ``stats.NAMES`` and ``label`` (0 or 1; other values are left out).

    Products are summed within each task, then by key: 2 * (1 + k + k * k) rows reach the driver whatever the input.
    """
    k = N_FEATURES

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((2, 1 + k + k * k))
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            x = features(_matrix(b.columns[1:]))
            for c in range(2):
                rows = x[y == c]
                acc[c] += np.concatenate([[len(rows)], rows.sum(0), (rows.T @ rows).ravel()])
        cls, place = np.indices(acc.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(cls.astype(np.int32)), pa.array(place.astype(np.int32)),
                                          pa.array(acc.ravel())], ["cls", "place", "v"])

    rows = (labelled.where(F.col(label).isin(0, 1)).select(F.col(label).cast("int"), *NAMES)
            .mapInArrow(sums, "cls int, place int, v double").groupBy("cls", "place").agg(F.sum("v").alias("v")).collect())
    acc = np.zeros((2, 1 + k + k * k))
    for r in rows:
        acc[r.cls, r.place] = r.v
    return model_from_sums(acc[:, 0], acc[:, 1:k + 1], acc[:, k + 1:].reshape(2, k, k), pooled, diagonal)


def _matrix(columns: list[pa.Array]) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns]) if len(columns[0]) else (
        np.zeros((0, len(columns))))


def with_score(stats: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``stats`` (any columns, among them those of ``stats.NAMES``) with the score as column ``out``."""
    stats = stats.drop(out)
    names = stats.columns
    at = [names.index(n) for n in NAMES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = model.score(_matrix([b.column(i) for i in at])) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(b.columns + [pa.array(score)], names + [out])

    return stats.mapInArrow(run, StructType(stats.schema.fields + [StructField(out, DoubleType())]))
