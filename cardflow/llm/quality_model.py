"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a short vector of transformed statistics (``FEATURES``). Per class, Spark sums
the count, the vectors and their outer products over all labelled training rows; the driver gets
those few hundred sums, whatever the number of rows. A class covariance is shrunk towards the pooled one and
towards a multiple of the identity, factored once by Cholesky, and the factors are kept with the
model. A score is the logistic function of the tempered difference of the two log densities
(Mahalanobis distances by the cached factors) plus the log prior odds.

Null and empty texts have the vector of a text without words and get a score like any other.
Labels with a null ``doc_id`` or null or other values than 0 and 1 are ignored; repeated labels
count as often as they occur. Without labels of both classes every score is 0.5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardflow.llm.common import give_back
from cardflow.llm.textstats import utf8, windows, word_hashes

FEATURES = ("log_words", "log_word_length", "symbols", "pipes", "exclamations", "upper_case",
            "same_as_previous", "repeated_trigrams", "top_word", "sentence_ends", "digits")
THRESHOLD = 0.7
_DELETE_UPPER = bytes(range(65, 91))
_DELETE_LOWER = bytes(range(97, 123))
_DELETE_DIGITS = b"0123456789"


def _vector(text: bytes, words: np.ndarray) -> list[float]:
    n = len(words)
    per_word = 1.0 / max(n, 1)
    size = len(text)
    upper = size - len(text.translate(None, _DELETE_UPPER))
    lower = size - len(text.translate(None, _DELETE_LOWER))
    symbols = size - len(text.translate(None, b"#*$%&<>"))
    digits = size - len(text.translate(None, _DELETE_DIGITS))
    grams = windows(words, 3)
    same = float(np.mean(words[1:] == words[:-1])) if n > 1 else 0.0
    repeated = 1.0 - len(np.unique(grams)) / len(grams) if len(grams) else 0.0
    top = float(np.unique(words, return_counts=True)[1].max()) * per_word if n else 0.0
    part = lambda x: math.log1p(10.0 * x)
    return [
        math.log1p(n), math.log1p(size * per_word), part(symbols * per_word), part(text.count(b"|") * per_word),
        part(text.count(b"!") * per_word), part(upper / max(upper + lower, 1)), part(same), part(repeated),
        part(top), part((text.count(b".") + text.count(b"?")) * per_word), part(digits / max(size, 1)),
    ]


def features(text: str | Column) -> Column:
    """The feature vector of each text as ``array<double>``."""

    @F.pandas_udf("array<double>")
    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            data = utf8(texts)
            yield pd.Series([_vector(t, w) for t, w in zip(data, word_hashes(data))], dtype=object)
        give_back()

    return vectors(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


@dataclass(frozen=True)
class QuadraticDiscriminant:
    means: np.ndarray  # class x feature
    factors: np.ndarray  # class x feature x feature: inverse Cholesky factors
    log_dets: np.ndarray
    prior: float  # log odds of class 1
    temperature: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        z = self.log_odds(x) / self.temperature
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        density = [-0.5 * (np.square((x - self.means[k]) @ self.factors[k].T).sum(axis=1) + self.log_dets[k])
                   for k in (0, 1)]
        return density[1] - density[0] + self.prior


def class_sums(rows: DataFrame, label: str = "label", vector: str = "vector") -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class (count, sum of vectors, sum of outer products), by Spark.

    One row for each class and cell of the outer product comes back: its number depends on the
    number of features alone.
    """
    d = len(FEATURES)
    v = F.col(vector)
    cells = [F.lit(1.0)] + [v[i] for i in range(d)] + [v[i] * v[j] for i in range(d) for j in range(i, d)]
    sums = rows.groupBy(label).agg(*[F.sum(c).alias(f"c{k}") for k, c in enumerate(cells)]).collect()
    out = {}
    upper = np.triu_indices(d)
    for row in sums:
        values = np.array(row[1:], dtype=float)
        outer = np.zeros((d, d))
        outer[upper] = values[1 + d:]
        out[int(row[0])] = (values[0], values[1:1 + d], outer + outer.T - np.diag(np.diag(outer)))
    return out


def fit(rows: DataFrame, label: str = "label", vector: str = "vector", pooled: float = 0.3,
        ridge: float = 0.02, temperature: float = 4.0) -> QuadraticDiscriminant | None:
    """Fit on rows (label 0/1, vector); ``None`` unless both classes occur.

    ``pooled`` is the weight of the pooled covariance in each class covariance, ``ridge`` that of
    the identity times the mean variance.
    """
    sums = class_sums(rows.filter(F.col(label).isin(0, 1)), label, vector)
    if set(sums) != {0, 1}:
        return None
    d = len(FEATURES)
    means = np.array([sums[k][1] / sums[k][0] for k in (0, 1)])
    within = [sums[k][2] - sums[k][0] * np.outer(means[k], means[k]) for k in (0, 1)]
    total = sums[0][0] + sums[1][0]
    common = (within[0] + within[1]) / total
    factors, dets = [], []
    for k in (0, 1):
        cov = (1 - pooled) * within[k] / sums[k][0] + pooled * common
        cov = (1 - ridge) * cov + (ridge * np.trace(common) / d + 1e-9) * np.eye(d)
        chol = np.linalg.cholesky((cov + cov.T) / 2)
        factors.append(np.linalg.inv(chol))
        dets.append(2.0 * float(np.log(np.diag(chol)).sum()))
    return QuadraticDiscriminant(means, np.array(factors), np.array(dets),
                                 math.log(sums[1][0] / sums[0][0]), temperature)


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(vectors: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, vector) of the labelled documents outside the held-out part. ``vectors``: doc_id, vector."""
    known = labels.select("doc_id", F.col("quality").alias("label"))
    return vectors.filter(~held_out()).join(known, "doc_id").select("label", "vector")


def score_vector(model: QuadraticDiscriminant | None, vector: str | Column) -> Column:
    """Score of a feature vector, 0 to 1."""
    if model is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in parts:
            yield pd.Series(model.scores(np.stack(vectors.to_list())) if len(vectors) else np.empty(0))

    return score(vector)


def score_text(model: QuadraticDiscriminant | None, text: str | Column) -> Column:
    return score_vector(model, features(text))
