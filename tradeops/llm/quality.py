"""Quality of documents by a regularised quadratic discriminant over transformed document statistics.

Each class is a normal density over the statistics below, brought to similar scales (logarithms of counts, square roots of
shares) and standardised;
what a text of few words shows is drawn towards the mean. A class covariance is shrunk towards a multiple of the identity; its Cholesky factor is kept, so
a score is the difference of two Mahalanobis distances, two log-determinants and two priors, through the logistic function.

Defined cases: a null text is an empty one, and an empty text is scored by its statistics like any other; with labels of one
class, or none, every score is the share of label 1 (0.5 without labels); repeated rows are scored alike; other columns
pass through. Statistics read the whole text and need memory for its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import training_sample

SAMPLE, LONGEST = {0: 2000, 1: 2000}, 40_000  # documents a class, and characters of each, to train on
SHRINKAGE = 0.1
DOUBT = 20  # words after which half of a deviation from the mean counts
BOUND = 6.0  # standard deviations from the common mean beyond which a statistic is cut

_UPPER, _DIGIT, _SPACE, _OTHER, _MARK, _HIGH = range(6)


def _byte_classes() -> np.ndarray:
    out = np.full(256, 7, np.int64)
    for b in range(128):
        c = chr(b)
        if c.isupper():
            out[b] = _UPPER
        elif c.isdigit():
            out[b] = _DIGIT
        elif c.isspace():
            out[b] = _SPACE
        elif c in ".,;:?'\"()-":
            out[b] = _MARK
        elif not c.isalpha():
            out[b] = _OTHER
    out[128:] = _HIGH
    return out


_CLASSES = _byte_classes()


def statistics(text: str) -> list[float]:
    """The statistics of a text, and last how far a text of so few words can be trusted to show them."""
    data = np.frombuffer(text.encode(), np.uint8)
    share = np.bincount(_CLASSES, np.bincount(data, minlength=256), minlength=8) / max(len(data), 1)
    words, lines = text.split(), text.split("\n")
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    counts = Counter(words)
    return [
        np.log1p(len(data)),
        *np.sqrt(share[:6]),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        np.log1p(lengths.max()),
        len(counts) / n,
        np.sqrt(max(counts.values(), default=0) / n),
        len(set(lines)) / len(lines),
        np.log1p(n / len(lines)),
        np.sqrt(sum(text.count(c) for c in ".!?") / n),
        np.sqrt(sum(len(w) == 1 for w in counts) / max(len(counts), 1)),
        len(words) / (len(words) + DOUBT),
    ]


@dataclass
class Discriminant:
    mean: np.ndarray
    deviation: np.ndarray
    centres: list[np.ndarray]
    factors: list[np.ndarray]  # lower Cholesky factors of the class covariances
    constants: list[float]  # log prior - half the log-determinant

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 for rows of statistics."""
        x = _standard(x, self.mean, self.deviation)
        density = [
            c - 0.5 * (np.linalg.solve(f, (x - m).T) ** 2).sum(axis=0)
            for m, f, c in zip(self.centres, self.factors, self.constants)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def _standard(x: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> np.ndarray:
    return np.clip((x[:, :-1] - mean) / deviation, -BOUND, BOUND) * x[:, -1:]


def fit(x: np.ndarray, y: np.ndarray, share: float) -> Discriminant | None:
    if len(np.unique(y)) < 2:
        return None
    mean, deviation = x[:, :-1].mean(axis=0), x[:, :-1].std(axis=0) + 1e-6
    x = _standard(x, mean, deviation)
    centres, factors, constants = [], [], []
    for k, prior in ((0, 1 - share), (1, share)):
        part = x[y == k]
        centre = part.mean(axis=0)
        covariance = (part - centre).T @ (part - centre) / len(part)
        level = np.trace(covariance) / len(covariance) + 1e-3
        factor = np.linalg.cholesky((1 - SHRINKAGE) * covariance + SHRINKAGE * level * np.eye(len(covariance)))
        centres.append(centre)
        factors.append(factor)
        constants.append(float(np.log(max(prior, 1e-9)) - np.log(np.diag(factor)).sum()))
    return Discriminant(mean, deviation, centres, factors, constants)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[Discriminant | None, float]:
    texts, classes, share = training_sample(docs, labels, label, SAMPLE, LONGEST)
    if not texts:
        return None, 0.5
    return fit(np.array([statistics(t) for t in texts]), np.array(classes), share), share


def with_quality(df: DataFrame, model: Discriminant | None, share: float, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with the probability ``score`` of being good."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if shared.value is None or not len(batch):
                yield pd.Series(share, index=batch.index, dtype=float)
            else:
                yield pd.Series(shared.value.scores(np.array([statistics(t) for t in batch])))

    return df.withColumn(score, scores(F.coalesce(df[text], F.lit(""))))
