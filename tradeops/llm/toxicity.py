"""Toxicity of documents by a string-kernel support vector machine (``subsequence_svm``).

The machine is trained on a bounded sample of labelled documents and sent to the tasks; there every sentence of every whole
text gets a margin, and the three highest give the document's probability.

Defined cases: a null text is an empty one; empty texts get the score of a text without any toxic sentence, or the share of
toxic labels if there was nothing to learn from (as then has every text); repeated rows are scored alike; other columns
pass through. Sentences without an end are cut every few words, so long texts need no more memory than their words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import training_sample
from .subsequence_svm import Machine, train

SAMPLE, LONGEST = {0: 700, 1: 500}, 10_000  # documents a class, and characters of each, to train on


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple[Machine | None, float]:
    texts, classes, share = training_sample(docs, labels, label, SAMPLE, LONGEST)
    return train(texts, classes, share), share


def with_toxicity(df: DataFrame, machine: Machine | None, share: float = 0.0, text: str = "text", score: str = "score") -> DataFrame:
    """``df`` with the probability ``score`` of being toxic."""
    shared = df.sparkSession.sparkContext.broadcast(machine)  # 2^18 weights

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if shared.value is None:
                yield pd.Series(share, index=batch.index, dtype=float)
            else:
                yield batch.map(shared.value.score).astype(float)

    return df.withColumn(score, scores(F.coalesce(df[text], F.lit(""))))
