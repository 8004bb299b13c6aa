"""Language identification by a bidirectional gated recurrent network over bytes.

The network (``byte_gru``) starts from a bounded sample of labelled rows and then learns from every byte of all of them: they are
dealt to tasks, each goes on training with its rows, and the mean of the tasks' parameters over all their steps is the model. It is
sent to the tasks again; there it labels every byte of every whole text, and the mean of the position probabilities is the
document's. Only the text is an input. A label counts the same in all, however many rows it has.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text if there is nothing to
learn from; with a single label, every text with a letter has it; repeated rows are scored alike, and teach once an id and text; any
number of labels is learned, with fewer rows each where there are many; other columns pass through, whatever their names. Long texts go through the network in windows, so memory does not grow with a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import staged
from . import byte_gru
from .common import release_memory

UNDETERMINED = "und"
SAMPLE, CHARS = 500, 400  # at most this many rows a label, and characters of each, from a place that varies by row
ROWS = 4_000  # at most this many rows of all labels together; a label has one at least, however many labels there are
PIECES = 16  # in which tasks' parameters are added up


def sample(labelled: DataFrame, seed: int = 1) -> list[tuple[bytes, str]]:
    """A bounded sample of ``labelled`` (doc_id, text, label), to start from: for each label the ids of smallest hash, each once."""
    rows = labelled.where(F.col("text").isNotNull() & F.col("label").isNotNull())
    rows = rows.select("label", "text", F.xxhash64("doc_id", F.lit(seed)).alias("draw"))
    ids = staged(rows.select("label", "draw").distinct(), "ids")  # used twice: texts are not read for both
    labels = ids.select("label").distinct().count()
    each = max(min(SAMPLE, ROWS // max(labels, 1)), 1)
    place = F.row_number().over(W.partitionBy("label").orderBy("draw"))
    picked = F.broadcast(ids.withColumn("place", place).where(F.col("place") <= each).select("label", "draw"))  # ROWS rows, or one a label
    at = F.pmod(F.col("draw"), F.greatest(F.length("text") - CHARS, F.lit(1))).cast("int") + 1
    part = F.substring("text", at, F.lit(CHARS))
    found = rows.join(picked, ["label", "draw"]).groupBy("label", "draw").agg(F.min(part).alias("part"))
    return [(r["part"].encode(), r["label"]) for r in sorted(found.collect(), key=lambda r: (r["label"], r["draw"]))]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def with_language(
    df: DataFrame, model: byte_gru.Model | None, text: str = "text", label: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """``df`` with the predicted ``label`` and its pooled probability ``score``."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # some ten thousand numbers

    @F.pandas_udf("label string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        space = byte_gru.Space()
        for batch in batches:
            out = [(UNDETERMINED, 0.0)] * len(batch)
            if shared.value is not None:
                known = [i for i, t in enumerate(batch) if t is not None and has_letter(t)]
                chances = byte_gru.pooled(shared.value, [batch.iloc[i].encode() for i in known], space)
                for i, p in zip(known, chances):
                    out[i] = (shared.value.labels[p.argmax()], min(float(p.max()), 1.0))
            yield pd.DataFrame(out, columns=["label", "score"])
        del space
        release_memory()

    # Given columns travel as one, so that none can clash; those named like the results are replaced by them.
    given = [c for c in df.columns if c not in (label, score)]
    row = F.struct(*[F.col(f"`{c}`") for c in given]).alias("row")
    named = df.select(row, predict(F.col(f"`{text}`")).alias("named"))
    return named.select("row.*", F.col("named.label").alias(label), F.col("named.score").alias(score))


def learn(labelled: DataFrame) -> byte_gru.Model | None:
    """A model from ``labelled`` (doc_id, text, label), or none if there is nothing to learn from."""
    samples = sample(labelled)
    return from_all_rows(byte_gru.train(samples), labelled) if samples else None


def from_all_rows(start: byte_gru.Model, labelled: DataFrame) -> byte_gru.Model:
    """``start`` trained on with every row of ``labelled`` (doc_id, text, label) of its labels, each row of a kind once."""
    context = labelled.sparkSession.sparkContext
    rows = labelled.where((F.length("text") > 0) & F.col("label").isin(start.labels))
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}  # one row a label
    if len(counts) < 2:
        return start
    weight = np.array([1 / counts.get(label, 1) for label in start.labels], np.float32)
    shared = context.broadcast((start, weight))  # some ten thousand numbers

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, weight = shared.value
        number = {label: i for i, label in enumerate(model.labels)}
        total, size = byte_gru.taught(model, ([(t.encode(), number[k]) for t, k in zip(b["text"], b["label"])] for b in batches), weight)
        pieces = np.array_split(total, PIECES)
        yield pd.DataFrame({"piece": range(PIECES), "sums": [x.tobytes() for x in pieces], "size": size})
        release_memory()

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(b, np.float64) for b in batch["sums"])
        return pd.DataFrame({"piece": batch["piece"][:1], "sums": [total.tobytes()], "size": batch["size"].sum()})

    # Dealt by id and text, whatever files the rows of a label lie in.
    dealt = rows.groupBy("label", "doc_id", F.xxhash64("text").alias("mark")).agg(F.first("text").alias("text")).select("text", "label")
    schema = "piece int, sums binary, size bigint"
    found = dealt.mapInPandas(work, schema).groupBy("piece").applyInPandas(add, schema).orderBy("piece").collect()  # one model
    shared.destroy()
    return byte_gru.with_params(start, np.concatenate([np.frombuffer(r["sums"], np.float64) for r in found]) / found[0]["size"])


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold``; a null id does not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def document_languages(docs: DataFrame) -> byte_gru.Model | None:
    """A model learned from the documents outside the held-out fold."""
    training = docs.where(~held_out(F.col("doc_id"), 4, 2))
    return learn(training.select("doc_id", "text", F.col("lang").alias("label")))
