"""Bounded samples of labelled documents for training."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language_id import held_out

FOLDS, FOLD = 5, 0  # crc32 of the id mod FOLDS is FOLD: held out, its labels are never read


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: dict[int, int], longest: int
) -> tuple[list[str], list[int], float]:
    """(texts, labels, share of label 1 among all training labels).

    At most ``rows[label]`` documents a class, those of smallest hash among the documents that can teach: with a text, a label and
    an id. Of a text of more than ``longest`` characters a part of that length teaches, at a place that varies by document. Of
    labels repeated for one document the largest counts, of texts repeated for one id the one of smallest hash, once.
    """
    known = (
        labels.where(F.col(label).isin(*rows) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), FOLDS, FOLD))
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )
    share = known.agg(F.avg("label").alias("p")).first()["p"] or 0.0
    texts = docs.where(F.length("text") > 0).select("doc_id", "text", F.xxhash64("text").alias("mark"))
    # No text moves for the choice: one mark an id, and as many as labels have.
    usable = known.join(texts.select("doc_id", "mark"), "doc_id").groupBy("doc_id", "label").agg(F.min("mark").alias("mark"))
    usable = usable.withColumn("draw", F.xxhash64("doc_id"))
    classes = [usable.where(F.col("label") == k).orderBy("draw", "doc_id").limit(n) for k, n in rows.items()]
    picked = F.broadcast(reduce(DataFrame.union, classes))  # at most the sum of ``rows``
    room = F.greatest(F.length("text") - longest, F.lit(0)) + 1
    part = F.substring("text", F.pmod(F.col("mark"), room).cast("int") + 1, F.lit(longest))
    found = texts.join(picked, ["doc_id", "mark"]).groupBy("label", "draw", "doc_id").agg(F.min(part).alias("part"))
    chosen = sorted((r["label"], r["draw"], r["part"]) for r in found.collect())
    return [r[2] for r in chosen], [r[0] for r in chosen], float(share)
