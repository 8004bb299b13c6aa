"""Query op4: toxicity of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import toxicity
from .common import bounded_batches
from .labelled import FOLD, FOLDS
from .language_id import held_out

NAME = "op4_toxicity"
LIMIT = 0.5
SQL = None  # a trained machine has no SQL form; tests check the kernel by brute force and held-out accuracy


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded_batches(spark).read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    machine, share = toxicity.learn(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "text")
    scored = toxicity.with_toxicity(rows, machine, share)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))
