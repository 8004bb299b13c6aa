"""Query op3: the language of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id
from .common import bounded_batches

NAME = "op3_language_id"
SQL = None  # a trained network has no SQL form; tests check gradients, whole texts and held-out accuracy


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded_batches(spark).read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.document_languages(docs)
    rows = docs.select("doc_id", language_id.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "text")
    return language_id.with_language(rows, model).select("doc_id", "held_out", "lang_pred", "score")
