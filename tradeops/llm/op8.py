"""Query op8: benchmark items in all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches
from .decontamination import contaminated

NAME = "op8_benchmark_decontamination"
SQL = None  # the projection has no SQL form; tests compare with a search for whole items and for planted paraphrases


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded_batches(spark).read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
