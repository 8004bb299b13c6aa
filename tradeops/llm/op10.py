"""Query op10: near duplicates among all documents by an exact Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches
from .jaccard_join import near_duplicates

NAME = "op10_ngram_jaccard_join"
SHINGLE, THRESHOLD = 3, 90
SQL = None  # the transitive closure over all pairs is too slow in SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded_batches(spark).read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, SHINGLE, THRESHOLD)
