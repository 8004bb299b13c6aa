"""Query op6: all documents packed into sequences of 1024 tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches, tokenizer_path
from .packing import pack_documents

NAME = "op6_best_fit_packing"
SIZE, END_TOKEN = 1024, 2
SQL = None  # tokenization has no SQL form; tests check ids, gapless sequences and the number of sequences


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded_batches(spark).read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, tokenizer_path(), SIZE, END_TOKEN)
