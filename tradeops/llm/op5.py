"""Query op5: token counts of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, tokenizer_path
from .token_counts import with_budget

NAME = "op5_token_counts"
LIMIT = 1024
SQL = None  # byte-pair encoding has no SQL form; tests compare with the library


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded_batches(spark).read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    return with_budget(docs, tokenizer_path(), LIMIT, chars="chars_within_limit").select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
        "chars_within_limit",
    )
