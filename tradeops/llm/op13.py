"""Query op13: all documents encoded to token ids and decoded again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe_codec import with_tokens
from .common import bounded_batches, tokenizer_path

NAME = "op13_bpe_codec"
TOKENIZER = "word_bpe_49k.json"
SQL = None  # byte-pair encoding has no SQL form; tests compare with the library


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = bounded_batches(spark, 100).read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    tokens = with_tokens(docs, tokenizer_path(TOKENIZER), ids="ids", back="back")
    return tokens.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("back", 256).alias("decoded_sha256"),
    )
