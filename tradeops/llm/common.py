"""Settings that several operators of this subpackage share."""

from __future__ import annotations

import ctypes

import public_tokenizers
import pyarrow as pa
from pyspark.sql import SparkSession

BYTE_BPE = "byte_bpe_50k.json"


def tokenizer_path(name: str = BYTE_BPE) -> str:
    return public_tokenizers.path(name)


def bounded_batches(spark: SparkSession, rows: int = 500) -> SparkSession:
    """Python workers get texts in batches of few rows, so that long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return spark


def release_memory() -> None:
    """Gives back what a task has freed: Python workers live on for other stages, and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim is not None:
        trim(0)
