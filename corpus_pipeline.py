"""A corpus pipeline over ``documents``: each stage reads what the one before kept and writes what it keeps.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the columns of ``documents``, the last one
the packed pieces. ``run`` applies them in order, writing each result as Parquet below the shared folder and reading it again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeops.llm import language_id
from tradeops.llm.common import bounded_batches, tokenizer_path
from tradeops.llm.decontamination import uncontaminated
from tradeops.llm.jaccard_join import repeated, row_mark
from tradeops.llm.line_dedup import dedup_lines
from tradeops.llm.packing import pack_documents
from tradeops.sources.staging import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE, ABOVE_CHANCE = 0.3, 1.2  # least pooled probability of a language, and how far above chance where there are many
SHINGLE, SIMILARITY = 5, 80


def _documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text, no letter, or no language that is likely."""
    docs = _documents(docs)
    model = language_id.document_languages(docs)
    least = min(LEAST_SCORE, ABOVE_CHANCE / max(len(model.labels) if model else 1, 1))
    named = language_id.with_language(docs, model, label="_label", score="_score")
    return _documents(named.where((F.col("_label") != language_id.UNDETERMINED) & (F.col("_score") >= least)))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated chunks of lines out of texts; drops documents of which nothing is left."""
    cleaned = dedup_lines(_documents(docs)).where((F.col("removed_lines") == 0) | (F.trim("text") != ""))
    changed = F.col("removed_lines") > 0
    return _documents(cleaned.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, and everything that is alone.

    Kept is the row of smallest id (a null id last). A document is an id and a text: rows that share only one of them are
    told apart, and of rows equal in both one stays, that of least further columns. Texts without words never link and stay.
    """
    docs = _documents(docs)
    gone = repeated(docs, SHINGLE, SIMILARITY).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_of"))
    marked = docs.withColumn("_mark", row_mark())
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_of"))
    left = marked.join(staged(gone, "gone"), same, "left_anti")
    spoken = left.where(F.col("text").rlike("[^ \t\n\x0b\f\r]"))
    twice = spoken.groupBy(F.col("doc_id").alias("_id"), F.col("_mark").alias("_of")).count().where("count > 1").drop("count")
    twice = staged(twice, "twice")  # ids and marks only; texts move where they are repeated
    rest = F.struct("lang", "source", "n_chars")
    once = spoken.join(twice, same, "left_semi").groupBy("doc_id", "text").agg(F.min(rest).alias("rest")).select("doc_id", "text", "rest.*")
    return _documents(left.join(twice, same, "left_anti")).unionByName(_documents(once))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    docs = _documents(docs)
    return _documents(uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences."""
    return pack_documents(_documents(docs), tokenizer_path())


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_repeated_lines),
    ("n-gram Jaccard join", remove_near_duplicates),
    ("benchmark decontamination", remove_benchmark),
    ("best-fit packing", pack),
]

ORACLE_SQL = None  # a trained network, a random projection and a tokenizer have no SQL form; tests compare stage by stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
