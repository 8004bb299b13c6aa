"""Query op2: for every fiftieth vector, the five other vectors with the largest inner product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .exact_topk import exact_topk

NAME = "op2_exact_topk"
K, SCALE, EVERY = 5, 256, 50


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return exact_topk(vectors, F.col("vec_id") % EVERY == 0, K, SCALE)


SQL = f"""
with v as (
  select vec_id, row_number() over () as n, [floor({SCALE} * cast(x as double)) for x in embedding] as e
  from embeddings
  where embedding is not null and len([1 for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select q.n as qn, q.vec_id as query_id, c.vec_id, c.n, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.n <> c.n where q.vec_id % {EVERY} = 0
), ranked as (
  select *, row_number() over (partition by qn order by score desc, vec_id, n) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= {K}
"""
