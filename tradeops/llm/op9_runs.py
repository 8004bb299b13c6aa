"""Query op9_line_dedup_runs: repeated runs of two lines or more taken out of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .line_dedup import dedup_runs

NAME = "op9_line_dedup_runs"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_runs(docs)


SQL = """
with lines as (
  select doc_id, i, ls[i] as line
  from (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null) s,
       lateral (select unnest(range(1, len(ls) + 1)) as i) n
), pairs as (
  select doc_id, i, line || chr(10) || lead(line) over (partition by doc_id order by i) as body from lines
), ranked as (
  select doc_id, i, row_number() over (partition by body order by doc_id, i) as occurrence from pairs where body is not null
), gone as (
  select doc_id, i from ranked where occurrence > 1 union select doc_id, i + 1 from ranked where occurrence > 1
), marked as (
  select l.*, g.i is not null as is_gone from lines l left join gone g on l.doc_id = g.doc_id and l.i = g.i
)
select d.doc_id,
  case when d.text is null then null else coalesce(r.body, '') end as text,
  coalesce(r.removed_lines, 0) as removed_lines
from documents d left join (
  select doc_id,
    string_agg(line, chr(10) order by i) filter (not is_gone) as body,
    cast(count(*) filter (is_gone) as bigint) as removed_lines
  from marked group by doc_id
) r on d.doc_id = r.doc_id
"""
