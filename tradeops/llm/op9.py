"""Query op9: repeated multi-line chunks taken out of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .line_dedup import BASE, DIVISOR, MODULUS, WINDOW, dedup_lines

NAME = "op9_line_dedup"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs)


assert WINDOW == 2  # the SQL writes its window out
SQL = f"""
with lines as (
  select doc_id, i - 1 as i, ls[i] as line
  from (select doc_id, string_split(text, chr(10)) as ls from documents where text is not null) s,
       lateral (select unnest(range(1, len(ls) + 1)) as i) n
), hashed as (
  select *, cast(('0x' || substr(md5(line), 1, 7)) as bigint) as h from lines
), ended as (
  select doc_id, i, line,
    case when (coalesce(lag(h) over w, 0) % {MODULUS} * {BASE} + h) % {MODULUS} % {DIVISOR} = 0 then 1 else 0 end as is_end
  from hashed window w as (partition by doc_id order by i)
), numbered as (
  select doc_id, i, line,
    coalesce(sum(is_end) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as chunk
  from ended
), chunks as (
  select doc_id, chunk, count(*) as lines, string_agg(line, chr(10) order by i) as body from numbered group by doc_id, chunk
), ranked as (
  select *, row_number() over (partition by body order by doc_id, chunk) as occurrence from chunks
)
select d.doc_id,
  case when d.text is null then null else coalesce(r.body, '') end as text,
  coalesce(r.removed_lines, 0) as removed_lines
from documents d left join (
  select doc_id,
    string_agg(body, chr(10) order by chunk) filter (lines = 1 or occurrence = 1) as body,
    cast(coalesce(sum(lines) filter (lines > 1 and occurrence > 1), 0) as bigint) as removed_lines
  from ranked group by doc_id
) r on d.doc_id = r.doc_id
"""
