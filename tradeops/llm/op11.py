"""Query op11: damaged conversations, audited and repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .conversation_repair import repair, with_faults
from .op12 import crc32_sql

NAME = "op11_conversation_repair"
DAMAGE = 20


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32 of ``conv_id:turn`` names."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % DAMAGE
    text = F.when(draw == 1, "").when(draw == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(draw == 4, "user").otherwise(space("role"))
    copies = F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1)
    one = F.struct("conv_id", "turn", role.alias("role"), text.alias("text"))
    return rows.select(F.explode(F.array_repeat(one, copies)).alias("row")).select("row.*")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    faults = with_faults(damaged(rows))
    is_a = lambda f: F.count(F.when(F.col("fault") == f, 1)).alias(f)
    # Distinct turns without a set for each conversation: a turn counts where it is first met.
    by_turn = faults.groupBy("conv_id", "turn").agg(is_a("blank"), is_a("duplicate"), is_a("truncated"))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    counted = by_turn.groupBy(F.col("conv_id").alias("_counted")).agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")]
    )
    whole, _ = repair(faults)
    all_ids = rows.select(F.col("conv_id").alias("_conv")).distinct()
    out = all_ids.join(counted, F.col("_conv").eqNullSafe(F.col("_counted")), "left")
    out = out.join(whole, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        F.col("_conv").alias("conv_id"),
        *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


_WORD = r"[^\x20\x09-\x0D]"
_DRAW = crc32_sql("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')") + f" % {DAMAGE}"
# States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant. A row is taken after up to two insertions.
SQL = f"""
with recursive drawn as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_DRAW} as draw from conversations
), rows as (
  select conv_id, turn, case when draw = 4 then 'user' else role end as role,
    case when draw = 1 then '' when draw = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from drawn, lateral (select unnest(range(case when draw = 3 then 2 else 1 end)) as copy) c
  where draw <> 0
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as n, left(role, 1) as ini from rows
), repeated as (
  select *, row_number() over (partition by conv_id, role, text order by n) as said from numbered
), marked as (
  select *, case when not regexp_matches(text, '{_WORD}') then 'blank' when said > 1 then 'duplicate'
    when not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') then 'truncated' else '' end as fault,
    lag(ini) over (partition by conv_id order by n) as before
  from repeated
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (n > 1 and before || ini not in ('su', 'ua', 'au')) as illegal, max(n) as size
  from marked group by conv_id
), ways as (
  select conv_id, 0 as n, 0 as q, 0 as cost, '' as audit, '' as lines from counted
  union all
  select conv_id, n, q, min(cost), min_by(audit, {{'c': cost, 'a': audit}}), min_by(lines, {{'c': cost, 'a': audit}}) from (
    select w.conv_id, r.n, e.q, w.cost + w.more + e.cost as cost, w.audit || w.ins || e.edit as audit, w.lines || w.new || e.line as lines
    from (
      select conv_id, n, cost, audit, lines, i.at, i.more, i.ins, i.new from ways, lateral (
        select q as at, 0 as more, '' as ins, '' as new
        union all select case q when 2 then 3 else 2 end, 5, 'I', case q when 2 then chr(10) || 'assistant:' else chr(10) || 'user:' end
        union all select case q when 2 then 2 else 3 end, 10, 'II', case q when 2 then chr(10) || 'assistant:' || chr(10) || 'user:'
          else chr(10) || 'user:' || chr(10) || 'assistant:' end
      ) i
    ) w join marked r on r.conv_id is not distinct from w.conv_id and r.n = w.n + 1, lateral (
      select w.at as q, 2 as cost, 'D' as edit, '' as line
      union all select case w.at when 2 then 3 else 2 end, case r.fault when 'truncated' then 6 else 1 end, 'R',
        chr(10) || case w.at when 2 then 'assistant:' else 'user:' end || r.text where r.fault not in ('blank', 'duplicate')
      union all select case r.ini when 's' then 1 when 'u' then 2 else 3 end, case r.fault when 'truncated' then 5 else 0 end, 'K',
        chr(10) || r.role || ':' || r.text
        where r.fault not in ('blank', 'duplicate')
          and ((r.ini = 's' and w.at = 0) or (r.ini = 'u' and w.at <> 2) or (r.ini = 'a' and w.at = 2))
    ) e
  ) moved group by conv_id, n, q
), ended as (
  select conv_id, min({{'c': cost, 'a': audit, 'l': lines}}) as best from (
    select w.conv_id, w.cost, w.audit, w.lines from ways w join counted c on c.conv_id is not distinct from w.conv_id and c.size = w.n
    where w.q in (0, 3)
    union all
    select w.conv_id, w.cost + case w.q when 2 then 5 else 10 end, w.audit || case w.q when 2 then 'I' else 'II' end,
      w.lines || case w.q when 2 then '' else chr(10) || 'user:' end || chr(10) || 'assistant:'
    from ways w join counted c on c.conv_id is not distinct from w.conv_id and c.size = w.n where w.q <> 3
  ) x group by conv_id
)
select d.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.c, 0)::bigint as cost,
  coalesce(best.a, '') as audit, sha256(coalesce(substr(best.l, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) d
left join counted c on c.conv_id is not distinct from d.conv_id
left join ended e on e.conv_id is not distinct from d.conv_id
"""
