"""Query op1: every conversation, formatted and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format as chat

NAME = "op1_chat_formatting"
PROBE = "</s>[INST] ok [/INST]"


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql(
        f"select * from values (-1L, 0L, 'user', '{PROBE}'), (-1L, 1L, 'assistant', '{PROBE}') "
        "as probe(conv_id, turn, role, text)"
    )
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    chats = chat.format_chats(chat.events_of_turns(rows.unionByName(probe)))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return chats.select(
        F.col("conversation").alias("conv_id"),
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


_ESCAPED = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '[', '&lsqb;')"
SQL = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         role as r0, text as t0 from conversations
  union all values (-1, 0, 'user', '{PROBE}', 'user', '{PROBE}'),
                   (-1, 1, 'assistant', '{PROBE}', 'assistant', '{PROBE}')
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, r0 nulls first, t0 nulls first) as n from turns
)
select conv_id,
  count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by n), '')) as loss_sha256,
  cast(sum({len(chat.TURN + chat.TEXT + chat.END)} + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})) as bigint)
    as formatted_chars
from numbered group by conv_id
"""
