"""Query op12: Merkle manifest of all documents, proofs checked against altered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .merkle import field, fold, hashed, manifest, proof_digest

NAME = "op12_merkle_manifest"
ARITY, TAMPERED = 2, 7


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = F.col("n_chars").cast("decimal(20,0)") + 1
    digest = lambda n: hashed(*map(field, (F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))))
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    rows = docs.select("doc_id", "lang", digest(F.col("n_chars")).alias("leaf"), F.when(tampered, digest(more)).alias("other"))
    return (
        manifest(rows, "lang", "doc_id", "leaf", ARITY)
        .select(
            "doc_id", "leaf", "subroot", "root",
            proof_digest(F.col("steps")).alias("proof_sha256"),
            fold(F.coalesce("other", "leaf"), F.col("steps")).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


def _field(x: str) -> str:
    return f"coalesce(strlen(cast({x} as varchar)) || ':' || cast({x} as varchar), '-')"


def _digest(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


def crc32_sql(text: str) -> str:
    """crc32 of a text of ASCII characters, bit by bit."""
    bit = "case when y & 1 = 1 then xor(y >> 1, 3988292384) else y >> 1 end"
    return (
        f"xor(list_reduce(list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint), "
        f"lambda c, b: list_reduce(range(8), lambda y, i: {bit}, xor(c, b)), 4294967295), 4294967295)"
    )


_UP = "list_transform(range(0, (len(nodes) + 1) // 2), lambda k: sha256(nodes[2 * k + 1] || coalesce(nodes[2 * k + 2], '')))"
_STEP = "case when {0} & 1 = 1 then nodes[{0}] || '|' else '|' || coalesce(nodes[{0} + 2], '') end"
SQL = f"""
with recursive leaves as (
  select *, row_number() over (partition by lang order by doc_id nulls last, leaf) - 1 as i from (
    select doc_id, lang, {_digest("n_chars")} as leaf,
      case when {crc32_sql("cast(doc_id as varchar)")} % {TAMPERED} = 0 then {_digest("(n_chars::hugeint + 1)")} end as other
    from documents
  ) d
), tree as (
  select lang, 0 as lvl, list(leaf order by i) as nodes from leaves group by lang
  union all
  select lang, lvl + 1, {_UP} from tree where len(nodes) > 1
), subroots as (
  select lang, nodes[1] as subroot, row_number() over (order by lang nulls first) - 1 as i from tree where len(nodes) = 1
), upper_tree as (
  select 0 as lvl, list(subroot order by i) as nodes from subroots
  union all
  select lvl + 1, {_UP} from upper_tree where len(nodes) > 1
), steps as (
  select l.lang, l.i, t.lvl, {_STEP.format("(l.i >> t.lvl)")} as step
  from leaves l join tree t on t.lang is not distinct from l.lang and len(t.nodes) > 1
), higher as (
  select s.lang, 1000 + u.lvl as lvl, {_STEP.format("(s.i >> u.lvl)")} as step
  from subroots s join upper_tree u on len(u.nodes) > 1
), paths as (
  select l.lang, l.i, coalesce(list(step order by lvl) filter (step is not null), []) as path
  from leaves l left join (
    select * from steps union all select l.lang, l.i, h.lvl, h.step from leaves l join higher h on h.lang is not distinct from l.lang
  ) s on s.lang is not distinct from l.lang and s.i = l.i
  group by l.lang, l.i
), folded as (
  select l.doc_id, l.leaf, s.subroot, (select nodes[1] from upper_tree where len(nodes) = 1) as root,
    sha256(replace(array_to_string(path, ''), '|', '')) as proof_sha256,
    list_reduce(path, lambda own, s: sha256(split_part(s, '|', 1) || own || split_part(s, '|', 2)), coalesce(l.other, l.leaf)) as folded_root
  from leaves l
  join paths p on p.lang is not distinct from l.lang and p.i = l.i
  join subroots s on s.lang is not distinct from l.lang
)
select *, folded_root = root as verified from folded
"""
