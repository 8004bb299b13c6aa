"""Group-wise operators that stay balanced when one group holds most of the rows.

A window over a hot key would put that whole group in one task. Everything here
aggregates first (map-side partial aggregates shrink a hot group before it is
shuffled) and joins the one-row-per-key result back, a join whose hot side
adaptive execution can split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import writes_stages

CROWD = 100_000  # rows of one key that a task joins or numbers


def same_key(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of key columns, as GROUP BY and PARTITION BY compare."""
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def join_groups(df: DataFrame, groups: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join one-row-per-key ``groups`` onto ``df``; NULL keys form a group too."""
    renamed = [f"__key_{k}" for k in keys]
    side = groups.select(
        *[F.col(k).alias(r) for k, r in zip(keys, renamed)],
        *[F.col(c) for c in groups.columns if c not in keys],
    )
    return df.join(side, same_key(keys, renamed), how).drop(*renamed)


def fanout_left_join(
    left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], only: Column | None = None
) -> DataFrame:
    """Left join on (left column, right column) pairs whose right side may repeat a key very often.

    Adaptive execution cannot split a hot right side of an outer join, but both
    sides of an inner join. So matched rows come from an inner join and the rest
    from an anti join with the distinct keys. Rows of ``left`` outside ``only`` meet
    nothing: they are kept as they are and never shuffled. Both sides are evaluated
    more than once: pass tables or staged results, not long chains of operators.
    """
    cond, names = F.lit(True), [f"__k{i}" for i, _ in enumerate(pairs)]
    for a, b in pairs:
        cond = cond & (F.col(a) == F.col(b))
    keys = right.select(*[F.col(b).alias(n) for (_, b), n in zip(pairs, names)]).distinct()
    none = F.lit(True)
    for (a, _), n in zip(pairs, names):
        none = none & (F.col(a) == F.col(n))
    inside = left if only is None else left.where(only)
    # Both joins see the same rows and columns of the left, so that Spark shuffles them once.
    keyless = reduce(Column.__or__, [F.col(a).isNull() for a, _ in pairs])
    keyed = inside.where(~keyless)
    out = keyed.join(right, cond).unionByName(keyed.join(keys, none, "left_anti"), allowMissingColumns=True)
    out = out.unionByName(inside.where(keyless), allowMissingColumns=True)
    if only is None:
        return out
    return out.unionByName(left.where(~F.coalesce(only, F.lit(False))), allowMissingColumns=True)


def spread_left_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], only: Column | None = None) -> DataFrame:
    """`fanout_left_join` if the right side has more than ``CROWD`` rows of a key; else one left join, which sorts and merges
    ``left`` once, not twice. ``right`` is counted by key first, and should be staged.
    """
    keys = [b for _, b in pairs]
    if not writes_stages():
        return fanout_left_join(left, right, pairs, only)
    counts = right.where(reduce(Column.__and__, [F.col(b).isNotNull() for b in keys])).groupBy(*keys).count()
    if (counts.agg(F.max("count")).first()[0] or 0) > CROWD:
        return fanout_left_join(left, right, pairs, only)
    cond = reduce(Column.__and__, [F.col(a) == F.col(b) for a, b in pairs])
    # Rows without a key or outside ``only`` meet nothing: they are never shuffled.
    meets = reduce(Column.__and__, [F.col(a).isNotNull() for a, _ in pairs])
    if only is not None:
        meets = meets & F.coalesce(only, F.lit(False))
    return left.where(meets).join(right, cond, "left").unionByName(left.where(~meets), allowMissingColumns=True)


def attach_totals(df: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """`aggregate(..) OVER (PARTITION BY keys)` for every row of ``df``."""
    groups = df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in totals.items()])
    return join_groups(df, groups, keys)


def first_row_order(*columns: str) -> Column:
    """Struct that sorts ascending with NULLs last, for `min_by`."""
    fields = []
    for i, c in enumerate(columns):
        fields += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)


def times(text: Column, n: Column, sep: str) -> Column:
    """The text repeated ``n`` times, as a list would show duplicates."""
    return F.array_join(F.array_repeat(text, n.cast("int")), sep)


def text_list(df: DataFrame, keys: list[str], value: str, sep: str, name: str, distinct: bool = False) -> DataFrame:
    """One text per group listing its values in sorted order.

    Values are counted per (group, value) first, so only distinct values travel
    to the task that writes the group's cell.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    shown = F.col(value) if distinct else times(F.col(value), F.col("__n"), sep)
    cells = (
        counted.select(*keys, F.struct(F.col(value).alias("v"), shown.alias("t")).alias("__v"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("__v")).alias("__vs"))
    )
    return cells.select(*keys, F.array_join(F.col("__vs.t"), sep).alias(name))


def lookup_table(dim: DataFrame, key: str, values: list[str]) -> DataFrame:
    """One row per non-NULL key: the smallest value row, so lookups are repeatable."""
    picked = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*values)).alias("__v"))
    return picked.select(key, *[F.col(f"__v.{v}").alias(v) for v in values])


def in_any(df: DataFrame, columns: list[str], members: DataFrame, member: str) -> DataFrame:
    """Rows where at least one of the columns is a member of a key set."""
    keys = members.select(F.col(member).alias("__m")).where(F.col("__m").isNotNull()).distinct()
    kept = df.columns
    hits = []
    for i, c in enumerate(columns):
        side = keys.select(F.col("__m").alias(f"__m{i}"))
        df = df.join(side, F.col(c) == F.col(f"__m{i}"), "left")
        hits.append(F.col(f"__m{i}").isNotNull())
    cond = hits[0]
    for h in hits[1:]:
        cond = cond | h
    return df.where(cond).select(*kept)
