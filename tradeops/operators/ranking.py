"""Exact row numbers without sorting a whole group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged, writes_stages
from .grouping import CROWD, join_groups, same_key, times


def row_numbers(df: DataFrame, keys: list[str], order: list[str], name: str, stage=staged) -> DataFrame:
    """`row_number() OVER (PARTITION BY keys ORDER BY order)`, NULLs last.

    Rows are cut into ranges of (keys, order) by sampled quantiles of the actual values, so a hot group spreads over as
    many ranges as its rows need; the cut is staged, so that counting and numbering see the same ranges. A window then
    numbers one group's rows of one range, and counts of the ranges before are added. Only rows with equal keys and equal
    order stay together.
    """
    given = df.columns
    sort = [F.col(c).asc_nulls_last() for c in order]
    ranges = df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in keys], *sort)
    rows = stage(ranges.withColumn("__range", F.spark_partition_id()), "ranges")
    counts = rows.groupBy(*keys, "__range").agg(F.count("*").alias("__n"))
    if keys:
        earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
        before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).drop("__n")
    else:
        # One number for each range, of which there are as many as shuffle partitions.
        total, sums = 0, []
        for r in sorted(counts.collect(), key=lambda r: r["__range"]):
            sums.append((r["__range"], total))
            total += r["__n"]
        before = rows.sparkSession.createDataFrame(sums, "__range int, __before long")
    inside = Window.partitionBy(*keys, "__range").orderBy(*sort)
    numbered = rows.withColumn("__rank", F.row_number().over(inside))
    out = join_groups(numbered, before, [*keys, "__range"])
    return out.select(*given, (F.col("__before") + F.col("__rank")).cast("long").alias(name))


def numbers_by_group(df: DataFrame, keys: list[str], order: list[str], name: str, stage=staged, crowd: int = CROWD) -> DataFrame:
    """`row_numbers` for rows whose groups are small but for a few: a group of up to ``crowd`` rows is numbered in one task.

    Groups are counted first. The rows of larger ones alone are cut into ranges and staged; of the others only the columns
    that are used later move. ``df`` is read more than once: pass a table or a staged result.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > crowd)
    crowded = stage(sizes.select(*[F.col(k).alias(f"__crowd_{k}") for k in keys]), "crowded")
    sort = [F.col(c).asc_nulls_last() for c in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*sort)).cast("long")
    if writes_stages() and crowded.isEmpty():
        return df.withColumn(name, place)
    crowded_row = same_key(keys, crowded.columns)
    few = df.join(crowded, crowded_row, "left_anti").withColumn(name, place)
    return few.unionByName(row_numbers(df.join(crowded, crowded_row, "left_semi"), keys, order, name, stage))


def running_totals(df: DataFrame, keys: list[str], order: list[str], amount: str, name: str, stage=staged) -> DataFrame:
    """Sum of ``amount`` over the rows of the group that come before, in `row_numbers`' order and by its ranges.

    A range's own total is added up before it is shuffled, so a hot group is many ranges and one row of each.
    """
    given = df.columns
    sort = [F.col(c).asc_nulls_last() for c in order]
    rows = stage(df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in keys], *sort).withColumn("__range", F.spark_partition_id()), "ranges")
    totals = rows.groupBy(*keys, "__range").agg(F.sum(amount).alias("__sum"))
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.withColumn("__before", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    inside = Window.partitionBy(*keys, "__range").orderBy(*sort).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumn("__inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    out = join_groups(summed, before, [*keys, "__range"])
    return out.select(*given, (F.col("__before") + F.col("__inside")).alias(name))


def list_rows(df: DataFrame, keys: list[str], value: str, distinct: bool = False, stage=staged) -> DataFrame:
    """A group's non-NULL values in sorted order as child rows (keys.., position, ``value``, times).

    A value that occurs several times is one row with its first position and how often it stands there, so neither a cell
    nor a task ever holds a list; with ``distinct`` every value counts once. `list_text` makes the text of short lists.
    """
    seen = df.where(F.col(value).isNotNull()).groupBy(*keys, value)
    counted = seen.agg(F.lit(1).cast("long").alias("times")) if distinct else seen.agg(F.count("*").alias("times"))
    placed = running_totals(counted, keys, [value], "times", "__before", stage)
    return placed.select(*keys, (F.col("__before") + 1).alias("position"), value, "times")


def list_text(rows: DataFrame, keys: list[str], value: str, sep: str, name: str) -> DataFrame:
    """One text a group from `list_rows`. The text is one cell: for groups whose lists are known to be short."""
    entry = F.struct("position", times(F.col(value), F.col("times"), sep).alias("text"))
    cells = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(entry)).alias("__cells"))
    return cells.select(*keys, F.array_join(F.col("__cells.text"), sep).alias(name))


def dense_ids(names: DataFrame, column: str, id_name: str, stage=staged) -> DataFrame:
    """Distinct names numbered 1.. in name order; the list is staged, so its users share one numbering."""
    return stage(row_numbers(names.select(column).distinct(), [], [column], id_name, stage), "ids")
