"""Who may see what: entitlement tables and the filters that use them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined

ALL = "*"  # scope of users who see everything


def any_of_join(left: DataFrame, columns: list[str], right: DataFrame, key: str) -> DataFrame:
    """Inner join where any of the columns equals the key (`a = k OR b = k`).

    Each left row is listed once per distinct value, which turns the OR into a
    hash-partitioned equi-join with the same multiplicity.
    """
    values = F.array_distinct(F.array(*[F.col(c) for c in columns]))
    spread = left.withColumn("__any", F.explode(values))
    return spread.join(right, F.col("__any") == F.col(key)).drop("__any")


def codes_of(sources: list[tuple[DataFrame, str, int | None]], name: str) -> DataFrame:
    """Distinct codes of several (frame, column, longest length) sources."""
    arms = []
    for df, column, longest in sources:
        arm = df.select(F.col(column).alias(name))
        arms.append(arm if longest is None else arm.where(F.length(name) <= longest))
    return reduce(DataFrame.unionAll, [a.distinct() for a in arms]).distinct()


def link_text(a: Column | str, b: Column | str) -> Column:
    """Key that both directions of a pair contain: 'a|b|b|a'."""
    bar = F.lit("|")
    return joined(a, bar, b, bar, b, bar, a)


def observed_pairs(sources: list[tuple[DataFrame, str, str, int | None]]) -> DataFrame:
    """Ordered office pairs that occur in (frame, column, other column, longest code) sources, either way round, with
    their link key. A pair nobody has a document for is not listed, so the list grows with the documents' distinct pairs."""
    arms = []
    for df, one, other, longest in sources:
        arm = df.select(F.col(one).alias("_side_a"), F.col(other).alias("_side_b")).dropna()
        arms.append((arm if longest is None else arm.where(F.length("_side_b") <= longest)).distinct())
    seen = reduce(DataFrame.unionAll, arms)
    both = seen.unionByName(seen.select(F.col("_side_b").alias("_side_a"), F.col("_side_a").alias("_side_b"))).distinct()
    return both.withColumn("_link", link_text("_side_a", "_side_b"))


def grants(local: DataFrame, everyone: DataFrame, scope: str) -> DataFrame:
    """One list of who sees what: ``local`` rows with their scope, ``everyone`` with the scope ``ALL``.

    A user who sees everything is one row, not one row for each scope there is.
    """
    return everyone.withColumn(scope, F.lit(ALL)).unionByName(local)


def viewers(df: DataFrame, columns: list[str], granted: DataFrame, scope: str, name: str = "_viewers") -> DataFrame:
    """``df`` (distinct rows) with the number of grants that show a row: of the scope of any of its columns, or ``ALL``."""
    given = df.columns
    counts = granted.groupBy(F.col(scope).alias("__scope")).agg(F.count("*").alias("__n"))
    scopes = df.withColumn("__at", F.explode(F.array_distinct(F.array(*columns, F.lit(ALL)))))
    seen = scopes.join(counts, F.col("__at") == F.col("__scope"), "left")
    return seen.groupBy(*given).agg(F.coalesce(F.sum("__n"), F.lit(0)).alias(name))


def _sees_all(scope: str, everything: Column | None) -> Column:
    return F.coalesce(F.col(scope) == ALL if everything is None else everything, F.lit(False))


def visible_to(
    df: DataFrame, columns: list[str], granted: DataFrame, scope: str, who: str, user: str, everything: Column | None = None
) -> DataFrame:
    """The rows of ``df`` that one user sees: of a scope granted to the user in any of ``columns``, or all of them.

    ``granted`` is a linear list (``grants``); ``everything`` tells the rows of a user who sees all, by default those of the
    scope ``ALL``. That branch is one scalar in the filter. The other marks rows by a left join with the user's distinct
    scopes for each column, whose left side can be split where a scope is hot; no row is listed twice.
    """
    given = df.columns
    mine = granted.where(F.upper(who) == user.upper())
    whole = _sees_all(scope, everything)
    own = mine.where(~whole & F.col(scope).isNotNull()).select(F.col(scope).alias("__scope")).distinct()
    seen = mine.where(whole).agg(F.count("*").alias("n")).scalar() > 0
    for i, c in enumerate(columns):
        side = own.select(F.col("__scope").alias(f"__scope{i}"))
        df = df.join(side, F.col(c) == F.col(f"__scope{i}"), "left")
        seen = seen | F.col(f"__scope{i}").isNotNull()
    return df.where(seen).select(*given)


def rows_seen(
    df: DataFrame, columns: list[str], granted: DataFrame, scope: str, who: str, sums: dict[str, Column],
    everything: Column | None = None,
) -> DataFrame:
    """(``who``, ``rows``, ``sums``) for every user of a linear list: how many rows of ``df`` the user sees, and totals of them.

    Rows are added up for each combination of scopes before they meet the list, so a hot scope is one row there; a user who
    is granted several scopes of a combination counts it once, and one who sees everything is given the total.
    """
    adds = {"rows": F.count("*"), **{name: F.sum(c) for name, c in sums.items()}}
    cells = df.groupBy(*columns).agg(*[c.alias(name) for name, c in adds.items()])
    user = F.upper(who)
    whole = _sees_all(scope, everything)
    everyone = granted.where(whole).select(user.alias("__who")).distinct()
    local = granted.where(~whole & F.col(scope).isNotNull()).select(user.alias("__who"), F.col(scope).alias("__scope")).distinct()
    local = local.join(everyone, "__who", "left_anti")
    places = cells.withColumn("__at", F.explode(F.array_distinct(F.array(*columns))))
    met = places.join(local, F.col("__at") == F.col("__scope"))
    once = met.groupBy("__who", *columns).agg(*[F.first(name).alias(name) for name in adds])
    zero = {name: F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in adds}
    seen = once.groupBy(F.col("__who").alias("__seer")).agg(*[F.sum(name).alias(name) for name in adds])
    users = local.select("__who").distinct().join(seen, F.col("__who") == F.col("__seer"), "left").drop("__seer")
    users = users.select("__who", *[F.coalesce(name, F.lit(0)).alias(name) for name in adds])
    total = cells.agg(*zero.values())
    entire = everyone.select("__who", *[total.select(name).scalar().alias(name) for name in adds])
    return users.unionByName(entire).withColumnRenamed("__who", who)


def apply_entitlements(df: DataFrame, entitlements: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key somebody is entitled to."""
    return df.join(entitlements.select(*on).distinct(), on, "left_semi")
