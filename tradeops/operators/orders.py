"""Order lines: numbering, quantities left, grouping by freight order, light rollup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import STAGES, pieces_of
from ..functions.text import choose
from .grouping import first_row_order, join_groups
from .ranking import list_rows, numbers_by_group


def number_lines(lines: DataFrame, po: str = "po_no", line: str = "id", name: str = "_line_no") -> DataFrame:
    """Running number of the lines of an order by line id."""
    return numbers_by_group(lines, [po], [line], name)


def shipped_quantity(links: DataFrame, key: str = "purchase_order_id", quantity: str = "quantity") -> DataFrame:
    return links.groupBy(F.col(key).alias("__line")).agg(F.sum(quantity).alias("__shipped"))


def remaining_quantity(lines: DataFrame, links: DataFrame, keep: str = "positive", line: str = "id",
                       ordered: str = "po_qty_ordered") -> DataFrame:
    """Ordered minus shipped per order line as ``remaining_quantity``.

    ``keep``: 'positive' only lines with something left, 'all' every line.
    """
    out = lines.join(shipped_quantity(links), F.col(line) == F.col("__line"), "left")
    shipped = F.coalesce(F.col("__shipped"), F.lit(0))
    out = out.withColumns(
        {
            "shipped_quantity": shipped,
            "remaining_quantity": F.coalesce(F.col(ordered), F.lit(0)) - shipped,
        }
    ).drop("__line", "__shipped")
    return out.where(F.col("remaining_quantity") > 0) if keep == "positive" else out


def balance_pieces(balance: Column | str, unit: Column | str) -> Column:
    return pieces_of(balance, unit)


def collapse_by_primary(
    df: DataFrame,
    key: str,
    split: str,
    order: list[str],
    from_primary: list[str],
    largest: dict[str, Column],
    texts: list[str],
    others: str,
    sep: str = " | ",
    about: list[DataFrame] | None = None,
) -> DataFrame:
    """One row per ``key``, led by its first row in ``order``.

    ``from_primary`` come from that row, ``largest`` are maxima over all rows,
    ``texts`` list their distinct values, and ``others`` lists the distinct
    ``split`` values of the rows that are not the first. ``about`` are further columns of keys, in frames grouped by ``__key``, a
    struct of the key as below: they meet the reduced rows where these lie.

    ``df`` is read once for maxima of fixed width, once for the first row and longest texts, and once for the lists: pass a table
    or a staged result. Each is reduced where the rows lie, by key or by (key, value), so a key with very many rows is spread
    and wide rows neither travel nor are sorted.
    """
    rows = df.withColumn("__key", F.struct(F.col(key)))  # never NULL, so the parts are joined by plain equality
    whole = F.struct(*[F.col(c) for c in from_primary], F.col(split).alias("__split"))
    by_key = rows.groupBy("__key")
    kinds = {f.name: f.dataType for f in df.agg(F.lit(0).alias("__none"), *[expr.alias(name) for name, expr in largest.items()]).schema}
    fixed = [n for n in largest if isinstance(kinds[n], T.NumericType | T.DateType | T.TimestampType | T.BooleanType)]
    numbers = by_key.agg(F.count("*").alias("__rows"), *[largest[n].alias(n) for n in fixed])
    firsts = by_key.agg(
        F.min_by(whole, first_row_order(*order)).alias("__lead"), *[expr.alias(n) for n, expr in largest.items() if n not in fixed]
    )
    named = [F.struct(F.lit(i).alias("__list"), F.col(c).cast("string").alias("__value")) for i, c in enumerate([split, *texts])]
    counted = rows.select("__key", F.inline(F.array(*named))).groupBy("__key", "__list", "__value").agg(F.count("*").alias("__n"))
    entry = F.struct(F.col("__value").alias("v"), F.col("__n").alias("n"))
    known = F.col("__value").isNotNull()
    lists = counted.groupBy("__key").agg(
        *[F.collect_list(F.when(known & (F.col("__list") == i), entry)).alias(f"__list_{i}") for i in range(len(named))]
    )
    grouped = firsts.join(numbers, "__key").join(lists, "__key")
    more = []
    for side in about or []:
        more += [c for c in side.columns if c != "__key"]
        grouped = grouped.join(side, "__key", "left")
    lead_only = F.filter("__list_0", lambda s: ~(s["v"].eqNullSafe(F.col("__lead.__split").cast("string")) & (s["n"] == 1)))

    def listing(entries: Column) -> Column:
        values = F.transform(entries, lambda s: s["v"])
        return F.nullif(F.array_join(F.array_sort(F.array_distinct(values)), sep), F.lit(""))

    return grouped.select(
        F.col(f"__key.{key}").alias(key),
        *[F.col(f"__lead.{c}").alias(c) for c in from_primary],
        *largest,
        *[listing(F.col(f"__list_{i}")).alias(t) for i, t in enumerate(texts, 1)],
        listing(lead_only).alias(others),
        *more,
    )


def order_list_rows(df: DataFrame, key: str, split: str, order: list[str], texts: list[str], others: str) -> DataFrame:
    """(key, list, position, value): the lists of `collapse_by_primary` as child rows.

    The first row in ``order`` is found as one narrow value a key and joined back; ``others`` lists the ``split`` values of
    the other rows.
    """
    rank = first_row_order(*order)
    narrow = df.select(key, split, *texts, rank.alias("__rank"))
    lead = narrow.groupBy(F.col(key).alias("__key")).agg(F.min("__rank").alias("__lead"))
    counted = narrow.groupBy(key, split).agg(F.min("__rank").alias("__rank"), F.count("*").alias("__n"))
    led = counted.join(lead, F.col(key).eqNullSafe(F.col("__key")), "left")
    secondary = led.where(~((F.col("__rank") == F.col("__lead")) & (F.col("__n") == 1)))
    arms = [secondary.select(key, F.lit(others).alias("list"), F.col(split).alias("value"))]
    named = [F.struct(F.lit(t).alias("list"), F.col(t).alias("value")) for t in texts]
    arms.append(narrow.select(key, F.inline(F.array(*named))))
    return list_rows(arms[0].unionByName(arms[1]), [key, "list"], "value", distinct=True).drop("times")


# Bits of a row's lights. OTHER stands for any colour but yellow; above it, one bit a stage that is done.
RED, YELLOW, GREEN, OTHER, DONE = 1, 2, 4, 8, 16


def light_mask(stages: tuple[str, ...] = STAGES) -> Column:
    """A row's lights as one integer; absent lights add nothing."""
    mask = F.lit(0)
    for i, s in enumerate(stages):
        colour = F.col(s)
        bits = F.when(colour == "red", RED | OTHER).when(colour == "yellow", YELLOW).when(colour == "green", GREEN | OTHER)
        bits = bits.when(colour == "dark green", OTHER | DONE << i).when(colour.isNotNull(), OTHER).otherwise(0)
        mask = mask.bitwiseOR(bits)
    return mask


def rolled_light(mask: Column | str, balance: Column | str, stages: int = len(STAGES)) -> Column:
    """Light of a whole order line from the bits of its shipped lines, NULL where it has none.

    Quirk kept: with a balance left, any colour other than yellow also makes
    the line yellow.
    """
    mask, balance = (F.col(c) if isinstance(c, str) else c for c in (mask, balance))
    has = lambda bits: mask.bitwiseAND(F.lit(bits)) != 0
    done = DONE * ((1 << stages) - 1)
    rules = [
        (mask.isNull() | has(RED), "red"),
        (has(YELLOW | OTHER) & (balance > 0), "yellow"),
        (has(GREEN) & (balance == 0), "green"),
        ((mask.bitwiseAND(F.lit(done)) == done) & (balance == 0), "dark green"),
    ]
    return choose([(cond, F.lit(colour)) for cond, colour in rules])


def light_rollup(masters: DataFrame, shipped: DataFrame, keys: list[str], balance: str, name: str,
                 stages: tuple[str, ...] = STAGES) -> DataFrame:
    """Give each master line the light of its shipped lines: one integer a row, one aggregate a key."""
    masks = shipped.groupBy(*keys).agg(F.bit_or(light_mask(stages)).alias("__mask"))
    return join_groups(masters, masks, keys).withColumn(name, rolled_light("__mask", balance, len(stages))).drop("__mask")
