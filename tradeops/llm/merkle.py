"""Merkle trees over the rows of a table, by sibling-shift self-joins.

Each tree's leaves are numbered from 0. On every level a node joins the nodes at its sibling indices (index XOR 1 for binary
trees, slot offsets modulo the arity otherwise), so it knows what stands before and after it in its run; the node in slot 0
then emits the parent, the hash of the run. Runs hold ``arity`` nodes, the last one of a level maybe fewer, even one. Levels are
written tables of hashes: the next is a projection of the last, and none is ever in one task or on the driver.

Proofs go down again: a node's steps are its own, then those of its parent, found by index. So a level ships half as many
rows as the one below, and leaves meet the steps of all levels in one join.

Hashes are lowercase hex sha256 of concatenated hex texts; tables hold them as bytes.

Defined cases: null trees are a tree of their own, before all others; leaves with a null order value come last; rows equal in
tree, order and leaf are leaves of their own, next to each other; a tree of one leaf is that leaf; no rows give no rows.
Columns other than those named pass through, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.grouping import join_groups
from ..operators.ranking import row_numbers
from ..sources.staging import staged

TOGETHER = 6  # levels of proofs between two written tables

_STEPS = "array<struct<before:binary,after:binary>>"


def field(value: Column) -> Column:
    """A value as hash input: ``-`` if null, else its UTF-8 byte count, a colon and its text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def hashed(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf (hex) leads to."""
    return F.aggregate(steps, leaf, lambda own, s: hashed(_hex(s["before"]), own, _hex(s["after"])))


def proof_digest(steps: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: _hex(F.concat(s["before"], s["after"]))), ""), 256)


def _level(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (_tree, _i, _width, _digest) with what stands ``_before`` and ``_after`` each in its run."""
    slot, none = F.col("_i") % arity, F.unhex(F.lit(""))
    before, after = [none], [none]
    out = nodes
    for offset in range(1, arity):
        index = F.col("_i").bitwiseXOR(F.lit(1)) if arity == 2 else F.col("_i") - slot + (slot + offset) % arity
        other = nodes.select(F.col("_tree").alias("_t"), F.col("_i").alias("_j"), F.col("_digest").alias(f"_s{offset}"))
        out = out.join(other, (F.col("_tree") == F.col("_t")) & (index == F.col("_j")), "left").drop("_t", "_j")
        # Behind the last slot, offsets begin again with slot 0; either part comes in the order of slots.
        sibling = F.coalesce(F.col(f"_s{offset}"), none)
        before.append(F.when(slot + offset >= arity, sibling).otherwise(none))
        after.append(F.when(slot + offset < arity, sibling).otherwise(none))
    out = out.withColumns({"_before": F.concat(*before), "_after": F.concat(*after)})
    return out.drop(*[f"_s{o}" for o in range(1, arity)])


def _trees(leaves: DataFrame, arity: int) -> tuple[DataFrame, DataFrame]:
    """(``leaves`` with ``_steps`` up to their tree's root, roots (_tree, _digest)) of leaves (_tree, _i, _digest, ..)."""
    widths = leaves.groupBy("_tree").agg(F.count("*").alias("_width"))
    nodes = join_groups(leaves, widths, ["_tree"])
    widest = widths.agg(F.max("_width")).first()[0] or 0  # one number
    levels = [staged(_level(nodes, arity), "level")]
    while widest > 1:
        widest = -(-widest // arity)
        run = hashed(_hex(F.col("_digest")), _hex(F.col("_after")))
        parents = levels[-1].where((F.col("_width") > 1) & (F.col("_i") % arity == 0)).select(
            "_tree",
            (F.col("_i") / arity).cast("long").alias("_i") if arity & (arity - 1) else F.shiftright("_i", arity.bit_length() - 1).alias("_i"),
            F.ceil(F.col("_width") / arity).alias("_width"),
            F.unhex(run).alias("_digest"),
        )
        levels.append(staged(_level(parents, arity), "level"))
    roots = reduce(DataFrame.union, [x.where("_width = 1").select("_tree", "_digest") for x in levels])

    own = F.when(F.col("_width") > 1, F.array(F.struct(F.col("_before").alias("before"), F.col("_after").alias("after"))))
    own = F.coalesce(own, F.array().cast(_STEPS)).cast(_STEPS)
    steps = None
    for k, level in reversed(list(enumerate(levels))):
        if steps is None:
            level = level.withColumn("_steps", own)
        else:
            above = steps.select(F.col("_tree").alias("_t"), F.col("_i").alias("_j"), F.col("_steps").alias("_above"))
            parent = F.floor(F.col("_i") / arity) if arity & (arity - 1) else F.shiftright("_i", arity.bit_length() - 1)
            meets = (F.col("_tree") == F.col("_t")) & (parent == F.col("_j")) & (F.col("_width") > 1)
            level = level.join(above, meets, "left").withColumn("_steps", F.concat(own, F.coalesce("_above", F.array().cast(_STEPS))))
        steps = level.select(*levels[k].columns, "_steps") if k == 0 else level.select("_tree", "_i", "_steps")
        if k and k % TOGETHER == 0:
            steps = staged(steps, "steps")
    return steps.drop("_width", "_digest", "_before", "_after"), roots


def manifest(rows: DataFrame, tree: str, order: str, leaf: str, arity: int = 2) -> DataFrame:
    """``rows`` with ``subroot`` (of the tree), ``root`` (of all trees) and ``steps`` from leaf to root.

    ``leaf`` is a column of hex digests. Trees' leaves ascend by ``order``, trees by their key; ``root`` stands over the trees'
    roots like these over their leaves. ``fold`` and ``proof_digest`` evaluate the steps.
    """
    if arity < 2:
        raise ValueError("a run holds two nodes or more")
    given = rows.columns
    taken = {"subroot", "root", "steps"} & set(given)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are the result's")
    # Given columns travel as one, so that none can clash with the operator's own.
    row = rows.select(
        F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("")).alias("_tree"),
        F.col(order).alias("_order"),
        F.unhex(F.col(leaf)).alias("_digest"),
        F.struct(*[F.col(f"`{c}`") for c in given]).alias("_row"),
    )
    numbered = row_numbers(staged(row, "leaves"), ["_tree"], ["_order", "_digest"], "_n")
    leaves = numbered.select("_tree", (F.col("_n") - 1).alias("_i"), "_digest", "_row")
    documents, roots = _trees(leaves, arity)
    tops = row_numbers(roots.select(F.lit("").alias("_all"), "_tree", "_digest"), ["_all"], ["_tree"], "_n")
    upper, root = _trees(tops.select(F.col("_all").alias("_tree"), (F.col("_n") - 1).alias("_i"), "_digest", F.col("_tree").alias("_of"), F.col("_digest").alias("_subroot")), arity)
    upper = upper.join(root.select("_tree", F.col("_digest").alias("_root")), "_tree")
    upper = upper.select("_of", "_subroot", "_root", F.col("_steps").alias("_higher"))
    whole = documents.join(upper, documents["_tree"] == upper["_of"])
    return whole.select(
        "_row.*",
        _hex(F.col("_subroot")).alias("subroot"),
        _hex(F.col("_root")).alias("root"),
        F.concat("_steps", "_higher").alias("steps"),
    )
