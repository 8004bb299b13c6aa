"""Near duplicates by an exact join in the metric space of the Jaccard distance.

Points are documents' shingle sets. Two documents link if ``100 * |x & y| >= threshold * |x | y|``.

*Pivots.* In text, distances between documents concentrate at 1, and windows around documents as pivots would copy every
document into every region. So the first pivots are the points of the space with one shingle each, ordered rare first.
A document's Voronoi region is that of its first shingle: for any other pivot, distance or order is larger.
*Windows.* Linked sets differ by at most ``k`` of a set's shingles, ``k = n - ceil(threshold * n / 100)``. By the triangle
inequality a partner cannot lie behind the first ``k + 1`` pivots of a document, and among the first ``k + s`` at least ``s``
are shared; each document is copied into these boundary regions, with ``s = SHARED`` (or the size of the overlap, if less). Within a region, the distance to the empty set (the set's size) cuts rings: a document on a ring's upper
border is copied into the next ring, as sizes of linked sets differ by at most the factor ``threshold / 100``.
*Regions.* In a ring of at most ``SMALL`` documents all pairs are listed, and those listed by ``SHARED`` pivots are candidates;
pairs that also share a larger ring are found there. In a larger one a document becomes the pivot ``c``,
``TURNS`` times. Distances to it are taken in the space of signatures (class counts; the sum of their differences is at most
the symmetric difference). Documents up to ``R + k`` from ``c`` go into the ball of ``c``, those beyond ``R`` stay in the
ring, and a document between, on the boundary, is in both: linked documents are together in one of the two. The balls of a
family's many rings are one region, as they share their pivot. It is joined exactly on the whole sets, block against
block, after its pivot's own links; once two components meet, no more of their pairs are looked at, and only links that
join components come back. What stays in a ring behind its last pivot is joined in the same way, as a region named by its
document of least draw, so that a family's many rings are one; a ring above ``BLOCK`` is split again by the second shared
pivot first. So no group's pairs are listed, however many of them signatures allow.
*Exactness.* Every candidate pair is verified on the whole sets of 64-bit shingle hashes.

Equal sets are one point, so exact copies never meet; links inside a component once known are not listed again.

Defined cases: null, empty and wordless texts have the empty set and link with nothing; a document's component is its smallest
non-null ``doc_id``; rows that repeat a ``doc_id`` are documents of their own; empty input gives no row; further columns
are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..sources.staging import staged
from .common import release_memory
from .components import components
from .shingle_sets import codes, frequency_ranks, set_key, signature

SMALL = 8  # documents of a ring that are all compared at once
TURNS = 3  # documents that become pivot of a larger ring, one after the other
RADIUS = 0.25  # of a ball, as a share of its pivot's size
BLOCK = 1_000  # documents in a block
SHARED = 3  # pivots that linked documents have in common among those listed
FILTER = 1 << 20  # hash cells of a filter for documents, whatever their number
RING = 3  # a ring spans sizes from s to s / threshold^RING


def _least_overlap(n: Column, threshold: int) -> Column:
    return F.ceil(n * threshold / F.lit(100))


def _features(docs: DataFrame, text: str, size: int, threshold: int, ranks) -> DataFrame:
    """doc_id, mark, n, key, prefix (the pivots of its boundary regions, as signed numbers), signature."""

    @F.pandas_udf("n int, key binary, prefix array<bigint>, signature binary")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t in batch:
                c = codes(t, size, ranks.value)
                overlap = -(-threshold * len(c) // 100)
                prefix = c[: len(c) - overlap + min(SHARED, overlap)].view(np.int64)
                rows.append((len(c), set_key(c), prefix, signature(c).tobytes()))
            yield pd.DataFrame(rows, columns=["n", "key", "prefix", "signature"])
        release_memory()

    return docs.select("doc_id", "mark", features(F.col(text)).alias("f")).select("doc_id", "mark", "f.*")


def _rings(members: DataFrame, threshold: int) -> DataFrame:
    """``members`` once for their own ring (``home``) and, at its upper border, for the next."""
    step = -RING * math.log(threshold / 100) if threshold < 100 else 1.0
    level = lambda n: F.floor(F.log(n) / step + 1e-9)
    # A partner may be larger by 100 / threshold; a little more keeps rounding out of the way.
    upper = level(F.col("n") * (100 / threshold) * (1 + 1e-6))
    return members.withColumn("home", level(F.col("n"))).withColumn("ring", F.explode(F.sequence(F.col("home"), upper)))


def _sizes_fit(a: Column, b: Column, threshold: int) -> Column:
    return (100 * F.least(a, b)) >= (threshold * F.greatest(a, b))


@F.pandas_udf(IntegerType())
def _apart(x: pd.Series, y: pd.Series) -> pd.Series:
    """Distance of signatures."""
    both = [np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1).astype(np.int16) for s in (x, y)]
    return pd.Series(np.abs(both[0] - both[1]).sum(axis=1, dtype=np.int32))


def _distances(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with sizes ``n_a``, ``n_b`` and the distance of their signatures, ``apart``."""
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("signature").alias(f"s_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.withColumn("apart", _apart("s_a", "s_b")).drop("s_a", "s_b")


def _may_link(threshold: int) -> Column:
    """|x ^ y| = |x| + |y| - 2 |x & y|, and |x & y| >= threshold / (100 + threshold) * (|x| + |y|) of linked sets."""
    return F.col("apart") * (100 + threshold) <= (F.col("n_a") + F.col("n_b")) * (100 - threshold)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    side = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"x_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("x_a", "x_b"))
    return joined.where(100 * common >= threshold * (F.size("x_a") + F.size("x_b") - common)).select("a", "b")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    return members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _small_pairs(rings: DataFrame, key: list[str], threshold: int) -> DataFrame:
    """Pairs that have enough pivots in common; each pivot counts in the ring that is home to the larger document."""
    other = rings.select(*key, F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("home").alias("home_b"))
    least = F.least(F.lit(SHARED), _least_overlap(F.min("n"), threshold), _least_overlap(F.min("n_b"), threshold))
    return (
        rings.join(other, key)
        .where((F.col("node") < F.col("b")) & (F.col("ring") == F.greatest("home", "home_b")))
        .where(_sizes_fit(F.col("n"), F.col("n_b"), threshold))
        .groupBy(F.col("node").alias("a"), "b")
        .agg(F.count("*").alias("shared"), least.alias("least"))
        .where("shared >= least")
        .select("a", "b")
    )


def _turn(rings: DataFrame, key: list[str], classes: DataFrame, threshold: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """One document of each ring as its pivot: (distances (a: pivot, b) with ``ball``, the documents that stay in rings)."""
    pick = F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node")
    centres = rings.groupBy(*key).agg(F.min(pick)["node"].alias("a"), F.count("*").alias("rows")).where("rows > 1").drop("rows")
    placed = rings.join(centres, key)
    distances = _distances(placed.select("a", F.col("node").alias("b")).distinct(), classes)
    # A partner's distance to the pivot differs by at most k = n * (100 / threshold - 1), by its own size n.
    reach = F.col("n_a") * RADIUS + F.col("n_b") * (100 / threshold - 1) * (1 + 1e-6)
    distances = staged(distances.withColumn("ball", F.col("apart") <= reach), "distances")
    beyond = distances.where(F.col("apart") > F.col("n_a") * RADIUS).select("a", F.col("b").alias("node"))
    return distances, staged(placed.join(beyond, ["a", "node"], "left_semi").select(*key, "node", "n"), "beyond")


def _mixed(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows of groups that hold more than one component, with the group's number of rows."""
    groups = rows.groupBy(*key).agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("rows"))
    return rows.join(groups.where("c0 <> c1").select(*key, "rows"), key)


def _in_blocks(groups: DataFrame, key: list[str]) -> DataFrame:
    """``groups`` (with ``rows``) dealt to cells in which rows that are ``low`` meet those that are ``high``, each pair once."""
    blocks = F.ceil(F.col("rows") / F.lit(BLOCK)).cast("int")
    return (
        groups.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("cell", F.xxhash64(*key, F.least("own", "other"), F.greatest("own", "other")))
        .withColumn("low", F.col("own") <= F.col("other"))
        .withColumn("high", F.col("own") >= F.col("other"))
        .drop("own", "other", "rows")
    )


def _partners(batch: pd.DataFrame, signatures: np.ndarray, part: np.ndarray, threshold: int):
    """For each low row the high rows of another ``part`` (which may change meanwhile) that size and signature allow."""
    n, low, high = batch["n"].to_numpy().astype(np.int64), batch["low"].to_numpy(), np.flatnonzero(batch["high"].to_numpy())
    signatures = signatures.astype(np.int16)
    for i in np.flatnonzero(low):
        j = high[high > i] if batch["high"].iat[i] else high
        j = j[(part[j] != part[i]) & (100 * np.minimum(n[j], n[i]) >= threshold * np.maximum(n[j], n[i]))]
        if len(j):
            apart = np.abs(signatures[j] - signatures[i]).sum(axis=1)
            j = j[apart * (100 + threshold) <= (n[j] + n[i]) * (100 - threshold)]
        if len(j):
            yield i, j


def _partnered(balls: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """The rows of ``balls`` (ball, node, component, rows) that size and signature let link with another component of their ball."""
    dealt = _in_blocks(balls, ["ball"]).join(classes.select("node", "n", "signature"), "node")

    def compare(batch: pd.DataFrame) -> pd.DataFrame:
        signatures = np.frombuffer(b"".join(batch["signature"]), np.uint8).reshape(len(batch), -1)
        hit = np.zeros(len(batch), bool)
        for i, candidates in _partners(batch, signatures, batch["component"].to_numpy(), threshold):
            hit[candidates] = hit[i] = True
        return batch.loc[hit, ["ball", "node", "component"]]

    found = dealt.groupBy("cell").applyInPandas(compare, "ball bigint, node bigint, component bigint")
    found = staged(found.distinct(), "partnered")
    return found.join(found.groupBy("ball").agg(F.count("*").alias("rows")), "ball")


def _ball_links(balls: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links that join components inside each ball (ball, node, component, rows)."""
    dealt = _in_blocks(balls, ["ball"]).join(sets, "node").withColumn("n", F.size("shingles"))

    def join(batch: pd.DataFrame) -> pd.DataFrame:
        shingles, node, n = batch["shingles"].to_list(), batch["node"].to_numpy(), batch["n"].to_numpy().astype(np.int64)
        signatures = np.stack([signature(s.view(np.uint64)) for s in shingles])
        values, number = np.unique(np.concatenate(shingles), return_inverse=True)
        numbers, inside = np.split(number, np.cumsum(n)[:-1]), np.zeros(len(values), np.int64)
        part, found = batch["component"].to_numpy().copy(), []
        for i, candidates in _partners(batch, signatures, part, threshold):
            inside[numbers[i]] = 1
            begins = np.cumsum(n[candidates]) - n[candidates]
            common = np.add.reduceat(inside[np.concatenate([numbers[j] for j in candidates])], begins)
            inside[numbers[i]] = 0
            for j in candidates[100 * common >= threshold * (n[i] + n[candidates] - common)]:
                if part[i] != part[j]:
                    found.append((node[i], node[j]))
                    part[part == part[j]] = part[i]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return dealt.groupBy("cell").applyInPandas(join, "a bigint, b bigint")


def _regions(groups: DataFrame, key: list[str]) -> DataFrame:
    """(ball, node): ``groups`` (node) as regions named by their document of least draw, so that a family's many groups are one."""
    least = groups.groupBy(*key).agg(F.min(F.struct(F.xxhash64("node", F.lit(TURNS)).alias("draw"), "node"))["node"].alias("least"))
    return groups.join(least, key).select((-1 - F.col("least")).alias("ball"), "node")  # below 0, apart from pivots' balls


def _rest_regions(rings: DataFrame, key: list[str], classes: DataFrame) -> DataFrame:
    """(ball, node): regions of what stays in rings (node, n) behind their last pivot."""
    counted = rings.join(rings.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1"), key)
    # Few rings are that large; of their documents alone the pivots are listed again.
    crowded = staged(counted.where(F.col("rows") > BLOCK), "crowded")
    listed = classes.join(crowded.select("node").distinct(), "node", "left_semi")
    again = crowded.join(listed.select("node", F.explode("prefix").alias("second")), "node").where(F.col("second") != F.col("pivot"))
    # Each pair of pivots once: a document has both, so it meets the pair from either side.
    deeper = ["first", "second", "ring"]
    again = again.withColumn("first", F.least("pivot", "second")).withColumn("second", F.greatest("pivot", "second"))
    again = again.select(*deeper, "node").distinct()
    again = again.join(again.groupBy(*deeper).agg(F.count("*").alias("rows")).where("rows > 1"), deeper)
    return _regions(counted.where(F.col("rows") <= BLOCK).select(*key, "node"), key).union(_regions(again.select(*deeper, "node"), deeper))


def near_duplicates(docs: DataFrame, size: int = 5, threshold: int = 80, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text); ``threshold`` above 50."""
    return _grouped(docs, size, threshold, text).select("doc_id", "n_shingles", "component_id")


def row_mark(text: str = "text") -> Column:
    """Tells apart rows that share a ``doc_id`` or have none, by their text."""
    return F.xxhash64(text)


def repeated(docs: DataFrame, size: int = 5, threshold: int = 80, text: str = "text") -> DataFrame:
    """(doc_id, mark) of the rows that are not the kept one of their component; ``mark`` is ``row_mark``.

    Kept is the row of smallest ``doc_id``, a null one last; of texts that share this id, the one of smallest mark.
    """
    rows = _grouped(docs, size, threshold, text).where("n_shingles > 0")
    own = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "mark")
    return rows.where(~own.eqNullSafe(F.col("first"))).select("doc_id", "mark").distinct()


def _grouped(docs: DataFrame, size: int, threshold: int, text: str) -> DataFrame:
    """(doc_id, mark, n_shingles, component_id, first); ``first`` (absent, doc_id, mark) is the component's kept row."""
    if not 50 < threshold <= 100:
        raise ValueError("threshold is a percentage above 50")
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col(text).alias("text"), row_mark(text).alias("mark"))
    ranks = spark.sparkContext.broadcast(frequency_ranks(docs, "text", size))  # 2^16 numbers
    features = staged(_features(docs, "text", size, threshold, ranks), "features")
    classes = staged(
        features.where("n > 0")
        .groupBy("key")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "mark")).alias("first"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )

    # Boundary regions with at least two sets. Counting reads all columns of a posting, so that it shares the shuffle of
    # the rows it counts.
    postings = classes.select("node", "n", F.explode("prefix").alias("pivot"))
    shared = postings.groupBy("pivot").count().where("count > 1").select("pivot")
    rings = _rings(postings.join(shared, "pivot"), threshold)
    key = ["pivot", "ring"]
    populated = rings.groupBy(*key).agg(F.count("*").alias("rows"), F.max("node").alias("last")).where("rows > 1 and last is not null")
    rings = staged(rings.join(populated.drop("last"), key), "rings")

    small = rings.where(F.col("rows") <= SMALL).drop("rows")
    rest = rings.where(F.col("rows") > SMALL).drop("rows", "home")
    pairs = _distances(_small_pairs(small, key, threshold), classes).where(_may_link(threshold)).select("a", "b")
    balls = None
    for turn in range(TURNS):
        distances, rest = _turn(rest, key, classes, threshold, turn)
        pairs = pairs.union(distances.where(_may_link(threshold) & (F.col("a") != F.col("b"))).select("a", "b"))
        ball = distances.where("ball").select(F.col("a").alias("ball"), F.col("b").alias("node"))
        balls = ball if balls is None else balls.union(ball)
    balls = balls.union(_rest_regions(rest, key, classes))
    ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs, balls = staged(ordered.distinct(), "pairs"), staged(balls.distinct(), "balls")

    # Whole sets are large: they are built of those documents only that are compared, here and in the balls.
    def sets(wanted: DataFrame) -> DataFrame:
        return staged(_sets(docs, classes.join(wanted.distinct(), "node", "left_semi"), size, ranks), "sets")

    links = staged(_verified(pairs, sets(pairs.select(F.explode(F.array("a", "b")).alias("node"))), threshold), "links")
    mixed = staged(_mixed(_labelled(balls, components(links)), ["ball"]), "mixed")
    mixed = staged(_partnered(mixed, classes, threshold), "mixed")
    links = links.union(staged(_ball_links(mixed, sets(mixed.select("node")), threshold), "links"))
    labels = components(links)

    named = _labelled(classes.select("key", "node", "first"), labels)
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    names = named.join(least, "component").select("key", "least")
    return (
        features.select("doc_id", "mark", "n", "key")
        .join(names, "key", "left")
        .select(
            "doc_id",
            "mark",
            F.col("n").cast("long").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
            F.col("least").alias("first"),
        )
    )


def _sets(docs: DataFrame, classes: DataFrame, size: int, ranks) -> DataFrame:
    """(node, shingles) of ``classes``, computed again from one document of each."""

    @F.pandas_udf("key binary, shingles array<bigint>")
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coded = [codes(t, size, ranks.value) for t in batch]
            yield pd.DataFrame({"key": [set_key(c) for c in coded], "shingles": [c.view(np.int64) for c in coded]})
        release_memory()

    row = lambda of: F.xxhash64(f"{of}doc_id", f"{of}mark").alias("row")
    wanted = classes.select(row("first."), F.col("key").alias("wanted"), "node")
    # Most texts need not move: a table of at most FILTER hash cells of the wanted rows is broadcast and keeps them back.
    cell = F.pmod("row", F.lit(FILTER)).alias("cell")
    cells = F.broadcast(wanted.select(cell).distinct())
    docs = docs.select(row(""), "doc_id", "mark", "text").withColumn("cell", cell).join(cells, "cell", "left_semi").drop("cell")
    # Equal rows lie together by now; one text of each goes on, and a row whose hash met another's set is left out.
    found = docs.join(wanted, "row").groupBy("row", "doc_id", "mark", "node", "wanted").agg(F.first("text").alias("text"))
    # Not to be moved below the filter, where sets would be computed twice.
    sets = found.select("node", "wanted", whole.asNondeterministic()("text").alias("s"))
    return sets.where("s.key = wanted").select("node", "s.shingles")
