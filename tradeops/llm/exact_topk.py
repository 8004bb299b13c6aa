"""Exact top-k search by inner product over integer vectors.

Vectors are written once, by descending length in ranges. Each query gets a first bound from the longest of them. Then queries
are broadcast in blocks of bounded bytes, one block after another, and every task goes through its own vectors where they
are, longest first, and keeps the best ``k`` for each query of the block: no vector moves to meet a query, and a task sends ``k``
rows a query at most. A task stops once lengths allow no score above the bounds (Cauchy-Schwarz), and files of vectors too
short for a whole block are not read. Both sides are rotated onto the principal axes of all vectors (an orthogonal matrix from the
distributed second moment); the first axes give a partial sum, and the lengths of the rest bound what is missing. Only
pairs that this bound lets through are scored, in exact integer arithmetic. The bounds carry a slack above their rounding
error, so nothing that belongs into a result is lost.

Defined cases: a vector that is null or holds a null or non-finite component takes no part; shorter vectors count as padded
with zeros; an empty vector is the zero vector; ties go to the smaller ``vec_id`` (null last); a row never answers itself, other rows
with its ``vec_id`` do; queries with fewer than ``k`` candidates return all; components and scores beyond 64 bits saturate (and then
tie); further columns are ignored; empty input gives no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import staged

BLOCK, QUERIES, STRIP = 4096, 2048, 512  # longest vectors for the first bounds; queries and vectors compared at once
BROADCAST = 16 << 20  # bytes of a block of queries
NO_ID = (1 << 63) - 1
_MOST = float(1 << 63)


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, x as double."""
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")))


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite), F.lit(False))


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T without any rounding."""
    most = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return a.astype(float) @ b.T.astype(float)
    if most < 1 << 62:
        return a @ b.T
    return a.astype(object) @ b.T.astype(object)


def axes(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthonormal columns, the direction of largest second moment first."""

    def moments(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = matrix(batch["x"], width).astype(float)
            total += x.T @ x
        yield pd.DataFrame({"cell": np.arange(width * width), "v": total.ravel()})

    cells = vectors.select("x").mapInPandas(moments, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros(width * width)
    total[cells["cell"].to_numpy(dtype=np.int64)] = cells["v"].to_numpy(dtype=float)
    return np.linalg.eigh(total.reshape(width, width))[1][:, ::-1]


class Best:
    """The best ``k`` vectors for each of the queries ``q`` (uid, x, norm, bound), as vectors go by."""

    def __init__(self, q: pd.DataFrame, rotation: np.ndarray, k: int):
        self.k, self.rotation, self.head = k, rotation, max(1, len(rotation) // 4)
        self.x = matrix(q["x"], len(rotation))
        self.y = self.x @ rotation
        self.rest = np.sqrt((self.y[:, self.head :] ** 2).sum(axis=1))
        self.norm, self.uid = q["norm"].to_numpy(dtype=float), q["uid"].to_numpy()
        self.low = q["bound"].to_numpy(dtype=float).copy()
        self.best: list[list[tuple]] = [[] for _ in range(len(q))]

    def feed(self, c: pd.DataFrame) -> None:
        """Looks at the vectors ``c`` (vec_id, uid, x, norm)."""
        # Descending length; vec_id decides ties in the end, uid between rows of one vec_id.
        c = c.sort_values(["norm", "vec_id", "uid"], ascending=[False, True, True], ignore_index=True)
        norm = c["norm"].to_numpy(dtype=float)
        if not len(c) or not self._alive(norm[0]).any():
            return
        x, uid, ids = matrix(c["x"], len(self.rotation)), c["uid"].to_numpy(), c["vec_id"].to_numpy()
        y = x @ self.rotation
        rest = np.sqrt((y[:, self.head :] ** 2).sum(axis=1))
        for at in range(0, len(c), STRIP):
            strip = slice(at, at + STRIP)
            alive = np.flatnonzero(self._alive(norm[at]))
            if not len(alive):
                return  # later vectors are shorter still
            for part in range(0, len(alive), QUERIES):
                self._compare(alive[part : part + QUERIES], x[strip], y[strip], rest[strip], norm[at], uid[strip], ids[strip])

    def _slack(self, longest: float) -> np.ndarray:
        return 1e-9 * self.norm * longest + 1e-6

    def _alive(self, longest: float) -> np.ndarray:
        return self.norm * longest >= self.low - self._slack(longest)

    def _compare(self, alive, x, y, rest, longest: float, uid, ids) -> None:
        slack, head, k = self._slack(longest), self.head, self.k
        most = self.y[alive, :head] @ y[:, :head].T + np.outer(self.rest[alive], rest)
        open_ = most >= (self.low - slack)[alive, None]
        rows = np.flatnonzero(open_.any(axis=1))
        if not len(rows):
            return
        cols = np.flatnonzero(open_.any(axis=0))
        scores = products(self.x[alive[rows]], x[cols])
        for i, r in enumerate(rows):
            me = alive[r]
            take = np.flatnonzero(open_[r, cols])
            found = scores[i, take]
            near = (found >= self.low[me] - slack[me]) & (uid[cols[take]] != self.uid[me])
            found, at = found[near], cols[take[near]]
            if not len(at):
                continue
            order = np.lexsort((uid[at], ids[at], -found))[:k] if found.dtype != object else sorted(
                range(len(found)), key=lambda j: (-found[j], ids[at[j]], uid[at[j]])
            )[:k]
            own = sorted(self.best[me] + [(-int(found[j]), int(ids[at[j]]), int(uid[at[j]])) for j in order])[:k]
            self.best[me] = own
            if len(own) == k:
                self.low[me] = max(self.low[me], float(-own[-1][0]))

    def rows(self) -> pd.DataFrame:
        """(query, vec_id, uid, score)."""
        out = [(int(self.uid[i]), v, u, max(min(-s, NO_ID), -NO_ID - 1)) for i, b in enumerate(self.best) for s, v, u in b]
        return pd.DataFrame(out, columns=["query", "vec_id", "uid", "score"]).astype("int64")


def exact_topk(
    vectors: DataFrame, is_query: Column, k: int, scale: int = 256, vector: str = "embedding", vec_id: str = "vec_id"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` that ``is_query``, the ``k`` best other rows."""
    spark = vectors.sparkSession
    x = scaled(F.col(vector), scale)
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    prepared = staged(
        vectors.where(usable(F.col(vector)))
        .select(F.coalesce(vec_id, F.lit(NO_ID)).alias("vec_id"), x.alias("x"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
        .withColumn("norm", length)
        .withColumn("uid", F.monotonically_increasing_id()),
        "vectors",
    )
    seen = prepared.agg(
        F.max(F.size("x")).alias("width"), F.max("norm").alias("top"), F.min(F.when(F.col("norm") > 0, F.col("norm"))).alias("least")
    ).first()
    width = max(seen["width"] or 1, 1)
    rotation = spark.sparkContext.broadcast(axes(prepared, width))  # width^2 numbers

    if seen["top"] is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    vectors = prepared.select("vec_id", "uid", "x", "norm")
    # Ranges of length, longest first, each sorted: lengths of equal value may share a range.
    by_length = staged(vectors.repartitionByRange(F.desc("norm"), "uid").sortWithinPartitions(F.desc("norm")), "by-length")

    # A first bound from the longest vectors.
    first = spark.sparkContext.broadcast(by_length.orderBy(F.desc("norm"), "uid").limit(BLOCK // 4).toPandas())

    def bounds(batches):
        for batch in batches:
            batch["bound"] = -_MOST * _MOST
            longest = Best(batch, rotation.value, k)
            longest.feed(first.value)
            kth = longest.rows().groupby("query")["score"].agg(["size", "min"])
            kth = kth[(kth["size"] == k) & (kth["min"] > -NO_ID - 1)]["min"].astype(float)  # a saturated score bounds nothing
            batch["bound"] = batch["uid"].map(kth).fillna(-_MOST * _MOST).astype(float)
            yield batch[["uid", "vec_id", "x", "norm", "bound"]]

    queries = prepared.where("is_query").select("uid", "vec_id", "x", "norm")
    queries = staged(queries.mapInPandas(bounds, "uid bigint, vec_id bigint, x array<bigint>, norm double, bound double"), "queries")
    first.destroy()
    groups = -(-queries.count() * 8 * (width + 4) // BROADCAST) or 1

    found = None
    for group in range(groups):
        block = queries.where(F.pmod(F.xxhash64("uid"), F.lit(groups)) == group).drop("vec_id").toPandas()  # about BROADCAST bytes
        if len(block):
            block["x"] = list(matrix(block["x"], width))
            part = _block(by_length, spark.sparkContext.broadcast(block), rotation, k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "uid")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = queries.select(F.col("uid").alias("query"), F.col("vec_id").alias("query_id"))
    return ranked.join(names, "query").select(
        _id("query_id"), F.col("rank").cast("int").alias("rank"), _id("vec_id"), "score"
    )


def _block(vectors: DataFrame, queries, rotation, k: int) -> DataFrame:
    """(query, vec_id, uid, score): the best ``k`` of each file of ``vectors`` for a broadcast block of queries."""
    norm = queries.value["norm"].to_numpy(dtype=float)
    # Below this length no vector can reach the bound of any query of the block; such files are skipped by their statistics.
    reach = np.where(norm > 0, queries.value["bound"].to_numpy(dtype=float) / np.maximum(norm, 1e-300), -_MOST)
    least = float(reach.min()) * (1 - 1e-9) - 1e-6 if reach.min() > 0 else float(reach.min())

    def search(batches):
        best = Best(queries.value, rotation.value, k)
        for batch in batches:  # a task may read several files, so a short batch says nothing about the next
            best.feed(batch)
        yield best.rows()

    out = vectors.where(F.col("norm") >= least).mapInPandas(search, "query bigint, vec_id bigint, uid bigint, score bigint")
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "uid")
    ranked = out.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")
    ranked = staged(ranked, "found")
    queries.destroy()
    return ranked


def _id(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)
