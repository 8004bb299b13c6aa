"""Line deduplication over content-defined chunks of lines.

DataFrame functions only. Lines are hashed; a rolling hash over the last ``WINDOW`` line hashes ends a chunk wherever it is 0
modulo ``DIVISOR``, so boundaries follow content and come back in step after lines were inserted or removed. A chunk of
several lines that occurs more than once in the corpus is kept at its first place (smallest doc_id, then position) and
removed elsewhere, if its bytes are those of the first place, not just its hash.

``dedup_runs`` goes beyond chunks: a line goes if, with the line before or behind it, it is a pair that stands at an earlier
place, so a repeated run of two lines or more goes whole, wherever chunks end. Each line taken out stays at an earlier place.

Only hashes travel in the search: text is sent for chunks that repeat, and documents meet no other documents.

Defined cases: a null text stays null; an empty one has one empty line and is kept; chunks of one line are never removed;
rows equal in ``doc_id`` and text are one place and do not remove each other's chunks; a null ``doc_id`` counts as smallest; a document whose chunks are all removed keeps the empty text; ``removed_lines`` is 0 where nothing was
removed; empty input gives no row. Other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged

WINDOW, DIVISOR = 2, 4
MODULUS, BASE = 2147483647, 48271  # fixed values: a prime that keeps products inside 64 bits, and a multiplier


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 7), 16, 10).cast("long")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, not once for every element a higher-order function visits."""
    return F.transform(F.array(value), use)[0]


def chunked(text: Column) -> Column:
    """array<struct<lines, text>>: the chunks of a text, with their numbers of lines."""

    def ends(hashes: Column) -> Column:
        def rolling(i: Column) -> Column:
            value = F.lit(0).cast("long")
            for back in range(WINDOW - 1, -1, -1):
                value = (value * BASE + F.coalesce(F.get(hashes, i - back), F.lit(0))) % MODULUS
            return value

        last = F.size(hashes) - 1
        return F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (rolling(i) % DIVISOR == 0))

    def cut(lines: Column, ends: Column) -> Column:
        def chunk(end: Column, i: Column) -> Column:
            start = F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1) + 1)
            length = end - start + 1
            return F.struct(length.alias("lines"), F.array_join(F.slice(lines, start + 1, length), "\n").alias("text"))

        return F.transform(ends, chunk)

    return _bound(
        F.split(text, "\n", -1),
        lambda lines: _bound(
            F.transform(lines, line_hash), lambda hashes: _bound(ends(hashes), lambda stops: cut(lines, stops))
        ),
    )


def repeated_chunks(chunks: DataFrame) -> DataFrame:
    """The places (doc_id, row, at) of chunks to remove, from ``chunks`` (doc_id, row, at, lines, text)."""
    several = chunks.where("lines > 1").select(F.xxhash64("text").alias("hash"), "text", F.struct("doc_id", "row", "at").alias("place"))
    repeated = (
        several.groupBy("hash")
        .agg(F.min("place").alias("first"), F.max("place").alias("last"))
        .where("first <> last")
        .select("hash", "first")
    )
    found = staged(several.join(repeated, "hash"), "repeated-chunks")
    kept = found.where("place = first").groupBy("hash").agg(F.min("text").alias("kept"))
    return found.where("place <> first").join(kept, "hash").where("text = kept").select("place.*").distinct()


def dedup_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with repeated chunks taken out of ``text``, and ``removed_lines``."""
    return _without(docs, repeated_chunks(_units(docs, text, chunked)), text, chunked)


def _lines(text: Column) -> Column:
    return F.transform(F.split(text, "\n", -1), lambda line: F.struct(F.lit(1).alias("lines"), line.alias("text")))


def _pairs(text: Column) -> Column:
    def pair(lines: Column) -> Column:
        after = F.slice(lines, F.lit(2), F.size(lines) - 1)
        return F.zip_with(F.slice(lines, F.lit(1), F.size(lines) - 1), after, lambda a, b: F.struct(F.lit(2).alias("lines"), F.concat(a, F.lit("\n"), b).alias("text")))

    return _bound(F.split(text, "\n", -1), pair)


def dedup_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with repeated runs of two lines or more taken out of ``text``, and ``removed_lines``."""
    pairs = repeated_chunks(_units(docs, text, _pairs))
    lines = pairs.select("doc_id", "row", F.explode(F.array(F.col("at"), F.col("at") + 1)).alias("at"))
    return _without(docs, lines, text, _lines)


def _units(docs: DataFrame, text: str, cut) -> DataFrame:
    """(doc_id, row, at, lines, text) of the parts into which ``cut`` takes the texts."""
    units = docs.where(F.col(text).isNotNull()).select("doc_id", F.xxhash64(text).alias("row"), F.posexplode(cut(F.col(text))))
    return units.select("doc_id", "row", F.col("pos").alias("at"), "col.lines", "col.text")


def _without(docs: DataFrame, places: DataFrame, text: str, cut) -> DataFrame:
    """``docs`` without the parts of ``cut`` that stand at ``places`` (doc_id, row, at), and ``removed_lines``."""
    given = docs.columns
    docs = docs.withColumn("_row", F.xxhash64(text))
    gone = places.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("at")).alias("_gone"))
    gone = gone.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_of"), "_gone")
    marked = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_doc"]) & (docs["_row"] == gone["_of"]), "left")

    # One flag a chunk, so that each is looked up in constant time: zeros between the removed places, ones there.
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get("_gone", i - 1))
    flags = F.split(F.array_join(F.transform("_gone", lambda at, i: F.concat(F.repeat(F.lit("0"), at - before(i) - 1), F.lit("1"))), ""), "")

    def clean(chunks: Column) -> Column:
        def use(flags: Column) -> Column:
            left = F.filter(chunks, lambda c, i: F.coalesce(F.get(flags, i), F.lit("0")) != "1")
            out = F.filter(chunks, lambda c, i: F.get(flags, i) == "1")
            return F.struct(
                F.array_join(left["text"], "\n").alias("text"),
                F.aggregate(out["lines"], F.lit(0).cast("long"), lambda n, k: n + k).alias("lines"),
            )

        return _bound(flags, use)

    done = marked.withColumn("_done", F.when(F.col("_gone").isNotNull(), _bound(cut(F.col(text)), clean)))
    return done.select(
        *[F.coalesce("_done.text", F.col(text)).alias(text) if c == text else F.col(c) for c in given],
        F.coalesce("_done.lines", F.lit(0)).cast("long").alias("removed_lines"),
    )
