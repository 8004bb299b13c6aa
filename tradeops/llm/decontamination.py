"""Benchmark decontamination by latent semantic retrieval.

Passages of ``WINDOW`` words are TF-IDF vectors over hashed words; weights come from passage counts over the whole corpus. A
distributed randomised singular value decomposition gives ``RANK`` directions of these vectors, and passages are compared by
cosine there, without the first ``COMMON`` directions. A pair of cosine ``NEAR`` or more (``NEAR_SHORT`` for items of fewer
words than a passage) is a candidate: around it, the longest common subsequence of words must hold ``SAME`` of the item's words, and ``ANSWERED`` of those of its answer (behind its last answer mark, else its last
sentence). So copies, and paraphrases that keep most words in order, are found wherever they stand.

Before the projection, pairs are left out that cannot hold ``SAME`` of the item's words, whatever their cosine: a region may
miss at most ``n - SAME * n`` words of an item, so of the ``m`` rarest it has all but so many. Segments of ``SEGMENT`` words,
long enough for every region that begins in them, are looked up by these words; no pair that would pass the last checks
is lost. An item of fewer than ``WINDOW`` words is compared with passages of its own length.

The decomposition is fitted to every passage of every text and item, each text once; it starts from the directions of a bounded
sample (``SAMPLE`` documents and items). Weights, projection and search cover every passage of every text, too. Benchmark
vectors are broadcast in blocks of at most ``BLOCK`` words of text.

Defined cases: null, empty and wordless documents or items match nothing; texts of fewer than ``WINDOW`` words are one
passage; a document row is returned once for each item row it holds, so repeated rows and ids repeat; an empty
benchmark or corpus gives no row; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import staged
from .common import release_memory
from .shingle_sets import CELLS, cell_counts, word_hashes

WINDOW, STRIDE, STEP = 16, 4, 4  # words of a passage, and between passages of documents and of items
RANK, OVERSAMPLING, POWERS, SAMPLE, TASKS = 64, 16, 2, 4000, 2
NEAR, SAME, ANSWERED = 0.5, 0.6, 0.5
NEAR_SHORT = 0.25  # cosine from which an item shorter than a passage is a candidate: one replaced word turns it further
SEGMENT, RARE = 128, 0.25  # words of a segment; share of an item's words that are looked up beyond those it may miss
COMMON = 4  # leading directions left out of the comparison: what all passages of a language share
BLOCK = 200_000
LIFT, BLOCKS = 64, 64  # blocks of rows in which matrices are summed and worked on
PORTION, PART = 1 << 22, 1 << 10  # characters that a task works on at once, and words whose wide rows it holds
SIZE = 3  # characters of text that a byte of staged cells stands for, about
TASK_WORDS = 1 << 24  # words a task has at least where all texts are fitted, as each task sends its sums
ANSWER = re.compile(r"\b(?:answer|ans|a)\s*:", re.IGNORECASE)

_IN_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)], np.int8)


def words(text: str | None) -> np.ndarray:
    return word_hashes((text or "").encode(), _IN_WORD)


def cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(48)).astype(np.int64)


def starts(n: int, stride: int, width: int = WINDOW) -> np.ndarray:
    """Where passages of a text of ``n`` words begin; the last one ends with the text."""
    if n <= width:
        return np.zeros(min(n, 1), np.int64)
    return np.unique(np.append(np.arange(0, n - width + 1, stride), n - width))


def _passage_cells(text: str | None) -> np.ndarray:
    """Each cell once for every passage (end to end) that has it."""
    c = cells(words(text)).astype(np.uint16)
    whole = len(c) // WINDOW * WINDOW
    passages = np.sort(c[:whole].reshape(-1, WINDOW), axis=1)
    first = np.ones(passages.shape, bool)
    first[:, 1:] = passages[:, 1:] != passages[:, :-1]
    return np.concatenate([passages[first], np.unique(c[whole:])])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    counts = cell_counts(texts, _passage_cells)
    return np.log(1 + counts.sum() / WINDOW / (1 + counts)).astype(np.float32)


def _entries(texts, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, cell, weight) of the TF-IDF vectors of passages end to end, each of length 1; and their number."""
    rows, columns, at = [], [], 0
    for t in texts:
        c = np.frombuffer(t, np.uint16) if isinstance(t, bytes | bytearray) else cells(words(t))
        rows.append(at + np.arange(len(c)) // WINDOW)
        columns.append(c)
        at += -(-len(c) // WINDOW)
    row, column = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (rows, columns))
    weight = idf[column]
    norm = np.sqrt(np.bincount(row, weight * weight, minlength=at)) + 1e-9
    return row, column, (weight / norm[row]).astype(np.float32), at


def _summed(out: np.ndarray, to: np.ndarray, rows: np.ndarray, of: np.ndarray, weight: np.ndarray) -> None:
    """Adds ``rows[of]`` times ``weight`` to the rows ``to`` of ``out``; ``to`` ascends. Only ``PART`` wide rows are made at once."""
    wide = np.empty((min(len(to), PART), rows.shape[1]), np.float32)
    for at in range(0, len(to), PART):
        part = slice(at, at + PART)
        begins = np.flatnonzero(np.diff(to[part], prepend=-1))
        products = np.take(rows, of[part], axis=0, out=wide[: len(to[part])], mode="clip")
        products *= weight[part, None]
        out[to[part][begins]] += np.add.reduceat(products, begins, axis=0)


def _portions(texts) -> Iterator[list]:
    """``texts`` (or their staged cells) in order, in lists of ``PORTION`` characters, or one longer text."""
    some, size = [], 0
    for t in texts:
        own = len(t or "") * (SIZE if isinstance(t, bytes | bytearray) else 1)
        if some and size + own > PORTION:
            yield some
            some, size = [], 0
        some.append(t)
        size += own
    if some:
        yield some


def _products(texts, idf: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    row, column, weight, n = _entries(texts, idf)
    # Passages side by side, short ones filled up with words of no weight.
    slot = row * WINDOW + np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row]
    column_of, weight_of = np.zeros(n * WINDOW, np.uint16), np.zeros((n, 1, WINDOW), np.float32)
    column_of[slot], weight_of.reshape(-1)[slot] = column, weight
    del slot
    y = np.empty((n, 1, right.shape[1]), np.float32)
    few = max(PART // WINDOW, 1)
    for at in range(0, n, few):
        some = right[column_of[at * WINDOW : (at + few) * WINDOW]].astype(np.float32)
        np.matmul(weight_of[at : at + few], some.reshape(-1, WINDOW, right.shape[1]), out=y[at : at + few])
    return row, column, weight, y[:, 0]


def _half(matrix: np.ndarray) -> np.ndarray:
    """Half the bytes to broadcast; entries of orthonormal columns are small, so they are lifted into the exact range."""
    return (matrix * LIFT).astype(np.float16)


def directions(texts: DataFrame, idf: np.ndarray, rank: int = RANK, seed: int = 11) -> np.ndarray:
    """(CELLS, rank): right singular vectors of the passages of ``texts`` times ``LIFT``, by randomised subspace iteration.

    Each task sends one block sum of each step, so ``texts`` have few partitions, or many words in each.
    """
    return _iterated(texts, idf, np.random.default_rng(seed).standard_normal((CELLS, rank + OVERSAMPLING), np.float32), POWERS, rank)


def refined(texts: DataFrame, idf: np.ndarray, start: np.ndarray, seed: int = 12) -> np.ndarray:
    """`directions` of ``texts``, beginning with those of a part of them in place of random ones."""
    basis = np.random.default_rng(seed).standard_normal((CELLS, start.shape[1] + OVERSAMPLING), np.float32)
    basis /= np.float32(np.sqrt(CELLS))
    basis[:, : start.shape[1]] = start
    basis[:, : start.shape[1]] /= LIFT
    return _iterated(texts, idf, basis, POWERS, start.shape[1])


def _iterated(texts: DataFrame, idf: np.ndarray, basis: np.ndarray, powers: int, rank: int) -> np.ndarray:
    """Subspace iteration from ``basis``, which is used up. ``texts`` has one column: texts, or the cells of their words as bytes."""
    context = texts.sparkSession.sparkContext
    width = basis.shape[1]
    rows = CELLS // BLOCKS

    def transposed(matrix: np.ndarray) -> np.ndarray:
        """A'A matrix: blocks of it, summed over tasks. The driver takes one block at a time into one array."""
        right = context.broadcast(matrix)

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((CELLS, width), np.float32)
            for some in _portions(t for batch in batches for t in batch.iloc[:, 0]):
                row, column, weight, y = _products(some, idf_.value, right.value)
                order = np.argsort(column.astype(np.uint16), kind="stable")
                _summed(total, column[order], y, row[order], weight[order])
                del row, column, weight, y, order
            for i in range(BLOCKS):  # one at a time: a frame of all of them is copied whole on its way
                yield pd.DataFrame({"block": [i], "sums": [total[i * rows : (i + 1) * rows].tobytes()]})
            del total
            release_memory()

        def add(batch: pd.DataFrame) -> pd.DataFrame:
            total = np.zeros(rows * width)
            for b in batch["sums"]:
                total += np.frombuffer(b, np.float32)
            return pd.DataFrame({"block": batch["block"][:1], "sums": [total.astype(np.float32).tobytes()]})

        blocks = texts.mapInPandas(work, "block int, sums binary").groupBy("block").applyInPandas(add, "block int, sums binary")
        out = np.zeros((CELLS, width), np.float32)
        for r in blocks.toLocalIterator():  # CELLS x width numbers in all
            out[r["block"] * rows : (r["block"] + 1) * rows] = np.frombuffer(r["sums"], np.float32).reshape(rows, width)
        right.destroy()
        out /= LIFT
        return out

    idf_ = context.broadcast(idf)  # CELLS numbers
    _orthonormal(basis)
    for _ in range(powers):
        basis = transposed(_half(basis))
        _orthonormal(basis)
    half = _half(basis)
    del basis
    again = transposed(half)
    idf_.destroy()
    # basis' A'A basis has the squared singular values; its eigenvectors turn the basis onto the singular vectors.
    gram = sum(half[at : at + rows].astype(np.float64).T @ again[at : at + rows] for at in range(0, CELLS, rows)) / LIFT
    del again
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    turn = vector[:, ::-1][:, :rank].astype(np.float32)
    return np.concatenate([(half[at : at + rows].astype(np.float32) @ turn).astype(np.float16) for at in range(0, CELLS, rows)])


def _orthonormal(matrix: np.ndarray) -> None:
    """Makes the columns of a tall matrix orthonormal in place, block by block; directions of no weight become small noise.

    Twice through the small Gram matrix: the second time what rounding has left is gone.
    """
    step = CELLS // BLOCKS
    noise = np.random.default_rng(17)
    for turn in range(2):
        parts = [slice(at, at + step) for at in range(0, len(matrix), step)]
        gram = sum(matrix[p].astype(np.float64).T @ matrix[p] for p in parts)
        value, vector = np.linalg.eigh(gram)
        weak = value <= value[-1] * 1e-10
        if turn == 0 and weak.any():
            # Fewer passages than columns: fill up with random directions.
            scale = np.sqrt(max(float(value[-1]), 1.0) / len(matrix))
            for p in parts:
                block = matrix[p] @ vector.astype(np.float32)
                block[:, weak] = noise.standard_normal((len(block), int(weak.sum())), np.float32) * np.float32(scale)
                matrix[p] = block
            gram = sum(matrix[p].astype(np.float64).T @ matrix[p] for p in parts)
            value, vector = np.linalg.eigh(gram)
        whiten = (vector / np.sqrt(np.maximum(value, 1e-30))).astype(np.float32)
        for p in parts:
            matrix[p] = matrix[p] @ whiten


def project(hashes: np.ndarray, at: np.ndarray, idf: np.ndarray, basis: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Unit vectors of the passages of ``width`` words that begin ``at``."""
    width = min(width, len(hashes))
    c = cells(hashes)[at[:, None] + np.arange(width)]
    out = np.einsum("pwr,pw->pr", basis[c, COMMON:].astype(np.float32, copy=False), idf[c])
    return out / (np.linalg.norm(out, axis=1, keepdims=True) + 1e-9)


def common_length(item: np.ndarray, region: np.ndarray) -> int:
    """Length of the longest common subsequence; one bit a word of ``item``."""
    marks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        marks[w] = marks.get(w, 0) | 1 << i
    every = (1 << len(item)) - 1
    row = every
    for w in region.tolist():
        hit = row & marks.get(w, 0)
        row = (row + hit | row - hit) & every
    return len(item) - row.bit_count()


def answer(text: str) -> str:
    marks = list(ANSWER.finditer(text))
    if marks and words(text[marks[-1].end() :]).size:
        return text[marks[-1].end() :]
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n", text) if words(s).size >= 3]
    return sentences[-1] if sentences else text


@dataclass
class Index:
    """Benchmark items and the unit vectors of their passages."""

    ids: list
    items: list[np.ndarray]
    answers: list[np.ndarray]
    known: list[frozenset]  # different words of each item
    least: list[int]  # how many of its words a region must have in order
    vectors: np.ndarray
    owner: np.ndarray  # item of each vector
    place: np.ndarray  # first word of each vector
    first: np.ndarray  # first vector of each item, and their number behind the last
    width: np.ndarray  # words of an item's passages
    begins: np.ndarray  # for each cell, where its postings begin
    stops: np.ndarray  # and end
    looked_up: np.ndarray  # whether there are any
    posted: np.ndarray  # items that have the cell among their rare words
    times: np.ndarray  # how often
    needed: np.ndarray  # how many of its rare words a region must have
    reach: int  # words of the longest region


def least_common(n: int) -> int:
    """The least number of an item's ``n`` words that a region must have in order."""
    return next(k for k in range(int(SAME * n), n + 1) if k / n >= SAME)


def around(n: int) -> int:
    """Words before and behind an item's place that belong to its region."""
    return n // 4 + 4


def build_index(rows: list, idf: np.ndarray, basis: np.ndarray) -> Index:
    ids, items, answers, vectors, owner, place = [], [], [], [], [], []
    cell, item, times, needed = [], [], [], []
    for item_id, text in rows:
        h = words(text)
        if len(h):
            at = starts(len(h), STEP)
            vectors.append(project(h, at, idf, basis))
            owner.append(np.full(len(at), len(ids)))
            place.append(at)
            missed = len(h) - least_common(len(h))
            m = min(missed + max(int(RARE * len(h)), 1), len(h))
            c = cells(h)
            rare, count = np.unique(c[np.argsort(-idf[c], kind="stable")[:m]], return_counts=True)
            cell.append(rare)
            times.append(count)
            item.append(np.full(len(rare), len(ids)))
            needed.append(m - missed)
            ids.append(item_id)
            items.append(h)
            answers.append(words(answer(text)))
    empty = np.zeros(0, np.int64)
    cell, item, times, owner, place = (np.concatenate([empty, *x]) for x in (cell, item, times, owner, place))
    order = np.argsort(cell, kind="stable")
    begins, stops = (np.searchsorted(cell[order], np.arange(CELLS), side=side) for side in ("left", "right"))
    unit = np.concatenate([np.zeros((0, basis.shape[1] - COMMON), np.float32), *vectors])
    lengths = np.array([len(h) for h in items], np.int64)
    return Index(
        ids, items, answers, [frozenset(h.tolist()) for h in items], [least_common(len(h)) for h in items], unit, owner, place, np.searchsorted(owner, np.arange(len(ids) + 1)), np.minimum(lengths, WINDOW),
        begins, stops, stops > begins, item[order], times[order], np.array(needed, np.int64), max((len(h) + 2 * around(len(h)) for h in items), default=0),
    )


def _possible(c: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(segment, item) pairs in which a region that begins in the segment may have enough of the item's words; sorted."""
    total = len(index.ids)
    here = np.flatnonzero(index.looked_up[c])
    # A word is in its own segment, and in those before from which regions reach it.
    own = here // SEGMENT
    keys = []
    for back in range(-(-index.reach // SEGMENT) + 1):
        inside = (own >= back) & (here < (own - back + 1) * SEGMENT + index.reach)
        keys.append((own[inside] - back) * CELLS + c[here[inside]])
    keys = np.sort(np.concatenate(keys))
    keys = keys[np.diff(keys, prepend=-1) > 0]
    segment, cell = keys // CELLS, keys % CELLS
    out = []
    size = max((1 << 20) // total, 1)  # segments counted at once
    for low in range(0, int(segment[-1]) + 1 if len(segment) else 0, size):
        part = slice(*np.searchsorted(segment, [low, low + size]))
        counts = index.stops[cell[part]] - index.begins[cell[part]]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        posting = np.repeat(index.begins[cell[part]], counts) + within
        pair = np.repeat(segment[part] - low, counts) * total + index.posted[posting]
        # Each of the segment's words counts as often as the item has it: no fewer than a region can have.
        shared = np.bincount(pair, index.times[posting], size * total if low + size <= segment[-1] else int(segment[-1] - low + 1) * total)
        out.append(np.flatnonzero(shared.reshape(-1, total) >= index.needed) + low * total)
    found = np.concatenate([np.zeros(0, np.int64), *out])
    return found // total, found % total


def matches(text: str | None, index: Index, idf: np.ndarray, basis: np.ndarray) -> list[tuple[int, float, float, int]]:
    """(item number, cosine, share of the item's words in order, first word of the region) for every item in the text."""
    h = words(text)
    if not len(h) or not index.ids:
        return []
    segments, numbers = _possible(cells(h), index)
    best: dict[int, tuple[float, float, int]] = {}
    places: dict[int, np.ndarray] = {}  # by width
    edges = np.flatnonzero(np.diff(segments, prepend=-1, append=-1)) if len(segments) else []
    for low_edge, high_edge in zip(edges[:-1], edges[1:]):
        begin, here = int(segments[low_edge]) * SEGMENT, numbers[low_edge:high_edge]
        here = np.array([i for i in here.tolist() if i not in best], np.int64)
        for width in np.unique(index.width[here]).tolist():
            if width not in places:
                places[width] = starts(len(h), STRIDE if width == WINDOW else max(min(width // 4, STRIDE), 1), width)
            at = places[width][slice(*np.searchsorted(places[width], [begin, begin + SEGMENT + index.reach]))]
            if len(at):
                _look(h, begin, at, here[index.width[here] == width], width, index, idf, basis, best)
    return [(number, *found) for number, found in sorted(best.items())]


def _look(h, begin: int, at: np.ndarray, here: np.ndarray, width: int, index: Index, idf: np.ndarray, basis: np.ndarray, best: dict) -> None:
    """Adds to ``best`` those items of ``here`` that passages ``at``, of ``width`` words, find in regions of a segment."""
    vector = np.concatenate([np.arange(index.first[i], index.first[i + 1]) for i in here.tolist()])
    cosine = project(h, at, idf, basis, width) @ index.vectors[vector].T
    row, column = np.nonzero(cosine >= (NEAR if width == WINDOW else NEAR_SHORT))
    tried = set()
    for i in np.argsort(-cosine[row, column], kind="stable"):
        v = vector[column[i]]
        number = int(index.owner[v])
        if number in best:
            continue
        item, expected = index.items[number], index.answers[number]
        n = len(item)
        place = int(at[row[i]] - index.place[v])
        low, high = max(place - around(n), 0), place + n + around(n)
        if low // SEGMENT * SEGMENT != begin:
            continue  # another segment's
        if (number, place) in tried:
            continue  # other passages of the same place
        tried.add((number, place))
        region = h[low:high]
        known = index.known[number]
        if sum([w in known for w in region.tolist()]) < index.least[number]:
            continue  # too few words of the item in any order
        same = common_length(item, region) / n
        if same >= SAME and common_length(expected, region) >= ANSWERED * len(expected):
            best[number] = (float(cosine[row[i], column[i]]), same, low)


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, item_id, cosine, common_share, first_word) for every row of ``docs`` and item of ``benchmark`` it holds."""
    search = _searcher(docs.select(F.col(text).alias("text")), benchmark)
    return docs.select("doc_id", F.inline(search(text)))


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item of ``benchmark``, each judged by its own text; ids play no part."""
    search = _searcher(docs.select(F.col(text).alias("text")), benchmark)
    return docs.where(F.size(search(text)) == 0)


def _searcher(docs: DataFrame, benchmark: DataFrame):
    """A function of a text column that gives the array of hits; all ``docs`` (text) are fitted. Texts are read once for all blocks."""
    spark = docs.sparkSession
    context = spark.sparkContext
    bench = staged(benchmark.select("item_id", F.col("text").alias("item")), "benchmark")
    idf = inverse_frequencies(docs)
    total = max(docs.count(), 1)
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(min(1.0, SAMPLE / total) * (1 << 20)) + 1
    some = bench.orderBy(F.xxhash64("item"), "item").limit(SAMPLE)
    # Each text once, those of smallest hash: the same whatever the partitions and however many copies there are.
    texts = docs.where(draw).groupBy(F.xxhash64("text").alias("mark")).agg(F.min("text").alias("text"))
    drawn = texts.orderBy("mark").limit(SAMPLE).select("text")
    fitted = staged(drawn.union(some.select("item")).repartition(TASKS), "passages")
    basis = refined(_all_cells(docs, bench), idf, directions(fitted, idf))
    weights = context.broadcast((idf, basis))  # CELLS x (RANK + 1) numbers

    size = bench.agg(F.sum(F.length("item"))).first()[0] or 0
    blocks = -(-size // (BLOCK * 6)) or 1
    indexes = []
    for block in range(blocks):
        rows = bench.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(blocks)) == block).select("item_id", "item").collect()
        indexes.append(context.broadcast(build_index([tuple(r) for r in rows], idf, basis)))
    del idf, basis
    return _search(indexes, weights, bench.schema["item_id"].dataType.simpleString())


def _all_cells(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The cells of the words of every text and item, two bytes a word; texts of the same cells are one row.

    They are sorted where they lie, so that sums are the same in every run.
    """

    @F.pandas_udf("binary")
    def coded(texts: pd.Series) -> pd.Series:
        return pd.Series([cells(words(t)).astype(np.uint16).tobytes() for t in texts], dtype=object)

    texts = docs.select("text").union(bench.select("item")).select(coded("text").alias("cells")).where(F.length("cells") > 0)
    out = staged(texts.distinct().sortWithinPartitions("cells"), "cells")
    size = out.agg(F.sum(F.length("cells"))).first()[0] or 0
    return out.coalesce(-(-size // (2 * TASK_WORDS)) or 1)


def _search(indexes, weights, id_type: str):
    hit = f"array<struct<item_id:{id_type}, cosine:double, common_share:double, first_word:bigint>>"

    @F.pandas_udf(hit)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        idf, basis = weights.value
        basis = basis.astype(np.float32)  # once, and not for every passage
        for batch in batches:
            found = [[] for _ in batch]
            for index in indexes:
                for hits, t in zip(found, batch):
                    hits += [(index.value.ids[n], *rest) for n, *rest in matches(t, index.value, idf, basis)]
            yield pd.Series(found, dtype=object)
        del basis
        release_memory()

    return search
