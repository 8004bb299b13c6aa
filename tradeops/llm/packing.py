"""Best-fit packing of token pieces into sequences, by exact complements first.

The pieces of a corpus are known by their lengths, of which there are at most ``size``. So the whole plan is made from
the histogram of lengths (at most ``size`` numbers, however large the corpus): single, pair and triple sums that exactly fill
the gap beside a length are used up under their availability counts, and what remains goes best-fit, longest first. Each step
uses up a length or a group of equal bins, so the plan too is bounded by ``size``. Each task numbers its pieces of a
length as it makes them, the tasks' counts give where its numbers start, and number and plan give sequence and offset: no
piece meets the others of its length or sequence, and none is sorted.

Defined cases: a null text is an empty one and consists of the end token alone; repeated rows are packed like any other;
empty input gives no row; documents longer than ``size`` are cut so that only the first piece may be shorter; white space and
words of any length are encoded whole. Columns of pieces that the packing does not name pass through, whatever their names.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import count

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import staged
from .bpe_codec import codec
from .byte_pairs import PIECES, byte_pairs
from .common import release_memory


class Encoder:
    """Token ids of whole texts.

    The splitting pattern looks ahead of white space, for which the library gives up on runs of about a million characters. By the
    same pattern such a run is one word, without its last character if more text follows; so long runs are taken out before.
    """

    def __init__(self, path: str, long_run: int = 10_000):
        pairs = byte_pairs(path)
        special = pairs.special
        self.plain = tiktoken.Encoding("packing", pat_str=PIECES.pattern, mergeable_ranks=pairs.ids, special_tokens=special)
        self.special, self.long = special, long_run
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.run = regex.compile(rf"\s{{{long_run},}}")
        self.path = path

    def encode(self, text: str) -> list[int]:
        if len(text) < self.long or not self.run.search(text):
            return self.plain.encode(text, allowed_special="all")
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            at = 0
            for run in self.run.finditer(part):
                end = run.end() - (run.end() < len(part))
                out += self.plain.encode_ordinary(part[at : run.start()])
                out += codec(self.path).word(part[run.start() : end])  # loaded only where such a text occurs
                at = end
            out += self.plain.encode_ordinary(part[at:])
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process."""
    return Encoder(path)


def cut(ids: list[int], size: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's token ids."""
    ends = list(range(len(ids) % size or size, len(ids) + 1, size)) if len(ids) > size else [len(ids)]
    data, start = np.asarray(ids, dtype="<u4"), 0
    for piece, end in enumerate(ends):
        yield piece, start, end - start, zlib.crc32(data[start:end].tobytes())
        start = end


def token_pieces(docs: DataFrame, tokenizer: str, size: int, end_token: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, place): each document's ids and ``end_token``, cut to at most ``size``.

    ``place`` counts the pieces of a length within a task.
    """

    @F.pandas_udf("array<struct<piece:int, start:bigint, length:bigint, ids_crc32:bigint, place:bigint>>")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(tokenizer).encode
        places = [count() for _ in range(size + 1)]
        for batch in batches:
            cuts = (cut([*encode(t), end_token], size) for t in batch)
            yield pd.Series([[(*piece, next(places[piece[2]])) for piece in pieces] for pieces in cuts], dtype=object)
        release_memory()

    return docs.select("doc_id", F.inline(pieces(F.coalesce("text", F.lit("")))))


@dataclass(frozen=True)
class Pattern:
    """``bins`` sequences that each hold ``runs``: (length, copies), in this order."""

    runs: tuple[tuple[int, int], ...]
    bins: int


def _runs(lengths: list[int]) -> tuple[tuple[int, int], ...]:
    return tuple((x, lengths.count(x)) for x in sorted(set(lengths), reverse=True))


def exact_patterns(left: np.ndarray, size: int, sums: int = 3) -> list[Pattern]:
    """Use up, from ``left`` (availability by length), a length and one to ``sums`` others that sum to ``size``."""
    out: list[Pattern] = []

    def use(*lengths: int) -> None:
        runs = _runs(list(lengths))
        bins = min(int(left[x]) // k for x, k in runs)
        if bins > 0:
            for x, k in runs:
                left[x] -= bins * k
            out.append(Pattern(runs, bins))

    if left[size]:
        use(size)
    for a in range(size - 1, 0, -1):  # single
        if left[a] and left[size - a]:
            use(a, size - a)
    for a in range(size - 1, 0, -1) if sums >= 2 else ():
        gap = size - a
        for b in range(gap // 2, 0, -1):  # pair b + (gap - b)
            if not left[a]:
                break
            if left[b] and left[gap - b]:
                use(a, gap - b, b)
    for a in range(size - 1, 0, -1) if sums >= 3 else ():
        gap = size - a
        for b in range(gap - 2, 0, -1):  # triple b + c + (gap - b - c)
            if not left[a]:
                break
            if not left[b]:
                continue
            rest = gap - b
            low = np.arange(1, rest // 2 + 1)
            for c in low[(left[low] > 0) & (left[rest - low] > 0)]:
                use(a, b, int(c), int(rest - c))
                if not left[a] or not left[b]:
                    break
    return out


def best_fit_patterns(left: np.ndarray, size: int) -> list[Pattern]:
    """Best-fit decreasing over what is left, bins of equal content handled together."""
    gaps: list[int] = []  # sorted, those with bins
    bins: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}

    def put(runs: tuple[tuple[int, int], ...], many: int) -> None:
        gap = size - sum(x * k for x, k in runs)
        if gap not in bins:
            insort(gaps, gap)
            bins[gap] = []
        bins[gap].append((runs, many))

    def take(least: int) -> tuple[tuple[tuple[int, int], ...], int, int] | None:
        at = bisect_left(gaps, least)
        if at == len(gaps):
            return None
        gap = gaps[at]
        runs, many = bins[gap].pop()
        if not bins[gap]:
            del bins[gap], gaps[at]
        return runs, many, gap

    for x in range(size, 0, -1):
        todo = int(left[x])
        while todo:
            runs, many, gap = take(x) or ((), todo, size)
            each = min(gap // x, todo)
            used = min(many, todo // each)
            put((*runs, (x, each)), used)
            todo -= used * each
            if runs and many > used:
                put(runs, many - used)
        left[x] = 0
    return [Pattern(runs, many) for groups in bins.values() for runs, many in groups]


def plan(histogram: dict[int, int], size: int) -> list[Pattern]:
    """The plan with the fewest sequences among those that use exact sums of up to three, two or one lengths."""
    plans = []
    for sums in (3, 2, 1):
        left = np.zeros(size + 1, dtype=np.int64)
        for length, count in histogram.items():
            left[length] = count
        plans.append(exact_patterns(left, size, sums) + best_fit_patterns(left, size))
    return min(plans, key=lambda patterns: sum(p.bins for p in patterns))


def _slots(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first number, copies a bin, first sequence, offset), sorted by length and first number."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for p in patterns:
        offset = 0
        for x, k in p.runs:
            first = taken.get(x, 0)
            rows.append((x, first, k, sequence, offset))
            taken[x] = first + p.bins * k
            offset += x * k
        sequence += p.bins
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, size: int) -> DataFrame:
    """``pieces`` (with ``length`` from 1 to ``size`` and ``place``) and their ``sequence_id`` and ``offset``."""
    given = [c for c in pieces.columns if c not in ("place", "sequence_id", "offset")]
    # Given columns travel as one, so that none can clash with those of the plan.
    row = F.struct(*[F.col(f"`{c}`") for c in given]).alias("row")
    pieces = staged(pieces.select("length", "place", F.spark_partition_id().alias("task"), row), "pieces")
    counts = pieces.groupBy("length", "task").count()
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0)))
    bases = staged(bases, "bases")
    histogram = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # <= size rows
    slots = _slots(plan(histogram, size))
    keys = slots[:, 0] << 48 | slots[:, 1]

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def slot(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        number = number.to_numpy()
        at = np.searchsorted(keys, length.to_numpy() << 48 | number, side="right") - 1
        x, first, each, sequence, offset = slots[at].T
        nth = number - first
        return pd.DataFrame({"sequence_id": sequence + nth // each, "offset": offset + nth % each * x})

    numbered = pieces.join(bases.drop("count"), ["length", "task"])
    return numbered.select("row", slot("length", F.col("base") + F.col("place")).alias("slot")).select("row.*", "slot.sequence_id", "slot.offset")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 1024, end_token: int = 2) -> DataFrame:
    return pack(token_pieces(docs, tokenizer, size, end_token), size)
