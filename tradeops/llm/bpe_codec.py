"""Byte-pair encoding to token ids, and back.

A word's symbols are a doubly linked list; a priority queue holds the neighbours that can merge, by rank and then place. The
first is merged, its new neighbours go into the queue, and an entry whose pair is no longer there is skipped when it comes
up. So a word of n symbols takes n log n steps. Ids decode by concatenating the strings of the vocabulary, as the file's
decoder joins them.

What comes before words is read from the tokenizer file: special strings are cut out first, then the text is normalised and
split. A step of the file that is not known here is an error. Characters newer than Unicode 13 may be split, ordered or lower-cased
otherwise than by the library, whose tables are of another version.

Defined cases: a null or empty text has no ids, and null or no ids decode to the empty text; special strings inside texts
are their one id; texts of any length are encoded whole, words of any length too (a bounded table keeps only short ones);
repeated rows are encoded like any other; further columns pass through.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .byte_pairs import PIECES, _byte_alphabet

WORDS, LONG = 700_000, 64  # words kept in a worker's table, and characters of the longest of them
# Fixed value: the splitting pattern of the word file, and the same for texts of ASCII characters, where `re` is faster.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z]+|[0-9]|[^\sA-Za-z0-9]+"


def _lower(text: str) -> str:
    """Every character by itself: no final form of sigma."""
    return text.replace("Σ", "σ").lower()


def _normaliser(step: dict | None, spaceless: bool) -> Callable[[str], str]:
    """``spaceless``: the splitter drops white space, so steps that only change one kind of it for another are left out."""
    if step is None:
        return lambda t: t
    kind = step["type"]
    if kind == "Sequence":
        spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
        steps = [_normaliser(s, spaceless) for s in step["normalizers"] if not (spaceless and s == spaces)]

        def every(text: str) -> str:
            for s in steps:
                text = s(text)
            return text

        return every
    if kind == "NFC":
        return lambda t: t if t.isascii() else unicodedata.normalize("NFC", t)
    if kind == "Lowercase":
        return _lower
    if kind == "Replace" and "Regex" in step["pattern"]:
        pattern, content = regex.compile(step["pattern"]["Regex"]), step["content"].replace("\\", "\\\\")
        return lambda t: pattern.sub(content, t)
    raise ValueError(f"unknown normaliser {step}")


def _splitter(step: dict) -> tuple[Callable[[str], list[str]], bool]:
    """(words of a normalised text, whether they never hold white space); their bytes are mapped to the file's characters later."""
    parts = step["pretokenizers"] if step["type"] == "Sequence" else [step]
    *split, bytewise = parts
    if bytewise["type"] != "ByteLevel" or bytewise["add_prefix_space"] or bytewise.get("use_regex", True) == bool(split):
        raise ValueError(f"unknown pre-tokenizer {step}")
    if not split:
        return PIECES.findall, False
    if len(split) == 1 and split[0]["type"] == "Split" and split[0]["behavior"] == "Removed" and split[0]["invert"]:
        pattern = split[0]["pattern"]["Regex"]
        if pattern != WORD_PATTERN:
            return regex.compile(pattern).findall, False
        whole, ascii_only = regex.compile(pattern).findall, re.compile(ASCII_PATTERN, re.ASCII).findall
        return lambda t: ascii_only(t) if t.isascii() else whole(t), True
    raise ValueError(f"unknown pre-tokenizer {step}")


class _Table(dict):
    """Ids of words, learned as they are met; long words are not kept."""

    def __init__(self, learn: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.learn(word)
        if len(word) <= LONG:
            self[word] = ids
        return ids


class Codec:
    """The vocabulary and merges of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        added = spec["added_tokens"]
        odd += [t["content"] for t in added if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"unknown settings {odd or model['type']}")
        self.split, spaceless = _splitter(spec["pre_tokenizer"])
        self.normal = _normaliser(spec["normalizer"], spaceless)
        vocab, self.end = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)}
        self.bytes = {byte: char for char, byte in _byte_alphabet().items()}
        self.inside = [vocab[self.bytes[b]] for b in range(256)]
        self.last = [vocab[self.bytes[b] + self.end] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in added}
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        if spec["decoder"] not in (None, {}) and spec["decoder"]["type"] != "ByteLevel":
            raise ValueError(f"unknown decoder {spec['decoder']}")
        self.bytewise = bool(spec["decoder"])
        self.table = _Table(self.word)

    def word(self, word: str) -> tuple[int, ...]:
        """The ids of one word."""
        data = word.encode()
        symbols: list[int | None] = [*map(self.inside.__getitem__, data[:-1]), self.last[data[-1]]]
        n, known = len(symbols), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        found = map(known, zip(symbols, symbols[1:]))
        queue = [(merge[0], i) for i, merge in enumerate(found) if merge is not None]
        heapify(queue)
        while queue:
            rank, i = heappop(queue)
            j = after[i]
            merge = known((symbols[i], symbols[j])) if j < n else None
            if merge is None or merge[0] != rank:
                continue  # stale: one of the pair has been merged since
            symbols[i], symbols[j] = own, _ = merge[1], None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (right := known((own, symbols[k]))) is not None:
                    heappush(queue, (right[0], i))
            h = before[i]
            if h >= 0 and (left := known((symbols[h], own))) is not None:
                heappush(queue, (left[0], h))
        return tuple([s for s in symbols if s is not None])

    def _ordinary(self, text: str) -> list[int]:
        if len(self.table) > WORDS:
            self.table.clear()
        return list(chain.from_iterable(map(self.table.__getitem__, self.split(self.normal(text)))))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.cut is None or not any(s in text for s in self.special):
            return self._ordinary(text)
        out: list[int] = []
        for part in self.cut.split(text):
            out += [self.special[part]] if part in self.special else self._ordinary(part)
        return out

    def decode(self, ids) -> str:
        if ids is None or not len(ids):
            return ""
        strings = map(self.strings.__getitem__, ids.tolist() if hasattr(ids, "tolist") else ids)
        if not self.bytewise:
            return " ".join(strings)  # without a decoder of its own, the file's tokens are set apart
        byte = _bytes_of()
        data = bytearray()
        for s in strings:
            known = [byte.get(c) for c in s]
            data += s.encode() if None in known else bytes(known)
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=1)
def _bytes_of() -> dict[str, int]:
    return _byte_alphabet()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One table for each worker process."""
    return Codec(path)


def encoded(tokenizer: str, text: Column) -> Column:
    """array<int>: the ids of a text column."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = codec(tokenizer).encode
        for batch in batches:
            yield batch.map(of)

    return encode(F.coalesce(text, F.lit("")))


def decoded(tokenizer: str, ids: Column) -> Column:
    """The text of a column of ids."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = codec(tokenizer).decode
        for batch in batches:
            yield batch.map(of)

    return decode(ids)


def with_tokens(df: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", back: str | None = None) -> DataFrame:
    """``df`` with the ``ids`` of ``text`` and, if named, the text ``back`` from them."""
    df = df.withColumn(ids, encoded(tokenizer, df[text]))
    return df if back is None else df.withColumn(back, decoded(tokenizer, df[ids]))
