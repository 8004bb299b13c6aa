"""Byte-pair tables read from a public tokenizer file, and exact token counts of all prefixes of a word.

A sequence of tokens is the byte-pair encoding of its bytes exactly if every two neighbours are the encoding of their
own concatenation. So the last token of each prefix of a word follows from those of shorter prefixes, and with it the
prefix's count: ``count[p] = count[p - len(token)] + 1``.
"""

from __future__ import annotations

import json
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import regex

PIECES = regex.compile(
    # fixed value: the splitting pattern of the tokenizer file's byte-level step
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
SPACE = regex.compile(r"\s+")


def _byte_alphabet() -> dict[str, int]:
    """The file writes every byte as one printable character: itself where printable, else a code from 256 on."""
    out, extra = {}, 0
    for b in range(256):
        c = chr(b)
        if b > 32 and unicodedata.category(c) not in ("Cc", "Cf", "Zs"):
            out[c] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


class BytePairs:
    """Vocabulary, merge ranks and special strings of one tokenizer file."""

    def __init__(self, path: str, memo: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _byte_alphabet()
        decode = lambda s: bytes(alphabet[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {decode(s): i for s, i in spec["model"]["vocab"].items() if s not in self.special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.rank = {(decode(a), decode(b)): r for r, (a, b) in enumerate(pairs)}
        self.longest = max(map(len, self.ids))
        self.tokens = frozenset(t for t in self.ids if len(self.merge(t)) == 1)
        self._fits: dict[tuple[bytes, bytes], bool] = {}
        self._memo = memo
        self._number_tokens()

    def _number_tokens(self) -> None:
        """Tokens in the order in which the encoding makes them, each with the two it is made of; bytes come first."""
        self._number = {t: t[0] for t in self.tokens if len(t) == 1}
        self._halves: dict[int, tuple[int, int]] = {n: (n, n) for n in self._number.values()}
        made = sorted((self.rank[halves], halves) for t in self.tokens if len(t) > 1 and (halves := tuple(self.merge(t, 2))))
        self._number |= {a + b: 256 + r for r, (a, b) in made}
        self._halves |= {256 + r: (self._number[a], self._number[b]) for r, (a, b) in made}
        known = ((self._number.get(a), self._number.get(b), r) for (a, b), r in self.rank.items())
        self._pairs = {(a, b): 256 + r for a, b, r in known if a is not None and b is not None}
        # So it is in trained files: a pair is joined later than its parts are made.
        self._in_order = all(n > max(pair) for pair, n in self._pairs.items())

    def merge(self, word: bytes, until: int = 1) -> list[bytes]:
        """The plain encoding: join the pair of lowest rank until none, or ``until`` parts, are left."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > until:
            ranks = [self.rank.get(pair, 1 << 30) for pair in zip(parts, parts[1:])]
            low = min(ranks)
            if low == 1 << 30:
                break
            at = ranks.index(low)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _joins(self, a: bytes, b: bytes) -> bool:
        if len(self._fits) >= self._memo:
            self._fits.clear()
        ok = self._fits[a, b] = self._stay_apart(a, b) if self._in_order else self.merge(a + b) == [a, b]
        return ok

    def _stay_apart(self, a: bytes, b: bytes) -> bool:
        """Whether ``a + b`` is encoded as these two tokens.

        The two that meet at the border are taken apart again, the one made last first: a pair that is joined before one of
        its parts is used up would have crossed the border. Of equal ranks the left one is joined first.
        """
        pairs, halves = self._pairs, self._halves
        left, right, limit = self._number[a], self._number[b], 1 << 60
        while pairs.get((left, right), limit) >= limit:
            if left < 256 and right < 256:
                return True
            if left > right:
                limit, left = left, halves[left][1]
            else:
                limit, right = right + 1, halves[right][0]
        return False

    def prefixes(self, word: bytes) -> list[int]:
        """count[p] for p = 0 .. len(word) bytes."""
        tokens, fits, longest = self.tokens, self._fits, self.longest
        n = len(word)
        count, last = [0] * (n + 1), [b""] * (n + 1)
        for p in range(1, n + 1):
            start = p - longest if p > longest else 0
            for s in range(start, p):
                t = word[s:p]
                if t in tokens:
                    if s == 0:
                        break
                    ok = fits.get((last[s], t))
                    if ok or (ok is None and self._joins(last[s], t)):
                        break
            count[p], last[p] = count[s] + 1, t
        return count


@lru_cache(maxsize=4)
def byte_pairs(path: str) -> BytePairs:
    return BytePairs(path)


class PrefixCounter:
    """Token counts of texts from a bounded table of words; the table holds each word's counts at all its prefixes."""

    def __init__(self, path: str, words: int = 700_000):
        self.pairs = byte_pairs(path)
        self.words = words
        self._total: dict[str, int] = {}
        self._special = regex.compile("|".join(map(regex.escape, self.pairs.special)) or r"(?!)")

    def _learn(self, new: list[str]) -> None:
        """Counts of ``new`` words in sorted order: a word goes on from the longest prefix shared with the one before."""
        pairs, total, longest = self.pairs, self._total, self.pairs.longest
        tokens, fits = pairs.tokens, pairs._fits
        count, last, before = [0], [b""], b""
        for text, word in sorted((w.encode(), w) for w in new):
            p, stop = 0, min(len(text), len(before))
            while p < stop and text[p] == before[p]:
                p += 1
            del count[p + 1 :], last[p + 1 :]
            for p in range(p + 1, len(text) + 1):
                for s in range(p - longest if p > longest else 0, p):
                    t = text[s:p]
                    if t in tokens:
                        if s == 0:
                            break
                        ok = fits.get((last[s], t))
                        if ok or (ok is None and pairs._joins(last[s], t)):
                            break
                count.append(count[s] + 1)
                last.append(t)
            total[word] = count[-1]
            before = text

    def totals(self, texts: list[str]) -> list[int]:
        """Number of tokens of each text; special strings count one, as the library has them by default."""
        total = self._total
        return [n + sum(map(total.__getitem__, words)) for n, words in self._split(texts)]

    def with_budget(self, texts: list[str], budget: int) -> tuple[list[int], list[int]]:
        """``totals``, and for each text ``longest_within`` the budget."""
        totals, within, total = [], [], self._total
        for text, (n, words) in zip(texts, self._split(texts)):
            counts = list(map(total.__getitem__, words))
            totals.append(n + sum(counts))
            if totals[-1] <= budget:
                within.append(len(text))
            elif n:
                within.append(self.longest_within(text, budget, totals[-1]))
            else:
                within.append(self._cut(text, words, counts, budget))
        return totals, within

    def _cut(self, text: str, words: list[str], counts: list[int], budget: int) -> int:
        """``longest_within`` of a text of more tokens, without special strings, from its words and their counts."""
        ends = list(accumulate(counts[: max(budget, 0) + 1]))  # a word has one token at least
        fit = bisect_right(ends, budget)
        at, used = sum(map(len, words[:fit])), ends[fit - 1] if fit else 0
        near = self._ordinary(text[at : at + sum(map(len, words[fit : fit + 2]))])
        return at + max(k for k, n in enumerate(near) if used + n <= budget)

    def _split(self, texts: list[str]) -> Iterator[tuple[int, list[str]]]:
        """For each text the number of its special strings, and the words between, which are in the table until the next group."""
        total, special = self._total, self._special
        for group in _groups(texts):
            split = []
            for text in group:
                if any(s in text for s in self.pairs.special):
                    parts = special.split(text)
                    split.append((len(parts) - 1, [w for part in parts for w in PIECES.findall(part)]))
                else:
                    split.append((0, PIECES.findall(text)))
            if len(total) > self.words:
                total.clear()
            new = {w for _, words in split for w in words}.difference(total)
            if new:
                self._learn(list(new))
            yield from split

    def _count(self, word: str) -> int:
        if word not in self._total:
            self._learn([word])
        return self._total[word]

    def longest_within(self, text: str, budget: int, total: int | None = None) -> int:
        """Code points of the longest prefix of at most ``budget`` tokens, from the prefix counts where the budget runs out.

        Counts at ends of words never fall, so all words up to the last that fits are in; behind it, only prefixes that end
        in the next word count, or in a run of white space that it begins. A text with special strings is looked at whole.
        ``total`` is the text's own count, if it is known.
        """
        if total is not None and total <= budget:
            return len(text)
        if any(s in text for s in self.pairs.special):
            return max(k for k, n in enumerate(self.prefixes(text)) if n <= budget)
        if total is None and self.totals([text])[0] <= budget:
            return len(text)
        words = PIECES.findall(text)
        return self._cut(text, words, list(map(self._count, words[: max(budget, 0) + 1])), budget)

    def prefixes(self, text: str) -> list[int]:
        """count[k]: the number of tokens of ``text[:k]``, for k = 0 .. len(text)."""
        out, base, at = [0], 0, 0
        for m in self._special.finditer(text):
            # Until it is complete, a special string is ordinary text.
            part = self._ordinary(text[at : m.end() - 1])
            whole = self._ordinary(text[at : m.start()])[-1]
            out += [base + c for c in part[1:]] + [base + whole + 1]
            base, at = base + whole + 1, m.end()
        return out + [base + c for c in self._ordinary(text[at:])[1:]]

    def _word(self, word: str) -> list[int]:
        """Counts at the code points of one word."""
        counts = self.pairs.prefixes(word.encode())
        if len(counts) == len(word) + 1:
            return counts
        ends, at = [0], 0
        for c in word:
            at += len(c.encode())
            ends.append(at)
        return [counts[e] for e in ends]

    def _ordinary(self, text: str) -> list[int]:
        out, base = [0] * (len(text) + 1), 0
        settled = 0  # positions up to here are known: a run of white space that ends a prefix is one word
        for m in PIECES.finditer(text):
            s, e = m.span()
            word = m.group()
            counts = self._word(word)
            if s >= settled and SPACE.fullmatch(word):
                settled = SPACE.match(text, s).end()
                out[s + 1 : settled + 1] = [base + c for c in self._word(text[s:settled])[1:]]
            fill = max(s, settled) + 1
            if word in ("'re", "'ve", "'ll"):  # cut after two letters, this is an apostrophe and a letter
                counts = [0, 1, 2, counts[3]]
            out[fill : e + 1] = [base + c for c in counts[fill - s :]]
            base += counts[-1]
        return out


def _groups(texts: list[str], size: int = 1 << 20):
    """Neighbouring texts of about ``size`` characters together."""
    group, chars = [], 0
    for t in texts:
        group.append(t)
        chars += len(t)
        if chars >= size:
            yield group
            group, chars = [], 0
    if group:
        yield group


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounter:
    """One table for each worker process."""
    return PrefixCounter(path)
