"""A support vector machine on a gapped subsequence kernel with Nystroem landmarks, in numpy.

The kernel of two words counts their common subsequences of three characters that span at most ``REACH`` characters, each
weighted by ``DECAY`` to the power of the span in both words, normalised to 1 for a word with itself; a sentence is the
sum of its distinct words. So ``mor-on`` is near ``moron``, as inserted characters only lengthen spans. Sentences are mapped by
their kernels with landmark words, ``K(landmarks)^(-1/2)`` makes that an approximation of the kernel's own space, and a
squared-hinge machine is trained there. Its decision is linear in subsequences, so it becomes one weight for each
subsequence, and a text costs a look-up a word.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np

CODES = 64  # characters are told apart as a .. z, 0 .. 9, and 27 classes for all others
REACH, DECAY = 5, 0.7
SENTENCE = 16  # words in a piece of a long sentence
SHARE, RIDGE = 0.15, 1e-4  # weight of all toxic sentences together in training, and the machine's regularisation
LONGEST = 32  # characters in a piece of a long word; pieces overlap by the reach
GAPS = [(i, j) for i in range(1, REACH - 1) for j in range(1, REACH - i)]
MARKS = ".,!?;:\"'()"
SPACED = re.compile(r"(?<!\S)\S(?:[ \t]\S){2,}(?!\S)")
LETTERS = re.compile(r"\s\S[ \t]\S[ \t]\S(?!\S)")  # finds texts for SPACED quickly
ENDS = (".", "!", "?")


def tokens(text: str) -> list[str]:
    """Lower-cased words; letters spaced out one by one make one word."""
    text = text.lower()
    if LETTERS.search(" " + text[:8]) or LETTERS.search(text):
        text = SPACED.sub(lambda m: m.group().replace(" ", "").replace("\t", ""), text)
    return text.split()


def sentence_places(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word its piece of a sentence and its place there, given which words end a sentence."""
    begins = np.concatenate([[0], np.flatnonzero(ends[:-1]) + 1])
    place = (np.arange(len(ends)) - np.repeat(begins, np.diff(begins, append=len(ends)))) % SENTENCE
    return np.cumsum(place == 0) - 1, place


# Codes of ASCII characters; others have 37 + point mod 27.
_ASCII = np.array([c - 96 if 97 <= c <= 122 else c - 48 + 27 if 48 <= c <= 57 else 37 + c % 27 for c in range(128)])
_WEIGHTS = DECAY ** (np.arange(4) + 3.0)


def subsequences(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, subsequence, weight) of all words together, each word's weights of length 1; sorted by owner."""
    pieces, owners = list(words), np.arange(len(words))
    if any(len(w) > LONGEST for w in words):
        cuts = [range(0, max(len(w) - REACH + 1, 1), LONGEST - REACH + 1) for w in words]
        pieces = [w[at : at + LONGEST] for w, starts in zip(words, cuts) for at in starts]
        owners = np.repeat(owners, [len(starts) for starts in cuts])
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    n = int(lengths.max(initial=0))
    chars = np.zeros((len(pieces), n + REACH), np.int64)
    points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    chars[:, :n][np.arange(n) < lengths[:, None]] = np.where(points < 128, _ASCII[points % 128], 37 + points % 27)
    keys, owner = [], owners[:, None] << 18
    for i, j in GAPS:
        a, b, c = chars[:, :n], chars[:, i : n + i], chars[:, i + j : n + i + j]
        # The two lowest bits hold the span, which gives the weight.
        keys.append((owner | a << 12 | b << 6 | c)[c > 0] << 2 | i + j - 2)
    key = np.sort(np.concatenate(keys)) if keys else np.empty(0, np.int64)
    if not len(key):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    begins = np.flatnonzero(np.diff(key >> 2, prepend=-1))
    weight = np.add.reduceat(_WEIGHTS[key & 3], begins)
    key = key[begins] >> 2
    owner = key >> 18
    norm = np.sqrt(np.bincount(owner, weight * weight, minlength=len(words)))
    return owner, key & (CODES**3 - 1), weight / norm[owner]


def kernel(words: Sequence[str], landmarks: Sequence[str]) -> np.ndarray:
    """(words, landmarks): the normalised word kernel."""
    owner, code, weight = subsequences(landmarks)
    known, column = np.unique(code, return_inverse=True)
    table = np.zeros((len(known) + 1, len(landmarks)), np.float32)
    table[column, owner] = weight
    out = np.zeros((len(words), len(landmarks)), np.float32)
    owner, code, weight = subsequences(words)
    place = np.searchsorted(known, code)
    hit = np.append(known, -1)[place] == code
    np.add.at(out, owner[hit], table[place[hit]] * weight[hit, None].astype(np.float32))
    return out


@dataclass
class Machine:
    """Weights of subsequences, the offset, and the calibration of a document's three highest margins."""

    weights: np.ndarray
    offset: float
    scale: np.ndarray
    bias: float
    words: int = 600_000  # words remembered
    _known: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_known": {}}

    def _learn(self, words: list[str]) -> None:
        """A word's value without the marks around it; an end of sentence is marked by adding 1000."""
        known, bare = self._known, [w.strip(MARKS) for w in words]
        new = list(set(bare).difference(known))
        for at in range(0, len(new), 5000):
            part = new[at : at + 5000]
            owner, code, weight = subsequences(part)
            known.update(zip(part, np.bincount(owner, weight * self.weights[code], minlength=len(part)).tolist()))
        known.update([(w, known[b] + 1000.0 * w.endswith(ENDS)) for w, b in zip(words, bare) if w != b])

    def margins(self, words: list[str]) -> np.ndarray:
        """The decision value of each sentence."""
        if not words:
            return np.empty(0)
        if len(self._known) > self.words:
            self._known.clear()
        new = [w for w in words if w not in self._known]
        if new:
            self._learn(list(set(new)))
        values = np.fromiter(map(self._known.__getitem__, words), float, len(words))
        ends = values > 500
        values[ends] -= 1000
        sentence, place = sentence_places(ends)
        rows = np.zeros((sentence[-1] + 1, SENTENCE))
        rows[sentence, place] = values
        rows.sort(axis=1)
        rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = 0  # a word counts once
        return rows.sum(axis=1) + self.offset

    def score(self, text: str) -> float:
        margins = self.margins(tokens(text))
        top = top_margins(margins if len(margins) else np.array([min(self.offset, -1.0)]))
        return float(1 / (1 + np.exp(-np.clip(top @ self.scale + self.bias, -30, 30))))


def top_margins(margins: np.ndarray) -> np.ndarray:
    """The three highest, bounded; of fewer sentences the lowest counts again."""
    top = np.sort(margins)[-3:][::-1]
    return np.clip(np.pad(top, (0, 3 - len(top)), mode="edge"), -2, 5)


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Newton's method for the primal machine; ``x`` has a column of ones, ``y`` is +1 or -1."""
    w = np.zeros(x.shape[1])
    for _ in range(12):
        active = y * (x @ w) < 1
        xa, c = x[active], weight[active]
        weighted = (xa * c[:, None].astype(xa.dtype)).T
        new = np.linalg.solve((weighted @ xa).astype(float) + ridge * np.eye(len(w)), (weighted @ y[active]).astype(float))
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    return w


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        g = (x1 * (weight * (p - y))[:, None]).sum(axis=0) + 1e-2 * w
        h = (x1 * (weight * p * (1 - p))[:, None]).T @ x1 + 1e-2 * np.eye(len(w))
        w = w - np.linalg.solve(h, g)
    return w[:-1], float(w[-1])


def choose_landmarks(docs: list[list[str]], toxic: np.ndarray, count: int, rng: np.random.Generator) -> list[str]:
    """Half the words that speak most for the toxic class, half drawn from all."""
    seen: list[dict[str, int]] = [{}, {}]
    for words, label in zip(docs, toxic):
        for w in set(words):
            seen[label][w] = seen[label].get(w, 0) + 1
    n = [max(int((toxic == k).sum()), 1) for k in (0, 1)]
    odds = {w: c / n[1] * np.log((c + 0.5) / n[1] / ((seen[0].get(w, 0) + 0.5) / n[0])) for w, c in seen[1].items() if c > 1}
    best = sorted(odds, key=lambda w: (-odds[w], w))[: count // 2]
    rest = sorted((set(seen[0]) | set(seen[1])).difference(best))
    return best + [rest[i] for i in sorted(rng.choice(len(rest), min(count - len(best), len(rest)), replace=False))]


def train(texts: list[str], toxic: Sequence[int], prior: float, landmarks: int = 160, rounds: int = 4, seed: int = 3) -> Machine | None:
    """From documents' labels: sentences take them over, then only the most toxic sentences of toxic documents keep them."""
    y = np.asarray(toxic, dtype=int)
    docs = [tokens(t) for t in texts]
    bare = [[w.strip(MARKS) for w in d] for d in docs]
    if not len(y) or y.min() == y.max() or not any(docs):
        return None
    rng = np.random.default_rng(seed)
    marks = choose_landmarks(bare, y, landmarks, rng)
    vocabulary = sorted({w for d in bare for w in d})
    number = {w: i for i, w in enumerate(vocabulary)}
    value, vector = np.linalg.eigh(kernel(marks, marks).astype(float))
    keep = value > 1e-3
    root = vector[:, keep] / np.sqrt(value[keep])
    root32 = root.astype(np.float32)
    mapped = np.concatenate([kernel(vocabulary[at : at + 5000], marks) @ root32 for at in range(0, len(vocabulary), 5000)])
    rows, owner = [], []
    for d, words in enumerate(docs):
        ids = np.array([number[w] for w in bare[d]], np.int64)
        if len(ids):
            ends = np.array([w.endswith(ENDS) for w in words])
            sentence, _ = sentence_places(ends)
            distinct = [np.unique(part) for part in np.split(ids, np.flatnonzero(np.diff(sentence)) + 1)]
            rows.append(np.stack([mapped[part].sum(axis=0) for part in distinct]))
            owner += [d] * len(distinct)
    x = np.hstack([np.concatenate(rows), np.ones((len(owner), 1), np.float32)])
    owner = np.array(owner)
    bad = y[owner] == 1
    chosen = bad.copy()
    for _ in range(rounds):
        use = chosen | ~bad
        label = np.where(chosen, 1.0, -1.0)[use]
        weight = np.where(label > 0, SHARE / max(chosen.sum(), 1), (1 - SHARE) / max((~bad).sum(), 1))
        w = _squared_hinge(x[use], label, weight, RIDGE)
        f = x @ w
        order = np.lexsort((-f, owner))
        rank = np.arange(len(owner)) - np.searchsorted(owner[order], owner[order])
        chosen = np.zeros(len(owner), bool)
        chosen[order] = (rank < 3) & ((rank == 0) | (f[order] > 0))
        chosen &= bad
    top = np.stack([top_margins(f[owner == d] if (owner == d).any() else w[-1:]) for d in range(len(docs))])
    scale, bias = _logistic(top, y, np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean())))
    landmark_weights = root @ w[:-1]
    at, code, weight = subsequences(marks)
    primal = np.bincount(code, weight * landmark_weights[at], minlength=CODES**3)
    return Machine(primal, float(w[-1]), scale, bias)
