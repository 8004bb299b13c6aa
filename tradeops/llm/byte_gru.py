"""A bidirectional gated recurrent network over bytes, in numpy: training by backpropagation through time, and use.

Gate ``z`` keeps the state, gate ``r`` resets what the candidate sees of it: ``h' = z h + (1 - z) tanh(x + r (U h))``.
A byte is looked up in a table of the three gates' inputs (embedding and input weights in one). The row of ``PAD`` closes both
gates, so the state is zero behind it and padding or neighbours never reach a text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

PAD = 255  # never occurs in UTF-8
SPAN, CONTEXT = 256, 12  # bytes labelled by one window, and bytes read before and behind them
WINDOWS = 1024  # windows that go through the network at once
BLOCK, FEW = 8, 4  # positions, and steps of training, that are worked on while they lie in the cache


@dataclass
class Model:
    labels: list[str]
    table: list[np.ndarray]  # for each direction, (256, 3H)
    inner: list[np.ndarray]  # for each direction, (H, 3H)
    out: np.ndarray  # (2H, labels)
    bias: np.ndarray

    def params(self) -> list[np.ndarray]:
        return [*self.table, *self.inner, self.out, self.bias]


def _new(labels: list[str], hidden: int, rng: np.random.Generator) -> Model:
    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.normal(size=shape) * scale).astype(np.float32)

    model = Model(
        labels,
        [normal(256, 3 * hidden, scale=0.3) for _ in "fb"],
        [normal(hidden, 3 * hidden, scale=hidden**-0.5) for _ in "fb"],
        normal(2 * hidden, len(labels), scale=0.3),
        np.zeros(len(labels), np.float32),
    )
    _close(model)
    return model


def _close(model: Model) -> None:
    hidden = len(model.inner[0])
    for table in model.table:
        table[PAD] = 0
        table[PAD, : 2 * hidden] = -60


class Space:
    """Arrays by name, taken again by the next call: memory that is given back and asked for anew at every step costs time."""

    def __init__(self) -> None:
        self._kept: dict[tuple, np.ndarray] = {}

    def take(self, name: str, shape: tuple[int, ...], dtype) -> np.ndarray:
        """An array whose content is not defined; it lasts until the name is taken again."""
        size, key = math.prod(shape), (name, np.dtype(dtype))
        if key not in self._kept or self._kept[key].size < size:
            self._kept[key] = np.empty(size, dtype)
        return self._kept[key][:size].reshape(shape)


def _states(model: Model, steps: np.ndarray, space: Space, length: int, trace: list | None = None) -> np.ndarray:
    """(length + 1, 2, H, N) states of both directions, the first zero: the second reads ``steps`` (T, N) from the end.

    It lies in ``space``. To ``trace`` go (length, 2, 3H, N) gates and candidates, and (length, 2, H, N) what the state gives to
    candidates before ``r`` resets it. Both directions take a step at once: a call has a cost of its own, whatever the size of what it works on.
    """
    hidden, lanes, dtype = len(model.inner[0]), steps.shape[1], model.out.dtype
    half = np.repeat([0.5, 0.5, 1], hidden).astype(dtype)  # a gate is tanh of half its input, brought to 0 .. 1
    inputs = np.concatenate([table * half for table in model.table])  # the second direction's bytes come behind the first's
    recurrent = np.stack([(inner * half).T for inner in model.inner])
    out = space.take("states", (length + 1, 2, hidden, lanes), dtype)
    out[0] = 0
    kept = 1 if trace is None else length
    rows, given = (space.take(x, (kept, 2, n * hidden, lanes), dtype) for x, n in (("rows", 3), ("given", 1)))
    opening = space.take("opening", (2, 2 * hidden, lanes), dtype)
    to_gates, to_candidates = recurrent[:, : 2 * hidden], recurrent[:, 2 * hidden :]
    looked, reset = space.take("looked", (2, lanes, 3 * hidden), dtype), space.take("reset", (2, hidden, lanes), dtype)
    read = space.take("read", (length, 2, lanes), np.intp)
    read[:, 0] = steps[:length]
    np.add(steps[::-1][:length], 256, out=read[:, 1], dtype=np.intp)
    turned = looked.transpose(0, 2, 1)
    for t in range(length):
        h, after, x, u = out[t], out[t + 1], rows[t % kept], given[t % kept]
        np.take(inputs, read[t], axis=0, out=looked, mode="clip")  # a byte is never beyond the table
        np.copyto(x, turned)
        np.matmul(to_gates, h, out=opening)
        np.matmul(to_candidates, h, out=u)
        gates, c = x[:, : 2 * hidden], x[:, 2 * hidden :]
        gates += opening
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        np.multiply(gates[:, hidden:], u, out=reset)
        c += reset
        np.tanh(c, out=c)
        np.subtract(h, c, out=after)
        after *= gates[:, :hidden]
        after += c
    if trace is not None:
        trace += [rows, given]
    return out


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def _probabilities(model: Model, steps: np.ndarray, space: Space) -> np.ndarray:
    """(T - 2 CONTEXT, labels, N): what the network says at every position but the context's; it lies in ``space``."""
    hidden, (length, lanes) = len(model.inner[0]), steps.shape
    length -= CONTEXT  # neither direction has to read the context behind its last position
    states = _states(model, steps, space, length)[CONTEXT + 1 :]
    length -= CONTEXT
    scores = space.take("scores", (length, len(model.labels), lanes), model.out.dtype)
    behind = space.take("behind", (BLOCK, *scores.shape[1:]), model.out.dtype)
    ahead_of, behind_of = states[:, 0], states[::-1, 1]
    for at in range(0, length, BLOCK):
        part = slice(at, at + BLOCK)
        block = scores[part]
        np.matmul(model.out[:hidden].T, ahead_of[part], out=block)
        block += np.matmul(model.out[hidden:].T, behind_of[part], out=behind[: len(block)])
        block += model.bias[:, None]
        _softmax(block)
    return scores


def gradients(
    model: Model, steps: np.ndarray, target: np.ndarray, weight: np.ndarray | None = None, space: Space | None = None
) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions that hold a byte, and its gradients, by backpropagation through time.

    ``weight`` is how much a position of each lane counts in the mean.
    """
    hidden, space, dtype = len(model.inner[0]), space or Space(), model.out.dtype
    length, width = steps.shape
    trace: list = []
    states = _states(model, steps, space, length, trace)
    both = space.take("both", (length, 2 * hidden, width), dtype)
    both[:, :hidden], both[:, hidden:] = states[1:, 0], states[:0:-1, 1]
    p = np.matmul(model.out.T, both, out=space.take("p", (length, len(model.bias), width), dtype))
    p += model.bias[:, None]
    _softmax(p)
    real = (steps != PAD).astype(np.float32)
    if weight is not None:
        real *= weight
    real /= real.sum() or 1
    right = (np.arange(len(model.bias))[:, None] == target).astype(dtype)
    loss = float(-(np.log((p * right).sum(axis=1) + 1e-12) * real).sum())
    p -= right
    p *= real[:, None]
    d_out = np.matmul(both, p.transpose(0, 2, 1)).sum(axis=0)
    d_bias = p.sum(axis=(0, 2))
    d_states = space.take("d_states", (length, 2, hidden, width), dtype)  # as each direction reads
    np.matmul(model.out[:hidden], p, out=d_states[:, 0])
    np.matmul(model.out[hidden:], p[::-1], out=d_states[:, 1])
    rows, u = trace
    z, r, c = rows[:, :, :hidden], rows[:, :, hidden : 2 * hidden], rows[:, :, 2 * hidden :]
    # What does not depend on the steps behind is worked out for a few steps at once, which stay in the cache until they are used.
    open_, to_c, to_z, to_r = (space.take(x, (FEW, 2, hidden, width), dtype) for x in ("open", "to_c", "to_z", "to_r"))
    carry, left = (space.take(x, (2, hidden, width), dtype) for x in ("carry", "left"))
    # A row for each gate, the candidate's with and without its reset; a little longer, or all rows share cache lines.
    g = space.take("g", (2, 4 * hidden, steps.size + 16), dtype)[:, :, : steps.size]
    g_t, sorted_ = g.reshape(2, 4 * hidden, length, width), space.take("sorted", (2 * hidden, steps.size), dtype)
    inner = np.stack(model.inner)
    carry[:] = 0
    for end in range(length, 0, -FEW):
        begin = max(end - FEW, 0)
        part, n = slice(begin, end), end - begin
        np.subtract(1, z[part], out=open_[:n])
        np.multiply(c[part], c[part], out=to_c[:n])
        np.subtract(1, to_c[:n], out=to_c[:n])
        to_c[:n] *= open_[:n]
        np.subtract(states[part], c[part], out=to_z[:n])
        to_z[:n] *= z[part]
        to_z[:n] *= open_[:n]
        np.subtract(1, r[part], out=to_r[:n])
        to_r[:n] *= r[part]
        to_r[:n] *= u[part]
        to_r[:n] *= to_c[:n]
        for t in range(end - 1, begin - 1, -1):
            x, i = g_t[:, :, t], t - begin
            to_inner = x[:, 3 * hidden :]
            carry += d_states[t]
            np.multiply(carry, to_z[i], out=x[:, :hidden])
            np.multiply(carry, to_r[i], out=x[:, hidden : 2 * hidden])
            np.multiply(carry, to_c[i], out=to_inner)
            np.multiply(to_inner, r[t], out=x[:, 2 * hidden : 3 * hidden])
            np.multiply(carry, z[t], out=left)
            np.matmul(inner, x[:, : 3 * hidden], out=carry)
            carry += left
    d_inner = sum(np.matmul(states[t], g_t[:, : 3 * hidden, t].transpose(0, 2, 1)) for t in range(length))
    d_table, counts = [], np.bincount(steps.ravel(), minlength=256)
    found = np.flatnonzero(counts)
    begins = (np.cumsum(counts) - counts)[found]
    for d in (0, 1):
        order = np.argsort(steps[:: 1 - 2 * d].ravel(), kind="stable")
        table = np.zeros((256, 3 * hidden), dtype)
        for part, rows in ((slice(2 * hidden), g[d, : 2 * hidden]), (slice(2 * hidden, None), g[d, 3 * hidden :])):
            near = np.take(rows, order, axis=1, out=sorted_[: len(rows)], mode="clip")
            table[found, part] = np.add.reduceat(near, begins, axis=1).T
        table[PAD] = 0
        d_table.append(table)
    return loss, [*d_table, *d_inner, d_out, d_bias]


class _Adam:
    """Steps of ``model``, which is changed in place, down gradients of length 1 at most."""

    def __init__(self, model: Model):
        self.model, self.steps = model, 0
        self.row = np.concatenate([p.ravel() for p in model.params()])  # all parameters, of which the model's are views
        ends = np.cumsum([p.size for p in model.params()])[:-1]
        parts = [x.reshape(p.shape) for x, p in zip(np.split(self.row, ends), model.params())]
        model.table, model.inner, (model.out, model.bias) = parts[:2], parts[2:4], parts[4:]
        self.first, self.second = np.zeros_like(self.row), np.zeros_like(self.row)

    def step(self, grads: list[np.ndarray], rate: float) -> None:
        self.steps += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        g, m, v = np.concatenate([x.ravel() for x in grads]), self.first, self.second
        g = g * min(1, 1 / (norm + 1e-9))
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        self.row -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-8)
        _close(self.model)


def train(
    samples: list[tuple[bytes, str]], hidden: int = 8, steps: int = 400, lanes: int = 128, length: int = 64, seed: int = 7
) -> Model:
    """Adam over random windows of ``samples`` (text, label), each label drawn equally often."""
    rng = np.random.default_rng(seed)
    labels = sorted({label for _, label in samples})
    by_label = [[np.frombuffer(text, np.uint8) for text, label in samples if label == name and text] for name in labels]
    model = _new(labels, hidden, rng)
    adam, space = _Adam(model), Space()
    drawable = [i for i, texts in enumerate(by_label) if texts]
    for step in range(1, steps + 1 if len(drawable) > 1 else 0):
        target = rng.choice(drawable, lanes)
        batch = np.full((length, lanes), PAD, np.uint8)
        for lane, label in enumerate(target):
            text = by_label[label][rng.integers(len(by_label[label]))]
            at = rng.integers(max(len(text) - length, 0) + 1)
            part = text[at : at + length]
            batch[: len(part), lane] = part
        _, grads = gradients(model, batch, target, space=space)
        adam.step(grads, 0.02 * min(1, 3 * (1 - step / (steps + 1))))
    return model


def taught(
    model: Model, batches: Iterator[list[tuple[bytes, int]]], weight: np.ndarray, rate: float = 0.005, lanes: int = 512, length: int = 32
) -> tuple[np.ndarray, int]:
    """(sum, bytes): goes on training with every byte of (text, number of its label), once.

    ``sum`` has all parameters in one row, after each step, times the bytes of that step: over ``bytes``, of any number of
    calls, it is the mean over their steps. A byte counts as ``weight`` says of its label. ``model`` stays as it is.
    """
    model = Model(model.labels, [x.copy() for x in model.table], [x.copy() for x in model.inner], model.out.copy(), model.bias.copy())
    adam, rng, space = _Adam(model), np.random.default_rng(5), Space()
    total, size = np.zeros(len(adam.row)), 0
    for batch in batches:
        batch = [(text, label) for text, label in batch if text]
        counts = [-(-len(text) // length) for text, _ in batch]
        windows = np.full((sum(counts), length), PAD, np.uint8)
        for (text, _), count, end in zip(batch, counts, np.cumsum(counts).tolist()):
            windows[end - count : end].reshape(-1)[: len(text)] = np.frombuffer(text, np.uint8)
        target = np.repeat(np.array([label for _, label in batch], np.int64), counts)
        order = rng.permutation(len(windows))
        for at in range(0, len(order), lanes):
            part = order[at : at + lanes]
            _, grads = gradients(model, np.ascontiguousarray(windows[part].T), target[part], weight[target[part]], space)
            adam.step(grads, rate)
            n = int((windows[part] != PAD).sum())
            total += n * adam.row
            size += n
    return total, size


def with_params(model: Model, row: np.ndarray) -> Model:
    """``model`` with the parameters of ``row``, one after another."""
    ends = np.cumsum([p.size for p in model.params()])[:-1]
    parts = [x.reshape(p.shape).astype(np.float32) for x, p in zip(np.split(row, ends), model.params())]
    out = Model(model.labels, parts[:2], parts[2:4], *parts[4:])
    _close(out)
    return out


def _windows(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bounded batches of (windows, number of the text each belongs to)."""
    kept, owners, size = [], [], 0
    for number, text in enumerate(texts):
        count = -(-len(text) // SPAN)
        padded = np.full(count * SPAN + 2 * CONTEXT, PAD, np.uint8)
        padded[CONTEXT : CONTEXT + len(text)] = np.frombuffer(text, np.uint8)
        start = 0
        while start < count:
            stop = min(start + WINDOWS - size, count)
            part = padded[start * SPAN : stop * SPAN + 2 * CONTEXT]
            kept.append(np.lib.stride_tricks.sliding_window_view(part, SPAN + 2 * CONTEXT)[::SPAN])
            owners.append(np.full(stop - start, number))
            size += stop - start
            start = stop
            if size == WINDOWS:
                yield np.concatenate(kept), np.concatenate(owners)
                kept, owners, size = [], [], 0
    if size:
        yield np.concatenate(kept), np.concatenate(owners)


def pooled(model: Model, texts: list[bytes], space: Space | None = None) -> np.ndarray:
    """(texts, labels): the mean of the probabilities at all positions of each whole text; 0 for empty ones."""
    total, space = np.zeros((len(texts), len(model.labels))), space or Space()
    for windows, owners in _windows(texts):
        p = _probabilities(model, np.ascontiguousarray(windows.T), space)
        p *= (windows.T[CONTEXT : CONTEXT + SPAN] != PAD).astype(p.dtype, order="C")[:, None]
        np.add.at(total, owners, p.sum(axis=0).T)
    sizes = np.array([max(len(t), 1) for t in texts])
    return total / sizes[:, None]


def positions(model: Model, text: bytes) -> list[str]:
    """The label of every byte of ``text``."""
    out: list[str] = []
    space = Space()
    for windows, _ in _windows([text]):
        best = _probabilities(model, np.ascontiguousarray(windows.T), space).argmax(axis=1)
        out += [model.labels[i] for i in best.T.ravel()]
    return out[: len(text)]
