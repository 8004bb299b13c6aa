from __future__ import annotations

import zlib

import numpy as np
import pytest

from tests.conftest import SF_DIR
from tradeops.llm import byte_gru, language_id, op3

SAMPLES = [(b"abab abba baab " * 5, "ab"), (b"cdcd ccdd dcdc " * 5, "cd")]


@pytest.fixture(scope="module")
def model():
    return byte_gru.train(SAMPLES, steps=60, lanes=32, length=24)


def test_gradients():
    rng = np.random.default_rng(0)
    m = byte_gru._new(["a", "b", "c"], 4, rng)
    for part in ("table", "inner"):
        setattr(m, part, [x.astype(np.float64) for x in getattr(m, part)])
    m.out, m.bias = m.out.astype(np.float64), m.bias.astype(np.float64)
    steps = rng.integers(97, 100, (7, 5)).astype(np.uint8)
    steps[4:, 1] = byte_gru.PAD
    target = np.array([0, 1, 2, 1, 0])
    _, grads = byte_gru.gradients(m, steps, target)
    for p, g in zip(m.params(), grads):
        for _ in range(6):
            at = tuple(rng.integers(n) for n in p.shape)
            if p.shape[0] == 256:
                at = (97 + at[0] % 3, at[1])
            old, e = p[at], 1e-2
            p[at] = old + e
            up, _ = byte_gru.gradients(m, steps, target)
            p[at] = old - e
            down, _ = byte_gru.gradients(m, steps, target)
            p[at] = old
            assert abs((up - down) / (2 * e) - g[at]) < 2e-3


def test_whole_texts_and_neighbours(model):
    texts = [b"abba", b"", b"cd" * 5000, b"ab" * 400 + b"cd" * 400, b"x"]
    together = byte_gru.pooled(model, texts)
    for i, t in enumerate(texts):
        assert np.allclose(byte_gru.pooled(model, [t])[0], together[i], atol=1e-5)
    labels = byte_gru.positions(model, texts[3])
    assert len(labels) == 1600 and labels[100] == "ab" and labels[1500] == "cd"
    share = np.mean([x == "ab" for x in labels])
    assert 0.4 < share < 0.6 and together[1].sum() == 0


def test_windows_bound_memory(model, monkeypatch):
    text = b"abba cdcd " * 3000
    whole = byte_gru.pooled(model, [text])
    monkeypatch.setattr(byte_gru, "WINDOWS", 3)
    assert np.allclose(byte_gru.pooled(model, [text]), whole, atol=1e-4)


def test_odd_rows(spark, model):
    rows = [(1, None, 1), (2, "", 2), (2, "12 !?", 3), (None, "abba", 4), (5, "cdcd", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    got = {r["label"]: (r["lang_pred"], r["score"]) for r in language_id.with_language(df, model).collect()}
    assert [got[i] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4][0] == "ab" and got[5][0] == "cd" and all(0 <= s <= 1 for _, s in got.values())
    assert language_id.with_language(df, None).where("lang_pred <> 'und'").count() == 0
    none = spark.createDataFrame([], "doc_id long, text string, label string")
    assert language_id.learn(none) is None and language_id.with_language(none, model).collect() == []


def test_query_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op3.run(spark, SF_DIR).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    hidden = [r for r in rows if r["held_out"] and truth[r["doc_id"]] is not None]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in hidden) >= 0.95 * len(hidden)


def test_any_number_of_labels(spark, monkeypatch):
    monkeypatch.setattr(language_id, "ROWS", 1000)
    rows = [(i * 10 + k, f"text {i} {k}", f"l{i:03}") for i in range(200) for k in range(10)]
    rows += [(7, "text 0 7", "l000")] * 3_000  # one id, many times
    df = spark.createDataFrame(rows, "doc_id long, text string, label string")
    found = language_id.sample(df)
    assert len(found) == 1000 and len({label for _, label in found}) == 200
    assert all(text.decode().split()[1] == str(int(label[1:])) for text, label in found)
    assert language_id.learn(df.where("label < 'l070'")).labels == [f"l{i:03}" for i in range(70)]


def test_clashing_columns(spark, model):
    df = spark.createDataFrame([("abba", 1, 2, 3, "x", 0.5)], "text string, _language int, named int, `row.x` int, lang_pred string, score double")
    out = language_id.with_language(df, model)
    assert out.columns == ["text", "_language", "named", "row.x", "lang_pred", "score"]
    row = out.collect()[0]
    assert tuple(row)[:4] == ("abba", 1, 2, 3) and row["lang_pred"] == "ab"


def test_all_rows_teach(spark, monkeypatch):
    """What only rows outside the sample show is learned, from files that hold one label each."""
    monkeypatch.setattr(language_id, "SAMPLE", 5)
    rng = np.random.default_rng(4)
    draw = lambda letters: "".join(rng.choice(list(letters), 300))
    rows = [(i, draw("abxy"), "ab") for i in range(3000)] + [(i, draw("cdxy"), "cd") for i in range(3000, 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label string").repartitionByRange(6, "doc_id")
    start = byte_gru.train(language_id.sample(df), steps=3)
    model = language_id.from_all_rows(start, df)
    texts = [(draw(x).encode(), i) for i, x in enumerate(("abxy", "cdxy")) for _ in range(30)]
    loss = lambda m: -np.log([byte_gru.pooled(m, [t])[0][i] for t, i in texts]).mean()
    assert loss(model) < 0.95 * loss(start)


def test_every_byte_teaches_once(model):
    texts = [(b"abba" * 30 + b"a", 0), (b"", 1), (b"cd", 1)]
    total, size = byte_gru.taught(model, iter([texts, texts[:1]]), np.ones(2, np.float32), rate=0)
    assert size == 2 * 121 + 2
    for a, b in zip(byte_gru.with_params(model, total / size).params(), model.params()):
        assert np.allclose(a, b, atol=1e-6)


def test_steps_take_no_new_memory(model):
    """Steps, and windows that are read, work in the same arrays again, and give what fresh arrays give."""
    rng, space = np.random.default_rng(2), byte_gru.Space()
    batches = [(rng.choice(np.frombuffer(b"abcd ", np.uint8), (32, n)), rng.integers(0, 2, n)) for n in (512, 40, 512)]
    kept = None
    for steps, target in batches:
        steps[20:, :9] = byte_gru.PAD
        got = byte_gru.gradients(model, steps, target, None, space)[1]
        for a, b in zip(got, byte_gru.gradients(model, steps, target)[1]):
            assert np.array_equal(a, b)
        kept = kept or {k: id(x) for k, x in space._kept.items()}
        assert kept == {k: id(x) for k, x in space._kept.items()}
    texts = [b"abba" * 500, b"cd", b"", b"ba" * 30]
    assert np.array_equal(byte_gru.pooled(model, texts, space), byte_gru.pooled(model, texts))
    assert np.array_equal(byte_gru.pooled(model, texts[1:], space), byte_gru.pooled(model, texts[1:]))


def test_both_directions_take_a_step_at_once(model, monkeypatch):
    """A step of both directions is one call of each kind, none reads context that nothing needs, and all is as worked out plainly."""
    text = b"abba cdcd " * 60
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    states = []
    for table, inner, read in zip(model.table, model.inner, (text, text[::-1])):
        h, hidden, found = np.zeros(len(inner)), len(inner), []
        for byte in read:
            x, u = table[byte], h @ inner
            z, r = sigmoid(x[:hidden] + u[:hidden]), sigmoid(x[hidden : 2 * hidden] + u[hidden : 2 * hidden])
            h = z * h + (1 - z) * np.tanh(x[2 * hidden :] + r * u[2 * hidden :])
            found.append(h)
        states.append(found)
    scores = np.hstack([states[0], states[1][::-1]]) @ model.out + model.bias
    plain = np.exp(scores) / np.exp(scores).sum(axis=1, keepdims=True)

    calls, tanh = [], np.tanh
    monkeypatch.setattr(np, "tanh", lambda *a, **k: calls.append(1) or tanh(*a, **k))
    got = byte_gru._probabilities(model, np.full((len(text) + 2 * byte_gru.CONTEXT, 1), byte_gru.PAD, np.uint8), byte_gru.Space())
    assert len(got) == len(text) and len(calls) == 2 * (len(text) + byte_gru.CONTEXT)
    calls.clear()
    padded = np.frombuffer(bytes([byte_gru.PAD] * byte_gru.CONTEXT) + text + bytes([byte_gru.PAD] * byte_gru.CONTEXT), np.uint8)
    got = byte_gru._probabilities(model, padded[:, None], byte_gru.Space())
    assert np.allclose(got[:, :, 0], plain, atol=1e-4)
    calls.clear()
    byte_gru.gradients(model, np.tile(padded[12:44, None], (1, 5)), np.array([0, 1, 0, 1, 0]))
    assert len(calls) == 2 * 32


def test_no_more_windows_at_once(model, monkeypatch):
    """What goes through the network at once is bounded, wherever long and short texts end."""
    monkeypatch.setattr(byte_gru, "WINDOWS", 4)
    texts = [b"ab" * n for n in (100, 1200, 0, 3, 700, 2000)]
    got = list(byte_gru._windows(texts))
    assert [len(o) for _, o in got[:-1]] == [4] * (len(got) - 1) and len(got[-1][1]) <= 4
    owners = np.concatenate([o for _, o in got])
    assert owners.tolist() == [i for i, t in enumerate(texts) for _ in range(-(-len(t) // byte_gru.SPAN))]


def test_no_scattered_lookups_in_a_step(model, monkeypatch):
    """A step changes all parameters, views of one row, at once; its sums by byte are cut by one count for both directions."""
    params = [p.copy() for p in model.params()]
    own = byte_gru.with_params(model, np.concatenate([p.ravel() for p in params]))
    adam = byte_gru._Adam(own)
    steps = np.random.default_rng(3).choice(np.frombuffer(b"abcd", np.uint8), (16, 6))
    calls, diff = [], np.diff
    monkeypatch.setattr(np, "diff", lambda *a, **k: calls.append(1) or diff(*a, **k))
    loss, grads = byte_gru.gradients(own, steps, np.array([0, 1] * 3))
    assert not calls
    adam.step(grads, 0.01)
    for before, after, grad in zip(params, own.params(), grads):
        moved = np.abs(grad) > 1e-4
        assert np.shares_memory(after, adam.row) and np.array_equal(np.sign(before - after)[moved], np.sign(grad)[moved])
    assert byte_gru.gradients(own, steps, np.array([0, 1] * 3))[0] < loss
