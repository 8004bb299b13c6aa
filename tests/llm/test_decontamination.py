from __future__ import annotations

import itertools
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from tests.conftest import SF_DIR
from tradeops.llm import decontamination as dec
from tradeops.llm import op8


def test_common_length():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 9)), rng.integers(0, 5, rng.integers(0, 9))
        want = max((len(s) for k in range(len(a) + 1) for s in itertools.combinations(a, k) if _inside(s, b)), default=0)
        assert dec.common_length(a, b) == want


def _inside(s, b):
    it = iter(b.tolist())
    return all(x in it for x in s)


def test_passages_are_counted_without_search_trees(monkeypatch):
    """Each cell once a passage; whole passages are sorted side by side, so only what is left behind them is made unique alone."""
    text = " ".join(f"w{i * i % 23}" for i in range(16 * 40 + 5))
    c = dec.cells(dec.words(text))
    want = np.bincount(np.concatenate([np.unique(c[i : i + 16]) for i in range(0, len(c), 16)]), minlength=dec.CELLS)
    sizes, unique = [], np.unique
    monkeypatch.setattr(dec.np, "unique", lambda x, *a, **b: sizes.append(len(x)) or unique(x, *a, **b))
    got = [np.bincount(dec._passage_cells(t), minlength=dec.CELLS) for t in (text, "w1 w2 w1", "", None)]
    assert (got[0] == want).all() and [x.sum() for x in got[1:]] == [2, 0, 0]
    assert max(sizes) < dec.WINDOW


def test_answer():
    assert dec.answer("What is it? Answer: forty two").strip() == "forty two"
    assert dec.answer("First one here. The second one here.") == "The second one here."
    assert dec.answer("one") == "one"


def vocabulary(rng):
    return ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(900)]


def text(rng, words, n):
    return " ".join(rng.choice(words) if rng.random() < 0.7 else rng.choice(words[:20]) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(9)
    words = vocabulary(rng)
    items = [(i, text(rng, words, rng.randint(16, 60)) + ". " + text(rng, words, 8) + ".") for i in range(30)]
    docs, leaks = [], set()
    for d in range(160):
        body = text(rng, words, rng.randint(10, 400)).split()
        if d % 4 == 0:
            item = rng.choice(items)
            leak = item[1].split()
            if d % 8 == 0:  # a paraphrase: other words at some places, some left out, other case and punctuation
                leak = [w.upper() + "," if rng.random() < 0.2 else w for w in leak]
                leak = [rng.choice(words) if rng.random() < 0.12 else w for w in leak if rng.random() > 0.04]
            at = rng.randint(0, len(body))
            body[at:at] = leak
            leaks.add((d, item[0]))
        docs.append((d, " ".join(body), 1.0))
    docs += [(900, None, 0.0), (901, "", 0.0), (902, "!!!", 0.0), (None, items[3][1], 0.0), (903, items[4][1], 0.0), (903, items[4][1], 0.0)]
    leaks |= {(None, 3), (903, 4)}
    schema = "doc_id long, text string, item_id double"
    return spark.createDataFrame(docs, schema), spark.createDataFrame([*items, (98, None), (99, "?!")], "item_id long, text string"), leaks


@pytest.mark.parametrize("block", [200_000, 300])
def test_planted(spark, monkeypatch, planted, block):
    monkeypatch.setattr(dec, "BLOCK", block)
    docs, bench, leaks = planted
    rows = dec.contaminated(docs, bench).collect()
    found = {(r["doc_id"], r["item_id"]) for r in rows}
    assert found <= leaks
    assert len(found) >= 0.9 * len(leaks)
    assert sum(r["doc_id"] == 903 for r in rows) == 2


def test_directions_are_singular_vectors(spark):
    rng = random.Random(2)
    words = vocabulary(rng)[:60]
    texts = [text(rng, words, 16) for _ in range(120)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    idf = dec.inverse_frequencies(df)
    row, column, weight, n = dec._entries(texts, idf)
    dense = np.zeros((n, dec.CELLS), np.float32)
    np.add.at(dense, (row, column), weight)
    used = np.flatnonzero(dense.any(axis=0))
    exact = np.linalg.svd(dense[:, used], compute_uv=False)
    basis = dec.directions(df, idf, rank=8).astype(np.float32) / dec.LIFT
    got = np.linalg.norm(dense @ basis, axis=0)
    assert np.allclose(basis.T @ basis, np.eye(8), atol=5e-3)
    assert np.allclose(got[:3], exact[:3], rtol=0.03)


def test_query_finds_whole_items(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    whole = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in (d["text"] or "")}
    found = {(r["doc_id"], r["item_id"]) for r in op8.run(spark, folder).collect()}
    assert whole and whole <= found
    assert len({d for d, _ in found} - {d for d, _ in whole}) <= 0.005 * len(docs)


def test_empty(spark, planted):
    docs, bench, _ = planted
    none = spark.createDataFrame([], "doc_id long, text string")
    assert dec.contaminated(none, bench).collect() == []
    assert dec.contaminated(docs, spark.createDataFrame([], "item_id long, text string")).collect() == []


def test_candidates_lose_nothing_the_last_checks_keep():
    """Paraphrases without their rarest words, and items shorter than a passage, against a search of every region."""
    rng = random.Random(5)
    common, rare = vocabulary(rng)[:60], ["r" + w for w in vocabulary(rng)]
    draw = lambda n: [rng.choice(common) if rng.random() < 0.6 else rng.choice(rare) for _ in range(n)]
    corpus = [" ".join(draw(120)) for _ in range(150)]
    items = [(i, " ".join(draw(n))) for i, n in enumerate([40] * 25 + [7] * 25)]
    counts = np.bincount(np.concatenate([dec._passage_cells(t) for t in corpus]), minlength=dec.CELLS)
    idf = np.log(1 + counts.sum() / dec.WINDOW / (1 + counts)).astype(np.float32)
    row, column, weight, n = dec._entries(corpus + [t for _, t in items], idf)
    used, place = np.unique(column, return_inverse=True)
    dense = np.zeros((n, len(used)))
    np.add.at(dense, (row, place), weight)
    basis = np.zeros((dec.CELLS, dec.RANK))
    basis[used] = np.linalg.svd(dense, full_matrices=False)[2][: dec.RANK].T
    basis = dec._half(basis)
    index = dec.build_index(items, idf, basis)
    expected = found = 0
    for number, text in items:
        w = text.split()
        if len(w) > dec.WINDOW:
            for i in sorted(range(len(w)), key=lambda i: w[i] not in rare)[: int(0.35 * len(w))]:
                w[i] = f"new{i}"
        leak = " ".join(draw(31 + number) + w + draw(50))
        h, item, end = dec.words(leak), index.items[number], index.answers[number]
        wide = len(item) // 4 + 4
        regions = [h[max(b - wide, 0) : b + len(item) + wide] for b in range(len(h))]
        if any(dec.common_length(item, r) >= dec.SAME * len(item) and dec.common_length(end, r) >= dec.ANSWERED * len(end) for r in regions):
            expected += 1
            found += number in [m[0] for m in dec.matches(leak, index, idf, basis)]
    assert expected >= 40 and found >= 0.97 * expected, (found, expected)


def test_short_paraphrases_are_found(spark):
    """Items of 6 to 14 words with a fifth of the words replaced, planted in documents of the test tables."""
    rng = random.Random(21)
    folder = SF_DIR.replace("0.001", "0.01")
    docs = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if r["text"] and len(r["text"].split()) > 60]
    pool = [w for t in docs[:200] for w in t.split()]
    bench, leaks, expected = [], [], set()
    for k in range(60):
        n = rng.randint(6, 14)
        item = [rng.choice(pool) for _ in range(n)]
        bench.append((k, " ".join(item)))
        changed = list(item)
        for i in rng.sample(range(n), max(round(0.2 * n), 1)):
            changed[i] = rng.choice(pool)
        around = docs[rng.randrange(len(docs))].split()[:60]
        leaks.append((k, " ".join(around[:30] + changed + around[30:])))
        item_h, region = dec.words(bench[-1][1]), dec.words(" ".join(changed))
        end = dec.words(dec.answer(bench[-1][1]))
        if dec.common_length(item_h, region) >= dec.SAME * n and dec.common_length(end, region) >= dec.ANSWERED * len(end):
            expected.add(k)
    rest = [(1000 + i, t) for i, t in enumerate(docs)]
    found = dec.contaminated(
        spark.createDataFrame(leaks + rest, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    ).collect()
    caught = {r["doc_id"] for r in found if r["doc_id"] == r["item_id"]}
    assert len(expected) > 50 and len(caught & expected) >= 0.9 * len(expected), (len(caught & expected), len(expected))
    assert len({r["doc_id"] for r in found if r["doc_id"] >= 1000}) <= 0.005 * len(rest)


def test_the_sample_holds_each_text_once(spark, monkeypatch):
    monkeypatch.setattr(dec, "SAMPLE", 20)
    seen = []
    monkeypatch.setattr(dec, "directions", lambda fitted, idf: seen.append([r[0] for r in fitted.collect()]) or np.zeros((dec.CELLS, dec.RANK), np.float16))
    docs = spark.createDataFrame([(1, "the same words again and again")] * 500 + [(i, f"text number {i}") for i in range(40)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "an item of the benchmark")], "item_id long, text string")
    dec.contaminated(docs, bench)
    assert len(seen[0]) == len(set(seen[0])) and len(seen[0]) <= 21


@pytest.mark.parametrize("use", [dec.contaminated, dec.uncontaminated])
def test_directions_are_those_of_all_texts(spark, monkeypatch, use):
    """What texts outside the sample say, and nothing in it does, is in the directions; each text counts once."""
    monkeypatch.setattr(dec, "SAMPLE", 6)
    seen, search = [], dec._search
    monkeypatch.setattr(dec, "_search", lambda indexes, weights, kind: seen.append(weights.value) or search(indexes, weights, kind))
    rng = random.Random(12)
    words = [f"w{i}" for i in range(48)]
    texts = [" ".join(rng.choice(words[8 * (i % 6) :][:8]) for _ in range(40)) for i in range(240)]
    bench = spark.createDataFrame([(1, "an item of the benchmark")], "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)) + [(1000 + i, texts[0]) for i in range(300)] + [(9, None)], "doc_id long, text string").repartition(5)
    use(docs, bench)
    idf, basis = seen[0]
    row, column, weight, n = dec._entries([*texts, "an item of the benchmark"], idf)
    dense = np.zeros((n, dec.CELLS), np.float32)
    np.add.at(dense, (row, column), weight)
    used = np.flatnonzero(dense.any(axis=0))
    exact = np.linalg.svd(dense[:, used], compute_uv=False)
    got = np.linalg.norm(dense @ (basis.astype(np.float32) / dec.LIFT), axis=0)
    assert np.allclose(got[:8], exact[:8], rtol=0.01)
    assert (got**2).sum() > 0.995 * (exact[: dec.RANK] ** 2).sum()


def test_a_fitting_task_takes_as_many_staged_words_as_words_of_texts():
    words = dec.PORTION // (2 * dec.SIZE)
    portions = list(dec._portions([bytes(2 * (words // 4))] * 9))
    assert [len(p) for p in portions] == [4, 4, 1]


def test_all_cells_are_those_of_every_text(spark):
    docs = spark.createDataFrame([("b a",), ("a b c",), ("b, A",), (None,), ("",), ("?!",)], "text string")
    bench = spark.createDataFrame([(1, "a b c"), (2, "d"), (3, None)], "item_id long, item string")
    got = sorted(bytes(r[0]) for r in dec._all_cells(docs, bench).collect())
    assert got == sorted(dec.cells(dec.words(t)).astype(np.uint16).tobytes() for t in ("b a", "a b c", "d"))
    none = spark.createDataFrame([], "text string")
    assert dec._all_cells(none, bench.limit(0)).collect() == []


def test_orthonormal_in_blocks():
    rng = np.random.default_rng(1)
    matrix = (rng.standard_normal((dec.CELLS, 12)) * np.logspace(0, -3, 12)).astype(np.float32)
    whole = matrix.copy()
    dec._orthonormal(matrix)
    assert np.allclose(matrix.T @ matrix, np.eye(12), atol=1e-4)
    assert np.abs(whole - matrix @ (matrix.T @ whole)).max() < 1e-4  # the same directions
    few = np.zeros((dec.CELLS, 6), np.float32)
    few[:4, 0] = 1
    dec._orthonormal(few)
    assert np.allclose(few.T @ few, np.eye(6), atol=1e-4)


def test_places_are_compared_once_and_only_with_enough_words(monkeypatch):
    """Passages that point to one place, and places with few of an item's words, cost no search for common words in order."""
    rng = random.Random(8)
    item = [f"w{i}" for i in range(40)]
    fill = lambda k: [f"f{rng.randrange(10**6)}" for _ in range(k)]
    part = [w if i % 2 else f"g{i}" for i, w in enumerate(item)]
    held, half = " ".join(fill(60) + item + fill(60)), " ".join(fill(60) + part + fill(60))
    idf = np.ones(dec.CELLS, np.float32)
    basis = dec._half(np.random.default_rng(2).standard_normal((dec.CELLS, dec.RANK)) / 100)
    index = dec.build_index([("item", " ".join(item))], idf, basis)
    looked, common = [], dec.common_length
    monkeypatch.setattr(dec, "common_length", lambda a, b: looked.append(len(a)) or common(a, b))
    monkeypatch.setattr(dec, "NEAR", 0.3)
    changed = " ".join(fill(60) + item[:20] + item[:3:-1] + fill(60))
    assert [m[0] for m in dec.matches(held, index, idf, basis)] == [0] and len(looked) == 2
    looked.clear()
    assert dec.matches(half, index, idf, basis) == [] and looked == []
    assert dec.matches(changed, index, idf, basis) == [] and 0 < len(looked) <= 30


def test_memory_of_a_fitting_task(monkeypatch):
    """A task that multiplies by the sample's passages keeps one matrix of sums, and wide rows of a bounded number of words."""
    rng = random.Random(5)
    words = vocabulary(rng)
    texts = [text(rng, words, 300) for _ in range(60)]
    peaks = []

    class Frame:
        """A task by itself: what it sends goes on at once."""

        sparkSession = property(lambda self: self)
        sparkContext = property(lambda self: self)
        groupBy = applyInPandas = lambda self, *a: self
        destroy = lambda self: None

        def broadcast(self, value):
            out = Frame()
            out.value = value
            return out

        def mapInPandas(self, work, schema):
            self.work = work
            return self

        def toLocalIterator(self):
            tracemalloc.start()
            for frame in self.work(iter([pd.DataFrame({"text": texts[:30]}), pd.DataFrame({"text": texts[30:]})])):
                for block, sums in zip(frame["block"], frame["sums"]):
                    before = tracemalloc.get_traced_memory()[0]
                    yield {"block": block, "sums": sums}
                    assert tracemalloc.get_traced_memory()[0] - before < 1 << 20
            peaks.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()

    idf = np.ones(dec.CELLS, np.float32)
    whole = dec.directions(Frame(), idf, rank=8)
    matrix = dec.CELLS * (8 + dec.OVERSAMPLING) * 4
    assert len(peaks) == dec.POWERS + 1 and max(peaks) < 2 * matrix
    assert [len(p) for p in dec._portions(["a" * dec.PORTION, None, "b"])] == [2, 1] and list(dec._portions([])) == []
    monkeypatch.setattr(dec, "PART", 700)
    monkeypatch.setattr(dec, "PORTION", 4000)
    parts = dec.directions(Frame(), idf, rank=8)
    turned = whole[:, :2].astype(float).T @ parts[:, :2].astype(float) / dec.LIFT**2
    assert np.allclose(np.abs(turned), np.eye(2), atol=2e-2)
