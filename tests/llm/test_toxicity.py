from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest

from tests.conftest import SF_DIR
from tradeops.llm import op4, toxicity
from tradeops.llm import subsequence_svm as svm


def brute_kernel(a, b):
    def features(w):
        out = {}
        for i, j, k in itertools.combinations(range(len(w)), 3):
            if k - i < svm.REACH:
                key = tuple(svm._ASCII[ord(c)] if ord(c) < 128 else 37 + ord(c) % 27 for c in (w[i], w[j], w[k]))
                out[key] = out.get(key, 0) + svm.DECAY ** (k - i + 1)
        norm = sum(v * v for v in out.values()) ** 0.5
        return {key: v / norm for key, v in out.items()}

    x, y = features(a), features(b)
    return sum(v * y.get(key, 0) for key, v in x.items())


def test_kernel():
    words = ["moron", "mor-on", "mooron", "the", "aaaaaa", "ab", "éclair", "stupid"]
    got = svm.kernel(words, words)
    for (i, a), (j, b) in itertools.product(enumerate(words), repeat=2):
        assert got[i, j] == pytest.approx(brute_kernel(a, b), abs=1e-5)
    assert got[0, 0] == pytest.approx(1) and got[5, 5] == 0
    assert got[0, 2] > 0.6 > 0.3 > got[0, 3]


def test_long_words_keep_their_norm():
    word = "abcdefghij" * 20
    owner, _, weight = svm.subsequences([word, "xyz"])
    assert np.bincount(owner, weight**2) == pytest.approx([1, 1])


@pytest.fixture(scope="module")
def machine():
    rng = np.random.default_rng(0)
    plain = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(300)]
    insults = ["moron", "stupid", "worthless"]
    texts, labels = [], []
    for i in range(160):
        words = list(rng.choice(plain, 60))
        if i % 2:
            for at in rng.choice(60, 3, replace=False):
                words[at] = rng.choice(insults)
        texts.append(". ".join(" ".join(words[k : k + 10]) for k in range(0, 60, 10)))
        labels.append(i % 2)
    return svm.train(texts, labels, 0.5)


def test_gapped_and_inserted(machine):
    clean = "abcdef gfedcb abcabc. hhgfab aaccee."
    base = machine.score(clean)
    assert base < 0.5
    for insult in ("moron moron", "MORON", "m o r o n", "mooron stupidd", "worth-less moron"):
        assert machine.score(f"{clean} abc {insult} abd. {insult}.") > max(0.5, base)


def test_odd_rows(spark, machine):
    rows = [(1, None, 0.5), (2, "", 0.5), (2, "", 0.5), (None, "moron stupid. " * 3, 1.0), (4, "abc " * 100_000, 0.0), (5, "é!!! ...", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label double")
    got = toxicity.with_toxicity(df, machine).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    by_text = {r["text"]: r["score"] for r in got}
    assert by_text[None] == by_text[""] < 0.5 < by_text["moron stupid. " * 3]
    assert {r["score"] for r in toxicity.with_toxicity(df, None, 0.25).collect()} == {0.25}
    none = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, None)], "doc_id long, toxic int")
    assert toxicity.learn(none, labels)[0] is None


def test_query_on_held_out_labels(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op4.run(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    hidden = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert hidden and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in hidden)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in hidden) >= 0.93 * len(hidden)
