from __future__ import annotations

import numpy as np
import pytest

from tests.conftest import SF_DIR
from tradeops.llm import op7, quality

GOOD = ["The quick brown fox jumps over the lazy dog, and then it rests for a while.\nAnother line of prose follows here."]
BAD = ["BUY!!! NOW!!! $$$ %%% BUY!!! NOW!!! $$$ %%% | | | 0000 BUY!!! NOW!!!", "a | b | c | a | b | c | a | b | c |"]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(0)
    good = ["\n".join(" ".join(rng.choice(GOOD[0].split(), rng.integers(5, 30))) + "." for _ in range(rng.integers(1, 9))) for _ in range(150)]
    bad = [" ".join(rng.choice(BAD[i % 2].split(), rng.integers(20, 200))) for i in range(150)]
    x = np.array([quality.statistics(t) for t in good + bad])
    return quality.fit(x, np.array([1] * 150 + [0] * 150), 0.5)


def test_density_by_brute_force(model):
    rng = np.random.default_rng(1)
    x = np.hstack([model.mean + model.deviation * rng.normal(size=(20, len(model.mean))), np.ones((20, 1))])
    z = np.clip((x[:, :-1] - model.mean) / model.deviation, -quality.BOUND, quality.BOUND)
    logs = []
    for m, f in zip(model.centres, model.factors):
        s = f @ f.T
        d = z - m
        logs.append(np.log(0.5) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
    want = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
    assert np.allclose(model.scores(x), want, atol=1e-6)


def test_odd_rows(spark, model):
    rows = [(1, None, 0.1), (2, "", 0.1), (2, "", 0.1), (None, GOOD[0], 0.0), (4, BAD[0] * 50, 0.0), (5, "é", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality double")
    got = quality.with_quality(df, model, 0.5).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    by_text = {r["text"]: r["score"] for r in got}
    assert by_text[GOOD[0]] > 0.5 > by_text[BAD[0] * 50] and by_text[None] == by_text[""]
    assert {r["score"] for r in quality.with_quality(df, None, 0.25).collect()} == {0.25}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert quality.with_quality(none, model, 0.5).collect() == []
    assert quality.learn(none, spark.createDataFrame([], "doc_id long, quality int")) == (None, 0.5)


def test_query_on_held_out_labels(spark):
    folder = SF_DIR.replace("0.001", "0.01")
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op7.run(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    hidden = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in hidden) >= 0.95 * len(hidden)
