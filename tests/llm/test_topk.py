from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tradeops.llm import exact_topk as topk
from tradeops.llm import op2
from tradeops.workload import compare


def brute(rows, every, k):
    good = [(i, v, [int(np.floor(256 * float(np.float32(x)))) for x in e]) for i, (v, e) in enumerate(rows) if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, q, x in good:
        if q is not None and q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), v is None, v or 0, j) for j, v, y in good if j != i)
            out += [(q, r, None if n else v, -s) for r, (s, n, v, _) in enumerate(scores[:k], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("block", [4096, 16])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "STRIP", 5)
    monkeypatch.setattr(topk, "BROADCAST", 16 << 20 if block > 16 else 800)  # one block of queries, or several
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6) * rng.choice([0.01, 1, 30])]) for i in range(300)]
    rows += [(i, [0.5, -0.25, 1.0]) for i in range(300, 330)] + [(40, [0.1] * 6), (None, [1.0] * 6), (1000, []), (1010, [0.0] * 6)]
    rows += [(50, None), (60, [None, 1.0]), (70, [float("nan")]), (80, [float("inf"), 0.0])]
    df = spark.createDataFrame([(v, e, 1.0) for v, e in rows], "vec_id long, embedding array<float>, norm double")
    got = topk.exact_topk(df, F.col("vec_id") % 10 == 0, 5).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows, 10, 5)


def test_large_values_stay_exact(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 1.0]), (2, [3e6, 1.01]), (3, [-2e6, 0.0]), (4, [2.9e6, 5e5])]  # beyond 2^53
    got = topk.exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0, 2).collect()
    assert [tuple(r) for r in got] and sorted(map(repr, map(tuple, got))) == [x for x in brute(rows, 50, 2)]


def test_scores_saturate(spark):
    rows = [(0, [3e7, 1.0]), (1, [3e7, 1.0]), (2, [1e18, 1.01]), (3, [-1e18, 0.0])]
    got = topk.exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") == 0, 3).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 2**63 - 1), (0, 2, 2, 2**63 - 1), (0, 3, 3, -(2**63))]


def test_matches_twin(spark, duck_docs):
    assert compare.difference(op2.run(spark, SF_DIR), duck_docs, op2.SQL) is None


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0])], schema)
    assert topk.exact_topk(one, F.col("vec_id") == 0, 5).collect() == []
    assert topk.exact_topk(spark.createDataFrame([], schema), F.col("vec_id") == 0, 5).collect() == []


def test_vectors_are_read_once_a_block_of_queries(spark, monkeypatch):
    """What is written grows with queries times k times tasks, not with vectors times queries."""
    seen, staged = {}, topk.staged

    def stage(df, label):
        out = staged(df, label)
        seen.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(topk, "staged", stage)
    rng = np.random.default_rng(5)
    for n in (400, 1600):
        rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(n)]
        seen.clear()
        df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
        assert topk.exact_topk(df, F.col("vec_id") % 50 == 0, 3).count() == 3 * n // 50
        assert seen["by-length"] == [n] and seen["found"] == [3 * n // 50]
