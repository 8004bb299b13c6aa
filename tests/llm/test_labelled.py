"""Bounded training samples."""

from __future__ import annotations

import zlib

from tradeops.llm.labelled import training_sample

DOCS, LABELS = "doc_id long, text string", "doc_id long, toxic int"


def taught(i):
    return zlib.crc32(str(i).encode()) % 5 != 0


def sample(spark, docs, labels, rows, longest=100):
    return training_sample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), "toxic", rows, longest)


def test_only_long_texts_teach_a_part(spark):
    ids = [i for i in range(200) if taught(i)]
    docs = [(i, f"{i} " * 500) for i in range(200)]
    texts, classes, share = sample(spark, docs, [(i, i % 2) for i in range(200)], {0: 30, 1: 20})
    assert classes == [0] * 30 + [1] * 20 and all(len(t) == 100 for t in texts)
    assert share == sum(i % 2 for i in ids) / len(ids)
    assert len({t[:8] for t in texts}) > 25


def test_labels_without_documents_take_no_place(spark):
    known = [i for i in range(5000) if taught(i)]
    docs = [(i, f"text {i}") for i in known[-40:]]
    texts, classes, _ = sample(spark, docs, [(i, i % 2) for i in range(5000)], {0: 1000, 1: 1000})
    assert sorted(texts) == sorted(t for _, t in docs)
    assert classes == sorted(i % 2 for i, _ in docs)


def test_repeated_ids_and_odd_rows(spark):
    a, b = [i for i in range(20) if taught(i)][:2]
    hidden = next(i for i in range(20) if not taught(i))
    docs = [(a, "same text")] * 20_000 + [(b, "one"), (b, "other"), (None, "no id"), (hidden, "held out")]
    labels = [(a, 0), (a, 1), (b, 0), (None, 1), (hidden, 1), (a, None)]
    texts, classes, _ = sample(spark, docs, labels, {0: 5, 1: 5})
    assert classes == [0, 1] and texts[1] == "same text" and texts[0] in ("one", "other")


def test_nothing_to_learn_from(spark):
    assert sample(spark, [], [], {0: 5, 1: 5}) == ([], [], 0.0)
    assert sample(spark, [(1, None), (2, "")], [(1, 0), (2, 1)], {0: 5, 1: 5})[:2] == ([], [])
