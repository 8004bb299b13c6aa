from __future__ import annotations

import random

import pytest

import corpus_pipeline as pipeline
from tests.conftest import SF_DIR
from tests.llm.test_jaccard import brute as near_brute
from tests.llm.test_lines import brute as line_brute
from tests.llm.test_packing import check as check_packing
from tradeops.llm import byte_gru, language_id


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returned, on the smallest test tables."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    out.append(docs.collect())
    for _, stage in pipeline.STAGES:
        docs = spark.createDataFrame(out[-1], docs.schema)
        docs = stage(spark, docs, SF_DIR)
        out.append(docs.collect())
        assert len(out) == 6 or tuple(docs.columns) == pipeline.COLUMNS
    return out


def test_order():
    assert [name for name, _ in pipeline.STAGES] == ["language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]


def test_language_stage(spark, kept):
    docs = spark.createDataFrame(kept[0])
    model = language_id.document_languages(docs)
    rows = [r for r in kept[0] if r["text"] and any(map(str.isalpha, r["text"]))]
    best = byte_gru.pooled(model, [r["text"].encode() for r in rows]).max(axis=1)
    assert sorted(kept[1]) == sorted(r for r, p in zip(rows, best) if p >= pipeline.LEAST_SCORE)
    assert len(kept[1]) > 0.98 * len(kept[0])


def test_line_stage(kept):
    want = line_brute([(r["doc_id"], r["text"]) for r in kept[1]])
    texts = {d: (t, n) for (d, _), (t, n) in want.items()}
    assert {r["doc_id"]: r["text"] for r in kept[2]} == {d: t for d, (t, n) in texts.items() if not n or t.strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in kept[2] if texts[r["doc_id"]][1])


def test_near_duplicate_stage(kept):
    groups = near_brute([(r["doc_id"], r["text"]) for r in kept[2]], 5, 80)
    assert {r["doc_id"] for r in kept[3]} == {component for _, _, component in groups}
    assert len(kept[3]) < len(kept[2])


def test_benchmark_stage(spark, kept):
    items = [r["text"] for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before, after = {r["doc_id"]: r["text"] for r in kept[3]}, {r["doc_id"] for r in kept[4]}
    whole = {d for d, t in before.items() if any(i in t for i in items)}
    assert whole and not whole & after
    assert len(after) >= len(before) - len(whole) - 1


def test_packing_stage(kept):
    check_packing(kept[5], [(r["doc_id"], r["text"]) for r in kept[4]])


def test_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, label string"
    text = "the same words in the same order, over and over again with a few more to fill the line"
    rows = [(None, None, None, None, None, "x"), (1, "", "en", "s", 0, "x"), (2, "12 34", "en", "s", 5, "x"), (3, text, "en", "s", 9, "x"), (3, text, "en", "s", 9, "x"), (5, text, None, None, None, None)]
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "nothing like it anywhere")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert [r["doc_id"] for r in got] == [3]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _passage(seed, n=60):
    rng = random.Random(seed)
    return [f"w{rng.randrange(400)}" for _ in range(n)]


def test_near_duplicate_stage_decides_by_row(spark):
    a, b, c, d, e = (" ".join(_passage(i)) for i in range(5))
    rows = [(None, a), (None, a), (1, a + " more"), (1, b), (2, a + " less"), (2, c), (2, c), (None, d), (None, d), (None, d + " end"), (7, e), (7, e + " end")]
    rows += [(None, " "), (None, " "), (None, None), (None, None), (8, None)]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], SCHEMA)
    got = [(r["doc_id"], r["text"]) for r in pipeline.remove_near_duplicates(spark, df, SF_DIR).collect()]
    # One of each group, the smallest id; a clean text stays whatever shares its id; of rows equal in id and text one stays.
    assert sorted(r for r in got if r[0] in (1, 2)) == sorted([(1, a + " more"), (1, b), (2, c)])
    assert sum(t in (d, d + " end") for _, t in got) == 1 and sum(i == 7 for i, _ in got) == 1
    assert a not in {t for _, t in got}
    assert sorted(repr(r) for r in got if not (r[1] or "").strip()) == sorted(map(repr, rows[-5:]))


def test_benchmark_stage_decides_by_row(spark, tmp_path):
    item = " ".join(_passage(50, 30))
    spark.createDataFrame([(1, item), (2, " ".join(_passage(51, 30)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    bad = [(None, " ".join(_passage(60)) + " " + item), (5, item)]
    good = [(None, " ".join(_passage(61))), (None, None), (5, " ".join(_passage(62))), (5, " ".join(_passage(62))), (6, "")]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in bad + good], SCHEMA)
    got = [(r["doc_id"], r["text"]) for r in pipeline.remove_benchmark(spark, df, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, good))


def test_run_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).collect() == []
