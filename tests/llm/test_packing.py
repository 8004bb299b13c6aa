from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF_DIR
from tradeops.llm import op6, packing
from tradeops.llm.common import tokenizer_path

library = Tokenizer.from_file(tokenizer_path())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30)))
def test_plan_places_everything(histogram):
    patterns = packing.plan(histogram, 40)
    used = defaultdict(int)
    for p in patterns:
        assert p.bins > 0 and sum(x * k for x, k in p.runs) <= 40
        for x, k in p.runs:
            used[x] += k * p.bins
    assert dict(used) == histogram


def test_exact_sums_first():
    patterns = packing.plan({60: 5, 40: 2, 25: 2, 15: 2, 20: 1, 10: 2}, 100)
    assert sum(p.bins for p in patterns) == 5  # 60+40 twice, 60+25+15 twice, 60+20+10+10


def test_plan_does_not_grow_with_the_corpus():
    rng = random.Random(1)
    small = {x: rng.randint(1, 50) for x in range(1, 1025)}
    large = {x: c * 10**9 for x, c in small.items()}
    patterns = packing.plan(large, 1024)
    assert len(patterns) < 8 * 1024
    # no two lengths above half the size share a sequence
    least = max(sum(x * c for x, c in large.items()) / 1024, sum(c for x, c in large.items() if x > 512))
    assert sum(p.bins for p in patterns) <= 1.02 * least


def check(rows, texts):
    expected = {}
    for doc, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        head = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        cuts = [0, *range(head, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.setdefault((doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())), []).append(1)
    got, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]].append(1)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == expected
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return len(bins)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = op6.run(spark, SF_DIR).collect()
    n = check(rows, [(r["doc_id"], r["text"]) for r in docs])
    assert n <= 1.05 * sum(r["length"] for r in rows) / 1024 + 1


def test_odd_rows(spark):
    texts = [(1, None), (1, None), (None, ""), (2, "x <|endoftext|> y"), (3, "word " * 1023), (4, "word " * 1024), (5, "a b " * 9000), *((i, "same") for i in range(10, 40))]
    df = spark.createDataFrame([(d, t, 0) for d, t in texts], "doc_id long, text string, length int")
    check(packing.pack_documents(df.repartition(7), tokenizer_path()).collect(), texts)


def test_empty(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), tokenizer_path()).collect() == []


def test_encoder_has_the_library_ids():
    texts = ["Hello  world\n\n they're 日本語 😀<|endoftext|>!!!", "\x1c\x85 　é ²ⅷ", " " * 400 + "x" * 400]
    for t in texts:
        assert packing.encoder(tokenizer_path()).encode(t) == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    [
        "x" + " " * 1_200_000 + "y",
        "x" + "\n" * 1_200_000,
        " \t" * 600_000 + "<|endoftext|>" + " " * 20_000 + "b",
        "a" * 1_200_000,
        "a " * 600_000,
        "?" * 1_200_000,
    ],
    ids=["spaces", "newlines", "before a special string", "one word", "one-letter words", "marks"],
)
def test_very_long_texts(text):
    assert packing.encoder(tokenizer_path()).encode(text) == library.encode(text, add_special_tokens=False).ids


def test_long_runs_are_cut_as_the_library_does():
    own, rng = packing.Encoder(tokenizer_path(), long_run=3), random.Random(2)
    parts = [" ", "  ", "\n", "   ", "\t", "a", "b1", "<|endoftext|>", "'s", "é", "\u3000", "     "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids, text


def test_white_space_does_not_end_the_job(spark):
    texts = [(1, "x" + " " * 1_000_000 + "y"), (2, "plain")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    check(packing.pack_documents(df, tokenizer_path()).collect(), texts)


def test_clashing_columns(spark):
    pieces = spark.createDataFrame([(3, i, f"k{i}", "t", "s", "w") for i in range(5)], "length long, place long, base string, task string, slot string, `row.x` string")
    out = packing.pack(pieces.coalesce(1), 10)
    assert out.columns == ["length", "base", "task", "slot", "row.x", "sequence_id", "offset"]
    rows = out.collect()
    assert sorted(r["base"] for r in rows) == [f"k{i}" for i in range(5)] and len({r["sequence_id"] for r in rows}) == 2
