from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.conftest import SF_DIR
from tradeops.llm import op5
from tradeops.llm.byte_pairs import PrefixCounter
from tradeops.llm.common import tokenizer_path
from tradeops.llm.token_counts import longest_within, tokens_at, with_token_counts

library = Tokenizer.from_file(tokenizer_path())


def n(text: str) -> int:
    return len(library.encode(text, add_special_tokens=False).ids)


def odd_texts():
    rng = random.Random(5)
    bits = ["a", "the", " ", "  ", "\n", "\t", "'re", "'ll", "'", "'s", "é", "日本", "😀", "12", "!!", "<|endoftext|>", "<|end", "ⅷ", "²", "　", " ", "ing", "\x1c", "\x85", "​", "á", "_"]
    return ["", " ", "\n\n", "aaaa" * 50, *("".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(250))]


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(tokenizer_path(), words=100)


def test_totals(counter):
    texts = odd_texts()
    assert counter.totals(texts) == [n(t) for t in texts]


def test_every_prefix(counter):
    for text in odd_texts():
        assert counter.prefixes(text) == [n(text[:k]) for k in range(len(text) + 1)], repr(text)


def test_budget_questions(spark):
    text = "Counting, they're counting   tokens\n\nwithin budgets"
    df = spark.createDataFrame([(1, text, "x"), (2, None, "y"), (2, None, "y")], "doc_id int, text string, n_chars string")
    rows = with_token_counts(df, tokenizer_path(), prefixes="prefix").select("*", tokens_at(F.col("prefix"), 9).alias("nine"), longest_within(F.col("prefix"), 4).alias("fit")).collect()
    full = next(r for r in rows if r["doc_id"] == 1)
    assert full["n_tokens"] == n(text) and full["nine"] == n(text[:9])
    assert full["fit"] == max(k for k in range(len(text) + 1) if n(text[:k]) <= 4)
    assert [(r["n_tokens"], r["prefix"], r["fit"]) for r in rows if r["doc_id"] == 2] == [(0, [0], 0)] * 2


def test_query_against_library(spark):
    rows = op5.run(spark, SF_DIR).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n(t), n(t) > 1024)


def test_empty_and_long(spark):
    df = spark.createDataFrame([], "doc_id int, text string")
    assert with_token_counts(df, tokenizer_path()).collect() == []
    long = "word " * 200_000 + " " * 5_000 + "x" * 5_000
    assert with_token_counts(spark.createDataFrame([(long,)], "text string"), tokenizer_path()).first()["n_tokens"] == n(long)


def test_budgets_from_prefix_counts():
    counter = PrefixCounter(tokenizer_path())
    rng = random.Random(11)
    parts = [" ", "  ", "   ", "\n", "\t ", "word", " the", "é", "'re", "123", "!?", " " * 9, "<|endoftext|>", "unbelievably", "日本"]
    for k in range(400):
        text = "".join(rng.choice(parts[:12] if k % 3 else parts) for _ in range(rng.randrange(25)))
        counts = counter.prefixes(text)
        for budget in {0, 1, rng.randrange(12), counts[-1], max(counts[-1] - 1, 0)}:
            assert counter.longest_within(text, budget) == max(i for i, n in enumerate(counts) if n <= budget), (text, budget)


def test_query_answers_its_budget(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    counter = PrefixCounter(tokenizer_path())
    for r in op5.run(spark, SF_DIR).collect():
        text, chars = docs[r["doc_id"]], r["chars_within_limit"]
        assert (chars < len(text)) == r["over_limit"]
        assert counter.totals([text[:chars]])[0] <= op5.LIMIT


def test_neighbours_without_encoding_them_again():
    """Whether two tokens stay apart follows from how they are made, and no pair's text is encoded for it."""
    pairs = PrefixCounter(tokenizer_path()).pairs
    rng, tokens = random.Random(3), sorted(pairs.tokens)
    short = [t for t in tokens if len(t) < 4]
    drawn = [(rng.choice(tokens), rng.choice(tokens)) for _ in range(1500)] + [(rng.choice(short), rng.choice(short)) for _ in range(1500)]
    drawn += [(t * 1, t) for t in short[::40]] + [(t[:k], t[k:]) for t in tokens[::40] for k in range(1, len(t)) if {t[:k], t[k:]} <= pairs.tokens]
    drawn += [(a * 2, a) for a in short if len(a) == 1 and a * 2 in pairs.tokens] + [(a, a * 2) for a in short if len(a) == 1 and a * 2 in pairs.tokens]
    assert pairs._in_order
    for a, b in drawn:
        assert pairs._stay_apart(a, b) == (pairs.merge(a + b) == [a, b]), (a, b)


def test_words_are_learned_without_encoding_pairs(monkeypatch):
    counter = PrefixCounter(tokenizer_path())
    monkeypatch.setattr(type(counter.pairs), "merge", None)
    texts = ["strangely worded inventions aaaaaa", "wörds of no wordbook: xqzjkv", "word " * 20, "<|endoftext|> and more words"]
    totals, chars = counter.with_budget(texts, 9)
    assert totals == [n(t) for t in texts] and totals == counter.totals(texts)
    assert chars == [counter.longest_within(t, 9) for t in texts]
