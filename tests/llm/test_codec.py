"""Byte-pair encoding and decoding against the tokenizer library."""

from __future__ import annotations

import hashlib
import random
import unicodedata

import pytest
from tokenizers import Tokenizer

from tests.conftest import SF_DIR
from tradeops.llm import op13
from tradeops.llm.bpe_codec import Codec, codec, with_tokens
from tradeops.llm.common import tokenizer_path

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = tokenizer_path(request.param)
    return Tokenizer.from_file(path), codec(path)


def same(both, text):
    library, own = both
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids, text[:80]
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False), text[:80]


def test_random_texts(both):
    # Marks that are newer than the library's tables are put in another order there.
    known = [c for i in range(1, 0x20000) if unicodedata.category(c := chr(i)) not in ("Cs", "Cn") and (i < 0x400 or not unicodedata.combining(c))]
    latin, marked = [chr(i) for i in range(1, 0x250)], list("  \n\t\x0b\x1c\x85\xa0'sSΣσςİßé́")
    special = ["<|endoftext|>", "<|startoftext|>", "<|end", "hello ", " the", "'ll", "  "]
    draw = random.Random(3)
    for k in range(4000):
        pool = (known, latin, marked, special)[k % 4]
        same(both, "".join(draw.choice(pool if draw.random() < 0.7 else latin) for _ in range(draw.randrange(30))))


@pytest.mark.parametrize("text", ["a" * 100_000, "ab" * 50_000, " " * 300_000 + "x", "é" * 50_000, "\n" * 300_000, "", "<|endoftext|>" * 3])
def test_long_and_empty(both, text):
    same(both, text)


def test_stale_entries_and_ties(both):
    for word in ("aaaaaaaa", "ababababa", "thethethe", "ininining", "ssssssst", "aaaaaaa" * 9):
        same(both, word)


def test_unknown_steps_are_errors(tmp_path):
    import json

    with open(tokenizer_path(FILES[0]), encoding="utf-8") as f:
        spec = json.load(f)
    for key, value in (("normalizer", {"type": "StripAccents"}), ("pre_tokenizer", {"type": "Whitespace"}), ("decoder", {"type": "WordPiece"})):
        path = tmp_path / f"{key}.json"
        path.write_text(json.dumps(spec | {key: value}))
        with pytest.raises((ValueError, KeyError)):
            Codec(str(path))


def test_words_beyond_the_table(both, monkeypatch):
    monkeypatch.setattr("tradeops.llm.bpe_codec.WORDS", 3)
    for text in ("one two three four five", "six seven " + "long" * 40, "one two", "eight"):
        same(both, text)


def test_columns(spark):
    rows = [(1, None, "keep", "x"), (1, "", "keep", "y"), (2, "Hello  World", "k", "z"), (2, "Hello  World", "k", "z")]
    df = spark.createDataFrame(rows, "doc_id long, body string, text string, `encode(text)` string")
    out = with_tokens(df, tokenizer_path(FILES[0]), "body", "ids", "back")
    assert out.columns == [*df.columns, "ids", "back"]
    got = sorted((r["doc_id"], tuple(r["ids"]), r["back"], r["text"]) for r in out.collect())
    ids = codec(tokenizer_path(FILES[0])).encode("hello world")
    assert got == [(1, (), "", "keep")] * 2 + [(2, tuple(ids), "hello</w> world</w>", "k")] * 2
    assert with_tokens(df.limit(0), tokenizer_path(FILES[0]), "body").count() == 0


def test_query_against_library(spark):
    library = Tokenizer.from_file(tokenizer_path(op13.TOKENIZER))
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    got = op13.run(spark, SF_DIR).collect()
    assert len(got) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in got:
        ids = library.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(" ".join(map(str, ids))), sha(back))
