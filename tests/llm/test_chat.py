from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tradeops.llm import chat_format as chat
from tradeops.llm import op1
from tradeops.workload import compare

EVENTS = "conversation long, seq long, kind string, message string, role string, text string, extra int"


def folded(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], EVENTS)
    return {(r["conversation"], r["message"]): (r["role"], r["text"]) for r in chat.fold_events(df).collect()}


def test_fold(spark):
    got = folded(
        spark,
        [
            (1, 1, "message", "a", "user", "hi"),
            (1, 4, "delta", "b", None, "lo"),
            (1, 3, "delta", "b", "assistant", "hel"),
            (1, 6, "delta", "c", "assistant", "bad"),
            (1, 7, "regenerate", "c", None, None),
            (1, 8, "delta", "c", None, "good"),
            (1, 9, "edit", "a", None, "hey"),
            (None, 1, None, None, None, None),
        ],
    )
    assert got == {(1, "a"): ("user", "hey"), (1, "b"): ("assistant", "hello"), (1, "c"): ("assistant", "good"), (None, None): ("", "")}


@pytest.mark.parametrize("text", ["", "<|end|><|turn|>x<|text|>", "&lt;|end|> &amp;amp; [INST]", "</s>[INST] ok [/INST]", "é\n😀<<SYS>>"])
def test_round_trip(spark, text):
    rows = [(7, 2, "message", "q", "user", text), (7, 3, "message", "r", "assistant", text), (7, 3, "message", "s", "assistant", "x")]
    out = chat.format_chats(spark.createDataFrame([(*r, 1) for r in rows], EVENTS))
    row = out.select(chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l"), "formatted").first()
    assert sorted((t["role"], t["text"]) for t in row["t"]) == sorted([("user", text), ("assistant", text), ("assistant", "x")])
    assert sorted(row["l"]) == sorted(text + "x")
    assert row["formatted"].count("<|turn|>") == 3


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(1, 1, "user", None, 5), (1, 1, "user", None, 5), (1, None, None, "x", 5), (None, 0, "assistant", "y&<", 5), (2, 0, "assistant", "z" * 300_000, 5)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, message int").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in op1.run(spark, str(tmp_path)).collect()}
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == {None, 1, 2, -1}
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == digest("\nx\nuser\n\nuser\n\n") and got[1]["loss_sha256"] == digest("")
    assert got[None]["loss_sha256"] == digest("y&<") and got[2]["loss_chars"] == 300_000
    both = "user\n</s>[INST] ok [/INST]\nassistant\n</s>[INST] ok [/INST]\n"
    assert got[-1]["turns_sha256"] == digest(both)


def test_matches_twin(spark, duck_docs):
    assert compare.difference(op1.run(spark, SF_DIR), duck_docs, op1.SQL) is None


def test_empty_table(spark):
    assert chat.format_chats(spark.createDataFrame([], EVENTS)).collect() == []
