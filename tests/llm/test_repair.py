"""Conversation repair against enumeration of all edits, and its SQL twin."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import pytest

from pyspark.sql import functions as F
from tests.conftest import SF_DIR
from tradeops.llm import conversation_repair as cr
from tradeops.llm import op11
from tradeops.workload import compare

SOUND = re.compile(r"(s?(ua)+)?")
FIRST = {"system": "s", "user": "u", "assistant": "a"}
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_faults(rows):
    """(role, text, fault) in order of rows (turn, role, text)."""
    out, seen = [], set()
    for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        words = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain_repair(rows, costs):
    """Every edit of every row, with up to two insertions before each and at the end."""
    best = None
    gaps = ["", "I", "II"]
    for edits in itertools.product("DKR", repeat=len(rows)):
        if any(e != "D" and f in ("blank", "duplicate") for e, (_, _, f) in zip(edits, rows)):
            continue
        cost = sum({"D": costs.delete, "K": 0, "R": costs.rerole}[e] + costs.truncated * (e != "D" and f == "truncated") for e, (_, _, f) in zip(edits, rows))
        if best is not None and cost > best[0]:
            continue
        for holes in itertools.product(gaps, repeat=len(rows) + 1):
            total = cost + costs.insert * sum(map(len, holes))
            if best is not None and total > best[0]:
                continue
            audit = "".join(h + e for h, e in zip(holes, [*edits, ""]))
            if best is not None and (total, audit) >= best[:2]:
                continue
            options = []
            for hole, edit, row in itertools.zip_longest(holes, edits, rows):
                options += [[("user", ""), ("assistant", "")]] * len(hole)
                if edit == "K":
                    options.append([row[:2]])
                elif edit == "R":
                    options.append([("user", row[1]), ("assistant", row[1])])
            for lines in itertools.product(*options):
                if SOUND.fullmatch("".join(r[:1] or "?" for r, _ in lines)):
                    best = (total, audit, "\n".join(f"{r}:{t}" for r, t in lines))
    return best


def drawn(n, draw):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "admin"]
    texts = ["Yes.", "No!", "cut", "  ", "", "Why? \n", "Yes."]
    return [(draw.choice([None, 0, 1, 2, 3]), draw.choice(roles), draw.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("segment", [1, 2, 1000])
@pytest.mark.parametrize("costs", [cr.Costs(), cr.Costs(1, 2, 1, 2), cr.Costs(3, 3, 1, 0)])
def test_equals_enumeration(spark, monkeypatch, segment, costs):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    draw = random.Random(segment)
    chats = {i: drawn(draw.randrange(1, 6), draw) for i in range(60)}
    chats[None] = drawn(3, draw)
    df = spark.createDataFrame([(c, *r) for c, rows in chats.items() for r in rows], SCHEMA)
    faults = cr.with_faults(df)
    got = {r["conv_id"]: r for r in cr.repair(faults, costs)[0].collect()}
    assert set(got) == set(chats)
    for conv, rows in chats.items():
        plain = plain_faults(rows)
        cost, audit, text = plain_repair(plain, costs)
        initials = [r[0][:1] for r in plain]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        found = got[conv]
        assert (found["cost"], found["audit"], found["illegal"]) == (cost, audit, illegal), (rows, costs)
        assert found["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_divide_and_conquer_equals_whole_tables():
    """Long random conversations against a plain table of (cost, audit) by row and state."""
    draw = random.Random(8)
    for n, costs in itertools.product((1, 2, 7, 64, 301), (cr.Costs(), cr.Costs(2, 2, 1, 1))):
        moves = [cr.row_moves(draw.choice("ssuuaa?") + draw.choice("   bdt"), costs) for _ in range(n)] + [cr.row_moves("", costs)]
        best = {cr.START: (0, "")}
        for m in moves:
            ahead: dict = {}
            for q, (cost, audit) in best.items():
                for to, way in enumerate(m[q]):
                    if way is not None:
                        found = (cost + way[0], audit + way[1])
                        ahead[to] = min(ahead.get(to, found), found)
            best = ahead
        last = min(best, key=best.get)
        assert "".join(cr.audit_pieces(moves, cr.START, last)) == best[last][1]
        half = n // 2
        steps = [cr.step_of(m) for m in moves]
        whole = cr.segment_step(steps)
        joined = cr.segment_step([cr.segment_step(steps[:half]), cr.segment_step(steps[half:])])
        assert whole == joined


def test_a_conversation_longer_than_a_segment(spark, monkeypatch):
    rows = [(7, i, "user" if i % 2 else "assistant", f"word {i}.") for i in range(5_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    once = cr.repair(cr.with_faults(df))[0].collect()
    assert once[0]["cost"] == 4 and once[0]["audit"] == "D" + "K" * 4998 + "D"
    text = "\n".join(f"{r[2]}:{r[3]}" for r in rows[1:-1])
    assert once[0]["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_texts_and_extra_columns(spark):
    rows = [(1, 0, "user", "x" * 300_000 + ".", 5, 6, 7), (1, 1, "tool", "ok.", 5, 6, 7), (2, None, None, None, 5, 6, 7)]
    df = spark.createDataFrame(rows, SCHEMA + ", n int, fault int, _conv int")
    faults = cr.with_faults(df)
    whole, segments = cr.repair(faults)
    turns = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in cr.repaired_texts(faults, segments).collect()}
    assert turns == {1: [("user", "x" * 300_000 + "."), ("assistant", "ok.")], 2: []}
    assert {r["conv_id"]: r["audit"] for r in whole.collect()} == {1: "KR", 2: "D"}
    empty = cr.with_faults(df.limit(0))
    assert cr.repair(empty)[0].count() == 0


def test_query_on_odd_conversations(spark, tmp_path, duck_docs):
    import duckdb

    draw = random.Random(4)
    rows = [(draw.choice([None, *range(40)]), *r) for r in drawn(400, draw)]
    rows += [(5, 9, None, None), (5, 9, None, "x."), (6, None, "user", "same."), (6, None, "user", "same.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"audit": F.lit(1), "first": F.lit(2)})
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert compare.difference(op11.run(spark, str(tmp_path)), con, op11.SQL) is None


def test_nothing_left(spark, tmp_path):
    import zlib

    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    empty = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in op11.run(spark, str(tmp_path)).collect()] == [(gone, 0, 0, 0, 0, 0, 0, "", empty)]
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(str(tmp_path / "conversations.parquet"))
    assert op11.run(spark, str(tmp_path)).count() == 0


def test_matches_twin(spark, duck_docs):
    assert compare.difference(op11.run(spark, SF_DIR), duck_docs, op11.SQL) is None
