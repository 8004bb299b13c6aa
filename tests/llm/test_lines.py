from __future__ import annotations

import hashlib
import random

from tests.conftest import SF_DIR
from tradeops.llm import line_dedup, op9, op9_runs
from tradeops.workload import compare


def brute(rows):
    """{(doc_id, text): (text, removed)} by the same boundaries, comparing texts."""

    def cut(text):
        lines, out, now, last = text.split("\n"), [], [], 0
        for i, line in enumerate(lines):
            h = int(hashlib.md5(line.encode()).hexdigest()[:7], 16)
            now.append(line)
            if i == len(lines) - 1 or (last * line_dedup.BASE + h) % line_dedup.MODULUS % line_dedup.DIVISOR == 0:
                out.append(now)
                now = []
            last = h
        return out

    rank = lambda r: (r[0] is not None, r[0] or 0)
    first = {}
    rows = sorted({r for r in rows if r[1] is not None}, key=rank)
    out = {}
    for doc, text in rows:
        kept, gone = [], 0
        for at, chunk in enumerate(cut(text)):
            body = "\n".join(chunk)
            if len(chunk) > 1 and first.setdefault(body, (doc, at)) != (doc, at):
                gone += len(chunk)
            else:
                kept.append(body)
        out[doc, text] = ("\n".join(kept), gone)
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    passage = [f"shared line {i}" for i in range(30)]
    rows = [(i, "\n".join([f"own {rng.random()}" for _ in range(rng.randint(0, 6))] + passage[rng.randint(0, 9) :] + [f"x {rng.random()}"])) for i in range(30)]
    rows += [(100, ""), (101, None), (102, "\n\n\n"), (103, "\n\n\n"), (104, "one line"), (105, "one line"), (106, "\n".join(passage * 3))]
    rows += [(107, "\n".join(passage)), (107, "\n".join(passage)), (None, "\n".join(passage)), (108, "\n".join(f"l{i}" for i in range(20_000)))]
    df = spark.createDataFrame([(d, t, "k", 9) for d, t in rows], "doc_id long, text string, lines string, at int")
    got = line_dedup.dedup_lines(df).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    assert sum(r["removed_lines"] for r in got) > 300
    after = sorted((repr((r["doc_id"], r["text"], r["removed_lines"], r["lines"], r["at"])) for r in got))
    assert after == sorted(repr((d, *(want[d, t] if t is not None else (None, 0)), "k", 9)) for d, t in rows)


def test_boundaries_follow_content(spark):
    lines = [f"line {i * i}" for i in range(200)]
    rows = [(1, "\n".join(lines)), (2, "\n".join(["new"] + lines[:90] + lines[91:]))]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["removed_lines"] == 0 and got[1]["text"] == rows[0][1]
    assert got[2]["removed_lines"] > 120


def test_matches_twin(spark, duck_docs):
    assert compare.difference(op9.run(spark, SF_DIR), duck_docs, op9.SQL) is None


def test_empty(spark):
    df = line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string, x int"))
    assert df.collect() == [] and df.columns == ["doc_id", "text", "x", "removed_lines"]


def runs_brute(rows):
    """{(doc_id, text): (text, removed)}: lines go that are in a pair of neighbours of an earlier place."""
    first, out = {}, {}
    for doc, text in sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - 1):
            if first.setdefault((lines[i], lines[i + 1]), (doc, i)) != (doc, i):
                gone |= {i, i + 1}
        out[doc, text] = ("\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone))
    return out


def test_runs_go_whole(spark):
    rng = random.Random(4)
    passage = [f"shared line {i}" for i in range(12)]
    rows, planted = [(0, "\n".join(passage))], 0
    for i in range(1, 40):
        at, n = rng.randint(0, 6), rng.randint(2, 6)
        rows.append((i, "\n".join([f"own {rng.random()}", *passage[at : at + n], f"end {rng.random()}"])))
        planted += n
    rows += [(100, ""), (101, None), (102, "\n\n\n"), (103, "one line"), (104, "one line"), (None, "\n".join(passage[:3])), (105, "a\nb"), (105, "a\nb")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.dedup_runs(df).collect()
    want = runs_brute(rows)
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr((d, *(want[d, t] if t is not None else (None, 0)))) for d, t in rows)
    assert sum(r["removed_lines"] for r in got if r["doc_id"] in range(1, 40)) == planted
    assert sum(r["removed_lines"] for r in line_dedup.dedup_lines(df).collect() if r["doc_id"] in range(1, 40)) < planted


def test_runs_match_twin(spark, duck_docs):
    assert compare.difference(op9_runs.run(spark, SF_DIR), duck_docs, op9_runs.SQL) is None
