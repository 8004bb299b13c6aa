from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest

from tests.conftest import SF_DIR
from tradeops.llm import jaccard_join, op10
from tradeops.llm.components import components

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, size, threshold):
    """[(doc_id, n, component)] by comparing all sets that share a shingle."""
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    where = defaultdict(list)
    for i, s in enumerate(sets):
        seen = defaultdict(int)
        for x in s:
            for j in where[x]:
                seen[j] += 1
            where[x].append(i)
        for j, common in seen.items():
            if 100 * common >= threshold * (len(s) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, len(s), least.get(root(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=repr)


def run(spark, rows, size, threshold):
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, n int")
    return sorted((tuple(r) for r in jaccard_join.near_duplicates(df, size, threshold).collect()), key=repr)


def family(rng, words, copies, edits):
    base = [rng.choice(words) for _ in range(rng.randint(20, 120))]
    for _ in range(copies):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(w))
            w[at : at + rng.randint(0, 1)] = [rng.choice(words)]
        yield " ".join(w)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(150)]
    passage = " ".join(rng.choice(words) for _ in range(25))
    texts = [None, "", " \t\n", "one", "One", "one two", "one  two", "\x1cone two", "É one two", "é one two"]
    for _ in range(12):
        texts += family(rng, words, rng.choice([1, 2, 3, 25]), 5)
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(3, 60))) + " " + passage for _ in range(40)]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)] + [(3, "repeated id"), (None, "no id at all"), (None, "one two")]


@pytest.mark.parametrize(("seed", "size", "threshold", "block"), [(1, 3, 90, 1000), (3, 2, 70, 4)])
def test_against_brute_force(spark, monkeypatch, seed, size, threshold, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)  # recursion and blocks on small data
    rows = corpus(seed)
    assert run(spark, rows, size, threshold) == brute(rows, size, threshold)


@pytest.mark.parametrize(("turns", "radius"), [(1, 0.02), (2, 0.6)])
def test_rings_and_balls(spark, monkeypatch, turns, radius):
    monkeypatch.setattr(jaccard_join, "TURNS", turns)
    monkeypatch.setattr(jaccard_join, "RADIUS", radius)
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 6)
    rows = corpus(4)
    assert run(spark, rows, 3, 80) == brute(rows, 3, 80)


def test_sets_are_built_where_partners_are(spark, monkeypatch):
    """Loose versions of one text share balls, but few of them can link: the others' whole sets are never built."""
    rng = random.Random(31)
    base, rows = [f"w{rng.randrange(10**6)}" for _ in range(100)], []
    for i in range(40):
        w = list(base)
        for at in rng.sample(range(100), 3):
            w[at] = f"v{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows.append((50, rows[20][1] + " end"))
    built, whole = [], jaccard_join._sets

    def counted(docs, classes, size, ranks):
        built.append(classes.count())
        return whole(docs, classes, size, ranks)

    monkeypatch.setattr(jaccard_join, "_sets", counted)
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)
    assert sum(built) <= 20


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert sorted((tuple(r) for r in op10.run(spark, SF_DIR).collect()), key=repr) == brute(rows, 3, 90)


def test_empty(spark):
    assert run(spark, [], 3, 90) == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}


def test_components_settle_in_few_rounds(spark, monkeypatch):
    from tradeops.llm import components as module

    written, staged = [], module.staged
    monkeypatch.setattr(module, "staged", lambda df, label: written.append(label) or staged(df, label))
    ids = list(range(5000))
    random.Random(6).shuffle(ids)
    edges = spark.createDataFrame(list(zip(ids, ids[1:])), "a long, b long")
    got = components(edges)
    assert got.count() == 5000 and [tuple(r) for r in got.select("component").distinct().collect()] == [(0,)]
    assert len(written) < 30


def test_chain_of_versions(spark):
    """Each document is the one before, moved on by two words."""
    rng = random.Random(12)
    words = [f"w{rng.randrange(10**6)}" for _ in range(60 + 2 * 600)]
    ids = list(range(600))
    rng.shuffle(ids)
    rows = [(i, " ".join(words[2 * k : 2 * k + 60])) for k, i in enumerate(ids)]
    got = run(spark, rows, 3, 90)
    assert got == brute(rows, 3, 90)
    assert {component for _, _, component in got} == {0}


def test_pairs_left_in_rings_are_not_listed(spark, monkeypatch):
    """Loose versions of one text, each with many close copies: more families than pivots, and no row for every pair of copies."""
    monkeypatch.setattr(jaccard_join, "TURNS", 1)
    rng = random.Random(41)
    base, rows = [f"w{rng.randrange(10**6)}" for _ in range(100)], []
    for _ in range(4):
        version = list(base)
        for at in rng.sample(range(5, 95), 3):
            version[at] = f"v{rng.randrange(10**6)}"
        for _ in range(40):
            w = list(version)
            w[rng.randrange(100)] = f"u{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w)))
    written, staged = [], jaccard_join.staged

    def counted(df, label):
        out = staged(df, label)
        if label in ("pairs", "links"):
            written.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "staged", counted)
    assert run(spark, rows, 5, 80) == brute(rows, 5, 80)
    assert max(written) <= 3 * len(rows)
