"""Merkle manifests against a plain one built in memory, and their SQL twin."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from pyspark.sql import functions as F
from tests.conftest import SF_DIR
from tradeops.llm import op12
from tradeops.llm.merkle import fold, manifest, proof_digest
from tradeops.workload import compare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves: list[str], arity: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """(root, for each leaf its steps (before, after))."""
    steps, at, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            run = nodes[i - i % arity : i - i % arity + arity]
            steps[leaf].append(("".join(run[: i % arity]), "".join(run[i % arity + 1 :])))
        nodes = [h(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
        at = [i // arity for i in at]
    return nodes[0], steps


def plain_manifest(rows: list[tuple], arity: int) -> list[tuple]:
    """(tree, order, leaf) to (tree, order, leaf, subroot, root, folded, proof)."""
    trees: dict = {}
    for row in rows:
        trees.setdefault(row[0], []).append(row)
    keys = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    built = {}
    for k in keys:
        trees[k].sort(key=lambda r: (r[1] is None, r[1] or 0, r[2]))
        built[k] = plain_tree([r[2] for r in trees[k]], arity)
    root, higher = plain_tree([built[k][0] for k in keys], arity) if keys else (None, [])
    out = []
    for k, above in zip(keys, higher):
        for row, steps in zip(trees[k], built[k][1]):
            own = row[2]
            for before, after in steps + above:
                own = h(before, own, after)
            out.append((*row, built[k][0], root, own, h(*[b + a for b, a in steps + above])))
    return sorted(out, key=repr)


def found(spark, rows, arity):
    df = spark.createDataFrame(rows, "tree string, at long, leaf string")
    out = manifest(df, "tree", "at", "leaf", arity)
    out = out.select("tree", "at", "leaf", "subroot", "root", fold(F.col("leaf"), F.col("steps")), proof_digest(F.col("steps")))
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("arity", [2, 3, 4])
def test_every_proof_equals_a_plain_tree(spark, arity):
    sizes = {"b": 11, "a": 1, None: 2, "é": 5, "z": 3}
    rows = [(k, i * 7 % n, h(str(k), str(i))) for k, n in sizes.items() for i in range(n)]
    got = found(spark, rows, arity)
    assert got == plain_manifest(rows, arity)
    assert all(r[4] == r[5] for r in got)


def test_ties_nulls_and_repeated_rows(spark):
    rows = [("a", None, h("x")), ("a", None, h("x")), ("a", 1, h("y")), ("a", 1, h("b")), ("a", 0, h("c")), (None, None, h("d"))]
    assert found(spark, rows, 2) == plain_manifest(rows, 2)


def test_one_leaf_and_none(spark):
    assert found(spark, [("a", 1, h("x"))], 2) == [("a", 1, h("x"), h("x"), h("x"), h("x"), h())]
    assert found(spark, [], 2) == []


def test_clashing_columns_pass_through(spark):
    rows = [(str(i % 2), i, h(str(i)), f"keep {i}", "w", "n") for i in range(5)]
    df = spark.createDataFrame(rows, "tree string, at long, leaf string, _i string, _tree string, `_n.x` string")
    out = manifest(df, "tree", "at", "leaf")
    assert out.columns == [*df.columns, "subroot", "root", "steps"]
    assert sorted(r["_i"] for r in out.collect()) == sorted(r[3] for r in rows)
    with pytest.raises(ValueError):
        manifest(df.withColumnRenamed("_i", "root"), "tree", "at", "leaf")


def test_query_on_odd_documents(spark, tmp_path):
    rows = [
        (0, "zero", "en", "web", 4),
        (1, None, "en", None, None),
        (None, "", None, "web", 0),
        (2, "ä €" * 50_000, "de", "web", 150_000),
        (2, "ä €" * 50_000, "de", "web", 150_000),
        (14, "x", None, None, 2**63 - 1),
        *[(i, f"text {i}", "fr", "s", i) for i in range(20, 60)],
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"leaf": F.lit("?"), "steps": F.lit(1), "_i": F.lit(2)})
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = op12.run(spark, str(tmp_path)).collect()

    def digest(doc_id, text, lang, source, n_chars):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])

    plain = plain_manifest([(r[2], r[0], digest(*r)) for r in rows], 2)
    assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in got), key=repr) == sorted(
        ((p[1], p[2], p[3], p[4], p[6]) for p in plain), key=repr
    )
    for r in got:
        changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["doc_id"] != 1
        assert r["verified"] is (not changed) and (r["folded_root"] == r["root"]) is (not changed)
    assert not all(r["verified"] for r in got)


def test_matches_twin(spark, duck_docs):
    assert compare.difference(op12.run(spark, SF_DIR), duck_docs, op12.SQL) is None
