"""What lies on the disks while a report runs: shuffles go with the step that needed them, reduced rows do not move again."""

from __future__ import annotations

import time
from hashlib import md5

from pyspark.sql import functions as F

from tests.conftest import SF_DIR
from tradeops.operators import grouping, recon
from tradeops.operators.orders import collapse_by_primary
from tradeops.operators.ranking import numbers_by_group
from tradeops.plans import intercompany, po_lines
from tradeops.sources import staging
from tradeops.sources.staging import SHUFFLES_GO, staged
from tradeops.workload.base import inputs


def shuffles(spark) -> set:
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def test_a_stage_leaves_no_shuffle_behind(spark):
    before, given = shuffles(spark), spark.conf.get(SHUFFLES_GO, None)
    out = staged(spark.range(5000).groupBy((F.col("id") % 97).alias("k")).count().repartition(3), "counted")
    end = time.time() + 20
    while shuffles(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffles(spark) - before
    assert out.count() == 97 and out.agg(F.sum("count")).first()[0] == 5000
    assert spark.conf.get(SHUFFLES_GO, None) == given


def test_columns_of_a_key_meet_the_collapsed_rows_where_they_lie(spark):
    df = staged(spark.createDataFrame([(k, "a", d, 10 * k + d) for k in (1, 2) for d in (2, 1)], "k int, po string, d int, id int"), "led")
    side = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, word string").groupBy(F.struct("k").alias("__key")).agg(F.max("word").alias("word"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        alone = collapse_by_primary(df, "k", "po", ["d"], ["id"], {}, ["po"], "others")
        both = collapse_by_primary(df, "k", "po", ["d"], ["id"], {}, ["po"], "others", about=[side])
        plans = [x._jdf.queryExecution().executedPlan().toString().count("Exchange hash") for x in (alone, both)]
        got = sorted((r.k, r.id, r.word) for r in both.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == [(1, 11, "y"), (2, 21, None)]
    assert plans[1] == plans[0] + 1  # the side's own


def test_rows_of_an_order_move_once_for_its_dates_and_numbers(spark):
    data = [(po, i, u) for po, n in (("a", 3), (None, 2), ("b", 1)) for i in range(n) for u in (1, None)]
    df = spark.createDataFrame(
        [(po, i, u, f"1998-0{1 + i}-0{u or 2}") for po, i, u in data], "_po_no_ekporef string, __line int, _freight_unit_id int, day string"
    ).withColumns({c: F.col("day").cast("date") for c in ("_eta", "_eta_simple", "_eta_wakeo")})
    df = df.withColumns({"_arrival_date": F.lit(None).cast("date"), **{c: F.lit("x") for c in (
        "purchase_order_company_id", "_shipped", "_shipment_serial_iss_job", "_supplier_lead_time", "__unit_row", "_fo_serial")}})
    df = staged(df, "tracked")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = po_lines.with_line_ids(po_lines._with_order_delivery(df, F.lit("1998-09-02").cast("date")))
        assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 2  # the rows, and the orders' totals
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {(r._po_no_ekporef, str(r._first_edd_po), str(r._current_edd_po)) for r in rows} == {
        ("a", "1998-01-04", "1998-03-05"), (None, "1998-01-04", "1998-02-05"), ("b", "1998-01-04", "1998-01-05")}
    ids = {(r._po_no_ekporef, r["__line"], r._freight_unit_id): r._line_id for r in rows}
    assert len(ids) == len(rows) == len(data)
    ranked = {k: 1 + sum(o[0] == k[0] and (o[1], o[2] or 9) < (k[1], k[2] or 9) for o in data) for k in data if k[0]}
    assert all(ids[k] == md5(f"{k[0]}-{k[1]}-fo shipped-x-{n}".encode()).hexdigest() for k, n in ranked.items())


def test_groups_named_by_a_struct_are_numbered(spark):
    df = spark.createDataFrame([(k, i) for k, n in ((None, 9), ("a", 30), ("b", 3)) for i in range(n)], "k string, i int")
    df = staged(df.withColumn("group", F.struct("k")), "groups")
    for crowd in (5, 100):
        got = numbers_by_group(df, ["group"], ["i"], "n", crowd=crowd).collect()
        assert len(got) == 42 and all(r.n == r.i + 1 for r in got)


def test_documents_are_merged_once_with_sides_without_hot_keys(spark, monkeypatch):
    left = [(k, s) for k in (1, 2, 3, None) for s in ("m", "a", None)]
    left = staged(spark.createDataFrame(left, "k int, src string"), "left")
    right = staged(spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "r int, v string"), "right")
    want = lambda df: sorted(map(tuple, df.collect()), key=str)
    for only, cond in ((None, F.lit(True)), (F.col("src") == "m", F.col("src") == "m")):
        expected = want(left.join(right, (F.col("k") == F.col("r")) & cond, "left"))
        for crowd in (100, 1):
            monkeypatch.setattr(grouping, "CROWD", crowd)
            got = grouping.spread_left_join(left, right, [("k", "r")], only)
            assert want(got) == expected
            assert ("LeftAnti" in got._jdf.queryExecution().optimizedPlan().toString()) == (crowd == 1)


def test_both_ledgers_share_their_links(spark, monkeypatch):
    labels, write = [], staging.staged
    for module in (recon, intercompany):
        monkeypatch.setattr(module, "staged", lambda df, label: labels.append(label) or write(df, label))
    out = intercompany.ic_both_sides(inputs(spark, SF_DIR))
    assert labels.count("met-links") == labels.count("links") == 1
    assert labels.count("settled-documents") == 2 and "matched-documents" not in labels
    assert out.columns[-1] == "_side" and {r[0] for r in out.select("_side").distinct().collect()} == {"PAYABLES", "RECEIVABLES"}
