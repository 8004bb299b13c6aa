"""What moves between tasks: keys and columns that are used, no long texts, no rows that an earlier step could reduce."""

import re

from pyspark.sql import functions as F

from tradeops.operators.freight import resolve_payload
from tradeops.operators.grouping import fanout_left_join
from tradeops.operators.orders import collapse_by_primary, number_lines
from tradeops.operators.ranking import numbers_by_group
from tradeops.operators.recon import RECEIVABLES, credit_note_match, document_ledger, document_links, with_document_ids
from tradeops.sources.staging import staged, stages


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def shuffled(spark, df) -> str:
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_payload_texts_are_read_before_the_join(spark):
    enrich = staged(
        spark.createDataFrame(
            [("U1", "d1", "d9", '{"id":"1"}', '{"id":"2"}'), ("U2", "d2", "d1", None, '{"id":"4"}'), ("U3", "d1", "d1", '{"id":"5"}', '{"id":"6"}')],
            "unit_no string, iss_domain string, remote_iss_domain string, shipment_response string, remote_shipment_response string",
        ),
        "enrich",
    )
    units = spark.createDataFrame([("U1", "d1"), ("U2", "d2"), ("U3", "d1"), ("U4", "d1"), ("U5", None)], "unit string, dom string")
    domains = spark.createDataFrame([("d1",), ("d1",), ("d2",), (None,)], "dom string")
    read = lambda arms: arms.withColumn("id", F.get_json_object("_payload", "$.id")).drop("_payload")
    got = resolve_payload(units, enrich, "unit", "dom", domains=domains, read=read)
    expected = resolve_payload(units, enrich, "unit", "dom").withColumn("id", F.get_json_object("_payload", "$.id")).drop("_payload")
    assert rows(got) == rows(expected) == [("U1", "d1", "1"), ("U2", "d2", None), ("U3", "d1", "5"), ("U3", "d1", "6"), ("U4", "d1", None), ("U5", None, None)]


def test_collapse_does_not_sort_wide_rows_by_key_and_split(spark):
    data = [(None, "a", 2, 7, "x"), (None, None, 1, 5, None), (1, "a", 1, 1, "x"), (1, "a", 2, 9, "y"), (1, "b", None, 3, "x"), (2, None, None, None, None)]
    df = spark.createDataFrame(data, "k int, po string, d int, id int, note string").withColumn("first", F.col("po"))
    got = collapse_by_primary(df, "k", "po", ["d", "id"], ["first", "d"], {"top": F.max("id"), "word": F.max("note")}, ["note"], "others")
    # Of rows by (key, split) only their number is kept, not the columns of a possible first row.
    assert not re.search(r"keys=\[k#\d+, po#\d+\]", plan(got))
    assert rows(got) == sorted(
        [(None, None, 1, 7, "x", "x", "a"), (1, "a", 1, 9, "y", "x | y", "a | b"), (2, None, None, None, None, None, None)], key=str
    )


def test_lines_are_numbered_without_their_other_columns(spark):
    lines = staged(spark.createDataFrame([("p", 3, "c"), ("p", 1, "a"), ("p", 1, "a"), (None, 2, "b"), (None, 1, "d"), ("q", None, "e")], "po_no string, id int, text string"), "lines")
    got = number_lines(lines)
    assert "text" not in plan(got.select("po_no", "_line_no"))
    assert rows(got.select("po_no", "id", "_line_no")) == sorted(
        [("p", 1, 1), ("p", 1, 2), ("p", 3, 3), (None, 1, 1), (None, 2, 2), ("q", None, 1)], key=str
    )


def test_crowded_groups_are_numbered_over_ranges(spark):
    df = staged(spark.createDataFrame([(k, i) for k, n in ((None, 9), ("a", 30), ("b", 3)) for i in range(n)], "k string, i int"), "groups")
    expected = sorted([(r.k, r.i, r.i + 1) for r in df.collect()], key=str)
    assert rows(numbers_by_group(df, ["k"], ["i"], "n", crowd=5)) == rows(numbers_by_group(df, ["k"], ["i"], "n")) == expected
    with stages(spark, write=False) as scope:
        numbers_by_group(df, ["k"], ["i"], "n").explain()
    assert scope.paths == []


def test_both_halves_of_a_fanout_share_a_shuffle(spark):
    left = staged(spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c"), (3, "d")], "k int, c string"), "left")
    right = staged(spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "r int, v string"), "right")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = fanout_left_join(left, right, [("k", "r")])
        assert "ReusedExchange" in plan(got)
        assert rows(got) == rows(left.join(right, F.col("k") == F.col("r"), "left"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_links_of_both_kinds_meet_before_the_documents(spark):
    docs = spark.createDataFrame(
        [("i1", "d1"), ("i2", "d1"), ("i3", "d1"), ("i4", "d1"), (None, "d1"), ("i1", None)], "_invoice string, _iss_domain string"
    )
    invoices = spark.createDataFrame([(1, "i1", "d1"), (2, "i2", "d1"), (3, "i2", "d1"), (9, "i1", None)], "id int, serial_no string, iss_domain string")
    notes = spark.createDataFrame([(4, "i2", "d1"), (5, "i2", "d1"), (6, "i3", "d1"), (7, "i3", None)], "id int, serial_no string, iss_domain string")
    files = spark.createDataFrame(
        [(8, 1, "IssuedInvoice", True, "d1"), (9, 1, "IssuedInvoice", True, "d1"), (10, 6, "IssuedInvoice", True, "d1")],
        "id int, parent_id int, parent_type string, shared_with_customer boolean, iss_domain string",
    )
    got = document_links(docs, invoices, notes, files)
    assert shuffled(spark, got).count("_invoice") and "__cn_serial" not in shuffled(spark, got)
    found = sorted([(r._invoice, r._iss_domain, r._url and r._url[-1], r._url_vault and r._url_vault.rsplit("/")[-1]) for r in got.collect()], key=str)
    assert found == sorted(
        [("i1", "d1", "8", "inv1"), ("i1", "d1", "9", "inv1"), *[("i2", "d1", None, "inv2")] * 2, *[("i2", "d1", None, "inv3")] * 2,
         ("i3", "d1", None, "icn6"), ("i4", "d1", None, None), (None, "d1", None, None), ("i1", None, None, None)], key=str,
    )


def test_document_ids_hang_on_published_columns(spark):
    txns = spark.createDataFrame(
        [("E1", "E2", "E2-CN-1", "V1", None, None, "Customer", 1.0, "AED", 0.0, "V1"), ("E1", "E2", None, "V1", None, None, "Customer", 1.0, "AED", 0.0, None),
         ("E1", "E2", "I9", "V1", None, None, "Customer", 1.0, "AED", 0.0, None)],
        "customer_account string, company string, invoice string, voucher string, voucher_date date, posted_date date, transaction_type string, "
        "amount double, currency string, settled_amount double, last_settlement_voucher string",
    )
    ledger = document_ledger(txns, spark.createDataFrame([("E2", "d1")], "company string, iss_domain string"), RECEIVABLES)
    narrow = ledger.drop("_inv_id", "md5")
    assert rows(with_document_ids(narrow).select(ledger.columns)) == rows(ledger)
    matched = credit_note_match(staged(narrow, "docs"), txns, RECEIVABLES)
    assert "_inv_id" not in matched.columns and matched.count() == 3
