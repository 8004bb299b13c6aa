"""Group, rank, day-grain and access operators against brute force, with hot keys."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tradeops.operators.access import any_of_join, apply_entitlements, codes_of, grants, observed_pairs, rows_seen, viewers, visible_to
from tradeops.operators.daygrain import as_of_join, previous_day, trailing_max
from tradeops.operators.grouping import attach_totals, fanout_left_join, in_any, lookup_table, text_list
from tradeops.operators.orders import collapse_by_primary, order_list_rows
from tradeops.operators.ranking import dense_ids, list_rows, list_text, row_numbers, running_totals
from tradeops.sources.staging import staged


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def hot(n, seed=1):
    """Rows of which a third share one key; some keys are NULL."""
    rnd = random.Random(seed)
    keys = [None, "a", "b", "c", "d"]
    return [(i, "hot" if i % 3 == 0 else rnd.choice(keys), rnd.randrange(40)) for i in range(n)]


def test_attach_totals_equals_window(spark):
    df = spark.createDataFrame(hot(300), "id long, k string, v long")
    got = attach_totals(df, ["k"], {"n": F.count("*"), "s": F.sum("v")})
    w = Window.partitionBy("k")
    want = df.withColumns({"n": F.count("*").over(w), "s": F.sum("v").over(w)})
    assert rows(got.select("id", "k", "v", "n", "s")) == rows(want)


@pytest.mark.parametrize("width", [1, 7])
def test_row_numbers_equal_window(spark, width):
    data = hot(400, seed=width)
    df = spark.createDataFrame(data, "id long, k string, v long")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    got = row_numbers(df, ["k"], ["v", "id"], "n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).cast("long"))
    assert rows(got.select("id", "k", "v", "n")) == rows(want)
    spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_row_numbers_put_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("a", 5), ("a", 2)], "k string, id long")
    assert {(r.id, r.n) for r in row_numbers(df, ["k"], ["id"], "n").collect()} == {(2, 1), (5, 2), (None, 3)}


def test_row_numbers_spread_a_hot_group(spark):
    seen = []

    def stage(df, label):
        seen.append(staged(df, label))
        return seen[-1]

    df = spark.range(4000).select("id", F.lit("one order").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = row_numbers(df, ["k"], ["id"], "n", stage)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in seen[0].groupBy("__range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000
    assert got.where(F.col("n") != F.col("id") + 1).count() == 0
    ids = dense_ids(df.select(F.col("id").cast("string").alias("k")), "k", "n")
    assert "SinglePartition" not in ids._jdf.queryExecution().toString()


def test_dense_ids_follow_name_order(spark):
    names = ["SELLER_" + str(i) for i in range(60)] * 3 + ["AB", "A", "ABC"]
    got = dense_ids(spark.createDataFrame([(n,) for n in names], "k string"), "k", "id")
    assert [r.k for r in got.orderBy("id").collect()] == sorted(set(names))
    assert sorted(r.id for r in got.collect()) == list(range(1, len(set(names)) + 1))


DAY = dt.date(2023, 6, 30)


def test_previous_day_equals_lag(spark):
    rnd = random.Random(3)
    data = [(i, "hot" if i % 3 else None, None if i % 11 == 0 else DAY + dt.timedelta(days=rnd.randrange(30))) for i in range(200)]
    df = spark.createDataFrame(data, "id long, k string, d date")
    got = previous_day(df, ["k"], "d", "id", "p")
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_last(), "id")
    assert rows(got.select("id", "k", "d", "p")) == rows(df.withColumn("p", F.lag("d").over(w)))


def test_trailing_max_counts_calendar_months(spark):
    data = [("a", DAY, 1), ("a", dt.date(2024, 6, 30), 0), ("a", dt.date(2024, 7, 1), 0), ("a", None, 0)]
    got = trailing_max(spark.createDataFrame(data, "k string, d date, v int"), ["k"], "d", "v", 12, "m")
    assert {r.d: r.m for r in got.collect()} == {DAY: 1, dt.date(2024, 6, 30): 1, dt.date(2024, 7, 1): 0, None: 0}


def test_as_of_join_equals_interval_scan(spark):
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    log = [(rnd.choice("xyz"), base + dt.timedelta(hours=rnd.randrange(400)), f"m{i}") for i in range(60)]
    log += [("x", base + dt.timedelta(days=3), "tie")]
    facts = [(i, rnd.choice("xyzw"), base + dt.timedelta(hours=rnd.randrange(500))) for i in range(150)]
    got = as_of_join(
        spark.createDataFrame(facts, "id long, k string, t timestamp"),
        spark.createDataFrame(log, "who string, at timestamp, manager string"), "k", "t", "who", "at", "manager",
    )
    by_key = defaultdict(list)
    for who, at, m in log:
        by_key[who].append((at, m))
    want = {}
    for i, k, t in facts:
        spans = sorted(by_key[k])
        ends = [s[0] for s in spans[1:]] + [None]
        midnight = t.replace(hour=0, minute=0, second=0)
        hits = [m for (at, m), end in zip(spans, ends) if midnight >= at and (end is None or t < end)]
        assert len(hits) <= 1
        want[i] = hits[0] if hits else None
    assert {r.id: r.manager for r in got.collect()} == want


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("abcde"), st.sampled_from("abcde")), max_size=20),
    st.lists(st.sampled_from("abxy"), max_size=8),
)
def test_any_of_join_equals_or(spark, pairs, keys):
    left = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "id long, a string, b string")
    right = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "r long, key string")
    got = rows(any_of_join(left, ["a", "b"], right, "key").select("id", "r"))
    want = sorted(((i, r) for i, (a, b) in enumerate(pairs) for r, k in enumerate(keys) if k in (a, b)), key=repr)
    assert got == want


def test_observed_pairs_go_both_ways(spark):
    docs = spark.createDataFrame([("A", "B"), ("A", "B"), ("C", "C"), ("A", "TOOLONG"), (None, "A")], "x string, y string")
    assert rows(observed_pairs([(docs, "x", "y", 5)])) == [("A", "B", "A|B|B|A"), ("B", "A", "B|A|A|B"), ("C", "C", "C|C|C|C")]


def test_grants_and_viewers(spark):
    pairs = spark.createDataFrame([("A", "B"), ("B", "B"), ("C", "D")], "a string, b string")
    local = spark.createDataFrame([("u", "A"), ("u", "A"), ("v", "B")], "who string, office string")
    granted = grants(local, spark.createDataFrame([("boss",)], "who string"), "office")
    assert rows(granted) == [("boss", "*"), ("u", "A"), ("u", "A"), ("v", "B")]
    assert rows(viewers(pairs, ["a", "b"], granted, "office")) == [("A", "B", 4), ("B", "B", 2), ("C", "D", 1)]
    assert rows(viewers(pairs, ["a", "b"], local, "office")) == [("A", "B", 3), ("B", "B", 1), ("C", "D", 0)]
    plan = viewers(pairs, ["a", "b"], granted, "office")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_codes_and_entitlements(spark):
    one = spark.createDataFrame([("A",), ("B",), ("TOOLONG",)], "c string")
    assert rows(codes_of([(one, "c", 5), (one, "c", 5)], "n")) == [("A",), ("B",)]
    facts = spark.createDataFrame([(1, "x"), (2, "y")], "id long, key string")
    granted = spark.createDataFrame([("x",), ("x",)], "key string")
    assert rows(apply_entitlements(facts, granted, ["key"]).select("id")) == [(1,)]


def test_in_any_does_not_multiply(spark):
    df = spark.createDataFrame([(1, "a", "b"), (2, "c", None), (3, None, "a")], "id long, p string, q string")
    members = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "m string")
    assert rows(in_any(df, ["p", "q"], members, "m").select("id")) == [(1,), (3,)]


def test_text_list_sorts_counts_and_skips_nulls(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", None), ("z", None)], "k string, v string")
    assert rows(text_list(df, ["k"], "v", " | ", "t")) == [("k", "a | b | b")]
    assert rows(text_list(df.repartition(7), ["k"], "v", " | ", "t", distinct=True)) == [("k", "a | b")]


def test_lookup_table_is_deterministic(spark):
    df = spark.createDataFrame([("p", "z", 1), ("p", "a", 2), (None, "q", 3)], "k string, v string, w int")
    assert rows(lookup_table(df, "k", ["v", "w"])) == [("p", "a", 2)]


def test_collapse_lists_others_by_row_not_by_value(spark):
    d = dt.date(2024, 1, 1)
    data = [
        ("f", "P1", d, 1, "x"), ("f", "P1", d + dt.timedelta(1), 2, "y"), ("f", "P2", None, 3, None),
        ("g", "P9", None, 4, "x"),
    ]
    df = spark.createDataFrame(data, "k string, po string, d date, id long, note string").withColumn("first", F.col("po"))
    got = collapse_by_primary(df, "k", "po", ["d", "id"], ["first", "d"], {"top": F.max("id")}, ["note"], "others")
    out = {r.k: r for r in got.collect()}
    # P1 leads, but its second row counts among the others.
    assert (out["f"]["first"], out["f"].d, out["f"].top, out["f"].note, out["f"].others) == ("P1", d, 3, "x | y", "P1 | P2")
    assert (out["g"]["first"], out["g"].others) == ("P9", None)


def test_fanout_left_join_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a", 1), (2, "a", None), (3, None, 1), (4, "z", 9), (4, "z", 9)], "id long, p string, q long")
    right = spark.createDataFrame([("a", 1, i) for i in range(50)] + [("a", None, 99), (None, 1, 98)], "x string, y long, v long")
    got = fanout_left_join(left, right, [("p", "x"), ("q", "y")])
    want = left.join(right, (F.col("p") == F.col("x")) & (F.col("q") == F.col("y")), "left")
    assert got.columns == want.columns and rows(got) == rows(want)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    from tradeops.plans import ic_loans
    from tradeops.sources import Tables
    from tradeops.sources.schemas import SCHEMAS

    spark.createDataFrame([], SCHEMAS["journal_accruals"]).write.parquet(f"{tmp_path}/journal_accruals")
    df = ic_loans(Tables.from_files(spark, str(tmp_path))).select("_voucher")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "In(mainaccount" in plan.split("PushedFilters:")[1]
    assert "ReadSchema: struct<voucher:string,dataarea:string,counterparty:string,mainaccount:int>" in plan


def seen_by(data, granted, user):
    scopes = {s for u, s in granted if u.upper() == user.upper() and s is not None}
    return [r for r in data if "*" in scopes or r[1] in scopes or r[2] in scopes]


def test_rows_a_user_sees(spark):
    rnd = random.Random(3)
    offices = [None, *"abcdef"]
    data = [(i, "hot" if i % 3 == 0 else rnd.choice(offices), rnd.choice(offices), i % 7) for i in range(300)]
    granted = [("Ann", "hot"), ("ANN", "a"), ("ann", "a"), ("bob", "b"), ("eve", "*"), ("eve", "a"), ("dan", "nowhere"), ("joe", None)]
    df = spark.createDataFrame(data, "id long, a string, b string, v long")
    lists = spark.createDataFrame(granted, "who string, scope string")
    for user in ("ann", "bob", "Eve", "dan", "joe", "nobody"):
        got = visible_to(df, ["a", "b"], lists, "scope", "who", user)
        assert rows(got) == sorted(seen_by(data, granted, user), key=repr), user
    want = {u.upper(): seen_by(data, granted, u) for u in ("ann", "bob", "eve", "dan")}
    got = rows_seen(df, ["a", "b"], lists, "scope", "who", {"total": F.col("v")})
    assert {r["who"]: (r["rows"], r["total"]) for r in got.collect()} == {u: (len(r), sum(x[3] for x in r)) for u, r in want.items()}
    empty = rows_seen(df.limit(0), ["a", "b"], lists, "scope", "who", {"total": F.col("v")})
    assert {r["who"]: (r["rows"], r["total"]) for r in empty.collect()} == dict.fromkeys(want, (0, 0))


def test_everyone_may_be_marked_otherwise(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id long, seller long")
    lists = spark.createDataFrame([("boss", None), ("ann", 10)], "who string, seller long")
    everything = F.col("seller").isNull()
    assert [visible_to(df, ["seller"], lists, "seller", "who", u, everything).count() for u in ("boss", "ann")] == [3, 1]


def test_fanout_left_join_with_a_class(spark):
    rnd = random.Random(5)
    left = spark.createDataFrame([(i, rnd.choice(["hot", "a", "b", None]), rnd.choice(["x", "y", None])) for i in range(60)], "i long, k string, c string")
    right = spark.createDataFrame([("hot", j) for j in range(40)] + [("a", 1), (None, 2)], "r string, j long")
    got = fanout_left_join(staged(left, "left"), right, [("k", "r")], only=F.col("c") == "x")
    assert rows(got) == rows(left.join(right, (F.col("k") == F.col("r")) & (F.col("c") == "x"), "left"))


@pytest.mark.parametrize("width", [1, 7])
def test_running_totals_equal_window(spark, width):
    df = spark.createDataFrame(hot(300, seed=width), "id long, k string, v long")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    got = running_totals(df, ["k"], ["id"], "v", "before")
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    assert rows(got) == rows(df.withColumn("before", F.coalesce(F.sum("v").over(w), F.lit(0))))


def test_list_rows_and_their_text(spark):
    df = spark.createDataFrame(hot(300), "id long, k string, v long").withColumn("t", F.when(F.col("v") % 5 != 0, F.concat(F.lit("t"), "v")))
    lists = defaultdict(list)
    for r in df.collect():
        if r["t"] is not None:
            lists[r["k"]].append(r["t"])
    children = list_rows(df, ["k"], "t")
    want = sorted(((k, sorted(v).index(x) + 1, x, v.count(x)) for k, v in lists.items() for x in set(v)), key=repr)
    assert rows(children) == want
    assert {r["k"]: r["text"] for r in list_text(children, ["k"], "t", ", ", "text").collect()} == {k: ", ".join(sorted(v)) for k, v in lists.items()}
    once = sorted(((k, sorted(set(v)).index(x) + 1, x, 1) for k, v in lists.items() for x in set(v)), key=repr)
    assert rows(list_rows(df, ["k"], "t", distinct=True)) == once
    assert list_rows(df.limit(0), ["k"], "t").count() == 0


def test_a_hot_list_is_spread_over_tasks(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("v"))
    cuts = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    def stage(out, label):
        cuts.append(staged(out, label))
        return cuts[-1]

    assert list_rows(df, ["k"], "v", stage=stage).count() == 20_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in cuts[0].groupBy("__range").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 10_000


def test_order_list_rows_equal_the_collapse(spark):
    rnd = random.Random(9)
    data = [(rnd.randrange(8), rnd.choice(["F1", "F2", "F3", None]), rnd.choice([None, 1, 2, 3]), i, rnd.choice(["x", "y", None])) for i in range(80)]
    df = spark.createDataFrame(data, "k long, part string, day long, id long, note string")
    cells = collapse_by_primary(df, "k", "part", ["day", "id"], ["id"], {}, ["note"], "others").collect()
    children = order_list_rows(df, "k", "part", ["day", "id"], ["note"], "others").orderBy("k", "list", "position").collect()
    for name in ("note", "others"):
        found = defaultdict(list)
        for r in children:
            if r["list"] == name:
                found[r["k"]].append(r["value"])
                assert r["position"] == len(found[r["k"]])
        assert {r["k"]: r[name] for r in cells if r[name]} == {k: " | ".join(v) for k, v in found.items()}
