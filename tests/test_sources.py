"""Reading with rejects, staging scopes and publishing."""

from __future__ import annotations

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tradeops.sources import Tables, ingest, latest, publish, stages
from tradeops.sources.publish import registry, sweep
from tradeops.sources.staging import staged, staging_root
from tradeops.sources.tables import conform, read_files

PORTS = "`Port Code` string, country string, `Region.` string"
NAMES = {"port": "Port Code", "region": "Region."}


def test_rejects_stand_beside_accepted_rows(spark):
    rows = [("7", "3", "x"), ("soon", "4", "y"), (None, None, "z"), ("8", "many", "w"), ("a", "b", "v")]
    df = spark.createDataFrame(rows, "`User Id` string, company_id string, note string")
    seen = Observation("users")
    accepted, rejects = ingest(df, "companies_on_users", {"user_id": "User Id"}, seen)
    assert sorted(map(tuple, accepted.collect()), key=repr) == sorted([(7, 3), (None, None)], key=repr)
    assert seen.get == {"rows": 5, "accepted": 2}
    got = {(r["column"], r["value"]): r["row"] for r in rejects.collect()}
    assert set(got) == {("user_id", "soon"), ("company_id", "many"), ("user_id", "a"), ("company_id", "b")}
    assert got["user_id", "soon"] == '{"User Id":"soon","company_id":"4","note":"y"}'
    assert {r["table"] for r in rejects.collect()} == {"companies_on_users"}


def test_clashing_and_missing_columns(spark):
    df = spark.createDataFrame([("1", "x", 5)], "user_id string, company_id string, __faults int")
    with pytest.raises(ValueError, match="user_id"):
        conform(df.drop("user_id"), "companies_on_users")
    with pytest.raises(ValueError, match="Id"):
        ingest(df, "companies_on_users", {"user_id": "Id"})
    _, rejects = ingest(df, "companies_on_users")
    assert [(r["column"], r["value"]) for r in rejects.collect()] == [("company_id", "x")]
    assert [x.count() for x in ingest(df.limit(0), "companies_on_users")] == [0, 0]


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_files_with_the_sources_names(spark, tmp_path, fmt):
    df = spark.createDataFrame([("P1", "c", "r"), ("P2", "d", "s")], PORTS)
    writer = df.write.format(fmt)
    (writer.option("header", "true") if fmt == "csv" else writer).save(f"{tmp_path}/ports")
    got = Tables.from_files(spark, str(tmp_path), fmt, columns={"ports": NAMES})["ports"]
    assert sorted(map(tuple, got.collect())) == [("P1", "c", "r"), ("P2", "d", "s")]
    with pytest.raises(ValueError, match="port"):
        Tables.from_files(spark, str(tmp_path), fmt)["ports"]
    if fmt != "parquet":
        assert {t for _, t in read_files(spark, f"{tmp_path}/ports", fmt).dtypes} == {"string"}


def folders(spark):
    root = staging_root(spark).removeprefix("file:")
    return {f"{d}/{n}" for d, names, _ in os.walk(root) for n in names if n.startswith("scoped-")}


def test_a_scope_deletes_its_stages(spark):
    before = folders(spark)
    with stages(spark) as scope:
        one = staged(spark.range(10).where("id > 3"), "scoped-a")
        again = staged(spark.range(10).where("id > 3"), "scoped-a")
        other = staged(spark.range(10).where("id > 4"), "scoped-b")
        assert (one.count(), again.count(), other.count()) == (6, 6, 5)
        assert len(scope.paths) == 2 and len(folders(spark)) == len(before) + 2
    assert folders(spark) == before
    kept = staged(spark.range(2), "scoped-c")
    assert len(folders(spark)) == len(before) + 1 and kept.count() == 2


def test_a_scope_deletes_after_an_error_and_nests(spark):
    before = folders(spark)
    with pytest.raises(RuntimeError):
        with stages(spark):
            staged(spark.range(3), "scoped-a")
            with stages(spark) as inner:
                staged(spark.range(4), "scoped-b")
            assert len(inner.paths) == 1 and len(folders(spark)) == len(before) + 1
            raise RuntimeError
    assert folders(spark) == before


def test_explaining_runs_nothing(spark, monkeypatch):
    from tradeops.plans.po_lines import lit_links, order_lines
    from tradeops.workload.base import inputs
    from tests.conftest import SF_DIR

    written = []
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.parquet", lambda self, path, *a, **k: written.append(path))
    with stages(spark, write=False):
        t = inputs(spark, SF_DIR)
        lit_links(t, order_lines(t), F.current_date())._jdf.queryExecution().executedPlan().toString()
    assert not written


def test_versions_are_kept_and_deleted_in_order(spark, tmp_path):
    root = str(tmp_path)
    paths = [publish(spark.range(n), root, "daily report", "a/b", keep=2) for n in range(5)]
    assert latest(spark, root, "daily report", "a/b").count() == 4
    assert [os.path.isdir(p) for p in paths] == [False, False, False, True, True]
    assert [(r["report"], r["page"], r["seq"], r["path"]) for r in registry(spark, root).collect()] == [("daily report", "a/b", 5, paths[-1])]


def test_writers_that_race_are_put_in_order(spark, tmp_path):
    root, errors = str(tmp_path), []

    def write(n):
        try:
            publish(spark.range(n), root, "r", "p", keep=100)
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(1, 9)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors
    log = sorted(n for n in os.listdir(f"{root}/_registry/report=r/page=p") if n.endswith(".json"))
    assert log == [f"{n:012d}.json" for n in range(1, 9)]
    newest = registry(spark, root).first()
    assert newest["seq"] == 8 and latest(spark, root, "r", "p").count() == spark.read.parquet(newest["path"]).count()


def test_half_written_commits_and_orphans(spark, tmp_path):
    root = str(tmp_path)
    path = publish(spark.range(3), root, "r", "p")
    open(f"{root}/_registry/report=r/page=p/000000000002.json", "w").close()  # a writer died between create and write
    spark.range(9).write.parquet(f"{root}/r/p/v=lost")
    assert latest(spark, root, "r", "p").count() == 3
    assert sweep(spark, root, "r", "p") == []  # too young to be lost for sure
    assert [p.rsplit("/", 1)[1] for p in sweep(spark, root, "r", "p", dt.timedelta(0))] == ["v=lost"]
    publish(spark.range(4), root, "r", "p")
    assert latest(spark, root, "r", "p").count() == 4 and os.path.isdir(path)
