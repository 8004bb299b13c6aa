"""Every registered query against its SQL twin, value by value."""

from __future__ import annotations

import pytest

from tests.conftest import SF_DIR
from tradeops.workload import REGISTRY, compare


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_twin(spark, duck, name):
    q = REGISTRY[name]
    assert q.sql is not None
    assert compare.difference(q.run(spark, SF_DIR), duck, q.oracle()) is None


def test_contract_lists_every_query():
    import __spark_entry__ as entry

    assert set(REGISTRY) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["light_rollup", "charge_pivot", "gross_profit", "sales_ids"])
def test_partition_count_does_not_matter(spark, name):
    q, seen = REGISTRY[name], []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = q.run(spark, SF_DIR)
        seen.append(compare.rows_of(df.columns, df.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert seen[0] == seen[1]
