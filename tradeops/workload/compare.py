"""Run a query on Spark and its SQL twin in DuckDB and compare all values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

from .derived import SOURCES


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in SOURCES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (0.0 if v == 0 else round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    return v


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql: str, show: int = 3) -> str | None:
    """None if both sides hold the same rows, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns differ: {sorted(set(names) ^ set(spark_df.columns))}"
    want = rows_of(names, result.fetchall())
    got = rows_of(spark_df.columns, spark_df.collect())
    if want == got:
        return None
    order = sorted(names)
    only_got, only_want = got - want, want - got
    lines = [f"spark {sum(got.values())} rows, duckdb {sum(want.values())}; {sum(only_got.values())} differ"]
    pairs = list(zip(sorted(only_got, key=repr)[:show], sorted(only_want, key=repr)[:show]))
    for g, w in pairs:
        diff = {n: (a, b) for n, a, b in zip(order, g, w) if a != b}
        lines.append(f"  spark/duckdb {diff}")
        lines.append(f"  spark row {dict(zip(order, g))}"[:600])
    if not pairs:
        lines.append(f"  only spark {list(only_got)[:show]}; only duckdb {list(only_want)[:show]}"[:900])
    return "\n".join(lines)
