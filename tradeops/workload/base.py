"""Registering queries and running them on either engine."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune
from ..sources.tables import Tables
from .derived import DERIVED, SOURCES

_TOKEN = re.compile(r"(?<=[\s(])@(\w+)")
AS_OF = "1998-09-02"


def view_name(sf_dir: str, table: str) -> str:
    return f"tradeops_{md5(sf_dir.encode()).hexdigest()[:8]}_{table}"


def inputs(spark: SparkSession, sf_dir: str) -> Tables:
    """The test tables and everything derived from them, opened on demand."""
    frames: dict[str, Callable[[], DataFrame]] = {}

    def source(name: str) -> Callable[[], DataFrame]:
        return lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def derived(name: str) -> Callable[[], DataFrame]:
        def build() -> DataFrame:
            for used in set(_TOKEN.findall(DERIVED[name])):
                tables[used].createOrReplaceTempView(view_name(sf_dir, used))
            return spark.sql(_TOKEN.sub(lambda m: view_name(sf_dir, m[1]), DERIVED[name]))

        return build

    frames |= {n: source(n) for n in SOURCES}
    frames |= {n: derived(n) for n in DERIVED}
    tables = Tables(frames)
    return tables


@lru_cache(maxsize=None)
def _needed(name: str) -> tuple[str, ...]:
    """The derived tables ``name`` needs, in order, itself last."""
    if name not in DERIVED:
        return ()
    out: list[str] = []
    for used in _TOKEN.findall(DERIVED[name]):
        out += [n for n in _needed(used) if n not in out]
    return (*out, name)


def twin_sql(body: str) -> str:
    """Plain SQL for ``body``: derived tables it names become leading CTEs."""
    tables: list[str] = []
    for used in _TOKEN.findall(body):
        tables += [n for n in _needed(used) if n not in tables]
    ctes = [f"{n} as ({DERIVED[n].strip()})" for n in tables]
    text = body.strip()
    if ctes:
        if text.lower().startswith("with "):
            text = "with " + ",\n".join(ctes) + ",\n" + text[5:]
        else:
            text = "with " + ",\n".join(ctes) + "\n" + text
    return _TOKEN.sub(r"\1", text)


# Column kinds of published results: (Spark type, rounding).
_KINDS = {"s": "string", "l": "bigint", "D": "date", "t": "timestamp", "b": "boolean"}


def _columns(spec: str) -> list[tuple[str, str]]:
    """'s:a,b n2:c' -> [('a', 's'), ('b', 's'), ('c', 'n2')]"""
    out = []
    for group in spec.split():
        kind, names = group.split(":")
        out += [(n, kind) for n in names.split(",")]
    return out


def finish(df: DataFrame, spec: str) -> DataFrame:
    """Select the declared columns in plain comparable types."""
    shown = []
    for name, kind in _columns(spec):
        c = F.col(name)
        c = F.round(c.cast("double"), int(kind[1:])) if kind[0] == "n" else c.cast(_KINDS[kind])
        shown.append(c.alias(name))
    return df.select(*shown)


def finish_sql(body: str, spec: str) -> str:
    shown = []
    for name, kind in _columns(spec):
        if kind[0] == "n":
            shown.append(f'round(cast("{name}" as double), {kind[1:]}) as "{name}"')
        else:
            shown.append(f'cast("{name}" as {"varchar" if kind == "s" else _KINDS[kind]}) as "{name}"')
    return f"select {', '.join(shown)} from (\n{body}\n) published"


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    spec: str
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(self.build(inputs(tune(spark), sf_dir)), self.spec)

    def oracle(self) -> str | None:
        return None if self.sql is None else finish_sql(twin_sql(self.sql), self.spec)


REGISTRY: dict[str, Query] = {}


def query(spec: str, sql: str | None):
    """Register the decorated builder under its own name with its SQL twin."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = build.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, build, spec, sql)
        return build

    return register
