"""Intermediate results shared by several branches of one report."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (or ``setCheckpointDir``).

    A session on one machine that names none gets a fresh folder. On a cluster a
    folder of one machine would lose rows without an error, so there it is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("staging needs a folder that all machines share: set spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="tradeops-stage-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


class Scope:
    """The stages written while a scope is open."""

    def __init__(self, write: bool = True):
        self.write = write
        self.paths: list[str] = []
        self._known: dict[int, list[tuple[DataFrame, DataFrame]]] = {}

    def find(self, df: DataFrame) -> DataFrame | None:
        """The stage of an equal plan, if there is one."""
        return next((out for plan, out in self._known.get(df.semanticHash(), []) if plan.sameSemantics(df)), None)

    def add(self, df: DataFrame, path: str, out: DataFrame) -> None:
        self.paths.append(path)
        self._known.setdefault(df.semanticHash(), []).append((df, out))


_SCOPE: ContextVar[Scope | None] = ContextVar("stages", default=None)


@contextmanager
def stages(spark: SparkSession, write: bool = True) -> Iterator[Scope]:
    """Owns the stages written inside and deletes them when left: use up what reads them before.

    Equal plans are staged once. With ``write=False`` nothing is staged and nothing runs: plans can be built and explained,
    but not relied on, as branches may then see different cuts of one result.
    """
    scope = Scope(write)
    token = _SCOPE.set(scope)
    try:
        yield scope
    finally:
        _SCOPE.reset(token)
        for path in scope.paths:
            _delete(spark, path)


def writes_stages() -> bool:
    """Whether `staged` runs what it is given."""
    scope = _SCOPE.get()
    return scope is None or scope.write


def staged(df: DataFrame, label: str) -> DataFrame:
    """Run ``df`` now, write it once as Parquet in the shared folder and read it back.

    Cuts the lineage for every branch that follows, survives the loss of
    executors, and lets each branch read only the columns it needs. Inside
    `stages` the folder belongs to that scope; else it stays until the application's
    stages are dropped together (``drop_stages``), for which its path carries the application id.
    """
    scope = _SCOPE.get()
    if scope is not None:
        if not scope.write:
            return df
        if (known := scope.find(df)) is not None:
            return known
    spark = df.sparkSession
    path = f"{_application_root(spark)}/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    with _no_shuffles_kept(spark):
        df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    if scope is not None:
        scope.add(df, path, out)
    return out


@contextmanager
def _no_shuffles_kept(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it ends: nothing reads them again once a stage is written.

    Else they lie on the disks until the driver collects garbage, and the steps of a report add up.
    """
    kept = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if kept is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, kept)


def drop_stages(spark: SparkSession) -> None:
    """Delete everything this application has staged; results that still read it break."""
    _delete(spark, _application_root(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _application_root(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/tradeops/{spark.sparkContext.applicationId}"
