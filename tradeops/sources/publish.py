"""Keyed publishing of report results.

A publication writes a new version of the result, then a commit file with the next
number of its (report, page). A number can be taken only once, so writers that
race are put in order and none is lost. Readers follow the highest commit: they see the
old version until the new one is complete. Old versions are deleted after ``keep`` newer ones.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEEP = 3  # versions of a result, so that readers of the last ones are not cut off
TRIES = 1000  # numbers tried before a commit is given up as refused

_COMMITS = "seq long, path string, updated timestamp, report string, page string"


class _Files:
    """The file system of a folder, through Spark's own configuration."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def modified(self, path: str) -> dt.datetime:
        return dt.datetime.fromtimestamp(self.fs.getFileStatus(self._path(path)).getModificationTime() / 1000, dt.timezone.utc)

    def create(self, path: str, text: str) -> bool:
        """Whether the file was created here; False if there was one."""
        try:
            out = self.fs.create(self._path(path), False)
        except Py4JJavaError as e:
            if "Exists" in str(e.java_exception.getClass().getName()) or self.fs.exists(self._path(path)):
                return False
            raise
        out.write(text.encode())
        out.close()
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)


def _log(root: str, report: str, page: str) -> str:
    return f"{root}/_registry/report={quote(report, safe='')}/page={quote(page, safe='')}"


def _numbers(files: _Files, log: str) -> list[int]:
    return [int(n.split(".")[0]) for n in files.names(log) if n.endswith(".json") and n[0].isdigit()]


def publish(df: DataFrame, root: str, report: str, page: str, now: dt.datetime | None = None, keep: int = KEEP) -> str:
    """Write ``df`` as the current result of (report, page); returns its path."""
    now = now or dt.datetime.now(dt.timezone.utc)
    spark = df.sparkSession
    path = f"{root}/{report}/{page}/v={now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(path)
    files, log = _Files(spark, root), _log(root, report, page)
    entry = {"path": path, "updated": now.isoformat()}
    seq = max(_numbers(files, log), default=0)
    for _ in range(TRIES):
        seq += 1
        if files.create(f"{log}/{seq:012d}.json", json.dumps(entry | {"seq": seq})):
            break
    else:
        files.delete(path)
        raise RuntimeError(f"no commit number could be taken for {report}/{page}")
    _retain(spark, files, root, report, page, seq - keep)
    return path


def _retain(spark: SparkSession, files: _Files, root: str, report: str, page: str, last: int) -> None:
    """Delete versions of commits up to number ``last``, then the commits."""
    log = _log(root, report, page)
    old = [n for n in _numbers(files, log) if n <= last]
    if old:
        for row in _commits(spark, root, report, page).where(F.col("seq") <= last).collect():
            files.delete(row["path"])
        for n in old:
            files.delete(f"{log}/{n:012d}.json")


def _commits(spark: SparkSession, root: str, report: str, page: str) -> DataFrame:
    """Complete commits of one result; ``KEEP`` rows or so. A commit that is still being written reads as NULL."""
    commits = spark.read.schema(_COMMITS).json(f"{root}/_registry")
    return commits.where((F.col("report") == report) & (F.col("page") == page) & F.col("path").isNotNull())


def registry(spark: SparkSession, root: str) -> DataFrame:
    """(report, page, path, updated, seq) of every current result."""
    newest = F.max_by(F.struct("path", "updated", "seq"), "seq").alias("c")
    commits = spark.read.schema(_COMMITS).json(f"{root}/_registry").where(F.col("path").isNotNull())
    return commits.groupBy("report", "page").agg(newest).select("report", "page", "c.*")


def latest(spark: SparkSession, root: str, report: str, page: str) -> DataFrame:
    """The published result of (report, page)."""
    files = _Files(spark, root)
    entry = None
    if files.names(_log(root, report, page)):
        entry = _commits(spark, root, report, page).orderBy(F.desc("seq")).select("path").head()
    if entry is None:
        raise LookupError(f"nothing published for {report}/{page}")
    return spark.read.parquet(entry["path"])


def sweep(spark: SparkSession, root: str, report: str, page: str, older: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Delete versions that no commit names and that are ``older``: left by writers that died. Returns their paths."""
    files, folder = _Files(spark, root), f"{root}/{report}/{page}"
    known = set()
    if files.names(_log(root, report, page)):
        known = {r["path"].rsplit("/", 1)[1] for r in _commits(spark, root, report, page).select("path").collect()}
    limit = dt.datetime.now(dt.timezone.utc) - older
    lost = [f"{folder}/{n}" for n in files.names(folder) if n.startswith("v=") and n not in known]
    gone = [p for p in lost if files.modified(p) <= limit]
    for p in gone:
        files.delete(p)
    return gone
