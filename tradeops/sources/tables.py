"""Named input tables, read lazily from files, a catalog or a database."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from .schemas import SCHEMAS

Columns = Mapping[str, Mapping[str, str]]  # table -> our column name -> the source's
PARTITIONED = frozenset({"partitionColumn", "lowerBound", "upperBound", "numPartitions"})


class Tables(Mapping[str, DataFrame]):
    """Mapping of table name -> DataFrame; a table is opened when first asked for."""

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._frames = dict(frames)

    def __getitem__(self, name: str) -> DataFrame:
        frame = self._frames[name]
        if callable(frame):
            frame = self._frames[name] = frame()
        return frame

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    @classmethod
    def from_files(
        cls, spark: SparkSession, root: str, fmt: str = "parquet", names: list[str] | None = None, columns: Columns | None = None,
        **options: str,
    ) -> Tables:
        """`<root>/<table>` in any file format; ``columns`` maps a table's column names to the files'.

        Columns are taken by the files' own names, so a name that is not there is an error and no column of NULL. Text
        formats are read as text and typed by `conform`.
        """

        def reader(name: str) -> Callable[[], DataFrame]:
            return lambda: conform(read_files(spark, f"{root}/{name}", fmt, **options), name, (columns or {}).get(name))

        return cls({n: reader(n) for n in names or SCHEMAS})

    @classmethod
    def from_catalog(
        cls, spark: SparkSession, database: str, renames: Mapping[str, str] | None = None, columns: Columns | None = None
    ) -> Tables:
        """Catalog tables; ``renames`` maps our table names, ``columns`` a table's column names, to the catalog's."""

        def reader(name: str) -> Callable[[], DataFrame]:
            source = f"{database}.{(renames or {}).get(name, name)}"
            return lambda: conform(spark.read.table(source), name, (columns or {}).get(name))

        return cls({n: reader(n) for n in SCHEMAS})

    @classmethod
    def from_jdbc(
        cls, spark: SparkSession, url: str, sources: Mapping[str, str], options: Mapping[str, Mapping[str, str]] | None = None,
        columns: Columns | None = None, single_read: Collection[str] = (), **connection: str,
    ) -> Tables:
        """Database tables; ``options[name]`` holds the settings of a partitioned read (``PARTITIONED``).

        A table without them would be read by one task; it must be named in ``single_read``.
        """
        options = options or {}
        bare = [n for n in sources if n not in single_read and not PARTITIONED <= set(options.get(n, {}))]
        if bare:
            raise ValueError(f"no partitioned read for {', '.join(sorted(bare))}: give {', '.join(sorted(PARTITIONED))}")

        def reader(name: str, source: str) -> Callable[[], DataFrame]:
            reading = spark.read.format("jdbc").options(url=url, dbtable=source, **connection, **options.get(name, {}))
            return lambda: conform(reading.load(), name, (columns or {}).get(name))

        return cls({n: reader(n, s) for n, s in sources.items()})


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Files under their own column names; the values of text formats stay text."""
    own = {"csv": {"header": "true"}, "json": {"primitivesAsString": "true"}}.get(fmt, {})
    return spark.read.format(fmt).options(**own | options).load(path)


def _declared(df: DataFrame, name: str, columns: Mapping[str, str] | None) -> list[tuple[str, DataType, Column]]:
    """(name, type, source column) of the declared columns of a table."""
    source = columns or {}
    declared = StructType.fromDDL(SCHEMAS[name])
    missing = [source.get(f.name, f.name) for f in declared if source.get(f.name, f.name) not in df.columns]
    if missing:
        raise ValueError(f"{name}: the source has no column {', '.join(missing)}; it has {', '.join(df.columns)}")
    quoted = lambda c: df["`" + c.replace("`", "``") + "`"]
    return [(f.name, f.dataType, quoted(source.get(f.name, f.name))) for f in declared]


def conform(df: DataFrame, name: str, columns: Mapping[str, str] | None = None) -> DataFrame:
    """The declared columns of table ``name`` in their declared types, read from ``columns`` where the source calls them
    otherwise (``{"serial_no": "Serial No"}``). Text that is not of the type becomes NULL (`ingest` keeps it apart); a
    missing column is an error."""
    return df.select(*[c.try_cast(kind).alias(out) for out, kind, c in _declared(df, name, columns)])


def ingest(
    df: DataFrame, name: str, columns: Mapping[str, str] | None = None, observation: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) of a source of table ``name``.

    Accepted rows are those of `conform` all of whose values are of their types. A row with other values is left out and
    listed in rejects with each of them: (table, row, column, value), ``row`` being the whole source row as JSON text.
    Both are projections of one scan. ``observation`` counts rows and accepted rows as the accepted ones are used.
    """
    declared = _declared(df, name, columns)
    faults = [
        F.when(c.isNotNull() & c.try_cast(kind).isNull(), F.struct(F.lit(out).alias("column"), c.cast("string").alias("value")))
        for out, kind, c in declared
    ]
    source = F.struct(*[df["`" + c.replace("`", "``") + "`"] for c in df.columns])
    typed = F.struct(*[c.try_cast(kind).alias(out) for out, kind, c in declared])
    checked = df.select(typed.alias("typed"), F.to_json(source).alias("row"), F.array_compact(F.array(*faults)).alias("faults"))
    if observation is not None:
        sound = F.count(F.when(F.size("faults") == 0, 1))
        checked = checked.observe(observation, F.count(F.lit(1)).alias("rows"), sound.alias("accepted"))
    accepted = checked.where(F.size("faults") == 0).select("typed.*")
    rejects = checked.where(F.size("faults") > 0).select(F.lit(name).alias("table"), "row", F.inline("faults"))
    return accepted, rejects


def snake(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename quoted source columns ('Serial No') to the declared names, dropping the rest."""
    return df.select(*[df[f"`{old}`"].alias(new) for old, new in names.items()])
