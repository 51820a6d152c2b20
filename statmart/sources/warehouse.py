"""Warehouse tables and published documents as frames."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from statmart import schemas
from statmart.sinks import logs, versions

#: Append-only tables.
LOGS = (schemas.LOADS.name, schemas.RUNS.name)


class MissingSource(RuntimeError):
    """A required source has no usable resource."""


class LostTable(RuntimeError):
    """A table that has been loaded is gone."""


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The current version of a warehouse table; an empty frame of its schema before the first load.

    One that the load log says was loaded, and that is not there, is an error.
    """
    table = schemas.TABLES[name]
    path = table_path(root, name)
    if name in LOGS:
        rows = logs.frame(spark, path, table.schema)
    else:
        rows = versions.frame(spark, path, table.schema)
    if rows is None:
        if name not in LOGS and _was_loaded(spark, root, name):
            raise LostTable(f"{name} has been loaded, but {path} is missing")
        return spark.createDataFrame([], table.schema)
    return rows.select(*table.schema.names)


def periods(spark: SparkSession, root: str, name: str) -> list:
    """The periods a table holds, oldest first, from its folders alone; for tables laid out by period."""
    table = schemas.TABLES[name]
    kind = table.schema[table.laid_out_by].dataType
    read = date.fromisoformat if isinstance(kind, DateType) else int
    return sorted(read(v) for v in versions.partitions(spark, table_path(root, name), table.laid_out_by) if v is not None)


def read_latest(spark: SparkSession, root: str, name: str, as_of: int | None = None) -> DataFrame:
    """The rows of the newest complete period, or of the newest one if none is complete.

    Periods before ``as_of`` are complete, without it all are. The period comes
    from the list of partitions, so the scan opens the files of that period only,
    and an operator that looks for the latest period of these rows finds it.
    """
    rows, at = read_table(spark, root, name), schemas.TABLES[name].laid_out_by
    found = periods(spark, root, name)
    if not found:
        # Nothing loaded, or a folder written by other means.
        return rows
    complete = [p for p in found if as_of is None or p < as_of]
    return rows.filter(F.col(at) == F.lit(max(complete or found)))


class Warehouse(Mapping[str, DataFrame]):
    """All tables of a warehouse, by name."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root
        self._read = {name: read_table(spark, root, name) for name in schemas.TABLES}

    def __getitem__(self, name: str) -> DataFrame:
        return self._read[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._read)

    def __len__(self) -> int:
        return len(self._read)

    def latest(self, name: str, as_of: int | None = None) -> DataFrame:
        """``read_latest`` of the same version of the table as the mapping holds, if it has not been replaced since."""
        return read_latest(self.spark, self.root, name, as_of)


def latest_rows(tables: Mapping[str, DataFrame], name: str, as_of: int | None = None) -> DataFrame:
    """A table for operators that look at its latest period: pruned to it where the tables are a warehouse."""
    return tables.latest(name, as_of) if isinstance(tables, Warehouse) else tables[name]


def _was_loaded(spark: SparkSession, root: str, name: str) -> bool:
    """Whether the load log has a successful load of a table."""
    log = read_table(spark, root, schemas.LOADS.name)
    return not log.filter((F.col("dataset_key") == name) & (F.col("status") == "success")).isEmpty()


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make frames known to SQL under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def read_document(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A published JSON document as one row."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path, multiLine=True)


def require_source(df: DataFrame | None, what: str) -> DataFrame:
    """The frame, or an error when the source is missing or empty."""
    if df is None or df.isEmpty():
        raise MissingSource(f"no resource found for {what}")
    return df
