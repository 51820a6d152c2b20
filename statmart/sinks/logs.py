"""Append-only logs: a snapshot and the files added since.

    <path>/part-*.parquet               records as they were appended
    <path>/_snapshots/<id>/             all records up to some time, in few files
    <path>/_versions/<number>.json      the snapshot, and the appended files it covers

Every record is a file of its own, so a log that grows would be listed and
opened file by file. Compaction writes what there is to a snapshot and says in
a pointer which files it covers (``sinks.versions``); readers take the snapshot
and all other files. Covered files stay for ``versions.KEEP`` compactions, for
readers that are at them. Appending and compacting may go on side by side.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from statmart.sinks import files, versions

#: Appended files from which on a compaction pays.
MANY_FILES = 64

SNAPSHOTS = "_snapshots"


@dataclass(frozen=True)
class Log:
    """What a log is made of at one time."""

    snapshot: str | None
    covered: frozenset[str]
    tail: tuple[str, ...]


def append(df: DataFrame, path: str) -> None:
    """Add records."""
    df.write.mode("append").parquet(path)


def current(spark: SparkSession, path: str) -> Log:
    """The snapshot and the appended files beyond it.

    Files are listed after the pointer is read: one that is covered meanwhile is read as a file.
    """
    version = versions.current(spark, path) or versions.Version()
    covered = frozenset(version.covers)
    tail = tuple(n for n in files.names(spark, path) if n.endswith(".parquet") and n not in covered)
    return Log(version.folders.get(versions.WHOLE), covered, tail)


def frame(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """All records; None if there is no log."""
    path = path.rstrip("/")
    log = current(spark, path)
    sources = [f"{path}/{name}" for name in ([log.snapshot] if log.snapshot else []) + list(log.tail)]
    if sources:
        return spark.read.schema(schema).parquet(*sources)
    return spark.createDataFrame([], schema) if files.exists(spark, path) else None


def compact(spark: SparkSession, path: str, schema: StructType, least_files: int = 2) -> int:
    """Put snapshot and tail into a new snapshot; returns how many appended files it covers anew (0: nothing to do)."""
    path = path.rstrip("/")
    log = current(spark, path)
    if len(log.tail) < least_files:
        return 0
    sources = [f"{path}/{name}" for name in ([log.snapshot] if log.snapshot else []) + list(log.tail)]
    name = f"{SNAPSHOTS}/{uuid.uuid4().hex}"
    # Rebalanced by size: one file for a small log, as many as it takes for a large one.
    spark.read.schema(schema).parquet(*sources).hint("rebalance").write.parquet(f"{path}/{name}")

    def replaced(base: versions.Version) -> versions.Version:
        if base.folders.get(versions.WHOLE) != log.snapshot:
            raise versions.LostRace(f"{path}: another compaction was faster")
        left = log.covered & set(files.names(spark, path))
        return versions.Version(folders={versions.WHOLE: name}, covers=tuple(sorted(left | set(log.tail))))

    try:
        versions.commit(spark, path, replaced)
    except Exception:
        files.remove(spark, f"{path}/{name}")
        raise
    _expire(spark, path)
    return len(log.tail)


def _expire(spark: SparkSession, path: str) -> None:
    """Remove the files that even the oldest version kept covers."""
    kept = versions.kept(spark, path)
    if len(kept) >= versions.KEEP:
        for name in kept[0].covers:
            files.remove(spark, f"{path}/{name}")
