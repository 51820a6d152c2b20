"""Session settings for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "statmart", memory: str = "8g",
                  shared: str | None = None) -> SparkSession:
    """A local session for tests and benches; on a cluster use the one given.

    ``shared`` stands for the folder a cluster names in spark.checkpoint.dir; a
    new one is made if none is given.
    """
    parallel = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.session.timeZone", "UTC")
        # Call sites for error messages cost driver time on every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    return builder.config("spark.checkpoint.dir", shared or tempfile.mkdtemp(prefix="statmart-")).getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder the session names in spark.checkpoint.dir.

    Where that is unset, below the warehouse, which executors share as well.
    What lies there is removed when the program ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


_SCRATCH: list[tuple[SparkSession, str]] = []


def _remove_scratch() -> None:
    for spark, path in _SCRATCH:
        # The session may be gone by then.
        with contextlib.suppress(Exception):
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialized(df: DataFrame) -> DataFrame:
    """A small result several branches read: computed once, written to the shared folder.

    The files outlive the executors that wrote them, and their size lets Spark
    choose the right join.
    """
    path = scratch_path(df.sparkSession, "result")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_row(spark: SparkSession) -> DataFrame:
    """A single row to hang scalar subqueries on."""
    return spark.range(0, 1, 1, 1)
