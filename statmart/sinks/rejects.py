"""Rows of extracts that could not be read, kept with the reason beside the tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from statmart import schemas
from statmart.sinks import files


class TooManyRejects(ValueError):
    """An extract has more malformed rows than its load allows."""


@dataclass(frozen=True)
class Rejects:
    """Malformed rows of an extract: ``file``, ``reason``, ``first_field`` and ``line``, and what was seen of them while the extract was read."""

    rows: DataFrame
    observed: Observation

    def seen(self) -> bool:
        """Whether there are any; known once the extract has been read."""
        return bool(self.observed.get.get("n_rejects"))


def keep_rejects(spark: SparkSession, root: str, run_id: str, dataset_key: str, rejects: Rejects) -> int:
    """Write the rejected rows of one load; returns their number."""
    path = f"{root.rstrip('/')}/{schemas.REJECTS.name}"
    folder = f"{path}/run={files.quoted(run_id)}/dataset={files.quoted(dataset_key)}"
    counted = Observation()
    rows = rejects.rows.select(
        F.lit(run_id).alias("run_id"), F.lit(dataset_key).alias("dataset_key"), "file", "reason", "first_field", "line",
        F.current_timestamp().alias("loaded_at")
    ).observe(counted, F.count(F.lit(1)).alias("n"))
    # A load that is tried again within one run replaces what it has kept.
    rows.write.mode("overwrite").parquet(folder)
    return counted.get["n"]


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """All rejected rows kept beside the tables."""
    path = f"{root.rstrip('/')}/{schemas.REJECTS.name}"
    if not files.exists(spark, path):
        return spark.createDataFrame([], schemas.REJECTS.schema)
    return spark.read.schema(schemas.REJECTS.schema).parquet(path).select(*schemas.REJECTS.schema.names)
