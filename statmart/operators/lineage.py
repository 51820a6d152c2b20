"""Load records, run log and freshness reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart import schemas
from statmart.functions import iso_timestamp
from statmart.operators.dedupe import latest_per_key
from statmart.session import one_row

LOAD_FIELDS = (
    "dataset_key", "source_family", "source_id", "resource_id", "resource_name", "reference_period", "cadence", "status",
    "loaded_at", "notes",
)


@dataclass(frozen=True)
class SourceMeta:
    """What is known about a source, beside its rows."""

    dataset_key: str
    source_id: str
    source_family: str = "unknown"
    resource_id: str | None = None
    resource_name: str | None = None
    cadence: str | None = None


def load_record(spark: SparkSession, run_id: str, meta: SourceMeta, status: str, notes: str | None = None,
                reference_period: Column | str | None = None) -> DataFrame:
    """One lineage row with a new id and the current time."""
    one = one_row(spark)
    values = {
        "run_id": run_id,
        "dataset_key": meta.dataset_key,
        "source_family": meta.source_family,
        "source_id": meta.source_id,
        "resource_id": meta.resource_id,
        "resource_name": meta.resource_name,
        "reference_period": reference_period,
        "cadence": meta.cadence,
        "status": status,
        "notes": notes,
    }
    columns = {name: (v if isinstance(v, Column) else F.lit(v)).cast("string") for name, v in values.items()}
    columns["load_id"] = F.expr("uuid()")
    columns["loaded_at"] = F.current_timestamp()
    return one.select(*[columns[f.name].alias(f.name) for f in schemas.LOADS.schema])


def run_event(spark: SparkSession, run_id: str, started_at: datetime, status: str,
              finished_at: datetime | None = None, fetched: Sequence[str] = (),
              notes: str | None = None) -> DataFrame:
    """One row of the append-only run log."""
    row = (run_id, started_at, finished_at, status, list(fetched), notes or None)
    return spark.createDataFrame([row], schemas.RUNS.schema)


def current_runs(events: DataFrame) -> DataFrame:
    """Latest state of every run: its closing event, or the opening one while it runs."""
    seen = events.withColumn("_seen_at", F.coalesce("finished_at", "started_at"))
    closed_first = [F.col("finished_at").desc_nulls_last(), F.col("status")]
    return latest_per_key(seen, ["run_id"], "_seen_at", closed_first).drop("_seen_at")


def latest_loads(loads: DataFrame, keys: Sequence[str], fields: Sequence[str] = LOAD_FIELDS) -> DataFrame:
    """Latest load record of each listed dataset, in key order, time as text."""
    known = [f for f in fields if f in loads.columns]
    tie = [F.col("load_id").desc()] if "load_id" in loads.columns else []
    latest = latest_per_key(loads.filter(F.col("dataset_key").isin(*keys)), ["dataset_key"], "loaded_at", tie)
    return latest.select(*known).withColumn("loaded_at", iso_timestamp("loaded_at")).orderBy("dataset_key")


def freshness(loads: DataFrame, keys: Sequence[str], failures: Mapping[str, str],
              generated_at: datetime | None = None, fields: Sequence[str] = LOAD_FIELDS) -> DataFrame:
    """One row: when the report was made, what its sources cover, which of them failed.

    ``latest_source_reference`` is the last stated period in dataset-key order;
    ``last_success_reference`` is the newest one of a successful load.  The load
    log is read once and partially aggregated; what is collected is one record
    per listed dataset.
    """
    known = [iso_timestamp(f).alias(f) if f == "loaded_at" else F.col(f) for f in fields if f in loads.columns]
    newest = F.struct("loaded_at", *[c for c in ("load_id",) if c in loads.columns])
    stated = F.col("reference_period") != ""
    good = F.when((F.col("status") == "success") & stated, F.struct("loaded_at", "dataset_key", "reference_period"))
    per_key = (
        loads.filter(F.col("dataset_key").isin(*keys))
        .groupBy("dataset_key")
        .agg(F.max_by(F.struct(*known), newest).alias("record"), F.max(good).alias("good"))
    )
    failed = sorted(k for k in keys if k in failures)
    errors = [F.struct(F.lit(k).alias("dataset_key"), F.lit(failures[k]).alias("error")) for k in failed]
    periods = F.transform(
        F.filter("sources", lambda r: r["reference_period"] != ""),
        lambda r: F.struct(r["dataset_key"].alias("dataset_key"), r["reference_period"].alias("reference_period")),
    )
    return per_key.agg(F.array_sort(F.collect_list("record")).alias("sources"), F.max("good").alias("good")).select(
        F.lit(generated_at.isoformat() if generated_at else None).cast("string").alias("generated_at"),
        F.array_max(periods)["reference_period"].alias("latest_source_reference"),
        F.col("good.reference_period").alias("last_success_reference"),
        F.lit(bool(failed)).alias("stale"),
        F.array(*errors).cast("array<struct<dataset_key:string,error:string>>").alias("failed_sources"),
        "sources",
    )


def freshness_rows(loads: DataFrame, keys: Sequence[str], failures: Mapping[str, str]) -> DataFrame:
    """The freshness report as one row per dataset, with the report-wide fields on each."""
    report = freshness(loads, keys, failures).select("*", F.explode("sources").alias("_record"))
    own = F.filter("failed_sources", lambda f: f["dataset_key"] == F.col("_record.dataset_key"))
    return report.select(
        "_record.*",
        F.get(own, F.lit(0))["error"].alias("error"),
        (F.size(own) > 0).alias("failed_now"),
        "latest_source_reference", "last_success_reference", "stale",
    )
