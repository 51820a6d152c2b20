"""Warehouse tables: one schema and one key per table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


@dataclass(frozen=True)
class Table:
    """A warehouse table: columns, key, and the column its slices are cut by.

    Tables that are replaced whole may be laid out by their period, so that a
    reader of one period opens no other file.
    """

    name: str
    columns: tuple[tuple[str, str, bool], ...]
    key: tuple[str, ...]
    slice_by: str | None = None
    laid_out_by: str | None = None

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, _TYPES[t], nullable) for n, t, nullable in self.columns])

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(n for n, _, nullable in self.columns if not nullable)


def _table(name: str, ddl: str, key: tuple[str, ...], slice_by: str | None = None, laid_out_by: str | None = None) -> Table:
    """A table from its column list: name, type, and ``NOT NULL`` where a value is required."""
    columns = []
    for item in ddl.split(","):
        column, kind, *required = item.split()
        columns.append((column, kind, required != ["NOT", "NULL"]))
    return Table(name, tuple(columns), key, slice_by, laid_out_by)


# Names, columns, types and keys of the warehouse tables.
POPULATION = _table(
    "population_quarterly",
    """
    ref_date date NOT NULL,
    geo string NOT NULL,
    population bigint NOT NULL,
    source_table string NOT NULL,
    loaded_at timestamp NOT NULL
    """,
    ("ref_date", "geo"),
    slice_by="geo",
)
STATUS_CENSUS = _table(
    "status_breakdown_census",
    """
    census_year int NOT NULL,
    geo string NOT NULL,
    status string NOT NULL,
    count bigint,
    source_table string NOT NULL,
    loaded_at timestamp NOT NULL
    """,
    ("census_year", "geo", "status"),
    slice_by="geo",
)
NPR = _table(
    "npr_by_type_quarterly",
    """
    ref_date date NOT NULL,
    geo string NOT NULL,
    npr_type string NOT NULL,
    count bigint,
    source_table string NOT NULL,
    loaded_at timestamp NOT NULL
    """,
    ("ref_date", "geo", "npr_type"),
    laid_out_by="ref_date",
)
STUDY = _table(
    "study_permits_monthly",
    """
    ref_year int NOT NULL,
    ref_month int NOT NULL,
    country string NOT NULL,
    study_level string NOT NULL,
    province string NOT NULL,
    count bigint,
    source_dataset string NOT NULL,
    loaded_at timestamp NOT NULL
    """,
    ("ref_year", "ref_month", "country", "study_level", "province"),
    laid_out_by="ref_year",
)
WORK = _table(
    "work_permits_monthly",
    """
    ref_year int NOT NULL,
    ref_month int NOT NULL,
    program_stream string NOT NULL,
    country string NOT NULL,
    province string NOT NULL,
    count bigint,
    source_dataset string NOT NULL,
    loaded_at timestamp NOT NULL
    """,
    ("ref_year", "ref_month", "program_stream", "country", "province"),
    laid_out_by="ref_year",
)
WORK_PROGRAMS = _table(
    "work_permit_programs_monthly",
    """
    ref_year int NOT NULL,
    ref_month int NOT NULL,
    program_stream string NOT NULL,
    count bigint,
    source_dataset string NOT NULL,
    loaded_at timestamp NOT NULL
    """,
    ("ref_year", "ref_month", "program_stream"),
    laid_out_by="ref_year",
)
ASYLUM = _table(
    "asylum_claimants_monthly",
    """
    ref_year int NOT NULL,
    ref_month int NOT NULL,
    country string NOT NULL,
    province string NOT NULL,
    count bigint,
    source_dataset string NOT NULL,
    loaded_at timestamp NOT NULL
    """,
    ("ref_year", "ref_month", "country", "province"),
    laid_out_by="ref_year",
)
PERMANENT = _table(
    "permanent_residents_monthly",
    """
    ref_year int NOT NULL,
    ref_month int NOT NULL,
    immigration_category string NOT NULL,
    country string NOT NULL,
    province string NOT NULL,
    count bigint,
    source_dataset string NOT NULL,
    loaded_at timestamp NOT NULL
    """,
    ("ref_year", "ref_month", "immigration_category", "country", "province"),
    laid_out_by="ref_year",
)
NATURALIZED = _table(
    "naturalized_by_country_census",
    """
    census_year int NOT NULL,
    country string NOT NULL,
    count bigint,
    source_table string NOT NULL,
    loaded_at timestamp NOT NULL
    """,
    ("census_year", "country"),
    laid_out_by="census_year",
)
RUNS = _table(
    "pipeline_runs",
    """
    run_id string NOT NULL,
    started_at timestamp NOT NULL,
    finished_at timestamp,
    status string NOT NULL,
    sources_fetched array<string>,
    notes string
    """,
    ("run_id", "started_at", "status"),
)
LOADS = _table(
    "source_loads",
    """
    load_id string NOT NULL,
    run_id string NOT NULL,
    dataset_key string NOT NULL,
    source_family string NOT NULL,
    source_id string NOT NULL,
    resource_id string,
    resource_name string,
    reference_period string,
    cadence string,
    status string NOT NULL,
    loaded_at timestamp NOT NULL,
    notes string
    """,
    ("load_id",),
)
#: Rows of extracts that no load could use; kept beside the tables, not one of them.
REJECTS = _table(
    "rejected_rows",
    """
    run_id string NOT NULL,
    dataset_key string NOT NULL,
    file string NOT NULL,
    reason string NOT NULL,
    first_field string,
    line string NOT NULL,
    loaded_at timestamp NOT NULL
    """,
    ("run_id", "dataset_key", "file", "line"),
)

TABLES = {
    t.name: t
    for t in (
        POPULATION, STATUS_CENSUS, NPR, STUDY, WORK, WORK_PROGRAMS, ASYLUM, PERMANENT, NATURALIZED, RUNS, LOADS,
    )
}
