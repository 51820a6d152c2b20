"""The nine loads of the warehouse, declared over extracts in a landing folder.

Downloads are somebody else's; what lies in the landing folder is read with
the reader its source needs, shaped by its load and written to its table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from statmart import codes, schemas
from statmart.operators.lineage import SourceMeta
from statmart.plans import loads
from statmart.plans.refresh import Built, Load
from statmart.sources.catalog import best_resources
from statmart.sources.delimited import (
    BROKEN,
    FAIL,
    MARK,
    read_admin_tsv,
    read_stat_csv,
    select_columns,
    split_rejects,
)
from statmart.sources.grid import read_grid


@dataclass(frozen=True)
class Resource:
    """Where an extract lies, and which resource of the source it came from."""

    path: str
    id: str | None = None
    name: str | None = None


def chosen_resources(catalog: DataFrame, keywords: Sequence[str], by: str = "dataset_key", required: Sequence[str] = (),
                     pinned: Sequence[str] = (), path: str = "url") -> dict[str, Resource]:
    """The best resource of every dataset in a catalog: one row per dataset."""
    best = best_resources(catalog, [by], keywords, required, pinned=pinned)
    return {r[by]: Resource(r[path], r["id"], r["name"]) for r in best.select(by, path, "id", "name").collect()}


def census_extract(spark: SparkSession, path: str, surplus: str = FAIL) -> DataFrame:
    """The wide census extract; only the columns the loads use are kept."""
    fixed = ["REF_DATE", "GEO", codes.CENSUS_CITIZENSHIP, codes.CENSUS_BIRTHPLACE, *codes.CENSUS_MEMBERS, BROKEN, "_file"]
    return select_columns(read_stat_csv(spark, path, surplus=surplus), fixed, lambda name: name.startswith(codes.CENSUS_STATUS_PREFIX))


def landing_loads(spark: SparkSession, found: Mapping[str, Resource], cells: DataFrame | None = None,
                  geo: str | None = codes.FOCUS_GEO, npr_types: Mapping[str, str] = codes.NPR_TYPE_CODES,
                  npr_column: str = "Non-permanent resident types", most_rejects: int = 0) -> list[Load]:
    """All nine loads; a table whose extract was not found fails, or is skipped where it is optional.

    ``found`` names the extracts by table; the asylum worksheet is read from
    its delimited export, or given as ``cells``. Rows with more fields than
    columns are kept as rejects; more than ``most_rejects`` of them fail a load.
    """
    def load(table: schemas.Table, family: str, read: Callable[[str], DataFrame], shape: Callable[[DataFrame], DataFrame],
             period: str, constants: Mapping[str, object], cadence: str, optional: bool = False) -> Load:
        resource = found.get(table.name)
        meta = SourceMeta(
            table.name, table.name, family, resource.id if resource else None, resource.name if resource else None, cadence
        )

        def build() -> Built | None:
            if resource is None:
                return None
            good, rejects = split_rejects(read(resource.path))
            return Built(shape(good), rejects)

        return Load(meta, table, build, constants, period, optional, needs_rows=True, most_rejects=most_rejects)

    def csv(path: str) -> DataFrame:
        return read_stat_csv(spark, path, with_order=True, surplus=MARK)

    def census(path: str) -> DataFrame:
        return census_extract(spark, path, surplus=MARK)

    def tsv(path: str) -> DataFrame:
        return read_admin_tsv(spark, path, surplus=MARK)

    def asylum_rows() -> DataFrame | None:
        sheet = found.get(schemas.ASYLUM.name)
        if sheet is None and cells is None:
            return None
        return loads.asylum_claimants(read_grid(spark, sheet.path) if sheet else cells)

    table_of = {"source_table": "landing"}
    whole = {"province": codes.NO_DIMENSION, "source_dataset": "landing"}
    sheet = found.get(schemas.ASYLUM.name)
    asylum = Load(
        SourceMeta(schemas.ASYLUM.name, schemas.ASYLUM.name, "ircc", sheet.id if sheet else None, sheet.name if sheet else None, "Monthly"),
        schemas.ASYLUM, asylum_rows, whole, "ref_year",
    )
    return [
        load(schemas.POPULATION, "statcan", csv, lambda raw: loads.population_quarterly(raw, geo), "ref_date", table_of, "Quarterly"),
        load(schemas.NPR, "statcan", csv, lambda raw: loads.npr_by_type(raw, npr_types, npr_column), "ref_date", table_of, "Quarterly"),
        load(schemas.STATUS_CENSUS, "statcan", census, lambda raw: loads.status_breakdown(raw, geo), "census_year", table_of, "Every 5 years"),
        load(schemas.NATURALIZED, "statcan", census, lambda raw: loads.naturalized_by_country(raw, geo), "census_year", table_of, "Every 5 years"),
        load(schemas.STUDY, "ircc", tsv, loads.permits_by_country, "ref_year", {**whole, "study_level": codes.NO_DIMENSION}, "Monthly"),
        load(schemas.WORK, "ircc", tsv, loads.permits_by_country, "ref_year", {**whole, "program_stream": "work_permit"}, "Monthly"),
        load(schemas.WORK_PROGRAMS, "ircc", tsv, loads.work_permit_programs, "ref_year", {"source_dataset": "landing"}, "Monthly", optional=True),
        asylum,
        load(schemas.PERMANENT, "ircc", tsv, loads.permits_by_country, "ref_year", {**whole, "immigration_category": "permanent_resident"}, "Monthly"),
    ]
