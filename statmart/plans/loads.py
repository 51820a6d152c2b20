"""Raw extract to warehouse rows, one function per source.

Every function takes and returns lazy frames; writing, key checks and load
records are the refresh's business (``plans.refresh``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart import codes
from statmart.functions import (
    code_for,
    is_region,
    parse_count,
    program_code,
    quarter_start,
    starts_with,
)
from statmart.operators.dedupe import keep_first
from statmart.operators.rollup import annual_rollup
from statmart.sources.delimited import SOURCE_ORDER, column_tagged, first_present
from statmart.sources.grid import unpivot_year_totals


def population_quarterly(raw: DataFrame, geo: str | None = codes.FOCUS_GEO,
                         order: Sequence[str] = SOURCE_ORDER) -> DataFrame:
    """Quarterly population of one geography, or of all with ``geo=None``."""
    kept = raw.dropna(subset=["GEO", "VALUE"])
    if geo is not None:
        kept = kept.filter(F.col("GEO") == geo)
    rows = kept.select(
        quarter_start("REF_DATE").alias("ref_date"),
        F.trim("GEO").alias("geo"),
        parse_count("VALUE", strip_commas=False).alias("population"),
        *order,
    )
    return keep_first(rows, ["ref_date", "geo"], list(order)).drop(*order)


def npr_by_type(raw: DataFrame, types: Mapping[str, str] = codes.NPR_TYPE_CODES,
                type_column: str = "Non-permanent resident types",
                order: Sequence[str] = SOURCE_ORDER) -> DataFrame:
    """Non-permanent residents by type code, all geographies."""
    kind = F.col(f"`{type_column}`")
    rows = raw.filter(kind.isin(*types)).dropna(subset=["GEO", "VALUE"]).select(
        quarter_start("REF_DATE").alias("ref_date"),
        F.trim("GEO").alias("geo"),
        code_for(kind, types).alias("npr_type"),
        parse_count("VALUE", strip_commas=False).alias("count"),
        *order,
    )
    return keep_first(rows, ["ref_date", "geo", "npr_type"], list(order)).drop(*order)


def _census_rows(raw: DataFrame, geo: str | None) -> DataFrame:
    kept = raw
    for column, member in codes.CENSUS_MEMBERS.items():
        kept = kept.filter(F.col(f"`{column}`") == member)
    return kept if geo is None else kept.filter(F.col("GEO") == geo)


def _census_count(raw: DataFrame, tag: str, required: bool) -> Column | None:
    column = column_tagged(raw, codes.CENSUS_STATUS_PREFIX, codes.CENSUS_STATUS_TAGS[tag], required)
    return None if column is None else parse_count(column, strip_commas=False)


def _census_year() -> Column:
    return F.substring(F.col("REF_DATE").cast("string"), 1, 4).try_cast("int").alias("census_year")


def status_breakdown(raw: DataFrame, geo: str | None = codes.FOCUS_GEO) -> DataFrame:
    """Census counts by status: a citizenship row gives none, one or two status rows."""
    citizenship = F.col(f"`{codes.CENSUS_CITIZENSHIP}`")
    birthplace = F.col(f"`{codes.CENSUS_BIRTHPLACE}`")
    total = _census_count(raw, "total", required=True)
    members = [
        (codes.CITIZEN_BY_BIRTH, "canadian_born", total),
        (codes.CITIZEN_NATURALIZED, "naturalized", total),
        (codes.NOT_CITIZEN, "permanent_resident", _census_count(raw, "immigrant", required=False)),
        (codes.NOT_CITIZEN, "non_permanent_resident", _census_count(raw, "non_permanent", required=False)),
    ]
    emitted = F.array(*[
        F.struct(F.lit(status).alias("status"), F.when(citizenship == member, count).alias("count"))
        for member, status, count in members
        if count is not None
    ])
    return (
        _census_rows(raw, geo)
        .filter(starts_with(birthplace, "Total", when_null=False))
        .filter(citizenship.isin(codes.CITIZEN_BY_BIRTH, codes.CITIZEN_NATURALIZED, codes.NOT_CITIZEN))
        .select(_census_year(), F.col("GEO").alias("geo"), F.inline(emitted))
        .filter(F.col("count").isNotNull())
    )


def naturalized_by_country(raw: DataFrame, geo: str | None = codes.FOCUS_GEO,
                           regions: codes.RegionRules = codes.CORRECTED_REGIONS) -> DataFrame:
    """Naturalised citizens by birth country: regions, totals and empty counts removed."""
    birthplace = F.col(f"`{codes.CENSUS_BIRTHPLACE}`")
    rows = (
        _census_rows(raw, geo)
        .filter(F.col(f"`{codes.CENSUS_CITIZENSHIP}`") == codes.CITIZEN_NATURALIZED)
        .filter(~starts_with(birthplace, "Total", when_null=True))
        .select(
            _census_year(),
            F.trim(birthplace).alias("country"),
            _census_count(raw, "total", required=True).alias("count"),
        )
    )
    return rows.filter((F.col("count") > 0) & ~is_region("country", regions))


def permits_by_country(raw: DataFrame, year: str = "EN_YEAR", country: str = "EN_COUNTRY_OF_CITIZENSHIP",
                       total: str = "TOTAL", strip_commas: bool = True) -> DataFrame:
    """Yearly totals by country from a monthly permit or admission extract."""
    return annual_rollup(raw, year, country, "country", total, strip_commas).withColumn(
        "ref_month", F.lit(codes.WHOLE_YEAR)
    )


def work_permit_programs(raw: DataFrame, year: str = "EN_YEAR", total: str = "TOTAL",
                         candidates: Sequence[str] = codes.PROGRAM_COLUMNS,
                         strip_commas: bool = True) -> DataFrame:
    """Yearly totals by program code; the program column is the first candidate present."""
    sums = annual_rollup(raw, year, first_present(raw, candidates), "program_stream", total, strip_commas,
                         # An empty cell is a program of its own, not a missing key.
                         clean=lambda text: program_code(F.coalesce(text, F.lit(""))))
    return sums.withColumn("ref_month", F.lit(codes.WHOLE_YEAR))


def asylum_claimants(cells: DataFrame) -> DataFrame:
    """Asylum claimants by country and year from a pivoted worksheet."""
    return unpivot_year_totals(cells).drop("sheet", "row_idx")
