"""Published documents: marts nested into one JSON document each.

A document has a head, one row whose sections are few rows by definition (a
top-k, the codes of a list, the listed sources), and sections that grow with
the tables, which are published row by row beside it, in parallel. Every mart
is stated once per document.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart import codes, schemas
from statmart.functions import code_for
from statmart.operators import lineage
from statmart.plans import marts
from statmart.session import one_row
from statmart.sources.warehouse import latest_rows
from statmart.sinks.documents import (
    PublishedSet,
    discard_set,
    new_set,
    publish_document,
    publish_rows,
    publish_set,
)
from statmart.sources.warehouse import latest_rows

Tables = Mapping[str, DataFrame]

# Titles of the sources and frequencies, as published.
POPULATION_SOURCE = "Statistics Canada 17-10-0009-01"
NPR_SOURCE = "Statistics Canada 17-10-0121-01"
NATURALIZED_SOURCE = "Statistics Canada 98-10-0302-01"
PROGRAMS_SOURCE = "IRCC work permit holders by program"
PERMANENT_SOURCE = "IRCC Permanent Residents — open.canada.ca"
PERMITS_SOURCE = "IRCC open.canada.ca"
QUARTERLY = "Quarterly"
MONTHLY = "Monthly"
MONTHLY_AS_ANNUAL = "Monthly aggregated to annual"
ANNUAL_OF_MONTHLY = "Annual aggregation of monthly data"
EVERY_CENSUS = "Census (every 5 years)"


@dataclass(frozen=True)
class Document:
    """What is published under one name.

    ``head`` is one row; ``rows`` are the sections published row by row;
    ``if_any`` names the head's column that is null when there is nothing to
    publish.
    """

    head: DataFrame
    rows: Mapping[str, DataFrame] = field(default_factory=dict)
    if_any: str | None = None


@dataclass(frozen=True)
class Export:
    """What a publication depends on, beside the tables."""

    as_of: int
    geo: str = codes.FOCUS_GEO
    k: int = 10
    generated_at: datetime | None = None
    failures: Mapping[str, str] = field(default_factory=dict)
    first_annual_year: int = 2015
    first_quarterly_year: int = 2021
    history_since: str = "2000-01-01"
    places: codes.PlaceRules = codes.DEFAULT_PLACES


def _one(tables: Tables, columns: Mapping[str, Column | object], facts: DataFrame | None = None) -> DataFrame:
    """A one-row document with the given fields; ``facts`` is a row they may refer to."""
    row = one_row(next(iter(tables.values())).sparkSession) if facts is None else facts
    return row.select(*[
        (value if isinstance(value, Column) else F.lit(value)).alias(name) for name, value in columns.items()
    ])


def _list(order: Sequence[Column], fields: Sequence[str], when: Column | None = None) -> Column:
    """Rows that are few by definition as an ordered array, as an aggregate."""
    rank = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])
    row = F.struct(rank.alias("rank"), F.struct(*fields).alias("row"))
    return F.transform(F.array_sort(F.collect_list(row if when is None else F.when(when, row))), lambda r: r["row"])


def _by_count() -> list[Column]:
    return [F.col("count").isNull(), -F.col("count"), F.col("country")]


def freshness(tables: Tables, keys: Sequence[str], export: Export) -> Column:
    """The freshness report of a document's sources."""
    report = lineage.freshness(tables[schemas.LOADS.name], keys, export.failures, export.generated_at)
    return report.select(F.struct("*")).scalar()


def population_current(tables: Tables, export: Export) -> Document:
    latest = marts.population_latest(tables[schemas.POPULATION.name], export.geo)
    facts = latest.agg(F.first("population").alias("population"), F.first("ref_date").alias("ref_date"))
    return Document(_one(tables, {
        "population": F.col("population"),
        "ref_date": F.col("ref_date"),
        "source": POPULATION_SOURCE,
        "frequency": QUARTERLY,
        "freshness": freshness(tables, [schemas.POPULATION.name], export),
    }, facts), if_any="ref_date")


def population_history(tables: Tables, export: Export) -> Document:
    rows = marts.population_history(tables[schemas.POPULATION.name], export.geo, export.history_since)
    return Document(_one(tables, {
        "source": POPULATION_SOURCE,
        "frequency": QUARTERLY,
        "freshness": freshness(tables, [schemas.POPULATION.name], export),
    }), {"data": rows})


def _status(tables: Tables, export: Export) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession
    return marts.status_estimates(
        spark, tables[schemas.POPULATION.name], tables[schemas.NPR.name], tables[schemas.STATUS_CENSUS.name], export.geo
    )


def status_breakdown(tables: Tables, export: Export) -> Document:
    snapshots = marts.census_snapshots(tables[schemas.STATUS_CENSUS.name], export.geo)
    place = {s: i for i, s in enumerate(codes.STATUS_LABELS)}
    order = [code_for("status", place)]
    fields = ["status", "label", "count", "ref_date", "source"]
    actual, estimated = F.col("mode") == "actual", F.col("mode") == "estimated"
    temporary = F.col("status") == codes.TEMPORARY_STATUS
    facts = _status(tables, export).agg(
        _list(order, fields, actual).alias("actual"),
        F.sum(F.when(actual, F.col("count"))).alias("actual_total"),
        _list(order, fields, estimated).alias("estimated"),
        F.sum(F.when(estimated, F.col("count"))).alias("estimated_total"),
        F.max("population").alias("population"),
        F.max(F.when(estimated & ~temporary, F.col("ref_date"))).alias("population_date"),
        F.max(F.when(temporary, F.col("ref_date"))).alias("temporary_date"),
    )
    census = tables[schemas.STATUS_CENSUS.name].filter((F.col("geo") == export.geo) & F.col("count").isNotNull())
    census_year = F.coalesce(census.agg(F.max("census_year")).scalar(), F.lit(codes.DEFAULT_CENSUS_YEAR))
    return Document(_one(tables, {
        "actual_latest": F.struct(F.col("actual").alias("rows"), F.col("actual_total").alias("total")),
        "estimated_latest": F.struct(
            F.col("estimated").alias("rows"),
            F.col("estimated_total").alias("total"),
            F.col("population").alias("reconciles_to_population_total"),
            F.col("population_date").alias("ref_date"),
        ),
        "latest_census_year": census_year,
        "source_dates": F.struct(
            F.col("population_date").alias("population_current"),
            F.col("temporary_date").alias("npr_current"),
            census_year.cast("string").alias("census_status"),
        ),
        "methodology": F.struct(
            F.lit("Temporary residents are the newest quarterly total. All other residents are the newest population "
                  "less that total, split by census shares, so the estimate adds up to the population.").alias("summary"),
            F.lit("Newest published figure of each status.").alias("actual_definition"),
            F.lit("All statuses at the date of the newest population.").alias("estimated_definition"),
        ),
        "freshness": freshness(
            tables, [schemas.POPULATION.name, schemas.NPR.name, schemas.STATUS_CENSUS.name], export
        ),
    }, facts), {"census_snapshots": snapshots})


def visa_streams_current(tables: Tables, export: Export) -> Document:
    streams = marts.streams_latest(tables[schemas.NPR.name], export.geo)
    # One row per stream code.
    facts = streams.agg(
        F.max("ref_date").alias("ref_date"), F.sum("count").alias("total"),
        _list([-F.col("count"), F.col("stream")], ["stream", "count", "pct"]).alias("streams"),
    )
    return Document(_one(tables, {
        "ref_date": F.col("ref_date"),
        "total_npr": F.col("total"),
        "streams": F.col("streams"),
        "source": NPR_SOURCE,
        "frequency": QUARTERLY,
        "freshness": freshness(tables, [schemas.NPR.name], export),
    }, facts), if_any="ref_date")


PERMITS = {"study": schemas.STUDY.name, "work": schemas.WORK.name, "asylum": schemas.ASYLUM.name}


def _permits(tables: Tables) -> DataFrame:
    return marts.tag_facts({stream: tables[name] for stream, name in PERMITS.items()})


def _latest_permits(tables: Tables, export: Export) -> DataFrame:
    """Every permit table, in its own latest complete year."""
    return marts.tag_facts({stream: latest_rows(tables, name, export.as_of) for stream, name in PERMITS.items()})


def visa_streams_history(tables: Tables, export: Export) -> Document:
    rows = marts.streams_history(
        tables[schemas.NPR.name], _permits(tables), export.geo, export.first_annual_year, export.first_quarterly_year
    )
    meta = [
        x
        for series, (label, group) in codes.SERIES_META.items()
        for x in (F.lit(series), F.struct(F.lit(label).alias("label"), F.lit(group).alias("group")))
    ]
    return Document(_one(tables, {
        "series_meta": F.create_map(*meta),
        "note": "Quarterly figures where there are any; earlier years are annual permit totals.",
        "freshness": freshness(
            tables, [schemas.NPR.name, schemas.STUDY.name, schemas.WORK.name, schemas.ASYLUM.name], export
        ),
    }), {"data": rows.select("date", "stream", "count", "cadence", "source_origin")})


def work_permit_sources(tables: Tables, export: Export) -> Document:
    programs = latest_rows(tables, schemas.WORK_PROGRAMS.name)
    # One row per program code.
    facts = marts.program_shares(programs).agg(
        F.max("ref_year").alias("listed_year"), F.count("*").alias("n"), F.sum("count").alias("total"),
        _list([-F.col("count"), F.col("stream")], ["stream", "count", "pct"]).alias("streams"),
    )
    year = F.coalesce("listed_year", programs.agg(F.max("ref_year")).scalar())
    return Document(_one(tables, {
        "available": F.col("n") > 0,
        "ref_year": year,
        "total": F.coalesce("total", F.lit(0).cast("bigint")),
        "streams": F.col("streams"),
        "source": PROGRAMS_SOURCE,
        "frequency": MONTHLY_AS_ANNUAL,
        "note": "Filled when a program-level extract has been loaded.",
        "freshness": freshness(tables, [schemas.WORK_PROGRAMS.name], export),
    }, facts))


def origin_pr_current(tables: Tables, export: Export) -> Document:
    top = marts.origin_top(latest_rows(tables, schemas.PERMANENT.name, export.as_of), export.as_of, export.k, export.places)
    facts = top.agg(F.max("ref_year").alias("ref_year"), _list(_by_count(), ["country", "count"]).alias("top"))
    return Document(_one(tables, {
        "ref_year": F.col("ref_year"),
        f"top{export.k}": F.col("top"),
        "source": PERMANENT_SOURCE,
        "frequency": MONTHLY,
        "freshness": freshness(tables, [schemas.PERMANENT.name], export),
    }, facts), if_any="ref_year")


def origin_pr_history(tables: Tables, export: Export) -> Document:
    rows = marts.origin_history(tables[schemas.PERMANENT.name], export.k, export.places)
    return Document(_one(tables, {
        "note": f"The {export.k} countries with the greatest sums over all years.",
        "source": PERMANENT_SOURCE,
        "frequency": ANNUAL_OF_MONTHLY,
        "freshness": freshness(tables, [schemas.PERMANENT.name], export),
    }), {"data": rows})


def origin_temp_current(tables: Tables, export: Export) -> Document:
    # The year and the list of each stream come out of the same sums.
    facts = marts.temporary_lists(_latest_permits(tables, export), export.as_of, export.k, export.places).agg(
        F.map_from_entries(F.collect_list(F.struct("stream", F.struct("ref_year", "top")))).alias("streams")
    )
    nothing = F.array().cast("array<struct<country:string,count:bigint>>")

    def stream(name: str, *more: Column) -> Column:
        own = F.try_element_at("streams", F.lit(name))
        return F.struct(own["ref_year"].alias("ref_year"), F.coalesce(own["top"], nothing).alias(f"top{export.k}"), *more)

    note = F.lit("Scaled to the temporary resident total in the origin overview.").alias("note")
    return Document(_one(tables, {
        "study_permits": stream("study"),
        "work_permits": stream("work"),
        "asylum_claimants": stream("asylum", note),
        "source": PERMITS_SOURCE,
        "frequency": MONTHLY,
        "freshness": freshness(tables, [schemas.STUDY.name, schemas.WORK.name, schemas.ASYLUM.name], export),
    }, facts))


def origin_naturalized(tables: Tables, export: Export) -> Document:
    table = tables[schemas.NATURALIZED.name]
    rows = marts.naturalized_all(table, export.places)
    top = marts.naturalized_top(table, export.k, export.places)
    facts = top.agg(F.max("year").alias("listed_year"), _list(_by_count(), ["country", "count"]).alias("top"))
    return Document(_one(tables, {
        "latest_census_year": F.coalesce("listed_year", table.agg(F.max("census_year")).scalar()),
        f"top{export.k}": F.col("top"),
        "source": NATURALIZED_SOURCE,
        "frequency": EVERY_CENSUS,
        "freshness": freshness(tables, [schemas.NATURALIZED.name], export),
    }, facts), {"all_census_data": rows}, if_any="latest_census_year")


ESTIMATION_BASIS = {
    "foreign_born_total": "Sum of the three estimated categories.",
    "naturalized": "Latest census distribution, scaled to the estimated stock.",
    "permanent_resident": "Latest complete year of admissions, scaled to the estimated stock.",
    "temporary_resident": "Latest study, work and asylum distributions together, scaled to the newest total.",
}


def origin_overview(tables: Tables, export: Export) -> Document:
    facts = marts.origin_facts(
        latest_rows(tables, schemas.NATURALIZED.name), latest_rows(tables, schemas.PERMANENT.name, export.as_of),
        _latest_permits(tables, export),
    )
    rows = marts.origin_categories(facts, _status(tables, export), export.as_of, export.k, export.places)
    named = rows.withColumnsRenamed({"top": f"top{export.k}", "non_top": f"non_top_{export.k}"}).withColumns({
        "estimation_basis": code_for("category", ESTIMATION_BASIS),
        "is_estimated": F.lit(True),
    })
    place = {c: i for i, c in enumerate(codes.ORIGIN_CATEGORIES)}
    fields = ["category", "label", "total", f"top{export.k}", f"non_top_{export.k}", "source_period",
              "estimation_basis", "is_estimated"]
    sources = [
        schemas.NATURALIZED, schemas.PERMANENT, schemas.STUDY, schemas.WORK, schemas.ASYLUM, schemas.POPULATION,
        schemas.NPR, schemas.STATUS_CENSUS,
    ]
    return Document(_one(tables, {
        "categories": F.col("categories"),
        "methodology": F.struct(
            F.lit("Each category's newest country distribution is scaled to its newest estimated stock.").alias("summary"),
            F.lit("Naturalized citizens, permanent residents and temporary residents together.").alias(
                "foreign_born_definition"
            ),
        ),
        "freshness": freshness(tables, [t.name for t in sources], export),
    }, named.agg(_list([code_for("category", place)], fields).alias("categories"))))


Build = Callable[[Tables, Export], Document]

# Documents that name a column of their own for it are left out while it is null.
DOCUMENTS: dict[str, Build] = {
    "population_current.json": population_current,
    "population_history.json": population_history,
    "status_breakdown.json": status_breakdown,
    "visa_streams_current.json": visa_streams_current,
    "visa_streams_history.json": visa_streams_history,
    "work_permit_sources_current.json": work_permit_sources,
    "origin_pr_current.json": origin_pr_current,
    "origin_pr_history.json": origin_pr_history,
    "origin_temp_current.json": origin_temp_current,
    "origin_naturalized.json": origin_naturalized,
    "origin_overview.json": origin_overview,
}


def section_path(folder: str, name: str, section: str) -> str:
    """Where a section published row by row lies: beside its document."""
    return f"{folder.rstrip('/')}/{name.removesuffix('.json')}.{section}.jsonl"


def publish(document: Document, folder: str, name: str) -> bool:
    """Publish a document and its sections; the sections first, so that a head never lacks them."""
    head = document.head
    if document.if_any:
        head = head.filter(F.col(document.if_any).isNotNull())
    for section, rows in document.rows.items():
        publish_rows(rows, section_path(folder, name, section))
    return publish_document(head, f"{folder.rstrip('/')}/{name}")


def export_all(tables: Tables, folder: str, export: Export, run_id: str = "") -> list[str]:
    """Publish every document that has rows as one set, and return their names.

    If one of them fails, the set published before stays as it is.
    """
    spark = next(iter(tables.values())).sparkSession
    at = new_set(folder)
    written: dict[str, dict[str, str]] = {}
    try:
        for name, build in DOCUMENTS.items():
            document = build(tables, export)
            if publish(document, at, name):
                written[name] = {section: section_path("", name, section).lstrip("/") for section in document.rows}
        skipped = [name for name in DOCUMENTS if name not in written]
        publish_set(spark, folder, PublishedSet(run_id, at, written, skipped))
    except Exception:
        discard_set(spark, folder, at)
        raise
    return list(written)
