"""Every registered query: a function of the session and the table folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statmart import codes, schemas
from statmart import functions as fn
from statmart.operators import dedupe, lineage, rollup, series
from statmart.operators.apportion import apportion
from statmart.plans import documents, loads, marts, views
from statmart.plans.landing import Resource, chosen_resources, landing_loads
from statmart.plans.refresh import load_all, refresh
from statmart.session import materialized, scratch_path
from statmart.sinks import (
    append_rows,
    logs,
    publish_document,
    rejects,
    replace_slice,
    replace_table,
    shape_for,
    versions,
)
from statmart.sinks.documents import published_set
from statmart.sources import catalog, grid, warehouse
from statmart.suite.fixtures import AS_OF, GEO, PLACES, STREAMS, Fixtures, thirds

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Fixtures], DataFrame]], Query]:
    """Register a function of the fixture views under a query name."""

    def add(build: Callable[[Fixtures], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Fixtures(spark, folder))

        QUERIES[name] = run
        return run

    return add


# -- population and dates ------------------------------------------------------


@query("population_latest")
def _(fx):
    return marts.population_latest(fx.population, GEO)


@query("population_history")
def _(fx):
    return marts.population_history(fx.population, GEO)


@query("population_year_window")
def _(fx):
    return views.population_in_years(marts.population_history(fx.population, GEO, since="1995-01-01"), 1997, 1999)


@query("population_years")
def _(fx):
    return series.years_present(marts.population_history(fx.population, GEO, since="1995-01-01"), F.year("date"))


@query("quarter_start_dates")
def _(fx):
    month = F.date_format("o_orderdate", "yyyy-MM")
    return fx.table("orders").select(fn.quarter_start(month).alias("ref_date")).distinct().orderBy("ref_date")


# -- streams -------------------------------------------------------------------


@query("streams_latest_share")
def _(fx):
    return marts.streams_latest(fx.npr, GEO)


def _history(fx: Fixtures) -> DataFrame:
    return marts.streams_history(fx.npr, fx.permits, GEO, first_year=1995, before_year=2000)


@query("streams_history_blended")
def _(fx):
    return _history(fx)


@query("streams_pivot")
def _(fx):
    return views.streams_wide(_history(fx), 1996, 1999, [*STREAMS, *codes.ANNUAL_SERIES.values()])


_FIRST_CLASS = ("1-URGENT", "2-HIGH")
_LABELS = {"3-MEDIUM": "Medium", "5-LOW": "Low"}


@query("streams_grouped")
def _(fx):
    return views.streams_grouped(marts.streams_latest(fx.npr, GEO), _FIRST_CLASS, "First class", _LABELS)


@query("streams_grouped_absent")
def _(fx):
    return views.streams_grouped(marts.streams_latest(fx.npr, GEO), ("8-NONE", "9-NONE"), "None", _LABELS)


@query("stream_panels")
def _(fx):
    panels = {"First": _FIRST_CLASS, "Second": ("3-MEDIUM", "5-LOW", "9-NONE")}
    # Views read published rows; written once, their filters do not reach back into the mart.
    return views.stream_panels(materialized(marts.streams_latest(fx.npr, GEO)), panels, _LABELS)


# -- status --------------------------------------------------------------------


def _status(fx: Fixtures) -> DataFrame:
    return marts.status_estimates(fx.spark, fx.population, fx.npr, fx.census, GEO)


@query("status_actual_and_estimated")
def _(fx):
    return _status(fx)


@query("status_pivot")
def _(fx):
    return views.status_wide(marts.census_snapshots(fx.census, GEO), codes.RESIDENT_STATUSES)


@query("status_share")
def _(fx):
    return views.status_shares(_status(fx), "estimated")


@query("mode_select")
def _(fx):
    return views.status_shares(_status(fx), "actual").withColumn("label", fn.code_for("status", codes.STATUS_TREND_LABELS))


# -- loads ---------------------------------------------------------------------


@query("population_load")
def _(fx):
    return loads.population_quarterly(fx.population_raw, GEO, order=["_row"])


@query("npr_load")
def _(fx):
    types = {s: s.split("-")[1].lower().replace(" ", "_") for s in STREAMS[:4]}
    return loads.npr_by_type(fx.population_raw, types, "TYPE", order=["_row"])


@query("status_fanout")
def _(fx):
    return loads.status_breakdown(fx.census_raw, geo=None)


@query("naturalized_region_filter")
def _(fx):
    return loads.naturalized_by_country(fx.census_raw, geo="AFRICA")


@query("country_annual")
def _(fx):
    return loads.permits_by_country(fx.country_raw)


@query("country_annual_clean")
def _(fx):
    rows = fx.country_raw.withColumn("TOTAL", fn.drop_null_tokens("TOTAL"))
    return rollup.annual_rollup(rows, "EN_YEAR", "EN_COUNTRY_OF_CITIZENSHIP", "country", "TOTAL",
                                clean=lambda name: fn.place_name(name, PLACES))


@query("null_token_audit")
def _(fx):
    text = fn.drop_null_tokens("TOTAL")
    strict, lenient = fn.parse_count(text, strip_commas=False), fn.parse_count(text)
    return fx.country_raw.groupBy(fn.parse_count("EN_YEAR").cast("int").alias("ref_year")).agg(
        F.count("*").alias("n_rows"),
        F.count_if(text.isNull()).alias("n_suppressed"),
        F.count_if(F.col("TOTAL").contains(",")).alias("n_commas"),
        F.count(strict).alias("n_strict"),
        F.coalesce(F.sum(strict), F.lit(0).cast("bigint")).alias("sum_strict"),
        F.count(lenient).alias("n_lenient"),
        F.coalesce(F.sum(lenient), F.lit(0).cast("bigint")).alias("sum_lenient"),
    )


@query("programs_annual")
def _(fx):
    return loads.work_permit_programs(fx.programs_raw)


@query("programs_latest_share")
def _(fx):
    return views.program_cards(marts.program_shares(loads.work_permit_programs(fx.programs_raw)))


@query("unpivot_year_totals")
def _(fx):
    return grid.unpivot_year_totals(fx.sheet_cells)


@query("promote_header")
def _(fx):
    return grid.promote_header(fx.sheet_cells)


_WORDS = ["ring", "small", "red", "economy"]


@query("catalog_best_resource")
def _(fx):
    return catalog.best_resources(fx.catalog, ["dataset_id"], _WORDS, required=["e"], min_score=2)


@query("catalog_pinned")
def _(fx):
    return catalog.best_resources(fx.catalog, ["dataset_id"], _WORDS, required=["e"], min_score=2, pinned=[7, 8])


@query("dedupe_keep_first")
def _(fx):
    lines = fx.table("lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return dedupe.keep_first(lines, keys, [c for c in lines.columns if c not in keys])


@query("key_violations")
def _(fx):
    return dedupe.key_violations(fx.table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity"])


# -- origin --------------------------------------------------------------------


@query("latest_complete_year")
def _(fx):
    facts = marts.tag_facts({"permanent": fx.permanent}).unionByName(fx.permits)
    sums = rollup.sum_by(facts, ["stream", "ref_year"])
    return rollup.latest_period(sums, AS_OF, ["stream"])


@query("origin_top10")
def _(fx):
    return marts.origin_top(fx.permanent, AS_OF, places=PLACES)


@query("origin_top10_history")
def _(fx):
    return marts.origin_history(fx.permanent, places=PLACES)


@query("origin_countries_pivot")
def _(fx):
    history = marts.naturalized_all(fx.permanent.withColumnRenamed("ref_year", "census_year"), PLACES)
    return views.countries_wide(history, 10, 1996, 2000)


@query("origin_top_rows")
def _(fx):
    history = marts.naturalized_all(fx.permanent.withColumnRenamed("ref_year", "census_year"), PLACES)
    return views.top_country_rows(history, 5, 1997, 1999)


@query("origin_total_trend")
def _(fx):
    return views.yearly_totals(marts.origin_history(fx.permanent, places=PLACES), 1996, 2000)


@query("temp_top10_by_stream")
def _(fx):
    return marts.temporary_top(fx.permits, AS_OF, places=PLACES)


@query("naturalized_top10")
def _(fx):
    return marts.naturalized_top(fx.naturalized, places=PLACES)


@query("naturalized_all")
def _(fx):
    return marts.naturalized_all(fx.naturalized, PLACES)


@query("merge_counts")
def _(fx):
    frames = [fx.permits, fx.permanent]
    return rollup.merge_counts([marts.place_sums(f, [], PLACES) for f in frames], ["country"])


@query("apportion_by_category")
def _(fx):
    return apportion(fx.category_weights, thirds(fx.category_weights), ["category"], "country")


@query("apportion_large_groups")
def _(fx):
    return apportion(fx.part_weights, thirds(fx.part_weights), ["category"], "part")


@query("apportion_outlier")
def _(fx):
    # Equal weights, one key far before all others.
    key = F.when(F.col("part") == F.lit("Part#000000001"), "A").otherwise(F.col("part"))
    flat = fx.part_weights.select("category", key.alias("part"), F.lit(1).cast("bigint").alias("count"))
    return apportion(flat, thirds(flat), ["category"], "part")


@query("topk_with_other")
def _(fx):
    return views.top_with_other(fx.permanent, ["ref_year"], "country", k=5)


@query("origin_overview")
def _(fx):
    return marts.origin_overview(
        fx.spark, fx.population, fx.npr, fx.census, fx.naturalized, fx.permanent, fx.permits, AS_OF, GEO, places=PLACES
    )


@query("category_select")
def _(fx):
    facts = marts.origin_facts(fx.naturalized, fx.permanent, fx.permits)
    return views.category_rows(marts.origin_category(facts, _status(fx), AS_OF, "temporary_resident", 10, PLACES), "temporary_resident")


# -- lineage -------------------------------------------------------------------


@query("latest_load_per_key")
def _(fx):
    return lineage.latest_loads(fx.source_loads, ["click", "error", "view"])


@query("freshness_summary")
def _(fx):
    failures = {"error": "no resource found", "other": "not in this report"}
    return lineage.freshness_rows(fx.source_loads, ["click", "error", "purchase"], failures)


@query("reference_period")
def _(fx):
    quarters = rollup.reference_period(fx.population, "ref_date", codes.NO_PERIOD, ["geo"])
    years = rollup.reference_period(fx.permanent, "ref_year", codes.NO_PERIOD, ["country"])
    nothing = rollup.reference_period(fx.permanent.filter(F.col("ref_year") < 0), "ref_year", codes.NO_PERIOD)
    return (
        quarters.withColumnRenamed("geo", "dataset")
        .unionByName(years.withColumnRenamed("country", "dataset"))
        .unionByName(nothing.select(F.lit("nothing").alias("dataset"), "reference_period"))
    )


# -- sinks ---------------------------------------------------------------------


@query("slice_replace")
def _(fx):
    path = scratch_path(fx.spark, "population")
    rows = fx.population.select("ref_date", "population", "geo")
    replace_slice(rows, path, "geo")
    doubled = rows.filter(F.col("geo") == GEO).withColumn("population", F.col("population") * 2)
    replace_slice(doubled, path, "geo")
    return versions.frame(fx.spark, path, rows.schema)


@query("table_replace")
def _(fx):
    path = scratch_path(fx.spark, "naturalized")
    replace_table(fx.naturalized, path)
    kept = versions.frame(fx.spark, path, fx.naturalized.schema)
    replace_table(kept.filter(F.col("census_year") == 2000), path)
    return versions.frame(fx.spark, path, fx.naturalized.schema)


@query("mart_json")
def _(fx):
    path = scratch_path(fx.spark, "origin") + "/origin_pr_current.json"
    top = marts.origin_top(fx.permanent, AS_OF, places=PLACES)
    order = [-F.col("count"), F.col("country")]
    rows = rollup.collect_ordered(top, order, ["country", "count"], "top10")
    publish_document(rows.select(F.lit(None).cast("string").alias("note"), "top10"), path)
    schema = "note string, top10 array<struct<country:string,count:bigint>>"
    document = warehouse.read_document(fx.spark, path, schema)
    return document.select("note", F.posexplode("top10").alias("place", "row")).select(
        "note", "place", "row.country", "row.count"
    )


# -- documents: published from the fixture tables, read back, flattened ---------


def _publish(fx: Fixtures, name: str) -> str:
    """Publish one document from tables shaped like the warehouse; returns the folder."""
    by_stream = {s: fx.permits.filter(F.col("stream") == s).drop("stream") for s in ("study", "work", "asylum")}
    tables = {
        schemas.POPULATION: fx.population, schemas.NPR: fx.npr, schemas.STATUS_CENSUS: fx.census,
        schemas.STUDY: by_stream["study"], schemas.WORK: by_stream["work"], schemas.ASYLUM: by_stream["asylum"],
        schemas.WORK_PROGRAMS: loads.work_permit_programs(fx.programs_raw), schemas.PERMANENT: fx.permanent,
        schemas.NATURALIZED: fx.naturalized, schemas.LOADS: fx.dataset_loads,
    }
    export = documents.Export(
        as_of=AS_OF, geo=GEO, places=PLACES, first_annual_year=1995, first_quarterly_year=2000, failures={schemas.NPR.name: "no answer"}
    )
    folder = scratch_path(fx.spark, "published")
    documents.publish(documents.DOCUMENTS[name]({t.name: df for t, df in tables.items()}, export), folder, name)
    return folder


def _document(fx: Fixtures, name: str, schema: str) -> DataFrame:
    return warehouse.read_document(fx.spark, f"{_publish(fx, name)}/{name}", schema)


def _section(fx: Fixtures, name: str, section: str, schema: str) -> DataFrame:
    return fx.spark.read.schema(schema).json(documents.section_path(_publish(fx, name), name, section))


def _places(df: DataFrame, *others: str, at: str = "top10") -> DataFrame:
    return df.select(*others, F.posexplode(at).alias("place", "row")).select(*others, "place", "row.*")


_LISTED = "array<struct<country:string,count:bigint>>"


@query("doc_population_current")
def _(fx):
    return _document(fx, "population_current.json", "population bigint, ref_date date, source string, frequency string")


@query("doc_population_history")
def _(fx):
    return _section(fx, "population_history.json", "data", "date date, population bigint")


@query("doc_status_breakdown")
def _(fx):
    row = "array<struct<status:string,label:string,count:bigint,ref_date:date,source:string>>"
    doc = _document(fx, "status_breakdown.json", f"actual_latest struct<rows:{row},total:bigint>, estimated_latest struct<rows:{row},total:bigint>")
    modes = [
        F.struct(F.lit(mode).alias("mode"), F.col(f"{mode}_latest.total").alias("mode_total"), F.col(f"{mode}_latest.rows").alias("rows"))
        for mode in ("actual", "estimated")
    ]
    return doc.select(F.inline(F.array(*modes))).select("mode", "mode_total", F.inline("rows"))


@query("doc_census_snapshots")
def _(fx):
    return _section(fx, "status_breakdown.json", "census_snapshots", "year int, status string, count bigint")


@query("doc_visa_streams_current")
def _(fx):
    row = "array<struct<stream:string,count:bigint,pct:double>>"
    doc = _document(fx, "visa_streams_current.json", f"ref_date date, total_npr bigint, streams {row}")
    return _places(doc, "ref_date", "total_npr", at="streams")


@query("doc_visa_streams_history")
def _(fx):
    schema = "date date, stream string, count bigint, cadence string, source_origin string"
    return _section(fx, "visa_streams_history.json", "data", schema)


@query("doc_work_permit_sources")
def _(fx):
    row = "array<struct<stream:string,count:bigint,pct:double>>"
    doc = _document(fx, "work_permit_sources_current.json", f"available boolean, ref_year int, total bigint, streams {row}")
    return _places(doc, "available", "ref_year", "total", at="streams")


@query("doc_origin_pr_current")
def _(fx):
    return _places(_document(fx, "origin_pr_current.json", f"ref_year int, top10 {_LISTED}"), "ref_year")


@query("doc_origin_pr_history")
def _(fx):
    return _section(fx, "origin_pr_history.json", "data", "year int, country string, count bigint")


@query("doc_origin_temp_current")
def _(fx):
    fields = {"study": "study_permits", "work": "work_permits", "asylum": "asylum_claimants"}
    doc = _document(fx, "origin_temp_current.json", ", ".join(f"{f} struct<ref_year:int,top10:{_LISTED}>" for f in fields.values()))
    streams = [F.struct(F.lit(s).alias("stream"), F.col(f"{f}.ref_year"), F.col(f"{f}.top10")) for s, f in fields.items()]
    return _places(doc.select(F.inline(F.array(*streams))), "stream", "ref_year")


@query("doc_origin_naturalized")
def _(fx):
    return _places(_document(fx, "origin_naturalized.json", f"latest_census_year int, top10 {_LISTED}"), "latest_census_year")


@query("doc_naturalized_all")
def _(fx):
    return _section(fx, "origin_naturalized.json", "all_census_data", "year int, country string, count bigint")


@query("doc_origin_overview")
def _(fx):
    category = (
        f"category:string,label:string,total:bigint,top10:{_LISTED},non_top_10:bigint,source_period:string,is_estimated:boolean"
    )
    doc = _document(fx, "origin_overview.json", f"categories array<struct<{category}>>")
    rows = doc.select(F.inline("categories"))
    return _places(rows, "category", "label", "total", "non_top_10", "source_period", "is_estimated")


@query("doc_freshness")
def _(fx):
    source = "array<struct<dataset_key:string,status:string,reference_period:string,loaded_at:string>>"
    schema = f"freshness struct<stale:boolean,last_success_reference:string,sources:{source}>"
    doc = _document(fx, "status_breakdown.json", schema)
    return doc.select("freshness.stale", "freshness.last_success_reference", F.inline("freshness.sources"))


# -- loads into a warehouse, from extracts as they lie in a landing folder ------


def _write_sheets(cells: DataFrame, path: str) -> None:
    """Worksheets as delimited text without a header, one file each; rows a sheet lacks are blank lines, texts are quoted."""
    field = F.when(F.col("is_text"), F.concat(F.lit('"'), F.replace("value", F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(F.col("value"))
    rows = cells.groupBy("sheet", "row_idx").agg(
        F.map_from_entries(F.collect_list(F.struct("col_idx", field))).alias("fields"), F.max("col_idx").alias("last")
    )
    line = F.array_join(F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.coalesce(F.try_element_at("fields", i), F.lit(""))), ",")
    above = F.lag("row_idx").over(Window.partitionBy("sheet").orderBy("row_idx"))
    gap = (F.col("row_idx") - F.coalesce(above, F.lit(-1)) - 1).cast("int")
    lines = rows.withColumn("value", F.concat(F.repeat(F.lit("\n"), gap), line))
    # A file per sheet, its lines in order: that is what makes it a sheet.
    lines.repartition("sheet").sortWithinPartitions("sheet", "row_idx").select("sheet", "value").write.partitionBy("sheet").text(path)


@query("grid_cells")
def _(fx):
    path = scratch_path(fx.spark, "sheets")
    _write_sheets(fx.sheet_cells, path)
    return grid.read_grid(fx.spark, path)


@query("grid_year_totals")
def _(fx):
    path = scratch_path(fx.spark, "sheets")
    _write_sheets(fx.sheet_cells, path)
    return grid.unpivot_year_totals(grid.read_grid(fx.spark, path))


@query("unpivot_repeated_cells")
def _(fx):
    again = fx.sheet_cells.where((F.col("row_idx") > 4) & (F.col("row_idx") % 3 == 0) & (F.col("col_idx") > 1)).withColumn("value", F.lit("7"))
    return grid.unpivot_year_totals(fx.sheet_cells.unionByName(again))


@query("refresh_log")
def _(fx):
    landing, root = scratch_path(fx.spark, "landing"), scratch_path(fx.spark, "warehouse")
    # Written as the sources publish them: comma-separated, tab-separated, and a worksheet; two sources have nothing.
    comma = {
        schemas.POPULATION.name: fx.population_raw.orderBy("_row").drop("_row"),
        schemas.NPR.name: fx.population_raw.orderBy("_row").drop("_row"),
        schemas.STATUS_CENSUS.name: fx.census_raw,
        schemas.NATURALIZED.name: fx.census_raw,
    }
    tab = {schemas.WORK_PROGRAMS.name: fx.programs_raw, schemas.PERMANENT.name: fx.country_raw}
    for extracts, sep in ((comma, ","), (tab, "\t")):
        for name, df in extracts.items():
            df.write.options(header=True, sep=sep).csv(f"{landing}/{name}")
    _write_sheets(fx.asylum_cells, f"{landing}/{schemas.ASYLUM.name}")
    loaded = (*comma, *tab, schemas.ASYLUM.name)
    # A catalog of the landing folder: the best resource of each dataset is the one that is there.
    listed = [(name, f"{name}-{kind}", f"{name} {kind}", kind, f"{landing}/{name}") for name in loaded for kind in ("csv", "xlsx")]
    offers = fx.spark.createDataFrame(listed, "dataset_key string, id string, name string, format string, url string")
    offers = offers.withColumn("description", F.lit(None).cast("string"))
    types = {s: s.split("-")[1].lower().replace(" ", "_") for s in STREAMS[:4]}
    sources = landing_loads(fx.spark, chosen_resources(offers, ["landing"]), geo="AFRICA", npr_types=types, npr_column="TYPE")
    load_all(fx.spark, root, "run", sources)
    totals = reduce(DataFrame.unionByName, [
        warehouse.read_table(fx.spark, root, name).agg(
            F.lit(name).alias("dataset_key"), F.count("*").alias("n_rows"),
            F.sum("population" if name == schemas.POPULATION.name else "count").alias("total"),
        )
        for name in loaded
    ])
    log = warehouse.read_table(fx.spark, root, schemas.LOADS.name)
    return log.select("dataset_key", "status", "resource_name", "reference_period").join(totals, "dataset_key", "left")


@query("rejected_rows")
def _(fx):
    landing, root = scratch_path(fx.spark, "landing"), scratch_path(fx.spark, "warehouse")
    lines = fx.country_lines.repartition("file").sortWithinPartitions("file", "place")
    lines.select("file", "value").write.partitionBy("file").text(landing)
    extract = Resource(f"{landing}/file=*")
    # One source allows malformed rows, the other does not.
    for name, most in ((schemas.STUDY.name, 1 << 40), (schemas.WORK.name, 0)):
        sources = [s for s in landing_loads(fx.spark, {name: extract}, most_rejects=most) if s.meta.dataset_key == name]
        load_all(fx.spark, root, name, sources)
    log = warehouse.read_table(fx.spark, root, schemas.LOADS.name).select(
        "dataset_key", "status", F.when(F.col("status") == "success", F.col("notes")).alias("notes")
    )
    kept = rejects.read_rejects(fx.spark, root).groupBy("dataset_key", "reason").agg(F.count("*").alias("n_rejected"))
    totals = reduce(DataFrame.unionByName, [
        warehouse.read_table(fx.spark, root, name).agg(F.lit(name).alias("dataset_key"), F.count("*").alias("n_rows"), F.sum("count").alias("total"))
        for name in (schemas.STUDY.name, schemas.WORK.name)
    ])
    return log.join(kept, "dataset_key").join(totals, "dataset_key")


@query("load_metrics")
def _(fx):
    root = scratch_path(fx.spark, "warehouse")
    seen = []
    for table, rows, fill, period in (
        (schemas.PERMANENT, fx.permanent, {"ref_month": 0, "immigration_category": "all", "province": "_", "source_dataset": "x"}, "ref_year"),
        (schemas.POPULATION, fx.population, {"source_table": "x"}, "ref_date"),
        (schemas.NPR, fx.npr, {"source_table": "x"}, "ref_date"),
    ):
        shaped, path = shape_for(rows, table, fill), warehouse.table_path(root, table.name)
        stated = rollup.period_text(period, codes.NO_PERIOD)
        if table.slice_by:
            done = replace_slice(shaped, path, table.slice_by, table, stated)
        else:
            done = replace_table(shaped, path, table, period=stated)
        seen.append((table.name, done.rows, done.period, done.null_rows))
    stated = fx.spark.createDataFrame(seen, "dataset_key string, n_written bigint, period string, n_null bigint")
    counted = reduce(DataFrame.unionByName, [
        warehouse.read_table(fx.spark, root, name).agg(F.lit(name).alias("dataset_key"), F.count("*").alias("n_read")) for name, *_ in seen
    ])
    return stated.join(counted, "dataset_key")


def _by_year(fx: Fixtures) -> str:
    """A warehouse whose yearly tables are laid out by year."""
    root = scratch_path(fx.spark, "warehouse")
    whole = {"ref_month": 0, "province": "_", "source_dataset": "x", "immigration_category": "all", "study_level": "_", "program_stream": "all"}
    # Streams come from one pass over the facts.
    permits = materialized(fx.permits)
    tables = {schemas.PERMANENT: fx.permanent}
    tables |= {t: permits.where(F.col("stream") == s) for s, t in _STREAM_TABLES.items()}
    for table, rows in tables.items():
        replace_table(shape_for(rows, table, whole), warehouse.table_path(root, table.name), table)
    return root


_STREAM_TABLES = {"study": schemas.STUDY, "work": schemas.WORK, "asylum": schemas.ASYLUM}


def _latest_permits(fx: Fixtures, root: str) -> DataFrame:
    return marts.tag_facts({s: warehouse.read_latest(fx.spark, root, t.name, AS_OF) for s, t in _STREAM_TABLES.items()})


@query("latest_complete_year_pruned")
def _(fx):
    root = _by_year(fx)
    permanent = marts.tag_facts({"permanent": warehouse.read_latest(fx.spark, root, schemas.PERMANENT.name, AS_OF)})
    sums = rollup.sum_by(permanent.unionByName(_latest_permits(fx, root)), ["stream", "ref_year"])
    return rollup.latest_period(sums, AS_OF, ["stream"])


@query("origin_top10_pruned")
def _(fx):
    return marts.origin_top(warehouse.read_latest(fx.spark, _by_year(fx), schemas.PERMANENT.name, AS_OF), AS_OF, places=PLACES)


@query("temp_top10_pruned")
def _(fx):
    return marts.temporary_top(_latest_permits(fx, _by_year(fx)), AS_OF, places=PLACES)


@query("log_compaction")
def _(fx):
    path = scratch_path(fx.spark, "log")
    records = shape_for(fx.source_loads.withColumns({
        "load_id": F.lpad(F.col("load_id").cast("string"), 12, "0"), "run_id": F.col("run_id").cast("string"),
    }), schemas.LOADS, {"source_family": "x", "source_id": "x", "resource_id": None, "resource_name": None, "cadence": None, "notes": None})
    part = F.pmod(F.xxhash64("load_id"), F.lit(3))
    # Two lots become a snapshot, the third one is the tail.
    for lot in range(3):
        append_rows(records.where(part == lot), path)
        if lot == 1:
            logs.compact(fx.spark, path, schemas.LOADS.schema)
    log = logs.frame(fx.spark, path, schemas.LOADS.schema)
    return lineage.latest_loads(log, ["click", "error", "view"], ["dataset_key", "reference_period", "status", "loaded_at"])


@query("catalog_scan")
def _(fx):
    path = scratch_path(fx.spark, "packages")
    fx.packages.write.text(path)
    offers = catalog.read_catalog(fx.spark, path, one_per_file=False)
    best = catalog.best_resources(offers, ["dataset_id"], _WORDS, required=["e"], min_score=2)
    return best.select("dataset_id", "id", "name", "description", "format", "last_modified", "url", "score")


@query("catalog_errors")
def _(fx):
    path = scratch_path(fx.spark, "packages")
    fx.packages.write.text(path)
    return catalog.broken_packages(fx.spark, path, one_per_file=False).groupBy("error").agg(F.count("*").alias("n"))


@query("refresh_run")
def _(fx):
    """A whole refresh, with an extract that is empty, one that is missing and one that is malformed; and a view by bound SQL."""
    landing, root, folder = (scratch_path(fx.spark, name) for name in ("landing", "warehouse", "published"))
    found = {name: Resource(f"{landing}/{name}") for name in (schemas.POPULATION.name, schemas.NPR.name, schemas.STATUS_CENSUS.name)}
    for name in (schemas.POPULATION.name, schemas.NPR.name):
        fx.population_raw.orderBy("_row").drop("_row").write.options(header=True).csv(f"{landing}/{name}")
    fx.census_raw.write.options(header=True).csv(f"{landing}/{schemas.STATUS_CENSUS.name}")
    found[schemas.ASYLUM.name] = Resource(f"{landing}/{schemas.ASYLUM.name}")
    _write_sheets(fx.asylum_cells.where("row_idx < 5"), found[schemas.ASYLUM.name].path)
    types = {s: s.split("-")[1].lower().replace(" ", "_") for s in STREAMS[:4]}
    sources = landing_loads(fx.spark, found, geo=GEO, npr_types=types, npr_column="TYPE")
    export = documents.Export(as_of=AS_OF, geo=GEO, places=PLACES, first_annual_year=1995, first_quarterly_year=2000)
    refresh(fx.spark, root, sources, folder, export)

    runs = lineage.current_runs(warehouse.read_table(fx.spark, root, schemas.RUNS.name)).select(
        F.lit("run").alias("part"), F.lit("run").alias("name"), "status", F.size("sources_fetched").cast("bigint").alias("n")
    )
    loaded = warehouse.read_table(fx.spark, root, schemas.LOADS.name).select(
        F.lit("load").alias("part"), F.col("dataset_key").alias("name"), "status", F.lit(None).cast("bigint").alias("n")
    )
    published = published_set(fx.spark, folder)
    listed = [("document", name, "published", len(sections)) for name, sections in published.documents.items()]
    listed += [("document", name, "skipped", None) for name in published.skipped]
    shown = fx.spark.createDataFrame(listed, "part string, name string, status string, n bigint")
    warehouse.register_views({f"{name}_{published.run_id}": warehouse.read_table(fx.spark, root, name) for name in (schemas.POPULATION.name,)})
    view = fx.spark.sql(
        f"select 'view' as part, geo as name, cast(null as string) as status, sum(population) as n "
        f"from {schemas.POPULATION.name}_{published.run_id} where year(ref_date) = :year group by geo", args={"year": 1997},
    )
    return reduce(DataFrame.unionByName, [runs, loaded, shown, view])


# -- functions -----------------------------------------------------------------


@query("count_labels")
def _(fx):
    n = F.col("population")
    scaled = F.call_function("div", n, F.lit(1000))
    return fx.population.select(
        "ref_date", "geo",
        fn.compact_label(n).alias("short"),
        fn.compact_label(n, 1).alias("shorter"),
        fn.compact_label(scaled).alias("thousands"),
        fn.compact_label(F.call_function("div", n, F.lit(1_000_000))).alias("small"),
        fn.grouped_label(n).alias("grouped"),
    )


@query("date_labels")
def _(fx):
    quarter = F.col("ref_date")
    known = F.when(F.month("ref_date") > 3, quarter)
    return fx.population.select(
        "ref_date", "geo",
        fn.month_label(known).alias("month_label"),
        F.year("ref_date").alias("year"),
        fn.year_start(F.year("ref_date")).alias("year_start"),
        F.date_format("ref_date", "yyyy-MM-dd").alias("iso"),
    )


@query("month_numbers")
def _(fx):
    n = F.month("o_orderdate")
    name = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MMMM"))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit(" "), F.upper(F.date_format("o_orderdate", "MMM")), F.lit(". ")))
        .when(n == 9, "sept")
        .when(n == 5, F.lit("5"))
        .when(n == 6, "Juin")
        .when(n == 7, "13")
        .when(n == 8, "-3")
    )
    return fx.table("orders").select(name.alias("month"), fn.month_number(name).alias("month_number")).groupBy(
        "month", "month_number"
    ).agg(F.count("*").alias("n"))


@query("scalar_strings")
def _(fx):
    # Texts repeat: each distinct one is worked on once.
    texts = fx.programs_raw.groupBy("EN_PROGRAM", "EN_YEAR").agg(F.count("*").alias("n"))
    program = F.col("EN_PROGRAM")
    forms = (("foreign", "f."), ("worker", "w."))
    low = F.lower(fn.squeeze(program))
    rows = texts.select(
        "n",
        fn.squeeze(program).alias("squeezed"),
        low.contains("work").alias("has_work"),
        low.startswith("t").alias("t_first"),
        low.endswith("t").alias("t_last"),
        F.length(low).alias("length"),
        F.substring(low, 1, 4).alias("first_four"),
        fn.short_place(low, forms).alias("shortened"),
        fn.template("%s in %s", F.nullif(low, F.lit("")), "EN_YEAR").alias("templated"),
        fn.program_code(program).alias("program"),
        fn.is_blank(program).alias("blank"),
    )
    return rows.groupBy(*[c for c in rows.columns if c != "n"]).agg(F.sum("n").alias("n"))


@query("scalar_math")
def _(fx):
    n = F.col("n")
    numbers = fx.country_raw.groupBy("EN_YEAR", "TOTAL").agg(F.count("*").alias("n_rows")).select(
        "EN_YEAR", "n_rows",
        fn.parse_count(fn.drop_null_tokens("TOTAL")).alias("n"),
        fn.parse_count(F.concat("TOTAL", F.lit(".6"))).alias("cut"),
    )
    return numbers.select(
        "EN_YEAR", "n_rows", "n", "cut",
        fn.not_negative(n - 20).alias("above_20"),
        (n % 7).alias("mod_7"),
        F.try_divide(n, F.nullif(n % 3, F.lit(0).cast("bigint"))).alias("ratio"),
        fn.percent_one_decimal(n, F.lit(1060)).alias("pct"),
        fn.percent_one_decimal(n, F.lit(0)).alias("no_pct"),
    )


@query("counts_of_chosen_years")
def _(fx):
    chosen = fx.country_raw.filter(F.col("EN_YEAR").isin("1996", "1998", "2000"))
    return chosen.groupBy("EN_YEAR").agg(F.sum(fn.parse_count(fn.drop_null_tokens("TOTAL"))).alias("n"))


@query("positive_counts")
def _(fx):
    n = fn.parse_count(fn.drop_null_tokens("TOTAL")) - 10
    return fx.country_raw.filter(n > 0).groupBy("EN_YEAR").agg(F.count("*").alias("n_rows"), F.sum(n).alias("above_10"))


@query("nested_topk")
def _(fx):
    sums = marts.place_sums(fx.permanent, ["ref_year"], PLACES)
    top = dedupe.top_per_key(sums, ["ref_year"], [F.col("count").desc(), F.col("country")], 3)
    lists = top.groupBy("ref_year").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("less"), "country", "count"))).alias("top")
    )
    text = F.to_json(F.struct("ref_year", F.slice("top", 1, 2).alias("top")), {"ignoreNullFields": "false"})
    back = F.from_json(text, "ref_year int, top array<struct<less:bigint,country:string,count:bigint>>")
    return lists.select(back.alias("doc")).select("doc.ref_year", F.posexplode("doc.top").alias("place", "row")).select(
        "ref_year", "place", "row.country", "row.count"
    )


@query("map_lookup")
def _(fx):
    wanted = ["1-URGENT", "3-MEDIUM", "missing"]
    latest = marts.streams_latest(fx.npr, GEO).filter(F.col("stream").isin(*wanted))
    one = latest.agg(F.map_from_entries(F.collect_list(F.struct("stream", "count"))).alias("counts"))
    entries = [
        F.struct(
            F.lit(s).alias("stream"),
            F.coalesce(F.try_element_at("counts", F.lit(s)), F.lit(0).cast("bigint")).alias("count"),
            F.array_contains(F.map_keys("counts"), s).alias("present"),
        )
        for s in wanted
    ]
    together = reduce(lambda a, b: a + b, [e["count"] for e in entries])
    return one.select(together.alias("together"), F.inline(F.array(*entries)))
