"""Warehouse tables to published relations, as flat rows.

``as_of`` is the current year: the latest complete year lies before it.  Every
ranking ends with the key, so ties always come out the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart import codes
from statmart.functions import code_for, is_place, not_negative, place_name, template, year_start
from statmart.operators.apportion import apportion, apportion_codes
from statmart.operators.dedupe import top_per_key
from statmart.operators.rollup import latest_row, rows_of_latest_period, rows_of_top_keys, sum_by
from statmart.operators.series import align_to_driver, blend_history, percent_of_total
from statmart.session import materialized, one_row

STATUS_SOURCES = {
    "census": "Statistics Canada 98-10-0302-01",
    "npr": "Statistics Canada 17-10-0121-01",
    "estimate": "Estimated from latest population + census resident shares",
}

# Which tagged facts make up an origin category.
CATEGORY_OF_STREAM = {
    "naturalized": "naturalized",
    "permanent_resident": "permanent_resident",
    "study": "temporary_resident",
    "work": "temporary_resident",
    "asylum": "temporary_resident",
}
STATUS_OF_CATEGORY = {
    "naturalized": "naturalized",
    "permanent_resident": "permanent_resident",
    "temporary_resident": "non_permanent_resident",
}


def tag_facts(tables: Mapping[str, DataFrame], keys: Sequence[str] = ("ref_year", "country"),
              value: str = "count") -> DataFrame:
    """Stack fact tables with their name in ``stream``."""
    tagged = [df.select(F.lit(name).alias("stream"), *keys, value) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged)


def place_sums(facts: DataFrame, keys: Sequence[str], places: codes.PlaceRules = codes.DEFAULT_PLACES,
               value: str = "count") -> DataFrame:
    """Sum by keys and place, aliases merged first so that no place comes out twice."""
    named = facts.select(*keys, place_name("country", places).alias("country"), value)
    return sum_by(named, [*keys, "country"], value)


def _ranked(df: DataFrame, places: codes.PlaceRules | None, value: str = "count") -> DataFrame:
    """Rows that may enter a ranking: a measure, and a real place unless that test is off."""
    kept = df.filter(F.col(value).isNotNull())
    return kept if places is None else kept.filter(is_place("country", places))


# -- population --------------------------------------------------------------


def population_latest(population: DataFrame, geo: str = codes.FOCUS_GEO) -> DataFrame:
    """Newest population of one geography."""
    rows = population.filter(F.col("geo") == geo).select("ref_date", "population")
    return rows.orderBy(F.col("ref_date").desc()).limit(1)


def population_history(population: DataFrame, geo: str = codes.FOCUS_GEO, since: str = "2000-01-01") -> DataFrame:
    """Population by quarter since a date."""
    kept = population.filter((F.col("geo") == geo) & (F.col("ref_date") >= F.lit(since).cast("date")))
    return kept.select(F.col("ref_date").alias("date"), "population").orderBy("date")


# -- status ------------------------------------------------------------------


def status_estimates(spark: SparkSession, population: DataFrame, npr: DataFrame, census: DataFrame,
                     geo: str = codes.FOCUS_GEO, default_year: int = codes.DEFAULT_CENSUS_YEAR,
                     labels: Mapping[str, str] = codes.STATUS_LABELS) -> DataFrame:
    """Status counts as last published, and estimated to add up to the newest population.

    Temporary residents come from the newest quarter; the rest of the population
    is split over the resident statuses by their latest census counts.
    """
    people = latest_row(population.filter(F.col("geo") == geo), "ref_date", ["population"])
    by_quarter = npr.filter(F.col("geo") == geo).groupBy("ref_date").agg(F.sum("count").alias("npr"))
    counts = [F.sum(F.when(F.col("status") == s, F.col("count"))).alias(s) for s in codes.RESIDENT_STATUSES]
    by_census = census.filter((F.col("geo") == geo) & F.col("count").isNotNull()).groupBy("census_year").agg(*counts)
    latest = {
        "people": people,
        "temporary": latest_row(by_quarter, "ref_date", ["npr"]).withColumnRenamed("ref_date", "npr_date"),
        "census": latest_row(by_census, "census_year", codes.RESIDENT_STATUSES),
    }
    # Three single rows side by side: scalar subqueries, no join.
    one = one_row(spark).select(*[df.select(F.struct("*")).scalar().alias(name) for name, df in latest.items()])
    one = one.select(*[f"{name}.*" for name in latest])

    zero = F.lit(0).cast("bigint")
    temp_count = F.coalesce("npr", zero)
    residents = not_negative(F.coalesce("population", zero) - temp_count)
    shares = apportion_codes([(s, F.col(s)) for s in codes.RESIDENT_STATUSES], residents)

    def row(mode: str, status: Column, count: Column, ref_date: Column, source: str) -> Column:
        return F.struct(
            F.lit(mode).alias("mode"), status.alias("status"),
            code_for(status, labels).alias("label"), count.alias("count"),
            ref_date.alias("ref_date"), F.lit(source).alias("source"),
        )

    census_date = year_start(F.coalesce("census_year", F.lit(default_year)))
    actual = F.transform(
        "_shares", lambda e: row("actual", e["code"], e["weight"], census_date, STATUS_SOURCES["census"])
    )
    estimated = F.transform(
        "_shares", lambda e: row("estimated", e["code"], e["scaled"], F.col("ref_date"), STATUS_SOURCES["estimate"])
    )
    temp_rows = [
        F.array(row(mode, F.lit(codes.TEMPORARY_STATUS), temp_count, F.col("npr_date"), STATUS_SOURCES["npr"]))
        for mode in ("actual", "estimated")
    ]
    counted = sum(
        (F.coalesce(F.col(s), zero) for s in codes.RESIDENT_STATUSES[1:]),
        F.coalesce(codes.RESIDENT_STATUSES[0], zero),
    )
    return (
        one.withColumn("_shares", shares)
        .select(
            F.lit(geo).alias("geo"),
            F.coalesce("population", zero).alias("population"),
            (counted + temp_count).alias("_actual_total"),
            (residents + temp_count).alias("_estimated_total"),
            F.inline(F.concat(actual, temp_rows[0], estimated, temp_rows[1])),
        )
        .withColumn(
            "mode_total", F.when(F.col("mode") == "actual", F.col("_actual_total")).otherwise(F.col("_estimated_total"))
        )
        .drop("_actual_total", "_estimated_total")
    )


def census_snapshots(census: DataFrame, geo: str = codes.FOCUS_GEO) -> DataFrame:
    """Census counts by year and status."""
    kept = census.filter((F.col("geo") == geo) & F.col("count").isNotNull())
    return kept.select(F.col("census_year").alias("year"), "status", "count").orderBy("year", "status")


# -- streams -----------------------------------------------------------------


def streams_latest(npr: DataFrame, geo: str = codes.FOCUS_GEO) -> DataFrame:
    """Non-permanent residents by stream in the newest quarter, with shares."""
    sums = sum_by(npr.filter(F.col("geo") == geo), ["geo", "ref_date", "npr_type"])
    latest = rows_of_latest_period(sums, by=["geo"], at="ref_date").filter(F.col("count").isNotNull())
    shares = percent_of_total(latest.select("ref_date", F.col("npr_type").alias("stream"), "count"))
    return shares.orderBy(F.col("count").desc(), "stream")


def streams_history(npr: DataFrame, permits: DataFrame, geo: str = codes.FOCUS_GEO, first_year: int = 2015,
                    before_year: int = 2021, series: Mapping[str, str] = codes.ANNUAL_SERIES) -> DataFrame:
    """Quarterly streams, preceded by annual permit totals for the fallback years.

    ``permits`` stacks the annual tables (see ``tag_facts``); the first name in
    ``series`` decides which years there are.
    """
    quarterly = sum_by(
        npr.filter(F.col("geo") == geo).select("ref_date", F.col("npr_type").alias("stream"), "count"),
        ["ref_date", "stream"],
    )
    in_window = permits.filter((F.col("ref_year") >= first_year) & (F.col("ref_year") < before_year))
    annual = align_to_driver(in_window, "stream", next(iter(series)), list(series), "ref_year")
    return blend_history(quarterly, annual, series).orderBy("date", "stream")


# -- programs ----------------------------------------------------------------


def program_shares(programs: DataFrame) -> DataFrame:
    """Work permits by program in the latest year, with shares."""
    sums = sum_by(programs.filter(F.col("ref_year").isNotNull()), ["ref_year", "program_stream"])
    latest = rows_of_latest_period(sums, as_of=None).filter(F.col("count").isNotNull()).drop("period_total")
    shares = percent_of_total(latest.withColumnRenamed("program_stream", "stream"))
    return shares.orderBy(F.col("count").desc(), "stream")


# -- origin ------------------------------------------------------------------


def origin_top(permanent: DataFrame, as_of: int, k: int = 10,
               places: codes.PlaceRules = codes.DEFAULT_PLACES, check_places: bool = True) -> DataFrame:
    """Top-k countries of the latest complete year."""
    latest = rows_of_latest_period(place_sums(permanent, ["ref_year"], places), as_of)
    rows = _ranked(latest, places if check_places else None)
    return rows.select("ref_year", "country", "count").orderBy(F.col("count").desc(), "country").limit(k)


def origin_history(permanent: DataFrame, k: int = 10, places: codes.PlaceRules = codes.DEFAULT_PLACES,
                   check_places: bool = True) -> DataFrame:
    """Yearly counts of the countries with the greatest all-time sums."""
    sums = place_sums(permanent, ["ref_year"], places).filter(F.col("country").isNotNull())
    if check_places:
        sums = sums.filter(is_place("country", places))
    return (
        rows_of_top_keys(sums, "country", "ref_year", k)
        .where(F.col("total").isNotNull())
        .select(F.col("ref_year").alias("year"), "country", "count")
        .orderBy("year", F.col("count").desc_nulls_last(), "country")
    )


def temporary_top(permits: DataFrame, as_of: int, k: int = 10,
                  places: codes.PlaceRules = codes.DEFAULT_PLACES, check_places: bool = True) -> DataFrame:
    """Top-k countries of each permit stream, each in its own latest complete year."""
    latest = rows_of_latest_period(place_sums(permits, ["stream", "ref_year"], places), as_of, ["stream"])
    rows = _ranked(latest, places if check_places else None).select("stream", "ref_year", "country", "count")
    top = top_per_key(rows, ["stream"], [F.col("count").desc(), F.col("country")], k, rank_as="rank")
    return top.orderBy("stream", "rank")


def temporary_lists(permits: DataFrame, as_of: int, k: int = 10,
                    places: codes.PlaceRules = codes.DEFAULT_PLACES) -> DataFrame:
    """One row per permit stream: its latest complete year and that year's top-k countries, greatest first."""
    latest = rows_of_latest_period(place_sums(permits, ["stream", "ref_year"], places), as_of, ["stream"])
    # The rows of a year may all be left out of the ranking; the year stays.
    placed = latest.withColumn("is_listed", F.coalesce(F.col("count").isNotNull() & is_place("country", places), F.lit(False)))
    order = [F.col("is_listed").desc(), F.col("count").desc(), F.col("country")]
    top = top_per_key(placed, ["stream"], order, k, rank_as="rank")
    rows = F.when(F.col("is_listed"), F.struct("rank", F.struct("country", "count").alias("row")))
    return top.groupBy("stream").agg(
        F.max("ref_year").alias("ref_year"),
        F.transform(F.array_sort(F.collect_list(rows)), lambda r: r["row"]).alias("top"),
    )


def naturalized_all(naturalized: DataFrame, places: codes.PlaceRules = codes.DEFAULT_PLACES) -> DataFrame:
    """Naturalised citizens by census and country, newest and greatest first."""
    sums = place_sums(naturalized.withColumnRenamed("census_year", "year"), ["year"], places)
    return sums.select("year", "country", "count").orderBy(
        F.col("year").desc(), F.col("count").desc_nulls_last(), "country"
    )


def naturalized_top(naturalized: DataFrame, k: int = 10, places: codes.PlaceRules = codes.DEFAULT_PLACES,
                    check_places: bool = True) -> DataFrame:
    """Top-k birth countries of the latest census."""
    latest = rows_of_latest_period(place_sums(naturalized, ["census_year"], places), None, at="census_year")
    rows = _ranked(latest, places if check_places else None)
    return rows.select(F.col("census_year").alias("year"), "country", "count").orderBy(
        F.col("count").desc(), "country"
    ).limit(k)


def origin_facts(naturalized: DataFrame, permanent: DataFrame, permits: DataFrame) -> DataFrame:
    """The three origin tables as tagged facts."""
    tables = {
        "naturalized": naturalized.withColumnRenamed("census_year", "ref_year"),
        "permanent_resident": permanent,
    }
    return tag_facts(tables).unionByName(permits.select("stream", "ref_year", "country", "count"))


def origin_categories(facts: DataFrame, status: DataFrame, as_of: int, k: int = 10,
                      places: codes.PlaceRules = codes.DEFAULT_PLACES) -> DataFrame:
    """Country of origin by category: distributions scaled to the estimated stock.

    ``facts`` is ``origin_facts``, ``status`` is ``status_estimates``.  One row
    per category with its total, its top-k countries and the remainder.  The
    foreign-born total adds the three lists; their remainders compete with the
    countries for a place in its top-k.
    """
    own, latest = _own_lists(facts, status, as_of, k, places, list(STATUS_OF_CATEGORY))
    return _with_foreign_born(own, k).select(
        "category", code_for("category", codes.ORIGIN_CATEGORIES).alias("label"), "total", "top", "non_top",
        _source_period(latest).alias("source_period"),
    )


def origin_category(facts: DataFrame, status: DataFrame, as_of: int, category: str, k: int = 10,
                    places: codes.PlaceRules = codes.DEFAULT_PLACES) -> DataFrame:
    """One category of ``origin_categories``: its name, total, top-k and remainder.

    A category of its own reads its own streams and scales its own countries;
    the total over all categories, or an unknown name, takes all of them.
    """
    if category not in STATUS_OF_CATEGORY:
        first = category if category in codes.ORIGIN_CATEGORIES else next(iter(codes.ORIGIN_CATEGORIES))
        return origin_categories(facts, status, as_of, k, places).where(F.col("category") == first).select("category", "total", "top", "non_top")
    own, _ = _own_lists(facts, status, as_of, k, places, [category])
    listed = F.filter("top", lambda e: e["count"] > 0)
    in_top = F.aggregate(listed, F.lit(0).cast("bigint"), lambda acc, e: acc + e["count"])
    ordered = F.transform(
        F.array_sort(F.transform(listed, lambda e: F.struct((-e["count"]).alias("less"), e["country"].alias("country"), e["count"].alias("count")))),
        lambda e: F.struct(e["country"].alias("country"), e["count"].alias("count")),
    )
    return own.select("category", F.col("target").alias("total"), ordered.alias("top"), not_negative(F.col("target") - in_top).alias("non_top"))


def _own_lists(facts: DataFrame, status: DataFrame, as_of: int, k: int, places: codes.PlaceRules,
               categories: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Stock, top-k and remainder of the categories, without the total over them; and the rows they rest on."""
    category_of_status = {STATUS_OF_CATEGORY[category]: category for category in categories}
    stocks = status.filter((F.col("mode") == "estimated") & F.col("status").isin(*category_of_status))
    targets = materialized(
        stocks.select(code_for("status", category_of_status).alias("category"), not_negative("count").alias("target"))
    )
    streams = [stream for stream, category in CATEGORY_OF_STREAM.items() if category in categories]
    wanted = facts if len(streams) == len(CATEGORY_OF_STREAM) else facts.where(F.col("stream").isin(*streams))
    complete = (F.col("stream") == "naturalized") | (F.col("ref_year") < as_of)
    latest = materialized(rows_of_latest_period(place_sums(wanted, ["stream", "ref_year"], places), complete, ["stream"]))

    weights = sum_by(
        _ranked(latest, places).withColumn("category", code_for("stream", CATEGORY_OF_STREAM)), ["category", "country"]
    )
    scaled = apportion(weights, targets, ["category"], "country").filter(F.col("scaled") > 0)
    top = top_per_key(scaled, ["category"], [F.col("scaled").desc(), F.col("country")], k)
    # At most k rows per category from here on.
    listed = top.groupBy("category").agg(
        F.collect_list(F.struct("country", F.col("scaled").alias("count"))).alias("top"),
        F.sum("scaled").alias("_listed"),
    )
    nothing = F.array().cast("array<struct<country:string,count:bigint>>")
    own = targets.join(listed, "category", "left").select(
        "category", "target",
        F.coalesce("top", nothing).alias("top"),
        not_negative(F.col("target") - F.coalesce("_listed", F.lit(0))).alias("_rest"),
    )
    return own, latest


def _with_foreign_born(own: DataFrame, k: int) -> DataFrame:
    """Category rows plus the foreign-born total, each with a ranked top-k list.

    Every category hands its listed countries on twice, to itself and to the
    total, and its remainder once, to the total.  A row without a country
    carries the category's stock.
    """

    def rows(category: Column) -> Column:
        listed = F.transform(
            "top", lambda e: F.struct(category.alias("category"), e["country"].alias("country"),
                                      e["count"].alias("count"), F.lit(0).cast("bigint").alias("stock"))
        )
        stock = F.struct(category.alias("category"), F.lit(None).cast("string").alias("country"),
                         F.lit(0).cast("bigint").alias("count"), F.col("target").alias("stock"))
        return F.concat(listed, F.array(stock))

    total = F.lit("foreign_born_total")
    rest_name = F.concat(F.lit(f"Non-top-{k} "), code_for("category", codes.REMAINDER_LABELS))
    rest = F.struct(total.alias("category"), rest_name.alias("country"), F.col("_rest").alias("count"),
                    F.lit(0).cast("bigint").alias("stock"))
    mixed = own.select(F.inline(F.concat(rows(F.col("category")), rows(total), F.array(rest))))
    merged = mixed.groupBy("category", "country").agg(F.sum("count").alias("count"), F.sum("stock").alias("stock"))
    # A handful of rows per category: k countries each, k remainders at most.
    listed = F.filter(
        F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("_less"), "country", "count"))),
        lambda e: e["country"].isNotNull() & (e["count"] > 0),
    )
    named = F.transform(
        F.slice("_sorted", 1, k), lambda e: F.struct(e["country"].alias("country"), e["count"].alias("count"))
    )
    in_top = F.aggregate("top", F.lit(0).cast("bigint"), lambda acc, e: acc + e["count"])
    return (
        merged.groupBy("category")
        .agg(F.sum("stock").alias("total"), listed.alias("_sorted"))
        .withColumn("top", named)
        .withColumn("non_top", not_negative(F.col("total") - in_top))
        .select("category", "total", "top", "non_top")
    )


def _source_period(latest: DataFrame) -> Column:
    """Which years each category rests on."""
    fields = [F.max(F.when(F.col("stream") == s, F.col("ref_year"))).alias(s) for s in CATEGORY_OF_STREAM]
    y = latest.agg(F.struct(*fields)).scalar()
    temporary = F.greatest(y["study"], y["work"], y["asylum"])
    # Wording of the period texts.
    return (
        F.when(
            F.col("category") == "foreign_born_total",
            template("Naturalized %s, PR %s, Temporary %s", y["naturalized"], y["permanent_resident"], temporary),
        )
        .when(
            F.col("category") == "naturalized",
            template("%s census distribution scaled to current estimated stock", y["naturalized"]),
        )
        .when(
            F.col("category") == "permanent_resident",
            template("%s IRCC annual distribution scaled to current estimated stock", y["permanent_resident"]),
        )
        .otherwise(template("Study %s, work %s, asylum %s", y["study"], y["work"], y["asylum"]))
    )


def origin_overview(spark: SparkSession, population: DataFrame, npr: DataFrame, census: DataFrame,
                    naturalized: DataFrame, permanent: DataFrame, permits: DataFrame, as_of: int,
                    geo: str = codes.FOCUS_GEO, k: int = 10,
                    places: codes.PlaceRules = codes.DEFAULT_PLACES) -> DataFrame:
    """``origin_categories`` as flat rows: one per listed country."""
    status = status_estimates(spark, population, npr, census, geo)
    categories = origin_categories(origin_facts(naturalized, permanent, permits), status, as_of, k, places)
    return categories.select(
        "category", "label", "total", "non_top", "source_period", F.posexplode_outer("top").alias("_place", "_row")
    ).select(
        "category", "label", "total", "non_top", "source_period",
        (F.col("_place") + 1).alias("rank"), F.col("_row.country").alias("country"), F.col("_row.count").alias("count"),
    )
