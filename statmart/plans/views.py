"""What the published rows are turned into for reading."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart import codes
from statmart.functions import all_present, code_for
from statmart.operators.apportion import topk_with_other, with_other_row
from statmart.operators.rollup import rollup_groups, rows_of_top_keys, sum_by
from statmart.operators.series import percent_of_total, pivot_series, year_window
from statmart.session import one_row


def population_in_years(history: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Population history within a year window."""
    return year_window(history, F.year("date"), start, end)


def streams_wide(history: DataFrame, start: int | None = None, end: int | None = None,
                 streams: Sequence[str] = tuple(codes.SERIES_META)) -> DataFrame:
    """Stream history with one column per stream."""
    return pivot_series(year_window(history, F.year("date"), start, end), ["date"], "stream", "count", streams).orderBy(
        "date"
    )


def status_wide(snapshots: DataFrame, statuses: Sequence[str] = tuple(codes.STATUS_TREND_LABELS)) -> DataFrame:
    """Census snapshots with one column per status."""
    return pivot_series(snapshots, ["year"], "status", "count", statuses).orderBy("year")


def yearly_totals(history: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Sum over the listed countries by year."""
    return sum_by(year_window(history, F.col("year"), start, end), ["year"], alias="total").orderBy("year")


def top_countries(history: DataFrame, k: int = 10) -> DataFrame:
    """Names of the countries with the greatest sums, greatest first."""
    return sum_by(history, ["country"], alias="total").orderBy(F.col("total").desc(), "country").limit(k)


def countries_wide(history: DataFrame, k: int = 10, start: int | None = None, end: int | None = None) -> DataFrame:
    """History of the top-k countries with one column per rank, and the country of each rank beside it.

    The ranks are found inside the plan, over all years as the chart does, so
    no names have to be collected first. Columns: year, country_1, count_1, ...
    """
    kept = history.filter(F.col("country").isNotNull())
    ranked = rows_of_top_keys(kept, "country", "year", k)
    # At most k names in every row; a year without one of them shows its name all the same.
    names = ranked.agg(F.map_from_entries(F.collect_set(F.struct("rank", "country")))).scalar()
    placed = year_window(ranked, F.col("year"), start, end)
    wide = pivot_series(placed, ["year"], "rank", "count", range(1, k + 1))
    columns = [c for i in range(1, k + 1) for c in (F.try_element_at(names, F.lit(i)).alias(f"country_{i}"), F.col(str(i)).alias(f"count_{i}"))]
    return wide.select("year", *columns).orderBy("year")


def top_country_rows(history: DataFrame, k: int = 10, start: int | None = None, end: int | None = None) -> DataFrame:
    """History rows of the top-k countries within a year window, long form.

    The top-k is taken over all years, as the chart does.
    """
    kept = history.filter(F.col("country").isNotNull())
    return year_window(rows_of_top_keys(kept, "country", "year", k), F.col("year"), start, end).select("year", "country", "count")


def streams_grouped(streams: DataFrame, combined: Sequence[str] = codes.ASYLUM_STREAMS,
                    combined_label: str = codes.ASYLUM_LABEL,
                    labels: Mapping[str, str] = codes.STREAM_LABELS) -> DataFrame:
    """Current streams with the asylum streams as one bar, and shares of the whole.

    The combined bar is there even if none of its streams has a row, with 0.
    """
    groups = {s: combined_label for s in combined}
    bars = rollup_groups(_with_members(streams, combined[:1]), "stream", groups, labels)
    return percent_of_total(bars).orderBy(F.col("count").desc(), "label")


def _with_members(streams: DataFrame, members: Sequence[str]) -> DataFrame:
    """Streams and counts, with a row of 0 for each of some codes; sums over them stay as they are."""
    zeros = one_row(streams.sparkSession).select(
        F.explode(F.array(*[F.lit(m) for m in members]).cast("array<string>")).alias("stream"), F.lit(0).cast("bigint").alias("count")
    )
    return streams.select("stream", "count").unionByName(zeros)


def stream_panels(streams: DataFrame, panels: Mapping[str, Sequence[str]] = codes.STREAM_PANELS,
                  labels: Mapping[str, str] = codes.STREAM_LABELS) -> DataFrame:
    """Streams within their panel, with shares of the panel; members without a row are listed with 0."""
    panel_of = {s: panel for panel, members in panels.items() for s in members}
    rows = sum_by(_with_members(streams, list(panel_of)), ["stream"]).select(
        code_for("stream", panel_of).alias("panel"),
        code_for("stream", labels, default=F.col("stream")).alias("label"),
        "count",
    ).filter(F.col("panel").isNotNull())
    return percent_of_total(rows, by=["panel"]).orderBy("panel", F.col("count").desc(), "label")


def status_shares(status: DataFrame, mode: str = "estimated") -> DataFrame:
    """Status rows of one mode with shares."""
    return percent_of_total(status.filter(F.col("mode") == mode).select("status", "label", "count"))


def category_rows(categories: DataFrame, category: str, other: str = "Non-top-10") -> DataFrame:
    """Country rows of one category, with a remainder row; the first category if it is unknown."""
    places = {c: i for i, c in enumerate(codes.ORIGIN_CATEGORIES)}
    known = code_for("category", places, default=F.lit(len(places)))
    wanted = F.when(F.col("category") == category, -1).otherwise(known)
    chosen = categories.orderBy(wanted, "category").limit(1)
    rest = F.when(
        F.col("non_top") > 0, F.array(F.struct(F.lit(other).alias("country"), F.col("non_top").alias("count")))
    )
    nothing = F.array().cast("array<struct<country:string,count:bigint>>")
    return chosen.select("category", F.inline(F.concat("top", F.coalesce(rest, nothing))))


def top_with_other(df: DataFrame, by: Sequence[str], key: str, value: str = "count", k: int = 10,
                   other: str = "Non-top-10") -> DataFrame:
    """Top-k per group plus a remainder row that makes the group add up to its total."""
    # Stated before the branches part, so that both read the same shuffle output.
    df = df.filter(all_present(*by))
    totals = sum_by(df, by, value, alias="total")
    top, groups = topk_with_other(df, by, key, value, k, totals)
    return with_other_row(top, groups, key, value, other)


def program_cards(shares: DataFrame, labels: Mapping[str, str] = codes.PROGRAM_LABELS) -> DataFrame:
    """Program shares with display labels."""
    return shares.withColumn("label", code_for("stream", labels, default=F.col("stream")))
