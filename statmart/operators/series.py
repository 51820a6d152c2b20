"""Shares, year windows, pivots and blended series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.functions import all_present, percent_one_decimal, year_start


def percent_of_total(df: DataFrame, value: str = "count", by: Sequence[str] = (), total: str = "total",
                     pct: str = "pct") -> DataFrame:
    """Share of the table's or the group's total, one decimal, null for a total of 0.

    The table total is a scalar subquery and group totals are joined back, so
    no window has to hold a whole group in one task.
    """
    if by:
        # Stated before the branches part, so that both read the same shuffle output.
        df = df.filter(all_present(*by))
        out = df.join(df.groupBy(*by).agg(F.sum(value).alias(total)), list(by))
    else:
        out = df.withColumn(total, df.agg(F.sum(value)).scalar())
    return out.withColumn(pct, percent_one_decimal(value, total))


def year_window(df: DataFrame, year: Column, start: int | None = None, end: int | None = None) -> DataFrame:
    """Rows whose year lies in the window; an open end reaches the first or last year present."""
    kept = df.filter(year.isNotNull())
    if start is not None:
        kept = kept.filter(year >= start)
    if end is not None:
        kept = kept.filter(year <= end)
    return kept


def years_present(df: DataFrame, year: Column) -> DataFrame:
    """Distinct years in order: the choices of a year window."""
    return df.select(year.alias("year")).distinct().orderBy("year")


def pivot_series(df: DataFrame, index: Sequence[str], series: str, value: str,
                 columns: Sequence[str]) -> DataFrame:
    """Long to wide with a fixed column list; cells without a row stay null."""
    return df.groupBy(*index).pivot(series, list(columns)).agg(F.sum(value))


def align_to_driver(facts: DataFrame, tag: str, driver: str, tags: Sequence[str], key: str,
                    value: str = "count") -> DataFrame:
    """Totals of several tagged tables side by side, for the keys of the driving one.

    ``facts`` stacks the tables with their name in ``tag``.  A table without
    rows for a key counts 0 there.  One aggregation replaces one left join per
    table; ``has_<tag>`` tells a true 0 from a missing row.
    """
    sums = [
        c
        for t in tags
        for c in (
            F.coalesce(F.sum(F.when(F.col(tag) == t, F.col(value))), F.lit(0).cast("bigint")).alias(t),
            (F.count_if(F.col(tag) == t) > 0).alias(f"has_{t}"),
        )
    ]
    return facts.groupBy(key).agg(*sums).filter(F.col(f"has_{driver}"))


def blend_history(quarterly: DataFrame, annual: DataFrame, series: Mapping[str, str]) -> DataFrame:
    """Quarterly series followed back in time by annual totals, each row tagged by origin.

    ``quarterly`` holds ref_date, stream and count; ``annual`` is the result of
    ``align_to_driver`` on ref_year; ``series`` names the stream of each table.
    """
    long = annual.select(
        year_start("ref_year").alias("date"),
        F.inline(
            F.array(*[
                F.struct(F.lit(stream).alias("stream"), F.col(t).alias("count"), F.col(f"has_{t}").alias("has_source"))
                for t, stream in series.items()
            ])
        ),
    )
    recent = quarterly.select(F.col("ref_date").alias("date"), "stream", "count", F.lit(True).alias("has_source"))
    return _tag(recent, "quarterly", "statcan").unionByName(_tag(long, "annual", "ircc"))


def _tag(df: DataFrame, cadence: str, origin: str) -> DataFrame:
    return df.withColumn("cadence", F.lit(cadence)).withColumn("source_origin", F.lit(origin))
