"""Sums, latest periods and other group results."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statmart.functions import all_present, code_for, parse_count


def sum_by(df: DataFrame, keys: Sequence[str], value: str = "count", alias: str | None = None,
           zero_default: bool = False) -> DataFrame:
    """Sum of ``value`` by one or several keys; optionally 0 where all values are null."""
    total = F.sum(value)
    if zero_default:
        total = F.coalesce(total, F.lit(0).cast("bigint"))
    return df.groupBy(*keys).agg(total.alias(alias or value))


def annual_rollup(df: DataFrame, year: str, key: str, key_name: str, total: str, strip_commas: bool = True,
                  clean: Callable[[Column], Column] | None = None) -> DataFrame:
    """Text extract to yearly sums.

    Unreadable totals count as null, rows without a year or key are dropped, and
    a group that holds nothing but nulls sums to 0.  Years and keys repeat from
    row to row, so rows are summed by the raw texts first; the year is parsed
    and the key cleaned once per distinct text.
    """
    key_column = F.col(f"`{key}`")
    raw = df.groupBy(F.col(f"`{year}`").alias("_year"), key_column.alias("_key")).agg(
        F.sum(parse_count(F.col(f"`{total}`"), strip_commas)).alias("count")
    )
    rows = raw.select(
        # A number beyond the range of years is no year.
        parse_count("_year").try_cast("int").alias("ref_year"),
        (clean(F.col("_key")) if clean else F.col("_key")).alias(key_name),
        "count",
    )
    sums = rows.groupBy("ref_year", key_name).agg(
        F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("count"),
        F.least(F.count("ref_year"), F.count(key_name)).alias("_known"),
    )
    # A test of an aggregate: a null test of the keys would be moved below the
    # first sum, where it parses every row of the extract.
    return sums.filter(F.col("_known") > 0).drop("_known")


def latest_period(sums: DataFrame, as_of: int | Column | None = None, by: Sequence[str] = (),
                  at: str = "ref_year", value: str = "count") -> DataFrame:
    """Per group the greatest complete year or date, else the greatest one.

    Periods before ``as_of`` are complete; a Column states a test of its own and
    None takes every period.  ``sums`` is a table already summed to ``by`` +
    period + other keys.  Returns ``by``, the period and its total.  The total
    is part of the result so that a join back to ``sums`` reads the same shuffle
    output instead of the base table a second time.
    """
    totals = sums.filter(F.col(at).isNotNull()).groupBy(*by, at).agg(F.sum(value).alias("period_total"))
    if isinstance(as_of, Column):
        complete = as_of
    else:
        complete = F.lit(True) if as_of is None else F.col(at) < F.lit(as_of)
    chosen = F.max_by(F.struct(at, "period_total"), F.struct(complete, F.col(at))).alias("_chosen")
    latest = totals.groupBy(*by).agg(chosen).select(*by, "_chosen.*")
    return latest.filter(F.col(at).isNotNull())


def rows_of_latest_period(sums: DataFrame, as_of: int | Column | None = None, by: Sequence[str] = (),
                          at: str = "ref_year", value: str = "count") -> DataFrame:
    """Rows of the latest complete period of every group, with the period's total.

    A join on the period rather than a window: rows stay spread over the tasks,
    however many of them the latest period has.
    """
    # Null keys are ruled out on both sides of the join, which keeps both plans alike.
    sums = sums.filter(all_present(at, *by))
    return sums.join(latest_period(sums, as_of, by, at, value), [*by, at])


def latest_row(df: DataFrame, at: str, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``values`` of the row with the greatest ``at`` per group, by partial aggregation.

    Without groups there is always one row, of nulls for an empty input.
    """
    chosen = F.max_by(F.struct(at, *values), at).alias("_chosen")
    return df.filter(F.col(at).isNotNull()).groupBy(*by).agg(chosen).select(*by, "_chosen.*")


def rows_of_top_keys(df: DataFrame, key: str, at: str, k: int, value: str = "count", total: str = "total") -> DataFrame:
    """All periods of the keys with the greatest sums, with the sum and the key's rank (from 1); ties go to the lower key.

    ``df`` has one row per key and period, so a key's rows travel as one list:
    one shuffle, and no join back. Keys whose values are all null come last.
    """
    lists = df.groupBy(key).agg(F.sum(value).alias(total), F.collect_list(F.struct(at, value)).alias("_rows"))
    order = [F.col(total).desc_nulls_last(), F.col(key)]
    # k keys from here on.
    top = lists.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order)))
    return top.select(key, total, "rank", F.inline("_rows"))


def merge_counts(frames: Sequence[DataFrame], keys: Sequence[str], value: str = "count") -> DataFrame:
    """Add keyed counts from several inputs."""
    stacked = reduce(DataFrame.unionByName, [f.select(*keys, value) for f in frames])
    return sum_by(stacked, keys, value)


def reference_period(df: DataFrame, at: str, fallback: str, by: Sequence[str] = ()) -> DataFrame:
    """``min to max`` of a date or year column as text, or ``fallback`` without values."""
    return df.groupBy(*by).agg(period_text(at, fallback).alias("reference_period"))


def period_text(at: str, fallback: str) -> Column:
    """``reference_period`` as an aggregate."""
    low, high = F.min(at).cast("string"), F.max(at).cast("string")
    return F.when(F.count(at) > 0, F.concat_ws(" to ", low, high)).otherwise(F.lit(fallback))


def rollup_groups(df: DataFrame, code: str, groups: Mapping[str, str], labels: Mapping[str, str],
                  value: str = "count") -> DataFrame:
    """Sum codes into fixed groups; codes without a group keep their own label."""
    label = code_for(code, groups, default=code_for(code, labels, default=F.col(code)))
    return df.groupBy(label.alias("label")).agg(F.sum(value).alias(value))


def collect_ordered(df: DataFrame, order: Sequence[Column], fields: Sequence[str], name: str) -> DataFrame:
    """All rows as one array of structs in the given order, as a one-row frame.

    Only for rows that are few by definition: a top-k, the codes of a list, one
    row per listed source. Anything else is published row by row with
    ``sinks.publish_rows``.
    """
    rank = F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])
    pairs = F.array_sort(F.collect_list(F.struct(rank.alias("_rank"), F.struct(*fields).alias("row"))))
    return df.agg(F.transform(pairs, lambda p: p["row"]).alias(name))
