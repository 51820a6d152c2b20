"""One row per key, and rows that break a declared key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], k: int = 1,
                rank_as: str | None = None) -> DataFrame:
    """The first ``k`` rows of every key in the given order, which must be total.

    The rank filter lets Spark cut every key to ``k`` rows in each input
    partition before the shuffle, so a key that holds a third of the table
    sends ``k`` rows per partition and no more.
    """
    name = rank_as or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if rank_as else kept.drop(name)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """De-duplicate on ``keys``, keeping the first row in source order."""
    return top_per_key(df, keys, order)


def latest_per_key(df: DataFrame, keys: Sequence[str], at: str, tie: Sequence[Column | str] = ()) -> DataFrame:
    """The row with the greatest ``at`` of every key."""
    return top_per_key(df, keys, [F.col(at).desc_nulls_last(), *tie])


def key_violations(df: DataFrame, keys: Sequence[str], not_null: Sequence[str] = ()) -> DataFrame:
    """Keys that occur more than once or come with a null in a required column."""
    required = [F.col(c).isNull() for c in dict.fromkeys([*keys, *not_null])]
    any_null = required[0]
    for test in required[1:]:
        any_null = any_null | test
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n_rows"), F.count_if(any_null).alias("n_null_rows"))
        .filter((F.col("n_rows") > 1) | (F.col("n_null_rows") > 0))
    )
