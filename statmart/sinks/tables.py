"""Keyed warehouse tables: full replace, slice replace, append.

Rows are written to a folder of their own and checked there before a pointer
makes them the table's (``sinks.versions``), so the extract is computed once, a
failed load changes nothing, and readers see all of a load or nothing of it.
What is said of a load - its rows, its period, empty required columns - is
observed while the rows are written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from statmart.operators.dedupe import key_violations
from statmart.schemas import Table
from statmart.sinks import files, logs, versions


class BrokenKey(ValueError):
    """Rows break the declared key or a required column."""


def shape_for(df: DataFrame, table: Table, constants: Mapping[str, Column | object] | None = None) -> DataFrame:
    """Bring a frame into the column order and types of its table.

    ``constants`` fill columns the frame does not have; ``loaded_at`` is the
    time of the load unless given.
    """
    filled = {"loaded_at": F.current_timestamp(), **(constants or {})}
    columns = []
    for field in table.schema:
        if field.name in df.columns:
            value = F.col(f"`{field.name}`")
        else:
            value = filled[field.name]
            value = value if isinstance(value, Column) else F.lit(value)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def check_keys(df: DataFrame, table: Table) -> None:
    """Refuse rows that break the table's key or leave a required column empty."""
    broken = key_violations(df, table.key, table.not_null)
    example = F.struct(*broken.columns)
    found = broken.agg(F.count(F.lit(1)).alias("n"), F.min(example).alias("first"), F.max(example).alias("last")).first()
    if found["n"]:
        examples = list(dict.fromkeys([found["first"], found["last"]]))
        raise BrokenKey(f"{table.name}: {found['n']} broken keys, such as {[row.asDict() for row in examples]}")


@dataclass(frozen=True)
class Replaced:
    """What was seen of the rows while they were written: their number, and what ``period`` found in them."""

    rows: int = 0
    period: str | None = None
    null_rows: int = 0


Check = Callable[[Replaced], None]


def _stage(df: DataFrame, path: str, table: Table | None, period: Column | None, by: Sequence[str],
           check: Check | None) -> tuple[str, Replaced]:
    """Write to a new folder and look at the rows on their way: one pass for rows, period and missing values.

    Only the key columns are read back, to find keys that occur twice.
    """
    spark = df.sparkSession
    staged = versions.new_folder(path)
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if period is not None:
        metrics.append(period.alias("period"))
    if table is not None:
        required = [F.col(f"`{c}`").isNull() for c in dict.fromkeys([*table.key, *table.not_null])]
        metrics.append(F.count_if(reduce(or_, required)).alias("null_rows"))
    # Rebalancing gives a large partition several files and a small one a single file.
    rows = (df.hint("rebalance", *by) if by else df).observe(seen, *metrics)
    try:
        (rows.write.partitionBy(*by) if by else rows.write).parquet(staged)
        done = Replaced(**seen.get)
        if done.null_rows:
            raise BrokenKey(f"{table.name}: {done.null_rows} rows lack a required value")
        if table is not None and done.rows:
            check_keys(spark.read.schema(df.schema).parquet(staged).select(*table.key), replace(table, columns=()))
        if check is not None:
            check(done)
        return staged, done
    except Exception:
        files.remove(spark, staged)
        raise


def replace_table(df: DataFrame, path: str, table: Table | None = None, keep_if_empty: bool = False,
                  period: Column | None = None, check: Check | None = None) -> Replaced:
    """Replace a whole table.

    With ``keep_if_empty`` an empty extract leaves the old rows in place.
    ``period`` is an aggregate over the rows of this load. A table that names
    a column to be laid out or sliced by is written by it. ``check`` sees what was
    written before it counts; if it raises, the old rows stay.
    """
    spark = df.sparkSession
    by = [c for c in (table.laid_out_by or table.slice_by,) if c] if table is not None else []
    staged, done = _stage(df, path, table, period, by, check)
    if done.rows == 0 and keep_if_empty:
        files.remove(spark, staged)
    else:
        versions.replace_all(spark, path, staged)
    return done


def replace_slice(df: DataFrame, path: str, by: str, table: Table | None = None, period: Column | None = None,
                  check: Check | None = None) -> Replaced:
    """Replace the slices that occur in the frame; other slices stay.

    Rows are written once, by slice, and checked; then one pointer makes all of
    them the table's at once.
    """
    spark = df.sparkSession
    staged, done = _stage(df, path, table, period, [by], check)
    if done.rows:
        versions.replace_parts(spark, path, staged)
    else:
        files.remove(spark, staged)
    return done


def append_rows(df: DataFrame, path: str) -> None:
    """Add log rows."""
    logs.append(df, path)
