"""Running sums over ordered rows, with no group in one task.

Rows are range-partitioned and sorted by their order once, and remember their
partition (``chunk``) and their place among all rows. A running sum is then the
sum of the chunks before - one small row per group and chunk - plus the sum
inside the chunk, so a group that holds most rows is spread over as many tasks
as it fills chunks. Sums need the keys, chunk and place of a row only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statmart.session import materialized


def chunked(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The rows range-partitioned and sorted by ``order``, with ``chunk`` and ``place``, written once.

    Places grow with the order over all chunks and are different for any two
    rows; equal rows follow each other and may lie in several chunks.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    ranges = tied.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    return materialized(ranges.withColumns({"chunk": F.spark_partition_id(), "place": F.monotonically_increasing_id()}))


def sums_before(df: DataFrame, group: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """``df`` with, per name, the sum of its value over the earlier rows of the group (0 for the first).

    ``df`` has the chunks and places of ``chunked``, whose order began with the
    group or a part of it. Null keys are a group as well.
    """
    inside = Window.partitionBy(*group, "chunk").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    names = list(values)
    local = df.withColumns({name: F.coalesce(F.sum(values[name]).over(inside), F.lit(0)) for name in names})
    totals = df.groupBy(*group, "chunk").agg(*[F.sum(values[name]).alias(f"total_{i}") for i, name in enumerate(names)])
    # One row per group and chunk.
    over = Window.partitionBy(*group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *[F.col(key).alias(f"key_{i}") for i, key in enumerate([*group, "chunk"])],
        *[F.coalesce(F.sum(f"total_{i}").over(over), F.lit(0)).alias(f"before_{i}") for i in range(len(names))],
    )
    same = [F.col(key).eqNullSafe(F.col(f"key_{i}")) for i, key in enumerate([*group, "chunk"])]
    joined = local.join(before, same)
    return joined.select(*[c for c in df.columns if c not in names], *[
        (F.col(name) + F.col(f"before_{i}")).alias(name) for i, name in enumerate(names)
    ])
