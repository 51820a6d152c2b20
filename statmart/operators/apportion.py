"""Exact largest-remainder apportionment, and top-k lists that reconcile to a total.

Weights and targets are whole numbers.  A key's share is
``target * weight div total``; the units left over go to the greatest
remainders, ties to the greater weight and then to the lower key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statmart.functions import all_present, div, not_negative, wide
from statmart.operators.dedupe import top_per_key
from statmart.operators.rollup import sum_by
from statmart.session import materialized


def apportion(weights: DataFrame, targets: DataFrame, by: Sequence[str], key: str, weight: str = "count",
              target: str = "target", scaled: str = "scaled", zero_policy: str = "other") -> DataFrame:
    """Scale integer weights of every group to the group's target, exactly.

    ``weights`` has one row per ``by`` + ``key``.  With
    ``zero_policy="other"`` weights that are null or not positive are dropped,
    so a group without weights gives no rows, and neither does one without a
    positive target; with ``"even"`` all rows stay, and a group of zeros shares
    its target evenly in key order.

    Built for groups of any size, without sorting them (``_cut_offs``): shares
    and remainders are worked out row by row from the group's sums, and a row
    gets one unit more if it does not come after the group's cut-off row. Per
    group one row is joined back.
    """
    by = list(by)
    if zero_policy == "other":
        rows, targets = weights.filter(F.col(weight) > 0), targets.filter(F.col(target) > 0)
    elif zero_policy == "even":
        rows = weights.withColumn(weight, F.greatest(F.coalesce(weight, F.lit(0)), F.lit(0)))
    else:
        raise ValueError(f"unknown zero_policy {zero_policy!r}")
    rows = rows.filter(all_present(*by, key)).select(*by, F.col(key).alias("_key"), F.col(weight).alias("_weight"))
    sums = rows.groupBy(*by).agg(F.sum(wide("_weight")).cast("decimal(38,0)").alias("_sum"), F.count("*").alias("_n"))
    goals = sums.join(targets.select(*by, not_negative(target).alias("_target")), by)
    state, cuts = _cut_offs(rows, goals, by)
    placed = _shares(rows.join(state.select(*by, "_sum", "_n", "_target"), by)).join(cuts, by, "left")
    # Before the cut-off row: by remainder, then weight, then key.
    first = F.col("_rest") > F.col("_cut._rest")
    same = F.col("_rest") == F.col("_cut._rest")
    heavier = F.col("_weight") > F.col("_cut._weight")
    level = F.col("_weight") == F.col("_cut._weight")
    more = F.coalesce(first | (same & (heavier | (level & (F.col("_key") <= F.col("_cut._key"))))), F.lit(False))
    return placed.select(
        *by, F.col("_key").alias(key), F.col("_weight").alias(weight), (F.col("_base") + more.cast("int")).cast("bigint").alias(scaled)
    )


#: Ranges a group's undecided rows are counted by, at each step.
BUCKETS = 1024
#: Undecided rows of a group that are few enough to be ranked.
FEW = 10_000
#: What rows are ranked by, and whether great values come first.
ORDER = (("_rest", True), ("_weight", True), ("_key", False))


def _shares(rows: DataFrame) -> DataFrame:
    """The whole share of every row, and the remainder."""
    # A group of zeros is dealt like a group of ones.
    empty = F.col("_sum") == 0
    product = (wide("_target") * F.when(empty, wide(F.lit(1))).otherwise(wide("_weight"))).cast("decimal(38,0)")
    whole = F.when(empty, F.col("_n")).otherwise(F.col("_sum")).cast("decimal(38,0)")
    return rows.withColumns({"_product": product, "_whole": whole}).withColumns({
        "_base": div(F.col("_product"), F.col("_whole")).cast("bigint"), "_rest": (F.col("_product") % F.col("_whole")).cast("decimal(38,0)"),
    })


def _cut_offs(rows: DataFrame, goals: DataFrame, by: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """What is known of every group, and the last row of each that gets a unit of those left over.

    Selection by counting: the rows of a group are counted by ranges of
    remainder; the range in which the units run out holds the cut-off row, all
    rows before it get a unit, all behind it none. That is enough if few rows
    are in that range. Otherwise - many equal remainders - the range is counted
    by finer ranges, then by ranges of weight and of key, until few rows are
    left in every group; those are ranked. Counts are added up before they are
    shuffled, so a group of any size sends at most ``BUCKETS`` rows per task.
    """
    bounds = {f"_{side}{c}": F.lit(None).cast(dict(_shares(rows.join(goals, list(by))).dtypes)[c]) for c, _ in ORDER for side in ("low", "high")}
    whole = F.col("_whole")
    width = (div(whole - 1, F.lit(BUCKETS).cast("decimal(38,0)")) + 1).cast("decimal(38,0)")
    counted = _shares(rows.join(goals, list(by))).groupBy(*by, "_sum", "_n", "_target", div(whole - 1 - F.col("_rest"), width).alias("_bucket")).agg(
        F.count("*").alias("_rows"), F.sum("_base").alias("_given"), F.min("_rest").alias("_low_rest"), F.max("_rest").alias("_high_rest")
    )
    group = Window.partitionBy(*by)
    needed = counted.withColumn("_need", F.col("_target") - F.sum("_given").over(group))
    state = _crossing(needed, by).withColumns({n: c for n, c in bounds.items() if not n.endswith("_rest")})
    state = materialized(state.select(*by, "_sum", "_n", "_target", "_need", "_rows", *bounds))
    for column, descending in ORDER:
        while not state.where((F.col("_rows") > FEW) & _is_open(column)).isEmpty():
            settled = state.where((F.col("_rows") <= FEW) | ~_is_open(column))
            finer = _finer(rows, state.where((F.col("_rows") > FEW) & _is_open(column)), by, column, descending)
            state = materialized(settled.unionByName(finer.select(*state.columns)))
    undecided = _shares(rows.join(state.where("_need > 0"), list(by))).where(_in_bounds())
    order = [F.col(c).desc() if descending else F.col(c).asc() for c, descending in ORDER]
    ranked = undecided.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rank") == F.col("_need"))
    return state, ranked.select(*by, F.struct(*[c for c, _ in ORDER]).alias("_cut"))


def _is_open(column: str) -> Column:
    """Whether a group's undecided rows may differ in a column; unknown bounds may."""
    return F.coalesce(F.col(f"_low{column}") < F.col(f"_high{column}"), F.lit(True))


def _in_bounds() -> Column:
    """Whether a row is undecided."""
    tests = [F.coalesce(F.col(c).between(F.col(f"_low{c}"), F.col(f"_high{c}")), F.lit(True)) for c, _ in ORDER]
    return tests[0] & tests[1] & tests[2]


def _crossing(counted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of each group the range in which the units run out, and how many of them its rows get; the first one if there are none."""
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    crosses = (F.col("_before") < F.col("_need")) & (F.col("_need") <= F.col("_before") + F.col("_rows"))
    none = (F.col("_need") <= 0) & (F.col("_before") == 0)
    return placed.where(crosses | none).withColumn("_need", F.greatest(F.col("_need") - F.col("_before"), F.lit(0)))


def _finer(rows: DataFrame, state: DataFrame, by: Sequence[str], column: str, descending: bool) -> DataFrame:
    """The state of groups after one more count of their undecided rows, by ranges of a column."""
    low, high, value = F.col(f"_low{column}"), F.col(f"_high{column}"), F.col(column)
    kind = dict(state.dtypes)[f"_low{column}"]
    if kind == "string":
        # All texts between two others begin like both; ranges are what follows.
        shared = F.length(F.regexp_extract(F.concat(low, F.lit("\0"), high), r"(?s)^(.*).*\x00\1", 1))
        state = state.withColumn("_shared", shared)
        bucket = F.when(low.isNotNull(), F.substring(value, F.lit(1), F.col("_shared") + 2)).otherwise(F.lit(""))
    elif kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal"):
        first, last, at = (wide(c) for c in (low, high, value))
        width = (div(last - first, F.lit(BUCKETS).cast("decimal(38,0)")) + 1).cast("decimal(38,0)")
        bucket = F.coalesce(div((last - at if descending else at - first).cast("decimal(38,0)"), width), F.lit(0).cast("bigint"))
    else:
        # Other keys are counted one by one.
        bucket = value
    kept = [c for c in state.columns if c not in (*by, "_rows", f"_low{column}", f"_high{column}")]
    counted = _shares(rows.join(state, list(by))).where(_in_bounds()).groupBy(*by, bucket.alias("_bucket")).agg(
        F.count("*").alias("_rows"), F.min(column).alias(f"_low{column}"), F.max(column).alias(f"_high{column}"),
        *[F.first(c).alias(c) for c in kept],
    )
    return _crossing(counted, by)


def apportion_codes(weights: Sequence[tuple[str, Column]], target: Column) -> Column:
    """Apportion a target over a short fixed code list, inside one row.

    Returns an array of ``(code, weight, scaled)`` in the order given.  Without
    any weight the target is dealt evenly, first codes first.
    """
    goal = not_negative(target)
    given = [F.coalesce(w, F.lit(0)).cast("bigint") for _, w in weights]
    total = sum((wide(w) for w in given[1:]), wide(given[0])).cast("decimal(38,0)")
    empty = total == 0
    whole = F.when(empty, wide(F.lit(len(given)))).otherwise(total)

    def entry(place: int, code: str, w: Column) -> Column:
        product = (wide(goal) * F.when(empty, wide(F.lit(1))).otherwise(wide(w))).cast("decimal(38,0)")
        return F.struct(
            (-(product % whole)).alias("rest"),
            (-w).alias("less"),
            F.lit(place).alias("place"),
            F.lit(code).alias("code"),
            w.alias("weight"),
            div(product, whole).alias("base"),
        )

    ranked = F.array_sort(F.array(*[entry(i, code, w) for i, ((code, _), w) in enumerate(zip(weights, given))]))
    spent = F.aggregate(ranked, F.lit(0).cast("bigint"), lambda acc, e: acc + e["base"])
    dealt = F.transform(
        ranked,
        lambda e, i: F.struct(
            e["place"].alias("place"),
            e["code"].alias("code"),
            e["weight"].alias("weight"),
            (e["base"] + F.when(i < goal - spent, 1).otherwise(0)).cast("bigint").alias("scaled"),
        ),
    )
    return F.transform(
        F.array_sort(dealt), lambda e: F.struct(e["code"].alias("code"), e["weight"].alias("weight"), e["scaled"].alias("scaled"))
    )


def topk_with_other(df: DataFrame, by: Sequence[str], key: str, value: str, k: int,
                    totals: DataFrame, total: str = "total") -> tuple[DataFrame, DataFrame]:
    """Top-k rows of every group, and per group what the total holds beyond them.

    Returns ``(top, groups)``: ``top`` has ``by``, key, value and rank, from
    positive values only; ``groups`` has ``by``, the total and ``non_top``.
    """
    by = list(by)
    order = [F.col(value).desc(), F.col(key).asc()]
    top = top_per_key(df.filter(F.col(value) > 0).select(*by, key, value), by, order, k, rank_as="rank")
    listed = sum_by(top, by, value, alias="_listed")
    groups = (
        totals.select(*by, not_negative(total).alias(total))
        .join(listed, by, "left")
        .withColumn("non_top", not_negative(F.col(total) - F.coalesce("_listed", F.lit(0))))
        .drop("_listed")
    )
    return top, groups


def with_other_row(top: DataFrame, groups: DataFrame, key: str, value: str, other: Column | str) -> DataFrame:
    """Top-k rows plus one row per group for a remainder that is not 0."""
    label = F.lit(other) if isinstance(other, str) else other
    by = [c for c in top.columns if c not in (key, value, "rank")]
    rest = groups.filter(F.col("non_top") > 0).select(*by, label.alias(key), F.col("non_top").alias(value))
    return top.select(*by, key, value).unionByName(rest)
