"""Quality rules with risk-controlled thresholds (operator 6).

Fixed base rules come first. What passes them is judged by signals (symbols
per word, exclamation marks, upper-case words, repeated lines and passages,
mean word length). Their cutoffs come in levels from lenient to strict: a
document is rejected at a level if any signal exceeds the level's cutoff, so
what a level rejects, every later one rejects too.

For every stratum, labelled documents decide how strict a level may be. The
levels are tested in order; the hypothesis "this level rejects more than
``risk`` of the good documents" is rejected by the exact binomial tail, at
``confidence`` divided by the number of strata (Bonferroni). Testing stops at
the first level that fails, so the sequence of levels costs no correction. Of
the certified levels the most lenient one that catches most bad documents is
taken. A stratum with no certified level rejects nothing beyond the base.

Defined results: a null or empty text has no words and fails the base; a null
stratum is a stratum of its own; labels that are null, or repeat with a
difference, count as the lower quality (null: none); repeated rows are judged
each by itself; an empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.llm.common import STATISTICS, map_column, table, word_statistics
from statmart.session import materialized

RISK = 0.02
CONFIDENCE = 0.05
#: Cutoffs per signal, one for each level, lenient to strict.
LEVELS: dict[str, tuple[float, ...]] = {
    "symbols_per_word": (1.0, 0.6, 0.3, 0.15, 0.08, 0.04, 0.02),
    "exclaims_per_word": (1.0, 0.6, 0.3, 0.15, 0.08, 0.04, 0.02),
    "upper_share": (0.9, 0.8, 0.6, 0.4, 0.3, 0.2, 0.15),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35),
    "repeat_share": (0.48, 0.45, 0.42, 0.4, 0.38, 0.36, 0.34),
    "long_words": (16.0, 14.0, 12.0, 11.0, 10.0, 9.0, 8.0),
    "short_words": (-1.5, -1.8, -2.0, -2.2, -2.4, -2.6, -2.8),
}
N_LEVELS = 7
STATS_SCHEMA = T.StructType([T.StructField(name, T.LongType()) for name in STATISTICS])


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows packed as ``row``, with the counts of their whole text."""
    return map_column(df, text, STATS_SCHEMA, lambda: lambda texts: list(zip(*map(word_statistics, texts))))


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    words = F.col("n_words")
    return (words < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * words)


def signals() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "exclaims_per_word": F.col("n_exclaims") / words,
        "upper_share": F.col("n_upper_words") / words,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words,
        "long_words": F.col("word_chars") / words,
        "short_words": -(F.col("word_chars") / words),
    }


def strictness(levels: dict[str, Sequence[float]] = LEVELS) -> Column:
    """The first level (from 1) at which a document is rejected; one more than there are, if at none."""
    def first(signal: Column, cutoffs: Sequence[float]) -> Column:
        found = F.lit(len(cutoffs) + 1)
        for level in range(len(cutoffs), 0, -1):
            found = F.when(signal > cutoffs[level - 1], F.lit(level)).otherwise(found)
        return found

    found = signals()
    return F.least(*[first(found[name], cutoffs) for name, cutoffs in levels.items()])


def binomial_tail(k: float, n: float, p: float) -> float:
    """P(X <= k) for X binomial(n, p), as a regularised incomplete beta function."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1.0, 1.0 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, 1.0 - x) / b


def _fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, by Lentz's method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 100_000):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-13:
            break
    return value


def certified_levels(judged: DataFrame, labels: DataFrame, risk: float = RISK,
                     confidence: float = CONFIDENCE) -> DataFrame:
    """One row per labelled stratum: ``stratum``, the certified ``level`` (0: none), and its counts.

    ``judged`` has doc_id, stratum, level; ``labels`` doc_id and quality.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = (
        judged.join(known, "doc_id")
        .groupBy("stratum", "level")
        .agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") != 1).cast("long")).alias("bad"))
    )
    # At most one row per stratum and level from here on.
    per_level = counts.groupBy("stratum").agg(
        F.sum("good").alias("n_good"), F.collect_list(F.struct("level", "good", "bad")).alias("hits")
    )
    n_strata = per_level.agg(F.count(F.lit(1))).first()[0]
    tested = confidence / max(1, n_strata)

    @F.pandas_udf("struct<level int, n_false long, n_caught long>")
    def choose(n_good: pd.Series, hits: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [_strictest(int(n), [(h["level"], h["good"], h["bad"]) for h in rows], risk, tested) for n, rows in zip(n_good, hits)],
            columns=["level", "n_false", "n_caught"],
        )

    return per_level.select("stratum", "n_good", choose("n_good", "hits").alias("c")).select("stratum", "n_good", "c.*")


def _strictest(n_good: int, hits: list[tuple[int, int, int]], risk: float, tested: float) -> tuple[int, int, int]:
    best = (0, 0, 0)
    for level in range(1, N_LEVELS + 1):
        false = sum(good for at, good, _ in hits if at <= level)
        caught = sum(bad for at, _, bad in hits if at <= level)
        if binomial_tail(false, n_good, risk) > tested:
            break
        if caught > best[2]:
            best = (level, false, caught)
    return best


def stratum_key(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("\0"))


def judge(counted: DataFrame, levels: DataFrame) -> DataFrame:
    """Rows with ``STATISTICS`` and ``stratum``, judged by the certified levels.

    Adds base_failed, strictness and kept. ``levels`` has one row per stratum;
    Spark broadcasts it by its size.
    """
    return (
        counted.withColumns({"base_failed": base_failed(), "strictness": strictness()})
        .join(levels.select("stratum", F.col("level").alias("certified")), "stratum", "left")
        .withColumn("kept", ~F.col("base_failed") & (F.col("strictness") > F.coalesce("certified", F.lit(0))))
        .drop("certified")
    )


def fit_levels(counted: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """Certified levels of rows with doc_id, stratum and ``STATISTICS``; written once."""
    reach = counted.where(~base_failed()).select("doc_id", "stratum", strictness().alias("level"))
    return materialized(certified_levels(reach, labels, risk, confidence))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text") -> DataFrame:
    """The documents the rules keep, with their columns; texts are counted twice rather than shuffled."""
    def counted(df: DataFrame, *columns: str) -> DataFrame:
        return with_statistics(df, text).select(*columns, stratum_key(F.col(f"row.`{stratum}`")).alias("stratum"), *STATISTICS)

    levels = fit_levels(counted(docs.select("doc_id", stratum, text), "row.doc_id"), labels)
    return judge(counted(docs, "row"), levels).where("kept").select("row.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and the level at which a document falls."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    counted = materialized(with_statistics(docs).select("row.doc_id", stratum_key(F.col("row.lang")).alias("stratum"), *STATISTICS))
    levels = fit_levels(counted, table(spark, sf_dir, "labels"))
    return judge(counted, levels).select("doc_id", *STATISTICS[:5], "base_failed", "kept", "strictness")
