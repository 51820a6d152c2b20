"""Resource catalogs: package responses as rows, and the best resource of each dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The fields of a package response that are read.
RESOURCE = ("id", "name", "description", "format", "url", "last_modified", "metadata_modified", "created")
PACKAGE = (
    "success boolean, result struct<id: string, title: string, "
    f"resources: array<struct<{', '.join(f'{name}: string' for name in RESOURCE)}>>>, _broken string"
)

RECENCY = ("last_modified", "metadata_modified", "created", "name")


def read_packages(spark: SparkSession, path: str | Sequence[str], one_per_file: bool = True) -> DataFrame:
    """Package responses as they were fetched: one JSON document per file, or one per line.

    Fields that a response lacks are null, fields beyond the known ones are not
    read. ``error`` says why a response cannot be used; null for good ones.
    """
    reader = spark.read.schema(PACKAGE).option("columnNameOfCorruptRecord", "_broken").option("multiLine", one_per_file)
    read = reader.json(path if isinstance(path, str) else list(path))
    error = (
        F.when(F.col("_broken").isNotNull(), "not a package response")
        .when(~F.coalesce("success", F.lit(False)), "the request has failed")
        .when(F.coalesce(F.size("result.resources"), F.lit(0)) < 1, "no resources")
    )
    return read.select(
        F.col("_metadata.file_path").alias("file"), error.alias("error"),
        F.col("result.id").alias("dataset_id"), F.col("result.title").alias("title"), F.col("result.resources").alias("resources"),
    )


def read_catalog(spark: SparkSession, path: str | Sequence[str], one_per_file: bool = True) -> DataFrame:
    """One row per resource of all usable package responses, for ``best_resources``.

    A resource without an id is left out. A dataset that was fetched more than
    once counts with each of its responses; equal resources come once.
    """
    usable = read_packages(spark, path, one_per_file).where(F.col("error").isNull())
    rows = usable.select("dataset_id", "title", F.inline("resources")).where(F.col("id").isNotNull())
    return rows.distinct()


def broken_packages(spark: SparkSession, path: str | Sequence[str], one_per_file: bool = True) -> DataFrame:
    """The responses that cannot be used: file and reason."""
    return read_packages(spark, path, one_per_file).where(F.col("error").isNotNull()).select("file", "dataset_id", "error")


def score_resources(catalog: DataFrame, keywords: Sequence[str], required: Sequence[str] = (),
                    format_wanted: str = "csv", min_score: int = 1) -> DataFrame:
    """Resources that hold every required word, with 2 points per keyword and 1 for the format."""
    text = F.lower(F.concat_ws(" ", F.coalesce("name", F.lit("")), F.coalesce("description", F.lit(""))))
    points = F.when(F.lower(F.coalesce("format", F.lit(""))) == format_wanted, 1).otherwise(0)
    for word in keywords:
        points = points + F.when(text.contains(word.lower()), 2).otherwise(0)
    kept = catalog
    for word in required:
        kept = kept.filter(text.contains(word.lower()))
    return kept.withColumn("score", points).filter(F.col("score") >= min_score)


def best_resources(catalog: DataFrame, by: Sequence[str], keywords: Sequence[str], required: Sequence[str] = (),
                   format_wanted: str = "csv", min_score: int = 1, recency: Sequence[str] = RECENCY,
                   tie: str = "id", pinned: Sequence[str] = (), all_ties: bool = False) -> DataFrame:
    """Best resource per dataset by score, then by the newest dates and name.

    Rows equal in all of that are decided by ``tie``, or all returned with
    ``all_ties``.  A ``pinned`` id wins within its dataset, whatever its score
    (null in the result); datasets without one are ranked as usual.
    """
    scored = score_resources(catalog, keywords, required, format_wanted, min_score)
    if pinned:
        own = catalog.filter(F.col(tie).isin(*pinned)).withColumn("score", F.lit(None).cast("int"))
        scored = scored.filter(~F.col(tie).isin(*pinned)).unionByName(own)
    # Missing texts compare as empty ones.
    newest = [
        (F.coalesce(c, F.lit("")) if kind == "string" else F.col(c)).desc_nulls_last()
        for c in recency for name, kind in catalog.dtypes if name == c
    ]
    # Only pinned rows have no score.
    order = [F.col("score").desc_nulls_first(), *newest]
    rank = F.rank() if all_ties else F.row_number()
    window = Window.partitionBy(*by).orderBy(*order, *([] if all_ties else [F.col(tie)]))
    return scored.withColumn("_rank", rank.over(window)).filter("_rank = 1").drop("_rank")
