"""Delimited extracts, read as text and typed later."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statmart import codes
from statmart.functions import drop_null_tokens
from statmart.sinks.rejects import Rejects

# Rows of a file have no order in Spark; these columns restore it.
SOURCE_ORDER = ("_file", "_block", "_row")


#: What stands between quotes; possessive, so a long field costs no stack.
QUOTED = '[^"]*+(?:""[^"]*+)*+'
#: The whole line of a row with more fields than columns; null for all other rows.
BROKEN = "_broken"
#: What happens to rows with more fields than columns: the read fails, or they are marked.
FAIL, MARK = "fail", "mark"


def read_stat_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
                  with_order: bool = False, surplus: str = FAIL) -> DataFrame:
    """Comma-separated extract with a header; a byte-order mark is skipped.

    Every column is text.  Pass ``schema`` to save the look at the header line.
    A row with fewer fields than columns has nulls at its end; one with more
    makes the read fail, or is marked in ``BROKEN`` with ``surplus="mark"``
    (``split_rejects`` parts them).
    """
    return _read(spark, path, ",", schema, with_order, surplus)


def read_admin_tsv(spark: SparkSession, path: str | Sequence[str], schema: StructType | None = None,
                   null_tokens: Iterable[str] = codes.NULL_TOKENS, with_order: bool = False, surplus: str = FAIL) -> DataFrame:
    """Tab-separated extract in which several texts stand for a missing value."""
    df = _read(spark, path, "\t", schema, with_order, surplus)
    return df.select(*[
        F.col(f"`{c}`") if c in (*SOURCE_ORDER, BROKEN) else drop_null_tokens(F.col(f"`{c}`"), null_tokens).alias(c)
        for c in df.columns
    ])


def fields_of(line: Column, sep: str) -> Column:
    """The fields of one line, as they are written: quotes and all."""
    field = f'"{QUOTED}"[^{sep}]*+|[^{sep}]*+'
    # With a separator in front, every field begins with one.
    return F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f"{sep}({field})"), 1)


def unquoted(field: Column) -> Column:
    """The value of a field: without the quotes around it, doubled ones as one."""
    inner = F.replace(F.regexp_extract(field, f'^"({QUOTED})"$', 1), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"') & field.rlike(f'^"{QUOTED}"$'), inner).otherwise(field)


def _read(spark: SparkSession, path: str | Sequence[str], sep: str, schema: StructType | None,
          with_order: bool, surplus: str) -> DataFrame:
    if surplus not in (FAIL, MARK):
        raise ValueError(f"unknown surplus {surplus!r}")
    paths = path if isinstance(path, str) else list(path)
    reader = spark.read.options(header=True, sep=sep, encoding="UTF-8", enforceSchema=False, escape='"')
    if schema is None:
        schema = reader.csv(paths).schema
    marked = StructType([*schema.fields, StructField(BROKEN, StringType())])
    # Fields can only be counted where all of them are parsed, whatever columns a query uses.
    df = reader.options(columnNameOfCorruptRecord=BROKEN, columnPruning=False).schema(marked).csv(paths)
    # Spark marks rows with fewer fields as well; those are read with nulls.
    line = F.when(F.size(fields_of(F.col(BROKEN), sep)) > len(schema), F.col(BROKEN))
    order = [
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    ]
    columns = [F.col(f"`{c}`") for c in schema.names]
    if surplus == MARK:
        return df.select(*columns, line.alias(BROKEN), *(order if with_order else [order[0]]))
    message = F.concat(F.lit(f"more than {len(schema)} fields in a row: "), line)
    whole = df.where(F.when(line.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return whole.select(*columns, *(order if with_order else []))


def split_rejects(marked: DataFrame) -> tuple[DataFrame, Rejects]:
    """Good rows of a marked extract, and its malformed ones with the reason.

    The malformed ones are counted while the good ones are read, in the same
    scan; they are read again only if there are any.
    """
    broken = F.col(BROKEN).isNotNull()
    observed = Observation()
    good = marked.observe(observed, F.count_if(broken).alias("n_rejects")).where(~broken).drop(BROKEN)
    rows = marked.where(broken).select(
        F.col("_file").alias("file"), F.lit("more fields than columns").alias("reason"),
        F.col(f"`{marked.columns[0]}`").alias("first_field"), F.col(BROKEN).alias("line"),
    )
    return good, Rejects(rows, observed)


def select_columns(df: DataFrame, fixed: Iterable[str], wanted: Callable[[str], bool]) -> DataFrame:
    """The fixed columns and those the name test accepts; the scan reads no others."""
    names = set(fixed)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in names or wanted(c)])


def first_present(df: DataFrame, candidates: Iterable[str]) -> str:
    """The first candidate that is a column."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ValueError(f"none of the columns {list(candidates)} is present in {df.columns}")


def column_tagged(df: DataFrame, prefix: str, tag: str, required: bool = True) -> Column | None:
    """The first column that starts with ``prefix`` and contains ``tag``."""
    for name in df.columns:
        if name.startswith(prefix) and tag in name:
            return F.col(f"`{name}`")
    if required:
        raise ValueError(f"no column starting with {prefix!r} contains {tag!r}")
    return None
