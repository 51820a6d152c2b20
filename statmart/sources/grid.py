"""Worksheets as cells: ``sheet, row_idx, col_idx, value, is_text``.

Empty cells have no row, or a null value.  Many sheets are handled at once.
A sheet exported as delimited text has no header that could be relied on, so
its rows are known by their number only; ``read_grid`` finds it for files of
any size, read in many splits.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statmart import codes
from statmart.functions import drop_null_tokens, is_blank, parse_count
from statmart.session import materialized
from statmart.sources.delimited import fields_of, unquoted


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def read_grid(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Cells of delimited sheets without a header line: one sheet per file, named like it, or like its folder ``sheet=<name>``.

    ``row_idx`` is the number of the line in its file, from 0, however many
    splits the file is read in: lines are counted per split, the splits before
    are added up, and lines are numbered inside their split. Blank lines count
    as rows without cells. A cell is text unless it is a plain number (quoted
    numbers are text). Quotes around a field are taken off; a quoted field
    cannot go on in the next line, since files are split between lines.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        F.regexp_replace("value", "^\ufeff", "").alias("line"),
    )
    return cells_of(numbered(lines, ["file"], "split", "place"), sep)


def numbered(rows: DataFrame, group: Sequence[str], split: str, place: str, number: str = "row_idx") -> DataFrame:
    """Rows with their number in the group, from 0; places follow each other inside a split, splits are ordered.

    Rows are written once, so places stay what they are, whatever executors are
    lost. Only one row per split is ordered.
    """
    written = materialized(rows)
    splits = written.groupBy(*group, split).agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy(split).rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
    return written.join(starts.drop("_first", "_n"), [*group, split]).withColumn(number, F.col("_start") + F.col(place)).drop("_start")


def cells_of(lines: DataFrame, sep: str) -> DataFrame:
    """The cells of numbered lines."""
    folder = F.regexp_extract("file", "/sheet=([^/]+)/[^/]+$", 1)
    name = F.regexp_replace(F.element_at(F.split("file", "/"), -1), r"\.[A-Za-z0-9]+$", "")
    # Names in file paths are escaped once, those of partition folders twice.
    plain = [F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))) for c in (folder, name)]
    sheet = F.when(folder != "", F.url_decode(F.replace(plain[0], F.lit("+"), F.lit("%2B")))).otherwise(plain[1])
    cells = lines.select(sheet.alias("sheet"), "row_idx", F.posexplode(fields_of(F.col("line"), sep)).alias("col_idx", "field"))
    value = unquoted(F.col("field"))
    return cells.where(value != "").select(
        "sheet", "row_idx", "col_idx", value.alias("value"), (~F.col("field").rlike(NUMBER)).alias("is_text")
    )


def header_rows(cells: DataFrame, probe_rows: int = 10, min_cells: int = 3) -> DataFrame:
    """Header row per sheet: the first probed row with enough cells, all text; row 0 without one."""
    present = cells.filter((F.col("row_idx") < probe_rows) & F.col("value").isNotNull())
    rows = present.groupBy("sheet", "row_idx").agg(
        F.count("*").alias("n_cells"), F.bool_and("is_text").alias("all_text")
    )
    fits = (F.col("n_cells") >= min_cells) & F.col("all_text")
    found = F.min(F.when(fits, F.col("row_idx")))
    return rows.groupBy("sheet").agg(F.coalesce(found, F.lit(0)).cast("bigint").alias("header_row"))


def promote_header(cells: DataFrame, probe_rows: int = 10, min_cells: int = 3) -> DataFrame:
    """Column names per sheet, taken from the header row."""
    headers = header_rows(cells, probe_rows, min_cells)
    # A header row is one of the probed rows, so the join reads only those.
    probed = cells.filter((F.col("row_idx") < probe_rows) & F.col("value").isNotNull())
    return (
        probed.join(headers, "sheet")
        .filter(F.col("row_idx") == F.col("header_row"))
        .select("sheet", "header_row", "col_idx", F.col("value").alias("name"))
    )


def unpivot_year_totals(cells: DataFrame, country_col: int = 0, subtype_col: int = 1, skip_rows: int = 2,
                        null_tokens: Iterable[str] = codes.NULL_TOKENS, probe_rows: int = 10,
                        min_cells: int = 3) -> DataFrame:
    """One row per sheet, country and year from a pivoted sheet.

    The first row below the header marks year columns with ``"<yyyy> Total"``.
    Rows below the preamble without a sub-type are country totals.  Unreadable
    numbers stay null.  Where a cell occurs more than once, its greatest
    readable number counts, and the last text in byte order.
    """
    value = drop_null_tokens("value", null_tokens)
    sheets = _year_columns(cells, probe_rows, min_cells)
    year = F.get(F.filter("years", lambda y: y["col_idx"] == F.col("col_idx")), F.lit(0))["ref_year"]
    body = (
        cells.join(sheets, "sheet")
        .filter(F.col("row_idx") > F.col("header_row") + skip_rows)
        .withColumn("_year", F.when(~F.col("col_idx").isin(country_col, subtype_col), year))
        .filter(F.col("col_idx").isin(country_col, subtype_col) | F.col("_year").isNotNull())
    )
    # One value per cell first, so that a repeated cell has no second entry in the map of its row; rows are dealt out once for both sums.
    single = body.repartition("sheet", "row_idx").groupBy("sheet", "row_idx", "col_idx", "_year").agg(
        F.max(value).alias("value"), F.max(F.when(F.col("_year").isNotNull(), parse_count(value))).alias("_number"), F.first("years").alias("years")
    )
    # A sheet row holds one cell per year column, so the map is small.
    rows = single.groupBy("sheet", "row_idx").agg(
        F.max(F.when(F.col("col_idx") == country_col, F.trim("value"))).alias("country"),
        F.max(F.when(F.col("col_idx") == subtype_col, F.col("value"))).alias("_subtype"),
        F.map_from_entries(F.collect_list(F.when(F.col("_year").isNotNull(), F.struct("_year", "_number")))).alias("_numbers"),
        F.first("years").alias("years"),
    )
    totals = rows.filter(F.col("_subtype").isNull() & ~is_blank("country") & (F.col("country") != "nan"))
    # Every total row gives a row per year column, also where the cell is empty.
    return totals.withColumn("_y", F.explode("years")).select(
        "sheet",
        "row_idx",
        F.col("_y.ref_year").alias("ref_year"),
        F.lit(codes.WHOLE_YEAR).alias("ref_month"),
        "country",
        F.lit(codes.NO_DIMENSION).alias("province"),
        F.try_element_at("_numbers", F.col("_y.ref_year")).alias("count"),
    )


def _year_columns(cells: DataFrame, probe_rows: int, min_cells: int) -> DataFrame:
    """Per sheet the header row and the columns marked as year totals; the last column of a year counts."""
    value = F.trim("value")
    marked = (
        cells.filter((F.col("row_idx") <= probe_rows) & F.col("value").isNotNull())
        .join(header_rows(cells, probe_rows, min_cells), "sheet")
        .filter((F.col("row_idx") == F.col("header_row") + 1) & value.rlike(r"^[0-9]{4} Total$"))
        .groupBy("sheet", "header_row", F.substring(value, 1, 4).cast("int").alias("ref_year"))
        .agg(F.max("col_idx").alias("col_idx"))
    )
    return marked.groupBy("sheet", "header_row").agg(F.collect_list(F.struct("col_idx", "ref_year")).alias("years"))
