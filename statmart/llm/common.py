"""What the operators share: reading, folds, word statistics, mapping texts in chunks."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
#: Rows turned into Python objects at a time; bounds memory together with the Arrow batch.
CHUNK = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is held out of training; a null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def sampled(key: Column, fraction: Column | float, seed: int = 7) -> Column:
    """A choice by hash that stays the same when a task is run again."""
    scale = 1 << 30
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(scale)) < F.lit(fraction) * scale


def map_column(df: DataFrame, column: str, result: T.StructType,
               make: Callable[[], Callable[[list], Sequence[Sequence]]], chunk: int = CHUNK) -> DataFrame:
    """Every row packed as ``row``, with the result of a function of one of its columns beside it.

    ``make`` builds the function once per task; it takes a list of values and
    returns one sequence per result field. Packing keeps the names of the
    input's columns apart from those of the results.
    """
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    at = df.columns.index(column)
    arrow = to_arrow_schema(result)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, chunk):
                rows = batch.column(0).slice(start, chunk)
                found = function(rows.field(at).to_pylist())
                arrays = [pa.array(values, type=field.type) for values, field in zip(found, arrow)]
                yield pa.RecordBatch.from_arrays([rows, *arrays], names=["row", *arrow.names])

    return packed.mapInArrow(run, T.StructType([packed.schema["row"], *result.fields]))


def repeated_windows(words: list[str], size: int = 3) -> int:
    """How many words lie in a window of ``size`` words that the text has twice or more."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered, end = 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + size - max(i, end)
            end = i + size
    return covered


def word_statistics(text: str | None) -> tuple[int, ...]:
    """The counts of ``STATISTICS`` for one whole text; a null text has no words."""
    if not text:
        return (0,) * len(STATISTICS)
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_windows(words),
        len(lines),
        text.count("!"),
        sum(map(str.isupper, words)),
        len(set(words)),
    )


STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_exclaims", "n_upper_words", "n_distinct_words",
)
