"""Fill-in-the-middle by a learned rank index (operator 12).

A text is cut into lines, and two of its line boundaries, chosen by a hash of
the id, part it into prefix, middle and suffix:

    plain   the text
    psm     <P>prefix<S>suffix<M>middle
    spm     <S>suffix<P>prefix<M>middle

Cuts are ranks ("after r lines"), texts are cut at offsets. The map from one to
the other is a learned index over the boundary offsets of a block of texts:
straight segments that miss no offset by more than ``MISS``, and per boundary
what is left to the exact offset, one byte each. A cut is predicted by its
segment and then put right by its residual, so it is always exact, and the
index takes about a ninth of the offsets it stands for. Segments are fitted in
one pass: from its first boundary, a segment goes on as long as one slope
serves all boundaries so far.

Texts are worked on in blocks of bounded size; a longer text is a block of its
own. No text contains a marker, or it stays plain, so every output can be
taken apart again (``restored``).

Defined results: a null or empty text has no lines, is plain and stays empty; a
null id hashes as an empty one; repeated rows give equal rows; an empty table
gives no rows; other columns are carried along inside ``row``, so their names
cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from statmart.llm.common import table

SEED = 7
#: Of 100: how many texts are cut at all, and how many of those put the suffix first.
CUT_PERCENT = 100
SPM_PERCENT = 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: By how much a segment may miss an offset; what is left fits a signed byte.
MISS = 120
#: Code points and texts of a block.
BLOCK_CHARS = 1 << 21
BLOCK_ROWS = 256

RESULT = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType()),
])


def line_ends(text: str) -> np.ndarray:
    """Offsets in code points at which the lines of a text end."""
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.flatnonzero(points == 10) + 1
    return ends if len(ends) and ends[-1] == len(text) else np.append(ends, len(text))


class RankIndex:
    """Ascending offsets by rank: segments of lines and the residuals they leave."""

    def __init__(self, offsets: np.ndarray, miss: int = MISS):
        starts, bases, slopes = [], [], []
        at, n = 0, len(offsets)
        while at < n:
            length, slope = self._segment(offsets, at, miss)
            starts.append(at)
            bases.append(offsets[at])
            slopes.append(slope)
            at += length
        self.starts, self.bases, self.slopes = np.array(starts, np.int64), np.array(bases, np.int64), np.array(slopes)
        left = offsets - self._predicted(np.arange(n))
        self.residuals = left.astype(np.int8 if miss < 127 else np.int64)

    @staticmethod
    def _segment(offsets: np.ndarray, first: int, miss: int) -> tuple[int, float]:
        """How many boundaries one line from ``first`` serves, and its slope."""
        low, high, done, step = -np.inf, np.inf, 1, 32
        while first + done < len(offsets):
            ranks = np.arange(done, min(done + step, len(offsets) - first))
            rise = offsets[first + ranks] - offsets[first]
            # The slopes that serve all boundaries up to each of these.
            lows = np.maximum(np.maximum.accumulate((rise - miss) / ranks), low)
            highs = np.minimum(np.minimum.accumulate((rise + miss) / ranks), high)
            broken = np.flatnonzero(lows > highs)
            last = broken[0] if len(broken) else len(ranks)
            if last:
                low, high = lows[last - 1], highs[last - 1]
                done += last
            if len(broken):
                break
            step *= 2
        return int(done), 0.0 if done == 1 else float(low + high) / 2

    def _predicted(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.starts, ranks, "right") - 1
        return self.bases[segment] + np.rint(self.slopes[segment] * (ranks - self.starts[segment])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        """The exact offsets of these ranks."""
        return self._predicted(ranks) + self.residuals[ranks]


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers from the id."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i:i + 8], 16) for i in range(0, 32, 8)]


def rearranged(ids: list[int | None], texts: list[str | None], seed: int, cut_percent: int, spm_percent: int) -> list[list]:
    """The columns of ``RESULT`` for a block of texts."""
    texts = [t or "" for t in texts]
    ends = [line_ends(t) for t in texts]
    n = np.array([len(e) for e in ends], np.int64)
    lengths = np.array([len(t) for t in texts], np.int64)
    # All boundaries of the block in one ascending row; each text brings n + 1 of them.
    begins, first = np.cumsum(lengths) - lengths, np.cumsum(n + 1) - n - 1
    index = RankIndex(np.concatenate([begin + np.append(0, e) for begin, e in zip(begins, ends)]) if texts else np.zeros(0, np.int64))
    drawn = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
    one, other = drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1)
    low = (index.offsets(first + np.minimum(one, other)) - begins).tolist()
    high = (index.offsets(first + np.maximum(one, other)) - begins).tolist()
    rows = []
    for text, a, b, count, (_, _, cut, order) in zip(texts, low, high, n.tolist(), drawn.tolist()):
        if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or cut % 100 >= cut_percent:
            rows.append((count, "plain", None, None, text))
        elif order % 100 < spm_percent:
            rows.append((count, "spm", a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"))
        else:
            rows.append((count, "psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"))
    return [list(column) for column in zip(*rows)] if rows else [[] for _ in RESULT]


def blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows that are small together: first row and number of rows."""
    first, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > first and (total + size > BLOCK_CHARS or i - first >= BLOCK_ROWS):
            yield first, i - first
            first, total = i, 0
        total += size
    if len(sizes) > first:
        yield first, len(sizes) - first


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
                   cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Every row as ``row``, with n, form, prefix_chars, middle_chars and the rearranged text as ``output``."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    id_at, text_at = docs.columns.index(doc_id), docs.columns.index(text)
    arrow = to_arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0)
            sizes = pc.fill_null(pc.binary_length(whole.field(text_at)), 0).to_numpy(zero_copy_only=False)
            for start, count in blocks(sizes):
                rows = whole.slice(start, count)
                found = rearranged(rows.field(id_at).to_pylist(), rows.field(text_at).to_pylist(), seed, cut_percent, spm_percent)
                arrays = [pa.array(values, type=field.type) for values, field in zip(found, arrow)]
                yield pa.RecordBatch.from_arrays([rows, *arrays], names=["row", *arrow.names])

    return packed.mapInArrow(run, T.StructType([packed.schema["row"], *RESULT.fields]))


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from."""
    def between(first: str, second: str) -> Column:
        start = len(first) + 1
        return F.substring(output, F.lit(start), F.locate(second, output) - start)

    # The first two parts stand in either order; the one before the middle begins after the second marker.
    def before_middle(marker: str) -> Column:
        start = F.locate(marker, output) + len(marker)
        return F.substring(output, start, F.locate(MIDDLE, output) - start)

    middle = F.substring(output, F.locate(MIDDLE, output) + len(MIDDLE), F.length(output))
    psm = F.concat(between(PREFIX, SUFFIX), middle, before_middle(SUFFIX))
    spm = F.concat(before_middle(PREFIX), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's rearranged text and of the text restored from it."""
    done = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "row.doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


FILL_IN_MIDDLE_SQL = f"""
with whole as (
    select doc_id, coalesce(text, '') as t,
           sha256('{SEED}:' || coalesce(cast(doc_id as varchar), '')) as h
    from documents
),
lines as (
    select doc_id, t, string_split(t, chr(10)) as parts,
           length(t) - length(replace(t, chr(10), '')) + case when t = '' or ends_with(t, chr(10)) then 0 else 1 end as n,
           cast(('0x' || h[1:8]) as bigint) as h1, cast(('0x' || h[9:16]) as bigint) as h2,
           cast(('0x' || h[17:24]) as bigint) as h3, cast(('0x' || h[25:32]) as bigint) as h4
    from whole
),
cuts as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
           case when t = '' or contains(t, '{PREFIX}') or contains(t, '{SUFFIX}') or contains(t, '{MIDDLE}') or h3 % 100 >= {CUT_PERCENT} then 'plain'
                when h4 % 100 < {SPM_PERCENT} then 'spm' else 'psm' end as form
    from lines
),
placed as (
    select *,
           case when a = n then length(t) when a = 0 then 0 else length(array_to_string(parts[1:a], chr(10))) + 1 end as low,
           case when b = n then length(t) when b = 0 then 0 else length(array_to_string(parts[1:b], chr(10))) + 1 end as high
    from cuts
),
pieces as (
    select *, left(t, low) as prefix, substr(t, low + 1, high - low) as middle, substr(t, high + 1) as suffix from placed
),
written as (
    select *, case form when 'plain' then t
                        when 'psm' then '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        else '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle end as output
    from pieces
)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then cast(low as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(high - low as bigint) end as middle_chars,
       sha256(output) as output_sha256, sha256(t) as restored_sha256
from written
"""
