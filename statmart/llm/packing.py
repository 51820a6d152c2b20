"""Best-fit packing with certified bin counts (operator 5).

Documents are tokenised once; each becomes its ids and a closing id 1. Only
documents longer than ``CAPACITY`` are cut, into full pieces and a last one.

Pieces are dealt by hash into partitions of about ``PART_ROWS`` rows and packed
best-fit decreasing. For every partition, lower bounds by dual-feasible
functions say how few sequences could hold its pieces: for a threshold t,
pieces over CAPACITY - t count as full, pieces below t as nothing, others as
they are; or lengths are rounded to multiples of CAPACITY / k. The best wins. A partition that meets its bound is certified
optimal and done. A partition with a gap keeps its full sequences and gives up
the others; what was given up is dealt anew among fewer partitions, so that
documents of different partitions meet, and packed again. A round that does not lower the
number of sequences is not taken, and ends the exchange.

Defined results: a null or empty text is the single closing id; rows without
doc_id, and rows that repeat one, are packed each by itself; ties in length go
by doc_id, then piece, then token digest; an empty table gives no rows. Texts
are tokenised whole, in parts cut at white space, which the tokenizer never
crosses.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import CHUNK, table
from statmart.session import materialized

CAPACITY = 4096
END_ID = 1
PART_ROWS = 20_000
ROUNDS = 4
#: Rounding functions tried for the bound.
ROUNDINGS = 20
#: The tokenizer's white space (Unicode White_Space).
SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
#: What str.split takes for white space beyond that.
SEPARATORS = re.compile(r"[\x1c-\x1f]")
#: Letters that are the same in lower case and composed form, then marks of ASCII but the apostrophe.
WORD_AND_MARKS = re.compile(r"([a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]*)([!-&(-/:-@\[-`{-~]*)")
#: Parts remembered per task; cleared when full.
REMEMBERED = 300_000


def byte_characters() -> dict[int, int]:
    """The characters byte-level vocabularies use for bytes that are not printable."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {byte: 256 + i for i, byte in enumerate(b for b in range(256) if b not in printable)}


BYTE_CHARACTERS = byte_characters()


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class PartIds(dict):
    """Little-endian ids of a part of a text, worked out when first asked for.

    Lower-case Latin-1 letters need no normalising and are one word to the
    tokenizer, and so are the marks after them; both go to the model at once,
    as the characters that stand for their bytes.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        size = self.tokenizer.get_vocab_size()
        self.id_bytes = [i.to_bytes(4, "little") for i in range(size)]

    def __missing__(self, part: str) -> bytes:
        simple = WORD_AND_MARKS.fullmatch(part)
        if simple:
            word, marks = simple.groups()
            if word and marks:
                ids = self[word] + self[marks]
            else:
                shown = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_CHARACTERS)
                id_bytes = self.id_bytes
                ids = b"".join([id_bytes[t.id] for t in self.tokenize(shown)])
        else:
            ids = b"".join([self.id_bytes[i] for i in self.tokenizer.encode(part, add_special_tokens=False).ids])
        self[part] = ids
        return ids


class PartEncoder:
    """Ids of whole texts as little-endian bytes; parts between white space are encoded once.

    Parts are independent of each other for a tokenizer that splits at white
    space, so a text's ids are those of its parts in turn.
    """

    def __init__(self, path: str):
        self.known = PartIds(path)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        ids_of = self.known.__getitem__
        return [b"".join(map(ids_of, _parts(_lowered(text)))) if text else b"" for text in texts]


def _parts(text: str) -> list[str]:
    return list(filter(None, SPACE.split(text))) if SEPARATORS.search(text) else text.split()


def _lowered(text: str) -> str:
    """Lower case where every program has the same, else the text itself; the tokenizer lowers anyway."""
    if text.isascii():
        return text.lower()
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


def cut(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Piece number, start, length and CRC-32 of one document's pieces."""
    step = 4 * capacity
    return [
        (i, start // 4, len(part := ids[start:start + step]) // 4, zlib.crc32(part))
        for i, start in enumerate(range(0, len(ids), step))
    ]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of every document; needs doc_id and text."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PartEncoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(at, CHUNK)
                ids = rows.column(0).to_pylist()
                found = [
                    (doc, *piece)
                    for doc, encoded in zip(ids, encoder.encode(rows.column(1).to_pylist()))
                    for piece in cut(encoded + end, capacity)
                ]
                columns = zip(*found)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, longest first into the fullest bin it fits."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    # Bit r is set while some bin has r tokens left.
    left, n_bins = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = left >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            at = free[room].pop()
            if not free[room]:
                left &= ~(1 << room)
        else:
            room, at = capacity, n_bins
            n_bins += 1
        bins[i], offsets[i] = at, capacity - room
        free[room - size].append(at)
        left |= 1 << (room - size)
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The greatest of the dual-feasible bounds over all thresholds up to half the capacity, and all roundings."""
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1)[:capacity + 1]
    tokens = count * np.arange(capacity + 1)
    below, below_tokens = np.cumsum(count), np.cumsum(tokens)
    t = np.arange(0, capacity // 2 + 1)
    # Longer than capacity - t: full. From t on up to that: as long as they are.
    full = below[-1] - below[capacity - t]
    lower = np.where(t > 0, below_tokens[np.maximum(t - 1, 0)], 0)
    between = below_tokens[capacity - t] - lower
    by_tokens = (full + -(-between // capacity)).max()
    # Pieces over half need a sequence each; those of exactly half share one.
    over_half = below[-1] - below[capacity // 2]
    half = count[capacity // 2] if capacity % 2 == 0 else 0
    best = max(by_tokens, over_half + -(-half // 2))
    # Rounding: a piece of at least j of k + 1 equal shares of a sequence counts j / k, one of exactly j shares j / (k + 1).
    length = np.arange(capacity + 1)
    for k in range(1, ROUNDINGS + 1):
        shares, rest = np.divmod((k + 1) * length, capacity)
        weight = np.where(rest == 0, shares * k, shares * (k + 1))
        best = max(best, -(-(count * weight).sum() // (k * (k + 1))))
    return int(best)


PACKED = PIECES + ", part long, bin long, offset long, n_bins long, bound long, fill long"


def _pack_parts(pieces: DataFrame, capacity: int) -> DataFrame:
    """Every partition (column ``part``) packed, with its bin count, its bound and its bins' fill."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable", na_position="first").reset_index(drop=True)
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets = best_fit_decreasing(lengths, capacity)
        return pdf.assign(
            bin=bins, offset=offsets, n_bins=bins.max() + 1, bound=lower_bound(lengths, capacity),
            fill=np.bincount(bins, lengths).astype(np.int64)[bins],
        )[[c.split()[0] for c in PACKED.split(", ")]]

    return pieces.groupBy("part").applyInPandas(pack, PACKED)


def _dealt(pieces: DataFrame, n_parts: int, turn: int) -> DataFrame:
    """Pieces dealt into partitions by hash; equal rows spread as well."""
    salt = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id(), F.lit(turn))
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32").withColumn("part", F.pmod(salt, F.lit(n_parts)))


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_rows: int = PART_ROWS, rounds: int = ROUNDS) -> DataFrame:
    """Pieces with sequence_id and offset."""
    full = pieces.where(F.col("length") >= capacity)
    # A full piece is a sequence by itself.
    done = [full.withColumns({"turn": F.lit(0), "part": F.lit(0).cast("long"), "bin": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})]
    open_pieces = pieces.where(F.col("length") < capacity)
    before = None
    for turn in range(1, rounds + 1):
        n_open = open_pieces.count()
        if not n_open:
            break
        # Later turns deal into fewer partitions, so that a gap is shared by more documents.
        n_parts = max(1, -(-n_open // part_rows))
        packed = materialized(_pack_parts(_dealt(open_pieces, n_parts, turn), capacity)).withColumn("turn", F.lit(turn))
        if before is not None and _n_bins(packed) >= _n_bins(before):
            break
        certified = F.col("n_bins") <= F.col("bound")
        settled = certified | (F.col("fill") == capacity)
        done.append(packed.where(settled))
        before, open_pieces = packed.where(~settled), packed.where(~settled)
        if n_parts == 1:
            # One partition held all that was open: there is nobody left to exchange with.
            break
    if before is not None:
        done.append(before)
    names = [*[c.split()[0] for c in PIECES.split(", ")], "turn", "part", "bin", "offset"]
    result = done[0].select(*names)
    for part in done[1:]:
        result = result.unionByName(part.select(*names))
    # Numbers need only differ: turn, partition and bin side by side.
    number = F.col("turn") * F.lit(1 << 60) + F.when(F.col("turn") > 0, F.col("part") * F.lit(1 << 24)).otherwise(0) + F.col("bin")
    return result.select(*names[:5], number.alias("sequence_id"), "offset")


def _n_bins(packed: DataFrame) -> int:
    return packed.select("part", "bin").distinct().count()


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """All documents packed; pieces are tokenised once and written."""
    return pack(materialized(pieces_of(docs.select("doc_id", "text"), path or word_bpe_path(), capacity)), capacity)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
