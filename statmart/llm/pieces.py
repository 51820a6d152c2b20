"""SentencePiece encoding and decoding by batched merges (operator 8).

A text is escaped (blank to U+2581, one in front) and split before every run of
blanks: no piece holds a blank after another character, which is checked when
the model is read, so no merge crosses words. The model ranks its pieces by the
order in which they were merged, so a word's ids come from merging: of its
adjacent pairs whose joined text is a piece, the one of the best score is
joined (of equal ones the leftmost), until no pair is a piece. That is what the
library does; the greatest sum of such scores is another segmentation.

Distinct words advance together. A step joins one pair in each word, so all
words that are still open have the same number of symbols, and words of that
length join them; words without a pair are done. Pairs are probed by the exact
ids of their halves in a sorted table. Characters that occur in no longer piece
are words of their own, and very long words are merged one by one with a heap.
A character that is no piece is written as its bytes' pieces.

The plain Viterbi over the scores (``segment``), batched by word length, remains
for tables of unigram scores; the query does not use it.

Decoding looks pieces up in one byte pool and gathers a whole batch at once.

Defined results: null and empty texts have no ids and decode to an empty text;
U+2581 in a text is a blank to the model and decodes as one; a text that starts
with a blank keeps it; repeated rows are encoded each by itself; an empty table
gives no rows. Texts are encoded whole.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.llm.common import map_column, table

BLANK = "▁"
WORDS = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
UNKNOWN_PENALTY = 10.0
BASE = np.uint64(0x100000001B3)
CHUNK = 512
#: Words remembered per task; cleared when full.
REMEMBERED = 300_000
#: Characters of equally long words that advance together.
BATCH = 1 << 20
#: Longer words are merged one by one.
LONG = 64
#: Words that are merged together.
TOGETHER = 1 << 15
NEVER = np.int64(1 << 62)


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Model:
    """Piece hashes, ids and scores by length; ids of bytes; all pieces' bytes end to end; pairs that join to a piece.

    A symbol is a piece's id or, for a character that is none, -1 less its code point. A pair's key is made of its two
    symbols, its value of the rank of the piece's score and its id.
    """

    lengths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    bytes_at: np.ndarray
    unknown_score: float
    unknown_id: int
    pool: np.ndarray
    starts: np.ndarray
    whole_texts: bool
    singles: tuple[np.ndarray, np.ndarray]
    pair_keys: np.ndarray
    pair_values: np.ndarray
    inner: str


def _hashes(points: np.ndarray) -> np.ndarray:
    """Hashes of the prefixes of equally long rows of code points, from the empty one on."""
    found = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
    for i in range(points.shape[1]):
        found[:, i + 1] = found[:, i] * BASE + points[:, i] + np.uint64(1)
    return found


def _points(words: list[str]) -> np.ndarray:
    joined = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, np.uint32).reshape(len(words), -1).astype(np.uint64)


def _pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF


def _pairs(pieces: list[tuple[str, int, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys, in order, and values of all pairs of symbols whose joined text is a piece."""
    symbols = {p: i for p, i, _ in pieces}
    symbols |= {c: -1 - ord(c) for p, _, _ in pieces for c in p if c not in symbols}
    ranks = {score: rank for rank, score in enumerate(sorted({s for _, _, s in pieces}, reverse=True))}
    found = [
        (symbols[p[:at]], symbols[p[at:]], ranks[score] << 32 | i)
        for p, i, score in pieces for at in range(1, len(p)) if p[:at] in symbols and p[at:] in symbols
    ]
    left, right, values = np.array(found, np.int64).reshape(-1, 3).T
    keys = _pair_keys(left, right)
    order = np.argsort(keys)
    return keys[order], values[order]


def read_model(path: str) -> Model:
    """The model file's table; read with the library, encoded without it."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    by_length: dict[int, list[tuple[str, int, float]]] = {}
    if any(processor.is_unused(i) for i in range(processor.get_piece_size())):
        raise ValueError("pieces that are merged but not written are not known here")
    bytes_at = np.full(256, -1, np.int64)
    texts: list[bytes] = []
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            bytes_at[int(piece[1:-1], 16)] = i
            texts.append(bytes([int(piece[1:-1], 16)]))
        elif processor.is_control(i) or processor.is_unknown(i):
            texts.append(" ⁇ ".encode() if processor.is_unknown(i) else b"")
        else:
            texts.append(piece.encode())
            by_length.setdefault(len(piece), []).append((piece, i, processor.get_score(i)))
    lengths = {}
    for n, pieces in by_length.items():
        hashed = _hashes(_points([p for p, _, _ in pieces]))[:, -1]
        order = np.argsort(hashed)
        if len(np.unique(hashed)) < len(hashed):
            raise ValueError("two pieces share a hash")
        lengths[n] = hashed[order], np.array([i for _, i, _ in pieces])[order], np.array([s for _, _, s in pieces])[order]
    sizes = np.array([len(t) for t in texts])
    single = by_length.get(1, [])
    return Model(
        lengths, bytes_at, min(s.min() for _, _, s in lengths.values()) - UNKNOWN_PENALTY, processor.unk_id(),
        np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum(sizes)),
        any(BLANK in p.lstrip(BLANK) for pieces in by_length.values() for p, _, _ in pieces),
        (np.array([ord(p) for p, _, _ in single], np.int64), np.array([i for _, i, _ in single], np.int32)),
        *_pairs([one for pieces in by_length.values() for one in pieces]),
        "".join(sorted({c for n, pieces in by_length.items() if n > 1 for p, _, _ in pieces for c in p} - {BLANK})),
    )


def segment(words: list[str], model: Model) -> list[bytes]:
    """Ids (little-endian) of equally long words, all at once."""
    points = _points(words)
    n_words, size = points.shape
    prefixes = _hashes(points)
    powers = np.array([pow(int(BASE), i, 1 << 64) for i in range(max(model.lengths) + 1)], np.uint64)
    score = np.full((n_words, size + 1), -np.inf)
    score[:, 0] = 0
    # Backpointers: the length of the last piece, and its id (-1: a character that is no piece).
    back = np.zeros((n_words, size + 1), np.int32)
    piece = np.full((n_words, size + 1), -1, np.int64)
    # Longest first, so that it wins a tie.
    tried = sorted(model.lengths, reverse=True)
    for end in range(1, size + 1):
        single = np.zeros(n_words, bool)
        for length in tried:
            if length > end:
                continue
            keys, ids, scores = model.lengths[length]
            sought = prefixes[:, end] - prefixes[:, end - length] * powers[length]
            at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
            hit = keys[at] == sought
            if length == 1:
                single = hit
            total = np.where(hit, score[:, end - length] + scores[at], -np.inf)
            better = total > score[:, end]
            score[better, end] = total[better]
            back[better, end] = length
            piece[better, end] = ids[at[better]]
        total = np.where(single, -np.inf, score[:, end - 1] + model.unknown_score)
        better = total > score[:, end]
        score[better, end] = total[better]
        back[better, end] = 1
        piece[better, end] = -1
    # All words walk back together.
    where = np.full(n_words, size)
    rows = np.arange(n_words)
    steps: list[np.ndarray] = []
    places: list[np.ndarray] = []
    while (where > 0).any():
        steps.append(np.where(where > 0, piece[rows, where], -2))
        places.append(where)
        where = np.maximum(where - back[rows, where], 0)
    path = np.stack(steps[::-1], axis=1)
    ends = np.stack(places[::-1], axis=1)
    plain = (path != -1).all(axis=1)
    result = []
    for i in range(n_words):
        if plain[i]:
            result.append(path[i][path[i] >= 0].astype("<u4").tobytes())
        else:
            ids: list[int] = []
            for found, end in zip(path[i].tolist(), ends[i].tolist()):
                if found >= 0:
                    ids.append(found)
                elif found == -1:
                    codes = words[i][end - 1].encode("utf-8", "surrogatepass")
                    known = [int(model.bytes_at[b]) for b in codes]
                    ids += known if min(known) >= 0 else [model.unknown_id]
            result.append(np.array(ids, "<u4").tobytes())
    return result


class Merger:
    """Ids of words by merging pairs in the order of the model's scores."""

    def __init__(self, model: Model):
        self.model = model
        self.symbols = -1 - np.arange(0x110000, dtype=np.int32)
        self.symbols[model.singles[0]] = model.singles[1]
        self.pairs = None

    def values(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sought = _pair_keys(left, right)
        if not len(self.model.pair_keys):
            return np.full(sought.shape, NEVER)
        at = np.minimum(np.searchsorted(self.model.pair_keys, sought), len(self.model.pair_keys) - 1)
        return np.where(self.model.pair_keys[at] == sought, self.model.pair_values[at], NEVER)

    def written(self, symbols: list[int]) -> bytes:
        ids: list[int] = []
        for one in symbols:
            if one >= 0:
                ids.append(one)
            else:
                known = [int(self.model.bytes_at[b]) for b in chr(-1 - one).encode("utf-8", "surrogatepass")]
                ids += known if min(known) >= 0 else [self.model.unknown_id]
        return np.array(ids, "<u4").tobytes()

    def merge_long(self, word: str) -> bytes:
        """One word; pairs wait in a heap."""
        if self.pairs is None:
            self.pairs = dict(zip(self.model.pair_keys.tolist(), self.model.pair_values.tolist()))
        symbols: list[int | None] = self.symbols[_points([word])[0].astype(np.int64)].tolist()
        size = len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        waiting: list[tuple[int, int, int, int]] = []

        def consider(at: int, then: int) -> None:
            value = self.pairs.get(symbols[at] << 32 | symbols[then] & 0xFFFFFFFF)
            if value is not None:
                heapq.heappush(waiting, (value >> 32, at, symbols[at], symbols[then]))

        for i in range(size - 1):
            consider(i, i + 1)
        while waiting:
            _, at, left, right = heapq.heappop(waiting)
            then = after[at]
            # A pair whose halves were joined elsewhere is gone.
            if symbols[at] != left or then >= size or symbols[then] != right:
                continue
            symbols[at] = self.pairs[left << 32 | right & 0xFFFFFFFF] & 0xFFFFFFFF
            symbols[then] = None
            after[at] = after[then]
            if after[at] < size:
                before[after[at]] = at
                consider(at, after[at])
            if before[at] >= 0:
                consider(before[at], at)
        return self.written([one for one in symbols if one is not None])

    def merge(self, by_length: dict[int, list[str]]) -> dict[str, bytes]:
        """Words up to LONG characters, all at once, from the longest on."""
        found: dict[str, bytes] = {}
        size = max(by_length)
        words = np.empty(0, object)
        symbols, values = np.empty((0, size), np.int32), np.empty((0, size - 1), np.int64)
        while size:
            if size in by_length:
                own = self.symbols[_points(by_length[size]).astype(np.int64)]
                words = np.concatenate([words, np.array(by_length[size], object)])
                symbols = np.concatenate([symbols, own])
                values = np.concatenate([values, self.values(own[:, :-1], own[:, 1:])])
            if size > 1:
                # The leftmost pair of the best rank.
                at = (values >> 32).argmin(axis=1)
                rows = np.arange(len(words))
                made = values[rows, at]
                is_open = made != NEVER
            else:
                is_open = np.zeros(len(words), bool)
            done = symbols[~is_open]
            plain = (done >= 0).all(axis=1)
            flat = done.astype("<u4").tobytes()
            for i, (word, is_plain) in enumerate(zip(words[~is_open].tolist(), plain.tolist())):
                found[word] = flat[4 * size * i:4 * size * (i + 1)] if is_plain else self.written(done[i].tolist())
            size -= 1
            if not size:
                break
            words, at, made = words[is_open], at[is_open], made[is_open]
            symbols, values = symbols[is_open], values[is_open]
            rows = np.arange(len(words))
            column = np.arange(size)
            symbols = np.where(column <= at[:, None], symbols[:, :-1], symbols[:, 1:])
            symbols[rows, at] = made & 0xFFFFFFFF
            # The pair is gone; those to its left and right have a new half.
            values = np.where(column[:-1] < at[:, None], values[:, :-1], values[:, 1:])
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < size - 1)
            i, j = np.concatenate([left, right]), np.concatenate([at[left] - 1, at[right]])
            values[i, j] = self.values(symbols[i, j], symbols[i, j + 1])
        return found

    def __call__(self, words: set[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        short: list[str] = []
        for word in words:
            if len(word) > LONG:
                found[word] = self.merge_long(word)
            else:
                short.append(word)
        for i in range(0, len(short), TOGETHER):
            by_length: dict[int, list[str]] = {}
            for word in short[i:i + TOGETHER]:
                by_length.setdefault(len(word), []).append(word)
            found.update(self.merge(by_length))
        return found


def best_sums(model: Model) -> Callable[[set[str]], dict[str, bytes]]:
    """Ids of words by the greatest sum of scores."""
    def run(words: set[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        by_length: dict[int, list[str]] = {}
        for word in words:
            by_length.setdefault(len(word), []).append(word)
        for size, equal in by_length.items():
            step = max(1, BATCH // size)
            for i in range(0, len(equal), step):
                part = equal[i:i + step]
                found.update(zip(part, segment(part, model)))
        return found

    return run


class Encoder:
    """Ids of whole texts; each distinct word is segmented once while it is remembered."""

    def __init__(self, model: Model, method: Callable[[Model], Callable[[set[str]], dict[str, bytes]]] = best_sums):
        self.model = model
        self.ids_of = method(model)
        self.words = WORDS
        if method is Merger:
            inner = re.escape(model.inner)
            # A character that no longer piece holds is not merged with anything.
            self.words = re.compile(f"{BLANK}+[{inner}]*|[{inner}]+|." if inner else f"{BLANK}+|.", re.S)
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        escaped = [BLANK + t.replace(" ", BLANK) if t else "" for t in texts]
        split = [[t] if self.model.whole_texts and t else self.words.findall(t) for t in escaped]
        new = set().union(*split).difference(self.known)
        if new:
            self.known.update(self.ids_of(new))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


def decode(ids: list[bytes], model: Model) -> list[str]:
    """Texts of little-endian ids, the whole list gathered from the byte pool at once."""
    sizes = np.array([len(one) // 4 for one in ids])
    flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
    lengths = model.starts[flat + 1] - model.starts[flat]
    ends = np.append(0, np.cumsum(lengths))
    gathered = model.pool[np.arange(ends[-1]) + np.repeat(model.starts[flat] - ends[:-1], lengths)].tobytes()
    bounds = ends[np.append(0, np.cumsum(sizes))].tolist()
    texts = [gathered[a:b].decode("utf-8", "replace").replace(BLANK, " ") for a, b in zip(bounds, bounds[1:])]
    return [t[1:] if t.startswith(" ") else t for t in texts]


def encode_texts(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows packed as ``row`` with their ``ids``."""
    sent = df.sparkSession.sparkContext.broadcast(vars(model))

    def make():
        encoder = Encoder(Model(**sent.value), Merger)
        return lambda texts: [[np.frombuffer(ids, "<u4").astype(np.int32) for ids in encoder.encode(texts)]]

    return map_column(df, text, T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))]), make, CHUNK)


def decode_ids(df: DataFrame, model: Model, ids: str = "ids") -> DataFrame:
    """Rows packed as ``row`` with their ``decoded`` text."""
    sent = df.sparkSession.sparkContext.broadcast(vars(model))

    def make():
        return lambda lists: [decode([np.array(one or [], "<u4").tobytes() for one in lists], Model(**sent.value))]

    return map_column(df, ids, T.StructType([T.StructField("decoded", T.StringType())]), make, CHUNK)


DIGEST = T.StructType([
    T.StructField("n_ids", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("n_decoded", T.LongType()),
    T.StructField("decoded_crc32", T.LongType()), T.StructField("round_trip", T.BooleanType()),
])


def digests(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows packed as ``row`` with the digest of their ids and of the text decoded from them."""
    sent = df.sparkSession.sparkContext.broadcast(vars(model))

    def make():
        encoder = Encoder(Model(**sent.value), Merger)

        def run(texts: list[str | None]):
            ids = encoder.encode(texts)
            decoded = decode(ids, encoder.model)
            return (
                [len(one) // 4 for one in ids], list(map(zlib.crc32, ids)), list(map(len, decoded)),
                [zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in decoded],
                [t == (original or "").replace(BLANK, " ") for t, original in zip(decoded, texts)],
            )

        return run

    return map_column(df, text, DIGEST, make, CHUNK)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, read_model(piece_path())).select("row.doc_id", *DIGEST.names)
