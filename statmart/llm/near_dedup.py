"""Near-duplicate classes by consistent weighted sampling (operator 1).

A text is the weighted set of its shingles of five lower-case words (a shorter
text is one shingle). The weight of a shingle is its count in the text times a
damped inverse document frequency between 1 and 1 + ``IDF_SHARE``. Damped,
because what a group of copies shares is frequent and what sets one apart is
rare: full weights would push true copies below the threshold, while with these
a similarity of 0.82 of plain counts is always one of 0.8 or more. Document
frequencies are estimated over all documents by a sketch of fixed size: counts
per hash bucket, less the mean of the other buckets.

1. Every text gets ``SAMPLES`` improved consistent weighted samples: two texts
   agree in one with the probability of their weighted Jaccard similarity.
   Texts with equal words are one node from here on, whatever their ids.
2. Bands of ``BAND_ROWS`` samples hash nodes into buckets. At a similarity of
   0.8 two nodes share a bucket with probability 0.999, at 0.5 with 0.3.
3. Each bucket links its members to its least node, where the weighted Jaccard
   similarity of the two whole texts is at least ``THRESHOLD``. This settles
   groups of copies with one comparison per member.
4. In buckets whose members are then still in different components, members of
   different components are compared by their samples, in blocks of bounded
   size; pairs that agree in fewer than ``LEAST_AGREED`` samples are dismissed
   (a similarity of 0.8 does so once in 2,000 pairs). The others are verified by
   their texts, the likeliest first, and only while they are still apart.
5. Classes are the connected components of the verified links.

No cap on buckets or partners, and no pair is written that is not to be verified.

Defined results: every row is compared by its own text, whether its doc_id is
null, or repeated with the same or another text. A class is named by its least
doc_id; a class without any has the name null. Texts without words (null,
empty, blank) are a class each, named by their own id. Of each class one row is
kept: of the least id (rows without one last), then of the least text by hash,
then of the least other columns by hash, so a rerun keeps the same. An empty table gives no
rows; columns of other names are carried along, whatever they are called.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.llm.common import CHUNK, table
from statmart.llm.components import components
from statmart.operators.dedupe import top_per_key
from statmart.session import materialized

SHINGLE = 5
THRESHOLD = 0.8
SAMPLES = 64
BAND_ROWS = 6
BANDS = 24
LEAST_AGREED = 40
BLOCK_ROWS = 512
SKETCH_BITS = 18
IDF_SHARE = 0.125
#: Shingles worked on at a time.
BLOCK = 4096

MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def shingles(words: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, ascending, and their counts."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))
    n = max(1, len(codes) - size + 1)
    hashed = np.full(n, len(codes) if len(codes) < size else size, np.uint64)
    for i in range(min(size, len(codes))):
        hashed = (hashed ^ codes[i:i + n]) * MIX
        hashed ^= hashed >> np.uint64(29)
    return np.unique(_mixed(hashed), return_counts=True)


def sketch_frequencies(texts: DataFrame, bits: int = SKETCH_BITS) -> tuple[np.ndarray, int]:
    """Texts per hash bucket that have a shingle in it, and the number of texts with words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                hashed = [shingles(words_of(t))[0] for t in batch.column(0).slice(start, CHUNK).to_pylist()]
                n += sum(len(h) > 0 for h in hashed)
                at = (np.concatenate(hashed) >> np.uint64(64 - bits)).astype(np.int64)
                total += np.bincount(at, minlength=1 << bits)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(total[at], n), pa.int64())], names=["bucket", "n"]
        )

    sums = texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    frequencies = np.zeros(1 << bits)
    known = sums[sums["bucket"] >= 0]
    frequencies[known["bucket"]] = known["n"]
    return frequencies, int(sums.loc[sums["bucket"] < 0, "n"].sum())


def bucket_weights(frequencies: np.ndarray, n_texts: int, share: float = IDF_SHARE) -> np.ndarray:
    """The damped inverse document frequency of each hash bucket."""
    others = (frequencies.sum() - frequencies) / max(1, len(frequencies) - 1)
    estimated = np.clip(frequencies - others, 1, max(1, n_texts))
    scale = np.log(max(2, n_texts))
    return (1 + share * np.log(max(1, n_texts) / estimated) / scale).astype(np.float32)


def weighted(words: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashed, counts = shingles(words)
    bits = len(weights).bit_length() - 1
    return hashed, counts * weights[(hashed >> np.uint64(64 - bits)).astype(np.int64)].astype(float)


def weighted_jaccard(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima over sum of maxima of two weighted sets with ascending hashes."""
    _, i, j = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    shared = np.minimum(one[1][i], other[1][j]).sum()
    total = one[1].sum() + other[1].sum() - shared
    return float(shared / total) if total else 0.0


def sampling_tables(seed: int = 11, size: int = 1 << 16) -> tuple[np.ndarray, ...]:
    """Draws of r, ln c and beta, looked up by 16 bits of a hash each; and a factor per sample."""
    chance = np.random.default_rng(seed)
    r = chance.gamma(2.0, 1.0, size).astype(np.float32)
    log_c = np.log(chance.gamma(2.0, 1.0, size)).astype(np.float32)
    beta = chance.random(size).astype(np.float32)
    factors = chance.integers(1, 1 << 63, SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return r, log_c, beta, factors


def samples(hashed: np.ndarray, weight: np.ndarray, tables: tuple[np.ndarray, ...]) -> np.ndarray:
    """The 32-bit codes of the consistent weighted samples (shingle and quantised weight)."""
    r_of, log_c_of, beta_of, factors = tables
    best = np.full(len(factors), np.inf, np.float32)
    codes = np.zeros(len(factors), np.uint64)
    low = np.uint64(0xFFFF)
    columns = np.arange(len(factors))
    for start in range(0, len(hashed), BLOCK):
        h = hashed[start:start + BLOCK]
        mixed = h[:, None] * factors
        mixed ^= mixed >> np.uint64(32)
        r = r_of[mixed & low]
        beta = beta_of[mixed >> np.uint64(16) & low]
        log_c = log_c_of[mixed >> np.uint64(48)]
        level = np.floor(np.log(weight[start:start + BLOCK]).astype(np.float32)[:, None] / r + beta)
        cost = log_c - r * (level - beta + 1)
        least = cost.argmin(axis=0)
        value = cost[least, columns]
        better = value < best
        best[better] = value[better]
        chosen = _mixed(h[least] + level[least, columns].astype(np.int64).astype(np.uint64) * MIX)
        codes[better] = chosen[better]
    return codes.astype(np.uint32)


def band_positions(seed: int = 5) -> np.ndarray:
    """Which samples make up each band; a sample serves several bands."""
    chance = np.random.default_rng(seed)
    return np.stack([chance.permutation(SAMPLES)[:BAND_ROWS] for _ in range(BANDS)])


def band_keys(codes: np.ndarray) -> np.ndarray:
    """One bucket number per row and band."""
    keys = np.zeros((len(codes), BANDS), np.uint64)
    for band, positions in enumerate(band_positions()):
        key = np.full(len(codes), band + 1, np.uint64)
        for at in positions:
            key = _mixed((key ^ codes[:, at].astype(np.uint64)) * MIX)
        keys[:, band] = key
    return keys.view(np.int64)


def _key(words: list[str]) -> bytes:
    return hashlib.md5("\n".join(words).encode("utf-8", "surrogatepass")).digest()


#: What tells a document from all others: its id and its text, by two hashes of 64 bits each.
DOC = ("doc_id", "print_1", "print_2")


def printed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the two hashes of the text."""
    prints = [F.xxhash64(F.lit(seed), "text").alias(f"print_{seed}") for seed in (1, 2)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *prints, "text")


def same_doc(one: str, other: str) -> Column:
    """Whether two rows hold the same document; null ids are equal."""
    tests = [F.col(f"{one}.{c}").eqNullSafe(F.col(f"{other}.{c}")) for c in DOC]
    return tests[0] & tests[1] & tests[2]


def signed(docs: DataFrame, weights) -> DataFrame:
    """The columns of ``DOC``, the key of the text's words (null without words) and its codes; ``weights`` is broadcast."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sampling_tables()
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(start, CHUNK)
                keys, codes = [], []
                for text in rows.column(3).to_pylist():
                    words = words_of(text)
                    if words:
                        keys.append(_key(words))
                        codes.append(samples(*weighted(words, weights.value), tables).astype("<u4").tobytes())
                    else:
                        keys.append(None)
                        codes.append(None)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:3], pa.array(keys, pa.binary()), pa.array(codes, pa.binary())], names=[*DOC, "key", "codes"]
                )

    return docs.mapInArrow(run, "doc_id long, print_1 long, print_2 long, key binary, codes binary")


def in_buckets(nodes: DataFrame) -> DataFrame:
    """bucket and node, a row per band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(-1, SAMPLES)
                ids = batch.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(band_keys(codes).ravel()), pa.array(np.repeat(ids, BANDS))], names=["bucket", "node"]
                )

    return nodes.select("node", "codes").mapInArrow(run, "bucket long, node long")


def verified(pairs: DataFrame, texts: DataFrame, weights, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (a, b) whose texts reach the threshold; each pair meets its two texts by joins."""
    joined = (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, tuple[np.ndarray, np.ndarray]] = OrderedDict()

        def vector(node: int, text: str) -> tuple[np.ndarray, np.ndarray]:
            if node not in kept:
                if len(kept) >= 64:
                    kept.popitem(last=False)
                kept[node] = weighted(words_of(text), weights.value)
            return kept[node]

        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(start, CHUNK)
                a, b, text_a, text_b = (c.to_pylist() for c in rows.columns)
                near = [weighted_jaccard(vector(x, t), vector(y, u)) >= threshold for x, y, t, u in zip(a, b, text_a, text_b)]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1)], names=["a", "b"]).filter(pa.array(near, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def _block_links(members: DataFrame, weights) -> DataFrame:
    """Links between members of one bucket that are still in different classes.

    Members have bucket, node, class_id, codes and text. Blocks are dealt by
    hash; each pair of blocks is one group of at most about two blocks of rows.
    A pair is looked at in the first band it shares only. Pairs whose samples
    agree often enough are verified by their texts, the likeliest first, unless
    a link found before has joined their classes. So a group writes fewer links
    than it has rows.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    n_blocks = F.ceil(F.col("n") / BLOCK_ROWS).cast("long")
    dealt = (
        members.join(sizes, "bucket")
        .withColumn("blocks", n_blocks)
        .withColumn("own", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "class_id", "codes", "text")
    )

    def compare(group: pa.Table) -> pa.Table:
        bucket, low, high = (group.column(c)[0].as_py() for c in ("bucket", "low", "high"))
        nodes, classes, own = (group.column(c).to_numpy() for c in ("node", "class_id", "own"))
        codes = np.frombuffer(b"".join(group.column("codes").to_pylist()), "<u4").reshape(-1, SAMPLES)
        texts = group.column("text")
        keys = band_keys(codes)
        vectors: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        parent: dict[int, int] = {}

        def vector(i: int) -> tuple[np.ndarray, np.ndarray]:
            if i not in vectors:
                vectors[i] = weighted(words_of(texts[i].as_py()), weights.value)
            return vectors[i]

        def root(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        left = np.flatnonzero(own == low)
        right = np.flatnonzero(own == high)
        pairs = []
        for i in left:
            others = right[right > i] if low == high else right
            others = others[classes[others] != classes[i]]
            agreed = (codes[others] == codes[i]).sum(axis=1)
            others, agreed = others[agreed >= LEAST_AGREED], agreed[agreed >= LEAST_AGREED]
            mine = keys[i][(keys[others] == keys[i]).argmax(axis=1)] == bucket
            pairs.append(np.stack([agreed[mine], np.full(mine.sum(), i), others[mine]]))
        likely = np.concatenate(pairs, axis=1)
        links = []
        for _, i, j in likely[:, np.argsort(-likely[0], kind="stable")].T.tolist():
            one, other = root(int(classes[i])), root(int(classes[j]))
            if one != other and weighted_jaccard(vector(i), vector(j)) >= THRESHOLD:
                parent[one] = other
                links.append((int(nodes[i]), int(nodes[j])))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("bucket", "low", "high").applyInArrow(compare, "a long, b long")


def node_classes(nodes: DataFrame, texts: Callable[[DataFrame], DataFrame], weights) -> DataFrame:
    """``node`` and ``class_id`` of the nodes that are linked to another one; ``texts`` gives node and text of some nodes."""
    buckets = in_buckets(nodes)
    shared = buckets.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialized(buckets.join(shared, "bucket").where("node <> pivot").select("bucket", "node", "pivot", "n"))
    stars = members.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    involved = stars.select(F.col("a").alias("node")).unionByName(stars.select(F.col("b").alias("node"))).distinct()
    # Only texts that share a bucket with another one are needed again; rows that repeat a document give one.
    needed = materialized(texts(involved).groupBy("node").agg(F.min("text").alias("text")))
    classes = components(verified(stars, needed, weights))

    # The least node of a bucket has met all others; two others are left to compare from three members on.
    open_members = (
        members.where("n > 2").select("bucket", "node").join(classes, "node", "left")
        .withColumn("class_id", F.coalesce("class_id", "node"))
    )
    mixed = open_members.groupBy("bucket").agg(F.min("class_id").alias("x"), F.max("class_id").alias("y")).where("x < y").select("bucket")
    apart = open_members.join(mixed, "bucket").join(nodes.select("node", "codes"), "node").join(needed, "node")
    found = _block_links(apart, weights)
    # Classes that a late link joins, as links between classes.
    late = found
    for side in ("a", "b"):
        renamed = classes.select(F.col("node").alias(side), F.col("class_id").alias("found"))
        late = late.join(renamed, side, "left").withColumn(side, F.coalesce("found", side)).drop("found")
    return joined_classes(classes, components(late))


def joined_classes(classes: DataFrame, merged: DataFrame) -> DataFrame:
    """Classes of nodes after some classes (and single nodes) have merged."""
    merged = merged.select(F.col("node").alias("class_id"), F.col("class_id").alias("joined"))
    both = classes.join(merged, "class_id", "full_outer").select(
        F.coalesce("node", "class_id").alias("node"), F.coalesce("joined", "class_id").alias("class_id")
    )
    return materialized(both)


def _first(doc: str = "") -> Column:
    """The least document of a group: rows without an id come last."""
    at = [F.col(f"{doc}{c}") for c in DOC]
    return F.min(F.struct(at[0].isNull().alias("nameless"), *at))


def _classed(docs: DataFrame) -> DataFrame:
    """Every row of (doc_id, text) as ``DOC``, with the number of its class (null without words), the class's least
    document ``first`` and its least id."""
    spark = docs.sparkSession
    slim = printed(docs)
    weights = spark.sparkContext.broadcast(bucket_weights(*sketch_frequencies(slim.select("text"))))
    keyed = materialized(signed(slim, weights))
    # Texts with equal words are one node.
    nodes = materialized(
        keyed.where("key is not null").groupBy("key").agg(_first().alias("first"), F.min("codes").alias("codes"), F.count(F.lit(1)).alias("n"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    # The text of a node is that of its least document.
    def texts(wanted: DataFrame) -> DataFrame:
        place = nodes.join(wanted, "node").select("node", "first.*").alias("place")
        return slim.alias("own").join(place, same_doc("own", "place")).select("place.node", "own.text")

    classes = node_classes(nodes.select("node", "codes"), texts, weights)
    own = nodes.join(classes, "node", "left").select("key", "n", "first", F.coalesce("class_id", "node").alias("class"))
    named = materialized(own.groupBy("class").agg(F.min("first").alias("least")))
    of_key = materialized(own.join(named, "class").select("key", "n", "class", F.col("least").alias("first")))
    # A text that fills a thousandth of the rows or more is joined by broadcast: there are a thousand of them at most.
    often = F.col("n") > max(1000, keyed.count() // 1000)
    frequent, other = F.broadcast(of_key.where(often)), of_key.where(~often)
    worded = keyed.where("key is not null").drop("codes")
    found = worded.join(frequent, "key").unionByName(worded.join(frequent.select("key"), "key", "left_anti").join(other, "key"))
    alone = keyed.where("key is null").select(*DOC, F.lit(None).cast("long").alias("class"), F.struct(F.col("doc_id").isNull().alias("nameless"), *DOC).alias("first"))
    return found.select(*DOC, "class", "first").unionByName(alone)


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id of every row, and whether its document stands for the class; needs doc_id and text."""
    rows = _classed(docs.select("doc_id", "text"))
    is_first = F.struct(F.col("doc_id").isNull().alias("nameless"), *DOC).eqNullSafe(F.col("first"))
    return rows.select("doc_id", F.col("first.doc_id").alias("class_id"), is_first.alias("is_kept"))


def keep_first_of_class(docs: DataFrame) -> DataFrame:
    """One row of each class, with its columns."""
    rows = materialized(_classed(docs.select("doc_id", "text")))
    firsts = rows.where("class is not null").select("first.*").distinct().drop("nameless")
    alone = rows.where("class is null").select(*DOC).distinct()
    wanted = firsts.withColumn("single", F.lit(True)).unionByName(alone.withColumn("single", F.lit(False))).alias("wanted")
    # All columns are packed, so their names cannot clash with those added.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    prints = [F.xxhash64(F.lit(seed), "row.text").alias(f"print_{seed}") for seed in (1, 2)]
    own = whole.select("row", F.col("row.doc_id").cast("long").alias("doc_id"), *prints).alias("own")
    met = own.join(wanted, same_doc("own", "wanted")).select("own.*", "wanted.single")
    # Rows that repeat a document: one of them, by the hash of all columns.
    ranked = top_per_key(met.where("single"), DOC, [F.xxhash64("row")])
    return ranked.select("row.*").unionByName(met.where(~F.col("single")).select("row.*"))


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and whether it stands for it."""
    return near_classes(table(spark, sf_dir, "documents"))
