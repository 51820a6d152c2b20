"""Near-duplicate vectors by cross-polytope hashing (operator 13).

Two vectors are linked if their cosine is at least ``THRESHOLD``. Classes are
the connected components of the links; a vector's links are counted one by one.

1. Equal vectors are one node with a weight.
2. A hash function turns a vector by three rounds of random signs and a fast
   Hadamard transform; its value is the nearest vertex of the cross-polytope,
   that is the axis with the greatest component, and its sign. A table takes several functions
   together, and probes several buckets per vector: for every function the two
   nearest vertices, of their combinations the nearest. Functions per table
   grow with the logarithm of the number of vectors, so buckets of unrelated vectors stay small; tables are
   as many as it takes for two vectors at exactly the threshold to miss each
   other in all of them with a chance of ``MISS`` (measured on random pairs).
3. Every bucket compares its members with its least node. Where members are
   then in different components, those outside the bucket's largest component
   are compared with all others, in blocks.
4. Links are counted inside components. Vectors within half the threshold's
   angle of their component's centre are linked with each other for certain
   (triangle inequality), however many they are: they are counted by their
   weight. Only the others (the rim) are compared with the members, in blocks.

Candidates become links by the cosine of the whole vectors in double precision
only. No pair of a group is written: a bucket or component sends its vectors to
blocks of bounded size, and blocks return links of classes, or sums. Joins on a
key that may hold most rows split the (at most 1,000 or so) frequent keys off
and broadcast their few rows.

Defined results: vectors that are null, empty, all zero or hold a null or
non-finite component link with nothing, and so do rows without vec_id, whose
component is null; both are kept. Every row is a vector: rows that repeat a
vec_id or a vector are linked like others, and rows of one id are kept or
dropped together if they are in the same component. Vectors of different lengths are not
compared. An empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.llm.common import table
from statmart.llm.components import components
from statmart.session import materialized

THRESHOLD = 0.95
MISS = 0.001
MOST_PROBES = 8
MOST_FUNCTIONS = 8
LEAST_SIZE = 32
#: Rows of a block: those that are compared, and those they are compared with.
FEW, MANY = 512, 2048
#: Buckets and components up to this size share a task's group with others.
SMALL = 256
GROUP_ROWS = 2048
#: Pairs of vectors compared at a time.
PAIRS = 1 << 15
#: Keys with more than one in so many rows are joined by broadcast, so they are at most as many.
HOT_SHARE = 1000
#: Angles are rounded: this much less counts as certain.
SLACK = 1e-7


# -- hashing -------------------------------------------------------------------


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, of a power of two in length; lengths of vectors stay."""
    n, size = x.shape
    step = 1
    while step < size:
        halves = x.reshape(n, -1, 2, step)
        x = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], axis=2).reshape(n, size)
        step *= 2
    return x / np.sqrt(size)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


class HashTables:
    """The hash tables for vectors of one length, so many of them: functions and probes per table, and how many tables."""

    def __init__(self, dim: int, n_rows: int, threshold: float = THRESHOLD, miss: float = MISS):
        # In few dimensions, signs alone would not make enough different rotations.
        self.dim, self.size = dim, max(LEAST_SIZE, 1 << (dim - 1).bit_length())
        self.functions = 1
        # Two unrelated vectors meet in a table by chance for one vector in two.
        while self.functions < MOST_FUNCTIONS and 2 * n_rows * self.probes ** 2 > (2 * self.size) ** self.functions:
            self.functions += 1
        self.choices = np.array(list(product((0, 1), repeat=self.functions)))
        chance = np.random.default_rng(dim)
        one, other = chance.normal(size=(2, 500, dim))
        one /= np.linalg.norm(one, axis=1, keepdims=True)
        other -= (other * one).sum(axis=1, keepdims=True) * one
        other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-300)
        near = threshold * one + np.sqrt(1 - threshold ** 2) * other
        met = np.mean([(self.keys(one, t)[:, :, None] == self.keys(near, t)[:, None, :]).any(axis=(1, 2)).mean() for t in range(4)])
        # Rather too many tables than too few.
        met = min(max(met - 0.02, 0.01), 0.99)
        self.n_tables = int(np.ceil(np.log(miss) / np.log(1 - met)))

    @property
    def probes(self) -> int:
        return min(2 ** self.functions, MOST_PROBES)

    def keys(self, units: np.ndarray, table_nr: int) -> np.ndarray:
        """The keys of the buckets of one table that each vector probes, nearest first."""
        n, dim = units.shape
        padded = np.zeros((n, self.size))
        padded[:, :dim] = units
        vertices, gaps = [], []
        for function in range(self.functions):
            turned = padded
            for signs in np.random.default_rng([self.size, table_nr, function]).choice([-1.0, 1.0], (3, self.size)):
                turned = hadamard(turned * signs)
            near = np.argpartition(-np.abs(turned), 1, axis=1)[:, :2]
            parts = np.take_along_axis(turned, near, axis=1)
            order = np.argsort(-np.abs(parts), axis=1, kind="stable")
            near, parts = np.take_along_axis(near, order, axis=1), np.take_along_axis(parts, order, axis=1)
            vertices.append(2 * near + (parts < 0))
            gaps.append((np.abs(parts[:, 0]) - np.abs(parts[:, 1])) ** 2)
        far = np.stack(gaps, axis=1) @ self.choices.T
        chosen = self.choices[np.argsort(far, axis=1, kind="stable")[:, :self.probes]]
        keys = np.full(chosen.shape[:2], np.uint64(dim) << np.uint64(32) | np.uint64(table_nr), np.uint64)
        for function in range(self.functions):
            keys = _mixed(keys) ^ np.take_along_axis(vertices[function], chosen[:, :, function], axis=1).astype(np.uint64)
        return _mixed(keys)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def buckets_of(nodes: DataFrame, n_nodes: int, threshold: float, miss: float) -> DataFrame:
    """key and node: all buckets each node probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, HashTables] = {}
        for batch in batches:
            dims, ids = batch.column(2).to_numpy(), batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                if dim not in tables:
                    tables[dim] = HashTables(dim, n_nodes, threshold, miss)
                for start in range(0, len(at), 2048):
                    part = at[start:start + 2048]
                    units = _matrix(batch.column(1).take(pa.array(part)))
                    for table_nr in range(tables[dim].n_tables):
                        keys = tables[dim].keys(units, table_nr)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(ids[part], keys.shape[1]))], names=["key", "node"]
                        )

    # Two keys of one vector may be equal by chance only; the pair then counts once more, which changes nothing.
    return nodes.select("node", "unit", "dim").mapInArrow(run, "key long, node long")


# -- joins and blocks ----------------------------------------------------------


def joined_by(many: DataFrame, one: DataFrame, key: str, n_many: Column, limit: int) -> DataFrame:
    """Inner join with a table of one row per key; keys of more than ``limit`` rows of ``many`` are broadcast.

    ``n_many`` is a column of ``one`` with the number of rows of its key. With
    ``limit`` at a thousandth of the rows, at most a thousand keys pass it.
    """
    hot = F.broadcast(one.where(n_many > limit))
    return many.join(hot, key).unionByName(
        many.join(hot.select(key), key, "left_anti").join(one.where(n_many <= limit), key)
    )


def hot_limit(n_rows: int) -> int:
    return max(100, n_rows // HOT_SHARE)


def in_blocks(rows: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Rows with ``n_few`` and ``n_many`` of their key, sent to where the two sides meet.

    Rows with ``few`` are one side, all rows the other. Both are dealt into
    blocks by node; a block of one side meets every block of the other, so a
    row is sent as often as the other side has blocks. Keys of few rows share groups.
    """
    blocks_few = F.ceil(F.col("n_few") / FEW).cast("long")
    blocks_many = F.ceil(F.col("n_many") / MANY).cast("long")
    own = F.xxhash64("node")
    is_small = F.col("n_many") <= SMALL
    n_groups = max(1, -(-n_rows // GROUP_ROWS))
    zero = F.lit(0).cast("long")
    sides = rows.select(
        "*", is_small.alias("small"), F.when(is_small, F.pmod(F.xxhash64(key), F.lit(n_groups))).otherwise(F.col(key)).alias("meet"),
        F.explode(F.when(F.col("few"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))).alias("as_few"),
    )
    i = F.when(F.col("as_few"), F.array(F.pmod(own, blocks_few))).otherwise(F.sequence(zero, blocks_few - 1))
    j = F.when(F.col("as_few"), F.sequence(zero, blocks_many - 1)).otherwise(F.array(F.pmod(own, blocks_many)))
    return sides.withColumn("i", F.explode(i)).withColumn("j", F.explode(j)).drop("n_few", "n_many", "few")


def near_pairs(group: pa.Table, key: str, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the few and rows of the many that are near enough, of the same key, as they are found."""
    keys, few = group.column(key).to_numpy(), group.column("as_few").to_numpy()
    units = _matrix(group.column("unit"))
    x, y = np.flatnonzero(few), np.flatnonzero(~few)
    if not group.column("small")[0].as_py():
        # One key, in blocks.
        at, to = np.nonzero(units[x] @ units[y].T >= threshold)
        yield x[at], y[to]
        return
    y = y[np.argsort(keys[y], kind="stable")]
    starts, ends = (np.searchsorted(keys[y], keys[x], side) for side in ("left", "right"))
    n_pairs = np.cumsum(ends - starts)
    begin = 0
    while begin < len(x):
        done = n_pairs[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(n_pairs, done + PAIRS, "right")))
        counts = (ends - starts)[begin:end]
        at = np.repeat(x[begin:end], counts)
        first = np.repeat(starts[begin:end] - (np.cumsum(counts) - counts), counts)
        to = y[np.arange(len(at)) + first]
        near = np.einsum("ij,ij->i", units[at], units[to]) >= threshold
        yield at[near], to[near]
        begin = end


MEET = ("dim", "small", "meet", "i", "j")


# -- classes -------------------------------------------------------------------


def verified(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose vectors are near enough; pairs of one ``a`` may be most of all."""
    vectors = nodes.select("node", "unit")
    per_a = pairs.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n_pairs"))
    ends = vectors.join(per_a, "node").select(F.col("node").alias("a"), F.col("unit").alias("unit_a"), "n_pairs")
    both = joined_by(pairs, ends, "a", F.col("n_pairs"), hot_limit(pairs.count())).join(
        vectors.select(F.col("node").alias("b"), F.col("unit").alias("unit_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = [batch.column(i).value_lengths().to_numpy() for i in (2, 3)]
            for dim in np.unique(lengths[0]):
                rows = batch.take(pa.array(np.flatnonzero((lengths[0] == dim) & (lengths[1] == dim))))
                cosines = np.einsum("ij,ij->i", _matrix(rows.column(2)), _matrix(rows.column(3))) if rows.num_rows else np.zeros(0)
                yield rows.select(["a", "b"]).filter(pa.array(cosines >= threshold))

    return both.select("a", "b", "unit_a", "unit_b").mapInArrow(run, "a long, b long")


def _class_links(members: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between classes that meet in a bucket; members have key, node and class_id."""
    sizes = members.groupBy("key", "class_id").agg(F.count(F.lit(1)).alias("n"))
    mixed = materialized(
        sizes.groupBy("key").agg(F.max_by("class_id", F.struct("n", "class_id")).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n_many"))
        .where("n_main < n_many").withColumn("n_few", F.col("n_many") - F.col("n_main")).drop("n_main")
    )
    limit = hot_limit(members.count())
    apart = materialized(
        joined_by(members, mixed, "key", F.col("n_many"), limit)
        .select("key", "node", "class_id", "n_few", "n_many", (F.col("class_id") != F.col("main")).alias("few"))
    )

    def compare(group: pa.Table) -> pa.Table:
        classes = group.column("class_id").to_numpy()
        found = [np.zeros((0, 2), np.int64)]
        for x, y in near_pairs(group, "key", threshold):
            pairs = np.stack([classes[x], classes[y]], axis=1)
            found.append(np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0))
        links = np.unique(np.concatenate(found), axis=0)
        return pa.table({"a": pa.array(links[:, 0], pa.int64()), "b": pa.array(links[:, 1], pa.int64())})

    placed = in_blocks(apart.join(nodes.select("node", "unit", "dim"), "node"), "key", apart.count())
    return placed.groupBy(*MEET).applyInArrow(compare, "a long, b long")


def classes_of(nodes: DataFrame, n_nodes: int, threshold: float, miss: float) -> DataFrame:
    """node and class_id of the nodes that are linked with another one."""
    buckets = buckets_of(nodes, n_nodes, threshold, miss)
    shared = materialized(
        buckets.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    members = materialized(joined_by(buckets, shared, "key", F.col("n"), hot_limit(n_nodes)).where("node <> pivot"))
    stars = materialized(members.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct())
    classes = materialized(components(verified(stars, nodes, threshold)))
    # The least node of a bucket has met all others; two others are left to compare from three members on.
    left = materialized(
        members.where("n > 2").select("key", "node").distinct().join(classes, "node", "left")
        .withColumn("class_id", F.coalesce("class_id", "node"))
    )
    merged = components(_class_links(left, nodes, threshold))
    merged = merged.select(F.col("node").alias("class_id"), F.col("class_id").alias("joined"))
    return classes.join(merged, "class_id", "full_outer").select(
        F.coalesce("node", "class_id").alias("node"), F.coalesce("joined", "class_id").alias("class_id")
    )


# -- counting links ------------------------------------------------------------


def link_counts(classes: DataFrame, nodes: DataFrame, n_nodes: int, threshold: float) -> DataFrame:
    """node and ``n_links`` with other rows, for the nodes in classes; nodes have weights ``n``."""
    inside = materialized(classes.join(nodes.select("node", "unit", "dim", "n"), "node"))
    limit = hot_limit(n_nodes)
    sums = inside.select("class_id", F.posexplode("unit").alias("place", "x")).groupBy("class_id", "place").agg(F.sum("x").alias("x"))
    centres = sums.groupBy("class_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda s: s["x"]).alias("centre")
    ).join(inside.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_many")), "class_id")
    half = np.arccos(threshold) / 2 - SLACK

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = batch.take(pa.array(np.flatnonzero(dims == dim)))
                centre = _matrix(rows.column("centre"))
                lengths = np.maximum(np.linalg.norm(centre, axis=1), 1e-300)
                cosines = np.einsum("ij,ij->i", _matrix(rows.column("unit")), centre) / lengths
                rim = np.arccos(np.clip(cosines, -1, 1)) > half
                kept = rows.select(["node", "class_id", "n", "n_many"])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(rim)], names=[*kept.schema.names, "few"])

    marked = materialized(
        joined_by(inside, materialized(centres), "class_id", F.col("n_many"), limit)
        .select("node", "class_id", "unit", "dim", "n", "centre", "n_many")
        .mapInArrow(mark, "node long, class_id long, n long, n_many long, few boolean")
    )
    cores = materialized(marked.groupBy("class_id", "n_many").agg(
        F.sum(F.when(~F.col("few"), F.col("n")).otherwise(0)).alias("core_rows"), F.count_if("few").alias("n_few")
    ))
    # All in the core are linked with each other.
    in_core = joined_by(marked.where("not few").select("node", "class_id", "n"), cores.select("class_id", "core_rows", "n_many"),
                        "class_id", F.col("n_many"), limit).select("node", (F.col("core_rows") - F.col("n")).alias("n_links"))
    to_compare = materialized(joined_by(
        marked.select("node", "class_id", "n", "few"), cores.where("n_few > 0").select("class_id", "n_few", "n_many"),
        "class_id", F.col("n_many"), limit,
    ))

    def count(group: pa.Table) -> pa.Table:
        nodes_of, n, rim = (group.column(c).to_numpy() for c in ("node", "n", "rim"))
        few = group.column("as_few").to_numpy()
        sums = np.zeros(len(n), np.int64)
        for x, y in near_pairs(group, "class_id", threshold):
            others = nodes_of[x] != nodes_of[y]
            np.add.at(sums, x[others], n[y[others]])
            np.add.at(sums, y[others], n[x[others]])
        # Rim nodes ask for themselves.
        told = few | ~rim
        return pa.table({"node": pa.array(nodes_of[told], pa.int64()), "n_links": pa.array(sums[told], pa.int64())})

    vectors = inside.select("node", "unit", "dim")
    placed = in_blocks(to_compare.join(vectors, "node").withColumn("rim", F.col("few")), "class_id", to_compare.count())
    at_rim = placed.groupBy(*MEET).applyInArrow(count, "node long, n_links long")
    copies = inside.select("node", (F.col("n") - 1).alias("n_links"))
    parts = copies.unionByName(in_core).unionByName(at_rim)
    return parts.groupBy("node").agg(F.sum("n_links").alias("n_links"))


# -- the operator --------------------------------------------------------------


def unit_vectors(rows: DataFrame) -> DataFrame:
    """Rows with vec_id and v, and ``unit``: v scaled to length 1 in double precision; null if it takes no part."""
    kind = rows.schema["v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            flat = vectors.flatten().cast(pa.float64())
            values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
            lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(lengths)), lengths)
            usable = (lengths > 0) & (np.bincount(row, ~np.isfinite(values), len(lengths)) == 0)
            greatest = np.zeros(len(lengths))
            np.maximum.at(greatest, row, np.where(usable[row], np.abs(values), 0.0))
            usable &= greatest > 0
            # First by the greatest component, so that no square overflows.
            kept = usable[row]
            scaled = values[kept] / greatest[row[kept]]
            norms = np.sqrt(np.bincount(row[kept], scaled * scaled, len(lengths)))
            ends = np.append(0, np.cumsum(np.where(usable, lengths, 0)))
            units = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(scaled / norms[row[kept]]), mask=pa.array(~usable))
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors, units], names=["vec_id", "v", "unit"])

    return rows.mapInArrow(run, T.StructType([rows.schema["vec_id"], kind, T.StructField("unit", T.ArrayType(T.DoubleType()))]))


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD,
                 miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = unit_vectors(vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v")))
    # Two independent 64-bit hashes stand for a vector.
    prints = [F.xxhash64(F.lit(seed), "v").alias(f"print_{seed}") for seed in (1, 2)]
    taking_part = rows.where("vec_id is not null and unit is not null")
    nodes = materialized(
        taking_part.select("vec_id", "unit", *prints).groupBy("print_1", "print_2")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("unit").alias("unit"))
        .withColumns({"node": F.monotonically_increasing_id(), "dim": F.size("unit")})
    )
    n_nodes = nodes.count()
    classes = materialized(classes_of(nodes, n_nodes, threshold, miss))
    counts = link_counts(classes, nodes, n_nodes, threshold)
    slim = nodes.select("node", "print_1", "print_2", "least", "n")
    firsts = classes.join(slim.select("node", "least"), "node").groupBy("class_id").agg(
        F.min("least").alias("first"), F.count(F.lit(1)).alias("n_many")
    )
    named = joined_by(classes, materialized(firsts), "class_id", F.col("n_many"), hot_limit(n_nodes)).select("node", "first")
    results = materialized(
        slim.join(counts, "node", "left").join(named, "node", "left").select(
            F.struct("print_1", "print_2").alias("print"), "n",
            F.coalesce("n_links", F.col("n") - 1).alias("n_links"), F.coalesce("first", "least").alias("component_id"),
        )
    )
    asked = taking_part.select("vec_id", F.struct(*prints).alias("print"))
    n_rows = nodes.agg(F.sum("n")).first()[0] or 0
    done = joined_by(asked, results, "print", F.col("n"), hot_limit(n_rows)).select("vec_id", "n_links", "component_id")
    apart = rows.where("vec_id is null or unit is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return done.unionByName(apart).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op13_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector of ``embeddings`` with its links, its component and whether it stands for it."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
