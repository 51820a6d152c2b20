"""Exact top-k by inner product: ball trees per shard (operator 4).

Candidates are dealt by hash into shards of about ``shard_rows`` rows. Each
shard becomes one ball tree, stored as a row of the shared folder. Trees stay
in one place; queries travel to them in blocks, and every block meets every
shard once, so a search has as many keys as there are shards.

In a tree the inner product of a query q with any row of a node with centre c
and radius r is at most q.c + |q| r. A query drops the nodes whose bound is
below its current k-th score, from the root down, and visits the remaining
leaves by decreasing bound, raising the k-th score as it goes. The k-th score
is shared: ``warm_shards`` shards are searched first, and all others start from
the k-th score found there, so most of their nodes are never opened.

Scores are exact integers. Ties go to the smaller id.

Defined results: rows whose id is null, or whose vector is null, empty or
holds a null or non-finite component take no part; every other row is a
candidate for all queries but its own, also where ids repeat, and each row of
a repeated query id is a query of its own; vectors of different lengths are not
compared; a query with fewer than k candidates returns all; an empty table
gives no rows. Components are kept in 64 bits where 32 do not hold them; components
and scores must be below 2^63 in size after quantisation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statmart.llm.common import table
from statmart.session import materialized

K = 5
SHARD_ROWS = 8192
LEAF_ROWS = 128
QUERY_ROWS = 1024
WARM_SHARDS = 4
LOWEST = np.iinfo(np.int64).min


def quantised(vector: Column, scale: int = 256) -> Column:
    """Components as floor(scale * x); null if the vector takes no part."""
    whole = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(whole, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when((F.size(vector) > 0) & finite, F.transform(whole, lambda x: F.floor(x * scale).cast("long")))


def _packed(values: np.ndarray) -> bytes:
    """Integers in 32 bits, or in 64 where one does not fit."""
    fits = not values.size or -1 << 31 <= values.min() <= values.max() < 1 << 31
    return np.ascontiguousarray(values, "<i4" if fits else "<i8").tobytes()


def _unpacked(data: bytes, n_rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<i8" if len(data) == 8 * n_rows * dim else "<i4").reshape(n_rows, dim).astype(np.int64)


def build_tree(vectors: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row order, node starts and ends, centres and radii of a balanced tree; node i has the children 2i+1 and 2i+2."""
    depth = max(0, int(np.ceil(np.log2(max(1, len(vectors)) / leaf_rows))))
    n_nodes = 2 ** (depth + 1) - 1
    order = np.arange(len(vectors))
    spans = np.zeros((n_nodes, 2), np.int64)
    centres = np.zeros((n_nodes, vectors.shape[1]))
    radii = np.zeros(n_nodes)
    spans[0] = 0, len(vectors)
    for node in range(n_nodes):
        low, high = spans[node]
        rows = vectors[order[low:high]].astype(float)
        if len(rows):
            centres[node] = rows.mean(axis=0)
            away = np.linalg.norm(rows - centres[node], axis=1)
            radii[node] = away.max()
        if 2 * node + 2 < n_nodes:
            middle = (low + high) // 2
            if high - low > 1:
                # Split half and half along the line between two far points.
                one = rows[away.argmax()]
                other = rows[np.linalg.norm(rows - one, axis=1).argmax()]
                along = rows @ (other - one)
                order[low:high] = order[low:high][np.argpartition(along, middle - low)]
            spans[2 * node + 1] = low, middle
            spans[2 * node + 2] = middle, high
    return order, spans, centres, radii


def search_tree(ids: np.ndarray, vectors: np.ndarray, spans: np.ndarray, centres: np.ndarray, radii: np.ndarray,
                query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k best rows for each query, of those that reach its bound; LOWEST marks none."""
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * vectors.shape[1]
    exact = np.float64 if largest < 2 ** 53 else np.int64
    rows, asked, wide = vectors.astype(exact), queries.astype(exact), queries.astype(float)
    best_scores = np.full((len(queries), k), LOWEST)
    best_ids = np.full((len(queries), k), np.iinfo(np.int64).max)
    floor = bounds.copy()
    norms = np.linalg.norm(wide, axis=1)

    def upper(nodes: np.ndarray) -> np.ndarray:
        inner = wide @ centres[nodes].T + norms[:, None] * radii[nodes]
        # Slack for rounding, so that no row is lost to it.
        return inner + 1e-9 * norms[:, None] * (np.linalg.norm(centres[nodes], axis=1) + radii[nodes]) + 1e-6

    first = 0
    alive = np.ones((len(queries), 1), bool)
    while True:
        nodes = np.arange(first, 2 * first + 1)
        bound = upper(nodes)
        alive &= (bound >= floor[:, None]) & (spans[nodes, 1] > spans[nodes, 0])
        if 2 * first + 2 >= len(radii):
            break
        alive = np.repeat(alive, 2, axis=1)
        first = 2 * first + 1
    bound = np.where(alive, bound, -np.inf)
    by_bound = np.argsort(-bound, axis=1, kind="stable")
    for rank in range(len(nodes)):
        leaf = by_bound[:, rank]
        reach = bound[np.arange(len(queries)), leaf]
        active = np.flatnonzero((reach > -np.inf) & (reach >= floor))
        if not len(active):
            break
        for at in np.unique(leaf[active]):
            asking = active[leaf[active] == at]
            low, high = spans[nodes[at]]
            scores = (asked[asking] @ rows[low:high].T).astype(np.int64)
            found = np.broadcast_to(ids[low:high], scores.shape)
            out = (found == query_ids[asking, None]) | (scores < floor[asking, None])
            scores = np.where(out, LOWEST, scores)
            merged = np.concatenate([best_scores[asking], scores], axis=1)
            merged_ids = np.concatenate([best_ids[asking], np.where(out, np.iinfo(np.int64).max, found)], axis=1)
            # Bitwise not turns the order round without overflow.
            top = np.lexsort((merged_ids, ~merged), axis=-1)[:, :k]
            best_scores[asking] = np.take_along_axis(merged, top, axis=1)
            best_ids[asking] = np.take_along_axis(merged_ids, top, axis=1)
            floor[asking] = np.maximum(floor[asking], best_scores[asking, -1])
    return best_ids, best_scores


TREE = "dim int, shard long, ids binary, keys binary, places binary, vectors binary, spans binary, centres binary, radii binary"
HITS = "query_key long, query_id long, vec_id long, key long, score long"


def build_shards(candidates: DataFrame, n_shards: int, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row per shard with its tree; candidates have vec_id, the number of their row (key) and the integer vector q.

    In a tree, rows go by their place in the order of ids and keys, so the smaller place wins a tie.
    """
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["vec_id", "key"], kind="stable")
        vectors = np.array(pdf["q"].tolist(), np.int64)
        order, spans, centres, radii = build_tree(vectors, leaf_rows)
        return pd.DataFrame({
            "dim": [vectors.shape[1]], "shard": [pdf["shard"].iloc[0]],
            "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "keys": [pdf["key"].to_numpy(np.int64).tobytes()],
            "places": [order.astype(np.int64).tobytes()], "vectors": [_packed(vectors[order])],
            "spans": [spans.tobytes()], "centres": [centres.tobytes()], "radii": [radii.tobytes()],
        })

    dealt = candidates.withColumns({"dim": F.size("q"), "shard": F.pmod(F.xxhash64("key"), F.lit(n_shards))})
    return dealt.groupBy("dim", "shard").applyInPandas(build, TREE)


def blocks_of(queries: DataFrame, n_queries: int, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Queries (query_key, query_id, q, bound) in blocks, a row each."""
    n_blocks = max(1, -(-n_queries // query_rows))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "dim": [pdf["dim"].iloc[0]], "block": [pdf["block"].iloc[0]],
            "query_keys": [pdf["query_key"].to_numpy(np.int64).tobytes()], "query_ids": [pdf["query_id"].to_numpy(np.int64).tobytes()],
            "queries": [_packed(np.array(pdf["q"].tolist(), np.int64))],
            "bounds": [pdf["bound"].to_numpy(np.int64).tobytes()],
        })

    dealt = queries.withColumns({"dim": F.size("q"), "block": F.pmod(F.xxhash64("query_key", F.lit(1)), F.lit(n_blocks))})
    return dealt.groupBy("dim", "block").applyInPandas(pack, "dim int, block long, query_keys binary, query_ids binary, queries binary, bounds binary")


def search(trees: DataFrame, blocks: DataFrame, first: int, last: int, k: int) -> DataFrame:
    """Up to k hits for each query and each shard from ``first`` to ``last`` that reach the query's bound."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                query_keys, query_ids = (np.frombuffer(b, np.int64) for b in (row.query_keys, row.query_ids))
                ids, keys, places = (np.frombuffer(b, np.int64) for b in (row.ids, row.keys, row.places))
                # A query's own place in this shard; -1 if it lies elsewhere.
                by_key = np.argsort(keys)
                at = np.minimum(np.searchsorted(keys[by_key], query_keys), len(keys) - 1)
                own = np.where(keys[by_key[at]] == query_keys, by_key[at], -1)
                found, scores = search_tree(
                    places, _unpacked(row.vectors, len(keys), row.dim),
                    np.frombuffer(row.spans, np.int64).reshape(-1, 2),
                    np.frombuffer(row.centres, float).reshape(-1, row.dim), np.frombuffer(row.radii, float),
                    own, _unpacked(row.queries, len(query_ids), row.dim),
                    np.frombuffer(row.bounds, np.int64), k,
                )
                asked, _ = hit = np.nonzero(scores != LOWEST)
                yield pd.DataFrame({
                    "query_key": query_keys[asked], "query_id": query_ids[asked], "vec_id": ids[found[hit]], "key": keys[found[hit]], "score": scores[hit],
                })

    # Every block goes to every shard.
    sent = blocks.withColumn("shard", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"))))
    return trees.join(sent, ["dim", "shard"]).mapInPandas(find, HITS)


def best(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query, ranked."""
    order = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id", "key")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = K, shard_rows: int = SHARD_ROWS,
          warm_shards: int = WARM_SHARDS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the k greatest inner products; ``vectors`` has vec_id and the integer q."""
    rows = materialized(
        vectors.where("vec_id is not null and q is not null").select("vec_id", "q").withColumn("key", F.monotonically_increasing_id())
    )
    asked = rows.where(is_query).select(F.col("key").alias("query_key"), F.col("vec_id").alias("query_id"), "q")
    n_queries = asked.count()
    n_shards = max(1, -(-rows.count() // shard_rows))
    warm_shards = min(warm_shards, n_shards)
    trees = materialized(build_shards(rows, n_shards))

    cold = blocks_of(asked.withColumn("bound", F.lit(int(LOWEST)).cast("long")), n_queries, query_rows)
    warm = materialized(best(search(trees, cold, 0, warm_shards - 1, k), k))
    if warm_shards == n_shards:
        return warm.select("query_id", "rank", "vec_id", "score")
    # A query's k-th score so far; without k hits there is no bound yet.
    reached = warm.groupBy("query_key").agg(
        F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(int(LOWEST)).alias("bound")
    )
    bounded = asked.join(reached, "query_key", "left").select(
        "query_key", "query_id", "q", F.coalesce("bound", F.lit(int(LOWEST))).cast("long").alias("bound")
    )
    rest = search(trees, blocks_of(bounded, n_queries, query_rows), warm_shards, n_shards - 1, k)
    return best(warm.drop("rank").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", quantised(F.col("embedding")).alias("q"))
    return top_k(vectors, F.col("vec_id") % 50 == 0)
