"""Near-duplicate vectors against all pairs, and the recall of the hash tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statmart.llm import cross_polytope


def plain(rows, threshold=0.95):
    """vec_id, n_links, component_id and kept by comparing all pairs."""
    valid = [i for i, (vec_id, v) in enumerate(rows) if vec_id is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for dim in {len(rows[i][1]) for i in valid}:
        at = np.array([i for i in valid if len(rows[i][1]) == dim])
        units = np.array([rows[i][1] for i in at], float)
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        near = units @ units.T >= threshold
        np.fill_diagonal(near, False)
        for i, line in zip(at, near):
            links[i] = int(line.sum())
            for j in at[line]:
                one, other = root(i), root(int(j))
                parent[max(one, other)] = min(one, other)
    least = {}
    for i in valid:
        r = root(i)
        least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    out = []
    for i, (vec_id, _) in enumerate(rows):
        component = least[root(i)] if i in set(valid) else vec_id
        out.append((vec_id, links[i], component, vec_id is None or vec_id == component))
    return sorted(out, key=str)


def run(spark, rows, kind="float", partitions=4, **options):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], f"vec_id long, embedding array<{kind}>, node int, n_links int").repartition(partitions)
    found = cross_polytope.near_vectors(df, **options).select("vec_id", "n_links", "component_id", "kept").collect()
    return sorted((tuple(r) for r in found), key=str)


def around(chance, centre, cosine, n):
    centre = centre / np.linalg.norm(centre)
    noise = chance.normal(size=(n, len(centre)))
    noise -= (noise @ centre)[:, None] * centre
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return cosine * centre + np.sqrt(1 - cosine ** 2) * noise


def as_rows(vectors, first=0):
    return [(first + i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]


def test_groups_of_copies(spark):
    """Tight groups, groups with a rim, single vectors, equal and scaled copies, and vectors that take no part."""
    chance = np.random.default_rng(1)
    parts = [chance.normal(size=(400, 32))]
    parts += [around(chance, chance.normal(size=32), c, n) for c, n in ((0.995, 300), (0.99, 60), (0.98, 50), (0.965, 40), (0.999, 2), (0.98, 3))]
    vectors = np.concatenate(parts)
    vectors = vectors[chance.permutation(len(vectors))] * chance.uniform(0.1, 10, (len(vectors), 1))
    rows = as_rows(vectors)
    rows += [(2000 + i, rows[5][1]) for i in range(40)] + [(2100, [2 * x for x in rows[5][1]]), (7, rows[9][1]), (7, rows[7][1]), (9, rows[9][1])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 32), (3003, [None] * 32), (3004, [float("nan")] + [1.0] * 31), (3005, [float("inf")] * 32),
             (None, rows[5][1]), (3006, [1.0]), (3007, [4.0]), (3008, [-1.0]), (3009, [1.0, 0.1]), (3010, [1.0, 0.11]), (3011, rows[5][1][:31])]
    assert run(spark, rows) == plain(rows)


def test_chains_and_components_wider_than_the_threshold(spark):
    """A chain along an arc: neighbours are linked, ends are not; and two groups joined by one vector."""
    chance = np.random.default_rng(2)
    one, other = np.linalg.qr(chance.normal(size=(16, 2)))[0].T
    turns = np.linspace(0, 2.5, 300)
    chain = np.cos(turns)[:, None] * one + np.sin(turns)[:, None] * other
    a, b = np.linalg.qr(chance.normal(size=(16, 2)))[0].T
    left, right = around(chance, a, 0.999, 80), around(chance, np.cos(0.5) * a + np.sin(0.5) * b, 0.999, 80)
    bridge = (np.cos(0.25) * a + np.sin(0.25) * b)[None]
    rows = as_rows(np.concatenate([chain, left, right, bridge])[chance.permutation(461)])
    assert run(spark, rows) == plain(rows)


def test_large_groups_are_split(spark, monkeypatch):
    """Blocks of a few rows and frequent keys from a few rows on give the same."""
    for name, value in (("FEW", 7), ("MANY", 11), ("SMALL", 5), ("GROUP_ROWS", 50)):
        monkeypatch.setattr(cross_polytope, name, value)
    monkeypatch.setattr(cross_polytope, "hot_limit", lambda n: 10)
    chance = np.random.default_rng(3)
    vectors = np.concatenate([around(chance, chance.normal(size=24), c, 120) for c in (0.99, 0.97)] + [chance.normal(size=(60, 24))])
    rows = as_rows(vectors[chance.permutation(300)])
    rows += [(900 + i, rows[0][1]) for i in range(30)]
    assert run(spark, rows, "double") == plain(rows)


@pytest.mark.parametrize("dim, n_rows", [(64, 10_000), (64, 10**7), (48, 10**5), (3, 1000)])
def test_recall_at_the_threshold(dim, n_rows):
    """Pairs at exactly the threshold share a bucket in all but about one of a thousand cases."""
    tables = cross_polytope.HashTables(dim, n_rows)
    chance = np.random.default_rng(8)
    x = chance.normal(size=(3000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = chance.normal(size=(3000, dim))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    y = 0.95 * x + np.sqrt(1 - 0.95 ** 2) * z
    met = np.zeros(len(x), bool)
    for t in range(tables.n_tables):
        keys = [tables.keys(v, t) for v in (x, y)]
        met |= (keys[0][:, :, None] == keys[1][:, None, :]).any(axis=(1, 2))
    assert met.mean() >= 0.99


def test_unrelated_vectors_share_few_buckets():
    for n_rows in (1000, 100_000):
        tables = cross_polytope.HashTables(64, n_rows)
        x = np.random.default_rng(9).normal(size=(2000, 64))
        keys = tables.keys(x / np.linalg.norm(x, axis=1, keepdims=True), 0)
        _, n = np.unique(keys, return_counts=True)
        assert (n * (n - 1)).sum() / len(x) * n_rows / len(x) < 12


def test_hadamard_keeps_lengths_and_angles():
    x = np.random.default_rng(5).normal(size=(20, 64))
    assert np.allclose(cross_polytope.hadamard(x) @ cross_polytope.hadamard(x).T, x @ x.T)


def test_planted_copies_of_the_given_table(spark):
    """Vectors with noisy copies beside them: all links are found, other vectors have none."""
    given = [r["embedding"] for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").collect()]
    chance = np.random.default_rng(6)
    copies = [c for v in given[:60] for c in around(chance, np.array(v), float(chance.uniform(0.952, 0.999)), int(chance.integers(1, 4)))]
    rows = as_rows(given) + as_rows(copies, 10_000)
    want, got = plain(rows), run(spark, rows)
    found, missing = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found >= 0.995 * missing and all(g[1] <= w[1] for g, w in zip(got, want))


def test_empty_table(spark):
    assert run(spark, []) == []
    nothing = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in cross_polytope.near_vectors(nothing).collect()] == [(1, 0, 1, True)]
    assert cross_polytope.near_vectors(spark.range(0).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"))).count() == 0
