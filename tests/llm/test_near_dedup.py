"""Near-duplicate classes, components, and the pipeline."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from statmart.llm import language_id, near_dedup, packing
from statmart.llm.components import components

SF = "/root/testdata/sf0.001"


def classes_of(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def plain_classes(rows, weights):
    """The class number of every row (id, text), by comparing all pairs; rows without words are alone."""
    vectors = [near_dedup.weighted(near_dedup.words_of(t), weights) for _, t in rows]
    links = [
        (i, j) for (i, x), (j, y) in combinations(enumerate(vectors), 2)
        if len(x[0]) and len(y[0]) and near_dedup.weighted_jaccard(x, y) >= near_dedup.THRESHOLD
    ]
    number = classes_of(range(len(rows)), links)
    return [number[i] for i in range(len(rows))]


def names_of(rows, numbers):
    """The least id of every row's class."""
    ids = {}
    for (i, _), number in zip(rows, numbers):
        ids.setdefault(number, []).append(i)
    return [min((i for i in ids[number] if i is not None), default=None) for number in numbers]


def check_against_plain(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    weights = near_dedup.bucket_weights(*near_dedup.sketch_frequencies(docs.select("text")))
    numbers = plain_classes(rows, weights)
    names = names_of(rows, numbers)
    found = near_dedup.near_classes(docs).collect()
    assert sorted(((r["doc_id"], r["class_id"]) for r in found), key=str) == sorted(zip([i for i, _ in rows], names), key=str)
    # One row of each class stays, of its least id.
    kept = [(r["doc_id"], r["text"]) for r in near_dedup.keep_first_of_class(docs).select("doc_id", "text").collect()]
    assert len(kept) == len(set(numbers))
    known = dict(zip(rows, zip(numbers, names)))
    assert all(known[row][1] == row[0] for row in kept)
    alone = sum(1 for _, t in rows if not near_dedup.words_of(t))
    assert len({known[row][0] for row in kept if near_dedup.words_of(row[1])}) == len(kept) - alone
    return dict(zip([i for i, _ in rows], names))


def test_documents_against_all_pairs(spark):
    want = check_against_plain(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    assert len(set(want.values())) < len(want)


def edited(words, n, chance):
    words = list(words)
    for at in chance.sample(range(len(words)), n):
        words[at] = f"new{chance.randrange(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("block_rows", [512, 6])
def test_group_around_the_threshold(spark, monkeypatch, block_rows):
    """Copies with 0 to 12 edits of one text lie on both sides of the threshold, whatever the blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block_rows)
    chance = random.Random(8)
    base = [f"w{chance.randrange(5000)}" for _ in range(300)]
    rows = [(i, edited(base, i % 13, chance)) for i in range(60)]
    rows += [(100 + i, " ".join(f"x{chance.randrange(5000)}" for _ in range(200))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = check_against_plain(spark, docs)
    assert 20 < len(set(want.values())) < 80


def test_every_row_is_compared_by_its_own_text(spark):
    """Ids with several texts, and rows without an id."""
    chance = random.Random(5)
    bases = [[f"{c}{chance.randrange(5000)}" for _ in range(200)] for c in "abcdefg"]
    near = [edited(b, 2, chance) for b in bases]
    rows = [(20, " ".join(bases[0])), (20, " ".join(bases[1])), (30, near[1]), (25, near[0]), (50, " ".join(bases[2])), (60, near[2]),
            (70, " ".join(bases[3])), (70, ""), (10, near[3]), (80, " ".join(bases[4])), (81, " ".join(bases[5])), (0, None), (1, " "),
            (None, near[4]), (None, " ".join(bases[6])), (None, near[6]), (None, near[6]), (None, None), (None, "")]
    want = check_against_plain(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert want[30] == want[25] == 20 and want[60] == 50 and want[10] == 10 and want[0] == 0 and want[80] != want[81]


def test_no_text_is_lost_with_its_id(spark):
    """Id 1 has the texts x and y, id 2 has x, id 3 has y: one x and one y stay."""
    x, y = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    docs = spark.createDataFrame([(1, x, "a"), (1, y, "b"), (2, x, "c"), (3, y, "d"), (3, y, "e")], "doc_id long, text string, more string")
    for partitions in (1, 4):
        kept = near_dedup.keep_first_of_class(docs.repartition(partitions)).collect()
        assert sorted((r["doc_id"], r["text"], r["more"]) for r in kept) == [(1, x, "a"), (1, y, "b")]
    again = spark.createDataFrame([(3, y, m) for m in "abcdef"], "doc_id long, text string, more string")
    assert len({near_dedup.keep_first_of_class(again.repartition(n)).collect()[0]["more"] for n in (1, 2, 5)}) == 1


def test_near_dedup_edges(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(5, text), (3, text.upper()), (9, text + " tail"), (9, text + " tail"), (1, None), (2, ""), (4, " \n"), (None, text), (None, None),
            (6, "one two"), (7, "One  two"), (8, "two one"), (11, "far " * 50 + "away"), (12, "other"), (11, "other"), (13, "z " * 30000)]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, class_id int, key string")
    found = near_dedup.near_classes(docs).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in found if r["doc_id"]} == {
        5: 3, 3: 3, 9: 3, 1: 1, 2: 2, 4: 4, 6: 6, 7: 6, 8: 8, 11: 11, 12: 11, 13: 13}
    # A row without an id is a copy like others; one without a text is alone.
    assert {(r["class_id"], r["is_kept"]) for r in found if r["doc_id"] is None} == {(3, False), (None, True)}
    kept = near_dedup.keep_first_of_class(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 8, 11, 11, 13]
    assert near_dedup.near_classes(docs.limit(0)).count() == 0


def test_samples_agree_as_often_as_texts_are_similar():
    chance = np.random.default_rng(3)
    tables = near_dedup.sampling_tables()
    agreed, similar = [], []
    for _ in range(60):
        hashed = np.unique(chance.integers(0, 2**63, 150).astype(np.uint64))
        weight = chance.uniform(0.5, 6, len(hashed))
        other = np.where(chance.random(len(hashed)) < 0.3, weight * chance.uniform(0.3, 3, len(hashed)), weight)
        agreed.append((near_dedup.samples(hashed, weight, tables) == near_dedup.samples(hashed, other, tables)).mean())
        similar.append(near_dedup.weighted_jaccard((hashed, weight), (hashed, other)))
    assert abs(np.mean(agreed) - np.mean(similar)) < 0.02


def test_samples_do_not_depend_on_blocks(monkeypatch):
    hashed, weight = near_dedup.weighted([f"w{i}" for i in range(500)], np.ones(1 << 18, np.float32))
    whole = near_dedup.samples(hashed, weight, near_dedup.sampling_tables())
    monkeypatch.setattr(near_dedup, "BLOCK", 64)
    assert (near_dedup.samples(hashed, weight, near_dedup.sampling_tables()) == whole).all()


def test_components(spark):
    chance = random.Random(1)
    links = [(chance.randrange(400), chance.randrange(400)) for _ in range(250)]
    links += [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2100)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    ends = {x for a, b in links if a != b for x in (a, b)}
    want = classes_of({x for ab in links for x in ab}, links)
    assert {r["node"]: r["class_id"] for r in found} == {i: c for i, c in want.items() if i in ends} and len(found) == len(ends)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kept", F.lit(3))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "x"), (-3, "12 34")], "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True)
    columns, before, seen = docs.columns, docs.count(), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialized(stage(spark, docs, SF))
        assert docs.columns == columns and docs.count() <= before
        before, seen[name] = docs.count(), docs
    model = language_id.trained_on(spark.read.parquet(f"{SF}/documents.parquet"))
    assert len(model["languages"]) and seen["language_id"].where("doc_id < 0").count() == 0
    words = seen["quality_rules"].select(F.size(F.split(F.trim("text"), r"\s+")).alias("n")).collect()
    assert min(r["n"] for r in words) >= 50
    kept = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    all_good = seen["quality_rules"]
    weights = near_dedup.bucket_weights(*near_dedup.sketch_frequencies(all_good.select("text")))
    good = [(r["doc_id"], r["text"]) for r in all_good.select("doc_id", "text").collect()]
    assert sorted(i for i, _ in kept) == sorted(set(names_of(good, plain_classes(good, weights))))
    encoder = packing.PartEncoder(packing.word_bpe_path())
    pieces = [(i, *p) for i, t in kept for p in packing.cut(encoder.encode([t])[0] + np.array([1], "<u4").tobytes())]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(tuple(r)[:5] for r in packed) == sorted(pieces)
    run = corpus_pipeline.run(spark, SF)
    assert run.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and run.count() > 0


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialized(stage(spark, docs, SF))
    assert docs.count() == 0
