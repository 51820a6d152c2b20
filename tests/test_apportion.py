import datetime
import random

import pytest
from pyspark.sql import functions as F

from statmart.operators import apportion as module
from statmart.operators.apportion import apportion, apportion_codes, topk_with_other, with_other_row
from statmart.operators.prefix import chunked, sums_before


def shares(weights, target, zero_policy="other"):
    """Plain integer version: floors first, then one each by remainder, weight, key."""
    kept = {k: w or 0 for k, w in weights.items() if zero_policy == "even" or (w or 0) > 0}
    if not kept or (zero_policy == "other" and target <= 0):
        return {}
    target = max(target, 0)
    total = sum(kept.values())
    if total == 0:
        kept_units = {k: 1 for k in kept}
        total = len(kept)
    else:
        kept_units = kept
    out = {k: target * w // total for k, w in kept_units.items()}
    order = sorted(kept_units, key=lambda k: (-(target * kept_units[k] % total), -kept_units[k], k))
    for k in order[: target - sum(out.values())]:
        out[k] += 1
    return out


def run(spark, groups, targets, **options):
    rows = [(g, k, w) for g, weights in groups.items() for k, w in weights.items()]
    weights = spark.createDataFrame(rows, "g string, key string, count bigint")
    goals = spark.createDataFrame(list(targets.items()), "g string, target bigint")
    got = {}
    for r in apportion(weights, goals, ["g"], "key", **options).collect():
        got.setdefault(r["g"], {})[r["key"]] = r["scaled"]
    return got


def test_tie_goes_to_the_lower_key(spark):
    assert run(spark, {"g": {"a": 1, "b": 1, "c": 1}}, {"g": 10}) == {"g": {"a": 4, "b": 3, "c": 3}}


def test_zero_weights(spark):
    zeros = {"g": {"a": 0, "b": 0, "c": 0}}
    assert run(spark, zeros, {"g": 8}) == {}
    assert run(spark, zeros, {"g": 8}, zero_policy="even") == {"g": {"a": 3, "b": 3, "c": 2}}
    mixed = {"g": {"a": 0, "b": 5, "c": None}}
    assert run(spark, mixed, {"g": 7}, zero_policy="even") == {"g": {"a": 0, "b": 7, "c": 0}}


def test_negative_target(spark):
    assert run(spark, {"g": {"a": 5}}, {"g": -3}) == {}
    assert run(spark, {"g": {"a": 5}}, {"g": -3}, zero_policy="even") == {"g": {"a": 0}}


def test_census_split(spark):
    # Published census counts and the estimate made from them.
    weights = {"canadian_born": 27042125, "naturalized": 6101105, "permanent_resident": 2260400}
    want = {"canadian_born": 29633022, "naturalized": 6685650, "permanent_resident": 2476968}
    assert run(spark, {"g": weights}, {"g": 38795640}) == {"g": want}


def test_unknown_policy_and_key_type(spark):
    weights = spark.createDataFrame([("g", 10, 1), ("g", 9, 1)], "g string, key int, count bigint")
    goals = spark.createDataFrame([("g", 3)], "g string, target bigint")
    assert sorted((r["key"], r["scaled"]) for r in apportion(weights, goals, ["g"], "key").collect()) == [(9, 2), (10, 1)]
    with pytest.raises(ValueError, match="zero_policy"):
        apportion(weights, goals, ["g"], "key", zero_policy="x")


@pytest.mark.parametrize("policy", ["other", "even"])
def test_random_groups_match_plain_integers(spark, policy):
    rng = random.Random(7)
    groups, targets = {}, {}
    for g in range(60):
        size = rng.choice([1, 2, 5, 40])
        top = rng.choice([0, 1, 3, 1000, 10**12])
        groups[f"g{g}"] = {f"key {rng.random():.9f}": rng.randint(0, top) for _ in range(size)}
        targets[f"g{g}"] = rng.choice([0, 1, 7, 10**6 + 3, 10**15 + 1])
    want = {g: shares(w, targets[g], policy) for g, w in groups.items()}
    got = run(spark, groups, targets, zero_policy=policy)
    assert got == {g: s for g, s in want.items() if s}
    for g, s in got.items():
        assert sum(s.values()) == targets[g]


def test_many_equal_weights(spark):
    weights = {f"Part#{i:05d}": 1 + (i % 3 == 0) for i in range(3000)}
    assert run(spark, {"g": weights, "h": {"x": 1}}, {"g": 4567, "h": 9}) == {"g": shares(weights, 4567), "h": {"x": 9}}


KEYS = {
    "string": lambda i: ["Part#", "Part", "", "Pärt#é"][i % 4] + f"{i * 7919 % 1000:05d}"[: 1 + i % 6] + "x" * (i % 3) + str(i),
    "int": lambda i: (i * 7919) % 100_003 - 50_000,
    "bigint": lambda i: (-1) ** i * (i * 10**15 + 7),
    "date": lambda i: datetime.date(2000, 1, 1) + datetime.timedelta(days=i * 37),
}


@pytest.mark.parametrize("kind", sorted(KEYS))
@pytest.mark.parametrize("policy", ["other", "even"])
def test_cut_offs_by_finer_and_finer_ranges(spark, monkeypatch, kind, policy):
    """With few ranges and hardly any rows that may be ranked, remainders, weights and keys are all narrowed down."""
    monkeypatch.setattr(module, "FEW", 2)
    monkeypatch.setattr(module, "BUCKETS", 3)
    rng = random.Random(11)
    made = {
        "flat": [1] * 90, "two": [1 + (i % 2) for i in range(60)], "zeros": [0] * 25, "spread": [rng.randint(0, 10**9) for _ in range(80)],
        "ties": [rng.choice([3, 3, 3, 6, 10**12]) for _ in range(70)], "one": [5],
    }
    targets = {g: rng.choice([7, 41, 10**6 + 3, 10**15 + 1]) for g in made}
    weights = {g: {KEYS[kind](i): w for i, w in enumerate(ws)} for g, ws in made.items()}
    rows = [(g, k, w) for g, ws in weights.items() for k, w in ws.items()]
    df = spark.createDataFrame(rows, f"g string, key {kind}, count bigint")
    goals = spark.createDataFrame(list(targets.items()), "g string, target bigint")
    got = {}
    for r in apportion(df, goals, ["g"], "key", zero_policy=policy).collect():
        got.setdefault(r["g"], {})[r["key"]] = r["scaled"]
    want = {g: shares(w, targets[g], policy) for g, w in weights.items()}
    assert got == {g: s for g, s in want.items() if s}


@pytest.mark.parametrize("weight", ["1", "id % 1000 + 1"])
def test_groups_are_not_sorted_and_not_written(spark, monkeypatch, weight):
    """Selection: no range exchange, and what is written is a row per group. Equal weights are the hard case."""
    written = []

    def watched(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        kept = real(df)
        written.append((kept.count(), plan))
        return kept

    real = module.materialized
    monkeypatch.setattr(module, "materialized", watched)
    monkeypatch.setattr(module, "FEW", 100)
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "h").otherwise("g").alias("g"),
        F.concat(F.lit("Part#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("key"), F.expr(weight).alias("count"),
    )
    goals = df.groupBy("g").agg((F.sum("count") * 7 / 3).cast("bigint").alias("target"))
    result = apportion(df, goals, ["g"], "key")
    sums = {r["g"]: (r["n"], r["t"]) for r in result.join(goals, "g").groupBy("g").agg(F.sum("scaled").alias("n"), F.max("target").alias("t")).collect()}
    assert len(sums) == 2 and all(n == t for n, t in sums.values())
    assert written and all(n == 2 for n, _ in written)
    plans = [p for _, p in written] + [result._jdf.queryExecution().executedPlan().toString()]
    assert not any("rangepartitioning" in p for p in plans)


def test_no_task_holds_a_large_group(spark):
    """One hot weight, one outlier key: the chunks of the group stay even."""
    rows = spark.range(4000).select(
        F.lit("g").alias("g"), F.concat(F.lit("Part#"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("key"), F.lit(1).alias("w")
    ).unionByName(spark.createDataFrame([("g", "A", 1)], "g string, key string, w int"))
    # Chunks this small would be put together; large ones are not.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunks = chunked(rows, ["g", F.col("w").desc(), "key"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in chunks.groupBy("chunk").count().collect()]
    assert sum(sizes) == 4001 and max(sizes) < 4001 / 4
    before = sums_before(chunks, ["g"], {"n": F.lit(1)}).orderBy("key").collect()
    assert [r["n"] for r in before] == list(range(4001))


def test_code_list_matches_rows(spark):
    rng = random.Random(3)
    names = ("a", "b", "c")
    cases = [tuple(rng.choice([0, 1, 2, 33, 10**9]) for _ in names) + (rng.choice([-4, 0, 8, 10**9 + 7]),) for _ in range(60)]
    cases.append((None, None, None, 8))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a bigint, b bigint, c bigint, t bigint")
    split = apportion_codes([(n, F.col(n)) for n in names], F.col("t"))
    for r in df.select("*", split.alias("s")).collect():
        got = {e["code"]: e["scaled"] for e in r["s"]}
        assert [e["code"] for e in r["s"]] == list(names)
        assert got == shares({n: r[n] for n in names}, r["t"], "even")


def test_topk_with_other(spark):
    rows = [("g", c, n) for c, n in [("d", 5), ("b", 9), ("a", 5), ("c", 5), ("e", 0)]] + [("h", "z", 1)]
    df = spark.createDataFrame(rows, "g string, country string, count bigint")
    totals = spark.createDataFrame([("g", 30), ("h", 1), ("i", -2)], "g string, total bigint")
    top, groups = topk_with_other(df, ["g"], "country", "count", 2, totals)
    assert sorted((r["g"], r["rank"], r["country"]) for r in top.collect()) == [("g", 1, "b"), ("g", 2, "a"), ("h", 1, "z")]
    assert sorted((r["g"], r["total"], r["non_top"]) for r in groups.collect()) == [("g", 30, 16), ("h", 1, 0), ("i", 0, 0)]
    listed = with_other_row(top, groups, "country", "count", "Rest").collect()
    assert sorted(tuple(r) for r in listed) == [("g", "Rest", 16), ("g", "a", 5), ("g", "b", 9), ("h", "z", 1)]
