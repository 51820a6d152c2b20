"""Language ID, quality rules and the quality classifier."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from statmart.llm import language_id, quality_model, quality_rules
from statmart.llm.common import STATISTICS, WORD, held_out, word_statistics

SF = "/root/testdata/sf0.01"
#: Higher than the default, as the small table has few labels.
RISK = 0.05
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score int, row int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "k", 1, 2) for i, t, lang in rows], DOCS)


def slow_statistics(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    covered = {j for i, g in enumerate(grams) if counts[g] > 1 for j in (i, i + 1, i + 2)}
    return (
        len(words), sum(len(w) for w in words), sum(c in "#*$%&|<>" for c in text or ""),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(covered),
    )


@pytest.mark.parametrize("text", [
    None, "", "  \n ", "a", "a b c a b c", "x x x x x", "a b\na b\n\na b", "one # two ** <three>\tfour\x0bfive", "é ü\xa0z",
    "a b c d a b c e f a b", "line\r\nline\r\nline",
])
def test_word_statistics(text):
    assert word_statistics(text)[:5] == slow_statistics(text)


def test_held_out_is_the_crc_of_the_id(spark):
    rows = spark.range(50).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


@pytest.mark.parametrize("k, n, p", [(0, 10, 0.1), (3, 50, 0.02), (10, 400, 0.02), (399, 400, 0.5), (5, 5, 0.3), (40, 9000, 0.01)])
def test_binomial_tail(k, n, p):
    exact = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
                for i in range(k + 1))
    assert quality_rules.binomial_tail(k, n, p) == pytest.approx(min(1.0, exact), rel=1e-8)


def test_strictest_level():
    free = quality_rules.N_LEVELS + 1
    # 1,000 good documents that no level rejects; level 3 catches all that can be caught.
    assert quality_rules._strictest(1000, [(3, 0, 40), (free, 1000, 5)], 0.02, 0.01) == (3, 0, 40)
    # Level 2 would reject a tenth of the good ones: testing stops before it.
    assert quality_rules._strictest(1000, [(1, 0, 4), (2, 100, 40), (free, 900, 0)], 0.02, 0.01) == (1, 0, 4)
    # Too few to tell.
    assert quality_rules._strictest(20, [(1, 0, 4), (free, 20, 0)], 0.02, 0.01) == (0, 0, 0)


def test_quality_rules_against_plain_python(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    counted = quality_rules.with_statistics(table).select("row.doc_id", quality_rules.stratum_key(F.col("row.lang")).alias("stratum"), *STATISTICS)
    levels = quality_rules.fit_levels(counted, spark.read.parquet(f"{SF}/labels.parquet"), risk=RISK)
    rows = quality_rules.judge(counted, levels).collect()
    registered = {r["doc_id"]: r for r in quality_rules.op6_quality_rules(spark, SF).collect()}
    assert all(registered[r["doc_id"]]["strictness"] == r["strictness"] for r in rows) and len(registered) == len(rows)
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == len(docs)

    def level_of(text):
        n, chars, symbols, dup, repeat, lines, bangs, upper, _ = word_statistics(text)
        w = max(1, n)
        signal = {"symbols_per_word": symbols / w, "exclaims_per_word": bangs / w, "upper_share": upper / w, "dup_line_share": dup / max(1, lines),
                  "repeat_share": repeat / w, "long_words": chars / w, "short_words": -chars / w}
        for level in range(quality_rules.N_LEVELS):
            if any(signal[name] > cutoffs[level] for name, cutoffs in quality_rules.LEVELS.items()):
                return level + 1
        return quality_rules.N_LEVELS + 1

    base = {d: (s := slow_statistics(r["text"]))[0] < 50 or 100 * s[4] > 50 * s[0] for d, r in docs.items()}
    level = {d: level_of(r["text"]) for d, r in docs.items()}
    strata = {docs[d]["lang"] for d in labels if d in docs and not base[d]}
    certified = {}
    for s in strata:
        own = [d for d in labels if d in docs and not base[d] and docs[d]["lang"] == s]
        hits = [(level[d], int(labels[d] == 1), int(labels[d] != 1)) for d in own]
        certified[s] = quality_rules._strictest(
            sum(h[1] for h in hits), hits, RISK, quality_rules.CONFIDENCE / len(strata))[0]
    assert max(certified.values()) > 0
    for r in rows:
        d = r["doc_id"]
        assert tuple(r[c] for c in STATISTICS[:5]) == slow_statistics(docs[d]["text"])
        assert r["base_failed"] == base[d] and r["strictness"] == level[d]
        assert r["kept"] == (not base[d] and level[d] > certified.get(docs[d]["lang"], 0))


def test_quality_rules_edges(spark):
    good = " ".join(f"word{i}" for i in range(60))
    docs = docs_of(spark, [(1, None, None), (2, "", "en"), (None, good, "en"), (3, good, None), (3, good, None), (4, good + " ###" * 60, "xx")])
    labels = spark.createDataFrame([(3, 1, 0), (3, None, 0), (None, 1, 1), (4, 0, 0)], "doc_id long, quality int, toxic int")
    kept = quality_rules.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 3, 3, 4]
    assert quality_rules.keep_good(docs.limit(0), labels.limit(0)).count() == 0


def test_language_id_accuracy_and_brute_force(spark):
    rows = {r["doc_id"]: r for r in language_id.op2_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    unseen = [r for r in docs if rows[r["doc_id"]]["held_out"] and len(r["text"]) > 40]
    assert sum(rows[r["doc_id"]]["lang_pred"] == r["lang"] for r in unseen) >= 0.98 * len(unseen) > 100
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    model = language_id.trained_on(spark.read.parquet(f"{SF}/documents.parquet"))
    for r in docs[:60]:
        vector = language_id.unit_vectors(language_id.ngram_counts([r["text"]]), model["idf"])[0]
        cosines = [float(vector @ c) for c in model["centroids"]]
        got = rows[r["doc_id"]]
        assert got["score"] == pytest.approx(max(cosines), abs=1e-5)
        assert got["lang_pred"] == model["languages"][int(np.argmax(cosines))]


def test_ngrams_do_not_depend_on_blocks(monkeypatch):
    texts = ["Hello, wörld 12 again", None, "", "ab" * 300, "x"]
    whole = language_id.ngram_counts(texts)
    assert all((language_id.ngram_counts([t]) == row).all() for t, row in zip(texts, whole))
    monkeypatch.setattr(language_id, "BLOCK", 7)
    assert (language_id.ngram_counts(texts) == whole).all()
    assert whole[0].sum() == sum(
        1 for n in (1, 2, 3) for i in range(len(texts[0]) + 3 - n) if any(c.isalpha() for c in f" {texts[0]} "[i:i + n]))


def test_language_id_edges(spark):
    english, german = "the cat and the dog of this house " * 3, "der hund und die katze in das haus " * 3
    docs = docs_of(spark, [(i, english if i % 2 else german, "en" if i % 2 else "de") for i in range(40)]
                   + [(100, None, "en"), (101, "", None), (102, "123 !?", "en"), (None, english, None), (103, "Привет как дела друзья мои " * 20, None)])
    model = language_id.trained_on(docs)
    found = {r["doc_id"]: r for r in language_id.predict(docs, model).select("row.doc_id", "row.score", "lang_pred", "score", "rejected").toDF(
        "doc_id", "clash", "lang_pred", "score", "rejected").collect()}
    assert [found[i]["lang_pred"] for i in (1, 2, None)] == ["en", "de", "en"]
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 and found[i]["rejected"] for i in (100, 101, 102))
    assert found[103]["rejected"] and not found[1]["rejected"]
    kept = language_id.keep_known(docs)
    assert kept.columns == docs.columns and kept.count() == 41
    assert language_id.keep_known(docs.limit(0)).count() == 0
    untrained = language_id.predict(docs, language_id.trained_on(docs.where("false")))
    assert {r["lang_pred"] for r in untrained.collect()} == {"und"}


def test_machine_equals_all_pairs():
    chance = np.random.default_rng(0)
    x, w, v = chance.random((5, 7)), chance.random(7), chance.random((7, 3))
    raw, _ = quality_model.machine(x, 0.3, w, v)
    for row, value in zip(x, raw):
        pairs = sum(v[i] @ v[j] * row[i] * row[j] for i in range(7) for j in range(i))
        assert value == pytest.approx(0.3 + row @ w + pairs)


def test_quality_classifier_accuracy(spark):
    rows = {r["doc_id"]: r for r in quality_model.op9_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    unseen = [(r["quality"], rows[r["doc_id"]]["predicted"]) for r in labels if rows[r["doc_id"]]["held_out"]]
    assert sum(a == b for a, b in unseen) >= 0.95 * len(unseen) > 50
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())


def test_quality_classifier_edges(spark):
    docs = docs_of(spark, [(1, None, None), (2, "", "en"), (None, "some text here", None), (3, "x" * 5000, "en"), (3, "x" * 5000, "en")])
    none = spark.createDataFrame([], "doc_id long, quality int")
    unlabelled = quality_model.score(docs, quality_model.fit(docs, none)).collect()
    assert len(unlabelled) == 5 and {r["score"] for r in unlabelled} == {0.5}
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, 0), (None, 1), (2, None)], "doc_id long, quality int")
    model = quality_model.fit(docs, labels)
    scored = quality_model.score(docs, model).select("row.doc_id", "row.inputs.text", "score").collect()
    assert scored[0]["score"] == scored[1]["score"] and scored[3]["score"] == scored[4]["score"]
    assert quality_model.score(docs.limit(0), model).count() == 0
