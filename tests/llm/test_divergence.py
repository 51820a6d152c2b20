"""Source divergence: kept terms, shares and ranks against plain Python."""

import random
import re
from collections import Counter, defaultdict

from statmart.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_kept(docs, least):
    seen = defaultdict(Counter)
    for text, lang, _ in docs:
        seen[lang or ""].update(set(terms(text)))
    return {lang: {t for t, n in c.items() if n >= least} for lang, c in seen.items()}


def plain(docs, least=3, top=200):
    kept = plain_kept(docs, least)
    counts, langs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        words = [t for t in terms(text) if t in kept[lang or ""]]
        counts[lang or "", source or ""].update(words)
        langs[lang or ""].update(words)

    def p(counter, term, lang):
        return 1 + 10**9 * (counter[term] + 1) // (counter.total() + len(kept[lang]))

    def f(a, b):
        return (a - b) ** 2 // b

    out = []
    for lang, source in counts:
        own = counts[lang, source]
        pairs = [(other, sum(f(p(own, t, lang), p(counts[lang, other], t, lang)) for t in kept[lang]))
                 for other_lang, other in counts if other_lang == lang and other != source]
        telling = [(t, f(p(own, t, lang), p(langs[lang], t, lang))) for t in own if p(own, t, lang) > p(langs[lang], t, lang)]
        for part, items, limit in (("pair", pairs, None), ("term", telling, top)):
            items.sort(key=lambda i: (-i[1], i[0].encode()))
            out += [(lang, source, part, item, value, rank) for rank, (item, value) in enumerate(items[:limit], 1)]
    return sorted(out)


SCHEMA = "text string, lang string, source string, term string, item int, p int"


def run(spark, docs, partitions=5, **options):
    df = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], SCHEMA).repartition(partitions)
    return sorted(tuple(r) for r in divergence.divergence(df, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def documents(chance, n):
    stems = ["a", "ab", "abc", "abcd", "abcde", "abcdefgh", "abcdefghi", "abcdefghijklmnopq", "Straße", "straßen", "über", "日本語", "日本", "ABCD", "x" * 40]
    words = stems + [s + e for s in stems for e in ("s", "é", "er")]
    def text():
        return "".join(chance.choice(words) + chance.choice([" ", "-", "1", "\n", "_", ", "]) for _ in range(chance.randint(0, 30)))
    return [(text(), chance.choice(["en", "de", None]), chance.choice(["s1", "s2", "s3", "", None, "é"])) for _ in range(n)]


def test_against_plain_python(spark):
    docs = documents(random.Random(5), 120)
    docs += docs[:7]  # repeated rows
    docs += [(None, "en", "s9"), ("", None, None), ("123 ++", "fr", "only numbers"), ("once", "es", "a"), ("twice twice", "es", "b")]
    want = plain(docs)
    assert run(spark, docs) == want
    # Blocks of a few texts and prefixes of one byte give the same.
    assert run(spark, docs, block_bytes=60, first_bytes=1) == want
    assert ("es", "a", "pair", "b", 0, 1) in want and not [r for r in want if r[0] == "fr"]


def test_ranks_end_at_the_limit_and_ties_follow_bytes(spark):
    docs = [(" ".join(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)) + " é z", "en", "s")] * 3 + [("other words", "en", "t")] * 4
    want = plain(docs, top=10)
    assert run(spark, docs, top_terms=10) == want
    assert [r[3] for r in want if r[1] == "s" and r[2] == "term"] == sorted((r[3] for r in want if r[1] == "s" and r[2] == "term"), key=str.encode)


def test_prefixes_count_distinct_documents(spark):
    """A prefix that many terms of two documents share is in two documents."""
    docs = [(" ".join("abcdef" + c for c in "efghijk"), "en", "s")] * 2 + [("abcdefz", "en", "s")]
    df = spark.createDataFrame(docs, "text string, lang string, source string")
    for partitions in (1, 3):
        blocks = divergence.term_blocks(df.repartition(partitions))
        kept = {r["term"].decode() for r in divergence.kept_terms(blocks.cache()).collect()}
        assert kept == set()
    assert {r["term"].decode() for r in divergence.kept_terms(blocks, least_docs=2).collect()} == {"abcdef" + c for c in "efghijk"}
    sums = {r["term"].decode(): list(r["docs"]) for r in divergence.term_blocks(df.coalesce(1)).collect()}
    assert sums["abcdefe"] == [2, 2] and sums["abcdeff"] == [0, 2] and sums["abcdefz"] == [1, 1]


def test_very_long_texts_and_terms(spark):
    long_term = "é" * 300_000
    docs = [(long_term + " a", "en", "s"), (long_term + " b " + "w " * 400_000, "en", "t"), (long_term, "en", "s"), (long_term + "x", "en", "s")]
    docs += [("z", "en", "t")] * 3
    got = run(spark, docs)
    assert got == plain(docs)
    assert {r[3] for r in got if r[1:3] == ("s", "term")} == {long_term}


def test_empty_table(spark):
    assert run(spark, []) == []
