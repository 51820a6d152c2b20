"""Source divergence audit over an iceberg of terms (operator 11).

How far does the wording of a source lie from that of the other sources of its
language? Terms are runs of letters; a language keeps the terms that occur in
at least ``LEAST_DOCS`` of its documents. Of these, with add-one smoothing, a
source has shares p, another source or the whole language has shares q, and a
term contributes floor((p - q)^2 / q). All of it is integer arithmetic.

Which terms are kept is found by iceberg prefix refinement:

1. One pass over the texts writes, per block of documents, the distinct terms
   of a language with the occurrences per source and with the number of
   documents that count for a prefix of each length. A document counts for a
   prefix with the first of its sorted terms that begins with it - the one that
   shares less than the prefix with the term before it - so the sums over all
   terms of a prefix are distinct documents, and blocks simply add up.
2. Prefixes of 6 bytes are counted and those in too few documents discarded;
   terms that go on below a prefix that is left are counted by 12 bytes, then by
   24, and so on. A prefix that holds a whole term decides it. Levels end when no longer prefix is left,
   so their number grows with the logarithm of the longest kept term. The long
   tail of rare terms is never shuffled: it ends with its rare prefixes.
3. Only kept terms are counted by source.

Sums over all kept terms touch only the terms a source has: a pair's value is
that of two empty sources, plus what each source's own terms change (from a
histogram of its shares), plus a correction for terms both have.

Defined results: null text, lang or source is an empty one; every row is a
document, repeated rows too; a language without kept terms gives pairs of value
0 and no terms; a source alone in its language has no pairs; ties go to the
item that comes first in UTF-8; terms of any length count whole; an empty table
gives no rows; columns other than the three named do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from statmart.functions import div, wide
from statmart.llm.common import table
from statmart.operators.dedupe import top_per_key
from statmart.session import materialized

LEAST_DOCS = 3
SCALE = 1_000_000_000
TOP_TERMS = 200
#: Bytes of the prefixes of the first level; every level doubles them.
FIRST_BYTES = 6
#: Bytes of the texts of a block; bounds a task's memory.
BLOCK_BYTES = 10 << 20

#: Bytes that part terms become 0, A to Z become lower case, all others stay.
LETTERS = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)

BLOCK = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("term", T.BinaryType()), T.StructField("n_bytes", T.IntegerType()),
    T.StructField("docs", T.ArrayType(T.LongType())),
    T.StructField("used", T.ArrayType(T.StructType([T.StructField("source", T.StringType()), T.StructField("n", T.LongType())]))),
])


def letters_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts one after the other, and how many each text has."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    size = int(offsets[-1] - offsets[0])
    whole = texts.buffers()[2]
    letters = LETTERS[np.frombuffer(whole, np.uint8)[offsets[0]:offsets[-1]]] if size else np.zeros(0, np.uint8)
    begins = offsets[:-1][np.diff(offsets) > 0] - offsets[0]
    inside = letters > 0
    # Whether the byte before, or behind, belongs to the same term.
    joined = inside.copy()
    joined[1:] &= inside[:-1]
    joined[begins] = False
    starts = np.flatnonzero(inside & ~joined)
    joined[:-1] = joined[1:]
    joined[-1:] = False
    lengths = np.flatnonzero(inside & ~joined) + 1 - starts
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=places[1:])
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(letters[inside])])
    return terms, np.diff(np.searchsorted(starts, offsets - offsets[0]))


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """Runs of so many values as lists."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), values)


def block_rows(terms: pa.Array, n_terms: np.ndarray, langs: list[str], sources: list[str], first_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of a block: its documents' terms one after the other, and each document's number of terms, lang and source."""
    encoded = terms.dictionary_encode()
    order = pc.sort_indices(encoded.dictionary)
    ordered = encoded.dictionary.take(order)
    n = len(ordered)
    place = np.empty(n, np.int64)
    place[order.to_numpy()] = np.arange(n)
    names, lang_of = np.unique(np.array(langs, object), return_inverse=True)
    source_names, source_of = np.unique(np.array(sources, object), return_inverse=True)

    # Every term of every document once, sorted.
    pairs = np.repeat(np.arange(len(langs)) * n, n_terms)
    pairs += place[encoded.indices.to_numpy()]
    del encoded, terms
    pairs, used = np.unique(pairs, return_counts=True)
    doc, term = np.divmod(pairs, max(n, 1))
    # By how many levels a term's document counts already with the term before.
    level = np.zeros(len(pairs), np.int64)
    length = first_bytes
    while True:
        prefix = pc.binary_slice(ordered, 0, length)
        same_prefix = pc.equal(prefix[1:], prefix[:-1]).to_numpy(zero_copy_only=False) if n else np.zeros(0, bool)
        number = np.append(0, np.cumsum(~same_prefix))
        shared = (doc[1:] == doc[:-1]) & (number[term[1:]] == number[term[:-1]])
        if not shared.any():
            break
        level[1:] += shared
        length *= 2
    of_lang = lang_of[doc] * n + term
    rows, row = np.unique(of_lang, return_inverse=True)
    n_levels = int(level.max(initial=0)) + 1
    docs = np.bincount(row * n_levels + level, minlength=len(rows) * n_levels).reshape(len(rows), n_levels).cumsum(axis=1)
    cells, cell = np.unique(row * len(source_names) + source_of[doc], return_inverse=True)
    totals = np.bincount(cell, weights=used, minlength=len(cells)).astype(np.int64)
    per_row = np.bincount(cells // max(1, len(source_names)), minlength=len(rows))
    row_lang, row_term = np.divmod(rows, max(n, 1))
    texts = ordered.take(pa.array(row_term))
    uses = pa.StructArray.from_arrays(
        [pa.array(source_names, pa.string()).take(pa.array(cells % max(1, len(source_names)))), pa.array(totals)], names=["source", "n"]
    )
    whole = pa.RecordBatch.from_arrays([
        pa.array(names, pa.string()).take(pa.array(row_lang)), texts.cast(pa.binary()), pc.binary_length(texts).cast(pa.int32()),
        _lists(pa.array(docs.ravel()), np.full(len(rows), n_levels)), _lists(uses, per_row),
    ], schema=to_arrow_schema(BLOCK))
    for start in range(0, len(rows), 20_000):
        yield whole.slice(start, 20_000)


def term_blocks(docs: DataFrame, first_bytes: int = FIRST_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per block of documents its terms by language; ``docs`` holds text, lang and source.

    ``docs[i]`` counts the documents of the block for the term's prefix of
    ``first_bytes`` * 2^i bytes, the last entry for all longer ones too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            texts = batch.column(0).cast(pa.large_binary())
            langs, sources = (batch.column(i).to_pylist() for i in (1, 2))
            # Cut so that no part is much larger than a block; a longer text is a part of its own.
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            start = 0
            while start < len(texts):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + block_bytes, "right")))
                terms, n_terms = letters_of(texts.slice(start, stop - start))
                held.append((terms, n_terms, langs[start:stop], sources[start:stop]))
                size += int(ends[stop - 1] - before)
                start = stop
                if size >= block_bytes:
                    yield from flushed(held)
                    held, size = [], 0
        if held:
            yield from flushed(held)

    def flushed(held: list) -> Iterator[pa.RecordBatch]:
        terms, n_terms, langs, sources = zip(*held)
        return block_rows(pa.concat_arrays(terms), np.concatenate(n_terms), sum(langs, []), sum(sources, []), first_bytes)

    return docs.select("text", "lang", "source").mapInArrow(run, BLOCK)


def kept_terms(blocks: DataFrame, least_docs: int = LEAST_DOCS, first_bytes: int = FIRST_BYTES) -> DataFrame:
    """lang and term of the terms in at least ``least_docs`` documents of their language."""
    found, length, level = [], first_bytes, 0
    left = blocks
    while True:
        counts = F.get("docs", F.least(F.lit(level), F.size("docs") - 1))
        prefixes = materialized(
            left.groupBy("lang", F.substring("term", 1, length).alias("prefix")).agg(F.sum(counts).alias("n_docs"))
            .where(F.col("n_docs") >= least_docs).select("lang", "prefix", (F.length("prefix") < length).alias("is_term"))
        )
        found.append(prefixes.where("is_term").select("lang", F.col("prefix").alias("term")))
        # Terms of just as many bytes end at the next level.
        open_ends = prefixes.where("not is_term")
        if open_ends.isEmpty():
            return reduce(DataFrame.unionByName, found)
        on = [blocks["lang"] == open_ends["lang"], F.substring(blocks["term"], 1, length) == open_ends["prefix"]]
        left = blocks.where(F.col("n_bytes") >= length).join(open_ends, on, "left_semi")
        length, level = length * 2, level + 1


def share(n: Column, total: Column, n_terms: Column, scale: int = SCALE) -> Column:
    """1 + floor(scale * (n + 1) / (total + n_terms)); null without kept terms."""
    return (div((wide(n) + 1) * F.lit(scale), wide(total) + wide(n_terms)) + 1).cast("bigint")


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares lie between 1 and ``SCALE`` + 1, so the square fits 64 bits."""
    return F.call_function("div", (p - q) * (p - q), q)


def exact_sum(value: Column) -> Column:
    """A sum of 64-bit numbers that cannot overflow: halves are added up apart."""
    high = F.shiftright(value, 32)
    low = value - F.shiftleft(high, 32)
    return (wide(F.sum(high)) * F.lit(1 << 32) + wide(F.sum(low))).cast("decimal(38,0)")


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, first_bytes: int = FIRST_BYTES,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """lang, source, part, item, value and rank: all other sources (``pair``) and the source's most telling terms (``term``)."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    blocks = materialized(term_blocks(rows, first_bytes, block_bytes))
    # Terms and groups go by numbers from here on; texts come back at the end.
    kept = materialized(kept_terms(blocks, least_docs, first_bytes).withColumn("term_id", F.monotonically_increasing_id()))
    named = materialized(rows.select("lang", "source").distinct().withColumn("group", F.monotonically_increasing_id()))
    used = blocks.select("lang", "term", "used").join(kept, ["lang", "term"]).select("lang", "term", "term_id", F.inline("used"))
    # Grouped by the text as well, which the rows are already dealt by.
    counts = materialized(
        used.join(named, ["lang", "source"]).groupBy("lang", "term", "term_id", "group").agg(F.sum("n").alias("n")).select("term_id", "group", "n")
    )

    # One row per group, and what its absent terms are worth.
    totals = named.join(counts.groupBy("group").agg(F.sum("n").alias("total")), "group", "left")
    per_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    groups = materialized(
        totals.join(per_lang, "lang").join(sizes, "lang", "left")
        .select("group", "lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total", "n_terms", "lang_total")])
        .withColumn("absent", share(F.lit(0), F.col("total"), F.col("n_terms")))
    )
    shares = materialized(
        counts.join(groups.select("group", "total", "n_terms", "absent"), "group")
        .select("term_id", "group", share(F.col("n"), F.col("total"), F.col("n_terms")).alias("p"), "absent")
    )
    return _pairs(groups, shares).unionByName(_terms(groups, kept, counts, shares, top_terms))


def _other(df: DataFrame, *same: str) -> DataFrame:
    """The same rows as the other side of a pair."""
    return df.select(*same, *[F.col(c).alias(f"other_{c}") for c in df.columns if c not in same])


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Every other source of the language with the sum of all gaps."""
    slim = groups.select("group", "lang", "absent")
    p0, q0 = F.col("absent"), F.col("other_absent")
    # No term at all, as if both were empty.
    empty = groups.select("group", "lang", "n_terms", "absent").join(_other(slim, "lang"), "lang").where("group <> other_group").select(
        "group", "other_group", F.coalesce(wide("n_terms") * wide(gap(p0, q0)), wide(F.lit(0))).cast("decimal(38,0)").alias("value")
    )
    # What the terms of one side change; shares repeat, so there are few distinct ones in a source.
    levels = materialized(shares.groupBy("group", "absent", "p").agg(F.count(F.lit(1)).alias("n")))
    alone = levels.join(groups.select("group", "lang"), "group").join(_other(slim, "lang"), "lang").where("group <> other_group")
    n, p = F.col("n"), F.col("p")
    changes = alone.select(F.inline(F.array(
        F.struct("group", "other_group", (wide(n) * wide(gap(p, q0) - gap(p0, q0))).cast("decimal(38,0)").alias("value")),
        F.struct(F.col("other_group").alias("group"), F.col("group").alias("other_group"),
                 (wide(n) * wide(gap(q0, p) - gap(q0, p0))).cast("decimal(38,0)").alias("value")),
    )))
    # What terms of both sides change beyond that: both directions from one meeting of the two.
    q = F.col("other_p")
    met = shares.join(_other(shares, "term_id"), "term_id").where("group < other_group")
    both = met.groupBy("group", "other_group").agg(
        exact_sum(gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0)).alias("there"),
        exact_sum(gap(q, p) - gap(q, p0) - gap(q0, p) + gap(q0, p0)).alias("back"),
    ).select(F.inline(F.array(
        F.struct("group", "other_group", F.col("there").alias("value")),
        F.struct(F.col("other_group").alias("group"), F.col("group").alias("other_group"), F.col("back").alias("value")),
    )))
    summed = reduce(DataFrame.unionByName, [empty, changes, both]).groupBy("group", "other_group").agg(
        F.sum("value").cast("bigint").alias("value")
    )
    names = groups.select("group", "lang", "source")
    told = summed.join(names, "group").join(_other(names), "other_group")
    # All ranks: as many rows as the language has other sources.
    ranked = top_per_key(told, ["lang", "source"], [F.desc("value"), F.col("other_source")], 1 << 30, rank_as="rank")
    return ranked.select("lang", "source", F.lit("pair").alias("part"), F.col("other_source").alias("item"), "value", "rank")


def _terms(groups: DataFrame, kept: DataFrame, counts: DataFrame, shares: DataFrame, top_terms: int) -> DataFrame:
    """The terms a source uses more than its language does, with the greatest gaps."""
    langs = groups.groupBy("lang").agg(F.max("lang_total").alias("lang_total"), F.max("n_terms").alias("n_terms"))
    usual = counts.groupBy("term_id").agg(F.sum("n").alias("n")).join(kept, "term_id").join(langs, "lang").select(
        "term_id", "term", share(F.col("n"), F.col("lang_total"), F.col("n_terms")).alias("q")
    )
    p, q = F.col("p"), F.col("q")
    telling = shares.join(usual, "term_id").where(p > q).select("group", F.col("term").cast("string").alias("item"), gap(p, q).alias("value"))
    ranked = top_per_key(telling, ["group"], [F.desc("value"), F.col("item")], top_terms, rank_as="rank")
    return ranked.join(groups.select("group", "lang", "source"), "group").select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank"
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source of ``documents`` lies from the others of its language, and in which terms."""
    return divergence(table(spark, sf_dir, "documents"))


DIVERGENCE_SQL = f"""
with docs as (
    select row_number() over () as nr, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents
),
found as (
    select nr, lang, source,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
    from docs
),
kept as (select lang, term from found group by lang, term having count(distinct nr) >= {LEAST_DOCS}),
sizes as (select lang, count(*) as v from kept group by lang),
counts as (
    select lang, source, term, cast(count(*) as hugeint) as n from found join kept using (lang, term) group by lang, source, term
),
groups as (
    select g.lang, g.source, coalesce(sum(c.n), 0) as total
    from (select distinct lang, source from docs) g left join counts c on c.lang = g.lang and c.source = g.source
    group by g.lang, g.source
),
shares as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
           cast(1 + {SCALE} * (coalesce(c.n, 0) + 1) // (g.total + s.v) as hugeint) as p
    from groups g join kept k on k.lang = g.lang join sizes s on s.lang = g.lang
         left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
),
usual as (
    select lang, term, cast(1 + {SCALE} * (n + 1) // (sum(n) over (partition by lang) + v) as hugeint) as q
    from (select lang, term, sum(n) as n from counts group by lang, term) join sizes using (lang)
),
gaps as (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
    from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by a.lang, a.source, b.source
),
pairs as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(g.value, 0) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
         left join gaps g on g.lang = a.lang and g.source = a.source and g.item = b.source
),
terms as (
    select lang, source, 'term' as part, term as item, (p - q) * (p - q) // q as value
    from shares join usual using (lang, term) where n > 0 and p > q
),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
    from (select * from pairs union all select * from terms)
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
from ranked where part = 'pair' or rank <= {TOP_TERMS}
"""
