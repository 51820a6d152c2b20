"""Language identification by nearest centroid (operator 2).

A text becomes the normalised TF-IDF vector of its hashed letter 1- to
3-grams. Document frequencies cover every training row. Per language, several
centroids are fitted by spherical k-means on a sample of at most about
``fit_rows`` training texts (chosen by hash, so a bound on the expected size).
A text gets the language of the centroid with the greatest cosine; the score
is that cosine.

Rejection is by distance: each centroid knows the largest cosine distance of
the fit rows it was given. A text is rejected if its similarity is less than
``slack`` times the least similarity the centroid accepted in training, or if
it has no letter. Few letters give few grams and so lie far from everything:
below ``full_letters`` letters the bound shrinks in proportion.

Defined results: null, empty and letterless texts are ``und`` with score 0,
and rejected; ties between centroids go to the smaller language name, then the
smaller cluster number; repeated rows are predicted each by itself; without a
single training row every text is ``und`` and rejected; an empty table gives
no rows. Texts are read whole, in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.llm.common import CHUNK, held_out, map_column, sampled, table

BUCKETS = 4096
FIT_ROWS = 600
CLUSTERS = 4
SLACK = 0.5
FULL_LETTERS = 200
UNKNOWN = "und"
#: Code points worked on at a time.
BLOCK = 1 << 18


_TABLES: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Which code points are letters; made once per task."""
    if "letters" not in _TABLES:
        _TABLES["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _TABLES["letters"]


def ngram_counts(texts: list[str | None], buckets: int = BUCKETS) -> np.ndarray:
    """Counts of hashed letter 1- to 3-grams, a row per text; other characters count as one blank."""
    lowered = [" " + (t or "").lower() + " " for t in texts]
    lengths = np.array([len(t) for t in lowered])
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), lengths)
    counts = np.zeros(len(texts) * buckets)
    letters = _letters()
    for start in range(0, len(points), BLOCK):
        block = points[start:start + BLOCK + 2]
        last = start + BLOCK >= len(points)
        is_letter = letters[block]
        chars = np.where(is_letter, block, 32).astype(np.uint32)
        base = owner[start:start + BLOCK + 2] * buckets
        hashed = np.zeros(len(chars), np.uint32)
        any_letter = np.zeros(len(chars), bool)
        for size in (1, 2, 3):
            n = len(chars) - size + 1
            if n <= 0:
                break
            # A gram that starts in this block belongs to it, even if it ends in the next.
            keep = n if last else min(n, BLOCK)
            hashed = hashed[:n] * np.uint32(0x01000193) ^ (chars[size - 1:] * np.uint32(0x9E3779B1))
            any_letter = any_letter[:n] | is_letter[size - 1:]
            mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(size)
            at = base[:n] + (mixed >> np.uint32(8)) % buckets
            # No gram reaches into the next text.
            chosen = any_letter[:keep] & (base[:keep] == base[size - 1:size - 1 + keep])
            counts += np.bincount(at[:keep][chosen], minlength=len(counts))
    return counts.reshape(len(texts), buckets).astype(np.float32)


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length 1; a row without grams stays zero."""
    rows = np.log1p(counts) * idf
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms > 0, norms, 1)


def document_frequencies(texts: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, dict[str, int]]:
    """How many texts have each bucket, and how many there are of each language.

    Every task counts its own rows, so one row per bucket and task is shuffled;
    the driver gets one per bucket and language.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        languages: dict[str, int] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                rows = batch.slice(start, CHUNK)
                total += (ngram_counts(rows.column(1).to_pylist(), buckets) > 0).sum(axis=0)
                for name in rows.column(0).to_pylist():
                    languages[name] = languages.get(name, 0) + 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array([*at.tolist(), *[None] * len(languages)], pa.int32()),
            "lang": pa.array([*[None] * len(at), *languages], pa.string()),
            "n": pa.array([*total[at].tolist(), *languages.values()], pa.int64()),
        })

    sums = texts.mapInArrow(count, "bucket int, lang string, n long").groupBy("bucket", "lang").agg(F.sum("n").alias("n"))
    frequencies, languages = np.zeros(buckets), {}
    for row in sums.collect():
        if row["bucket"] is not None:
            frequencies[row["bucket"]] = row["n"]
        else:
            languages[row["lang"]] = row["n"]
    return frequencies, languages


def spherical_means(vectors: np.ndarray, clusters: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length 1 and the least similarity of a member to each.

    Starts from members spread evenly by their similarity to the mean; no chance.
    """
    by_mean = np.argsort(vectors @ vectors.mean(axis=0), kind="stable")
    clusters = min(clusters, len(vectors))
    chosen = by_mean[(2 * np.arange(clusters) + 1) * len(vectors) // (2 * clusters)]
    centroids = vectors[chosen]
    for _ in range(rounds):
        member = (vectors @ centroids.T).argmax(axis=1)
        sums = np.stack([vectors[member == k].sum(axis=0) for k in range(len(centroids))])
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centroids)
    similar = vectors @ centroids.T
    member = similar.argmax(axis=1)
    own = similar[np.arange(len(vectors)), member]
    used = np.unique(member)
    return centroids[used], np.array([own[member == k].min() for k in used])


def fit(training: DataFrame, fit_rows: int = FIT_ROWS, clusters: int = CLUSTERS, buckets: int = BUCKETS) -> dict:
    """A model of rows with doc_id, lang (not null) and text."""
    frequencies, languages = document_frequencies(training.select("lang", "text"), buckets)
    n = sum(languages.values())
    idf = (np.log((1 + n) / (1 + frequencies)) + 1).astype(np.float32)

    def centroids(pdf: pd.DataFrame) -> pd.DataFrame:
        # Rows arrive in any order; the same model has to come out.
        pdf = pdf.sort_values(["doc_id", "text"], kind="stable")
        parts = [unit_vectors(ngram_counts(list(pdf["text"][i:i + CHUNK]), buckets), idf) for i in range(0, len(pdf), CHUNK)]
        vectors = np.concatenate(parts)
        vectors = vectors[vectors.any(axis=1)]
        if not len(vectors):
            return pd.DataFrame({"lang": [], "centroid": [], "least": []})
        found, least = spherical_means(vectors, clusters)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": list(found.astype(np.float32)), "least": least.astype(float)})

    picked = F.lit(False)
    for name, rows in languages.items():
        picked = picked | ((F.col("lang") == name) & sampled(F.col("doc_id"), min(1.0, fit_rows / rows)))
    sample = training.where(picked).select("doc_id", "lang", "text")
    # One group per language, of the bounded sample.
    rows = sample.groupBy("lang").applyInPandas(centroids, "lang string, centroid array<float>, least double").collect()
    rows.sort(key=lambda r: r["lang"])
    return {
        "idf": idf,
        "languages": [r["lang"] for r in rows],
        "centroids": np.array([r["centroid"] for r in rows], np.float32).reshape(len(rows), buckets),
        "least": np.array([r["least"] for r in rows]),
    }


PREDICTION = T.StructType([
    T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType()),
])


def predict(docs: DataFrame, model: dict, text: str = "text", slack: float = SLACK,
            full_letters: int = FULL_LETTERS) -> DataFrame:
    """Rows packed as ``row`` with lang_pred, score and rejected."""
    def make():
        languages = np.array([*model["languages"], UNKNOWN], object)

        def run(texts: list[str | None]):
            counts = ngram_counts(texts, len(model["idf"]))
            vectors = unit_vectors(counts, model["idf"])
            if not len(model["least"]):
                return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            similar = vectors @ model["centroids"].T
            best = similar.argmax(axis=1)
            score = np.clip(similar[np.arange(len(texts)), best], 0, 1).astype(float)
            has_letters = vectors.any(axis=1)
            # Each letter starts up to three grams.
            part = np.minimum(1, counts.sum(axis=1) / (3 * full_letters))
            rejected = ~has_letters | (score < slack * part * model["least"][best])
            return languages[np.where(has_letters, best, -1)].tolist(), score.tolist(), rejected.tolist()

        return run

    return map_column(docs, text, PREDICTION, make)


def trained_on(docs: DataFrame) -> dict:
    """The model of the training folds of documents."""
    return fit(docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text"))


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    return predict(docs, trained_on(docs)).where(~F.col("rejected")).select("row.*")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = trained_on(docs)
    return predict(docs.select("doc_id", "text"), model).select(
        "row.doc_id", held_out("row.doc_id").alias("held_out"), "lang_pred", "score", "rejected"
    )
