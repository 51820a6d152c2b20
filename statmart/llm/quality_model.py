"""Quality classifier: a factorisation machine (operator 9).

Inputs are the hashed words of the whole text (log counts, length 1),
structure statistics and the table's ``n_chars``. The score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

which is linear in the number of words. Weights are fitted by Adam on at most
about ``fit_rows`` labelled training rows, chosen by hash: a bounded sample,
turned into sparse rows first and fitted in one task.

Defined results: a null text scores as an empty one; a null n_chars counts as
0; labels that repeat with a difference count as the lower; null labels are not
used; without labelled rows every score is 0.5; repeated rows score alike; an
empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.llm.common import held_out, map_column, sampled, table, word_statistics
from statmart.session import materialized

BUCKETS = 4096
FACTORS = 8
FIT_ROWS = 6000
EPOCHS = 12
#: A small sample is gone through more often, until there are as many steps.
LEAST_STEPS = 600
THRESHOLD = 0.7
N_STRUCTURE = 13


def structure(text: str | None, n_chars: int | None) -> list[float]:
    """Ratios and log sizes of one text, and of its recorded length."""
    text = text or ""
    words, chars, symbols, dup, repeat, lines, bangs, upper, distinct = word_statistics(text)
    n = max(1, words)
    return [
        np.log1p(words), np.log1p(max(0, n_chars or 0)), chars / n, min(symbols / n, 3.0), dup / max(1, lines), repeat / n,
        np.log1p(lines), min(bangs / n, 3.0), upper / n, distinct / n,
        (text.count(",") + text.count(".")) / n, sum(map(text.count, "0123456789")) / max(1, len(text)), float(words < 50),
    ]


def word_counts(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the lower-case words, and the logs of their counts scaled to length 1."""
    counts: Counter = Counter()
    for word, n in Counter((text or "").lower().split()).items():
        counts[zlib.crc32(word.encode("utf-8", "surrogatepass")) % buckets] += n
    at = np.fromiter(counts.keys(), np.int64, len(counts))
    values = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    norm = np.sqrt((values ** 2).sum())
    return at, (values / norm if norm else values).astype(np.float32)


def rows_of(texts: list[str | None], n_chars: list[int | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Word part and structure part of some texts, dense."""
    words = np.zeros((len(texts), buckets), np.float32)
    for i, text in enumerate(texts):
        at, values = word_counts(text, buckets)
        words[i, at] = values
    return words, np.array([structure(*x) for x in zip(texts, n_chars)], np.float32).reshape(len(texts), N_STRUCTURE)


def machine(x: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores and the factor sums."""
    sums = x @ v
    return w0 + x @ w + 0.5 * ((sums ** 2).sum(axis=1) - (x ** 2) @ (v ** 2).sum(axis=1)), sums


def fit_machine(x: np.ndarray, y: np.ndarray, factors: int = FACTORS, epochs: int = EPOCHS, batch: int = 128,
                rate: float = 0.01, decay: float = 1e-4) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the logistic loss; fixed seed, rows in hash order."""
    chance = np.random.default_rng(1)
    theta = np.zeros((x.shape[1], 1 + factors), np.float32)
    theta[:, 1:] = chance.normal(0, 0.01, (x.shape[1], factors))
    prior = np.clip(y.mean(), 0.01, 0.99)
    w0 = float(np.log(prior / (1 - prior)))
    first, second, steps = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(max(epochs, -(-LEAST_STEPS * batch // max(1, len(x))))):
        order = chance.permutation(len(x))
        for start in range(0, len(x), batch):
            part = order[start:start + batch]
            rows = x[part]
            raw, sums = machine(rows, w0, theta[:, 0], theta[:, 1:])
            error = ((1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y[part]) / len(part)).astype(np.float32)
            grad = np.empty_like(theta)
            grad[:, 0] = rows.T @ error
            grad[:, 1:] = rows.T @ (error[:, None] * sums) - theta[:, 1:] * ((rows ** 2).T @ error)[:, None]
            grad += decay * theta
            steps += 1
            first += 0.1 * (grad - first)
            second += 0.001 * (grad ** 2 - second)
            theta -= rate * (first / (1 - 0.9 ** steps)) / (np.sqrt(second / (1 - 0.999 ** steps)) + 1e-8)
            w0 -= rate * float(error.sum())
    return w0, theta[:, 0].copy(), theta[:, 1:].copy()


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, buckets: int = BUCKETS) -> dict | None:
    """A model of labelled documents (doc_id, text, n_chars; doc_id, quality); None without any."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    n = known.count()
    if not n:
        return None
    # Written, so that its size is known and Spark can send the small side.
    chosen = materialized(known.where(sampled(F.col("doc_id"), min(1.0, fit_rows / n))))
    sample = docs.where(~held_out()).join(chosen, "doc_id")
    sparse = T.StructType([
        T.StructField("at", T.ArrayType(T.LongType())), T.StructField("values", T.ArrayType(T.FloatType())),
    ])
    words = map_column(sample, "text", sparse, lambda: lambda texts: list(zip(*(word_counts(t, buckets) for t in texts))))
    parts = map_column(
        words.select(F.col("row.doc_id"), F.col("row.quality"), F.struct("row.text", "row.n_chars").alias("both"), "at", "values"),
        "both", T.StructType([T.StructField("structure", T.ArrayType(T.DoubleType()))]),
        lambda: lambda rows: [[structure(r["text"], r["n_chars"]) for r in rows]],
    )
    slim = parts.select("row.doc_id", "row.quality", "row.at", "row.values", "structure")

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        # Rows arrive in any order; the same model has to come out.
        pdf = pdf.assign(key=pdf["at"].map(len)).sort_values(["doc_id", "key"], kind="stable")
        x = np.zeros((len(pdf), buckets + N_STRUCTURE), np.float32)
        for i, (at, values) in enumerate(zip(pdf["at"], pdf["values"])):
            x[i, at] = values
        dense = np.array(pdf["structure"].tolist(), np.float32)
        mean, scale = dense.mean(axis=0), dense.std(axis=0) + 1e-3
        x[:, buckets:] = np.clip((dense - mean) / scale, -4, 4) / 2
        w0, w, v = fit_machine(x, (pdf["quality"].to_numpy() == 1).astype(np.float32))
        return pd.DataFrame({"w0": [w0], "w": [w], "v": [v.ravel()], "mean": [mean], "scale": [scale]})

    # One group of the bounded sample.
    fitted = slim.groupBy(F.lit(0).alias("all")).applyInPandas(
        train, "w0 double, w array<float>, v array<float>, mean array<float>, scale array<float>"
    ).collect()
    if not fitted:
        return None
    row = fitted[0]
    model = {name: np.array(row[name], np.float32) for name in ("w", "v", "mean", "scale")}
    return model | {"w0": row["w0"], "v": model["v"].reshape(len(model["w"]), -1), "buckets": buckets}


def score(docs: DataFrame, model: dict | None, threshold: float = THRESHOLD) -> DataFrame:
    """Rows packed as ``row`` with score and predicted; needs text and n_chars."""
    def make():
        def run(rows: list[dict]):
            if model is None:
                return [0.5] * len(rows), [int(0.5 >= threshold)] * len(rows)
            words, dense = rows_of([r["text"] for r in rows], [r["n_chars"] for r in rows], model["buckets"])
            x = np.concatenate([words, np.clip((dense - model["mean"]) / model["scale"], -4, 4) / 2], axis=1)
            raw, _ = machine(x, model["w0"], model["w"], model["v"])
            scores = 1 / (1 + np.exp(-np.clip(raw.astype(float), -30, 30)))
            return scores.tolist(), (scores >= threshold).astype(int).tolist()

        return run

    result = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    inputs = "inputs"
    while inputs in others:
        inputs += "_"
    packed = docs.select(*[F.col(f"`{c}`") for c in others], F.struct("text", "n_chars").alias(inputs))
    return map_column(packed, inputs, result, make)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("row.doc_id", held_out("row.doc_id").alias("held_out"), "score", "predicted")
