"""Fill-in-the-middle: exact cuts from the rank index, and texts that can be restored."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from statmart.llm import fill_middle

LINE = re.compile(r"[^\n]*\n|[^\n]+")


def plain(doc_id, text, cut_percent=100, spm_percent=50):
    text = text or ""
    lines = LINE.findall(text)
    digits = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i * 8:i * 8 + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= cut_percent:
        return len(lines), "plain", None, None, text
    if h4 % 100 < spm_percent:
        return len(lines), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(lines), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts(chance):
    fixed = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "a\nb", "é\n日本\r\n\U0001f600", "x <P> y\nz", "<S>", "a\n<M>\n", "<\nP>\n<S\n>", "<P\n<S\n<M",
             "a\x0bb\x0cc\x85d e\nf"]
    made = ["".join(chance.choice(["word ", "é", "\n", "\n\n", "<", ">", "P", "S", "M", "x" * 90, "日本"]) for _ in range(chance.randint(0, 400))) for _ in range(300)]
    return fixed + made


@pytest.mark.parametrize("cut, spm", [(100, 50), (60, 0), (0, 50)])
def test_against_plain_python(spark, cut, spm):
    rows = [(i, t, "x", 5) for i, t in enumerate(texts(random.Random(2)))]
    rows += [(None, "a\nb\nc", "x", 5), (3, "other\ntext\n", "x", 5), (3, "other\ntext\n", "x", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, n int").repartition(3)
    done = fill_middle.fill_in_middle(df, cut_percent=cut, spm_percent=spm)
    found = done.select("row.*", F.struct("n", "form", "prefix_chars", "middle_chars", "output").alias("made"),
                        fill_middle.restored(done["output"], done["form"]).alias("back")).collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r["made"]) == plain(r["doc_id"], r["text"], cut, spm)
        assert r["back"] == (r["text"] or "")
        assert (r["output"], r["n"]) == ("x", 5)


def test_index_is_exact_and_small():
    chance = np.random.default_rng(3)
    for offsets in (np.arange(1000), np.cumsum(chance.integers(1, 100, 20_000)), np.cumsum(chance.choice([1, 2, 10**6], 3000)), np.zeros(50, np.int64),
                    np.array([0]), np.array([], np.int64), np.append(np.arange(500), np.arange(500) * 1000 + 10**9)):
        index = fill_middle.RankIndex(offsets)
        assert index.residuals.dtype == np.int8
        assert index.offsets(np.arange(len(offsets))).tolist() == offsets.tolist()
    assert len(fill_middle.RankIndex(np.arange(10**6) * 7).starts) == 1
    # Lines of about the same length need a segment for many of them.
    assert len(fill_middle.RankIndex(np.cumsum(chance.integers(30, 90, 20_000))).starts) < 1500


def test_segments_keep_the_error_bound():
    offsets = np.cumsum(np.random.default_rng(4).integers(0, 400, 5000))
    for miss in (0, 5, 120):
        index = fill_middle.RankIndex(offsets, miss)
        assert np.abs(index.residuals).max() <= miss + 1


def test_very_long_texts(spark):
    long = ("é" * 50 + "\n") * 60_000
    rows = [(1, long), (2, "\n" * 1_500_000), (3, "x" * 3_000_000), (4, "a\nb")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {r["row"]["doc_id"]: r for r in fill_middle.fill_in_middle(df).collect()}
    for i, text in rows:
        want = plain(i, text)
        assert (found[i]["n"], found[i]["form"], found[i]["prefix_chars"], found[i]["middle_chars"]) == want[:4]
        assert found[i]["output"] == want[4]


def test_blocks_are_bounded():
    sizes = np.array([10] * 600 + [fill_middle.BLOCK_CHARS * 3] + [fill_middle.BLOCK_CHARS // 2] * 5)
    runs = list(fill_middle.blocks(sizes))
    assert sum(n for _, n in runs) == len(sizes) and [s for s, _ in runs] == np.cumsum([0, *[n for _, n in runs][:-1]]).tolist()
    assert all(n == 1 or (n <= fill_middle.BLOCK_ROWS and sizes[s:s + n].sum() <= fill_middle.BLOCK_CHARS) for s, n in runs)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fill_middle.fill_in_middle(df).count() == 0
