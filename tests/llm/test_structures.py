"""URL filter, ball trees, packing, HTML text, pieces and chat perspectives."""

import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from statmart.llm import ball_tree, chat_format, html_text, packing, pieces, url_filter
from statmart.llm.queries import ORACLE, QUERIES
from statmart.suite.compare import difference, oracle_connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    pytest.importorskip("duckdb")
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, oracle, name):
    assert difference(QUERIES[name](spark, SF), oracle, ORACLE[name]) is None


# URL filter

def plain_verdict(url, rules, blocked):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    rule = max(fits, key=lambda r: (len(r), r), default=None)
    listed = any(host == b or host.endswith("." + b) for b in blocked)
    return host, path, rule, rules[rule] if rule else "block" if listed else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://com/", "https://Example.COM/en/x?y#z", "http://www.example.com/en/", "http://www.example.com/en",
    "http://badexample.com/en/1", "ftp://a.net/es/1", "x://net/fr/", "http://a.net/ES/1", "http://spam-farm.example.org", "http://x.spam-farm.example.org?q",
    "http://notspam-farm.example.org/", "http://a.b.c.com#f", "http://a.com?x=/en/", "http://É.net/fr/a", "a://b://c.com/", "http://a.net//fr/",
]


@pytest.mark.parametrize("blocked", [(), ("spam-farm.example.org", "b.c.com", "a.com", "a.com", "nowhere.test")])
def test_urls_against_plain_python(spark, blocked):
    rows = [(i, url, "host", 1) for i, url in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule int")
    given = spark.createDataFrame([(f" {b.upper()}", 1) for b in blocked] + [("",  2), (None, 3), ("com/", 4)], "domain string, n int") if blocked else None
    found = url_filter.judge_urls(pages, blocked=given).select("row.page_id", "host", "path", "rule", "verdict").collect()
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[1:] == plain_verdict(rows[r["page_id"]][1], dict(url_filter.RULES), blocked)
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_verdicts_follow_the_list(spark):
    """Hosts are blocked because they are listed, whatever they are called."""
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(("casino.test", "www.casino.test", "mild.test"))], "page_id long, url string")
    for listed, want in (("casino.test", ["block", "block", "allow"]), ("mild.test", ["allow", "allow", "block"])):
        domains = spark.createDataFrame([(listed,)], "domain string")
        found = url_filter.judge_urls(pages, blocked=domains).select("row.page_id", "verdict").collect()
        assert [r["verdict"] for r in sorted(found)] == want


def test_a_cascade_grows_with_the_list_and_not_with_the_universe(spark):
    sizes = []
    for n in (2_000, 200_000):
        keys = spark.range(n).select(F.xxhash64("id").alias("h"))
        cascade = url_filter.build_cascade(keys, spark.range(20).select(F.xxhash64("id").alias("h")))
        held = cascade.holds(np.array([r["h"] for r in keys.collect()], np.int64).view(np.uint64))
        assert held[:20].all() and not held[20:].any()
        sizes.append(sum(len(level.bits) for level in cascade.levels))
    assert sizes[1] <= 2 * sizes[0] and sizes[1] <= 16 * url_filter.LEAST_WORDS


@pytest.mark.parametrize("bits, hashes", [(1, 1), (3, 2), (12, 6)])
def test_cascade_is_exact_over_its_keys(spark, bits, hashes):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"), (F.col("id") % 17 == 0).alias("listed"))
    cascade = url_filter.build_cascade(keys.select("h"), keys.where("listed").select("h"), bits, hashes)
    rows = keys.collect()
    held = cascade.holds(np.array([r["h"] for r in rows], np.int64).view(np.uint64))
    assert held.tolist() == [r["listed"] for r in rows]
    assert len(cascade.levels) > 2 or bits > 3
    nothing = url_filter.build_cascade(keys.select("h"), keys.where("false").select("h"))
    assert not nothing.holds(np.array([r["h"] for r in rows], np.int64).view(np.uint64)).any()


# Exact top-k

def plain_top(rows, k):
    valid = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
             if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    result = []
    for at, (i, q) in enumerate(valid):
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for other, (j, v) in enumerate(valid) if other != at and len(v) == len(q))
            result += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(result)


def test_every_row_is_a_candidate(spark):
    """Rows that repeat an id, of candidates and of queries."""
    rows = [(0, [1.0, 0.0]), (1, [0.1, 0.0]), (1, [0.9, 0.0]), (0, [2.0, 0.0]), (50, [1.0, 0.0]), (50, [1.0, 0.0]), (2, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = df.select("vec_id", ball_tree.quantised(F.col("embedding")).alias("q"))
    for shard_rows in (100, 2):
        found = ball_tree.top_k(vectors, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, warm_shards=1).collect()
        assert sorted(tuple(r) for r in found) == plain_top(rows, 5)
    assert (0, 4, 1, 58_880) in [tuple(r) for r in found]


def test_top_k_against_all_pairs(spark):
    chance = random.Random(4)
    centres = [[chance.gauss(0, 0.3) for _ in range(8)] for _ in range(5)]
    rows = [(i, [c + chance.gauss(0, 0.05) for c in centres[i % 5]]) for i in range(1200)]
    rows += [(i, [0.5] * 8) for i in range(1200, 1500)]  # ties
    rows += [(2000, [1.0, 2.0]), (2001, [3.0, -1.0]), (2050, [1.0]), (2100, None), (2150, []), (2200, [None] * 8), (2250, [float("nan")] * 8),
             (2300, [float("inf")] * 8), (None, [0.1] * 8), (50, [0.1] * 8), (50, rows[50][1]), (2350, [100.0] * 8), (2400, [-100.0] * 8)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    vectors = df.select("vec_id", ball_tree.quantised(F.col("embedding")).alias("q"))
    rows32 = [(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None) for i, v in rows]
    for shard_rows, query_rows in ((100_000, 1024), (200, 7)):
        found = ball_tree.top_k(vectors, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, query_rows=query_rows, warm_shards=2).collect()
        assert sorted(tuple(r) for r in found) == plain_top(rows32, 5)
    assert ball_tree.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_components_beyond_32_bits(spark):
    chance = random.Random(9)
    rows = [(i, [chance.uniform(-1, 1) * 10.0 ** chance.choice((0, 3, 7)), *[chance.uniform(-9, 9) for _ in range(3)]]) for i in range(300)]
    rows += [(400, [float(1 << 23), 0.0, 0.0, 0.0]), (450, [float(-(1 << 23)) - 1, 1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = df.select("vec_id", ball_tree.quantised(F.col("embedding")).alias("q"))
    for shard_rows in (1000, 40):
        found = ball_tree.top_k(vectors, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, warm_shards=2).collect()
        assert sorted(tuple(r) for r in found) == plain_top(rows, 5)


def test_bounds_spare_leaves(monkeypatch):
    chance = np.random.default_rng(1)
    vectors = np.concatenate([chance.integers(-20, 20, (500, 6)) + c for c in chance.integers(-400, 400, (8, 6))])
    order, spans, centres, radii = ball_tree.build_tree(vectors, 64)
    assert sorted(order.tolist()) == list(range(len(vectors)))
    for node, (low, high) in enumerate(spans):
        assert (np.linalg.norm(vectors[order[low:high]] - centres[node], axis=1) <= radii[node] + 1e-9).all()


# Packing

@pytest.fixture(scope="module")
def encoder():
    return packing.PartEncoder(packing.word_bpe_path())


def test_parts_encode_like_whole_texts(spark, encoder):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(packing.word_bpe_path())
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    texts += [None, "", " ", "A\xa0b\u2003c ÉÉ éx", "don't we'll.,  x..,, 12ab3.", "<|endoftext|> a<|startoftext|>b", "İstanbul ΑΣ. ΟΔΟΣ Σ",
              "\x1c a\x1fb\x85c", "ﬁ ① ǅ e\u0301 É.", "a,b. c.,", "ªº µ ß ẞ", "汉字 かな", "x" * 3000, "naïve,. Œuvre."]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)] == want


def test_cut():
    ids = np.arange(10, dtype="<u4").tobytes()
    assert packing.cut(ids, 4) == [(0, 0, 4, zlib.crc32(ids[:16])), (1, 4, 4, zlib.crc32(ids[16:32])), (2, 8, 2, zlib.crc32(ids[32:]))]


def fewest_bins(sizes, capacity):
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + sizes[i] <= capacity:
                place(i + 1, [*bins[:j], bins[j] + sizes[i], *bins[j + 1:]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_bound_is_never_above_the_optimum():
    chance = random.Random(2)
    for _ in range(150):
        sizes = [chance.randint(1, 12) for _ in range(chance.randint(1, 8))]
        bins, offsets = packing.best_fit_decreasing(np.array(sizes), 12)
        optimum = fewest_bins(sizes, 12)
        assert packing.lower_bound(np.array(sizes), 12) <= optimum <= bins.max() + 1


def check_packing(rows, capacity):
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_exchange_closes_gaps(spark):
    chance = random.Random(3)
    sizes = [chance.choice([100, 60, 41, 40, 35, 33, 20, 7]) for _ in range(3000)]
    rows = [(i if i % 9 else None, 0, 0, n, 7) for i, n in enumerate(sizes)]
    found = packing.pack(spark.createDataFrame(rows, packing.PIECES), 100, part_rows=100).collect()
    assert sorted(r["length"] for r in found) == sorted(sizes)
    n = check_packing(found, 100)
    parts = [packing.best_fit_decreasing(np.array(sizes[i:i + 100]), 100)[0].max() + 1 for i in range(0, 3000, 100)]
    whole = packing.best_fit_decreasing(np.array(sizes), 100)[0].max() + 1
    assert packing.lower_bound(np.array(sizes), 100) <= n <= 1.02 * whole and n < sum(parts)


def test_packing_of_documents(spark, encoder):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(None, "a b"), (-1, None), (-2, ""), (-2, ""), (-3, "word " * 9000)], "doc_id long, text string")
    both = docs.unionByName(odd).withColumns({"part": F.lit(1), "length": F.lit("x"), "bin": F.lit(None).cast("int")})
    found = packing.pack_documents(both).collect()
    check_packing(found, packing.CAPACITY)
    want = []
    for r in both.collect():
        ids = encoder.encode([r["text"]])[0] + np.array([1], "<u4").tobytes()
        want += [(r["doc_id"], *p) for p in packing.cut(ids)]
    key = lambda x: (x[0] is None, *[v or 0 for v in x])
    assert sorted((tuple(r)[:5] for r in found), key=key) == sorted(want, key=key)
    assert packing.pack_documents(both.limit(0)).count() == 0


# HTML text

@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("just words, no markup.", "just words, no markup."),
    ("<p>a &amp; b &lt;c&gt; &nbsp; &#8217;&unknown; x<b>y</b>z<br>w</p>", "a & b <c> ’&unknown; xyz w"),
    ("<nav>Menu items here</nav><article><h1>Title</h1><p>Text one.<p>Text <a href=x>two</a>.</article><footer>foot</footer>", "Title Text one. Text two."),
    ("<header><h1>Site</h1></header><main><header><h1>Head</h1></header><p>Body of it.</p></main>", "Head Body of it."),
    ("<script>if (a<b) '</p>'</script><style>p{}</style><p>Only this remains here.</p><!-- <p>no</p> -->", "Only this remains here."),
    ("<article><p>Kept here.</p><div class='ad banner'>Buy now, it is cheap.</div><p>Kept too.</p><form>Name <input></form>"
     "<section id=comments><p>I liked this very much, thank you. It was good to read.</p></section></article>", "Kept here. Kept too."),
    ("<body class='has-sidebar'><div class='wrap no-sidebar'><div class=content><p>A paragraph with some words in it.</p></div>"
     "<div class=sidebar><p>Other stories you may want to read now.</p></div></div>", "A paragraph with some words in it."),
    ("<article><p>One", "One"), ("<article><p>a < b and c</p></article>", "a < b and c"), ("<ARTICLE><P>Up</P></ARTICLE></div></p>", "Up"),
    ("<article><p>x</p><textarea><p>no</p></textarea><p>y\n\t z</p><p hidden>secret words</p></article>", "x y z"),
])
def test_pages(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><meta charset=utf-8><body><article><p>All of it is here.</p></article></body></html>", "All of it is here."),
    ("<head><link rel=x><script>a</script><style>b</style>\n<article><p>No body tag here.</p></article>", "No body tag here."),
    ("<head><noscript><p>n</p></noscript><!-- c --><title>T</title></head><p>The head is closed.</p>", "The head is closed."),
    ("<head><title>T</title>Words end a head too.", "Words end a head too."),
    ("<head><title>T</title>Words end it.<p>And more follows.</p>", "Words end it. And more follows."),
    ("<head><title>T</title> \n <br>Text after a break.", "Text after a break."),
    ("<head><meta name=x><title>Only a head</title>", ""),
])
def test_heads_without_an_end(page, text):
    assert html_text.main_text(page) == text


STORY = "<article><p>A long sentence with quite a few words in it.</p></article>"
STORY_TEXT = "A long sentence with quite a few words in it."
OTHERS = "<p>I liked this very much, thank you. It was good to read.</p>"


@pytest.mark.parametrize("page, text", [
    *[(f"<div {names}>{STORY}</div>", STORY_TEXT) for names in (
        "class='content sidebar-right'", "class=two-sidebars", "id=page class='search-enabled'", "class=comments-open", "class='nav-collapsed wrap'",
    )],
    (f"<div class=two-sidebars><main><div class=sidebar-left>{STORY}</div></main></div>", STORY_TEXT),
    (f"<div class='newsletter'><main><p>{STORY_TEXT}</p></main></div>", STORY_TEXT),
    # What is not the page's own stays cut.
    *[(f"<{name}>{STORY}</{end}>", "") for name, end in (
        ("nav", "nav"), ("footer", "footer"), ("aside", "aside"), ("form", "form"), ("div hidden", "div"), ("div class=comments", "div"),
        ("div role=navigation", "div"), ("div style='display: none'", "div"),
    )],
    (f"<div class=two-sidebars>{STORY}<div class=sidebar><article>{OTHERS}</article></div></div>", STORY_TEXT),
    (f"{STORY}<div class=sidebar><article>{OTHERS}</article></div>", STORY_TEXT),
    (f"<main>{STORY}<section class=related><article>{OTHERS}</article></section></main>", STORY_TEXT),
    (f"<div class=sidebar-right><article><p>{STORY_TEXT}</p><div id=comments><article>{OTHERS}</article></div></article></div>", STORY_TEXT),
    (f"<div class=sidebar-right><article><p>{STORY_TEXT}</p><div class=share>{OTHERS}</div></article></div>", STORY_TEXT),
])
def test_names_of_wrappers(page, text):
    assert html_text.main_text(page) == text


def test_cut_is_minimal():
    chance = random.Random(5)
    for _ in range(60):
        n = chance.randint(1, 7)
        odds = [round(chance.uniform(-3, 3), 2) for _ in range(n)]
        edges = [(a, b, round(chance.uniform(0, 2), 2)) for a, b in itertools.combinations(range(n), 2) if chance.random() < 0.5]

        def cost(kept):
            cut = sum(o for o, k in zip(odds, kept) if o > 0 and not k) - sum(o for o, k in zip(odds, kept) if o < 0 and k)
            return cut + sum(w for a, b, w in edges if kept[a] != kept[b])

        assert cost(html_text.minimum_cut(odds, edges)) == pytest.approx(min(map(cost, itertools.product((False, True), repeat=n))))


def plain_tag(page, at):
    """The next tag by looking at every "<" anew: start, end, name."""
    while (start := page.find("<", at)) >= 0:
        for opening, ending in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">")):
            if page.startswith(opening, start):
                found = page.find(ending, start + len(opening))
                return start, found + len(ending) if found >= 0 else len(page), ""
        name = re.match(r"</?([a-zA-Z][^\s/>]*)", page[start:])
        if name:
            rest = page[start + name.end():]
            end = re.match(r"""(?:[^>"']|"[^"]*"|'[^']*')*>""", rest) or re.match(r"[^>]*>", rest)
            if end:
                return start, start + name.end() + end.end(), name[1]
        at = start + 1
    return None


def test_tags_against_a_plain_reader():
    chance = random.Random(6)
    parts = ["<a ", "<p ", "</p ", ">", '"', "'", "<", "x ", "=", " ", "<!--", "-->", "<![CDATA[", "]]>", "<!", "<?", "</", '<i c="d" ']
    for _ in range(5000):
        page = "".join(chance.choice(parts) for _ in range(chance.randint(1, 30)))
        tags, at = html_text.Tags(page), 0
        while True:
            found, want = tags.after(at), plain_tag(page, at)
            assert (found and (found[0], found[1], found[3])) == want, page
            if not found:
                break
            at = found[1]


@pytest.mark.parametrize("page", [
    '<a "' * 250_000, '<a ">"' * 170_000 + "'", "<a" * 500_000, "<" * 1_000_000, "<div>" * 18_000 + "</x>" * 18_000, "<div>" * 40_000, "<a '\"" * 200_000,
], ids=["quotes", "quoted ends", "starts", "brackets", "end tags", "nested", "both quotes"])
def test_broken_pages_take_time_by_their_length(page):
    """A megabyte of what no browser wrote; the square of its length would be minutes."""
    started = time.perf_counter()
    html_text.read_blocks(page)
    assert time.perf_counter() - started < 15


def test_html_query(spark):
    rows = html_text.op3_html_text(spark, SF).collect()
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in rows:
        inside = re.search("<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        assert r["text"] == " ".join(html_text.html.unescape(re.sub("<[^>]*>", " ", inside)).split()) and r["n_chars"] == len(r["text"])
    odd = spark.createDataFrame([(1, None, "a"), (1, "<p>" * 3000 + "deep words here.", "b")], "page_id long, html string, text string")
    assert [tuple(r) for r in html_text.extract(odd).select("text", "n_chars").collect()] == [("", 0), ("deep words here.", 16)]
    assert html_text.extract(odd.limit(0)).count() == 0


# Pieces

@pytest.fixture(scope="module")
def model():
    return pieces.read_model(pieces.piece_path())


def slow_ids(text, model):
    import sentencepiece

    table = sentencepiece.SentencePieceProcessor(model_file=pieces.piece_path())
    pairs = {table.id_to_piece(i): (i, table.get_score(i)) for i in range(259, table.get_piece_size())}
    s = pieces.BLANK + text.replace(" ", pieces.BLANK) if text else ""
    best = [(0.0, [])] + [None] * len(s)
    for end in range(1, len(s) + 1):
        for length in range(min(16, end), 0, -1):
            piece = s[end - length:end]
            score, ids = best[end - length]
            if piece in pairs:
                found = (score + pairs[piece][1], [*ids, pairs[piece][0]])
            elif length == 1:
                found = (score + model.unknown_score, [*ids, *[3 + b for b in piece.encode()]])
            else:
                continue
            if best[end] is None or found[0] > best[end][0]:
                best[end] = found
    return best[len(s)][1]


TEXTS = ["", " ", "  a  b ", "Hello  world\n\tx", "é漢\U0001F600ｆ①", "a▁b", "   ", "ÿ" * 50, "漢字かな交じり文", "\U0001F9FF" * 3 + " x", "a" * 300,
         "the the then", "Was thsh edly thonnd, to thhainged"]


def test_pieces_against_plain_viterbi(spark, model):
    texts = TEXTS + [r["text"][:400] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect()]
    ids = [np.frombuffer(x, "<u4").tolist() for x in pieces.Encoder(model).encode(texts)]
    assert ids == [slow_ids(t, model) for t in texts]


def test_round_trip(spark, model):
    rows = pieces.op8_sentencepiece(spark, SF).collect()
    assert len(rows) == 200 and all(r["round_trip"] for r in rows)
    df = spark.createDataFrame([(t, 1) for t in [*TEXTS, None]], "text string, ids int")
    encoded = pieces.encode_texts(df, model).select("row.text", F.col("ids"))
    decoded = pieces.decode_ids(encoded, model).select("row.text", "decoded").collect()
    assert all(r["decoded"] == (r["text"] or "").replace(pieces.BLANK, " ") for r in decoded)
    assert pieces.digests(df.limit(0), model).count() == 0


def test_pieces_are_those_of_the_library(spark, model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.piece_path())
    chance = random.Random(3)
    letters = "  \u2581aeinst.,\n0é漢\U0001F600ｆѣla"
    texts = TEXTS + ["".join(chance.choices(letters, k=chance.randint(1, 400))) for _ in range(100)]
    texts += ["".join(chance.choices("aeinstthe", k=k)) for k in (63, 64, 65, 66, 500, 5000)] + [" " * 1000 + "the" * 500]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    ids = [np.frombuffer(x, "<u4").tolist() for x in pieces.Encoder(model, pieces.Merger).encode(texts)]
    assert ids == library.encode(texts)
    query = {r["doc_id"]: (r["n_ids"], r["ids_crc32"]) for r in pieces.op8_sentencepiece(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want = library.encode(r["text"])
        assert query[r["doc_id"]] == (len(want), zlib.crc32(np.array(want, "<u4").tobytes()))
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    assert all(r["ids"] == library.encode(r["text"]) for r in pieces.encode_texts(df, model).select("row.text", "ids").collect())


# Chat

def test_chat_edges(spark):
    rows = [
        ("c", 0, "system", "Be kind <|end|>"), ("c", 1, "ann", "hi"), ("c", 2, "bob", None), ("c", 2, "bob", None), ("c", None, None, "who"),
        ("c", 3, "a<|b", "x"), (None, 1, "ann", "lost"), (None, 2, "bob", ""), ("s", 1, "system", "alone"),
    ]
    turns = spark.createDataFrame([(*r, 5, "y") for r in rows], "conv_id string, turn long, role string, text string, start int, segment string")
    found = chat_format.perspectives(turns).orderBy("conv_id", "participant", "seq").collect()
    by_view = {}
    for r in found:
        by_view.setdefault((r["conv_id"], r["participant"]), []).append(r)
    assert set(by_view) == {("c", "ann"), ("c", "bob"), ("c", "a<|b"), (None, "ann"), (None, "bob")}
    for (conv, who), view in by_view.items():
        text = "".join(r["segment"] for r in view)
        assert len(view) == sum(r[0] == conv for r in rows) and [r["seq"] for r in view] == list(range(len(view)))
        for r in view:
            assert text[r["start"]:r["end"]] == r["segment"]
            trained = text[r["train_start"]:r["train_end"]] if r["is_assistant"] else None
            assert r["is_assistant"] == (r["speaker"] == who) == (r["train_start"] is not None)
            if trained is not None:
                assert trained.endswith("<|end|>") and r["segment"] == "<|assistant|>\n" + trained + "\n"
    ann = "".join(r["segment"] for r in by_view["c", "ann"])
    assert ann == (
        "<|user|>\nwho<|end|>\n<|system|>\nBe kind <||end|><|end|>\n<|assistant|>\nhi<|end|>\n" + "<|user name=bob|>\n<|end|>\n" * 2
        + "<|user name=a<||b|>\nx<|end|>\n"
    )
    assert chat_format.perspectives(turns.limit(0)).count() == 0
