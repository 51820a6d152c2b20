"""Main text of web pages by minimum cut (operator 3).

A page is read into blocks: runs of text between block-level tags. A linear
classifier turns what is known of a block (the elements it is in, names of
their classes, share of linked text, length, sentence marks) into log odds of
being content; their positive and negative parts are the block's capacities
from the source and to the sink. Edges pull neighbours to the same side:
one between consecutive blocks, and one to the next block with the same
parent element, both stronger the closer two blocks lie in the tree. A maximum
flow gives the cheapest labelling; the blocks on the source side are the text.

Never text, whatever the cut says: scripts, styles, markup, form controls,
comments of the page source, and the document head.

Defined results: null and empty pages give an empty text; broken markup is read
as far as tags can be told (an open "<" without an end is text); unknown
entities stay as written; a head without an end tag ends where something
stands that no head may hold; repeated pages are extracted each by itself; extra
columns play no part; an empty table gives no rows. Pages are read whole.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.llm.common import map_column, table

#: Elements whose content is never text.
SILENT = frozenset(
    "head script style noscript template iframe object embed svg canvas math audio video map select option optgroup "
    "datalist textarea button input title meta link base".split()
)
#: Silent elements whose content is raw characters up to their end tag.
RAW = frozenset("script style textarea title iframe noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt rtc ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: What may stand in a document head; any other start tag, and text, ends it, as its end tag may be left out.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Elements that a start tag closes if they are the open parent.
CLOSES = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
#: Block-level tags that end an open paragraph.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
    "section table ul".split()
)
#: Log odds a block gains from being inside an element.
INSIDE = {
    "article": 4.0, "main": 3.0, "p": 1.0, "h1": 1.0, "h2": 0.5, "h3": 0.5, "blockquote": 1.0, "pre": 1.0, "table": 0.3,
    "figcaption": 0.5, "nav": -9.0, "footer": -9.0, "aside": -9.0, "form": -9.0, "menu": -9.0, "dialog": -9.0, "header": -6.0,
    "fieldset": -9.0, "address": -2.0, "label": -3.0,
}
#: Log odds from words in class, id, role and aria-label; the strongest one counts.
NAMED = {
    **dict.fromkeys(
        "ad ads adv advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo promotion promoted banner "
        "sidebar sidebars rail menu menus nav navbar navigation navigational breadcrumb breadcrumbs footer masthead header topbar toolbar "
        "notice notices cookie cookies consent gdpr alert popup modal overlay dialog newsletter subscribe subscription signup login "
        "comment comments commentlist disqus replies reply respond discussion share sharing social related recommended recommendations "
        "widget widgets pagination pager skip search form contentinfo complementary copyright legal disclaimer tags toc "
        "responses feedback recent popular trending teaser teasers blogroll sitemap crumbs hidden".split(), -9.0
    ),
    **dict.fromkeys("article articlebody post entry story content main maincontent body text prose".split(), 2.0),
}
#: Of the objecting words, those that often tell of a page's layout when a wrapper of the article has them.
LAYOUT = frozenset(
    "sidebar sidebars rail menu menus nav navbar navigation navigational footer masthead header topbar toolbar banner search widgets "
    "breadcrumb breadcrumbs pagination pager tags toc share sharing social login signup".split()
)
#: At the end of a name they make any word one of layout ("comments-open").
STATES = frozenset("enabled disabled open opened closed on off active visible shown collapsed expanded sticky fixed".split())
#: Before a word they make it one of layout ("has-sidebar").
EXEMPT = frozenset(("has", "with", "no", "without"))
#: Kinds of objections: of elements, roles and hidden ones; of names of other content; of names of layout.
FIRM, OTHER, SOFT = range(3)
HYPHENS = re.compile(r"[^a-z]+")
CAMEL = re.compile(r"([a-z])([A-Z])")
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ENDS_OR_QUOTES = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"(class|id|role|aria-label|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
SPACES = re.compile(r"\s+")
SENTENCE = re.compile(r"[.!?…。](?:\s|$)")


class Tags:
    """The tags of a page, one after the other; no part of the page is looked through twice.

    A tag ends at the first ">" outside quotes; at the first one at all, if quotes are left open from there
    to the end of the page. Quotes that were followed to the end in vain are remembered.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = {c: page.rfind(c) for c in ">\"'"}
        self.in_vain: set[int] = set()

    def _end(self, at: int) -> int:
        """Behind the end of a tag whose name ends at ``at``; -1 if it has none."""
        seen, place = [], at
        while place <= self.last[">"]:
            found = ENDS_OR_QUOTES.search(self.page, place)
            if found[0] == ">":
                return found.end()
            quote = found.start()
            if quote in self.in_vain or quote == self.last[found[0]]:
                seen.append(quote)
                break
            seen.append(quote)
            place = self.page.index(found[0], quote + 1) + 1
        self.in_vain.update(seen)
        return self.page.find(">", at) + 1 or -1

    def after(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start, end, whether it is an end tag, name and attributes of the next tag; comments and the like have no name."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            for opening, ending in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">")):
                if page.startswith(opening, start):
                    found = page.find(ending, start + len(opening))
                    return start, found + len(ending) if found >= 0 else len(page), False, "", ""
            if start < self.last[">"] and (named := NAME.match(page, start)):
                end = self._end(named.end())
                if end > 0:
                    return start, end, page[start + 1] == "/", named[1], page[named.end():end - 1]
            at = start + 1
        return None


def _words(value: str) -> list[str]:
    return HYPHENS.split(CAMEL.sub(r"\1-\2", value).lower())


def _only_layout(names: list[str]) -> bool:
    """Whether all objecting words of names are ones of layout."""
    for name in " ".join(names).split():
        words = [w for w in _words(name) if w]
        if words and words[-1] not in STATES and any(
                NAMED.get(w, 0.0) < 0 and w not in LAYOUT and before not in EXEMPT for before, w in zip(["", *words], words)):
            return False
    return True


class Element:
    """An open or closed element: name, parent, and the log odds its name and attributes give.

    ``own`` is its own objection and ``kind`` the kind of it; ``frame`` says whether it is an article or main outside
    of all articles, ``wrappers`` how many elements above it object by their names only.
    """

    __slots__ = ("name", "parent", "depth", "good", "bad", "silent", "article", "own", "kind", "within", "frame", "wrappers")

    def __init__(self, name: str, parent: Element | None, attributes: str):
        self.name, self.parent = name, parent
        self.depth = parent.depth + 1 if parent else 0
        self.silent = (parent.silent if parent else False) or name in SILENT
        self.article = (parent.article if parent else False) or name in ("article", "main")
        own = INSIDE.get(name, 0.0)
        if name == "header" and self.article:
            own = 0.0
        named = 0.0
        kind = FIRM if own < 0 else SOFT
        names: list[str] = []
        if attributes:
            for key, *values in ATTRIBUTE.findall(attributes):
                key, value = key.lower(), "".join(values)
                if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                    named = min(named, -9.0)
                    kind = FIRM
                elif key in ("class", "id", "role", "aria-label") and name not in ("html", "body"):
                    words = _words(value)
                    if key == "role" and any(NAMED.get(w, 0.0) < 0 for w in words):
                        kind = FIRM
                    names.append(value)
                    for before, word in zip(["", *words], words):
                        odds = NAMED.get(word, 0.0)
                        if before in EXEMPT or word == "header" and self.article:
                            # What a wrapper says of its layout, and the head of an article.
                            odds = 0.0
                        named = odds if abs(odds) > abs(named) else named
        # The strongest approval and the strongest objection on the way up count.
        self.good = max(parent.good if parent else 0.0, own + named)
        self.bad = min(parent.bad if parent else 0.0, own + named)
        self.own = min(0.0, own + named)
        self.kind = OTHER if self.own < 0 and kind == SOFT and not _only_layout(names) else kind
        self.within = bool(parent) and (parent.within or parent.name == "article")
        self.frame = name in ("article", "main") and not self.within
        self.wrappers = parent.wrappers + (parent.own < 0 and parent.kind != FIRM) if parent else 0


class Block:
    __slots__ = ("text", "parent", "linked")

    def __init__(self, text: str, linked: int, parent: Element):
        self.text, self.linked, self.parent = text, linked, parent


def release(blocks: list[Block], frames: list[Element]) -> None:
    """Takes what names of wrappers around the page's article or main object to from the blocks inside.

    An article lifts objections of layout, a main all that names give; those of elements (nav, footer, aside, form),
    roles and hidden ones stay. Only the articles (or mains) with the fewest such wrappers do so: where another one
    stands free, a wrapper is not one of the page. Articles inside articles, such as comments, lift nothing.
    """
    least: dict[str, int] = {}
    for frame in frames:
        least[frame.name] = min(frame.wrappers, least.get(frame.name, frame.wrappers))
    lifting = {id(f): f.name for f in frames if f.wrappers == least[f.name] > 0}
    if not lifting:
        return
    known: dict[int, tuple[float, float, float]] = {}
    for block in blocks:
        path = []
        node = block.parent
        while node and id(node) not in known:
            path.append(node)
            node = node.parent
        firm, other, soft = known[id(node)] if node else (0.0, 0.0, 0.0)
        for node in reversed(path):
            if id(node) in lifting:
                other, soft = 0.0 if node.name == "main" else other, 0.0
            if node.kind == FIRM:
                firm = min(firm, node.own)
            elif node.kind == OTHER:
                other = min(other, node.own)
            else:
                soft = min(soft, node.own)
            known[id(node)] = firm, other, soft
            node.bad = min(firm, other, soft)


def read_blocks(page: str) -> list[Block]:
    """The page's text blocks in order, with decoded references and single spaces."""
    root = Element("#root", None, "")
    current = root
    blocks: list[Block] = []
    frames: list[Element] = []
    parts: list[str] = []
    linked, in_link = 0, 0

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = SPACES.sub(" ", "".join(parts)).strip()
            if text:
                holder = current
                while holder.name in INLINE and holder.parent:
                    holder = holder.parent
                blocks.append(Block(text, linked, holder))
            parts.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not current.silent:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    #: How many elements of a name are open, so that no end tag looks for one that is not.
    opens: Counter = Counter()

    def leave_to(holder: Element) -> None:
        nonlocal current, in_link
        while current is not holder:
            opens[current.name] -= 1
            in_link -= current.name == "a"
            current = current.parent

    at, tags = 0, Tags(page)
    while at < len(page):
        tag = tags.after(at)
        if not tag:
            if current.name == "head" and page[at:].strip():
                leave_to(current.parent)
            add(page[at:])
            break
        start, end, closing, name, attributes = tag
        if current.name == "head" and page[at:start].strip():
            leave_to(current.parent)
        add(page[at:start])
        at = end
        if not name:
            if page.startswith("<![CDATA[", start):
                add(page[start + 9:end].removesuffix("]]>"))
            continue
        name = name.lower()
        if current.name == "head" and not closing and name not in IN_HEAD:
            leave_to(current.parent)
        if name == "br" or name == "wbr":
            if name == "br" and parts:
                parts.append(" ")
            continue
        if name not in INLINE:
            end_block()
        if closing:
            if not opens[name]:
                continue
            opened = current
            # An end tag closes up to its start tag; inline ones do not reach past a block.
            while opened.parent and opened.name != name and (name not in INLINE or opened.name in INLINE):
                opened = opened.parent
            if opened.name == name and opened.parent:
                leave_to(opened.parent)
            continue
        if name in ENDS_PARAGRAPH or name in CLOSES:
            closable = CLOSES.get(name, set()) | ({"p"} if name in ENDS_PARAGRAPH else set())
            node = current
            while node.parent and node.name in INLINE:
                node = node.parent
            while node.parent and node.name in closable:
                leave_to(node.parent)
                node = current
        if name in VOID or attributes.rstrip().endswith("/") and name not in INLINE and name in SILENT:
            continue
        current = Element(name, current, attributes)
        opens[name] += 1
        if current.frame:
            frames.append(current)
        in_link += name == "a"
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            leave_to(current.parent)
    end_block()
    release(blocks, frames)
    return blocks


def content_odds(block: Block) -> float:
    """Log odds that a block is content."""
    n = len(block.text)
    words = block.text.count(" ") + 1
    odds = -0.5 + block.parent.good + block.parent.bad
    odds += min(2.0, words / 15) + (0.7 if SENTENCE.search(block.text) else 0.0)
    odds -= 4.0 * min(1.0, block.linked / n)
    return odds


FAR = 50


def _distance(a: Element, b: Element) -> int:
    """Steps between two elements in the tree, as far as they matter."""
    steps = 0
    while a is not b and steps < FAR:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source in a minimum cut (blocking flows, nodes level by level).

    Capacities are thousandths, so the flow is exact; of equal cuts the one with the fewest nodes is taken.
    """
    n = len(odds)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(a: int, b: int, forth: int, back: int) -> None:
        for x, y, capacity in ((a, b, forth), (b, a, back)):
            out[x].append(len(to))
            to.append(y)
            room.append(capacity)

    for i, value in enumerate(odds):
        if value >= 0:
            connect(source, i, round(value * 1000), 0)
        else:
            connect(i, sink, round(-value * 1000), 0)
    for a, b, weight in edges:
        connect(a, b, round(weight * 1000), round(weight * 1000))

    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            at = queue.popleft()
            for e in out[at]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[at] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        step = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                # Back to before the first full edge.
                cut = next(i for i, e in enumerate(path) if not room[e])
                at = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while step[at] < len(out[at]):
                e = out[at][step[at]]
                if room[e] and level[to[e]] == level[at] + 1:
                    break
                step[at] += 1
            if step[at] < len(out[at]):
                path.append(out[at][step[at]])
                at = to[path[-1]]
            elif path:
                at = to[path.pop() ^ 1]
                step[at] += 1
            else:
                break


NEAR = 1.0
SIBLING = 0.6


def main_text(page: str | None) -> str:
    """The blocks on the content side of the cut, joined by single spaces."""
    blocks = read_blocks(page or "")
    if not blocks:
        return ""
    odds = [content_odds(b) for b in blocks]
    edges = [(i, i + 1, NEAR / (1 + _distance(a.parent, b.parent))) for i, (a, b) in enumerate(zip(blocks, blocks[1:]))]
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        holder = block.parent.parent or block.parent
        if id(holder) in last and last[id(holder)] < i - 1:
            edges.append((last[id(holder)], i, SIBLING / (1 + _distance(blocks[last[id(holder)]].parent, block.parent))))
        last[id(holder)] = i
    return " ".join(b.text for b, kept in zip(blocks, minimum_cut(odds, edges)) if kept)


RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """Rows packed as ``row`` with text and n_chars."""
    def make():
        def run(found: list[str | None]):
            texts = [main_text(page) for page in found]
            return texts, [len(t) for t in texts]

        return run

    return map_column(pages, column, RESULT, make)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("row.page_id", "row.url", "text", "n_chars")
