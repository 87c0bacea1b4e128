"""Main text of web pages by a minimum cut between content and boilerplate.

A page becomes text blocks in page order: what stands between the borders of block elements. A classifier gives each block a
cost. One part of it comes from the elements around it: their names, roles, and the words of their classes and ids (fixed
values below). The other part is learned from all pages: blocks whose elements say plainly what they are serve as labels for
features of the text itself (words, share of link text, sentence ends, kind of block, signs), counted in Spark and turned into
log-odds, halfway to a stated belief. Blocks without such elements are judged by the learned part and by their
neighbours: costs become capacities to the two terminals, and blocks that follow each other or have one parent are joined by
edges that weaken with the distance in the element tree. A maximum flow (shortest augmenting paths in layers) gives the
smallest cut; what stays joined to the content terminal is the text.

Character references are decoded, white space inside a block becomes one space, blocks are joined by a line end; line breaks
(``br``) are white space. Inline elements that are marked as boilerplate are blocks of their own within their paragraph.

Rows: null or empty html gives an empty text; null ids and urls are kept; repeated rows give repeated results; an empty table
gives none. Unclosed elements end where the next of their kind or their parent ends; a page may end anywhere. Other columns are
not read. Time and memory grow with the page's blocks and depth.
"""

from __future__ import annotations

import functools
import html
import math
import re
from collections import Counter, deque
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship, tidied

# -- fixed values: elements of HTML -------------------------------------------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNREAD = RAW | frozenset("template svg math object select datalist canvas audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: what the start of an element ends (up to the elements that shield it)
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "body": ({"head"}, set()),
    "a": ({"a"}, set()),
}
SHIELDS = frozenset("table td th caption button object".split())  # of an open paragraph

# -- fixed values: what elements, roles and words of classes and ids say --------------------------------------------
CONTENT, BOILERPLATE = 9.0, -9.0
TAGS = {
    "main": CONTENT, "article": CONTENT, "nav": BOILERPLATE, "aside": BOILERPLATE, "footer": BOILERPLATE, "menu": BOILERPLATE,
    "dialog": BOILERPLATE, "noscript": BOILERPLATE, "form": BOILERPLATE, "button": BOILERPLATE, "label": BOILERPLATE,
    "fieldset": BOILERPLATE, "legend": BOILERPLATE, "search": BOILERPLATE, "output": BOILERPLATE,
}
ROLES = {
    "main": CONTENT, "article": CONTENT, "navigation": BOILERPLATE, "banner": BOILERPLATE, "contentinfo": BOILERPLATE,
    "complementary": BOILERPLATE, "search": BOILERPLATE, "form": BOILERPLATE, "alert": BOILERPLATE, "dialog": BOILERPLATE,
    "alertdialog": BOILERPLATE, "menu": BOILERPLATE, "menubar": BOILERPLATE, "toolbar": BOILERPLATE, "status": BOILERPLATE,
}
GOOD_WORDS = frozenset("article articlebody body content entry main maincontent page post prose story text".split())
BAD_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts adsense alert aside banner breadcrumb breadcrumbs colophon comment comments "
    "consent cookie cookies copyright discussion disqus follow footer gdpr login masthead menu modal nav navbar navigation "
    "newsletter notice notification notifications overlay pager pagination paywall popup promo promotion promoted rail "
    "recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar topbar widget widgets".split()
)
BAD_PARTS = ("sidebar", "footer", "navigation", "comment", "cookie", "advert", "newsletter", "breadcrumb", "masthead")
UNSAID = frozenset("has no with without".split())  # the words after these name what is elsewhere
WRAPPERS = frozenset("container layout wrap wrapper".split())

# -- parameters ---------------------------------------------------------------------------------------------------
GOOD_WORD = 3.0  # of a class or id
OUTSIDE = -2.5  # a block that nothing marks, on a page that marks its content
TEXT_MOST = 4.0
FEATURE_MOST = 2.0
LEARNED = 0.5  # of the way from the belief to what is counted
BELIEF_COUNT = 200  # labelled blocks that weigh as much as the belief
ADJACENT, SIBLING = 0.6, 0.4
SCALE = 1000

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^=>]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"']?))*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
MARKED = re.compile(r"\b(?:class|id|role|hidden|style|itemprop|aria-hidden|href)\b", re.I)
CLOSES = {name: re.compile(rf"</{name}[^>]*(?:>|\Z)", re.I) for name in UNREAD}
SIGNS = re.compile("[©®|»«·•]")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Element(NamedTuple):
    name: str
    number: int  # of the block element it is or stands in; 0 is the page
    mark: float  # what this and the elements around it say
    form: bool  # whether a form says it
    inside: bool  # an article or the main part
    link: bool
    paragraph: bool  # starts a paragraph of its own


class Block(NamedTuple):
    text: str
    paragraph: int
    inner: int  # number of the block element it stands in
    kind: str
    mark: float
    linked: int  # code points of link text


def _word_mark(value: str, inside: bool) -> float:
    good = bad = unsaid = False
    for word in WORDS.findall(value):
        word = word.lower()
        if unsaid or word in WRAPPERS:
            if word in WRAPPERS:
                return 0.0
            unsaid = False
            continue
        unsaid = word in UNSAID
        if word in BAD_WORDS or word.endswith(("nav", "menu")) or any(p in word for p in BAD_PARTS):
            bad = True
        elif word == "header":
            bad = bad or not inside
        elif word in GOOD_WORDS:
            good = True
    return BOILERPLATE if bad else GOOD_WORD if good else 0.0


@functools.lru_cache(4096)
def _own_mark(name: str, attributes: str, inside: bool) -> tuple[float, bool]:
    """What an element says itself, and whether it has a link's address."""
    mark, link = TAGS.get(name, 0.0), False
    if name == "header" and not inside:
        mark = BOILERPLATE
    if attributes and MARKED.search(attributes):
        words = 0.0
        for key, *values in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), html.unescape("".join(values))
            if key in ("class", "id") and name not in ("html", "body"):
                each = [_word_mark(part, inside) for part in value.split()]
                words = min([words, *each]) if min([words, *each]) < 0 else max([words, *each])
            elif key == "role":
                mark = ROLES.get(value.strip().lower(), mark)
            elif key == "itemprop" and value.strip().lower() == "articlebody":
                mark = CONTENT
            elif key == "hidden" or (key == "style" and re.search(r"display\s*:\s*none", value, re.I)):
                words = BOILERPLATE
            elif key == "aria-hidden" and value.strip().lower() == "true" and name in BLOCK:
                words = BOILERPLATE
            elif key == "href":
                link = True
        mark = words if words < 0 else mark or words
    return mark, link


def _entered(parent: Element, name: str, attributes: str, number: int) -> Element:
    own, link = _own_mark(name, attributes, parent.inside)
    mark, form = parent.mark, parent.form
    if own < 0:
        # a form around the whole page says less than the content in it
        mark, form = own, name == "form"
    elif own > 0 and (mark > BOILERPLATE / 2 or form or name == "main"):
        mark, form = max(own, mark), False
    inside = parent.inside or name in ("article", "main")
    return Element(name, number, mark, form, inside, (parent.link or link) if name != "a" else link, name in BLOCK)


class Page:
    """Blocks of a page, and of each block element its parent and depth."""

    def __init__(self) -> None:
        self.stack = [Element("", 0, 0.0, False, False, False, True)]
        self.parents, self.depths = [0], [0]
        self.open: Counter = Counter()
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = 0
        self.paragraph = 0

    def flush(self, paragraph: bool = True) -> None:
        """End the block; with ``paragraph`` also the line it stands in."""
        text = "".join(self.parts)
        if text and not text.isspace():
            kind = next(e.name for e in reversed(self.stack) if e.paragraph)
            inner = self.stack[-1]
            self.blocks.append(Block(text, self.paragraph, inner.number, kind, inner.mark, self.linked))
        elif text and self.blocks and not paragraph and self.blocks[-1].paragraph == self.paragraph:
            last = self.blocks[-1]  # white space between two parts of a line
            self.blocks[-1] = last._replace(text=last.text + text)
        self.parts, self.linked = [], 0
        if paragraph:
            self.paragraph += 1

    def say(self, text: str) -> None:
        if text:
            text = html.unescape(text) if "&" in text else text
            self.parts.append(text)
            if self.stack[-1].link:
                self.linked += len(text)

    def pop_to(self, size: int) -> None:
        if any(e.paragraph for e in self.stack[size:]):
            self.flush()
        elif self.stack[-1].mark != self.stack[size - 1].mark:
            self.flush(paragraph=False)
        for e in self.stack[size:]:
            self.open[e.name] -= 1
        del self.stack[size:]

    def end_before(self, names: set[str], shields: set[str] | frozenset[str]) -> None:
        if not any(self.open[n] for n in names):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].name in names:
                self.pop_to(k)
                return
            if self.stack[k].name in shields:
                return

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.say("\n")
            return
        block = name in BLOCK
        if block and name != "html":
            self.end_before({"p"}, SHIELDS)
        if name in ENDS:
            self.end_before(*ENDS[name])
        if block:
            self.flush()
        if name in VOID:
            return
        number = self.stack[-1].number
        if block:
            self.parents.append(number)
            self.depths.append(self.depths[number] + 1)
            number = len(self.parents) - 1
        entered = _entered(self.stack[-1], name, attributes, number)
        if not block and entered.mark != self.stack[-1].mark:
            self.flush(paragraph=False)
        self.stack.append(entered)
        self.open[name] += 1

    def end(self, name: str) -> None:
        if not self.open[name]:
            if name in BLOCK:
                self.flush()
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].name == name:
                self.pop_to(k)
                return
            if name not in BLOCK and self.stack[k].paragraph:
                return


def parse(page: str) -> Page:
    """The page with its text blocks in page order."""
    made, at = Page(), 0
    while True:
        token = TOKEN.search(page, at)
        if token is None:
            made.say(page[at:])
            break
        made.say(page[at : token.start()])
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name = name.lower()
        if token[1]:
            made.end(name)
        elif name in UNREAD:
            if name in RAW or not token[3].endswith("/"):
                close = CLOSES[name].search(page, at)
                if close:
                    at = close.end()
                elif name in RAW:
                    at = len(page)
        else:
            made.start(name, token[3])
    made.flush()
    return made


def features(block: Block) -> tuple[tuple[str, int], ...]:
    """What the text of a block looks like, apart from the elements that mark it."""
    words = len(block.text.split())
    share = block.linked / max(len(block.text), 1)
    kind = block.kind
    return (
        ("words", min(words.bit_length(), 8)),
        ("links", 0 if not share else 1 + min(int(share * 4), 3)),
        ("ends", int(block.text.rstrip(" \t\r\n\f\"'”»)").endswith((".", "!", "?", "…", "。", ":", ";")))),
        ("kind", 0 if kind == "p" else 1 if kind == "li" else 2 if kind in HEADINGS else 3 if kind in ("td", "th") else 4),
        ("signs", int(SIGNS.search(block.text) is not None)),
    )


def belief(name: str, value: int) -> float:
    """Log-odds of content before anything is counted."""
    if name == "words":
        return min(value - 3.5, 4) / 2
    if name == "links":
        return 0.4 - 0.6 * value
    if name == "ends":
        return 0.7 if value else -0.5
    if name == "kind":
        return (1.0, -0.3, 0.0, -0.3, 0.0)[value]
    return -1.0 if value else 0.0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for page in batch.column("html").to_pylist():
            for block in parse(page or "").blocks:
                if block.mark in (CONTENT, BOILERPLATE):
                    counts[features(block), block.mark > 0] += 1
    single: Counter = Counter()
    for (several, good), n in counts.items():
        for name, value in several:
            single[name, value, good] += n
    yield pa.RecordBatch.from_pylist(
        [{"name": n, "value": v, "good": g, "count": c} for (n, v, g), c in single.items()],
        pa.schema([("name", pa.string()), ("value", pa.int32()), ("good", pa.bool_()), ("count", pa.int64())]),
    )


def learned_odds(pages: DataFrame) -> dict[tuple[str, int], float]:
    """Log-odds of content by feature and value, counted over the plainly marked blocks of all pages.

    Some thirty values. What is counted moves a value by ``LEARNED`` of the way from the stated belief at most, and by less
    while there are few blocks: many pages of one template say how that template looks, not how all text does.
    """
    counted = pages.select("html").mapInArrow(tidied(_count), "name string, value int, good boolean, count long")
    sums = counted.groupBy("name", "value", "good").agg(F.sum("count").alias("count")).collect()  # features x values x 2
    count = {(r.name, r.value, r.good): r["count"] for r in sums}
    total: Counter = Counter()
    for (name, _, good), n in count.items():
        total[name, good] += n
    odds = {}
    for name, value in {k[:2] for k in count}:
        good, bad = count.get((name, value, True), 0), count.get((name, value, False), 0)
        seen = math.log((good + 1) / (total[name, True] + 2)) - math.log((bad + 1) / (total[name, False] + 2))
        seen = max(-FEATURE_MOST, min(FEATURE_MOST, seen))
        n = good + bad if total[name, True] and total[name, False] else 0
        believed = belief(name, value)
        odds[name, value] = believed + LEARNED * n / (n + BELIEF_COUNT) * (seen - believed)
    return odds


class Costs:
    """What blocks say for content (positive) or boilerplate (negative)."""

    def __init__(self, odds: dict[tuple[str, int], float]):
        self.odds, self.known = odds, {}

    def of_text(self, block: Block) -> float:
        seen = features(block)
        if seen not in self.known:
            ones = (self.odds.get(x, belief(*x)) for x in seen)
            total = sum(max(-FEATURE_MOST, min(FEATURE_MOST, one)) for one in ones)
            self.known[seen] = max(-TEXT_MOST, min(TEXT_MOST, total))
        return self.known[seen]

    def __call__(self, blocks: list[Block]) -> list[int]:
        unmarked = OUTSIDE if any(b.mark >= CONTENT for b in blocks) else 0.0
        return [round(SCALE * (self.of_text(b) + (b.mark or unmarked))) for b in blocks]


def block_edges(page: Page) -> list[tuple[int, int, int]]:
    """Edges (i, j, capacity) between blocks that follow each other, and between the next ones of one parent."""
    edges, last, parents, depths = [], {}, page.parents, page.depths
    for j, block in enumerate(page.blocks):
        x = block.inner
        if j:
            y, apart = page.blocks[j - 1].inner, 0
            while x != y:
                if depths[x] >= depths[y]:
                    x = parents[x]
                else:
                    y = parents[y]
                apart += 1
            edges.append((j - 1, j, round(SCALE * ADJACENT / (1 + max(apart - 2, 0)))))
        parent = parents[block.inner]
        i = last.get(parent)
        if i is not None and i < j - 1:
            edges.append((i, j, round(SCALE * SIBLING)))
        last[parent] = j
    return edges


def content_side(costs: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the content in the minimum cut; ties go to the boilerplate.

    Positive costs are capacities from the content terminal, negative ones to the other. Flow is sent along shortest
    paths, all of one length at a time, until the terminals are apart.
    """
    n = len(costs)
    source, sink = [max(c, 0) for c in costs], [max(-c, 0) for c in costs]
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for i, j, capacity in edges:
        out[i].append(len(to))
        to.append(j)
        room.append(capacity)
        out[j].append(len(to))
        to.append(i)
        room.append(capacity)
    while True:
        level = [0 if s else -1 for s in source]
        queue = deque(k for k in range(n) if source[k])
        reached = n + 1
        while queue:
            v = queue.popleft()
            if level[v] >= reached:
                continue
            if sink[v]:
                reached = level[v]
                continue
            for e in out[v]:
                w = to[e]
                if room[e] and level[w] < 0:
                    level[w] = level[v] + 1
                    queue.append(w)
        if reached > n:
            return [x >= 0 for x in level]
        turn = [0] * n
        for first in range(n):
            path: list[int] = []
            v = first
            while source[first]:
                if sink[v]:
                    flow = min(source[first], sink[v], *(room[e] for e in path))
                    source[first] -= flow
                    sink[v] -= flow
                    v, keep = first, 0
                    full = False
                    for k, e in enumerate(path):
                        room[e] -= flow
                        room[e ^ 1] += flow
                        if not room[e] and not full:
                            full, keep = True, k
                    if not full:
                        keep = len(path)
                    del path[keep:]
                    v = to[path[-1]] if path else first
                    if sink[v] or not full:
                        continue
                moved = False
                while turn[v] < len(out[v]):
                    e = out[v][turn[v]]
                    if room[e] and level[to[e]] == level[v] + 1:
                        path.append(e)
                        v = to[e]
                        moved = True
                        break
                    turn[v] += 1
                if moved:
                    continue
                if not path:
                    break
                e = path.pop()
                v = to[e ^ 1]
                turn[v] += 1


def main_text(page: str, costs: Costs) -> str:
    """The text of the blocks on the content's side of the minimum cut."""
    parsed = parse(page)
    blocks = parsed.blocks
    keep = content_side(costs(blocks), block_edges(parsed))
    lines: list[str] = []
    number = None
    for block, stays in zip(blocks, keep, strict=True):
        if stays:
            if block.paragraph == number:
                lines[-1] += block.text
            else:
                lines.append(block.text)
            number = block.paragraph
    return "\n".join(line for line in (" ".join(line.split()) for line in lines) if line)


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    ship(pages.sparkSession)
    costs = Costs(learned_odds(pages))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page or "", costs) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select("page_id", "url", "html")
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return rows.mapInArrow(tidied(extract), f"{kinds}, text string, n_chars long")
