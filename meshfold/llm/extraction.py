"""Main text of HTML pages: blocks labelled content or boilerplate by a minimum cut."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from meshfold.llm.common import bounded_scan, text_slices

# Element names by their part in a page.
RAW = frozenset("script style textarea title iframe".split())
#: Elements whose text isn't shown as text; blocks in them are boilerplate. One that nothing closes later in the page marks nothing.
INERT = frozenset("noscript template svg object select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
BOILERPLATE = frozenset("nav footer aside form menu button dialog head fieldset".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th".split())
#: Start tags that close an open element of the same kind, and what keeps them from looking further out.
SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ()}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[/a-zA-Z][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"\"[^\"]*\"|'[^']*'|([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_BAD = re.compile(
    r"(?<![a-z])(?:nav|navbar|navigation|menu|menubar|breadcrumbs?|footer|foot|sidebar|side-?bar|aside|ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|"
    r"cookies?|consent|gdpr|notices?|notifications?|alert|popup|modal|overlay|share|sharing|social|related|recommended|comments?|respond|replies|disqus|"
    r"subscribe|newsletter|signup|login|search|toolbar|widget|masthead|topbar|copyright|legal|disclaimer|tags|pager|pagination|skip|hidden|contentinfo|complementary)(?![a-z])", re.I)
#: Parts of a class that says what an element is filed under or stands beside, not what it is.
_ABOUT = frozenset("category cat tag has no not with without".split())
_GOOD = re.compile(r"(?<![a-z])(?:article|story|post|entry|main|content|body|text)(?![a-z])", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# Costs, in hundredths. A hint of boilerplate weighs more than all edges of a block together.
HINT_BAD, HINT_GOOD, IN_ARTICLE, HEADER, LINKED, ENDED, ADJACENT, SIBLING = 2000, 300, 700, 400, 500, 80, 200, 150
# Without an article element, a block's cost rises with its length from the first value by the second a character, up to the third.
BARE, CHARACTER, FULL = -160, 3, 160


@dataclass(slots=True)
class Block:
    """A run of text between block boundaries: where it is in the tree and what is known of it."""

    text: str
    parent: int
    depth: int
    bad: bool
    hinted: bool
    article: bool
    header: bool
    good: int
    linked: int


@dataclass(slots=True)
class _Open:
    name: str
    number: int
    bad: bool
    hinted: bool
    article: bool
    header: bool
    good: int
    link: bool
    inert: bool = False


def _hint_bad(value: str) -> bool:
    """Whether a name in a class, id or role hints at boilerplate."""
    return bool(_BAD.search(value)) and any(_BAD.search(x) and _ABOUT.isdisjoint(x.lower().split("-")) for x in value.split())


def blocks(page: str) -> list[Block]:
    """The blocks of a page in its order, character references decoded and white space made one space."""
    out: list[Block] = []
    stack = [_Open("", 0, False, False, False, False, 0, False)]
    opened: dict[str, int] = {}
    parts: list[str] = []
    linked, number, at, end = 0, 0, 0, len(page)
    closed: dict[str, int] = {}  # where the last end tag of an inert element is

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            top, *outer = (x for x in reversed(stack) if x.name in BLOCK or not x.name)
            holder = outer[0] if outer and top.name in LEAVES else top
            out.append(Block(text, holder.number, len(stack), top.bad, top.hinted, top.article, top.header, top.good, linked))
        parts.clear()
        linked = 0

    def close(name: str) -> None:
        while True:
            top = stack.pop()
            opened[top.name] -= 1
            if top.name == name:
                return

    while at < end:
        found = _TAG.search(page, at)
        chunk = page[at : found.start() if found else end]
        if chunk and not stack[-1].inert:
            text = html.unescape(chunk) if "&" in chunk else chunk
            parts.append(text)
            if stack[-1].link:
                linked += len(text)
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            if opened.get(name):
                if name in BLOCK:
                    flush()
                close(name)
            elif name in BLOCK:
                flush()
            continue
        if name in RAW:
            if not found[3].endswith("/"):
                closing = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
                at = closing.end() if closing else end
            parts.append(" ")
            continue
        if name in BLOCK:
            flush()
            if opened.get("p"):
                close("p")
            if name in SIBLINGS and opened.get(name):
                for x in reversed(stack):
                    if x.name == name:
                        close(name)
                        break
                    if x.name in SIBLINGS[name]:
                        break
        elif name == "br":
            parts.append(" ")
        if name in VOID or found[3].endswith("/") and name not in BLOCK:
            continue
        number += 1
        top = stack[-1]
        inert = False
        if name in INERT:
            if name not in closed:
                closed[name] = max((x.start() for x in re.finditer(rf"</{name}(?![^\s/>])", page, re.I)), default=-1)
            inert = closed[name] >= at
            parts.append(" ")
        bad, hint, good = top.bad or inert or name in BOILERPLATE, False, top.good
        if found[3]:
            for key, *values in _ATTRIBUTE.findall(found[3]):
                key, value = key.lower(), "".join(values)
                if key == "style":
                    bad |= bool(_HIDDEN.search(value))
                elif key == "hidden" or key == "aria-hidden":
                    bad |= value.lower() != "false"
                elif key in ("class", "id", "role") and name not in ("html", "body"):
                    value = value.replace("_", "-")
                    hint |= _hint_bad(value)
                    good = min(2, good + bool(_GOOD.search(value)))
        own = name in ("article", "main")  # a hint on these says nothing; one around them is weighed in main_text
        article, hinted = top.article or own, top.hinted or hint and not top.article and not own
        bad |= hint and top.article and not own
        stack.append(_Open(name, number, bad, hinted, article, top.header or name == "header", good, top.link or name == "a", inert or top.inert and name not in BLOCK))
        opened[name] = opened.get(name, 0) + 1
    flush()
    return out


def terminal(block: Block, any_article: bool) -> int:
    """The cost of calling a block boilerplate minus that of calling it content."""
    n = len(block.text)
    cost = IN_ARTICLE if block.article else -IN_ARTICLE if any_article else BARE + CHARACTER * min(n, FULL)
    cost += HINT_GOOD * block.good - HINT_BAD * block.bad
    if block.header and not block.article:
        cost -= HEADER
    share = min(1.0, block.linked / n)
    if share > 0.3 and not (block.article and n > 80):
        cost -= round(LINKED * share)
    if block.text[-1] in ".!?…\"'»”)":
        cost += ENDED
    return cost


def edges(found: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges (i, j, capacity): neighbours in page order, weaker the further apart in the tree, and the next block of the same
    parent."""
    out, last = [], {}
    for i, b in enumerate(found):
        if i:
            before = found[i - 1]
            apart = abs(b.depth - before.depth) + (b.parent != before.parent) + 3 * (b.bad != before.bad or b.article != before.article)
            out.append((i - 1, i, ADJACENT // (1 + apart)))
        if b.parent in last and last[b.parent] != i - 1:
            out.append((last[b.parent], i, SIBLING))
        last[b.parent] = i
    return out


def content_side(costs: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes stay with the source in a minimum cut; max-flow by levels and blocking flows.

    Node i is joined to the source by max(cost, 0), to the sink by max(-cost, 0), and to other nodes by ``links``.
    """
    n = len(costs)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]  # numbers of arcs; arc k runs back as k ^ 1
    to, room = [], []

    def arc(a: int, b: int, forth: int, back: int) -> None:
        graph[a].append(len(to))
        to.append(b)
        room.append(forth)
        graph[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, c in enumerate(costs):
        if c > 0:
            arc(source, i, c, 0)
        elif c < 0:
            arc(i, sink, -c, 0)
    for a, b, c in links:
        arc(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, [source]
        for x in queue:
            for k in graph[x]:
                if room[k] and level[to[k]] < 0:
                    level[to[k]] = level[x] + 1
                    queue.append(to[k])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        next_, path, x = [0] * (n + 2), [], source
        while True:
            if x == sink:
                flow = min(room[k] for k in path)
                for k in path:
                    room[k] -= flow
                    room[k ^ 1] += flow
                cut = next(p for p, k in enumerate(path) if not room[k])
                x = to[path[cut] ^ 1]
                del path[cut:]
                continue
            arcs = graph[x]
            while next_[x] < len(arcs):
                k = arcs[next_[x]]
                if room[k] and level[to[k]] == level[x] + 1:
                    path.append(k)
                    x = to[k]
                    break
                next_[x] += 1
            else:
                if x == source:
                    break
                level[x] = -2
                x = to[path.pop() ^ 1]


def main_text(page: str) -> str:
    """The content blocks of a page, one a line."""
    found = blocks(page)
    plain = any(b.article and not b.bad and not b.hinted for b in found)
    for b in found:  # a hint around an article holds only if the page has another one
        b.bad |= b.hinted and (plain or not b.article)
    any_article = any(b.article and not b.bad for b in found)
    keep = content_side([terminal(b, any_article) for b in found], edges(found))
    return "\n".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """(page_id, url, text) for each row of ``pages``, each page by itself and whole.

    Null or empty pages, and those without content, give an empty text; broken and cut-off markup is read as far as it goes; repeated
    rows come out as often as they are; an empty table gives an empty result; further columns are not read.
    """
    table = pages.selectExpr(f"`{page_id}` AS page_id", f"`{url}` AS url", f"`{page}` AS html")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch, "html"):
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array([main_text(t.decode()) for t in texts], pa.string())], ["page_id", "url", "text"])

    schema = table.withColumnRenamed("html", "text").schema
    return bounded_scan(table, "page_id", "url", "html").mapInArrow(scan, schema)


def op10_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).selectExpr("page_id", "url", "text", "CAST(length(text) AS long) AS n_chars")
