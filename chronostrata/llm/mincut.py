"""Main text of web pages by a minimum cut.

A page becomes its text blocks in page order, with where they stand in the element tree. A block's
class scores make two capacities: to the content terminal and to the boilerplate terminal. Edges between
neighbours on the page, and between blocks and the next block under the same parent or grandparent, cost
what it takes to part them. The minimum cut, found as a maximum flow, labels all blocks at once: a
short line between paragraphs stays with them, a menu stays together.

The scores are fixed numbers stated below; nothing is trained. An `article` or `main` element is worth a
bonus to its blocks, and a malus to blocks outside, that grow with its share of the page's text without
links: the one that holds the text counts in full, teaser cards hardly. Elements that never hold article text
(scripts, styles, forms, menus, footers, asides) cut their blocks off with a capacity no smoothing
outweighs, and so do class, id and role names that say so.

A page is read in one pass over its tags, and costs time in proportion to its length; flows run over the
blocks of one page only. Defined results: a null or empty page has an empty text; a page without tags is
all text. Unclosed elements end with their parent. Columns of the input are kept; `text` and `n_chars`
replace columns of these names.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chronostrata.llm.spans import numbered, pieces

# Contents of these are no text at all.
OPAQUE = frozenset("script style noscript template svg math iframe object head title select option textarea button canvas audio video datalist".split())
# Contents of these are raw up to the closing tag.
RAW = frozenset("script style textarea title noscript template iframe svg select button xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag ends an open element of these kinds without a closing tag.
ENDS_PARAGRAPH = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

BAD_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promos promotion banner popup "
    "modal overlay cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup "
    "login nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside rail footer foot "
    "topbar toolbar comment comments commentlist disqus reply replies respond discussion reactions related "
    "recommended recommendations share sharing social follow tags pagination pager widget widgets copyright legal "
    "disclaimer skip search form complementary contentinfo".split()
)
HEADER_NAMES = frozenset("header masthead".split())
# Names that tell the state of a layout, not what an element holds.
STATES = ("has-", "with-", "no-", "is-", "without-")
# Names that file an article under a subject.
SUBJECTS = ("tag-", "category-", "format-", "type-", "status-", "topic-")
GOOD_NAMES = frozenset("article content main story post entry body text prose".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\shidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
NAME_PART = re.compile(r"[a-z]+")

HARD = 1000.0
MAIN_BONUS, OUTSIDE_MALUS = 2.5, 1.5
NEXT_EDGE, SIBLING_EDGE, COUSIN_EDGE = 0.8, 0.6, 0.2


def _judge(attributes: str, inside: bool, article: bool = False) -> int:
    """-1: the names of the element say boilerplate; 1: they say content; 0: neither. `inside` the main
    element a header is the article's own. An `article` is named by the first part of a name."""
    if not attributes:
        return 0
    if HIDDEN.search(attributes):
        return -1
    good = False
    for found in NAMES.finditer(attributes):
        value = re.sub(r"([a-z])([A-Z])", r"\1-\2", found[1] or found[2] or found[3] or "").lower()
        for name in value.split():
            if name.startswith(STATES) or article and name.startswith(SUBJECTS):
                continue
            parts = NAME_PART.findall(name)[: 1 if article else None]
            if any(p in BAD_NAMES or p in HEADER_NAMES and not inside for p in parts):
                return -1
            good = good or any(p in GOOD_NAMES for p in parts)
    return int(good)


class Block:
    __slots__ = ("bad", "good", "grand", "heading", "linked", "main", "parent", "text")

    def __init__(self, text: str, linked: int, bad: bool, main: tuple[int, ...], good: bool, heading: bool, parent: int, grand: int):
        self.good = good
        self.text, self.linked, self.bad, self.main = text, linked, bad, main
        self.heading, self.parent, self.grand = heading, parent, grand


def blocks(html: str) -> list[Block]:
    """Text blocks of a page, in order."""
    out: list[Block] = []
    # Of each open element: name, number, boilerplate, main elements it is in, inside opaque, named as content.
    stack: list[tuple[str, int, bool, tuple[int, ...], bool, bool]] = [("", 0, False, (), False, False)]
    number, held, linked, links, heading = 0, [], 0, 0, False
    place = stack[0]
    at, end = 0, len(html)

    def flush() -> None:
        nonlocal held, linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                name, parent, bad, main, _, good = place
                grand = stack[-2][1] if len(stack) > 1 and stack[-1][1] == parent else parent
                out.append(Block(text, min(linked, len(text)), bad, main, good, heading or name in HEADINGS, parent, grand))
        held, linked = [], 0

    def say(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1][4]:
            said = unescape(raw) if "&" in raw else raw
            held.append(said)
            if links:
                linked += len(said)

    def close(depth: int) -> None:
        nonlocal links, place, heading
        for name, *_ in stack[depth:]:
            links -= name == "a"
            heading = heading and name not in HEADINGS
        del stack[depth:]

    while at < end:
        found = TAG.search(html, at)
        if found is None:
            say(html[at:])
            break
        say(html[at : found.start()])
        at = found.end()
        if found[2] is None:
            if found[0].startswith("<![CDATA["):
                say(found[0][9:].removesuffix("]]>"))
            continue
        name = found[2].lower()
        block = name not in INLINE
        if found[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                if block:
                    flush()
                close(depth)
                if block:
                    place = _holder(stack)
            continue
        if block:
            flush()
            if name in ENDS_PARAGRAPH:
                open_p = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] not in INLINE), 0)
                if open_p and stack[open_p][0] == "p":
                    close(open_p)
            for same in SAME_KIND.get(name, ()):
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] not in INLINE), 0)
                if depth and stack[depth][0] == same:
                    close(depth)
            place = _holder(stack)
        if name in VOID:
            continue
        attributes = found[3]
        if attributes.endswith("/") and not block:
            continue
        if name in RAW:
            stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(html, at)
            at = stop.end() if stop else end
            continue
        number += 1
        _, _, bad, main, opaque, good = stack[-1]
        if name in MAIN:
            main = (*main[-7:], number)
        judged = _judge(attributes, bool(main), name == "article")
        bad = bad or name in BOILERPLATE or judged < 0 and name not in ("html", "body", "main")
        # The page's own header is boilerplate, an article's holds its headline.
        bad = bad or name == "header" and not main
        stack.append((name, number, bad, main, opaque or name in OPAQUE, good or judged > 0))
        links += name == "a"
        if block:
            heading = heading or name in HEADINGS
            place = stack[-1]
    flush()
    return out


def _holder(stack: list) -> tuple:
    """The innermost open element that is no inline one."""
    return next(s for s in reversed(stack) if s[0] not in INLINE)


def main_shares(found: list[Block]) -> dict[int, float]:
    """How much of the page's text without links each main element holds."""
    held: Counter[int] = Counter()
    for b in found:
        if not b.bad:
            held.update(dict.fromkeys((0, *b.main), len(b.text) - b.linked))
    return {n: held[n] / max(1, held[0]) for n in held if n}


def capacities(block: Block, shares: dict[int, float]) -> tuple[float, float]:
    """Cost of calling the block boilerplate, and of calling it content."""
    if block.bad:
        return 0.0, HARD
    size, share = len(block.text), block.linked / max(1, len(block.text))
    stops = sum(block.text.count(c) for c in ".!?,;:")
    content = 0.3 + min(size, 200) / 80 + min(stops, 6) * 0.25 + (0.6 if block.heading else 0.0) + (1.5 if block.good else 0.0)
    boiler = 0.9 + 4.0 * share + (0.6 if size < 25 and not block.heading and not stops else 0.0)
    # An element with half of the text counts in full.
    if block.main:
        content += MAIN_BONUS * min(1.0, 2 * shares[block.main[-1]])
    else:
        boiler += OUTSIDE_MALUS * min(1.0, 2 * max(shares.values(), default=0.0))
    return content * (1 - share), boiler


def min_cut(costs: list[tuple[float, float]], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the blocks on the content side of the minimum cut (maximum flow, level graphs)."""
    n = len(costs)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    at: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, forth: float, back: float) -> None:
        at[a].append(len(to)), to.append(b), room.append(forth)
        at[b].append(len(to)), to.append(a), room.append(back)

    for i, (content, boiler) in enumerate(costs):
        through = min(content, boiler)  # flows straight from source to sink
        if content > through:
            link(source, i, content - through, 0.0)
        if boiler > through:
            link(i, sink, boiler - through, 0.0)
    for a, b, weight in edges:
        link(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in at[a]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(n)]
        following = [0] * (n + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                first = next(i for i, e in enumerate(path) if room[e] <= 1e-9)
                a = to[path[first] ^ 1]
                del path[first:]
                continue
            while following[a] < len(at[a]):
                e = at[a][following[a]]
                if room[e] > 1e-9 and level[to[e]] == level[a] + 1:
                    path.append(e)
                    a = to[e]
                    break
                following[a] += 1
            else:
                if a == source:
                    break
                level[a] = -1
                a = to[path.pop() ^ 1]


def edges_of(found: list[Block]) -> list[tuple[int, int, float]]:
    """Neighbours on the page, and each block with the next one under its parent and grandparent."""
    out = [(i, i + 1, NEXT_EDGE) for i in range(len(found) - 1)]
    for level, weight in (("parent", SIBLING_EDGE), ("grand", COUSIN_EDGE)):
        last: dict[int, int] = {}
        for i, b in enumerate(found):
            key = getattr(b, level)
            if key in last:
                out.append((last[key], i, weight))
            last[key] = i
    return out


def main_text(html: str | None) -> str:
    """The main text of one page."""
    found = blocks(html or "")
    if not found:
        return ""
    if "<" not in html:
        return found[0].text
    shares = main_shares(found)
    content = min_cut([capacities(b, shares) for b in found], edges_of(found))
    return " ".join(b.text for b, keep in zip(found, content, strict=True) if keep)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """All columns but the page source, with `text` and `n_chars`."""
    keep = [f for f in pages.schema.fields if f.name not in (html, "text", "n_chars")]
    schema = T.StructType([*keep, T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, len(keep)):
            texts = [main_text(x) for x in part.column(len(keep)).to_pylist()]
            columns = [part.column(i) for i in range(len(keep))]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return numbered(pages, [*[f.name for f in keep], html]).mapInArrow(run, schema)
