"""Main text of web pages by a tree-structured graphical model over the blocks of the DOM.

Every block element is a node that is content or not. A node's state depends on its parent's by a potential of its tag, and
shows in what can be seen of it: tag, class and id words, length, links, sentences. The potentials are counted on labelled
pages; on a page, sum-product messages go up from the leaves and down from the root, and the marginals decide.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txguard import workspace

SAMPLE = 4000  # pages that the potentials are counted on, at most
SLOTS = 4096  # features and tags are hashed into so many
SEED_WEIGHT = 20  # a hand-labelled page counts as so many others
SMOOTH = 10.0  # pages of each state that are taken to show every feature

# How HTML treats these elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr br img".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())  # text up to their end tag, or to the end
HIDDEN = frozenset("svg button select canvas template".split())  # left out when they are closed; unclosed, their text stays
SEEN_THROUGH = INLINE | {"object", "noscript"}
FOREIGN = frozenset("svg math annotation style script".split())  # no HTML right inside; style and script only below svg or math
HTML_INSIDE = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())  # elements of svg and math
LEAVES_FOREIGN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu "
                           "meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                     "header hr main menu nav ol p pre section table ul".split())
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table html body".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<![^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\s++|/(?!>)|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+)?)?)*+)(/?)(?:>|\Z)", re.S)
MARKS = re.compile(r"""\b(class|id|role|data-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
LABELLED = r"(?i)<(?:article|main)(?:[\s/>]|$)"
# Words of class, id and role that are no main text when they stand inside an article, or around one.
NO_TEXT = frozenset("comment comments reply replies respond discussion ad ads advert adverts advertisement advertising sponsored promo "
                    "cookie cookies consent sidebar widget newsletter subscribe signup popup related share social".split())
SENTENCE = re.compile(r"[.!?]")

# Hand-labelled pages: what the contract counts as main text (data-label=1) and what not, in other layouts than <article>.
SEEDS = (
    "<body><header class='site-header'><h1>Name</h1><p>All the news of the day.</p></header><div id=content class='post entry' "
    "data-label=1><h2>Some title of it</h2><p>A first sentence, and a second one. It goes on for a while, and ends here.</p><p>Another "
    "paragraph of the text follows, with several words. It ends too.</p></div><div id=sidebar class='sidebar widget'><ul><li><a>Old"
    "</a></li><li><a>New</a></li></ul></div><footer class=footer><p>Copyright, all rights reserved.</p></footer></body>",
    "<body><div class='menu navbar'><ul><li><a>Home</a></li><li><a>About</a></li></ul></div><div class='cookie notice banner'>This site "
    "uses cookies.</div><main data-label=1><h1>Title of the page</h1><p>The text starts here, and it has some length. There is more."
    "</p><ul><li>One point of the list, in words.</li><li>Another point of it.</li></ul></main><div class='comments' id=comments><h3>"
    "Comments</h3><div class=comment><p>I liked this text. Thanks for it.</p></div></div><form><p>Your mail</p></form></body>",
    "<body><nav><ul><li><a>Up</a></li></ul></nav><div class='ad advert promo sponsored'>Buy this now.</div><div class=wrapper><section "
    "class='article-body main text' data-label=1><p>Long sentences make the body of a page, as in this one. They follow each other.</p>"
    "<blockquote><p>Somebody said this, and it is quoted here.</p></blockquote><table><tr><td>Cell one of it</td><td>Cell two</td></tr>"
    "</table></section><aside class='related links'><p><a>See this as well</a></p></aside></div><div class='bottom footer legal'><p>"
    "Imprint and terms.</p></div></body>",
    "<body><article data-label=1><header><h1>Heading of an article</h1></header><p>It begins with a sentence of some words. It goes on."
    "</p><div class='body'><p>More of the same, in a block of its own. It has an end.</p></div></article><section class='comments reader "
    "replies discussion'><div class=comment><p>A reader wrote this. It is long, too, and has sentences.</p></div></section><div "
    "class='newsletter subscribe signup popup'>Get our letter.</div></body>",
)


@dataclass
class Page:
    """Block elements in page order. ``pieces`` are the text blocks: owner and text."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    marks: list[list[str]] = field(default_factory=lambda: [[]])
    labels: list[bool | None] = field(default_factory=lambda: [None])
    pieces: list[tuple[int, str]] = field(default_factory=list)
    linked: Counter = field(default_factory=Counter)


@dataclass
class Mark:
    """An open element that is no node, and what the page was before it. ``floor`` and ``wall``: nodes below stay open inside."""

    name: str
    hidden: bool
    floor: int  # for start tags that end a block, and </p>
    wall: int  # for all tags
    depth: int
    nodes: int
    pieces: int
    text: list[str]
    texts: int
    links: int
    linked: int


def parse(source: str) -> Page:
    """The blocks of a page, also of one that is cut off or not well formed. Only block elements become nodes.

    Scripts, forms of raw text, and closed elements of ``HIDDEN`` are left out. Formulas and what stands in for objects and
    scripts are text like any other.
    """
    page, stack, at, size = Page(), [0], 0, len(source)
    text: list[str] = []
    links = 0
    marks: list[Mark] = []

    def flush() -> None:
        nonlocal text
        joined = "".join(text)
        text = []  # marks may hold the old list
        if joined:
            plain = " ".join((html.unescape(joined) if "&" in joined else joined).split())
            if plain:
                page.pieces.append((stack[-1], plain))

    def cut(depth: int) -> None:
        del stack[depth:]
        while marks and marks[-1].depth > depth:
            marks.pop()

    def open_mark(name: str, hidden: bool) -> None:
        depth = len(stack)
        floor, wall = (marks[-1].floor, marks[-1].wall) if marks else (0, 0)
        marks.append(Mark(
            name, hidden, depth if name in ("button", "select", "template") else floor, depth if name == "template" else wall,
            depth, len(page.tags), len(page.pieces), text, len(text), links, page.linked[stack[-1]]))

    def close_mark(name: str) -> bool:
        nonlocal text, links
        for i in range(len(marks) - 1, -1, -1):
            mark = marks[i]
            if mark.name != name:
                continue
            del marks[i:]
            if not mark.hidden:
                if len(stack) > mark.depth:
                    flush()
                    del stack[mark.depth:]
                return True
            del stack[mark.depth:]
            for node in range(mark.nodes, len(page.tags)):
                page.linked.pop(node, None)
            for column in (page.tags, page.parents, page.marks, page.labels):
                del column[mark.nodes:]
            del page.pieces[mark.pieces:]
            text, links, page.linked[stack[-1]] = mark.text, mark.links, mark.linked
            del text[mark.texts:]
            text.append(" ")
            return True
        return False

    while at < size:
        found = TOKEN.search(source, at)
        start = found.start() if found else size
        if start > at:
            text.append(source[at:start])
            if links:
                page.linked[stack[-1]] += start - at
        if not found:
            break
        at = found.end()
        ends, tag = found[1], (found[2] or "").lower()
        if not tag:
            continue
        foreign = bool(marks) and marks[-1].name in FOREIGN
        if foreign and (tag == "p" if ends else tag in LEAVES_FOREIGN):
            while marks and marks[-1].name in FOREIGN:
                marks.pop()
            foreign = False
        if ends and marks and close_mark(tag):
            continue
        if foreign and not ends:
            if not found[4] and (tag in FOREIGN or tag in HTML_INSIDE):
                open_mark(tag, tag not in HTML_INSIDE - {"annotation-xml"} and tag != "math")
            continue
        if tag in SEEN_THROUGH:
            if tag == "a":
                links = 0 if ends else 1
            elif tag == "br":
                text.append(" ")
            continue
        if not ends and tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            at = closing.end() if closing else size
            text.append(" ")
            continue
        if tag in HIDDEN or tag == "math":
            if ends or found[4] and tag in FOREIGN:
                text.append(" ")
                continue
            if tag in ("button", "select"):  # one inside another ends it
                last = next((m for m in reversed(marks) if m.name == tag), None)
                if last and last.depth > last.wall:
                    if len(stack) > last.depth:
                        flush()
                    del marks[marks.index(last):]
                    cut(last.depth)
            open_mark(tag, tag in HIDDEN)
            continue
        floor, wall = (marks[-1].floor, marks[-1].wall) if marks else (0, 0)
        flush()
        links = 0
        if ends:
            for i in range(len(stack) - 1, max(0, (floor if tag == "p" else wall) - 1), -1):
                if page.tags[stack[i]] == tag:
                    cut(i)
                    break
            continue
        top = page.tags[stack[-1]]
        if top == "p" and tag in CLOSES_P and len(stack) > floor:
            cut(len(stack) - 1)
        elif tag in ENDED_BY:
            for i in range(len(stack) - 1, max(0, (wall if tag in ("tr", "td", "th") else floor) - 1), -1):
                if page.tags[stack[i]] in ENDED_BY[tag]:
                    cut(i)
                    break
                if page.tags[stack[i]] in SCOPES:
                    break
        words, label = [], None
        rest = found[3]
        if rest:
            for name, *values in MARKS.findall(rest):
                value = "".join(values).lower()
                if name.lower() == "data-label":
                    label = value == "1"
                else:
                    words += WORD.findall(value)
        page.tags.append(tag)
        page.parents.append(stack[-1])
        page.marks.append(words)
        page.labels.append(label)
        if tag not in VOID:
            stack.append(len(page.tags) - 1)
    flush()
    return page


def _slot(name: str) -> int:
    return zlib.crc32(name.encode()) % SLOTS


def evidence(page: Page) -> list[list[int]]:
    """Slots of what shows of each node: its tag, marks, own text and, with all below it, length, links and sentences."""
    n = len(page.tags)
    own, total, links, ends = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text in page.pieces:
        own[node] += len(text)
        ends[node] += len(SENTENCE.findall(text))
    for node in range(n - 1, -1, -1):
        total[node] += own[node]
        links[node] += page.linked[node]
        if node:
            up = page.parents[node]
            total[up] += total[node]
            links[up] += links[node]
            ends[up] += ends[node]
    out = []
    for node in range(n):
        size = total[node]
        density = min(4, int(5 * links[node] / size)) if size else 5
        seen = [f"tag {page.tags[node]}", f"size {min(8, size.bit_length() // 2)}", f"links {density}",
                f"ends {min(4, ends[node])}", f"own {min(6, own[node].bit_length() // 2)}"]
        out.append([_slot(s) for s in seen] + [_slot(f"mark {m}") for m in set(page.marks[node])])
    return out


def true_states(page: Page, marked: bool) -> list[int] | None:
    """States of a labelled page: below a marked block, or below ``article`` or ``main``; None if it has no such block.

    Inside an article, notices, adverts and comments by their marks are no content, nor are articles in an article, in
    ``aside`` or ``nav``, or below such marks: those are comments and teasers.
    """
    states, any_content = [], False
    outside = ("nav", "footer", "aside", "form", "head")
    barred, in_article = [False] * len(page.tags), [False] * len(page.tags)  # no article in here counts; one has begun
    for node, tag in enumerate(page.tags):
        above = page.parents[node]
        up = states[above] if node else 0
        if marked:
            inside = up if page.labels[node] is None else page.labels[node]
        else:
            odd = tag not in ("html", "body", "main") and not NO_TEXT.isdisjoint(page.marks[node])
            nested = tag == "article" and node and in_article[above]
            barred[node] = tag != "main" and bool(node and barred[above] or odd or nested or tag in ("nav", "aside"))
            in_article[node] = bool(tag == "article" or node and in_article[above])
            inside = not barred[node] and (tag in ("article", "main") or (up and tag not in outside))
        states.append(int(inside or 0))
        any_content |= bool(inside)
    return states if any_content else None


def tally(page: Page, states: list[int], counts: Counter, weight: int = 1) -> None:
    """Add a labelled page: (1, slot, state) for evidence, (0, slot of the tag, parent's state, state) for transitions."""
    for node, slots in enumerate(evidence(page)):
        state = states[node]
        for slot in slots:
            counts[1, slot, 0, state] += weight
        counts[2, 0, 0, state] += weight
        up = states[page.parents[node]] if node else 0
        counts[0, _slot("tag " + page.tags[node]), up, state] += weight


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for source in batch.column("html").to_pylist():
            page = parse(source or "")
            states = true_states(page, False)
            if states:
                tally(page, states, counts)
    if counts:
        columns = [list(c) for c in zip(*counts)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32()) for c in columns] + [pa.array(list(counts.values()), pa.int64())],
            names=["kind", "slot", "up", "state", "n"])


class Potentials:
    """Logs of smoothed shares: ``seen[slot]`` for both states, ``moves[slot of the tag]`` for parent's and own state."""

    def __init__(self, counts: dict):
        nodes = [counts.get((2, 0, 0, s), 0) for s in (0, 1)]
        self.seen, self.moves = {}, {}
        for slot in {k[1] for k in counts if k[0] == 1}:
            self.seen[slot] = tuple(math.log((counts.get((1, slot, 0, s), 0) + SMOOTH) / (nodes[s] + 2 * SMOOTH)) for s in (0, 1))
        every = [[sum(n for k, n in counts.items() if k[0] == 0 and k[2:] == (u, s)) for s in (0, 1)] for u in (0, 1)]
        usual = [[(every[u][s] + SMOOTH) / (sum(every[u]) + 2 * SMOOTH) for s in (0, 1)] for u in (0, 1)]
        self.usual = usual
        for slot in {k[1] for k in counts if k[0] == 0}:
            own = [[counts.get((0, slot, u, s), 0) for s in (0, 1)] for u in (0, 1)]
            self.moves[slot] = [[(own[u][s] + 2 * usual[u][s]) / (sum(own[u]) + 2) for s in (0, 1)] for u in (0, 1)]

    def marginals(self, page: Page) -> list[float]:
        """Probability that each node is content."""
        n = len(page.tags)
        local, moves = [], []
        for node, slots in enumerate(evidence(page)):
            a = b = 0.0
            for slot in slots:
                known = self.seen.get(slot)
                if known:
                    a += known[0]
                    b += known[1]
            top = max(a, b)
            local.append((math.exp(max(a - top, -60.0)), math.exp(max(b - top, -60.0))))
            moves.append(self.moves.get(_slot("tag " + page.tags[node]), self.usual))
        # Up: what everything below a node says about its parent's state.
        below = [list(x) for x in local]
        up = [(1.0, 1.0)] * n
        for node in range(n - 1, 0, -1):
            b0, b1 = below[node]
            m = moves[node]
            u0, u1 = m[0][0] * b0 + m[0][1] * b1, m[1][0] * b0 + m[1][1] * b1
            scale = max(u0, u1)
            u0, u1 = max(u0 / scale, 1e-30), max(u1 / scale, 1e-30)
            up[node] = (u0, u1)
            parent = below[page.parents[node]]
            parent[0] *= u0
            parent[1] *= u1
            scale = max(parent)
            parent[0], parent[1] = max(parent[0] / scale, 1e-30), max(parent[1] / scale, 1e-30)
        # Down: what everything else says about a node's state. The root is no content.
        belief: list[tuple[float, float]] = [(1.0, 0.0)] * n
        for node in range(1, n):
            p0, p1 = belief[page.parents[node]]
            p0, p1 = p0 / up[node][0], p1 / up[node][1]
            m, (b0, b1) = moves[node], below[node]
            s0, s1 = (p0 * m[0][0] + p1 * m[1][0]) * b0, (p0 * m[0][1] + p1 * m[1][1]) * b1
            both = s0 + s1
            belief[node] = (s0 / both, s1 / both) if both > 0 else (0.5, 0.5)
        return [b[1] for b in belief]


def main_text(source: str, model: Potentials) -> str:
    """The blocks that are content, one per line."""
    page = parse(source)
    sure = model.marginals(page)
    return "\n".join(text for node, text in page.pieces if sure[node] >= 0.5)


def seeds() -> Counter:
    counts: Counter = Counter()
    for source in SEEDS:
        page = parse(source)
        tally(page, true_states(page, True), counts, SEED_WEIGHT)
    return counts


def fit(pages: DataFrame, page: str = "page_id", source: str = "html", sample: int = SAMPLE) -> dict:
    """Counts behind the potentials: the hand-labelled pages, and at most ``sample`` pages with an ``article`` or ``main``.

    The sample are those of them with the smallest hashes of their id. What reaches the driver is bounded by the slots.
    """
    order = F.xxhash64(F.col(page).cast("string"))
    pages = pages.where(F.col(source).rlike(LABELLED))
    last = pages.select(order.alias("o")).orderBy("o").limit(sample).agg(F.max("o")).first()[0]
    chosen = pages.where(order <= F.lit(last).cast("long")).select(F.col(source).alias("html"))
    found = chosen.mapInArrow(_count, "kind int, slot int, up int, state int, n long")
    stored = workspace.write_table(found.groupBy("kind", "slot", "up", "state").agg(F.sum("n").alias("n")),
                                   workspace.new_path(pages.sparkSession, "html"))
    counts = seeds()
    for r in stored.collect():
        counts[r["kind"], r["slot"], r["up"], r["state"]] += r["n"]
    return dict(counts)


def _extractor(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Potentials(shared.value)
        for batch in batches:
            texts = [main_text(s or "", model) for s in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, page: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``url``, ``text``, ``n_chars``.

    Null and empty pages have an empty text; so have pages without content. Repeated rows come out alike; other columns
    are ignored; an empty table gives an empty one.
    """
    shared = pages.sparkSession.sparkContext.broadcast(fit(pages, page, source))  # bounded by the slots
    rows = pages.select(F.col(page).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(_extractor(shared), f"page_id {kinds['page_id']}, url string, text string, n_chars long")
