"""Main text of web pages by minimum-cut labelling.

A page is cut into text blocks at its block-level elements. A linear classifier gives each block a score from its tags,
the classes and ids around it, its length and its links; positive scores become capacities from the source (content),
negative ones capacities to the sink (boilerplate). What speaks for content in all ancestors together is bounded, and what
a class, id, role or form speaks against it is discounted by the share of the page's unlinked text the element holds: a
wrapper of the whole page is no sidebar, whatever its class says. A class that is a noise word in full is only discounted
where the element also holds a main heading or the page's largest article. Smoothness edges join blocks that follow each
other, weaker the further apart they are in the element tree, and more so blocks that follow each other inside one
container: a doubtful block goes with its neighbours. A maximum flow then separates content from boilerplate at the least cost.

Defined results: a null or empty page has no text. Broken markup is read as far as it goes: unclosed elements end with
their container (a script or style without an end is code up to the page's end, as in browsers), unknown character
references stay as they are, a page without any content has empty text. What is no text of the page (``OPAQUE_TAGS``) is
nested like other elements; a head also ends at the first thing that belongs to a body, and svg and math end at a tag of
HTML, or at once if they close themselves. Pages are independent: equal rows give equal results, rows without or with
the same page_id one result each, an empty table an empty result. A very long page is read whole, in time and memory that
follow its length times its depth. Blocks whose cut costs the same either way count as boilerplate. Columns are taken by
name; others, whatever they are called, are not read.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, functions as F

BLOCK_TAGS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option
p pre section select summary table tbody td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page.
OPAQUE_TAGS = frozenset("script style noscript template iframe object svg math canvas audio video textarea title head".split())
RAW_TAGS = "script style textarea title".split()  # up to their end tag nothing is markup
HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title head html".split())
FOREIGN_TAGS = frozenset(["svg", "math"])
#: Parts of foreign elements that hold HTML, and tags that end a foreign element because they are HTML.
_ISLANDS = frozenset("foreignobject desc annotation-xml mtext mi mo mn ms".split())
_HTML_ONLY = BLOCK_TAGS | frozenset("""b big br code em embed head i img meta nobr ruby s small span strong strike sub sup tt u
var""".split())
#: Linear weights of the classifier, in log-odds of content.
CONTENT_TAGS = {"article": 3.0, "main": 2.0}
NOISE_TAGS = frozenset("nav footer aside button select menu dialog option legend".split())
WRAPPING_TAGS = frozenset(["form", "fieldset"])  # noise unless most of the page is inside
LEAF_WEIGHTS = {
    "p": 1.5, "blockquote": 1.0, "pre": 1.0, "h1": 1.0, "h2": 0.7, "h3": 0.6, "h4": 0.5, "li": -0.2, "td": 0.0, "dd": 0.3,
    "dt": 0.2, "figcaption": 0.5}
NOISE_WEIGHT, CONTENT_WEIGHT, LINK_WEIGHT, BIAS = -9.0, 1.5, -3.0, -1.0
MOST_CONTENT, MOST = 3.0, 8.0  # bounds of what all ancestors together say for content, and of a score either way
NOISE = re.compile(
    r"(?:^|(?<=[_-]))(?P<word>ads?|adverts?|advertisement|adsense|sponsor(?:ed|s)?|promo(?:tion|ted)?|banner|cookies?|consent|gdpr|"
    r"notices?|alert|popup|pop-up|modal|overlay|nav|navbar|navigation|menus?|breadcrumbs?|sidebar|side|widget|footer|foot|"
    r"masthead|site-header|page-header|topbar|toolbar|header|comments?|reply|replies|respond|disqus|discussion|share|"
    r"sharing|social|related|recommend(?:ed|ations)?|newsletter|subscribe|subscription|signup|login|search|tags?|"
    r"pagination|pager|legal|copyright|disclaimer|skip|hidden)(?=$|[_-])", re.I)
#: Before a noise word: the class tells what a page has or is about, not what the element is.
STATED = re.compile(r"(?:^|[_-])(?:has|with|no|not|without|is|category|cat|format|type|layout|theme|supports)[_-]+$", re.I)
ARTICLE_CLASSES = frozenset("article post entry story hentry article-body article-content post-content entry-content".split())
CONTENT = re.compile(r"(?:^|[\s_-])(?:article|content|post|entry|story|body|text|main)(?:$|[\s_-])", re.I)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar".split())
ADJACENT, SIBLING = 0.6, 1.5
FORM_PROSE = 200  # unlinked code points from which a form may be the frame of a page

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW_TAGS}
_NESTED = re.compile(r"<(/?)(" + "|".join(sorted(OPAQUE_TAGS.difference(RAW_TAGS))) + r")(?=[\s/>])", re.I)
_ATTR = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SELF_CLOSING = frozenset("p li dt dd option tr td th".split())


@dataclass(slots=True)
class Element:
    tag: str
    parent: int
    in_article: bool
    opaque: bool = False
    closed: bool = False  # an opaque element with an end tag further on
    content: float = 0.0  # what speaks for content
    sure: float = 0.0  # what speaks against it whatever the element holds
    noise: float = 0.0  # what speaks against it unless the element holds the article
    doubt: float = 0.0  # what speaks against it unless the element holds most of the text
    prose: int = 0  # unlinked code points inside
    landmark: bool = False  # holds a main heading or the largest article


@dataclass(slots=True)
class Block:
    text: str
    leaf: str
    path: tuple[int, ...]
    link_share: float = 0.0
    score: float = 0.0


@dataclass(slots=True)
class _Open:
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    length: int = 0


def _judge(element: Element, attrs: str) -> None:
    """What an element's tag, classes, id and role say about the text in it."""
    tag = element.tag
    element.content = CONTENT_TAGS.get(tag, 0.0)
    element.sure = NOISE_WEIGHT if tag in NOISE_TAGS else 0.0
    element.doubt = NOISE_WEIGHT if tag in WRAPPING_TAGS else 0.0
    inside = element.in_article  # of an ancestor
    if tag == "header" and not inside:
        element.noise = NOISE_WEIGHT
    for name, a, b, c in _ATTR.findall(attrs) if attrs else ():
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            element.sure = NOISE_WEIGHT
        elif name == "role":
            if value.lower() in NOISE_ROLES:
                element.noise = NOISE_WEIGHT
        elif name in ("class", "id"):
            if CONTENT.search(value):
                element.content += CONTENT_WEIGHT
            if tag in ("html", "body"):
                continue  # theirs tell about the page
            for word in value.split():
                element.in_article |= word.lower() in ARTICLE_CLASSES
                for found in NOISE.finditer(word):
                    if found["word"].lower() == "header" and inside:
                        continue  # an article's own header holds its title
                    if len(found["word"]) == len(word) or found["word"].lower() == "hidden":
                        element.noise = NOISE_WEIGHT
                    elif not STATED.search(word, 0, found.start()):
                        element.doubt = NOISE_WEIGHT
    element.in_article |= tag in ("article", "main")


def _weigh(elements: list[Element]) -> tuple[list[float], list[float]]:
    """For and against content, summed over each element and its ancestors (which come before it)."""
    for e in reversed(elements[1:]):
        elements[e.parent].prose += e.prose
    clean = [e for e in elements if e.tag in ("article", "main") and not e.noise + e.doubt + e.sure]
    largest = max(clean, key=lambda e: e.prose, default=None)
    for e in reversed(elements[1:]):
        e.landmark |= e.tag == "h1" or e is largest
        elements[e.parent].landmark |= e.landmark
    pro, contra = [0.0], [0.0]
    for e in elements[1:]:
        share = e.prose / max(elements[0].prose, 1)
        wrapper = (1 - share) ** 2 if e.landmark else 1.0
        enough = min(1.0, e.prose / FORM_PROSE) if e.tag in WRAPPING_TAGS else 1.0
        against = e.sure + min(e.noise * wrapper, e.doubt * min(wrapper, 1 - share ** 4 * enough))
        pro.append(pro[e.parent] + e.content)
        contra.append(contra[e.parent] + against)
    return pro, contra


def _closed_openings(page: str) -> set[int]:
    """Where the opening tags of opaque elements begin that have an end tag."""
    waiting: dict[str, list[int]] = {}
    closed = set()
    for found in _NESTED.finditer(page):
        own = waiting.setdefault(found[2].lower(), [])
        if not found[1]:
            own.append(found.start())
        elif own:
            closed.add(own.pop())
    return closed


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in order, scored by the classifier."""
    blocks: list[Block] = []
    elements = [Element("", 0, False)]
    stack, ids = [elements[0]], [0]
    current, links = _Open(), 0
    hidden = 0  # place of the outermost opaque element on the stack
    closed, endless = _closed_openings(page), set()

    def flush() -> None:
        nonlocal current
        if current.parts:
            text = " ".join(html.unescape("".join(current.parts)).split())
            if text:
                leaf = next((e.tag for e in reversed(stack) if e.tag in LEAF_WEIGHTS), "")
                linked = current.linked / max(current.length, 1)
                stack[-1].prose += round(len(text) * (1 - linked))
                blocks.append(Block(text, leaf, tuple(ids), linked))
            current = _Open()

    def enter(element: Element) -> None:
        stack.append(element)
        ids.append(len(elements))
        elements.append(element)

    def leave(place: int) -> None:
        nonlocal hidden
        del stack[place:], ids[place:]
        if hidden >= place:
            hidden = 0

    def ended_by(tag: str) -> int:
        """Place of the outermost element that ends, within the opaque ones, because ``tag`` begins; 0: none."""
        out = 0
        for i in range(len(stack) - 1, 0, -1):
            e = stack[i]
            if e.tag == "head":
                out = i if tag not in HEAD_TAGS else out
            elif e.tag in FOREIGN_TAGS:
                if tag not in _HTML_ONLY:
                    break
                out = i
            elif e.opaque:
                if e.closed:
                    break
            elif i < hidden and tag in BLOCK_TAGS and (e.tag == "p" or (e.tag == tag and tag in _SELF_CLOSING)):
                return hidden
            elif e.tag in _ISLANDS or (e.tag in BLOCK_TAGS and e.tag != "p"):
                break
        return out

    def add(text: str) -> None:
        if hidden and stack[-1].tag == "head" and text.strip():
            leave(len(stack) - 1)
        if text and not hidden:
            current.parts.append(text)
            current.length += len(text)
            current.linked += len(text) if links else 0

    at = 0
    while (found := _TOKEN.search(page, at)) is not None:
        add(page[at: found.start()])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if not tag:
            continue
        closing = found["close"]
        if hidden and not closing and (place := ended_by(tag)):
            leave(place)
        foreign = stack[-1].tag not in _ISLANDS and any(e.tag in FOREIGN_TAGS for e in stack[hidden:]) if hidden else False
        empty = tag in VOID_TAGS or ((foreign or tag in FOREIGN_TAGS) and found["attrs"].endswith("/"))
        if tag in _RAW_END and not closing and not empty:
            end = None if tag in endless else _RAW_END[tag].search(page, at)
            if end is not None:
                at = end.end()
                continue
            endless.add(tag)
            if tag in ("script", "style") and not foreign:
                at = len(page)
                break
        if not closing and (hidden or tag in OPAQUE_TAGS):
            if not empty:
                opaque = tag in OPAQUE_TAGS
                if opaque and not hidden:
                    hidden = len(stack)
                enter(Element(tag, ids[-1], stack[-1].in_article, opaque, found.start() in closed))
            continue
        if closing and hidden:
            at_depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if not at_depth:
                continue
            inside = at_depth >= hidden
            leave(max(at_depth, hidden))
            if inside:
                continue
        if tag == "br":
            add(" ")
            continue
        if tag == "a":
            links = 0 if closing else 1
        block = tag in BLOCK_TAGS
        if closing:
            at_depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if block:
                flush()
                links = 0
            if at_depth:
                del stack[at_depth:], ids[at_depth:]
            continue
        if block:
            flush()
            links = 0
            # what the element ends by beginning: an open paragraph, or its like, within the same container
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p" or (stack[i].tag == tag and tag in _SELF_CLOSING):
                    del stack[i:], ids[i:]
                    break
                if stack[i].tag in BLOCK_TAGS:
                    break
        if tag in VOID_TAGS:
            continue
        element = Element(tag, ids[-1], stack[-1].in_article)
        _judge(element, found["attrs"])
        if block or element.sure + element.noise + element.doubt:
            enter(element)  # plain inline elements leave no trace
    add(page[at:])
    if hidden:
        leave(hidden)
    flush()
    pro, contra = _weigh(elements)
    for block in blocks:
        at = block.path[-1]
        score = BIAS + min(pro[at], MOST_CONTENT) + contra[at] + LEAF_WEIGHTS.get(block.leaf, 0.0)
        score += min(len(block.text), 400) / 200 + LINK_WEIGHT * block.link_share
        block.score = max(-MOST, min(MOST, score))
    return blocks


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks in page order and between neighbours inside one container."""
    edges, last_in = [], {}
    for i, block in enumerate(blocks):
        container = block.path[:-1]
        if (j := last_in.get(container)) is not None:
            edges.append((j, i, SIBLING))
        if i and j != i - 1:
            a, b = blocks[i - 1].path, block.path
            common = sum(1 for _ in _common(a, b))
            edges.append((i - 1, i, ADJACENT / (1 + len(a) + len(b) - 2 * common)))
        last_in[container] = i
    return edges


def _common(a: tuple[int, ...], b: tuple[int, ...]) -> Iterator[int]:
    for x, y in zip(a, b):
        if x != y:
            return
        yield x


def min_cut(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """For each node whether it stays on the source's side of a minimum cut (the smallest such side).

    A positive score is a capacity from the source, a negative one to the sink; edges count both ways. Flow goes along
    shortest paths in layers (Dinic).
    """
    n = len(scores)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def edge(a: int, b: int, there: float, back: float) -> None:
        heads[a].append(len(to))
        to.append(b)
        room.append(there)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, score in enumerate(scores):
        if score > 0:
            edge(source, i, score, 0.0)
        elif score < 0:
            edge(i, sink, -score, 0.0)
    for a, b, weight in edges:
        edge(a, b, weight, weight)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in heads[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                amount = min(room[e] for e in path)
                for e in path:
                    room[e] -= amount
                    room[e ^ 1] += amount
                cut = next(k for k, e in enumerate(path) if room[e] <= tiny)
                at = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while turn[at] < len(heads[at]):
                e = heads[at][turn[at]]
                if room[e] > tiny and level[to[e]] == level[at] + 1:
                    break
                turn[at] += 1
            else:
                if at == source:
                    break
                e = path.pop()
                at = to[e ^ 1]
                turn[at] += 1
                continue
            path.append(e)
            at = to[e]


def main_text(page: str | None) -> str:
    """Content blocks of a page, joined by line breaks."""
    if not page:
        return ""
    blocks = blocks_of(page)
    keep = min_cut([b.score for b in blocks], smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep) if k)


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        text = [main_text(page) for page in batch["html"]]
        yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": text, "n_chars": [len(t) for t in text]})


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    rows = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))  # ids as text: pandas has no integers with nulls
    return rows.mapInPandas(_extract, "page_id string, url string, text string, n_chars bigint").withColumn(
        "page_id", F.col("page_id").cast("bigint"))
