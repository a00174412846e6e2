r"""Main-text extraction from HTML by minimum cut.

A page becomes blocks of text in page order, each with features and its path of open elements. A naive Bayes
classifier over binned features, trained here on blocks whose element already tells what they are, gives
costs of calling a block content or boilerplate; these are the capacities to the two terminals. Neighbouring
blocks, and blocks and the containers around them, are tied by smoothness edges. A maximum flow finds the
cheapest labelling, and the blocks on the source side are the text.

Script, style and other unseen elements give no blocks. Character references are decoded, white space inside a
block becomes one space, blocks are joined by one line end. Defined results: NULL and empty pages, and pages
without content, give empty text; unclosed and unknown elements, stray closing tags and cut-off pages are read
as far as they go; repeated rows are read one by one. An empty table gives no rows; a classifier without
examples says nothing and the elements decide. Extra columns are ignored.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter, deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.common import chunks, schema_of

# The classifier is fitted on about this many pages, chosen by hash.
TRAIN_PAGES = 5_000

# Elements by what they do to the text.
UNSEEN = frozenset("script style noscript template svg annotation annotation-xml iframe object canvas audio video head title select datalist textarea".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
# An opening tag closes an open element of the same set: paragraphs, items, cells.
CLOSES_P = BREAKS - {"br", "hr", "body", "html"}
SAME = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = frozenset("ul ol dl table div article section main aside body nav header footer form blockquote".split())
CONTENT = frozenset("article main".split())
CHROME = frozenset("nav footer aside form header menu button dialog search".split())
_CHROME_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar|side|footer|foot|header|masthead|"
    r"cookies?|consent|gdpr|notice|notification|popup|modal|overlay|newsletter|subscri\w*|signup|login|share|sharing|social|related|"
    r"recommend\w*|trending|popular|comments?|disqus|replies|reply|respond|widget|toolbar|pagination|pager|copyright|legal|search)(?:$|[\s_-])",
    re.I,
)
# What an article must be called to be anything but the article: a reader's comment, an advert, a teaser.
_OTHER_ARTICLE = re.compile(
    r"(?:comments?|repl(?:y|ies)|ads?|advert\w*|sponsor\w*|promo\w*|related|recommend\w*|trending|popular|teasers?|widget|newsletter)(?:[_-]\w+)*",
    re.I,
)
# A name with one of these in it tells of the page round it (no-sidebar, with-header) or files the text (category-legal).
_ABOUT = re.compile(
    r"(?:^|[_-])(?:no|not|non|has|have|with|without|hide|hides|show|shows)(?=$|[_-])"
    r"|^(?:category|cat|tag|topic|type|format|status|author|term|lang)[_-]",
    re.I,
)
_CONTENT_NAME = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body|text)(?:$|[\s_-])", re.I)
# Quotes hold an attribute's value together only right after its equals sign, and only if they are closed.
_TAG = re.compile(
    r"<(?:!--.*?(?:-->|$)|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)(?:>|$))", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_TELLING = frozenset("class id role aria-hidden hidden style".split())
_SPACE = re.compile(r"\s+")


ARTICLE, MAIN = 2, 3
# What speaks for boilerplate, by how much an article inside may take it back.
FORM, NAMED, FIRM, OTHER = -1, -2, -3, -4


@dataclass
class Element:
    tag: str
    container: int  # the innermost container: this element or one round it; 0 for none
    around: int  # the container round that container
    says: int  # with all elements round it, of its text: 1 content, 0 nothing, less boilerplate (FORM, NAMED, FIRM, OTHER)
    hidden: bool = False
    inner: str = ""  # tag of the innermost element that breaks text
    main: bool = False  # an article or main, or inside one


@dataclass
class Block:
    element: int
    text: str
    linked: int = 0  # characters inside links
    tag: str = ""


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)


def _leaning(tag: str, attributes: str, inside_content: bool) -> tuple[int, bool]:
    """What an opening tag by itself says of its text, and whether it hides it."""
    names, hidden, role = [], False, ""
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if name not in _TELLING:
            continue
        if name in ("class", "id"):
            names += [n for n in value.split() if not _ABOUT.search(n)]
        elif name == "role":
            role = value.lower()
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    # An article has a header of its own: its headline.
    if tag in CHROME and not (tag == "header" and inside_content):
        return FORM if tag == "form" else FIRM, hidden
    if role in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form"):
        return FORM if role == "form" else FIRM, hidden
    if tag in CONTENT or role in ("main", "article"):
        if any(_OTHER_ARTICLE.fullmatch(n) for n in names):
            return OTHER, hidden
        return MAIN if "main" in (tag, role) else ARTICLE, hidden
    if any(_CHROME_NAME.search(n) for n in names) and tag not in ("html", "body"):
        return NAMED, hidden
    if any(_CONTENT_NAME.search(n) for n in names) and tag in ("div", "section", "td"):
        return 1, hidden
    return 0, hidden


def _together(leaning: int, around: Element) -> int:
    """What an element says with those round it.

    A form may hold the whole page, and a name may mislead: the first article or main inside takes a form's word
    back, a main also a name's; a name and an article leave it to the cut. Other chrome stays chrome.
    """
    if leaning < 0:
        return min(leaning, around.says)
    if around.says >= 0:
        return 1 if leaning else around.says
    if not around.main:
        if around.says == FORM and leaning or around.says == NAMED and leaning == MAIN:
            return 1
        if around.says == NAMED and leaning == ARTICLE:
            return 0
    return around.says


def read_page(source: str) -> Page:
    """Elements and text blocks of a page."""
    page = Page([Element("", 0, 0, 0)])
    stack = [0]
    opened: Counter[str] = Counter()
    pieces: list[tuple[str, bool]] = []
    links = 0

    def flush() -> None:
        if pieces:
            text = _SPACE.sub(" ", "".join(p for p, _ in pieces)).strip()
            inside = page.elements[stack[-1]]
            if text:
                linked = sum(len(_SPACE.sub("", p)) for p, linked in pieces if linked)
                page.blocks.append(Block(stack[-1], text, linked, inside.inner))
            pieces.clear()

    def close(upto: int) -> None:
        nonlocal links
        for e in stack[upto:]:
            links -= page.elements[e].tag == "a"
            opened[page.elements[e].tag] -= 1
        del stack[upto:]

    at = 0
    while at < len(source):
        start = source.find("<", at)
        if start < 0:
            start = len(source)
        if start > at and not page.elements[stack[-1]].hidden:
            pieces.append((references.unescape(source[at:start]), links > 0))
        if start == len(source):
            break
        m = _TAG.match(source, start)
        if not m:  # a lone sign is text
            if not page.elements[stack[-1]].hidden:
                pieces.append(("<", links > 0))
            at = start + 1
            continue
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BREAKS:
                flush()
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if page.elements[stack[i]].tag == tag))
            continue
        if tag in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            if tag in BREAKS:
                flush()
            at = end.end() if end else len(source)
            continue
        if tag in BREAKS:
            flush()
        if tag in VOID or m[3].endswith("/"):
            continue
        closing = SAME.get(tag, set()) | ({"p"} if tag in CLOSES_P else set())
        for i in range(len(stack) - 1, 0, -1):
            open_tag = page.elements[stack[i]].tag
            if open_tag in closing:
                close(i)
                break
            if open_tag in SCOPES:
                break
        parent = page.elements[stack[-1]]
        leaning, hidden = _leaning(tag, m[3], parent.says > 0)
        number = len(page.elements)
        scope = (number, parent.container) if tag in SCOPES else (parent.container, parent.around)
        says = _together(leaning, parent)
        inner = tag if tag in BREAKS else parent.inner
        page.elements.append(
            Element(tag, *scope, says, hidden or parent.hidden or tag in UNSEEN, inner, parent.main or leaning in (ARTICLE, MAIN))
        )
        stack.append(number)
        opened[tag] += 1
        links += tag == "a"
    flush()
    return page


# ---------------------------------------------------------------- the classifier

FEATURES = ("words", "link share", "sentence ends", "mean word", "tag", "upper start", "position")


def features(page: Page) -> list[tuple[int, ...]]:
    """Binned features of each block, none of which looks at container elements."""
    out = []
    for i, b in enumerate(page.blocks):
        words = b.text.split(" ")
        out.append(
            (
                min(9, int(math.log2(len(words)))),
                min(4, int(4 * b.linked / max(1, len(b.text.replace(" ", ""))))),
                min(4, len(re.findall(r"[.!?:](?:\s|$)", b.text))),
                min(9, int(len(b.text) / len(words) / 2)),
                {"p": 1, "li": 2, "td": 3, "div": 4, "h1": 5, "h2": 6, "h3": 6, "pre": 7, "blockquote": 7}.get(b.tag, 0),
                int(b.text[0].isupper()),
                min(4, 5 * i // len(page.blocks)),
            )
        )
    return out


BINS = 10


def fit(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> np.ndarray:
    """Log-likelihood ratios (content over boilerplate), features x bins.

    Examples are blocks inside elements that tell, of about ``train_pages`` pages chosen by hash.
    """
    total = pages.count()
    drawn = F.pmod(F.xxhash64("page_id", F.length("html")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    rows = pages.select("page_id", "html").filter(drawn < F.lit(min(1.0, train_pages / max(1, total)))).select("html")

    def count(batches):
        counts = np.zeros((2, len(FEATURES), BINS), np.int64)
        for batch in batches:
            for _, texts in chunks(batch, 0):
                for source in texts.to_pylist():
                    page = read_page(source)
                    for block, binned in zip(page.blocks, features(page), strict=True):
                        side = page.elements[block.element].says
                        if side:
                            for f, b in enumerate(binned):
                                counts[int(side > 0), f, b] += 1
        side, f, b = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (side, f, b)] + [pa.array(counts[side, f, b])], names=["side", "f", "b", "n"])

    counted = rows.mapInArrow(count, "side int, f int, b int, n long").groupBy("side", "f", "b").agg(F.sum("n").alias("n")).collect()
    counts = np.ones((2, len(FEATURES), BINS))
    for r in counted:
        counts[r["side"], r["f"], r["b"]] += r["n"]
    if counts.sum() == counts.size:
        return np.zeros((len(FEATURES), BINS))
    shares = counts / counts.sum(axis=2, keepdims=True)
    return np.log(shares[1] / shares[0])


# ---------------------------------------------------------------- the cut

TOLD = 6.0  # cost of going against what the elements say; less than the classifier may say
ARTICLE_TOLD = 12.0  # against an article or main: its short lines are its text as well, and a comment's long ones are not
NEXT = 0.7  # smoothness between neighbouring blocks
AROUND = 1.0  # between a block or container and the container round it
CAP = 8.0  # most that the classifier may say


def min_cut(n: int, source_cost: list[float], sink_cost: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which of ``n`` nodes are on the source side of a minimum cut (Dinic's algorithm).

    ``source_cost[i]``: cost of putting node i on the sink side; ``sink_cost[i]``: on the source side.
    """
    s, t = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    room: list[float] = []

    def link(a: int, b: int, forth: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        room.append(forth)
        head[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        shared = min(source_cost[i], sink_cost[i])
        if source_cost[i] > shared:
            link(s, i, source_cost[i] - shared, 0.0)
        elif sink_cost[i] > shared:
            link(i, t, sink_cost[i] - shared, 0.0)
    for a, b, weight in edges:
        link(a, b, weight, weight)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in head[a]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        place = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                keep = next(k for k, e in enumerate(path) if room[e] <= tiny)
                a = to[path[keep] ^ 1]
                del path[keep:]
                continue
            while place[a] < len(head[a]):
                e = head[a][place[a]]
                if room[e] > tiny and level[to[e]] == level[a] + 1:
                    break
                place[a] += 1
            if place[a] < len(head[a]):
                path.append(head[a][place[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                place[a] += 1
            else:
                break


def label(page: Page, ratios: np.ndarray) -> list[bool]:
    """Whether each block is content."""
    blocks = page.blocks
    elements = page.elements
    home = [elements[b.element].container for b in blocks]
    used: dict[int, int] = {}  # containers to nodes
    for e in home:
        while e and e not in used:
            used[e] = len(blocks) + len(used)
            e = elements[e].around
    n = len(blocks) + len(used)
    content, chrome = [0.0] * n, [0.0] * n
    for i, (block, binned) in enumerate(zip(blocks, features(page), strict=True)):
        say = sum(ratios[f, b] for f, b in enumerate(binned))
        e = elements[block.element]
        sure = e.main and e.says > 0 or e.says == OTHER
        say = max(-CAP, min(CAP, say)) + (ARTICLE_TOLD if sure else TOLD) * max(-1, e.says)
        content[i], chrome[i] = max(say, 0.0), max(-say, 0.0)
    edges = [(i, used[e], AROUND) for i, e in enumerate(home) if e]
    edges += [(i - 1, i, NEXT if home[i] == home[i - 1] else NEXT / 4) for i in range(1, len(blocks))]
    edges += [(k, used[elements[e].around], AROUND / 2) for e, k in used.items() if elements[e].around]
    return min_cut(n, content, chrome, edges)[: len(blocks)]


def extract_text(source: str, ratios: np.ndarray) -> str:
    page = read_page(source)
    return "\n".join(b.text for b, keep in zip(page.blocks, label(page, ratios), strict=True) if keep)


def extract(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    ratios = fit(pages, train_pages)  # a few dozen numbers
    rows = pages.select("page_id", "url", "html")

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, 2):
                found = [extract_text(source, ratios) for source in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return rows.mapInArrow(run, schema_of(rows, "text string, n_chars long", "page_id", "url"))
