"""Main-text extraction by minimum-cut labelling of text blocks.

1. A tolerant tokenizer walks the markup with an element stack (implied ends of p, li, dt, dd, tr,
   td, option; void elements; raw text of script, style, textarea and the like) and cuts the text
   into blocks at block-level boundaries. A block keeps its path of elements and the marks seen on
   it: semantic elements, tokens of class, id and role, share of linked text, form controls.
2. A linear classifier over these features gives the cost of calling a block content or
   boilerplate; the costs are the terminal capacities of the block's node. Names count by the part of
   the page they name: an element that holds the page's core (its heaviest article or main element,
   else its h1) and half of its text is a wrapper, whose names and form tag say nothing; a class that
   states a layout (``has-sidebar``) never does; an article is not condemned by words that may be its
   topic. A heading that announces reader comments turns what follows under it into boilerplate. An
   article element is trusted only if it holds the h1 or a fair part of the text outside of boilerplate.
3. Smoothness edges join neighbours in page order, and blocks that share their parent element; an
   edge is weaker the farther apart the blocks are in the DOM.
4. Max-flow separates content (source side) from boilerplate (sink side).

Blocks whose elements are never text (script, style, noscript, template, form controls, hidden
elements) are not made at all. The classifier is small and fixed; its weights are public knowledge
of page structure, not fitted to any data set (no labelled pages are given).

Cost per page is linear in practice, at any depth: open elements are found by name, not by a walk; each block has at most two outgoing smoothness edges, and flow
that source and sink capacities of one block cancel is never routed.

Scale: a narrow scan; pages are independent, nothing is shuffled, memory is one page.

Defined results: null or empty html, and pages without content, give an empty text. Unclosed and
mismatched tags are repaired by the stack, text outside of any element is a block of its own. A
null page_id or url is returned as it is; repeated rows are returned each. Extra columns are
ignored. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements whose text is never shown as page text.
NEVER = frozenset("script style noscript template title head iframe object svg math canvas audio video textarea select option button input datalist noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that end an open element of the same group when they begin.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table article section div main body html nav aside header footer form blockquote".split())
GOOD_TAGS = {"article": 3.0, "main": 3.0}
#: Against content: elements that are never around a page's main text, and those that may be (a page in one form).
BAD_TAGS = {"nav": 9.0, "footer": 9.0, "aside": 9.0, "menu": 9.0, "dialog": 9.0}
BAD_UNLESS_WRAPPER = {"form": 9.0}
HEADER, BAD_NAME, COMMENTS = 2.5, 9.0, 9.0
GOOD_NAMES = frozenset("article content main post entry story body text blog news".split())
#: Names of boilerplate whatever the element; an article of such a name is a comment or a teaser.
PART_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion menu nav navigation navbar breadcrumb breadcrumbs "
    "footer masthead sidebar aside widget related recommended recommendations teaser comment comments reply replies responses reactions respond disqus "
    "cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup login toolbar pagination pager".split()
)
#: Names that may also be what an article is about.
BAD_NAMES = PART_NAMES | frozenset("banner header side popular trending share sharing social follow discussion notice notices alert search form copyright legal disclaimer skip tags toc feedback guestbook".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search menu menubar dialog alertdialog alert form toolbar".split())
_LAYOUT = re.compile(r"(?:has|with|no|without|is)[-_]", re.I)
_ABOUT_COMMENTS = re.compile(
    r"\W*(?:\d[\d.,]*\s+)?(?:(?:reader|user|your|all|leave an?|post an?|add an?|write an?)\s+)*"
    r"(?:comments?|repl(?:y|ies)|responses?|discussion|kommentare?|commentaires?|comentarios?)(?:\W*\d*)*", re.I
)
_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|</?[A-Za-z][^\s/>]*(?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*(?:>|$)", re.S)
_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_ATTR = re.compile(r"([A-Za-z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPLIT_NAME = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
_LEGAL = re.compile(r"\s*(?:©|\(c\)\s|copyright\b|all rights reserved)", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Element:
    tag: str
    number: int
    depth: int
    good: float = 0.0  # evidence of the element itself for and against content
    bad: float = 0.0
    unless_wrapper: float = 0.0  # further evidence against it that a wrapper does not have
    hidden: bool = False
    parent: Element | None = None
    inside: bool = False  # in an article or main element
    block: Element | None = None  # the nearest element that is not inline, itself or above
    mass: int = 0  # characters of text in it, without linked ones
    core: bool = False  # holds the page's core
    bias: float = 0.0  # summed evidence of the path: positive for content
    spoiled: bool = False  # something on the path speaks against content


@dataclass
class Block:
    text: str
    parent: Element
    linked: int = 0
    tag: str = ""
    chars: int = 0
    under_comments: bool = False  # after a heading that announces reader comments


def _evidence(tag: str, attrs: str) -> tuple[float, float, float, bool, bool]:
    """(for content, against it, against it unless a wrapper, hidden, whether it is an article) of one element."""
    good, bad, unless = GOOD_TAGS.get(tag, 0.0), BAD_TAGS.get(tag, 0.0), BAD_UNLESS_WRAPPER.get(tag, 0.0)
    hidden, article = False, tag in GOOD_TAGS
    if tag == "header":
        unless += HEADER
    if attrs and not attrs.isspace():
        names: set[str] = set()
        for m in _ATTR.finditer(attrs):
            k, v = m[1].lower(), (m[2] or "").strip("\"'")
            if k in ("class", "id"):
                for word in v.split():
                    if not _LAYOUT.match(word):
                        names.update(x.lower() for x in _SPLIT_NAME.split(word) if x)
            elif k == "role":
                roles = set(v.lower().split())
                article = article or bool(roles & {"main", "article"})
                good += 3.0 * bool(roles & {"main", "article"})
                unless += BAD_NAME * bool(roles & BAD_ROLES)
            elif k in ("itemprop", "itemtype") and "comment" in v.lower() and "count" not in v.lower():
                bad += COMMENTS
            elif k == "hidden" or (k == "style" and _HIDDEN.search(v)) or (k == "aria-hidden" and v.lower() == "true"):
                hidden = True
        if tag not in ("html", "body") and names & (PART_NAMES if article else BAD_NAMES):
            unless += BAD_NAME
            article = False
        elif names & GOOD_NAMES:
            good += 1.5
    return good, bad, unless, hidden, article


def _weigh(elements: list[Element], blocks: list[Block]) -> bool:
    """Fills mass, core, bias and spoiled of the elements; returns whether article elements are trusted."""
    for b in blocks:
        b.parent.mass += max(0, b.chars - b.linked)
    for e in reversed(elements):  # parents come before their children
        if e.parent is not None:
            e.parent.mass += e.mass
    total = elements[0].mass
    articles = [e for e in elements if e.inside and not (e.parent and e.parent.inside)]
    heads = [b for b in blocks if b.tag == "h1"]
    core = max(articles, key=lambda e: e.mass) if articles else heads[0].parent if heads else None
    while core is not None:
        core.core, core = True, core.parent
    known = bool(articles or heads)
    for e in elements[1:]:
        wrapper = 2 * e.mass >= total and (e.core if known else 5 * e.mass >= 4 * total)
        against = e.bad + (0.0 if wrapper else e.unless_wrapper)
        if e.tag == "header" and e.parent.inside:
            against -= HEADER if not wrapper else 0.0
        e.bias = e.parent.bias + e.good - against
        e.spoiled = e.parent.spoiled or against > HEADER
    level = depth = None
    for b in blocks:
        head = len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1].isdigit()
        if level is not None and (b.parent.depth < depth or (head and b.tag <= level)):
            level = None
        if head and len(b.text) <= 60 and b.tag != "h1" and _ABOUT_COMMENTS.fullmatch(b.text):
            level, depth = b.tag, b.parent.depth
        b.under_comments = level is not None
    if any(b.parent.inside and not b.parent.spoiled for b in heads):
        return True
    free = [b for b in blocks if not b.parent.spoiled and not b.under_comments]
    inside = sum(b.chars for b in free if b.parent.inside)
    return inside > 0 and 5 * inside >= sum(b.chars for b in free)


def blocks_of(html: str) -> list[Block]:
    """The page's text blocks in order."""
    return parse(html)[0]


def parse(html: str) -> tuple[list[Block], bool]:
    """(the page's text blocks in order, whether its article elements are trusted)."""
    root = Element("", 0, 0)
    root.block = root
    stack, out, elements = [root], [], [root]  # an element's depth is its position in the stack
    opened: dict[str, list[int]] = {}  # positions of the open elements of each name: no lookup walks the stack
    scopes: list[int] = []  # positions of the open elements of SCOPE
    text: list[str] = []
    linked = 0
    in_link = 0

    def flush() -> None:
        nonlocal text, linked
        if text:
            s = _SPACE.sub(" ", "".join(text)).strip()
            if s:
                at = stack[-1].block
                out.append(Block(s, at, linked=linked, tag=at.tag, chars=len(s)))
            text, linked = [], 0

    def close_to(i: int) -> None:
        nonlocal in_link
        for e in stack[i:]:
            if e.tag == "a":
                in_link -= 1
            opened[e.tag].pop()
            if e.tag in SCOPE:
                scopes.pop()
        del stack[i:]

    def last(name: str) -> int:
        at = opened.get(name)
        return at[-1] if at else 0

    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at)
        end = m.start() if m else n
        if end > at and not stack[-1].hidden:
            piece = unescape(html[at:end])
            text.append(piece)
            if in_link:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        tag = m[0]
        if tag[1] in "!?":
            if tag.startswith("<![CDATA[") and not stack[-1].hidden:
                text.append(tag[9:-3] if tag.endswith("]]>") else tag[9:])
            continue
        name = _NAME.match(tag)[1].lower()
        if tag[1] == "/":
            if name == "br":
                text.append(" ")
                continue
            i = last(name)
            if not i:
                if name == "p":
                    flush()
                continue
            if any(e.tag not in INLINE for e in stack[i:]):
                flush()
            close_to(i)
            continue
        if name == "br":
            text.append(" ")
            continue
        attrs = tag[1 + len(name) :].rstrip(">").rstrip("/")
        if name not in INLINE:
            flush()
            # a block begins: an open paragraph ends, with the inline elements left open in it
            if stack[-1].block.tag == "p":
                close_to(stack[-1].block.depth)
            k = max(map(last, CLOSES.get(name, ())), default=0)
            if k > (scopes[-1] if scopes else 0):
                close_to(k)
        if name in VOID:
            continue
        good, bad, unless, hidden, article = _evidence(name, attrs)
        top = stack[-1]
        e = Element(name, len(elements), top.depth + 1, good, bad, unless, top.hidden or hidden or name in NEVER, top, top.inside or article)
        e.block = top.block if name in INLINE else e
        elements.append(e)
        if tag.endswith("/>") and name in ("svg", "math", "path"):
            continue
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|$)", re.I).search(html, at)
            at = close.end() if close else n
            continue
        opened.setdefault(name, []).append(len(stack))
        if name in SCOPE:
            scopes.append(len(stack))
        stack.append(e)
        if name == "a":
            in_link += 1
    flush()
    return out, _weigh(elements, out)


def costs(b: Block, page_has_article: bool) -> float:
    """Log-odds that a block is content: the linear classifier."""
    score = b.parent.bias
    share = b.linked / max(1, b.chars)
    score -= 3.0 * share
    words = b.text.count(" ") + 1
    score += min(words, 40) * 0.05
    if b.tag in ("p", "blockquote", "pre") or (len(b.tag) == 2 and b.tag[0] == "h" and b.tag[1].isdigit()):
        score += 0.8
    if b.tag in ("li", "td", "th", "dt", "dd", "figcaption"):
        score += 0.2
    if page_has_article:
        score += 1.0 if b.parent.inside else -4.0
    if _LEGAL.match(b.text):
        score -= 3.0
    if b.under_comments:
        score -= COMMENTS
    return score


class Flow:
    """Dinic's max-flow on small graphs; edges as flat arrays."""

    def __init__(self, n: int):
        self.head: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.cap: list[float] = []

    def edge(self, u: int, v: int, there: float, back: float = 0.0) -> None:
        self.head[u].append(len(self.to))
        self.to.append(v)
        self.cap.append(there)
        self.head[v].append(len(self.to))
        self.to.append(u)
        self.cap.append(back)

    def reachable(self, s: int) -> list[int]:
        level = [-1] * len(self.head)
        level[s] = 0
        q = deque([s])
        while q:
            u = q.popleft()
            for k in self.head[u]:
                if self.cap[k] > 1e-9 and level[self.to[k]] < 0:
                    level[self.to[k]] = level[u] + 1
                    q.append(self.to[k])
        return level

    def run(self, s: int, t: int) -> float:
        total = 0.0
        while (level := self.reachable(s))[t] >= 0:
            at = [0] * len(self.head)
            while True:  # one blocking path at a time, without recursion
                path: list[int] = []
                u = s
                while u != t:
                    while at[u] < len(self.head[u]):
                        k = self.head[u][at[u]]
                        if self.cap[k] > 1e-9 and level[self.to[k]] == level[u] + 1:
                            break
                        at[u] += 1
                    if at[u] < len(self.head[u]):
                        path.append(self.head[u][at[u]])
                        u = self.to[path[-1]]
                    elif path:
                        u = self.to[path.pop() ^ 1]
                        at[u] += 1
                    else:
                        break
                if u != t:
                    break
                f = min(self.cap[k] for k in path)
                for k in path:
                    self.cap[k] -= f
                    self.cap[k ^ 1] += f
                total += f
        return total


def dom_distance(a: Element, b: Element) -> int:
    """Edges between two elements in the tree."""
    d = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        d += 1
    return d


def smoothness(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """(i, j, capacity): neighbours in page order, and the previous block of the same parent's parent."""
    edges, last = [], {}
    for i, b in enumerate(blocks):
        if i:
            edges.append((i - 1, i, 1.2 / (1.0 + dom_distance(blocks[i - 1].parent, b.parent))))
        group = (b.parent.parent or b.parent).number
        j = last.get(group)
        if j is not None and j != i - 1:
            edges.append((j, i, 0.6))
        last[group] = i
    return edges


def label(scores: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The minimum cut: True for content. Flow of a node's own source and sink arc is pre-cancelled."""
    n = len(scores)
    if all(s > 0 for s in scores) or all(s <= 0 for s in scores):
        return [s > 0 for s in scores]
    g = Flow(n + 2)
    for i, s in enumerate(scores):
        if s > 0:
            g.edge(n, i, s)
        elif s < 0:
            g.edge(i, n + 1, -s)
    for i, j, c in edges:
        g.edge(i, j, c, c)
    g.run(n, n + 1)
    level = g.reachable(n)
    return [level[i] >= 0 for i in range(n)]


def extract(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    blocks, trusted = parse(html)
    if not blocks:
        return ""
    keep = label([costs(b, trusted) for b in blocks], smoothness(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(x) for x in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(rows, "page_id bigint, url string, text string, n_chars bigint")


def op5_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
