"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text. A linear classifier over a block's words, links, wording and the tags
and names of the elements around it gives the cost of calling it content or boilerplate: these are the
capacities to the two terminals. Blocks that follow each other, and neighbours under one parent element,
are tied by smoothness edges. The minimum cut separates content from boilerplate.

What an element's name says counts by how sure it is, and only once the whole page is read: an element
that holds most of the page's text is no part of the page's trimmings, whatever it is called.

The page is read in one pass, attribute by attribute as HTML has it (a quote opens a value only after
``=``). Elements nested deeper than ``DEEPEST`` count as their ancestor there, so the time is linear in
the page's length however it is nested.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TEXT = re.compile(r"[^<]+")
_COMMENT = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(?:[!?]|/[^A-Za-z>])[^>]*(?:>|\Z)|</>", re.S)
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
#: An attribute and what precedes it, or the end of the tag. Every character fits one of them once.
_ATTRIBUTE = re.compile(
    r"[\s/]*(?:(>)|(=?[^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>\"'][^\s>]*)|(?=>|\Z)))?)"
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr img".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNSEEN = frozenset("script style template title noscript svg math iframe object canvas select textarea".split())
_RAW = frozenset("script style title textarea".split())
_BOILER_TAGS = frozenset("nav footer aside form button menu dialog fieldset".split())
_CONTENT_TAGS = frozenset("article main".split())
#: Elements that a start tag of the same kind closes.
_CLOSES_SELF = frozenset("p li dt dd option tr td th".split())
_BOILER_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|cmp|notices?|alert|nav"
    r"|navbar|navigation|menu|breadcrumbs?|sidebar|side|footer|header|masthead|comments?|feedback|respond|replies|reply"
    r"|disqus|share|sharing|social|related|recommended|newsletter|subscribe|signup|login|popup|modal|overlay"
    r"|widget|toolbar|pagination|pager|search|copyright|legal|disclaimer|toc|skip|hidden)(?=$|[\s_-])",
    re.I,
)
#: Of these, the ones that as part of a longer name (``search-page``, ``legal-content``) may name a subject.
_SUBJECTS = re.compile(
    r"(?:^|[\s_-])(?:notices?|alert|side|feedback|share|sharing|social|related|recommended|search|copyright|legal"
    r"|disclaimer|consent|banner|toc|skip)(?=$|[\s_-])",
    re.I,
)
#: Class names that tell what a layout has or lacks, not what the element is.
_MODIFIER = re.compile(r"(?:^|(?<=\s))(?:has|with|without|no|hide|show)[-_]\S*|(?:^|(?<=\s))side-by-side(?=$|\s)", re.I)
#: Names of parts that hold articles of their own: comments, teasers, advertisements.
_OTHER_ARTICLES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|feedback|respond|replies|reply|disqus|related"
    r"|recommended|newsletter|popup|modal|widgets?|hidden)(?=$|[\s_-])",
    re.I,
)
_COPYRIGHT = re.compile(
    r"©|\(c\) (?:(?i:copyright)\b|(?:by )?(?:[A-Z][\w&.'’-]*,? ){0,6}(?:(?:19|20)\d\d\b|(?i:all rights reserved))"
    r"|(?:[A-Z][\w&'’-]*,? )+(?:Inc|Ltd|LLC|GmbH|Corp|AG|SA|plc)\b)"
)
_COOKIES = re.compile(r"\bcookies?\b.*\b(?:accept|agree|consent|continu|prefer|privacy|settings)", re.I | re.S)
#: Degrees of boilerplate: a name that may as well be a subject, a wrapper that may hold the page, a part by
#: its name, a part by its tag or role.
SUBJECT, WRAPPER, NAMED, CERTAIN = 1, 2, 3, 4
_CONTENT_NAME = re.compile(
    r"(?:^|[\s_-])(?:article|main|content|post|entry|story|body|text)(?=$|[\s_-])", re.I
)
_BOILER_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

#: Classifier weights, in cost units; positive speaks for content. ``BOILER`` goes by degree.
BIAS, CONTENT, LINKS, WORDS, SENTENCE, HEADING, PLAIN = -0.2, 4.0, -3.0, 0.12, 0.6, 1.0, 0.3
BOILER = (0.0, -2.5, -8.0, -8.0, -8.0)
NOTICE = -8.0
#: Smoothness: between blocks in sequence, and between neighbours under one parent.
ADJACENT, SIBLING = 0.5, 0.5
#: Share of the page's unlinked text from which an element is the page itself, whatever it is called.
MOST = 0.5
DEEPEST = 400


@dataclass
class Element:
    tag: str
    parent: Element | None
    number: int
    own: int  # degree of boilerplate by its own tag, role and names
    other_articles: bool
    named_content: bool
    main: bool
    unseen: bool
    link: bool
    boiler: int = 0  # degree with what its ancestors give, once the page is read
    content: bool = False
    chars: int = 0  # unlinked text inside


@dataclass
class Block:
    top: Element
    holder: Element
    heading: bool
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""

    @property
    def parent(self) -> Element:
        return self.top if self.top.boiler else self.holder


def _attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes of a tag whose name ends at ``at``, and where the tag ends; the first of a name counts."""
    named: dict[str, str] = {}
    while m := _ATTRIBUTE.match(html, at):
        if m[1] or m.end() == at or at >= len(html):
            return named, max(m.end(), at)
        at = m.end()
        if m[2]:
            named.setdefault(m[2].lower(), m[3] or m[4] or m[5] or "")
    return named, len(html)


def _element(tag: str, named: dict[str, str], parent: Element | None, number: int) -> Element:
    names = _MODIFIER.sub("", f"{named.get('class', '')} {named.get('id', '')}")
    role = named.get("role", "").lower()
    own = 0
    if role in _BOILER_ROLE or (tag in _BOILER_TAGS and tag != "form"):
        own = CERTAIN
    elif tag not in ("html", "body", "article", "main") and _BOILER_NAME.search(names):
        parts = names.split()
        if any(_BOILER_NAME.fullmatch(x) for x in parts):
            own = NAMED
        elif not any(_BOILER_NAME.search(_SUBJECTS.sub("", x)) for x in parts):
            own = SUBJECT
        else:
            own = NAMED if _OTHER_ARTICLES.search(names) else WRAPPER
    elif tag == "form":
        own = WRAPPER
    unseen = tag in _UNSEEN or "hidden" in named or "display:none" in named.get("style", "").replace(" ", "")
    return Element(
        tag,
        parent,
        number,
        own,
        own == SUBJECT and bool(_OTHER_ARTICLES.search(names)),
        bool(_CONTENT_NAME.search(names)),
        tag == "main" or role == "main",
        unseen or (parent is not None and parent.unseen),
        tag == "a" or (parent is not None and parent.link),
    )


def settle(elements: list[Element], found: list[Block]) -> None:
    """What each element is, from its own names and its ancestors', and from the text it holds."""
    for b in found:
        b.top.chars += max(0, len(b.text) - b.link_chars)
    for e in reversed(elements[1:]):
        e.parent.chars += e.chars
    most = MOST * elements[0].chars
    for e in elements[1:]:
        own, inside, given = e.own, e.parent.content, e.parent.boiler
        if e.tag == "header" and not inside:
            own = CERTAIN
        if e.other_articles and not inside:
            own = NAMED
        if own in (SUBJECT, WRAPPER) and e.chars >= most > 0:
            own = 0
        # the page's main element, or an article in a mere wrapper, is no part of what its wrapper is named for
        if not own and (given <= NAMED if e.main else e.tag == "article" and given <= WRAPPER):
            given = 0
        e.boiler = max(own, given)
        e.content = inside or e.tag in _CONTENT_TAGS or (not own and e.named_content)


def blocks(html: str) -> list[Block]:
    """Blocks of visible text in page order, white space folded and character references decoded."""
    root = Element("", None, 0, 0, False, False, False, False, False)
    elements, stack, found, now, at = [root], [root], [], None, 0
    opened: Counter = Counter()

    def close(depth: int) -> None:
        for e in stack[depth:]:
            opened[e.tag] -= 1
        del stack[depth:]

    while at < len(html):
        m = _TEXT.match(html, at) or _COMMENT.match(html, at)
        tag = None if m else _TAG.match(html, at)
        if tag is None:
            text = m[0] if m else html[at]
            at += len(text)
            top = stack[-1]
            if (m and m.re is _COMMENT) or top.unseen:
                continue
            if now is None:
                holder = next((e for e in reversed(stack) if e.tag not in _INLINE), root)
                now = Block(top, holder, re.fullmatch("h[1-6]", holder.tag) is not None)
                found.append(now)
            now.parts.append(text)
            if top.link:
                now.link_chars += len(text.strip())
            continue
        bare = html[tag.end() : tag.end() + 1] == ">"
        named, end = ({}, tag.end() + 1) if bare else _attributes(html, tag.end())
        closed = html[end - 2 : end] == "/>"
        at, ends, name = end, bool(tag[1]), tag[2].lower()
        if name not in _INLINE:
            now = None
        if ends:
            if opened[name] > 0:
                depth = next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == name)
                if name not in _INLINE or all(e.tag in _INLINE for e in stack[depth:]):
                    close(depth)
            continue
        if name in _VOID:
            continue
        if name not in _INLINE:  # a block ends a paragraph, and an item the item before
            while stack[-1].tag in _INLINE or (stack[-1].tag == "p" or (stack[-1].tag == name and name in _CLOSES_SELF)):
                close(len(stack) - 1)
        if closed and name in ("svg", "path"):
            continue
        if len(stack) < DEEPEST:
            elements.append(_element(name, named, stack[-1], len(elements)))
            stack.append(elements[-1])
            opened[name] += 1
        if name in _RAW:
            over = re.compile(rf"</{name}[\s>/]", re.I).search(html, at)
            at = over.start() if over else len(html)
    for b in found:
        b.text = " ".join(entities.unescape("".join(b.parts)).split())
    found = [b for b in found if b.text]
    settle(elements, found)
    return found


def score(block: Block) -> float:
    """Classifier output: positive for content."""
    n = len(block.text.split(" "))
    return (
        BIAS
        + BOILER[block.parent.boiler]
        + CONTENT * block.parent.content
        + LINKS * min(1.0, block.link_chars / len(block.text))
        + WORDS * min(n, 20)
        + SENTENCE * block.text.rstrip("\"'”’)").endswith((".", "!", "?", "…", ":"))
        + HEADING * block.heading
        + PLAIN * (not block.link_chars and not block.parent.boiler)
        + NOTICE * (_COPYRIGHT.match(block.text) is not None or (n <= 60 and _COOKIES.search(block.text) is not None and not block.parent.content))
    )


def min_cut(terminals: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Labels of least cost: node i pays |terminals[i]| against its sign, an edge its weight if cut.

    A node whose terminal outweighs its edges keeps its sign in some optimum, so it is fixed and its edges
    move to its neighbours' terminals; maximum flow decides what is left. Ties fall to False.
    """
    n = len(terminals)
    weight, near = list(terminals), [dict() for _ in range(n)]
    for (i, j), w in edges.items():
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or abs(weight[i]) <= sum(near[i].values()):
            continue
        label[i] = weight[i] > 0
        for j, w in near[i].items():
            weight[j] += w if label[i] else -w
            del near[j][i]
            queue.append(j)
        near[i].clear()
    left = [i for i in range(n) if label[i] is None]
    if left:
        inside = _source_side(left, weight, near)
        for i in left:
            label[i] = i in inside
    return [bool(x) for x in label]


def _source_side(nodes: list[int], weight: list[float], near: list[dict]) -> set[int]:
    """Nodes that residual capacity still reaches from the source after a maximum flow (Dinic)."""
    source, sink = -1, -2
    room: dict[int, dict[int, float]] = {i: dict(near[i]) for i in nodes} | {source: {}, sink: {}}
    for i in nodes:
        a, b = (source, i) if weight[i] > 0 else (i, sink)
        if weight[i]:
            room[a][b] = room[a].get(b, 0.0) + abs(weight[i])
            room[b].setdefault(a, 0.0)
    tiny = 1e-9
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            a = queue.popleft()
            for b, r in room[a].items():
                if r > tiny and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return set(level)
        tries = {a: iter(list(room[a])) for a in level}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                steps = list(zip(path, path[1:]))
                flow = min(room[x][y] for x, y in steps)
                for x, y in steps:
                    room[x][y] -= flow
                    room[y][x] = room[y].get(x, 0.0) + flow
                path = [source]
                tries = tries | {x: iter(list(room[x])) for x, _ in steps}
                continue
            step = next((b for b in tries[a] if level.get(b) == level[a] + 1 and room[a][b] > tiny), None)
            if step is None:
                level[a] = -9
                path.pop()
            else:
                path.append(step)


def main_text(html: str | None) -> str:
    found = blocks(html or "")
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        if i:
            edges[i - 1, i] = ADJACENT
        parent = b.parent.parent or b.parent
        j = last.get(parent.number)
        if j is not None:
            edges[j, i] = edges.get((j, i), 0.0) + SIBLING
        last[parent.number] = i
    keep = min_cut([score(b) for b in found], edges)
    return " ".join(b.text for b, k in zip(found, keep) if k)


def extract(pages: DataFrame) -> DataFrame:
    """All columns of ``pages`` but html, and text and n_chars, per row; no shuffle.

    NULL or empty html gives an empty text; rows may repeat; columns named text or n_chars are replaced.
    Pages of any length are read whole, in time linear in their length.
    """
    pages = pages.drop("text", "n_chars")
    keep = [c for c in pages.columns if c != "html"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(batch.schema.get_field_index("html")).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep)]
                + [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=[*keep, "text", "n_chars"],
            )

    result = pages.select(*keep, F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return pages.mapInArrow(run, result)
