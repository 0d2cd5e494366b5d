"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. Pass one decides a block by its place (menus, side bars, forms,
adverts, comments and the like are out), by the share of its text that is links, by its length and by the share
of stop words. Names and forms tell nothing about an element that encloses the article: one with a main element,
an h1 or the longest article in it, or with most of the page's text while no article stands beside it. Short blocks, and longer ones in which hardly a word is a stop word, stay open. Pass two gives
an open block the label of the nearest decided block, a heading that of the next one; between two different ones at equal distance, and where a
page has no decided block, the place decides.

Defined cases: a null or empty page has the empty text; unclosed and crossed tags close at the next tag that
implies it; script, style and other elements of raw text reach to their end tag or the end of the page; other unread
elements nest and close with the block element around them, or at the next block where their end tag is missing; repeated rows are extracted each; a null id or url stays null. Other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Frequent words of the languages that pages are expected in.
STOP_WORDS = frozenset(
    """
    a about after all also an and are as at be been but by can for from had has have he her his i if in into is it its
    more no not of on one only or other our out she so some than that the their them then there these they this to up
    was we were what when which who will with would you your
    al como con de del desde donde el ella en entre era es esta este fue ha hay la las lo los más muy no nos o para pero
    por que se ser si sin sobre son su sus también un una uno y ya
    au aux avec ce ces cette comme dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou où par
    pas plus pour qu que qui sa sans se ses si son sont sur un une vous
    als am an auch auf aus bei bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich im
    in ist mit nach nicht noch nur oder sich sie sind so über um und uns von vor war wenn werden wie wird wir zu zum zur
    """.split()
)
# Elements by what they do to the text around them.
BLOCK_TAGS = frozenset(
    """
    address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1
    h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul
    """.split()
)
UNREAD_TAGS = frozenset(
    "audio button canvas head iframe math noscript object script select style svg template textarea title video".split()
)
RAW_TAGS = frozenset("head iframe script style textarea title".split())
OUTSIDE_TAGS = frozenset("aside dialog footer form menu nav".split())
NESTED_TAGS = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section "
    "table ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
OUTSIDE_NAMES = re.compile(
    r"ads?|advert\w*|alerts?|banners?|bread-?crumbs?|comments?|cookies?|consent|disqus|footer|ft|login|masthead|menus?|modal|nav\w*|"
    r"newsletter|notices?|pagination|popups?|promo\w*|related|replies|respond|share|sharing|side-?bars?|site-?header|"
    r"page-?header|topbar|social|sponsor\w*|subscribe|toolbar|widgets?",
    re.I,
)
# Parts of names that say where a thing is or that it is a box, and not what it is.
NEUTRAL_NAMES = re.compile(
    r"area|articles?|bar|block|body|bottom|box|buttons?|container|form|global|icons?|inner|items?|left|links?|list|main|outer|"
    r"page|panel|posts?|primary|right|secondary|section|site|stories|top|wrap|wrapper|\d[\dx]*|",
    re.I,
)
# Parts of names that are enough by themselves, whatever stands beside them.
TELLING_NAMES = re.compile(
    r"(?:^|[_-])(?:comments?|comment-?list|replies|reply|disqus|gdpr|consent|newsletter|sign-?up|subscribe|advert\w*|sponsor\w*)"
    r"(?:$|[_-])",
    re.I,
)
OUTSIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<more>(?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
WORD_TRIM = re.compile(r"^\W+|\W+$")

SHORT = 60
LONG = 140
STOP_LOW = 0.08
STOP_HIGH = 0.20
LINKS_HIGH = 0.5


@dataclass(eq=False)
class Element:
    tag: str
    parent: Element | None
    sure: bool  # beside the article by its tag or role, or hidden
    named: bool  # beside the article by its names, unless it encloses the article
    core: int  # number of the article or main element it stands in, 0 without one
    landmark: str = ""  # article or main, where it is one
    chars: int = 0
    lead: bool = False  # encloses a main element, an h1 or the longest article
    out: bool = False
    out_for_sure: bool = False


@dataclass
class Block:
    text: str
    link_chars: int
    place: Element
    heading: bool
    label: str = "open"
    outside: bool = False

    @property
    def core(self) -> int:
        return self.place.core

    @property
    def many_links(self) -> bool:
        return self.link_chars > LINKS_HIGH * len("".join(self.text.split()))


def beside(name: str) -> bool:
    """Whether a class or id names something beside the article.

    One part that speaks of comments, consent, sign-ups or adverts is enough; of other names each part must say so, or
    be neutral.
    """
    if OUTSIDE_NAMES.fullmatch(name) or TELLING_NAMES.search(name):
        return True
    parts = re.split("[_-]", name)
    named = [bool(OUTSIDE_NAMES.fullmatch(p)) for p in parts]
    return any(named) and all(n or NEUTRAL_NAMES.fullmatch(p) for n, p in zip(named, parts, strict=True))


def names_of(attributes: str) -> tuple[bool, bool, str]:
    """Whether an element's role or state, and whether its class or id puts it beside the article; its role."""
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)} if attributes else {}
    role = found.get("role", "").lower()
    named = any(beside(name) for k in ("class", "id") for name in found.get(k, "").split())
    hidden = "hidden" in found.get("aria-hidden", "") or found.get("aria-hidden") == "true"
    return hidden or role in OUTSIDE_ROLES - {"form"}, named or role == "form", role


def mark_outside(elements: list[Element], blocks: list[Block]) -> None:
    """Which elements stand beside the article; parents come before their children in ``elements``."""
    for b in blocks:
        b.place.chars += len(b.text)
    for el in reversed(elements[1:]):
        el.parent.chars += el.chars
    for el in elements[1:]:
        el.out_for_sure = el.parent.out_for_sure or el.sure
    total = elements[0].chars
    marks = [el for el in elements if el.landmark and not el.out_for_sure and not (el.named and el.landmark == "article")]
    articles = [el for el in marks if el.landmark == "article"]
    for el in [e for e in marks if e.landmark == "main"] + sorted(articles, key=lambda e: -e.chars)[:1]:
        el.lead = True
    for el in reversed(elements[1:]):
        el.parent.lead |= el.lead and not el.sure
    stands = any(el.chars >= LONG for el in marks)
    for el in elements[1:]:
        encloses = el.lead or (2 * el.chars > total and (el.core > 0 or not stands))
        el.out = el.parent.out or el.sure or (el.named and not encloses)
    for b in blocks:
        b.outside = b.place.out


def blocks_of(html: str) -> list[Block]:
    out: list[Block] = []
    root = Element("", None, False, False, 0)
    elements, stack = [root], [root]
    unread: list[tuple[str, int, str, bool]] = []  # open unread elements: tag, depth, block around it, ever closed
    last_ends: dict[str, int] = {}
    leaf = ""  # the open block that does not nest, such as p
    parts: list[str] = []
    link_chars, links, heading, cores, at, breaks = 0, 0, 0, 0, 0, 0

    def end_block() -> None:
        nonlocal link_chars, breaks
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, link_chars, stack[-1], heading > 0))
            stack[-1].lead |= heading == 1
        parts.clear()
        link_chars = breaks = 0

    def add(raw: str) -> None:
        nonlocal link_chars, breaks
        if unread:
            return
        text = unescape(raw)
        parts.append(text)
        if not text.isspace():
            breaks = 0
        if links:
            link_chars += len("".join(text.split()))

    while at < len(html):
        token = TOKEN.search(html, at)
        if token is None:
            add(html[at:])
            break
        if token.start() > at:
            add(html[at : token.start()])
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        closing = bool(token["close"])
        if tag in RAW_TAGS and not closing and not token["more"].endswith("/"):
            ends = "<body" if tag == "head" else f"</{tag}"
            stop = re.compile(rf"</{tag}\s*>|<body" if tag == "head" else rf"{ends}\s*>", re.I).search(html, at)
            if tag == "head" and stop is None:
                continue
            at = (stop.start() if stop and stop[0].lower().startswith("<body") else stop.end()) if stop else len(html)
            continue
        if tag in UNREAD_TAGS - RAW_TAGS:
            if not closing and not token["more"].endswith("/"):
                if tag not in last_ends:
                    ends = [m.start() for m in re.finditer(rf"</{tag}\s*>", html, re.I)]
                    last_ends[tag] = ends[-1] if ends else -1
                unread.append((tag, len(stack), leaf, last_ends[tag] >= at))
            elif closing:
                k = next((k for k in reversed(range(len(unread))) if unread[k][0] == tag), None)
                if k is not None:
                    del stack[unread[k][1] :]
                    del unread[k:]
            continue
        if unread and tag in BLOCK_TAGS:
            # Ends unread elements that have no end tag, and those in a p or the like that ends here.
            # The outermost one decides what is read, the innermost one what the next end tag closes.
            for k in (0, len(unread) - 1):
                _, depth, around, closed = unread[k]
                if not closed or (around == tag and (closing or tag not in NESTED_TAGS) and depth == len(stack)):
                    del unread[k:]
                    break
        if unread and tag not in NESTED_TAGS:
            continue
        if tag == "br":
            breaks += 1
            if breaks > 1:
                end_block()
            else:
                parts.append(" ")
        elif tag == "a":
            links = 0 if closing else 1
        elif tag in ("td", "th"):
            parts.append(" ")
        if tag in BLOCK_TAGS:
            if not unread:
                end_block()
                links = 0
                leaf = "" if closing or tag in NESTED_TAGS else tag
            heading = int(tag[1:]) if tag[0] == "h" and tag[1:].isdigit() and not closing else 0
            if closing and tag in NESTED_TAGS:
                places = [k for k, el in enumerate(stack) if el.tag == tag]
                if places:
                    del stack[places[-1] :]
                    while unread and unread[-1][1] > len(stack):
                        unread.pop()
            elif not closing and tag in NESTED_TAGS:
                sure, named, role = names_of(token["more"])
                core = stack[-1].core
                landmark = next((x for x in ("main", "article") if x in (tag, role)), "")
                if landmark:
                    cores += 1
                    core = core or cores
                if tag in ("body", "main"):
                    sure = named = False
                sure = sure or tag in OUTSIDE_TAGS - {"form"} or (tag == "header" and not core)
                elements.append(Element(tag, stack[-1], sure, named or tag == "form", core, landmark))
                stack.append(elements[-1])
    end_block()
    mark_outside(elements, out)
    return out


def stop_share(text: str) -> float:
    words = [WORD_TRIM.sub("", w).lower() for w in text.split()]
    words = [w for w in words if w]
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def decide(block: Block) -> str:
    """Pass one: good, bad or open. Within the article links alone do not make a block bad."""
    if block.outside or (block.many_links and not block.core):
        return "bad"
    if len(block.text) < SHORT:
        return "open"
    share = stop_share(block.text)
    if share >= STOP_HIGH or (len(block.text) >= LONG and share >= STOP_LOW):
        return "good"
    return "open"


def settle(blocks: list[Block]) -> None:
    """Pass two: open blocks take the label of the nearest decided one in the same place."""
    first = [b.label for b in blocks]
    last, left = None, []
    for k, label in enumerate(first):
        last = k if label != "open" else last
        left.append(last)
    following, right = None, [None] * len(blocks)
    for k in range(len(blocks) - 1, -1, -1):
        following = k if first[k] != "open" else following
        right[k] = following
    for k, block in enumerate(blocks):
        if block.label != "open":
            continue
        sides = (right[k],) if block.heading and right[k] is not None else (left[k], right[k])
        near = [j for j in sides if j is not None and (not block.core or blocks[j].core == block.core)]
        near = [j for j in near if not (block.core and first[j] == "bad")]
        found = {first[j] for j in near if abs(j - k) == min(abs(i - k) for i in near)}
        block.label = found.pop() if len(found) == 1 else ("good" if block.core else "bad")


def main_text(html: str | None) -> str:
    blocks = blocks_of(html) if isinstance(html, str) else []
    for b in blocks:
        b.label = decide(b)
    inside = sum(len(b.text) for b in blocks if b.core and not b.outside)
    if inside and inside >= sum(len(b.text) for b in blocks if not b.core and b.label == "good"):
        # The article element holds the article: what stands apart from it must be long running text by itself.
        for b in blocks:
            if not b.core and not (b.label == "good" and len(b.text) >= LONG and stop_share(b.text) >= STOP_HIGH):
                b.label = "bad"
    links = [bool(b.core) and b.many_links and len(b.text) < SHORT for b in blocks]
    for k, b in enumerate(blocks):
        # Within the article, short blocks of links are a list of links where they stand together.
        if links[k] and (links[k - 1 : k] == [True] or links[k + 1 : k + 2] == [True]):
            b.label = "bad"
    settle(blocks)
    if blocks and all(b.label == "bad" for b in blocks):
        # Nothing stands out: what is neither beside the article nor made of links; names count last.
        rest = [b for b in blocks if b.link_chars <= LINKS_HIGH * len(b.text)]
        for b in [b for b in rest if not b.outside] or [b for b in rest if not b.place.out_for_sure]:
            b.label = "good"
    return "\n".join(b.text for b in blocks if b.label == "good")


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    text = F.pandas_udf(lambda html: pd.Series([main_text(h) for h in html], dtype=object), "string")
    done = pages.select("page_id", "url", text("html").alias("text"))
    return done.withColumn("n_chars", F.length("text").cast("long"))
