"""The main region of a page as the maximum-scoring run of its tokens.

A page is a sequence of words and tags. Words score positive, tags negative; the
contiguous run of the highest sum is found in one scan. What a word or a tag is
worth is learned from labelled pages by its odds of lying in the content.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

# Elements by their role in HTML.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())  # text up to their own end tag
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FOREIGN = frozenset(("svg", "math"))  # in them, and only there, a slash closes an element
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table
    tbody td tfoot th thead tr ul""".split())
CONTENT = frozenset(("article", "main"))
#: Elements whose class, id and role speak of all they hold; those of a paragraph or a heading are its own.
CONTAINER = frozenset("""address aside center details dialog div dl fieldset figure footer form header menu nav ol section
    table tbody td tr ul""".split())
# What is believed to be no content before a page is seen: elements, and words in names of containers.
ASIDE = frozenset("nav footer aside form menu button head dialog select template noscript object svg math".split())
ASIDE_NAMES = frozenset("""ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment commenter comments
    consent cookie cookies discussion disqus feedback footer header menu modal nav navbar navigation newsletter notice
    popup promo promoted reactions related replies reply respond responses share sharing sidebar social sponsor
    sponsored subscribe toolbar widget""".split())
#: A name with one of these parts speaks of readers' comments, whatever the others.
COMMENT_NAMES = frozenset(("comments", "replies", "responses"))
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog".split())

_START = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*)|(?=>)))?")
_TAG_END = re.compile(r"[\s/]*>")
_NAME_PART = re.compile(r"[a-z]+")

PLAIN_WORD, ASIDE_WORD = 1.0, 0.02
PLAIN_TAG, INLINE_TAG = -1.0, -0.05


@dataclass
class Token:
    """A text (``tag`` empty) or a tag. ``inside``: the open element that holds a text, ``aside``: within
    an element that is never content, ``block``: the tag ends a block."""

    tag: str
    text: str = ""
    words: int = 0
    inside: str = ""
    block: bool = False
    aside: bool = False


def markup(page: str):
    """(kind, name, attributes, text) of a page by the rules of HTML: kind is "text", "start" or "end". A
    quote matters only behind ``=``, a raw element ends at its own end tag only (or with the page), and a
    tag that is never closed, like a comment, takes the rest of the page. A slash at the end of a start tag is the attribute "/"."""
    at, end = 0, len(page)
    while at < end:
        if page[at] != "<":
            to = page.find("<", at)
            to = end if to < 0 else to
            yield "text", "", {}, page[at:to]
            at = to
            continue
        m = _START.match(page, at)
        if m is None:
            if page.startswith("<!--", at):
                to = page.find("-->", at + (2 if page.startswith(("<!-->", "<!--->"), at) else 4))
                at = end if to < 0 else to + 3
            elif page[at + 1:at + 2] in ("!", "?", "/"):
                to = page.find(">", at)
                at = end if to < 0 else to + 1
            else:
                yield "text", "", {}, "<"
                at += 1
            continue
        name, attributes, at = m[2].lower(), {}, m.end()
        while (close := _TAG_END.match(page, at)) is None:
            a = _ATTRIBUTE.match(page, at)
            if a is None or a.end() == at:
                return  # the page ends inside a tag
            attributes.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
            at = a.end()
        at = close.end()
        if "/" in close[0]:
            attributes["/"] = ""
        yield "end" if m[1] else "start", name, attributes, ""
        if name in RAW and not m[1]:
            raw = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            at = raw.start() if raw else end


def _names(tag: str, attributes: dict[str, str]) -> set[str]:
    """Features of a container's names: ``#name`` for a whole class or id, ``#word`` for each word of one
    that is made of listed words alone (cookie-banner) and for words of COMMENT_NAMES, ``#role=..``."""
    out = set()
    for kind in ("class", "id") if tag in CONTAINER else ():
        for name in attributes.get(kind, "").lower().split():
            parts = _NAME_PART.findall(name)
            out.update(f"#{x}" for x in parts if ASIDE_NAMES.issuperset(parts) or x in COMMENT_NAMES)
            out.add(f"#{name}")
    if "role" in attributes:
        out.add("#role=" + attributes["role"].strip().lower())
    return out


@dataclass
class Element:
    """An element's token range, its features, and whether its end tag was seen."""

    tag: str
    features: frozenset
    start: int
    end: int = 0
    closed: bool = False


def parse(page: str) -> tuple[list[Token], list[Element]]:
    """Tokens of a page and its elements."""
    out: list[Token] = []
    stack: list[Element] = []
    elements: list[Element] = []
    is_open: Counter = Counter()

    def close(depth: int, at: int, seen: bool) -> None:
        while len(stack) > depth:
            e = stack.pop()
            is_open[e.tag] -= 1
            e.end, e.closed = at, seen
            elements.append(e)

    for kind, name, attributes, text in markup(page):
        at = len(out)
        if kind == "text":
            text = html.unescape(text)
            if out and not out[-1].tag and out[-1].text:
                out[-1].text += text
            else:
                out.append(Token("", text, inside=stack[-1].tag if stack else ""))
            continue
        if kind == "end":
            if is_open[name]:
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == name)
                close(depth + 1, at, False)
                close(depth, at, True)
            out.append(Token("/" + name, block=name in BLOCK))
            continue
        if name in BLOCK and stack and stack[-1].tag == "p" or name == "li" and stack and stack[-1].tag == "li":
            close(len(stack) - 1, at, True)
        out.append(Token(name, block=name in BLOCK, text="" if name != "br" else " "))
        foreign = name in FOREIGN or any(is_open[x] for x in FOREIGN)
        if name in VOID or name in RAW or foreign and "/" in attributes:
            continue
        page_header = name == "header" and not any(is_open[x] for x in CONTENT)
        is_open[name] += 1
        stack.append(Element(name, frozenset({"header@page" if page_header else name, *_names(name, attributes)}), at))
    close(0, len(out), False)
    for t in out:
        if not t.tag:
            t.words = len(t.text.split())
    return out, elements


def tokens(page: str, weights: Weights | None = None) -> tuple[list[Token], list[tuple[int, int]]]:
    """Tokens of a page with the words of asides marked, and the token ranges of its article and main elements.

    An element is an aside if one of its features is (``Weights.is_aside``), unless it was never closed
    (it may not swallow what follows), or holds a main or a large article, or is told by its names or is
    a form and holds most of the page's words."""
    weights = weights or Weights()
    out, elements = parse(page)
    count = [0]
    for t in out:
        count.append(count[-1] + t.words)
    held = lambda e: count[min(e.end, len(out))] - count[e.start]
    articles = [e for e in elements if e.tag in CONTENT]
    most = max((held(e) for e in articles if e.tag == "article"), default=0)
    large = sorted(e.start for e in articles if e.tag == "main" or 2 * held(e) >= most)
    edges = [0] * (len(out) + 2)
    for e in elements:
        if not e.closed or e.tag in ("html", "body", *CONTENT) or not any(map(weights.is_aside, e.features)):
            continue
        by_tag = weights.is_aside(e.tag) and e.tag != "form"
        holds_large = bisect_right(large, e.start) < bisect_left(large, e.end)
        if holds_large or not by_tag and 2 * held(e) > count[-1]:
            continue  # it wraps the content
        edges[e.start] += 1
        edges[e.end + 1] -= 1
    for t, depth in zip(out, accumulate(edges)):
        t.aside = depth > 0
    return out, [(e.start, e.end) for e in articles]


def believed_aside(feature: str) -> bool:
    """Whether an element's feature is an aside before any page is seen."""
    if feature.startswith("#role="):
        return feature[6:] in ASIDE_ROLES
    return feature[1:] in ASIDE_NAMES if feature.startswith("#") else feature in ASIDE or feature == "header@page"


@dataclass
class Weights:
    """Scores of words by the element that holds them, of tags, and of the features of elements (log odds
    that the words below are content)."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)
    features: dict[str, float] = field(default_factory=dict)

    def is_aside(self, feature: str) -> bool:
        known = self.features.get(feature)
        return believed_aside(feature) if known is None else known < -1.0

    def score(self, t: Token) -> float:
        if not t.tag:
            return t.words * (ASIDE_WORD if t.aside else self.words.get(t.inside, PLAIN_WORD))
        known = self.tags.get(t.tag)
        if known is None:
            known = PLAIN_TAG if t.block else INLINE_TAG
        return known


def region(page: list[Token], weights: Weights) -> tuple[int, int]:
    """(first, end) of the contiguous run with the highest sum; (0, 0) if no sum is positive."""
    best, best_range, total, start = 0.0, (0, 0), 0.0, 0
    for i, t in enumerate(page):
        if total <= 0.0:
            total, start = 0.0, i
        total += weights.score(t)
        if total > best:
            best, best_range = total, (start, i + 1)
    return best_range


def blocks(page: list[Token]) -> list[str]:
    """Texts of the blocks, white space folded; words of never-content elements are left out."""
    out, held = [], []
    for t in page:
        if t.block:
            out.append(" ".join("".join(held).split()))
            held = []
        if not t.aside:
            held.append(t.text)
    out.append(" ".join("".join(held).split()))
    return [b for b in out if b]


def main_text(page: str, weights: Weights) -> str:
    """The region's blocks, one a line. A region that lies at least half in an article or main element
    is widened by the whole element (the smallest that holds the whole region, if any does), so weak blocks
    at its ends stay."""
    found, articles = tokens(page, weights)
    a, b = region(found, weights)
    around = [(not x <= a <= b <= y, y - x, x, y) for x, y in articles if x < b and y > a and min(y, b) - max(x, a) >= (b - a) / 2]
    if a < b and around:
        _, _, x, y = min(around)
        a, b = min(a, x), max(b, y)
    return "\n".join(blocks(found[a:b]))


#: Words that the belief about an element's feature is worth.
PRIOR_WORDS = 30.0


def learn(pages: list[tuple[str, str]]) -> Weights:
    """Weights from (html, document text) pairs. A block is content if it is a line of the document or
    begins its first line (a title); a page's content runs from its first to its last such block. Tags
    and leaf elements are judged by lying in that run, features of elements by how many words below them
    are in content blocks, on top of what is believed of them."""
    words, tags, below = ({True: Counter(), False: Counter()} for _ in range(3))
    for page, text in pages:
        lines = [" ".join(line.split()) for line in text.split("\n")]
        known = {line for line in lines if line}
        title = next((line for line in lines if line), "")
        found, elements = parse(page)
        hits, content, start, held = [], [0] * len(found), 0, []
        for i, t in enumerate([*found, Token("/html", block=True)]):
            if t.block:
                block = " ".join("".join(held).split())
                if block and (block in known or (title.startswith(block) and found[start].tag[:1] == "h")):
                    hits += [start, i]
                    content[start:i] = [1] * (i - start)
                start, held = i, []
            held.append(t.text)
        if not hits:
            continue
        upto = {True: [0], False: [0]}
        for t, c in zip(found, content):
            upto[True].append(upto[True][-1] + (t.words if c else 0))
            upto[False].append(upto[False][-1] + (0 if c else t.words))
        for e in elements:
            for f in e.features if e.closed and e.tag not in ("html", "body") else ():
                for side, sums in upto.items():
                    below[side][f] += sums[e.end] - sums[e.start]
        for i, t in enumerate(found):
            inside = hits[0] <= i < hits[-1]
            if t.tag:
                tags[inside][t.tag] += 1
            elif t.words:
                words[inside][t.inside] += t.words
    odds = {kind: {k: math.log((n[True][k] + 0.5) / (n[False][k] + 0.5)) for k in n[True] | n[False]}
            for kind, n in (("words", words), ("tags", tags))}
    prior = lambda f, side: PRIOR_WORDS if believed_aside(f) != side else 1.0
    features = {f: math.log((below[True][f] + prior(f, True)) / (below[False][f] + prior(f, False)))
                for f in below[True] | below[False]}
    return Weights({k: max(ASIDE_WORD, min(2.0, v)) for k, v in odds["words"].items()},
                   {k: min(INLINE_TAG, v) for k, v in odds["tags"].items()}, features)
