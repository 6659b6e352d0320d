"""Main text of web pages by composite text density.

A page is parsed into a DOM. Menus, footers, forms, scripts and hidden elements
are cut by their tag. Words of class, id and role only raise a suspicion, which
the text under the element decides (``settle``): a wrapper round most of the page
is kept whatever its class says, an advert or a reader comment goes, and an element
with a doubtful word ("related", "alert") goes where it is short or mostly links.

Each remaining node gets its characters, tags, link characters and link tags;
its composite density is its characters per tag, scaled down by the share of
links. The node of the largest density gives a threshold, the least density on
its path to the body; from the body down, each node that reaches it gives its
descendant of the largest sum of child densities (of blocks). The main subtree is that of the
largest sum in the body; the page's text is it, the others chosen, the subtrees
beside it of at least ``HALF`` of its sum and half the threshold, the headings that
stand before it, and what stands between these, but for link lists. An article
element round it is taken whole. A short unmarked element outside the main subtree
that none of these reaches is left out: nothing tells it from a footer.

Text: character references decoded, white space in a block one space, blocks in
page order joined by one line feed; ``br`` is white space, a table cell a block.

Defined results: null and empty pages, and pages without text, give the empty
text; unclosed, misnested and cut-off markup is read as far as it goes, in time
linear in the page's tags; rows are read each on their own; extra columns are
carried along (``text`` is replaced).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
                   "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main nav ol option p pre section summary table tbody td tfoot th thead "
                   "title tr ul").split())
#: Elements that are never main text.
CUT = frozenset(("head title script style noscript template nav footer aside form button input select textarea label iframe svg canvas object "
                 "dialog menu").split())
#: Words of class, id and role of what is not main text, unless most of the page stands in it.
CUES = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments commentlist disqus reply "
                  "replies respond reader readers sidebar nav navbar navigation menu breadcrumb breadcrumbs footer cookie cookies consent gdpr "
                  "notice notices banner popup modal overlay newsletter subscribe subscription contentinfo complementary paywall toolbar "
                  "pagination pager").split())
#: Words that also name parts of articles: the text decides.
DOUBTS = frozenset("alert share sharing social related recommended recommendations widget widgets login signup search".split())
#: A doubtful part of an article stays from this many words, elsewhere from this share of the page's text; none with this share of links.
DOUBT_WORDS, DOUBT_SHARE, LINK_SHARE = 8, 0.2, 0.5
#: A suspected wrapper stays with this share of the page's text, or with most of it and a title or article in it.
WRAPPER = 0.9
#: Share of the main subtree's sum from which a subtree beside it is a part of the same text.
HALF = 0.2
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: A start of the first closes an open one of the others, up to a scope.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}}
_WORDS = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


class Dom(HTMLParser):
    """Elements in page order: tag, parent, cut or not; and the texts between their tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.cut = ["#root"], [-1], [False]
        self.suspects: list[tuple[int, bool, bool]] = []  # element, only doubtful, in an article
        self.texts: list[tuple[int, int, str]] = []  # element, block, text
        self.open, self.block = [0], 0
        self.count: Counter = Counter()  # open elements by tag
        self.open_blocks: list[int] = []  # depths of open block elements

    def _close(self, depth: int) -> None:
        while len(self.open) > depth:
            tag = self.tags[self.open.pop()]
            self.count[tag] -= 1
            if tag in BLOCK:
                self.open_blocks.pop()
                self.block += 1

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body") and self.count[tag]:
            return
        if tag in CLOSES:
            stop, closed = SCOPE.get(tag, {"table"}), CLOSES[tag]
            d = len(self.open) - 1
            while d > 0 and any(self.count[c] for c in closed):
                name = self.tags[self.open[d]]
                if name in stop:
                    break
                if name in closed:
                    self._close(d)
                d -= 1
        elif tag in BLOCK and self.open_blocks and self.tags[self.open[self.open_blocks[-1]]] == "p":
            self._close(self.open_blocks[-1])  # a block ends an open paragraph
        me = len(self.tags)
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        self.cut.append(self.cut[self.open[-1]] or self._is_cut(me, tag, attrs))
        self.block += tag in BLOCK
        if tag == "br":
            self.texts.append((me, self.block, " "))
        if tag not in VOID:
            if tag in BLOCK:
                self.open_blocks.append(len(self.open))
            self.open.append(me)
            self.count[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in ("svg", "path"):  # foreign elements do close themselves
            self.handle_endtag(tag)

    def _is_cut(self, me: int, tag: str, attrs: list) -> bool:
        in_article = bool(self.count["article"] or self.count["main"])
        if tag in CUT or tag == "header" and not in_article:
            return True
        if tag in ("html", "body", "main"):
            return False
        cue = doubt = False
        for name, value in attrs:
            value = (value or "").lower()
            if name in ("class", "id", "role"):
                found = set(_WORDS.findall(value))
                cue |= not CUES.isdisjoint(found)
                doubt |= not DOUBTS.isdisjoint(found)
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and _HIDDEN.search(value):
                return True
        if cue or doubt:
            self.suspects.append((me, not cue, in_article))
        return False

    def handle_endtag(self, tag):
        if not self.count[tag]:
            return
        for d in range(len(self.open) - 1, 0, -1):
            name = self.tags[self.open[d]]
            if name == tag:
                self._close(d)
                return
            if name in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html", "article"):
                return

    def handle_data(self, data):
        self.texts.append((self.open[-1], self.block, data))


def settle(dom: Dom) -> None:
    """Cut the suspects whose text agrees, and all below them."""
    if not dom.suspects:
        return
    n = len(dom.tags)
    chars, word, links, title = [0] * n, [0] * n, [0] * n, [False] * n
    linked = [False] * n
    for e in range(n):
        linked[e] = dom.tags[e] == "a" or e > 0 and linked[dom.parents[e]]
        title[e] = dom.tags[e] in ("h1", "article", "main")
    for e, _, text in dom.texts:
        if not dom.cut[e]:
            parts = text.split()
            size = sum(map(len, parts))
            chars[e] += size
            word[e] += len(parts)
            links[e] += size * linked[e]
    for e, _, _ in dom.suspects:
        title[e] = False
    holds = list(title)
    for e in range(n - 1, 0, -1):
        if not dom.cut[e]:
            p = dom.parents[e]
            chars[p] += chars[e]
            word[p] += word[e]
            links[p] += links[e]
            holds[p] |= holds[e]
    whole = chars[0]
    for e, doubtful, in_article in dom.suspects:
        wrapper = chars[e] >= WRAPPER * whole or 2 * chars[e] > whole and holds[e]
        if doubtful and not wrapper and links[e] < LINK_SHARE * chars[e]:
            wrapper = word[e] >= DOUBT_WORDS if in_article else chars[e] >= DOUBT_SHARE * whole
        dom.cut[e] = dom.cut[e] or not wrapper
    for e in range(1, n):
        dom.cut[e] = dom.cut[e] or dom.cut[dom.parents[e]]


def densities(dom: Dom) -> tuple[list[float], list[float], int]:
    """Composite density and sum of child densities of every element; the body."""
    n = len(dom.tags)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for e, _, text in dom.texts:
        if not dom.cut[e]:
            chars[e] += len("".join(text.split()))
    linked = [False] * n
    for e in range(n):
        p = dom.parents[e]
        linked[e] = dom.tags[e] == "a" or p >= 0 and linked[p]
        if linked[e]:
            link_chars[e] = chars[e]
    for e in range(n - 1, 0, -1):
        if not dom.cut[e]:
            p = dom.parents[e]
            chars[p] += chars[e]
            link_chars[p] += link_chars[e]
            tags[p] += tags[e] + 1
            link_tags[p] += link_tags[e] + (dom.tags[e] == "a")
    body = next((e for e in range(n) if dom.tags[e] == "body"), 0)
    body_share = link_chars[body] / max(chars[body], 1)
    block = [t in BLOCK for t in dom.tags]  # blocks and what holds some: a word in bold is no part of a sum
    for e in range(n - 1, 0, -1):
        block[dom.parents[e]] |= block[e]
    density, total = [0.0] * n, [0.0] * n
    for e in range(n - 1, -1, -1):
        c, t, lc, lt = chars[e], max(tags[e], 1), max(link_chars[e], 1), max(link_tags[e], 1)
        if c and not dom.cut[e]:
            base = math.log(c / max(c - link_chars[e], 1) * link_chars[e] + body_share * c + math.e)
            density[e] = c / t * math.log(c / lc * t / lt + 1) / math.log(max(base, 1.0) + 1)
        if e and block[e]:
            total[dom.parents[e]] += density[e]
    return density, total, body


def main_elements(dom: Dom) -> set[int]:
    """Roots of the subtrees that hold the main text."""
    density, total, body = densities(dom)
    n = len(dom.tags)
    if not any(density):
        return set()
    path = max(range(n), key=lambda e: density[e])
    threshold = density[path]
    while path != body and dom.parents[path] >= 0:
        path = dom.parents[path]
        threshold = min(threshold, density[path])
    # the element of the largest sum in each subtree; the first of equal ones
    best = list(range(n))
    for e in range(n - 1, 0, -1):
        p = dom.parents[e]
        if total[best[e]] > total[best[p]] or total[best[e]] == total[best[p]] and best[p] != p and best[e] < best[p]:
            best[p] = best[e]
    chosen, reached = set(), [False] * n
    for e in range(n):
        p = dom.parents[e]
        reached[e] = (e in (0, body) or p >= 0 and reached[p]) and not dom.cut[e]
        if reached[e] and density[e] >= threshold:
            chosen.add(best[e])
        elif e not in (0, body):
            reached[e] = False
    main = best[body]
    chosen = {e for e in chosen if e > body} | {main}
    around, at = set(), main
    while at >= body:
        around.add(at)
        if dom.tags[at] in ("article", "main"):
            chosen.add(at)
        at = dom.parents[at]
    chars, links, headed = _shares(dom)
    beside = [e for e in range(body + 1, n) if density[e] and e not in around and dom.parents[e] in around - {main}]
    parts = {e for e in beside if density[e] >= threshold / 2 and total[e] >= HALF * total[main]}
    parts |= {e for e in beside if e < main and headed[e] == chars[e] and (dom.tags[e] in HEADINGS or links[e] < chars[e])}
    if parts:  # what stands between them belongs to the text, too, but for link lists
        first, last = min(parts | {main}), max(parts | {main})
        parts |= {e for e in beside if first < e < last and links[e] < LINK_SHARE * chars[e]}
    return chosen | parts


def _shares(dom: Dom) -> tuple[list[int], list[int], list[int]]:
    """Characters under every element: all, those in links, those in headings."""
    n = len(dom.tags)
    linked, head = [False] * n, [False] * n
    for e in range(1, n):
        p = dom.parents[e]
        linked[e], head[e] = dom.tags[e] == "a" or linked[p], dom.tags[e] in HEADINGS or head[p]
    chars, links, headed = [0] * n, [0] * n, [0] * n
    for e, _, text in dom.texts:
        if not dom.cut[e]:
            size = sum(map(len, text.split()))
            chars[e] += size
            links[e] += size * linked[e]
            headed[e] += size * head[e]
    for e in range(n - 1, 0, -1):
        for sums in (chars, links, headed):
            sums[dom.parents[e]] += sums[e]
    return chars, links, headed


def main_text(html: str | None) -> str:
    if not html:
        return ""
    dom = Dom()
    dom.feed(html)
    dom.close()
    settle(dom)
    roots = main_elements(dom)
    inside = [False] * len(dom.tags)
    for e in range(len(dom.tags)):
        inside[e] = (e in roots or dom.parents[e] >= 0 and inside[dom.parents[e]]) and not dom.cut[e]
    blocks: list[tuple[int, list[str]]] = []
    for e, block, text in dom.texts:
        if inside[e]:
            if not blocks or blocks[-1][0] != block:
                blocks.append((block, []))
            blocks[-1][1].append(text)
    lines = (" ".join("".join(parts).split()) for _, parts in blocks)
    return "\n".join(x for x in lines if x)


def main_texts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with ``text``, their main text. Narrow."""

    def run(batches):
        for batch in batches:
            yield {"text": [main_text(h) for h in batch[html]]}

    return map_columns(pages, run, [html], [("text", T.StringType())], keep=[c for c in pages.columns if c != html])


def digest(texts: DataFrame) -> DataFrame:
    """The contract's columns of ``main_texts``."""
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
