"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams events; elements that hold no article text
(scripts, menus, forms, and what a role calls so) are marked as they open.
Containers whose class or id ends in a word for a part beside the article, or whose
class starts with a word for adverts, are marked too, unless they hold a main element
or, on pages without an article outside them, an article or most of the text, or their
id repeats the heading they start with. Every block-level border ends a line.

A line's ratio is its characters outside links over its tags (marked lines: 0). Ratios
are smoothed by a Gaussian along the page; the threshold is their standard deviation.
A line is content if its smoothed ratio passes the threshold and its own ratio does
too, or is that of a sentence (``SENTENCE``) where the threshold is higher. The content
region is the sibling article (or main) elements with most of the content's characters
if there are such, else the smallest container with all content lines. In it all stays
between the first and the last content line but lines of links in the low cluster (in
an article, those in lists stay). Outside these two a line stays only in a list or
container that holds content: the article itself counts as one, a whole page does not.
Headings that lead to the first content line stay.

Defined results: null and empty pages give the empty text, as do pages with
nothing but marked elements. Character references are decoded, white space in a
line is one space, lines are joined by a blank line.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import map_slices

# HTML element names by role, and words that name parts beside the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb "
                   "rp rt s samp small span strike strong sub sup time tt u var wbr".split())
BESIDE = frozenset("script style noscript template head title nav footer aside form button select option textarea "
                   "input iframe object embed svg canvas audio video dialog menu map datalist applet".split())
CONTAINERS = frozenset("html body article main section div td th tr table tbody center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol dl".split())
PARAGRAPH_ENDS = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 "
                           "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article main section div body html nav aside footer header form".split())
BESIDE_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising adbox adslot banner banners sponsor "
    "sponsored sponsors promo promos promotion sidebar sidebars menu menus nav navbar navigation breadcrumb "
    "breadcrumbs footer masthead notice notices alert cookie cookies consent gdpr privacy popup popups modal overlay "
    "comment comments commentlist reply replies respond disqus discussion share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup login signin search widget widgets toolbar pagination "
    "pager paywall disclaimer skiplink".split())
AD_WORDS = frozenset("ad ads adsense advert adverts advertisement advertisements advertising adbox adslot sponsored".split())
TOPIC_WORDS = frozenset(  # as ids these may be made from the words of an article's heading
    "advertisement advertisements advertising promotion navigation notice notices alert cookie cookies consent gdpr "
    "privacy comment reply replies respond discussion share sharing social related recommended recommendations "
    "newsletter subscribe subscription signup login signin search banner banners overlay widget widgets toolbar ads "
    "sponsors promos sponsored menus popups pagination disclaimer paywall".split())
NAMED = CONTAINERS - {"html", "body"} | frozenset("ul ol dl li dt dd".split())
BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu "
                         "menubar toolbar".split())
NEGATED = frozenset("has with no without".split())
SMOOTHING = 1.0
SENTENCE = 40.0  # characters a tag
LINK_SHARE = 0.6
UNFINISHED = re.compile(r"<[/!?]?[a-zA-Z][^<>]*\Z")
MASS_SHARE = 0.5


def name_words(name: str) -> list[str]:
    words = re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()
    return [w for w in re.split(r"[^a-z]+", words) if w]


def names_beside(tag: str, attrs: dict[str, str | None]) -> str | None:
    """How a class or id names a part beside the article: ``sure``, ``topic`` (an id that a heading may have made), or not.

    Paragraphs and other elements that are no containers are named by advert classes only.
    """
    topic = False
    for key in ("class", "id"):
        for name in (attrs.get(key) or "").split():
            words = name_words(name)
            if not words or words[0] in NEGATED:
                continue
            if key == "class" and (words[-1] in AD_WORDS or words[0] in AD_WORDS):
                return "sure"
            if tag in NAMED and words[-1] in BESIDE_WORDS:
                if key == "class" or words[-1] not in TOPIC_WORDS:
                    return "sure"
                topic = True
    return "topic" if topic else None


class Node:
    """A container or list: its number in page order, the last number inside it, and its parent."""

    __slots__ = ("tag", "number", "last", "parent", "outer", "box")

    def __init__(self, tag: str, number: int, parent: Node | None):
        self.tag, self.number, self.last, self.parent = tag, number, float("inf"), parent
        #: the outermost article or main element around it
        self.outer = parent.outer if parent and parent.outer else self if tag in ("article", "main") else None
        #: the innermost container that is no list
        self.box = parent.box if tag in LISTS and parent else self

    def holds(self, other: Node) -> bool:
        return self.number <= other.number <= self.last


class Line:
    """A run of text between block borders."""

    __slots__ = ("parts", "tags", "linked", "beside", "node", "heading", "named", "text", "chars")

    def __init__(self, beside: bool, node: Node, heading: bool, named: int):
        self.parts, self.tags, self.linked = [], 0, 0
        self.beside, self.node, self.heading, self.named = beside, node, heading, named


class PageLines(HTMLParser):
    """Turns parser events into lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        root = Node("", 0, None)
        # open elements: (tag, marked, innermost container, in article, heading, innermost element marked by name)
        self.open: list[tuple] = [("", False, root, False, False, -1)]
        self.count: Counter = Counter()  # open elements by tag
        # elements marked by name: attributes, how, the one around it, whether inside an article
        self.names: list[tuple[dict, str, int, bool]] = []
        self.holders: dict[str, set[int]] = {"article": set(), "main": set()}  # the innermost of them around such an element
        self.lines: list[Line] = []
        self.line: Line | None = None
        self.tags, self.links, self.number = 0, 0, 0

    def border(self) -> None:
        if self.line is not None:
            self.line.tags = self.tags
            self.lines.append(self.line)
            self.line = None
        self.tags = 0

    def close_until(self, tags, stop=()) -> None:
        """Closes up to the innermost of ``tags`` that is open inside the innermost of ``stop``."""
        if not any(self.count[t] for t in tags):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at][0] in tags:
                around = self.open[at - 1][2]
                for tag, _, node, *_ in self.open[at:]:
                    self.links -= tag == "a"
                    self.count[tag] -= 1
                    if node is not around:
                        node.last = self.number
                del self.open[at:]
                return
            if self.open[at][0] in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.border()
        if tag in PARAGRAPH_ENDS:
            self.close_until({"p"}, SCOPES)
        if tag in SIBLINGS:
            self.close_until(SIBLINGS[tag], SCOPES - {tag})
        self.tags += 1
        if tag == "br" and self.line is not None:
            self.line.parts.append(" ")
        if tag in VOID:
            return
        attrs = dict(attrs)
        _, marked, node, in_article, heading, named = self.open[-1]
        if not marked:
            style = (attrs.get("style") or "").replace(" ", "").lower()
            marked = (tag in BESIDE or (tag == "header" and not in_article) or "hidden" in attrs
                      or attrs.get("aria-hidden") == "true" or "display:none" in style
                      or (attrs.get("role") or "").lower() in BESIDE_ROLES)
        if not marked:
            article = tag in ("article", "main") and not in_article
            if (how := names_beside(tag, attrs)) and (not article or comment_like(attrs)):
                self.names.append((attrs, how, named, in_article))
                named = len(self.names) - 1
            elif article and named >= 0:
                self.holders[tag].add(named)
        if tag in CONTAINERS or tag in LISTS:
            self.number += 1
            node = Node(tag, self.number, node)
        self.open.append((tag, marked, node, in_article or tag in ("article", "main"), heading or tag in HEADINGS, named))
        self.count[tag] += 1
        self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.border()
        self.tags += 1
        if tag not in VOID:
            self.close_until({tag})

    def handle_data(self, data):
        if self.line is None:
            if not data.strip():
                return
            _, marked, node, _, heading, named = self.open[-1]
            self.line = Line(marked, node, heading, named)
        _, marked, *_ = self.open[-1]
        if marked and not self.line.beside:
            return  # a marked inline element inside a line
        if self.line.beside and not marked:
            self.border()
            return self.handle_data(data)
        self.line.parts.append(data)
        if self.links:
            self.line.linked += len(data.strip())

    def done(self) -> list[Line]:
        self.close()
        self.border()
        for line in self.lines:
            line.text = " ".join("".join(line.parts).split())
            line.chars = len(line.text)
        return [x for x in self.lines if x.text]


def comment_like(attrs: dict[str, str | None]) -> bool:
    names = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()
    return bool(re.search(r"comment|reply|related|teaser|promo|sponsor|advert", names))


def smoothed(values: np.ndarray, sigma: float = SMOOTHING) -> np.ndarray:
    """Gaussian smoothing; at the ends the weights inside are scaled to sum to one."""
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[reach:reach + len(values)]
    return np.convolve(values, kernel)[reach:reach + len(values)] / weight


def main_text(html: str | None) -> str:
    """The text of a page's content region, lines joined by a blank line."""
    if not html:
        return ""
    parser = PageLines()
    parser.feed(UNFINISHED.sub("", html))  # a page may end inside a tag
    lines = parser.done()
    if not any(not x.beside for x in lines):
        return ""
    if parser.names:
        marked = marked_by_name(parser, clustered(lines)[2], lines)
        for x in lines:
            x.beside = x.beside or (x.named >= 0 and marked[x.named])
        if not any(not x.beside for x in lines):
            return ""
    high, content, mass = clustered(lines)
    if not sum(mass):
        content = np.array([not x.beside for x in lines])
        mass = [0 if x.beside else x.chars for x in lines]
    articles, root = region(lines, mass)
    inside = [not x.beside and (x.node.outer in articles if articles else root.holds(x.node)) for x in lines]
    held = [at for at in range(len(lines)) if inside[at] and content[at]]
    if not held:  # an article of marked or linked lines only
        held = [at for at in range(len(lines)) if inside[at]]
    first, last = held[0], held[-1]
    numbers = sorted({lines[at].node.number for at in held})

    def holds_content(node: Node) -> bool:
        at = bisect_left(numbers, node.number)
        return at < len(numbers) and numbers[at] <= node.last

    if articles:  # what follows an article's first heading is in it
        first = next((at for at in range(first) if inside[at] and lines[at].heading), first)
    lead = [False] * (len(lines) + 1)  # headings right before the content
    for at in range(len(lines) - 2, -1, -1):
        lead[at] = lines[at].heading and not lines[at].beside and (
            lead[at + 1] or (inside[at + 1] if articles else at + 1 == first))
    keep = []
    for at, x in enumerate(lines):
        if x.beside or not (inside[at] or lead[at]):
            continue
        if not high[at] and x.linked > LINK_SHARE * x.chars and not (articles and x.node.tag in LISTS):
            continue
        whole_page = not articles and x.node is root and root.tag in ("", "html", "body")
        if first <= at <= last or lead[at] or (
                holds_content(x.node) or (articles and holds_content(x.node.box))) and not whole_page:
            keep.append(x.text)
    return "\n\n".join(keep)


def clustered(lines: list[Line]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Per line whether it is in the high cluster, whether it is content, and its characters if it is, outside link lists."""
    ratio = np.array([0.0 if x.beside else max(0, x.chars - x.linked) / max(1, x.tags) for x in lines])
    smooth = smoothed(ratio)
    threshold = smooth.std()
    shown = np.array([not x.beside for x in lines])
    high = (smooth >= threshold) & shown
    content = shown & (ratio >= min(threshold, SENTENCE)) & (high | (ratio >= SENTENCE))
    return high, content, [x.chars if c and x.linked <= LINK_SHARE * x.chars else 0 for x, c in zip(lines, content)]


def marked_by_name(parser: PageLines, mass: list[int], lines: list[Line]) -> list[bool]:
    """Per element marked by name: whether it, or one around it, is beside the article.

    Not so if it holds a main element, if its id repeats its first heading nor, if no
    article or main element with text lies outside all of them, if it holds an
    article or most of the mass.
    """
    names = parser.names
    alone = not any(x.node.outer for x in lines if not x.beside and x.named < 0)
    held, main, article = [0] * len(names), [False] * len(names), [False] * len(names)
    start: list[Line | None] = [None] * len(names)
    for x, m in zip(lines, mass):
        if x.named >= 0:
            held[x.named] += m
            if not x.beside and start[x.named] is None:
                start[x.named] = x
    for k in range(len(names) - 1, -1, -1):
        around = names[k][2]
        main[k] = main[k] or k in parser.holders["main"]
        article[k] = article[k] or k in parser.holders["article"]
        if around >= 0:
            held[around] += held[k]
            main[around], article[around] = main[around] or main[k], article[around] or article[k]
    marked = [False] * len(names)
    for k, (attrs, how, around, _) in enumerate(names):
        x = start[k]
        titled = how == "topic" and x is not None and x.heading and set(name_words(attrs.get("id") or "")) <= set(
            name_words(x.text))
        spared = main[k] or titled or (alone and (article[k] or (
            held[k] > MASS_SHARE * sum(mass) and not comment_like(attrs))))
        marked[k] = not spared or (around >= 0 and marked[around])
    return marked


def region(lines: list[Line], mass: list[int]) -> tuple[set[Node], Node]:
    """The article or main elements that hold the content, else none and the container that does.

    They are siblings with more than ``MASS_SHARE`` of the mass, else the smallest
    container, lists apart, with all of it.
    """
    siblings: dict[Node, int] = {}
    roots: dict[Node, set[Node]] = {}
    for x, m in zip(lines, mass):
        if x.node.outer and not x.beside:
            around = x.node.outer.parent
            siblings[around] = siblings.get(around, 0) + m
            roots.setdefault(around, set()).add(x.node.outer)
    best = max(siblings, key=siblings.get, default=None)
    if best is not None and siblings[best] > MASS_SHARE * sum(mass):
        return roots[best], best
    shared = None
    for x, m in zip(lines, mass):
        if m:
            shared = shared or x.node
            while not shared.holds(x.node):
                shared = shared.parent
    if shared is None:
        shared = lines[0].node
        while shared.parent:
            shared = shared.parent
    return set(), shared.box


def extract(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", keep: tuple = ("url",)) -> DataFrame:
    """Per page: the id, the columns ``keep``, ``text`` and ``n_chars`` (code points)."""
    def run(piece):
        texts = [main_text(h) for h in piece.column(1).to_pylist()]
        return {"id": piece.column(0), "text": texts, "n_chars": [len(t) for t in texts],
                **{c: piece.column(2 + i) for i, c in enumerate(keep)}}

    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"), *keep)
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("id", *keep))
    return map_slices(rows, run, f"{kinds}, text string, n_chars long", 64).withColumnRenamed("id", id_col)
