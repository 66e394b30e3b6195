"""Main text of web pages by scoring the containers of their paragraphs.

A page is read once into a flat tree. Every paragraph has points for its length and its commas, which
it passes on in full to the element that holds it, half to the next ancestor, a third to the one
after, and so on; an ``article`` or ``main`` gets the points of all its paragraphs in full. The points of
a container are discounted by its link density. The best container is kept: with the other articles
beside it that score well if it is an article or main, else with those siblings that score well, or
are headings or long paragraphs with few links.

Menus, headers, footers, sidebars, notices, adverts, forms and reader comments are left out, by element
and by the words of their class, id and role; scripts, styles and hidden elements too. A word counts
as part of a name (``cookie-notice``), but not behind ``has``, ``no``, ``with`` or the like. Such an element
is not left out if it turns out to hold the page: a form or an element with such a word around an
``article`` or ``main``, or around the page's heading and half of its points; or, where nothing else
on the page has text, the form, or else the element, that has most of it. Its points count a fifth.

Defined results: a null or empty page, or one without text, gives an empty string; the rest of an
unclosed comment, script or tag is not text; ``<`` before anything but a name is text; of equally
good containers the first one wins; repeated rows get a row each. Only ``page_id``, ``url`` and
``html`` are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TEXTS = "page_id long, url string, text string, n_chars long"

TAG = re.compile(r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)"
                 r"|(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>]++))?""")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
# the parts of a name: words between signs, or begun by a capital
NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
# words that turn the next one round, as in "no-sidebar"
TURNING = {"has", "no", "non", "not", "with", "without", "is", "hide", "show", "full"}

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template",
       "svg", "math", "object", "canvas"}
DROPPED = {"head", "nav", "header", "footer", "aside", "button", "select", "option", "menu", "dialog",
           "audio", "video", "map", "label"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr", "img", "picture", "source"}
PARAGRAPH = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "dt", "dd", "pre", "blockquote", "figcaption",
             "caption", "summary", "address"}
# lists and tables are paragraphs of what is around them
WRAPPERS = {"ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "tr", "colgroup", "figure", "details"}
HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
# a start tag of the key closes an open element of the values, if no table or list lies between
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"table", "ul", "ol", "dl", "body", "html", "td", "th", "article", "section", "div", "main"}
BOILERPLATE = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "adslot", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "commentlist", "complementary", "contentinfo", "cookie", "cookies", "consent", "disclaimer", "disqus", "footer",
    "foot", "footnav", "header", "masthead", "menu", "menus", "modal", "nav", "navbar", "navigation", "navi", "newsletter", "notice",
    "notices", "notification", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "respond", "search",
    "share", "sharing", "sidebar", "sidenav", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "tags",
    "toolbar", "topbar", "widget", "widgets"}


# Why an element may be left out: for what it is, or for a word or as a form, which other things can outweigh.
KEPT, HARD, SOFT = 0, 1, 2


def suspicion(tag: str, attributes: str) -> int:
    if tag in DROPPED:
        return HARD
    found = SOFT if tag in ("form", "fieldset") else KEPT
    if not attributes.strip(" /"):
        return found
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if (name == "hidden" or name == "aria-hidden" and value.lower() == "true"
                or name == "style" and NO_DISPLAY.search(value)):
            return HARD
        if name in ("class", "id", "role") and tag not in ("html", "body", "article", "main"):
            for token in value.split():
                words = [w.lower() for w in NAME.findall(token)]
                if any(w in BOILERPLATE and (not i or words[i - 1] not in TURNING) for i, w in enumerate(words)):
                    found = SOFT
    return found


class Page:
    """Elements with their parents, and text blocks as pieces with the elements they are in."""

    def __init__(self, source: str) -> None:
        self.tags, self.parents, self.suspects = ["#root"], [0], [KEPT]
        # holding element, pieces: the element each is in, the text, whether it is in a link
        self.blocks: list[tuple[int, list[tuple[int, str, bool]]]] = []
        stack, self.buffer, self.open = [0], [], {"#root": 1}
        self.in_link = 0

        def text(raw: str) -> None:
            if raw:
                self.buffer.append((stack[-1], html.unescape(raw), self.in_link > 0))

        def flush() -> None:
            if self.buffer:
                if any(not piece.isspace() for _, piece, _ in self.buffer):
                    holder = next(e for e in reversed(stack) if self.tags[e] not in INLINE)
                    self.blocks.append((holder, self.buffer))
                self.buffer = []

        at = 0
        while at < len(source):
            start = source.find("<", at)
            if start < 0:
                text(source[at:])
                break
            match = TAG.match(source, start)
            if not match:
                text(source[at:start + 1])
                at = start + 1
                continue
            text(source[at:start])
            at = match.end()
            if not match[2]:
                continue
            tag = match[2].lower()
            if match[1]:
                if tag in ("p", "br"):
                    flush()
                if tag in VOID or not self.open.get(tag):
                    continue
                if tag not in INLINE:
                    flush()
                while self.tags[stack[-1]] != tag:
                    self._pop(stack)
                self._pop(stack)
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
                if not match[3].endswith("/") or tag not in ("svg", "math"):
                    at = end.end() if end else len(source)
                continue
            if tag == "br":
                text(" ")
                continue
            if tag not in INLINE:
                flush()
                self._close(stack, tag)
            if tag in VOID:
                continue
            self.tags.append(tag)
            self.parents.append(stack[-1])
            self.suspects.append(suspicion(tag, match[3]))
            stack.append(len(self.tags) - 1)
            self.open[tag] = self.open.get(tag, 0) + 1
            self.in_link += tag == "a"
        flush()

    def _pop(self, stack: list[int]) -> None:
        tag = self.tags[stack.pop()]
        self.open[tag] -= 1
        self.in_link -= tag == "a"

    def _close(self, stack: list[int], tag: str) -> None:
        """Ends elements whose end tag the start of ``tag`` implies."""
        closes = CLOSES.get(tag, set())
        for depth in range(len(stack) - 1, 0, -1):
            open_tag = self.tags[stack[depth]]
            if open_tag == "p" or open_tag in closes:
                while len(stack) > depth:
                    self._pop(stack)
                if open_tag != "p":
                    break
            elif open_tag in SCOPE:
                break


def joined(pieces: list[tuple[int, str, bool]], out: list[bool]) -> tuple[str, int]:
    """The text of a block without the elements left out, and its characters within links."""
    pieces = [p for p in pieces if not out[p[0]]]
    return " ".join("".join(piece for _, piece, _ in pieces).split()), sum(len("".join(piece.split())) for _, piece, link in pieces if link)


def worth(text: str) -> float:
    return (len(text) >= 25) + text.count(",") + min(3.0, len(text) / 100)


def plain(text: str, links: int) -> int:
    """Characters outside links of a block that is long enough to be a paragraph."""
    return len(text) - links if len(text) >= 25 and links < len(text) / 2 else 0


LEAST_TEXT = 100  # characters that make an element worth keeping for want of any other


def left_out(page: Page) -> tuple[list[bool], list[bool]]:
    """Which elements are left out, and which were suspect and are kept."""
    tags, parents, suspects = page.tags, page.parents, page.suspects
    n = len(tags)
    nothing = [False] * n
    texts = [joined(pieces, nothing) for _, pieces in page.blocks]
    points, holds, heading, hard = [0.0] * n, [False] * n, [False] * n, [False] * n
    for (holder, _), (text, links) in zip(page.blocks, texts, strict=True):
        if plain(text, links):
            points[holder] += worth(text)
    for e in range(n):
        hard[e] = suspects[e] == HARD or (e > 0 and hard[parents[e]])
        holds[e] = tags[e] in ("article", "main") and not hard[e]
        heading[e] = tags[e] == "h1" and not hard[e]
    for e in range(n - 1, 0, -1):  # children come after their parents
        points[parents[e]] += points[e]
        holds[parents[e]] |= holds[e]
        heading[parents[e]] |= heading[e]
    excused = [suspects[e] == SOFT and (holds[e] or heading[e] and points[e] >= points[0] / 2 > 0) for e in range(n)]

    def out() -> list[bool]:
        found = [False] * n
        for e in range(1, n):
            found[e] = found[parents[e]] or suspects[e] != KEPT and not excused[e]
        return found

    found = out()
    if not any(plain(*joined(pieces, found)) for _, pieces in page.blocks):
        # the suspect with the most text, a form before one that is named so, and the way to its longest paragraph
        outer = [0] * n
        for e in range(1, n):
            outer[e] = outer[parents[e]] or (e if suspects[e] == SOFT else 0)
        sizes, longest = {}, {}
        for (holder, _), text in zip(page.blocks, texts, strict=True):
            if not hard[holder] and plain(*text):
                top = outer[holder]
                sizes[top] = sizes.get(top, 0) + plain(*text)
                longest[top] = max(longest.get(top, (0, 0)), (plain(*text), -holder))
        enough = [e for e, size in sizes.items() if size >= LEAST_TEXT]
        if enough:
            e = -longest[max(enough, key=lambda e: (tags[e] == "form", sizes[e], -e))][1]
            while e:
                excused[e] = suspects[e] == SOFT
                e = parents[e]
            found = out()
    return found, excused


def main_text(source: str | None) -> str:
    if not source:
        return ""
    page = Page(source)
    if not page.blocks:
        return ""
    tags, parents = page.tags, page.parents
    n = len(tags)
    out, excused = left_out(page)
    blocks = [(holder, *joined(pieces, out)) for holder, pieces in page.blocks if not out[holder]]
    blocks = [b for b in blocks if b[1]]
    # points as they are passed on, and those of all paragraphs within
    points, whole, chars, linked = ([0.0] * n for _ in range(4))
    for holder, text, links in blocks:
        own = worth(text)
        to = holder
        while tags[to] in PARAGRAPH or tags[to] in WRAPPERS:
            to = parents[to]
        for share in range(1, 6):
            points[to] += own / share
            if not to:
                break
            to = parents[to]
        whole[holder] += own
        chars[holder] += len(text)
        linked[holder] += links
    for e in range(n - 1, 0, -1):
        for sums in (whole, chars, linked):
            sums[parents[e]] += sums[e]

    def score(e: int, own: float) -> float:
        return own * (1 - linked[e] / chars[e]) * (0.2 if excused[e] else 1) if chars[e] else 0.0

    scores = [score(e, whole[e] if tags[e] in ("article", "main") else points[e]) for e in range(n)]
    best = max(range(n), key=lambda e: (scores[e], -e))
    kept = {best}
    if tags[best] in ("article", "main"):
        kept |= {e for e in range(1, n) if tags[e] == tags[best] and score(e, whole[e]) >= 0.2 * scores[best]}
    elif best:
        for e in range(1, n):
            if parents[e] == parents[best] and chars[e]:
                density = linked[e] / chars[e]
                if (score(e, whole[e]) >= 0.2 * scores[best] or tags[e] in HEADING and density < 0.5
                        or tags[e] in PARAGRAPH and density < 0.25 and chars[e] >= 80):
                    kept.add(e)
    inside = [False] * n
    for e in range(n):
        inside[e] = e in kept or (e > 0 and inside[parents[e]])
    return " ".join(text for holder, text, _ in blocks if inside[holder])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length in code points; one pass over the pages, no shuffle."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [main_text(h if isinstance(h, str) else None) for h in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"].astype("Int64"), "url": b["url"], "text": found,
                                "n_chars": [len(t) for t in found]})

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInPandas(rows, TEXTS)
