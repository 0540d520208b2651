"""Main text of HTML pages by composite text density.

For every element the density is its characters per tag, lowered by the share of them in links. The
block whose child blocks' densities have the largest sum holds the article (a block without any
counts by its own); menus and headers take part,
and lose by their links. The least density on the path from the body down to it is the threshold for
text outside of it, and for link lists and hinted sections inside. Of elements with equal sums one in
an ``article`` or ``main`` counts first. Tags and names tell only what densities cannot: that a dense
text is an advert, a form, a footer, a notice or a comment.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .shared import free_name, small_batches

# Element names of HTML by their role.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img",
    "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
    "sup", "time", "tt", "u", "var", "wbr",
}
BOILERPLATE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "input", "fieldset", "head"}
#: Of these, the ones that take part in the choice by density.
RIVALS = {"nav", "menu", "header"}
#: Elements that open tags of the same list end, and where the search for them stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: Words in a class, id or role that name something other than the article.
HINTS = {
    "ad", "ads", "adbox", "adv", "advert", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo",
    "promoted", "promotion", "nav", "navbar", "navigation", "navi", "menu", "submenu", "breadcrumb", "breadcrumbs", "footer",
    "sidebar", "sidebars", "aside", "complementary", "contentinfo", "rail", "cookie", "cookies", "consent", "gdpr", "notice",
    "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share",
    "sharing", "social", "related", "recommended", "recommendations", "trending", "popular", "widget", "widgets", "pagination",
    "pager", "toolbar", "search", "masthead", "teaser", "teasers", "disclaimer", "copyright", "skip", "form", "dialog",
}
COMMENT_HINTS = {"comment", "comments", "commentlist", "respond", "reply", "replies", "disqus", "discussion", "feedback"}
HEADER_HINTS = {"header", "banner", "masthead"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

#: Keeps the logarithm's base apart from one on pages without links.
LEAST_ROOT = 0.05

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+>|<[!?/][^>]*+(?:>|\Z)|</?[a-zA-Z][^>]*+\Z",
    re.DOTALL,
)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)(.*)>?\Z", re.DOTALL)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|/|=|$)", re.IGNORECASE)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_WORD = re.compile(r"[a-z]+")
_STATE = re.compile(r"\b(?:has|with|no|without|is|not)[-_]+[a-z]+")


@dataclass
class Element:
    tag: str
    parent: int
    boilerplate: bool
    hidden: bool = False
    hinted: bool = False
    comments: bool = False
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    children: list[int] = field(default_factory=list)
    density: float = 0.0
    density_sum: float = 0.0
    #: left out whatever its density; the top of a part that only a hint leaves out
    never: bool = False
    aside: bool = False
    #: in an ``article`` or ``main``; is or holds a heading
    semantic: bool = False
    headed: bool = False
    #: left out by its tag alone, but takes part in the choice; not to be chosen
    rival: bool = False
    barred: bool = False
    #: no block with text inside: its density stands for the sum, whatever inline elements it holds
    leaf: bool = True


class Open:
    """The open elements, with the places of each tag and of those that aren't inline."""

    def __init__(self) -> None:
        self.stack, self.tags, self.blocks = [0], [""], [0]
        self.places: dict[str, list[int]] = {"": [0]}

    def push(self, element: int, tag: str) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(element)
        self.tags.append(tag)

    def cut(self, depth: int) -> None:
        """End the element at ``depth`` and all that it holds."""
        while len(self.stack) > depth:
            self.stack.pop()
            self.places[self.tags.pop()].pop()
        while self.blocks[-1] >= depth:
            self.blocks.pop()

    def last(self, tags: set[str] | tuple[str, ...]) -> int:
        """Depth of the innermost open element of ``tags``; -1 for none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def close(self, tags: set[str], until: set[str]) -> None:
        """End the innermost open element of ``tags``, unless one of ``until`` is open inside of it."""
        depth = self.last(tags)
        if depth > 0 and depth > self.last(until):
            self.cut(depth)


def composite_density(chars: int, tags: int, link_chars: int, link_tags: int, link_share: float) -> float:
    """Characters per tag, times a logarithm that falls with the share of links in the element;
    ``link_share`` is that of the whole page. Zeros count as one."""
    t, lc, lt, plain = max(1, tags), max(1, link_chars), max(1, link_tags), max(1, chars - link_chars)
    root = math.log(chars / plain * link_chars + link_share * chars + math.e)
    fall = math.log(chars / lc * t / lt) / max(math.log(root), LEAST_ROOT)
    return chars / t * (max(fall, 0.0) if link_chars else max(fall, 0.01))


def _hints(attributes: str) -> tuple[bool, bool, bool, bool]:
    """Whether attributes hide an element, name something beside the article, comments, or a header."""
    hidden = bool(_HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)))
    words: set[str] = set()
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role", "data-role", "itemprop"):
            words.update(_WORD.findall(_STATE.sub(" ", _CAMEL.sub("-", value).lower())))
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            hidden = True
        elif name == "aria-hidden" and value.lower() == "true":
            hidden = True
    return hidden, bool(words & HINTS), bool(words & COMMENT_HINTS), bool(words & HEADER_HINTS)


class Page:
    """The elements of a page and its runs of text, in page order."""

    def __init__(self, source: str):
        self.elements = [Element("", -1, False)]
        #: text, element, number of the block
        self.runs: list[tuple[str, int, int]] = []
        self._parse(source)
        self._measure()

    def _parse(self, source: str) -> None:
        elements, open_, block, at, size = self.elements, Open(), 0, 0, len(source)
        stack = open_.stack
        while at < size:
            found = _MARKUP.search(source, at)
            text = source[at : found.start()] if found else source[at:]
            if text:
                self.runs.append((text, stack[-1], block))
            if not found:
                break
            at = found.end()
            closing, tag, attributes = found.group(1), found.group(2), found.group(3)
            if tag is None:
                loose = _NAME.match(found.group())
                if not loose or not found.group().endswith(">"):
                    continue
                closing, tag, attributes = loose.groups()
            tag = tag.lower()
            if tag not in INLINE:
                block += 1
            elif tag == "br":
                self.runs.append((" ", stack[-1], block))
            if closing:
                depth = open_.last((tag,))
                # the end of an inline element doesn't reach beyond the block that it stands in
                if depth > 0 and not (tag in INLINE and open_.blocks[-1] > depth):
                    open_.cut(depth)
                continue
            if tag in RAW and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(source, at)
                at = end.end() if end else size
                continue
            if tag not in INLINE:
                open_.close({"p"}, {"td", "th", "div", "li", "body", "article", "section", "main", "blockquote"})
            if tag in ENDS:
                open_.close(*ENDS[tag])
            if tag in ("html", "body") and open_.last((tag,)) > 0:
                continue
            if tag == "body":
                open_.close({"head"}, set())
            parent = stack[-1]
            hidden, hinted, comments, header = _hints(attributes) if attributes else (False,) * 4
            in_article = open_.last(("article", "main")) > 0
            role = tag in BOILERPLATE or hidden or (tag == "header" and not in_article)
            hinted |= header and not in_article
            whole = tag in ("html", "body", "main") or (tag == "article" and not comments)
            elements.append(
                Element(tag, parent, role and tag not in ("html", "body"), hidden, hinted and not whole and tag not in HEADINGS, comments and not whole)
            )
            elements[-1].semantic = in_article or tag in ("article", "main")
            elements[parent].children.append(len(elements) - 1)
            if tag not in VOID:
                open_.push(len(elements) - 1, tag)

    def _measure(self) -> None:
        elements = self.elements
        own = [0] * len(elements)
        for text, owner, _ in self.runs:
            own[owner] += len("".join(text.split()))
        # a hint on what holds the article itself, or most of the page in paragraphs, is no hint
        whole, paragraphs = own[:], [int(e.tag == "p") for e in elements]
        holds = [e.tag == "main" or (e.tag == "article" and not e.comments) for e in elements]
        for i in range(len(elements) - 1, 0, -1):
            up = elements[i].parent
            whole[up] += whole[i]
            paragraphs[up] += paragraphs[i]
            holds[up] |= holds[i]
        for i, e in enumerate(elements):
            e.never = (e.boilerplate and (e.tag not in RIVALS or e.hidden)) or (e.comments and not holds[i])
            most = paragraphs[i] > 1 and 2 * whole[i] > whole[0]
            e.rival = e.boilerplate and not e.never
            if e.comments or (e.hinted and not most):
                e.boilerplate |= not holds[i]
                e.rival &= holds[i]
        for i in range(1, len(elements)):
            e, up = elements[i], elements[elements[i].parent]
            e.aside = e.boilerplate and not (e.never or up.boilerplate or e.tag in RIVALS)
            e.barred = up.barred or (e.boilerplate and not e.rival)
            e.boilerplate |= up.boilerplate
            e.never |= up.never
        for i in range(len(elements) - 1, 0, -1):
            elements[i].headed |= elements[i].tag in HEADINGS
            elements[elements[i].parent].headed |= elements[i].headed
        in_link = [False] * len(elements)
        for i in range(1, len(elements)):
            in_link[i] = elements[i].tag == "a" or in_link[elements[i].parent]
        for i in range(len(elements) - 1, -1, -1):
            e = elements[i]
            if e.never:
                continue
            e.chars += own[i]
            e.link_chars += own[i] if in_link[i] else 0
            if i and not e.aside:  # what a hint leaves out is measured by itself
                up = elements[e.parent]
                up.chars += e.chars
                up.link_chars += e.link_chars
                up.tags += e.tags + 1
                up.link_tags += e.link_tags + (e.tag == "a")
        body = elements[self.body()]
        base = body.link_chars / max(1, body.chars)
        for i in range(len(elements) - 1, -1, -1):
            e = elements[i]
            if not e.never and e.chars:
                e.density = composite_density(e.chars, e.tags, e.link_chars, e.link_tags, base)
            if e.leaf:
                e.density_sum = e.density
            if i and not e.aside and e.tag not in INLINE and e.chars and not e.never:
                elements[e.parent].density_sum += e.density
                elements[e.parent].leaf = False

    def body(self) -> int:
        return next((i for i, e in enumerate(self.elements) if e.tag == "body"), 0)

    def path(self, i: int) -> list[int]:
        """From the element up to the body or the top."""
        out = []
        while i >= 0:
            out.append(i)
            if self.elements[i].tag == "body":
                break
            i = self.elements[i].parent
        return out

    def content(self) -> set[int]:
        """Elements whose own text belongs to the article."""
        elements = self.elements
        usable = [i for i, e in enumerate(elements) if e.chars and not e.barred and e.tag not in INLINE]
        if not usable:
            return set()
        best = max(usable, key=lambda i: (elements[i].density_sum, elements[i].semantic, elements[i].chars, -i))
        if elements[best].density_sum == 0:
            best = max(usable, key=lambda i: (elements[i].density, elements[i].semantic, -i))
        up = self.path(best)
        threshold = min(elements[i].density for i in up)
        on_path, chosen = set(up), {best}
        for i in up[1:]:
            for child in elements[i].children:
                e = elements[child]
                few_links = e.link_chars * 2 < e.chars
                dense = e.density >= threshold > 0 and few_links and e.density_sum > 0
                headline = child < best and few_links and e.headed
                if child not in on_path and not e.boilerplate and (dense or headline):
                    chosen.add(child)
        out: set[int] = set()
        for i in range(len(elements)):
            e = elements[i]
            if e.never or (e.rival and i not in on_path):
                continue
            dense = e.density >= threshold > 0
            if e.aside and not (e.semantic and dense and 2 * e.link_chars < e.chars):
                continue
            if i in chosen or (e.parent in out and (dense or not self._link_list(i))):
                out.add(i)
        return out

    def _link_list(self, i: int) -> bool:
        """A block that is little but several links is a menu."""
        e = self.elements[i]
        return e.tag not in INLINE and e.tag != "p" and e.link_tags >= 3 and 10 * e.link_chars >= 8 * e.chars

    def text(self) -> str:
        inside = self.content()
        blocks: dict[int, list[str]] = {}
        for text, owner, block in self.runs:
            if owner in inside:
                blocks.setdefault(block, []).append(text)
        lines = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
        return "\n".join(line for line in lines if line)


def main_text(source: str) -> str:
    """The article of a page: white space inside a block is one space, blocks are lines."""
    return Page(source).text() if source else ""


def extract(pages: DataFrame, source: str = "html") -> DataFrame:
    """The rows with a column ``text`` (the main text; empty if none) and ``n_chars`` (its code points)
    in place of ``source``. Null counts as empty. Other columns stay; where they have these names, the
    new ones take the next free names. Pages are parsed where they are read."""
    small_batches(pages.sparkSession)
    others = [c for c in pages.columns if c != source]
    rest = pages.select(*[F.col(f"`{c}`") for c in others])
    text, size = free_name(rest, "text"), free_name(rest, "n_chars")
    rows = pages.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{source}`").cast("string"))
    schema = T.StructType([*rest.schema.fields, T.StructField(text, T.StringType()), T.StructField(size, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(s or "") for s in batch.column(len(others)).to_pylist()]
            added = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *added], schema.names)

    return rows.mapInArrow(run, schema)
