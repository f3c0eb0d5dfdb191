"""Main text of web pages by tag-path ratios.

A block is the text between two block-level tags; its tag path is the chain of open
block-level elements from the root. For each path of a page the text length and the
punctuation of its blocks are added up: content paths have long, punctuated blocks,
boilerplate paths have short ones and links. The two ratios are smoothed along the page,
fused, and the paths above a threshold are content; the element that encloses most of their
text is the article, and all its blocks are kept, short ones and headings, too. An article or
main element is preferred where it encloses most of it, a teaser in one decides nothing. A
form is left out unless it encloses most of the page's text, as on pages that are one form.

Paths and elements are numbers with links to their parents, so a page takes memory in
proportion to its length, however deep it is nested.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from dayledger.llm.shared import ship

#: Elements whose content is never part of an article's text.
NEVER = frozenset(
    "script style noscript template iframe object svg math canvas audio video map select option button "
    "input textarea label nav header footer aside menu dialog head title".split()
)
#: Elements that start and end a block.
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre figure figcaption address center hr details summary fieldset form".split()
)
#: Elements without an end tag, and those whose text is not markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
#: Words in class, id or role by which pages name what surrounds an article.
SURROUNDINGS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner banners cookie "
    "cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login nav "
    "navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets header masthead footer foot "
    "copyright legal disclaimer share sharing social related recommended recommendations more-links tags "
    "pagination pager comment comments discussion replies respond disqus form search toolbar skip hidden "
    "complementary contentinfo alert toc".split()
)
#: First words of names that speak of other elements.
ABOUT = frozenset("has with without no not is js post article entry main content page single".split())
#: What an element of these names ends when it starts.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
_SCOPES = {"ul", "ol", "dl", "table", "select", "article", "section", "main", "div"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(>|\Z)", re.S
)
_UNQUOTED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>)")
_TAG_START = re.compile(r"</?[a-zA-Z]")
_NAMED = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")

#: Blocks on either side that smoothing looks at, and how quickly they count less.
RADIUS, SIGMA = 2, 1.0
#: Share of the page's best fused value that makes a path content.
THRESHOLD = 0.25


@dataclass
class Block:
    """Text, how much of it is linked, and the element and tag path it stands in (0: none)."""

    element: int
    path: int
    text: str
    linked: int


@dataclass
class Page:
    """Blocks in page order; name and parent of each element, parents before children."""

    blocks: list[Block] = field(default_factory=list)
    names: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [0])

    def enclosed(self, weights: list[int]) -> list[int]:
        """For each element the weight of all blocks inside it."""
        held = [0] * len(self.names)
        for b, weight in zip(self.blocks, weights, strict=True):
            held[b.element] += weight
        for n in range(len(held) - 1, 0, -1):
            held[self.parents[n]] += held[n]
        return held

    def inside(self, chosen: set[int]) -> list[bool]:
        """For each element whether it is one of those chosen or inside one."""
        out = [0 in chosen]
        for n in range(1, len(self.names)):
            out.append(n in chosen or out[self.parents[n]])
        return out


@dataclass
class _Open:
    name: str
    number: int
    path: int
    hidden: bool


def _surrounds(attributes: str) -> bool:
    for found in _NAMED.finditer(attributes):
        value = next(filter(None, found.groups()), "").lower()
        for name in value.split():
            words = _WORDS.findall(name)
            # "has-sidebar" tells something about what is inside, not that this is one.
            if name in SURROUNDINGS or words and words[0] not in ABOUT and SURROUNDINGS.intersection(words):
                return True
    return False


def parsed(page: str) -> Page:
    """The blocks outside of what is never content, in page order, with references decoded."""
    found = Page()
    paths: dict[tuple[int, str], int] = {}
    stack: list[_Open] = []
    text: list[str] = []
    linked = links = at = 0

    def close_block() -> None:
        nonlocal linked
        joined = " ".join(html.unescape("".join(text)).split())
        if joined and not (stack and stack[-1].hidden):
            element, path = (stack[-1].number, stack[-1].path) if stack else (0, 0)
            found.blocks.append(Block(element, path, joined, linked))
        text.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not (stack and stack[-1].hidden):
            text.append(piece)
            linked += len(piece) if links else 0

    size = len(page)
    while at < size:
        opens = page.find("<", at)
        if opens < 0:
            add(page[at:])
            break
        add(page[at:opens])
        tag = _MARKUP.match(page, opens)
        if tag is None:  # a quote is left open, or it is a sign and no tag
            tag = _UNQUOTED.match(page, opens)
        if tag is None:
            if _TAG_START.match(page, opens):  # cut off in the middle
                break
            add("<")
            at = opens + 1
            continue
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if name == "a":
            links = 0 if tag[1] else 1
        if name == "br":
            add(" ")
            continue
        edge = name in BLOCKS or name in NEVER
        if edge:
            close_block()
        if tag[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name), None)
            if depth is not None and (edge or depth == len(stack) - 1):
                del stack[depth:]
            continue
        if name in RAW and not tag[3].endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in VOID or not edge or tag[3].endswith("/"):
            continue
        if stack and stack[-1].name == "p" and name in BLOCKS:
            stack.pop()
        if name in _ENDS:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].name in _ENDS[name]:
                    del stack[i:]
                    break
                if stack[i].name in _SCOPES:
                    break
        hidden = bool(stack and stack[-1].hidden) or name in NEVER or _surrounds(tag[3])
        if name in ("html", "body", "main", "article"):
            hidden = bool(stack and stack[-1].hidden) or (name == "article" and _surrounds(tag[3]))
        above, over = (stack[-1].number, stack[-1].path) if stack else (0, 0)
        found.names.append(name)
        found.parents.append(above)
        path = paths.setdefault((over, name), len(paths) + 1)
        stack.append(_Open(name, len(found.names) - 1, path, hidden))
    close_block()
    return found


def _smoothed(values: list[float]) -> list[float]:
    weights = [math.exp(-0.5 * (k / SIGMA) ** 2) for k in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for k, w in zip(range(i - RADIUS, i + RADIUS + 1), weights, strict=True):
            if 0 <= k < len(values):
                total, weight = total + w * values[k], weight + w
        out.append(total / weight)
    return out


def _without_forms(page: Page) -> Page:
    """The page without forms that hold half of its unlinked text or less."""
    if "form" not in page.names:
        return page
    held = page.enclosed([max(0, len(b.text) - b.linked) for b in page.blocks])
    small = {n for n, name in enumerate(page.names) if name == "form" and 2 * held[n] <= held[0]}
    gone = page.inside(small)
    return Page([b for b in page.blocks if not gone[b.element]], page.names, page.parents)


def content_blocks(page: Page) -> list[Block]:
    """The blocks of the element that holds the content paths' text."""
    page = _without_forms(page)
    blocks = page.blocks
    if not blocks:
        return []
    sums: dict[int, list[float]] = {}
    for b in blocks:
        own = sums.setdefault(b.path, [0, 0, 0])
        own[0] += max(0, len(b.text) - b.linked)
        own[1] += len(_PUNCTUATION.findall(b.text))
        own[2] += 1
    lengths = _smoothed([sums[b.path][0] / sums[b.path][2] for b in blocks])
    marks = _smoothed([sums[b.path][1] / sums[b.path][2] for b in blocks])
    fused = [length * (1 + mark) for length, mark in zip(lengths, marks, strict=True)]
    best: dict[int, float] = {}
    for b, value in zip(blocks, fused, strict=True):
        best[b.path] = max(best.get(b.path, 0.0), value)
    chosen = {path for path, value in best.items() if value >= THRESHOLD * max(best.values())}
    # The text of chosen paths by enclosing element; the innermost with most of it is the article.
    held = page.enclosed([len(b.text) if b.path in chosen else 0 for b in blocks])
    most = [n for n in range(1, len(held)) if 2 * held[n] > held[0]]
    regions = [n for n in most if page.names[n] in ("article", "main")]
    if regions:
        article = max(regions, key=lambda n: (held[n], n))
    else:
        most = [n for n in most if page.names[n] not in ("p", "li", "td", "th")]
        if not most:
            return [b for b in blocks if b.path in chosen]
        article = max(most)
    kept = page.inside({article})
    return [b for b in blocks if kept[b.element]]


def main_text(page: str | None) -> str:
    """The article's blocks, joined by an empty line; empty for a page without any."""
    return "\n\n".join(b.text for b in content_blocks(parsed(page or "")))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points of text) of every row of pages.

    Whole pages are read, whatever their length. A null or empty page, or one without
    content, has an empty text. Rows are independent: repeated ones give repeated results,
    null ids and urls are kept. Markup that is cut off in the middle is dropped.
    """
    ship(pages.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(
        rows, "page_id long, url string, text string, n_chars long"
    )
