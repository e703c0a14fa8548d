"""Main text of web pages by tag-path ratios.

A page is cut into blocks: runs of text inside one block element, inline markup included. A block's tag path leads from the root to that
element, with class and id names. Blocks of one path belong together, as pages are made from templates. For each path,
text length and punctuation are summed and divided by its number of blocks. The length ratio is smoothed over neighbouring
blocks, fused with the punctuation ratio and with what the path's own names say, and paths under a threshold are dropped. Paths that
name a part of the page's frame (menus, footers, adverts, comments) are never content, unless only a class or id says so and an article or main element
lies inside, or the same element is also named content. The kept paths select the region, and blocks of other paths
inside the region (headings, short paragraphs, lists) stay as well.

Defined results: NULL or empty html, or a page without content, gives empty text. Unclosed, misnested and unknown tags are taken as browsers take them, roughly:
a paragraph ends where the next block starts, an end tag without a start is ignored. Pages are independent, so
repeated rows give repeated results. Extra columns are ignored. A quote that is open to the end of the page does not hide tags; a tag that never ends is text. Time and memory grow
with a page's length, also for deep nesting and for broken markup.
"""

from __future__ import annotations

import functools
import html
import math
import re
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statforge.llm.shared import map_columns

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_QUOTE_OR_END = re.compile(r"""[>"']""")
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
_PUNCTUATION = re.compile(r"[.,;:!?…。，¿¡]")
_WORDS = re.compile(r"[A-Za-z]+")

# Names of HTML.
_RAW = frozenset(("script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"))
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
_INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "ruby", "rt", "rp"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_FRAME = frozenset(("nav", "header", "footer", "aside", "form", "button", "select", "option", "menu", "dialog", "object", "svg", "canvas", "audio", "video", "map", "head", "fieldset", "input", "datalist", "math"))
_CONTENT = frozenset(("article", "main"))
_ENDS_ITSELF = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_LISTS = frozenset(("ul", "ol", "dl", "table", "select", "menu"))
# Words in class and id names that mark the frame of a page.
_FRAME_WORDS = frozenset(("ad", "ads", "advert", "adverts", "advertisement", "advertising", "adbox", "banner", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "header", "masthead", "topbar", "footer", "foot", "bottom", "sidebar", "side", "aside", "widget", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "search", "form", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "discussion", "related", "recommended", "share", "sharing", "social", "tags", "pagination", "pager", "toolbar", "copyright", "legal", "disclaimer", "skip", "teaser", "contentinfo", "complementary"))
_CONTENT_NAMES = frozenset(("article", "content", "main"))
_CONTENT_WORDS = frozenset(("article", "content", "main", "post", "entry", "story", "body", "text"))


@dataclass(frozen=True)
class Node:
    """An open element: ``barred`` by its tag or because it is hidden, ``named`` as frame by class or id."""

    tag: str
    step: str
    barred: bool
    named: bool
    content: bool


class Place(NamedTuple):
    """What holds for text inside an element of a path."""

    barred: bool = False
    named: bool = False
    content: bool = False
    heading: bool = False
    header: bool = False  # in a header of the content

    def inside(self, node: Node) -> Place:
        content = self.content or node.content
        own = node.tag == "header" and self.content
        return Place(
            self.barred or node.barred and not own,
            (self.named or node.named and not own) and node.tag not in _CONTENT,
            content,
            self.heading or node.tag in _HEADINGS,
            self.header or node.tag == "header" and content,
        )

    @property
    def frame(self) -> bool:
        return self.barred or self.named or self.header and not self.heading


class Paths:
    """Tag paths as numbers: each knows its last step and the path before it, which has a smaller number."""

    def __init__(self) -> None:
        self.before, self.tags, self.outer = [-1], [""], [-1]
        self.numbers: dict[tuple[int, str], int] = {}

    def longer(self, path: int, node: Node) -> int:
        number = self.numbers.setdefault((path, node.step), len(self.tags))
        if number == len(self.tags):
            self.before.append(path)
            self.tags.append(node.tag)
            # The outermost article or main element on the path.
            self.outer.append(self.outer[path] if self.outer[path] >= 0 else number if node.tag in _CONTENT else -1)
        return number

    def region(self, path: int) -> int:
        """The outermost article or main element of a path, else the element around its last block."""
        if self.outer[path] >= 0:
            return self.outer[path]
        return self.before[path] if path and self.tags[path] not in ("div", "section", "body", "td") else path

    def within(self, regions: set[int]) -> list[bool]:
        """Whether each path lies in one of ``regions``."""
        found: list[bool] = []
        for path, before in enumerate(self.before):
            found.append(path in regions or before >= 0 and found[before])
        return found


@dataclass
class Block:
    path: int
    frame: bool
    content: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@functools.lru_cache(4096)
def described(tag: str, attributes: str) -> Node:
    """What a start tag says of its element."""
    names = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _NAMES.finditer(attributes)} if "=" in attributes else {}
    labels = f"{names.get('class', '')} {names.get('id', '')}".split()
    words = {w for label in labels for w in _WORDS.findall(label)} | set(names.get("role", "").split())
    whole = tag in ("html", "body")
    named = not whole and bool(words & _FRAME_WORDS) and not _CONTENT_NAMES.intersection(labels)
    return Node(
        tag,
        ".".join((tag, *sorted(re.sub(r"\d+", "", label) for label in labels))),
        tag in _FRAME or bool(_HIDDEN.search(attributes)),
        named,
        tag in _CONTENT or not whole and bool(words & _CONTENT_WORDS),
    )


def tag_end(page: str, at: int, quotes: bool) -> tuple[int, bool]:
    """Where the tag whose name ends at ``at`` has its ``>``, and whether quotes still count: they don't once one is open to the page's end.

    There must be a ``>`` at or after ``at``.
    """
    place = at
    while quotes:
        found = _QUOTE_OR_END.search(page, place)
        if found is None:
            break
        if found[0] == ">":
            return found.start(), True
        close = page.find(found[0], found.end())
        if close < 0:
            break
        place = close + 1
    return page.find(">", at), False


def blocks(page: str, paths: Paths | None = None) -> list[Block]:
    """The text blocks of a page, in page order, scripts and other invisible text left out."""
    paths = Paths() if paths is None else paths
    found: list[Block] = []
    stack: list[tuple[str, int, Place]] = []
    opened: dict[str, int] = {}
    current: Block | None = None
    links, at, end, last, quotes = 0, 0, len(page), page.rfind(">"), True

    def text(piece: str) -> None:
        nonlocal current
        if current is None:
            if not piece.strip():
                return
            _, path, place = stack[-1] if stack else ("", 0, Place())
            current = Block(path, place.frame, place.content)
            found.append(current)
        piece = html.unescape(piece)
        current.parts.append(piece)
        if links:
            current.linked += len(piece)

    def close(names: tuple[str, ...], until: frozenset[str]) -> None:
        """Close the innermost open element of these names, not looking past ``until``."""
        if not any(opened.get(name) for name in names):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                for tag, _, _ in stack[i:]:
                    opened[tag] -= 1
                del stack[i:]
                return
            if stack[i][0] in until:
                return

    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            text(page[at:])
            break
        if mark > at and (current is not None or not page[at:mark].isspace()):
            text(page[at:mark])
        if page.startswith("<!--", mark):
            stop = page.find("-->", mark + 4)
            at = stop + 3 if stop >= 0 else end
            continue
        if mark > last:  # no tag ends here any more
            at = page.find("<!--", mark)
            at = at if at >= 0 else end
            text(page[mark:at])
            continue
        if page.startswith(("<!", "<?"), mark):
            at = page.find(">", mark) + 1
            continue
        match = _TAG.match(page, mark)
        if not match:
            text("<")
            at = mark + 1
            continue
        stop, quotes = tag_end(page, match.end(), quotes)
        attributes, tag, at = page[match.end() : stop], match[2].lower(), stop + 1
        if match[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in _INLINE:
                continue
            current = None
            close((tag,), frozenset())
            continue
        if tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = stop.end() if stop else end
            if tag not in _INLINE:
                current = None
            continue
        closed = attributes.endswith("/")
        if tag in _INLINE:
            if tag == "a" and not closed:
                links += 1
            continue
        current = None
        if tag in _VOID:
            continue
        close(("p",), _CONTENT | _LISTS | frozenset(("div", "section", "td", "th", "button", "body")))
        if tag in _ENDS_ITSELF:
            close(_ENDS_ITSELF[tag], _LISTS)
        if closed:
            continue
        node = described(tag, attributes)
        _, path, place = stack[-1] if stack else ("", 0, Place())
        stack.append((tag, paths.longer(path, node), place.inside(node)))
        opened[tag] = opened.get(tag, 0) + 1
        links = 0
    for block in found:
        block.text = " ".join("".join(block.parts).split())
    return [block for block in found if block.text]


def path_scores(page: list[Block], spread: float = 1.0) -> dict[int, float]:
    """The fused score of every tag path of the page."""
    length: dict[int, int] = {}
    marks: dict[int, int] = {}
    linked: dict[int, int] = {}
    number: dict[int, int] = {}
    for block in page:
        content = block.text
        length[block.path] = length.get(block.path, 0) + len(content)
        marks[block.path] = marks.get(block.path, 0) + len(_PUNCTUATION.findall(content))
        linked[block.path] = linked.get(block.path, 0) + min(block.linked, len(content))
        number[block.path] = number.get(block.path, 0) + 1
    ratio = [length[block.path] / number[block.path] for block in page]
    reach = max(1, math.ceil(2 * spread))
    weights = [math.exp(-((d / spread) ** 2) / 2) for d in range(-reach, reach + 1)]
    smooth: dict[int, float] = {}
    for i, block in enumerate(page):
        near = [(weights[d + reach], ratio[i + d]) for d in range(-reach, reach + 1) if 0 <= i + d < len(page)]
        smooth[block.path] = smooth.get(block.path, 0.0) + sum(w * r for w, r in near) / sum(w for w, _ in near)
    prior = {block.path: 0.0 if block.frame else 4.0 if block.content else 1.0 for block in page}
    return {
        path: prior[path] * (smooth[path] / number[path]) * (0.25 + marks[path] / number[path]) * (1 - linked[path] / max(1, length[path])) ** 2 + prior[path] * 1e-6 for path in number
    }


def main_text(page: str | None, share: float = 0.2) -> str:
    """The page's content blocks, joined by spaces. ``share`` of the best path's score is the threshold."""
    paths = Paths()
    page_blocks = blocks(page or "", paths)
    if not page_blocks:
        return ""
    scores = path_scores(page_blocks)
    best = max(scores.values())
    if best <= 0:
        return ""
    inside = paths.within({paths.region(path) for path, score in scores.items() if score >= share * best})
    return " ".join(b.text for b in page_blocks if not b.frame and inside[b.path])


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page; no shuffle."""

    def work(ids, urls, texts):
        found = [main_text(text) for text in texts]
        return {"page_id": ids, "url": urls, "text": found, "n_chars": [len(text) for text in found]}

    return map_columns(pages.select("page_id", "url", F.col("html")), "page_id bigint, url string, text string, n_chars bigint", work)
