"""Main text of web pages by tag-path ratios.

A page is read as a run of text blocks, each with the path of block elements
from the root to it. Blocks on one path are likely to be of one kind, so text
length and punctuation are summed up per path: the text ratio of a path is its
characters per block, its punctuation ratio the marks of a sentence per block.
Both ratios are laid over the blocks in page order, smoothed with a Gaussian,
multiplied, more under article or main, and paths above a threshold, a share of the spread of the page's
values, hold the content. Elements that never hold an article (scripts, forms,
navigation and the like, by tag or role, and what is hidden) are left out
before. An element whose class or id is a listed word, such as an advert, a
sidebar or reader comments, is left out unless the article, or the page's title
with most of its text, begins inside it. A name that has a listed word in it is a hint only: a small
element goes, in a larger one, which may be the layout around the article,
ratios are lowered. Ids of headings and sections are their titles and name
nothing. A form goes unless it frames the layout of the page or is mostly text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements by the way they take part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math canvas object audio video xmp noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var".split()
)
APART = frozenset("nav header footer aside button select menu dialog fieldset head".split())
LAYOUT = frozenset("article main nav header footer aside h1".split())  # a form around one of these is the frame of a page
CONTROLS = frozenset("input select textarea button".split())
PROSE = frozenset("ul ol dl blockquote pre table figure".split())  # what stands among paragraphs
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr"}),
    "th": ({"td", "th"}, {"tr"}),
    "option": ({"option"}, {"select"}),
}
ROLES_APART = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
# Words of class and id that name what is not the article.
NAMED_APART = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer disqus "
    "footer footnav header masthead login menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo "
    "promotion recommended related reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription "
    "teaser toc toolbar topbar tracking widget widgets alert contentinfo complementary search dialog".split()
)
ARTICLE_TAGS = frozenset("article main".split())
# A quotation mark only opens a value right after the equals sign.
_TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|$))|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)((?>[^>=]|=\s*\"[^\"]*(?:\"|$)|=\s*'[^']*(?:'|$)|=)*+)(?:>|$))", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=>/\"']+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|$)|'([^']*)(?:'|$)|([^\s>]*)))?|\"[^\"]*(?:\"|$)|'[^']*(?:'|$)")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_MARKS = re.compile(r"[.,;:!?、。，！？]")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: int  # characters inside links
    named: tuple[int, ...] = ()  # open elements whose names say that they are not the article, and forms

    @property
    def way(self) -> tuple:
        """The path, apart from the same path in an element named otherwise."""
        return (bool(self.named), *self.path) if self.named else self.path

    @property
    def marked(self) -> bool:
        return not ARTICLE_TAGS.isdisjoint(self.path)

    @property
    def unlinked(self) -> int:
        return max(0, len(self.text) - self.linked)


# Shares of a page's unlinked text above which an element is not left out for its name: named in part, named wholly.
SMALL = (0.25, 0.5)
WORDY = 400  # unlinked characters for each control from which on a form is text
LOWERED = 0.25  # of the fused ratio inside a larger element with such a name
MARKED = 10.0  # times the fused ratio under article or main
SLUGS = frozenset("section article main".split()) | HEADINGS


def _attributes(text: str) -> dict[str, str]:
    """Attributes by name in small letters, the first of each."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        if m[1]:
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def _apart(tag: str, attributes: dict[str, str]) -> bool:
    """Whether the element holds none of the article by its tag or role, or is hidden."""
    if tag in APART or "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", ""), re.I):
        return True
    return tag not in ARTICLE_TAGS and any(role in ROLES_APART for role in attributes.get("role", "").lower().split())


def _named(tag: str, attributes: dict[str, str]) -> int:
    """2 if class or id has a name made of listed words alone, 1 if a listed word is part of a name, else 0."""
    if tag in ("html", "body", *ARTICLE_TAGS):
        return 0
    names = attributes.get("class", "").split()
    if tag not in SLUGS and tag not in INLINE:
        names += attributes.get("id", "").split()
    level = 0
    for name in names:
        parts = [p.lower() in NAMED_APART for p in _NAME_PARTS.findall(name)]
        level = max(level, 2 if parts and all(parts) else int(any(parts)))
    return level


@dataclass
class Doubtful:
    """An element that may or may not be apart: by its name (``level`` 1 or 2), a form, or one that is never closed."""

    level: int
    form: bool = False
    around: bool = False  # an article or main begins inside
    title: bool = False  # an h1 begins inside
    layout: bool = False  # parts of a page's layout begin inside
    controls: int = 0


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order, outside of what is set apart.

    An element set apart by its tag that no tag of its own closes would take the
    rest of the page with it; the page is then read again with the element in
    doubt, like one set apart by its name.
    """
    unclosed: set[int] = set()
    while True:
        blocks, elements, more = _read(page, unclosed)
        if more <= unclosed:
            return without_apart(blocks, elements)
        unclosed |= more


def _read(page: str, unclosed: set[int]) -> tuple[list[Block], list[Doubtful], set[int]]:
    """Blocks, the doubtful elements by number (from 1), and the places of apart elements that only the end of the page closes."""
    found: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # block elements that are open, whether each is apart, its number if doubtful
    starts: list[int] = []  # where each of them begins
    elements = [Doubtful(0)]
    open_ended: set[int] = set()
    pieces: list[str] = []
    linked, in_link, apart = 0, False, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = _SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            if text and not apart:
                found.append(Block(text, tuple(t for t, _, _ in stack), linked, tuple(n for _, _, n in stack if n)))
            pieces.clear()
        linked = 0

    def close_to(depth: int, page_ends: bool = False) -> None:
        nonlocal apart
        flush()
        while len(stack) > depth:
            tag, out, _ = stack.pop()
            start = starts.pop()
            apart -= out
            if page_ends and out and tag in APART:
                open_ended.add(start)

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        chunk = page[at : m.start()] if m else page[at:]
        if stack and stack[-1][0] == "head" and not chunk.isspace() and chunk:
            close_to(len(stack) - 1)  # text ends a head that no tag has closed
        if chunk and not apart:
            pieces.append(chunk)
            linked += len(chunk) * in_link
        if not m:
            break
        at = m.end()
        closing, tag, attributes = m[1], (m[2] or "").lower(), m[3] or ""
        if not tag:
            continue
        if tag in CONTROLS and not closing:
            for _, _, n in stack:
                elements[n].controls += 1
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|$)", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            held = {} if closing or not attributes.strip() else _attributes(attributes)
            if held and not attributes.endswith("/"):
                out, named = _apart(tag, held), _named(tag, held) == 2
                end = re.compile(rf"</{re.escape(tag)}\s*(?:>|$)", re.I).search(page, at) if out or named else None
                if end and (out or ("".join(pieces).strip() == "" and not _text_follows(page, end.end()))):
                    in_link = False if tag == "a" else in_link
                    at = end.end()
            continue
        if tag in VOID:
            if tag in ("br", "hr"):
                pieces.append(" ")
                if tag == "hr":
                    flush()
            continue
        in_link = False
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    close_to(depth, tag in ("body", "html"))
                    break
            else:
                flush()
            continue
        flush()
        for depth, (t, _, _) in enumerate(stack):  # what a new part of the page ends, its own end tag missing
            if (t == "head" and tag != "head") or (t in ("nav", "header", "footer", "aside") and tag == "main") or (t == "nav" and tag == "article"):
                close_to(depth)
                break
        if tag in CLOSES_P and any(t == "p" for t, _, _ in stack[-3:]):
            depth = max(i for i, (t, _, _) in enumerate(stack) if t == "p")
            close_to(depth)
        if tag in SIBLINGS:
            ends, within = SIBLINGS[tag]
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in within:
                    break
                if stack[depth][0] in ends:
                    close_to(depth)
                    break
        if stack and stack[-1][0] in HEADINGS and tag in HEADINGS:
            close_to(len(stack) - 1)
        if not attributes.endswith("/"):
            held = _attributes(attributes) if attributes.strip() else {}
            out = tag != "body" and tag != "html" and _apart(tag, held)
            if tag == "header" and any(t in ARTICLE_TAGS for t, _, _ in stack):
                out = False  # an article's own heading
            doubt = out and tag in APART and m.start() in unclosed
            out = out and not doubt
            level = _named(tag, held) if held else 0
            for _, _, n in stack:
                elements[n].around |= tag in ARTICLE_TAGS
                elements[n].title |= tag == "h1"
                elements[n].layout |= tag in LAYOUT
            if level or doubt or tag == "form":
                elements.append(Doubtful(max(level, int(doubt)), tag == "form"))
            stack.append((tag, out, len(elements) - 1 if level or doubt or tag == "form" else 0))
            starts.append(m.start())
            apart += out
    close_to(0, True)
    return found, elements, open_ended


def _text_follows(page: str, at: int) -> bool:
    """Whether the block goes on with text after ``at``."""
    return bool(re.compile(r"(?:\s|</?(?:" + "|".join(INLINE) + r")\b[^>]*>)*[^<\s]", re.I).match(page, at))


def without_apart(blocks: list[Block], elements: list[Doubtful]) -> list[Block]:
    """``blocks`` outside of doubtful elements that hold none of the article.

    A form is one if it frames no part of a page's layout and has a control for
    every few words. A name of listed words alone says enough, at any size,
    unless the article begins inside the element, or the page's title with most of
    its text, or nothing else is left; a name with a listed word in it does in a
    small element only.
    """
    inside = [0] * len(elements)
    for b in blocks:
        for n in b.named:
            inside[n] += b.unlinked
    total = sum(b.unlinked for b in blocks)

    def dropped(n: int, whole_names: bool) -> bool:
        e = elements[n]
        if e.form and not e.layout and inside[n] < WORDY * max(1, e.controls):
            return True
        if not e.level or e.around or (e.title and 2 * inside[n] > total):
            return False
        return (whole_names and e.level == 2) or inside[n] <= SMALL[e.level - 1] * total

    for whole_names in (True, False):
        out = {n for n in range(1, len(elements)) if dropped(n, whole_names)}
        rest = [b for b in blocks if out.isdisjoint(b.named)]
        if any(b.unlinked for b in rest):
            break
    for b in rest:  # only names lower what is left
        b.named = tuple(n for n in b.named if elements[n].level)
    return rest


def smoothed(values: np.ndarray, radius: int = 2) -> np.ndarray:
    """Gaussian mean over neighbouring blocks."""
    offsets = np.arange(-radius, radius + 1)
    kernel = np.exp(-(offsets**2) / 2.0)
    weight = np.convolve(np.ones(len(values)), kernel, mode="full")[radius : radius + len(values)]
    return np.convolve(values, kernel, mode="full")[radius : radius + len(values)] / weight


def content_paths(blocks: list[Block], share: float = 0.5) -> set[tuple]:
    """The paths whose fused ratio reaches ``share`` of the spread of all blocks' values."""
    paths: dict[tuple, list[float]] = {}
    for b in blocks:
        total = paths.setdefault(b.way, [0, 0.0, 0.0])
        total[0] += 1
        total[1] += len(b.text) - min(b.linked, len(b.text))
        total[2] += len(_MARKS.findall(b.text)) * (1 - min(1.0, b.linked / len(b.text)))
    text = np.array([paths[b.way][1] / paths[b.way][0] for b in blocks])
    marks = np.array([paths[b.way][2] / paths[b.way][0] for b in blocks])
    fused = smoothed(text) * (smoothed(marks) + 0.1) * np.sqrt(text * (marks + 0.1))
    fused = fused * np.array([(LOWERED if b.named else 1.0) * (MARKED if b.marked else 1.0) for b in blocks])
    level: dict[tuple, list[float]] = {}
    for b, v in zip(blocks, fused, strict=True):
        level.setdefault(b.way, []).append(v)
    threshold = share * min(float(np.std(fused)), float(np.mean(fused))) if len(level) > 1 else 0.0
    return {path for path, v in level.items() if np.mean(v) >= threshold and np.mean(v) > 0}


def main_text(page: str) -> str:
    """The article of a page, blocks joined by an empty line."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    chosen = content_paths(blocks)
    # What stands beside content belongs to it: headings, and lists, quotations and tables.
    homes = {b.path[:-1] for b in blocks if b.way in chosen}

    def kept(b: Block) -> bool:
        if b.way in chosen:
            return True
        if b.linked * 2 > len(b.text):
            return False
        if b.path and b.path[-1] in HEADINGS:
            return any(b.path[:-1][: len(home)] == home or home[: len(b.path) - 1] == b.path[:-1] for home in homes)
        return any(
            home and home[-1] not in ("body", "html") and b.path[: len(home)] == home and not PROSE.isdisjoint(b.path[len(home) :]) for home in homes
        )

    return "\n\n".join(b.text for b in blocks if kept(b))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page.

    A null or empty page gives an empty text, repeated rows are extracted each,
    null ids and urls stay null, an empty table gives no rows, other columns
    are not looked at. Pages are read whole, one at a time.
    """

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py() or "") for page in batch.column("html")]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text"])

    made = pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(extracted, "page_id long, url string, text string")
    return made.withColumn("n_chars", F.length("text").cast("long"))
