"""Main text of web pages by tag-path ratios.

Every piece of text hangs on a path of block elements from the root. Text length and punctuation are summed by path and
set against the number of pieces: prose has long pieces with punctuation, menus have short ones without. The two ratios
are smoothed over neighbouring paths, fused and cut at a threshold. The element that holds most of what passes is the
article, or the named article around it, or the outermost one whose further blocks pass as well. Blocks of the article are
its text if their path passes, short ones among long ones too, except those on paths that are marked as something else.
Names weigh in: headings, items of lists, cells, quotes and the like have the ratio of their article, and in a named article
the threshold is lower. A mark by name is lifted where the element turns out to be a layout around the article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements without content, by the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not text of the page.
HIDDEN = frozenset("head title script style noscript template iframe object svg math select textarea button canvas audio video map datalist".split())
#: Elements that are never part of an article.
APART = frozenset("nav footer aside form dialog menu fieldset".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var ruby rb rt rp".split())
#: Elements that can hold an article.
HOLDERS = frozenset("html body main article section div td table tbody tr center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are short by their kind, and take the ratio of the article they stand in.
STRUCTURED = HEADINGS | frozenset("ul ol li dl dt dd table caption th td blockquote pre figure figcaption address details summary".split())
#: Words in class, id or role that mark something other than the article.
MARKS = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promos?|promotions?|banners?|cookies?|consent|gdpr|notices?|alerts?|popups?|modals?|overlays?"
    r"|sidebars?|side-?bar|rail|widgets?|menus?|navs?|navbar|navigation|breadcrumbs?|pagination|pager|footers?|mastheads?|topbar|toolbar|comments?|feedback|disqus|replies|respond"
    r"|related|recommend(?:ed|ations)?|share|sharing|social|subscribe|newsletters?|signup|login|search(?:box)?|copyright|complementary|contentinfo|banner)(?:$|[^a-z])"
)
#: Marks of what others say, which no share of the page makes the name of a layout.
FOREIGN = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promos?|promotions?|cookies?|consent|gdpr|popups?|modals?|overlays?|comments?|feedback|disqus|replies|respond"
    r"|related|recommend(?:ed|ations)?|subscribe|newsletters?|signup|copyright|contentinfo|footers?)(?:$|[^a-z])"
)
#: Elements apart by their kind that pages of forms put around all they hold.
WRAPPERS = frozenset("form fieldset".split())
#: An open p ends where one of these begins.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li dd dt td th tr".split())
#: An open element of these kinds ends where another of its own set begins, within the nearest holder named last.
ENDS_OWN = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

TOKEN = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^"]*"[^>"']*+|'[^']*'[^>"']*+)*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<!--.*?(?:--!?>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
ATTRIBUTES = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=\s|/|$)""", re.I)
NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？؟،]")

#: Neighbours weigh this much in smoothing.
KERNEL = (0.25, 0.5, 0.25)
#: A path is content if its fused ratio is at least this share of the mean over text, by length.
THRESHOLD = 0.25
#: The same for paths inside a named article, where less has to be told apart.
NAMED_THRESHOLD = 0.2
#: The article is looked for from the innermost element that holds this share of the content.
HELD = 0.8


@dataclass(eq=False)
class Mark:
    """A mark that may turn out to name a layout: whether it is foreign, and whether it stands in an article or main."""

    foreign: bool
    within: bool
    lifted: bool = False


@dataclass
class Piece:
    """A block of text: its path, its text with raw white space, and how much of it is in links.

    ``marks`` are those of the open elements, outermost first; ``main`` and ``article`` count the marks around the innermost
    open element of that name (0 if there is none), and ``named`` numbers the innermost open one of both.
    """

    path: tuple[str, ...]
    apart: bool
    text: list[str] = field(default_factory=list)
    linked: int = 0
    marks: tuple[Mark, ...] = ()
    main: int = 0
    article: int = 0
    named: int = 0


def _marked(tag: str, attributes: str, inside_article: bool) -> bool | Mark:
    """Whether an element is by its kind or its marks no part of an article, or its mark if that may be lifted."""
    if (tag in APART and tag not in WRAPPERS) or (tag == "header" and not inside_article):
        return True
    marked, foreign = tag in WRAPPERS, False
    for name, value in ATTRIBUTES.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and NOT_SHOWN.search(value)):
            return True
        if name in ("class", "id", "role") and tag not in ("html", "body", "article", "main") and MARKS.search(value):
            marked, foreign = True, foreign or FOREIGN.search(value) is not None
    return marked and Mark(foreign, inside_article)


def _closer(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>", re.I)


CLOSERS = {tag: _closer(tag) for tag in HIDDEN}


class _Reader:
    """The open elements of a page and the blocks of text read so far, tolerant of tags not closed or not opened."""

    def __init__(self):
        self.open: list[tuple[str, bool | Mark, int]] = []  # tag, apart or its mark, number if an article or main
        self.count = 0
        self.out: list[Piece] = []
        self.piece: Piece | None = None
        self.links = 0

    def add(self, raw: str) -> None:
        if self.piece is None:
            if raw.isspace():
                return
            path = tuple(t for t, _, _ in self.open if t not in INLINE)
            self.piece = Piece(path, any(a is True for _, a, _ in self.open))
            if any(a for _, a, _ in self.open):
                self.mark(self.piece)
            elif "article" in path or "main" in path:
                self.piece.named = next(n for _, _, n in reversed(self.open) if n)
            self.out.append(self.piece)
        decoded = html.unescape(raw) if "&" in raw else raw
        self.piece.text.append(decoded)
        if self.links:
            self.piece.linked += len(decoded)

    def mark(self, piece: Piece) -> None:
        """Tell a piece its marks, and which of them lie around its article or main."""
        marks = []
        for tag, apart, number in self.open:
            if number:
                piece.named = number
                setattr(piece, tag, len(marks))
            if isinstance(apart, Mark):
                marks.append(apart)
        piece.marks = tuple(marks)

    def cut(self, n: int) -> None:
        """Close the elements from the n-th on."""
        if self.links:
            self.links -= sum(t == "a" for t, _, _ in self.open[n:])
        del self.open[n:]

    def close(self, tag: str) -> None:
        """The innermost element of a kind ends; an inline one only within its block."""
        for n in range(len(self.open) - 1, -1, -1):
            if self.open[n][0] == tag:
                return self.cut(n)
            if tag in INLINE and self.open[n][0] not in INLINE:
                return None
        return None

    def end_open(self, kinds, within) -> None:
        """The innermost element of some kinds ends, if it lies inside the nearest of those it may lie in."""
        for n in range(len(self.open) - 1, -1, -1):
            if self.open[n][0] in kinds:
                return self.cut(n)
            if self.open[n][0] in within:
                return None
        return None

    def begin(self, tag: str, attributes: str) -> None:
        if tag in ENDS_P:
            self.end_open(("p",), HOLDERS)
        if tag in ENDS_OWN:
            self.end_open(*ENDS_OWN[tag])
        apart = (tag in APART or tag == "header" or bool(attributes)) and _marked(tag, attributes, any(n for _, _, n in self.open))
        named = tag in ("article", "main")
        self.count += named
        self.open.append((tag, apart, self.count if named else 0))
        self.links += tag == "a"


def blocks(page: str) -> list[Piece]:
    """The blocks of text of a page in order."""
    reader, at = _Reader(), 0
    for m in TOKEN.finditer(page):
        start = m.start()
        if start < at:
            continue  # inside an element that holds no text
        if start > at:
            reader.add(page[at:start])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag, closing = tag.lower(), (m[1] or m[4]) == "/"
        if tag == "br":
            reader.add(" ")
            continue
        if tag in HIDDEN and not closing:
            end = CLOSERS[tag].search(page, at) if tag != "head" else None  # a head holds elements and may be left open
            if end is not None:
                at = end.end()
            elif tag in ("script", "style", "title", "textarea"):
                at = len(page)
            continue
        if tag not in INLINE:
            reader.piece = None
        if closing:
            reader.close(tag)
        elif tag not in VOID:
            attributes = m[3] or m[6] or ""
            if tag not in INLINE or not attributes.endswith("/"):
                reader.begin(tag, attributes)
    if at < len(page):
        reader.add(page[at:])
    return reader.out


def lift(pieces: list[Piece]) -> None:
    """Lift the marks that name a layout around the article, from the element with most text on; links count as no text.

    A main element lifts every mark around it. So does an article with no less text than what has no mark, but several
    articles in a foreign mark are comments or teasers, unless the page has no other text. An element without a foreign mark
    that holds half of the page's text and HELD of what would then be read is a layout too, but not one beside an article
    or main with text.
    """
    holds: dict[Mark, list[tuple[Piece, int]]] = {}
    inside: dict[Mark, int] = {}
    articles: dict[Mark, dict[int, int]] = {}
    mains: set[Mark] = set()
    total = rest = beside = 0
    for p in pieces:
        size = max(len(p.text[0]) - p.linked, 0)
        total += size
        if not p.marks:
            rest += size
            beside += size if p.named else 0
        for k, m in enumerate(p.marks):
            holds.setdefault(m, []).append((p, size))
            inside[m] = inside.get(m, 0) + size
            if p.main > k:
                mains.add(m)
            if p.article > k:
                of = articles.setdefault(m, {})
                of[p.named] = of.get(p.named, 0) + size
    for m in sorted(holds, key=inside.get, reverse=True):
        if not inside[m] or not all(o.lifted for o in holds[m][0][0].marks[: holds[m][0][0].marks.index(m)]):
            continue
        named = articles.get(m, {})
        by_name = m in mains or (sum(named.values()) >= max(rest, 1) and (not m.foreign or len(named) == 1 or not rest))
        by_size = not m.foreign and 2 * inside[m] >= total and inside[m] >= HELD * (inside[m] + rest) and (m.within or not beside)
        if by_name or by_size:
            m.lifted = True
            for p, size in holds[m]:
                if all(o.lifted for o in p.marks):
                    rest += size
                    beside += size if p.named else 0


def path_ratios(pieces: list[Piece]) -> dict[tuple[str, ...], float]:
    """The fused ratio of every path of pieces with their text in one string: text length and punctuation a piece, smoothed over paths in order of appearance."""
    order: dict[tuple[str, ...], list[int]] = {}
    for p in pieces:
        text = p.text[0]
        entry = order.setdefault(p.path, [0, 0, 0])
        entry[0] += len(text) - p.linked
        entry[1] += len(PUNCTUATION.findall(text))
        entry[2] += 1
    sums = np.array(list(order.values()), float)
    length, marks = sums[:, 0] / sums[:, 2], (sums[:, 1] + 1) / sums[:, 2]
    fused = np.sqrt(np.maximum(length, 0) * marks)
    smooth = np.convolve(np.pad(fused, 1, mode="edge"), KERNEL, "valid")
    return dict(zip(order, np.sqrt(fused * smooth)))


def only_links(p: Piece, is_content: bool) -> bool:
    """Whether a block is a list of links, which is text of an article element alone."""
    return p.linked >= 0.8 * len(p.text[0]) and not is_content and "article" not in p.path


def around(article: tuple[str, ...], pieces: list[Piece], content: np.ndarray) -> tuple[str, ...]:
    """The path of the whole article from that of the element with most of its content.

    This is the outermost article element on the path, or the innermost main if there is none. Elsewhere it is the outermost
    holder to which every step up adds blocks that are, by length, at least half content or headings.
    """
    for name, order in (("article", article), ("main", article[::-1])):
        if name in order:
            at = order.index(name)
            return article[: at + 1] if name == "article" else article[: len(article) - at]
    # text and passing text that the parent at a depth adds to the next holder on the path
    depths = [d for d in range(len(article)) if d == 0 or article[d - 1] in HOLDERS]
    added = {d: [0, 0] for d in depths}
    for p, is_content in zip(pieces, content):
        common = next((k for k, (x, y) in enumerate(zip(article, p.path)) if x != y), min(len(article), len(p.path)))
        if common < len(article) and not only_links(p, is_content):
            entry = added[max(d for d in depths if d <= common)]
            entry[0] += len(p.text[0])
            entry[1] += len(p.text[0]) if is_content or (HEADINGS.intersection(p.path[common:]) and not p.linked) else 0
    for d in reversed(depths):
        if 2 * added[d][1] < added[d][0]:
            break
        article = article[:d]
    return article


def main_text(page: str | None) -> str:
    """The blocks of a page's article, each on a line, with single spaces and decoded references; empty if there are none."""
    pieces = [p for p in blocks(page or "") if not p.apart]
    for p in pieces:
        p.text = [" ".join("".join(p.text).split())]
    pieces = [p for p in pieces if p.text[0]]
    if any(p.marks for p in pieces):
        lift(pieces)
        pieces = [p for p in pieces if all(m.lifted for m in p.marks)]
    if not pieces:
        return ""
    ratios = path_ratios(pieces)
    sizes = np.array([len(p.text[0]) for p in pieces], float)
    own = np.array([ratios[p.path] for p in pieces])
    content = own >= THRESHOLD * (own * sizes).sum() / sizes.sum()
    held: dict[tuple[str, ...], float] = {}
    by_path: dict[tuple[str, ...], float] = {}
    for p, size in zip(pieces, sizes * content):
        by_path[p.path] = by_path.get(p.path, 0.0) + size
    for path, size in by_path.items():
        for depth in range(len(path) + 1):
            if depth == 0 or path[depth - 1] in HOLDERS:
                held[path[:depth]] = held.get(path[:depth], 0.0) + size
    named = [p for p in held if p and p[-1] in ("article", "main")]
    article = max((p for p in held if held[p] >= HELD * held[()]), key=len)
    if named and not any(t in ("article", "main") for t in article):
        # the article is named, but other text of the page outweighs it
        article = max(named, key=lambda p: (held[p], -len(p)))
    article = around(article, pieces, content)
    depth = len(article)
    bar = (NAMED_THRESHOLD if "article" in article or "main" in article else THRESHOLD) * (own * sizes).sum() / sizes.sum()
    kept = []
    for p, is_content, ratio in zip(pieces, content, own):
        if p.path[:depth] == article and not only_links(p, is_content) and (ratio >= bar or STRUCTURED.intersection(p.path[depth:])):
            kept.append(p.text[0])
    return "\n".join(kept)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        sizes = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points of the text) for every row of pages (page_id, url, html).

    Null and empty pages, and pages without text of their own, have an empty text. Each page is handled by itself, so
    repeated rows have repeated results; null ids and urls stay null; other columns of pages are not read.
    """
    own = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in own.schema.fields}
    return own.mapInArrow(_extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
