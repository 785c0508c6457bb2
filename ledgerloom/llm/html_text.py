"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's parser streams events over the whole page. A line is what stands between two block-level
tags; its ratio is its characters over its tags. The ratios are smoothed along the page, and lines are gathered into
regions: an article (or the main element) is one region, elsewhere each enclosing container is one. A region is
content if its best smoothed line reaches the threshold, the standard deviation of the smoothed ratios; the best
region always is. A content region is kept whole, so short paragraphs among long ones are not lost. Lines between two
content regions of one parent stay if they lie in that parent and are shorter than the content on either side taken together, or
hold no link; so do lists, tables and quotations without links at either end of a content region that holds them.
Where a page marks articles (else a main element), the marks override this: only those regions compete, and one alone
is kept whatever its ratios.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out where
the page marks them, by element (a header also within an article), role, ``hidden`` with any value, or a class or id that
is one of the known words or joins them with words that only say whose, where or what kind of part it is ("cookie-notice",
"site-header", "post-footer", "ad-300x250"). A class that names the header of a post or article marks its headline, which
stays. Ids of headings, terms and inline elements are names of places in the text and are not looked at; words that are
common subjects ("social", "alert") do not count as the id of a section or as a class of a paragraph, nor does "widget"
alone. The page, its body and main element are never left out, an article only as a reader's comment.

A map over rows without a shuffle. Defined results: a null or empty page has an empty text; character references are
decoded; white space inside a block, line breaks and no-break spaces included, is one space; blocks are joined by an
empty line; broken markup ends at the end of the page; repeated rows give repeated rows; an empty table gives an
empty table; other columns are not looked at unless named in ``keep``, where a result column has precedence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of HTML: elements that start a new line, that have no end tag, and whose text is never shown.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("canvas datalist head iframe math noembed noframes noscript object script style svg template title".split())
# Elements, roles and words of a class or id that mark what does not belong to the main text.
ASIDE = frozenset("aside button dialog footer form header input label menu nav option select textarea".split())
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
ASIDE_WORDS = frozenset(
    "ad ads adbox advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment commentlist "
    "comments consent cookie cookiebanner cookiebar cookienotice cookies copyright disqus footer gdpr header masthead menu "
    "modal nav navbar navigation newsletter notice notices notification pagination popup promo promoted promotion related "
    "replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split()
)
# Words that may stand beside them in one class or id: what kind of part it is, and whose.
PART_WORDS = frozenset(
    "area bar block body bottom box btn button buttons card center column container div entry form global google gpt group "
    "icon icons id inner item items label large left leaderboard link links list main message meta mobile module outer page "
    "pane panel posts primary recent right secondary section site slot small sticky sub text thread title top unit wrap "
    "wrapper".split()
)
OWNER_WORDS = frozenset("article articles blog breaking content entry news page post reader readers site story user users".split())
# Of whom a header is the headline.
HEADLINE_OWNERS = frozenset("article blog entry post story".split())
# Words that are also common subjects or states of a text.
SUBJECTS = frozenset("alert banner notice notification promo promotion related share sharing skip social widget widgets".split())
HEADINGS = frozenset("dt h1 h2 h3 h4 h5 h6".split())
# Containers that may be a region of their own outside of articles.
CONTAINERS = frozenset("article blockquote body div dl main ol section table td ul".split())
# Elements whose start ends an open paragraph, as browsers do.
PARAGRAPH_ENDS = BLOCKS - {"option", "select"}
# Those of them that are part of the text around them.
STRUCTURES = frozenset("blockquote dl ol table td ul".split())
SIGMA = 1.0

WORD = re.compile("[a-z0-9]+")
SIZE = re.compile("[0-9]+(x[0-9]+)?")
COMMENT_WORDS = frozenset(["comment", "commentlist", "comments"])
UNCLOSED = re.compile("<[a-zA-Z/!?]")
CAMEL = re.compile("(?<=[a-z0-9])(?=[A-Z])")


def marks_aside(token: str, asides: frozenset[str] = ASIDE_WORDS) -> bool:
    """Whether a class or id is made of words that set aside and words for parts of a page and their owners."""
    words = [w.rstrip("0123456789") for w in WORD.findall(CAMEL.sub(" ", token).lower()) if not SIZE.fullmatch(w)]
    marks = asides.intersection(words)
    if not marks or words == ["widget"]:
        return False
    if marks == {"header"} and HEADLINE_OWNERS.intersection(words):
        return False
    return all(w in asides or w in PART_WORDS or asides is ASIDE_WORDS and w in OWNER_WORDS for w in words)


def is_aside(tag: str, attributes: Sequence[tuple[str, str | None]]) -> bool:
    if tag in ASIDE:
        return True
    if tag in ("html", "body", "main"):
        return False
    asides = COMMENT_WORDS if tag == "article" else ASIDE_WORDS
    for name, value in attributes:
        if name == "hidden":
            return True
        if not value:
            continue
        if name == "class" or name == "id" and tag in BLOCKS and tag not in HEADINGS:
            subjects = tag == "p" or tag == "section" and name == "id"
            if any(marks_aside(t, asides) and not (subjects and t.lower() in SUBJECTS) for t in value.split()):
                return True
        elif name == "role" and value.strip().lower() in ASIDE_ROLES:
            return True
    return False


class Lines(HTMLParser):
    """Lines of a page: texts, tag counts and regions of those that can be content."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self.tags: list[int] = []
        self.regions: list[tuple[int, int]] = []
        self.links: list[bool] = []
        # Element and enclosing region's number of each region; the page itself is number 0.
        self.nested: list[tuple[str, int]] = [("", -1)]
        # Open elements: tag, whether it hides or sets aside what it holds, kind and number of its region.
        self.open: list[tuple[str, bool, tuple[int, int]]] = [("", False, (0, 0))]
        # Places in ``open`` of each tag, and of block-level elements, so that no search walks through it.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]
        self.pieces: list[str] = []
        self.n_tags = 0
        self.linked = False

    def end_line(self) -> None:
        """Blank lines have no ratio; what is set aside has no line."""
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.texts.append(text)
                self.tags.append(max(1, self.n_tags))
                self.regions.append(self.open[-1][2])
                self.links.append(self.linked)
            self.pieces = []
        self.n_tags = 0
        self.linked = bool(self.places.get("a"))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_line()
            if tag in PARAGRAPH_ENDS:
                self.close_paragraph()
        _, out, region = self.open[-1]
        self.n_tags += 1
        self.linked = self.linked or tag == "a"
        if tag in VOID:
            if tag == "br" and not out:
                self.pieces.append(" ")
            return
        # An advert that is set aside inside a line leaves the line as it is.
        out = out or tag in HIDDEN or is_aside(tag, attrs)
        kind = 2 if tag == "article" else 1 if tag == "main" else 0
        if kind > region[0] or kind == region[0] == 0 and tag in CONTAINERS:
            self.nested.append((tag, region[1]))
            region = (kind, len(self.nested) - 1)
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append((tag, out, region))

    def close_from(self, place: int) -> None:
        while len(self.open) > place:
            tag, _, _ = self.open.pop()
            self.places[tag].pop()
            if tag in BLOCKS:
                self.blocks.pop()

    def close_paragraph(self) -> None:
        """A block ends an open paragraph, with the inline elements left open in it."""
        if self.open[self.blocks[-1]][0] == "p":
            self.close_from(self.blocks[-1])

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.end_line()
        self.n_tags += 1
        if tag in VOID:
            return
        places = self.places.get(tag)
        # An inline end tag doesn't reach out of its block.
        if places and (tag in BLOCKS or places[-1] > self.blocks[-1]):
            self.close_from(places[-1])

    def handle_data(self, data: str) -> None:
        if not self.open[-1][1]:
            self.pieces.append(data)

    def finish(self) -> None:
        self.close()
        self.end_line()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean of the neighbours along the page; at the ends, of those that exist."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(ratios, kernel)[reach : reach + len(ratios)]
    return full / np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]


class Tree:
    """Where regions lie in each other, answered without a walk up: they are numbered in order of opening."""

    def __init__(self, nested: Sequence[tuple[str, int]]):
        self.last = list(range(len(nested)))
        for region in range(len(nested) - 1, 0, -1):
            parent = nested[region][1]
            self.last[parent] = max(self.last[parent], self.last[region])
        # The first region at or above each one that is no structure of its text.
        self.stop = [0] * len(nested)
        for region, (tag, parent) in enumerate(nested):
            self.stop[region] = self.stop[parent] if tag in STRUCTURES else region

    def within(self, region: int, outer: int) -> bool:
        """Whether ``region`` is ``outer`` or inside it."""
        return outer <= region <= self.last[outer]

    def belongs(self, region: int, outer: int) -> bool:
        """The same, with structures alone on the way."""
        return self.within(region, outer) and (region == outer or self.stop[region] <= outer)


def common_parent(lines: Lines, a: int, b: int) -> int | None:
    """The region that holds lines ``a`` and ``b``, if it is one of theirs or the parent of both."""
    x, y = lines.regions[a][1], lines.regions[b][1]
    up_x, up_y = lines.nested[x][1], lines.nested[y][1]
    return x if x == y or x == up_y else y if y == up_x else up_x if up_x == up_y else None


def fill(lines: Lines, kept: np.ndarray) -> np.ndarray:
    """The kept lines, and those among or beside them that belong to the same text."""
    tree, regions = Tree(lines.nested), [number for _, number in lines.regions]
    sizes = np.array([len(t) for t in lines.texts])
    edges = np.flatnonzero(np.diff(np.r_[False, kept, False].astype(np.int8))).reshape(-1, 2).tolist()
    result = kept.copy()
    for (start, a), (z, end) in zip(edges, edges[1:], strict=False):
        parent = common_parent(lines, a - 1, z)
        if parent is not None and all(tree.within(regions[i], parent) for i in range(a, z)):
            short = sizes[a:z].sum() < sizes[start:a].sum() + sizes[z:end].sum()
            result[a:z] = short or not any(lines.links[a:z])
    for start, end in edges:
        for first, way in ((start - 1, -1), (end, 1)):
            owner, i = regions[first - way], first
            while 0 <= i < len(kept) and not result[i] and not lines.links[i] and tree.belongs(regions[i], owner):
                result[i] = True
                i += way
    return result


def content_regions(lines: Lines) -> set[tuple[int, int]]:
    """The regions of the most marked kind whose best smoothed ratio reaches the threshold; the best always does."""
    ratios = smoothed(np.array([len(t) / n for t, n in zip(lines.texts, lines.tags, strict=True)]))
    marked = max(kind for kind, _ in lines.regions)
    best: dict[tuple[int, int], float] = {}
    for region, ratio in zip(lines.regions, ratios, strict=True):
        if region[0] == marked:
            best[region] = max(best.get(region, 0.0), ratio)
    threshold = min(float(np.std(ratios)), max(best.values()))
    return {region for region, ratio in best.items() if ratio >= threshold}


def main_text(html: str) -> str:
    # A tag that the end of the page cuts off is no text, nor is what follows it.
    cut = UNCLOSED.search(html, html.rfind(">") + 1)
    if cut:
        html = html[: cut.start()]
    lines = Lines()
    lines.feed(html)
    lines.finish()
    if not lines.texts:
        return ""
    chosen = content_regions(lines)
    kept = np.array([region in chosen for region in lines.regions])
    if not max(kind for kind, _ in lines.regions):
        kept = fill(lines, kept)
    return "\n\n".join(t for t, keep in zip(lines.texts, kept, strict=True) if keep)


def extract_text(pages: DataFrame, html: str = "html", keep: Sequence[str] = (), text: str = "text") -> DataFrame:
    """The ``keep`` columns and the main ``text`` of every page."""
    kept = [c for c in dict.fromkeys(keep) if c != text]
    fields = [T.StructField(c, pages.schema[c].dataType) for c in kept] + [T.StructField(text, T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py() or "") for h in batch.column(len(kept))]
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*kept, text])

    return pages.select(*kept, pages[html].alias("_html")).mapInArrow(run, T.StructType(fields))
