"""Main text of web pages.

The standard library's parser streams events; each block element becomes a
line with its text and its number of tags. The text-to-tag ratios of the
lines are smoothed by a Gaussian and split by a two-means threshold; the
lines above it show where the content is. The region is the smallest element
that holds nearly all of their text (the ``article`` elements or ``main`` if
there are any), widened to the element that also holds the headings, the
paragraphs and the other lines above the threshold outside it, but those that
are mostly links. All its lines are returned but those in menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments,
and lines outside the first region that are mostly links.

Words in a class mark such elements in containers; elsewhere, and in ids, only
names made of such words and words about layout do, and headings are never
marked. A form, a sidebar or the like that holds half of the page's text, on a
page without an article outside it, is a layout and isn't dropped. Dropped
elements within a line don't end it.

Cases: null and empty html, and pages without text, give the empty text;
truncated pages and unclosed elements are read to their end; repeated rows are
returned each; extra columns aren't returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batched

FEED = 1 << 16
SIGMA = 1.0  # of the Gaussian, in lines
REGION_SHARE = 0.9

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template svg math iframe object canvas audio video map "
                    "select button textarea title head datalist".split())
BOILERPLATE = frozenset("nav footer aside form dialog menu".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
                   "p pre section summary table tbody td tfoot th thead tr ul caption".split())
TEXT_BLOCKS = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("div section ul ol dl li table header fieldset details center".split())
NEVER_DROPPED = frozenset(("html", "body", "main"))
IN_HEAD = frozenset("base link meta noscript script style template title".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar "
                  "toolbar status".split())
#: Words in a class or id that mark what never is the article.
STRONG_HINTS = frozenset("""ad ads adv advert advertisement adverts advertising adbox adsense sponsor sponsored promo
promoted promotion cookie cookies consent gdpr notice notification notifications alert breadcrumb breadcrumbs footer
foot comment comments commentlist disqus reply replies respond newsletter subscribe subscription signup signin login
pagination pager skip skiplink""".split())
#: Words that mark it, too, unless the element holds most of the page's text.
HINTS = STRONG_HINTS | frozenset("""banner sidebar aside menu nav navbar navigation topnav header masthead topbar share
sharing social related recommended popup modal overlay paywall widget widgets toolbar search form""".split())
#: Words that may stand beside them in a name that isn't a topic.
LAYOUT = frozenset("""area articles banner bar block body bottom box btn button buttons center col column container
content desktop bottom fixed global google group holder icon icons inline inner item items left legal link links list
main mobile module outer page pane panel policy popular post posts primary reader readers right row secondary section
site slot small stories sub tertiary text thread top unit user visitor wrap wrapper zone""".split())
_NOT_THEM = frozenset(("has", "with", "no", "without", "is", "non"))
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
WEAK, STRONG = 1, 2


def name_mark(name: str, any_word: bool) -> int:
    """What a class or id says. ``any_word``: one word that marks boilerplate
    suffices; otherwise the others must be about layout, so that an id made
    from a heading (``search-algorithms``) marks nothing."""
    words = [w.lower() for w in _WORD.findall(name)]
    hints = [w for i, w in enumerate(words) if w in HINTS and (i == 0 or words[i - 1] not in _NOT_THEM)]
    if not hints or not any_word and any([w not in HINTS and w not in LAYOUT and not w.isdigit() and len(w) > 1
                                          for w in words]):
        return 0
    return STRONG if any([w in STRONG_HINTS for w in hints]) else WEAK


def boilerplate_mark(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """Whether an element, by its kind, role, class or id, isn't content:
    ``STRONG``, ``WEAK`` (unless it holds most of the page) or 0."""
    if tag in NEVER_DROPPED:
        return 0
    found = 0 if tag not in BOILERPLATE else WEAK if tag == "form" else STRONG
    for name, value in attrs:
        value = (value or "").strip()
        if name == "hidden" and value.lower() != "until-found":
            return STRONG
        if name == "aria-hidden" and value.lower() == "true":
            return STRONG
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return STRONG
        if name == "role" and value.lower() in ROLES and tag != "article":
            found = max(found, WEAK if value.lower() == "form" else STRONG)
        if tag in HEADINGS:
            continue
        if tag == "article":  # each of the readers' comments may be one
            if name == "class" and any([part.lower() in ("comment", "comment-body", "reply") for part in value.split()]):
                return STRONG
        elif name == "class":
            found = max([found, *[name_mark(part, tag in CONTAINERS) for part in value.split()]])
        elif name == "id" and tag in CONTAINERS:
            found = max(found, name_mark(value, False))
    return found


class Line:
    __slots__ = ("text", "tags", "linked", "path", "dropped")

    def __init__(self, text, tags, linked, path):
        self.text, self.tags, self.linked, self.path, self.dropped = text, tags, linked, path, False


class PageLines(HTMLParser):
    """Collect the lines of a page from parser events."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.names: list[str] = ["#page"]  # of all block elements, in page order
        self.parents: list[int] = [0]
        self.marks: list[int] = [0]
        self.open: list[tuple[str, int]] = [("#page", 0)]  # tag, element
        self.parts, self.tags, self.linked, self.in_link, self.skipping = [], 0, 0, 0, 0
        self.muted: list | None = None  # dropped inline element: tag, nested ones, open block elements

    def _end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.lines.append(Line(text, self.tags, self.linked, tuple([e for _, e in self.open])))
            self.parts = []
            self.tags = self.linked = 0

    def _close(self, at: int) -> None:
        self.skipping -= sum([t in SKIPPED for t, _ in self.open[at:]])
        del self.open[at:]
        if self.muted and at < self.muted[2]:
            self.muted = None

    def _close_head(self) -> None:
        at = next((i for i, (t, _) in enumerate(self.open) if t == "head"), None)
        if at is not None:
            self._close(at)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag not in IN_HEAD and tag != "head" and self.open[-1][0] == "head":
            self._close_head()  # its end tag may be left out
        if tag in VOID:
            if tag == "hr":
                self._end_line()
            elif tag == "br" and not self.muted:
                self.parts.append(" ")
            return
        if tag in SKIPPED:
            self.skipping += 1
            self.open.append((tag, self.open[-1][1]))
            return
        if tag not in BLOCKS:
            self.in_link += tag == "a"
            if self.muted:
                self.muted[1] += tag == self.muted[0]
            elif boilerplate_mark(tag, attrs):
                self.muted = [tag, 1, len(self.open)]
            return
        self._end_line()
        if tag in ("html", "body"):
            self._close_head()
        else:
            self._close_open(tag)
        mark = boilerplate_mark(tag, attrs)
        if tag == "header" and not any([t in ("article", "main") for t, _ in self.open]):
            mark = max(mark, WEAK)
        self.names.append(tag)
        self.parents.append(self.open[-1][1])
        self.marks.append(mark)
        self.open.append((tag, len(self.names) - 1))

    def _close_open(self, tag: str) -> None:
        """Elements whose end tag may be left out."""
        if self.open[-1][0] == "p":
            self._close(len(self.open) - 1)
        ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
                "td": ("td", "th"), "th": ("td", "th")}.get(tag, ())
        while self.open[-1][0] in ends:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in VOID:
            return
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if self.muted and tag == self.muted[0]:
            self.muted[1] -= 1
            if not self.muted[1]:
                self.muted = None
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i][0] == tag), None)
        if at is None:
            return
        if tag not in SKIPPED:
            self._end_line()
        self._close(at)

    def handle_data(self, data):
        if self.open[-1][0] == "head" and data.strip():
            self._close_head()
        if not self.skipping and not self.muted:
            self.parts.append(data)
            if self.in_link:
                self.linked += len(data.strip())

    def close(self):
        super().close()
        self._end_line()
        self._drop_lines()

    def _drop_lines(self) -> None:
        """Lines within marked elements are dropped. A weak mark is void if the
        page has no article outside marked elements and the marked one holds
        half of the text, links aside."""
        marks, parents = self.marks, self.parents
        strong, weak = [m == STRONG for m in marks], [0] * len(marks)  # weak: the innermost weakly marked element
        for e in range(1, len(marks)):
            strong[e] = strong[e] or strong[parents[e]]
            weak[e] = e if marks[e] == WEAK else weak[parents[e]]
        total, clean = 0, False
        held: dict[int, int] = {}
        for x in self.lines:
            e = x.path[-1]
            if strong[e] or mostly_links(x):
                continue
            total += len(x.text)
            if weak[e]:
                held[weak[e]] = held.get(weak[e], 0) + len(x.text)
            else:
                clean = clean or any([self.names[i] in ("article", "main") for i in x.path])
        void = set()
        if not clean:
            for e in sorted(held, reverse=True):  # from the inside
                if 2 * held[e] >= total:
                    while e:  # and all around it
                        void.add(e)
                        e = weak[parents[e]]
                    break
        kept = [not s for s in strong]
        for e in range(1, len(marks)):
            kept[e] = kept[e] and kept[parents[e]] and (marks[e] != WEAK or e in void)
        for x in self.lines:
            x.dropped = not kept[x.path[-1]]


def gaussian_smooth(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(3 * sigma) or 1
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    total = np.convolve(values, kernel)[reach:reach + len(values)]
    return total / np.convolve(np.ones(len(values)), kernel)[reach:reach + len(values)]


def two_means_threshold(values: np.ndarray) -> float:
    """The middle between the centres of two clusters of numbers."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        split = (low + high) / 2
        below, above = values[values <= split], values[values > split]
        if not len(above) or not len(below):
            break
        new = float(below.mean()), float(above.mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def mostly_links(x: Line) -> bool:
    return 2 * x.linked >= len(x.text)


def common_element(paths: list[tuple[int, ...]]) -> int:
    """The deepest element of all paths. Elements are numbered in page order,
    so it has the largest number."""
    return max(set(paths[0]).intersection(*paths[1:]), default=0)


def content_region(lines: list[Line], names: list[str]) -> tuple[int, int]:
    """The element where the content was found and the one, the same or around
    it, that holds all the content."""
    ratio = np.array([0.0 if x.dropped else len(x.text) * (1 - min(1.0, x.linked / len(x.text))) / max(1, x.tags)
                      for x in lines])
    smooth = gaussian_smooth(ratio)
    cut = two_means_threshold(smooth)
    above = [(x, not x.dropped and (s >= cut or r >= cut)) for x, s, r in zip(lines, smooth, ratio)]
    seeds = [(x, len(x.text)) for x, seed in above if seed]
    if not seeds:
        seeds = [(x, len(x.text)) for x in lines if not x.dropped]
    weight: dict[int, int] = {}
    for x, n in seeds:
        for e in set(x.path):
            weight[e] = weight.get(e, 0) + n
    total = weight.get(0, 0)
    counted = [x for x, seed in above if not x.dropped and not mostly_links(x)
               and (seed or names[x.path[-1]] in TEXT_BLOCKS)]
    for tag in ("article", "main"):
        # The outermost ones; what they hold counts together.
        inside = [(x, next((e for e in x.path if names[e] == tag), None)) for x in lines]
        named = {e for x, e in inside if e is not None and not x.dropped}
        if named and sum(weight.get(e, 0) for e in named) >= 0.5 * total:
            texts = set(counted)
            held = {e for x, e in inside if e is not None and x in texts} or named
            core = common_element([x.path[:x.path.index(e) + 1] for x, e in inside if e in held])
            around = [e for e in lines_path(lines, core) if names[e] == "main"]
            widened = [x.path for x in counted if around and around[0] in x.path]
            return core, common_element([lines_path(lines, core), *widened])
    core = max([e for e, w in weight.items() if w >= REGION_SHARE * total
                and names[e] not in ("p", "li", "ul", "ol", "td", "tr")], default=0)
    return core, common_element([lines_path(lines, core), *[x.path for x in counted]])


def lines_path(lines: list[Line], element: int) -> tuple[int, ...]:
    """The elements from the page to this one."""
    path = next(x.path for x in lines if element in x.path)
    return path[:path.index(element) + 1]


def main_text(html: str | None) -> str:
    """The blocks of the article, joined by line ends."""
    if not html:
        return ""
    page = PageLines()
    for i in range(0, len(html), FEED):
        page.feed(html[i:i + FEED])
    page.close()
    lines = page.lines
    if not any([not x.dropped for x in lines]):
        return ""
    core, region = content_region(lines, page.names)

    def is_menu(x: Line) -> bool:
        """A list whose items are links alone is a menu, but within an article."""
        if any([page.names[e] in ("article", "main") for e in x.path]):
            return False
        if core not in x.path:
            return mostly_links(x)
        return x.linked >= len(x.text) > 0 and page.names[x.path[-1]] in ("li", "ul", "ol")

    return "\n".join([x.text for x in lines if not x.dropped and region in x.path and not is_menu(x)])


def extract_pages(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    out = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*[c.to_pylist() for c in b.columns])
            made = ((i, u, t, len(t)) for i, u, t in ((i, u, main_text(h)) for i, u, h in rows))
            for group in batched(made, lambda r: 100 + 4 * r[3], 4 << 20):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*group), out)], schema=out)

    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col("url"), F.col("html"))
            .mapInArrow(run, "page_id long, url string, text string, n_chars long"))
