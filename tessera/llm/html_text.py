"""Main text of web pages from streamed parser events.

The standard library's parser is fed once; its events become lines, one per block, each with its
text, its tags, its link text and the containers around it.  The text-to-tag ratio per line is
smoothed with a Gaussian, and two-means on its logarithm gives the threshold between content and
the rest.  The content region is the deepest container that holds most of the content's text, widened
to the article or main element around it; outside it all that the threshold calls content stays.  Lines
of menus, headers, footers, sidebars, notices, adverts, forms and reader comments are known by their
element, role, class or id and do not count.  A name or a form only silences what is a part of the
page: not what holds its article or most of its text, and never all that there is.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tessera.llm.common import map_arrow

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr img".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never content.
SILENT = frozenset(
    "head script style noscript template svg math canvas iframe object audio video nav footer aside "
    "button select textarea dialog menu".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar".split())
#: Words of a class or id that name what is not content.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie "
    "cookies consent gdpr notice notices alert alerts sidebar sidebars nav navbar navigation menu menus breadcrumb "
    "breadcrumbs footer comment comments disqus respond replies reply share sharing social related recommended "
    "recommendations newsletter subscribe subscription popup modal overlay pagination pager toolbar masthead "
    "widget widgets skip login signup paywall".split()
)
#: Beginnings of such words that are written together with others.
MARK_STARTS = (
    "advert", "adbox", "adslot", "adunit", "sponsor", "cookie", "sidebar", "sidenav", "breadcrumb", "navbar",
    "newsletter", "footer", "sitefooter", "siteheader", "pagefooter", "pageheader", "commentlist", "noticebar",
)
COMMENT = frozenset("comment comments disqus reply replies respond".split())
#: A word of a class or id that tells of comments without being any: has-comments, comments-open, no-reply.
FLAG = re.compile(r"(?:^|\s)(?:(?:has|no|with|without)[-_]\S+|\S+[-_](?:open|opened|closed|enabled|disabled|allowed|count|off|on))(?=\s|$)")
#: What a start tag ends that has no end tag of its own, up to the nearest of the elements named last.
_CELLS, _ROWS = frozenset("td th".split()), frozenset("tr td th".split())
_ITEMS, _PAIRS = frozenset(["li"]), frozenset("dt dd".split())
IMPLIED = {
    "li": (_ITEMS, frozenset("ul ol menu table dl".split())),
    "dt": (_PAIRS, frozenset("dl ul ol table".split())),
    "dd": (_PAIRS, frozenset("dl ul ol table".split())),
    "td": (_CELLS, frozenset("tr table".split())),
    "th": (_CELLS, frozenset("tr table".split())),
    "tr": (_ROWS, frozenset(["table"])),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (_ROWS | frozenset("thead tbody tfoot".split()), frozenset(["table"]))),
    "option": (frozenset(["option"]), frozenset("select datalist optgroup".split())),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WORDS = re.compile(r"[a-z0-9]+")
#: Lines on either side that the Gaussian reaches, and its width.
RADIUS, WIDTH = 3, 1.5


class Line:
    __slots__ = ("parts", "tags", "link", "around", "silent", "named", "heading")

    def __init__(self, around: tuple[int, ...], silent: bool, named: tuple[int, ...], heading: bool):
        self.parts: list[str] = []
        self.tags, self.link = 0, 0
        self.around, self.silent, self.named, self.heading = around, silent, named, heading

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


#: What stands above an outermost element.
NOTHING = ("", 0, False, False, False)


class _Lines(HTMLParser):
    """Collects lines; ``stack`` holds (tag, id, silent, inside an article, named) of open elements;
    named are forms and elements with a name of boilerplate."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, bool, bool, bool]] = []
        self.lines: list[Line] = []
        self.count, self.links, self.current = 0, 0, None
        self.articles: set[int] = set()
        self.mains: set[int] = set()
        self.comments: set[int] = set()

    def _break(self) -> None:
        self.current = None

    def _line(self) -> Line:
        if self.current is None:
            silent = bool(self.stack) and self.stack[-1][2]
            named = tuple(s[1] for s in self.stack if s[4])
            heading = any(s[0] in HEADINGS for s in self.stack[-3:])
            around = tuple(s[1] for s in self.stack if s[0] not in INLINE and s[0] != "p")
            self.current = Line(around, silent, named, heading)
            self.lines.append(self.current)
        return self.current

    def _silences(self, tag: str, given: dict[str, str], inside: bool) -> bool:
        if tag in SILENT or (tag == "header" and not inside):
            return True
        return given.get("role") in ROLES or "hidden" in given or "display:none" in given.get("style", "").replace(" ", "")

    def _named(self, tag: str, given: dict[str, str], inside: bool) -> bool:
        """Whether it is a form or has a name of boilerplate; notes reader comments."""
        if tag in ("html", "body"):
            return False
        words = set(WORDS.findall(given.get("class", "") + " " + given.get("id", "")))
        told = FLAG.sub(" ", given.get("class", "") + " " + given.get("id", ""))
        comment = not COMMENT.isdisjoint(WORDS.findall(told))
        if comment:
            self.comments.add(self.count)
        if tag in ("article", "main"):
            return comment
        marked = not words.isdisjoint(MARKS) or any(w.startswith(MARK_STARTS) for w in words)
        return marked or tag == "form" or given.get("role") == "form" or ("header" in words and not inside)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "body":  # a head that nobody closed ends here
            self._close("head")
        block = tag not in INLINE
        if block:
            self._break()
            if self.stack and tag not in VOID:
                self._end_paragraph()
                if tag in IMPLIED:
                    self._end_implied(*IMPLIED[tag])
        elif self.current is not None:
            self.current.tags += 1
        if tag in VOID:
            return
        above = self.stack[-1] if self.stack else NOTHING
        inside = above[3] or tag in ("article", "main")
        self.count += 1
        given = {k: (v or "").lower() for k, v in attrs}
        silent = above[2] or self._silences(tag, given, above[3])
        named = not silent and self._named(tag, given, above[3])
        if tag in ("article", "main"):
            self.articles.add(self.count)
            if tag == "main":
                self.mains.add(self.count)
        self.stack.append((tag, self.count, silent, inside, named))
        if tag == "a":
            self.links += 1
        if named or silent != above[2]:
            self._break()

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "span", "a", "b", "i"):
            self.handle_endtag(tag)

    def _end_paragraph(self) -> None:
        """A block ends an open paragraph and the inline elements within it."""
        for k in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[k][0]
            if tag == "p":
                self._drop(k)
                return
            if tag not in INLINE:
                return

    def _end_implied(self, ended: frozenset[str], within: frozenset[str]) -> None:
        """A list item, cell or row ends the one before it, whose end tag may be left out."""
        last = None
        for k in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[k][0]
            if tag in within:
                break
            if tag in ended:
                last = k
        if last is not None:
            self._drop(last)

    def _drop(self, k: int) -> None:
        self.links -= sum(s[0] == "a" for s in self.stack[k:])
        del self.stack[k:]

    def _close(self, tag: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == tag:
                was, named = self.stack[-1][2], any(s[4] for s in self.stack[k:])
                self._drop(k)
                if named or was != (bool(self.stack) and self.stack[-1][2]):
                    self._break()
                return
            if tag in INLINE and self.stack[k][0] not in INLINE:
                return  # an inline end tag closes nothing beyond its block

    def handle_endtag(self, tag: str) -> None:
        if tag not in INLINE:
            self._break()
        elif self.current is not None:
            self.current.tags += 1
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.current is None and not data.strip():
            return
        line = self._line()
        line.parts.append(data)
        if self.links:
            line.link += len(data.strip())


def lines_of(html: str) -> tuple[list[Line], set[int]]:
    """The lines that have text, and the ids of article and main elements."""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    lines = [line for line in parser.lines if line.text]
    _silence(lines, parser.articles - parser.comments, parser.mains - parser.comments, parser.comments)
    return lines, parser.articles


def _silence(lines: list[Line], articles: set[int], mains: set[int], comments: set[int]) -> None:
    """Silences the lines in named containers and forms, outer ones first.

    One is opened instead if it holds the main element, an article and no open one has more non-link
    text, or, where no article with such text is open, more than half of the page's (of reader
    comments four fifths).  Reader comments are never opened beside an open article.
    """
    heard = [(x, max(0, len(x.text) - x.link)) for x in lines if not x.silent]
    size: dict[int, int] = {}
    own: dict[int, int] = {}  # of these, in articles within
    holds_main: set[int] = set()
    for x, n in heard:
        if not x.named:
            continue
        first = min(articles.intersection(x.around), default=0)
        first_main = min(mains.intersection(x.around), default=0)
        for c in x.named:
            size[c] = size.get(c, 0) + n
            if c < first:
                own[c] = own.get(c, 0) + n
            if c < first_main:
                holds_main.add(c)
    total = sum(n for _, n in heard)
    opened: set[int] = set()
    free: dict[int, int] = {}  # text of articles that nothing silences
    closed = heard
    while True:
        still, outer = [], set()
        for x, n in closed:
            c = next((c for c in x.named if c not in opened), 0)
            if c:
                still.append((x, n))
                outer.add(c)
            else:
                for a in articles.intersection(x.around):
                    free[a] = free.get(a, 0) + n
        closed = still
        most = max(free.values(), default=0)
        more = set()
        for c in outer:
            if c in comments:
                opens = not most and (5 * size[c] > 4 * total or own.get(c, 0) > 0)
            else:
                opens = own[c] >= most if own.get(c, 0) else not most and 2 * size[c] > total
            if opens or c in holds_main:
                more.add(c)
        if not more:
            break
        opened |= more
    if len(closed) < len(heard):  # else there is nothing but these
        for x, _ in closed:
            x.silent = True


def smoothed(ratios: list[float]) -> list[float]:
    kernel = [math.exp(-(k * k) / (2 * WIDTH * WIDTH)) for k in range(-RADIUS, RADIUS + 1)]
    out = []
    for i in range(len(ratios)):
        total = weight = 0.0
        for k, w in zip(range(i - RADIUS, i + RADIUS + 1), kernel, strict=True):
            if 0 <= k < len(ratios):
                total, weight = total + w * ratios[k], weight + w
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """Between the centres of two clusters; below all where the values are of one kind."""
    low, high = min(values), max(values)
    if high < 2 * low or high == low:
        return low
    logs = [math.log1p(v) for v in values]
    a, b = min(logs), max(logs)
    for _ in range(20):
        middle = (a + b) / 2
        lower = [v for v in logs if v <= middle]
        upper = [v for v in logs if v > middle]
        if not lower or not upper:
            break
        c, d = sum(lower) / len(lower), sum(upper) / len(upper)
        if (c, d) == (a, b):
            break
        a, b = c, d
    return math.expm1((a + b) / 2)


def _around(region: int, articles: set[int], open_lines: list[Line], core: list[Line], held: dict[int, int]) -> list[Line]:
    """Lines of the region, widened to the article or main around it, and all content outside it.

    Of a container beside the region everything stays where at least half of its text is content,
    else its lines of content.
    """
    path = next(x.around for x in core if region in x.around)
    path = path[: path.index(region) + 1]
    region = next((c for c in path if c in articles), region)
    within = set(path)
    size: dict[int, int] = {}
    for x in open_lines:
        for c in x.around:
            size[c] = size.get(c, 0) + len(x.text)
    kept = {c for c, n in held.items() if c not in within and 2 * n >= size[c]}
    content = set(map(id, core))
    return [x for x in open_lines if region in x.around or id(x) in content or not kept.isdisjoint(x.around)]


def main_text(html: str | None) -> str:
    """The main text of a page; '' for null, blank pages and pages of silent elements only."""
    lines, articles = lines_of(html) if html else ([], set())
    open_lines = [line for line in lines if not line.silent]
    if not open_lines:
        return ""
    ratios = [0.0 if x.silent else max(0, len(x.text) - x.link) / (1 + x.tags) for x in lines]
    smooth = smoothed(ratios)
    cut = threshold([s for s, x in zip(smooth, lines, strict=True) if not x.silent])
    core = [x for s, x in zip(smooth, lines, strict=True) if not x.silent and s >= cut and 2 * x.link <= len(x.text)]
    if not core:
        core = open_lines
    held: dict[int, int] = {}
    for x in core:
        for c in x.around:
            held[c] = held.get(c, 0) + len(x.text)
    total = sum(len(x.text) for x in core)
    region = max((c for c, n in held.items() if 10 * n >= 6 * total), default=None)
    chosen = open_lines if region is None else _around(region, articles, open_lines, core, held)
    # within the region only blocks that are mostly links, such as lists of further pages, go
    text = " ".join(x.text for x in chosen if 2 * x.link <= len(x.text) or x.heading)
    return text or " ".join(x.text for x in chosen)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """All rows and columns of ``pages`` with ``text``, the main text, and ``n_chars``, its code points.

    Null and empty pages have the text ''.  Repeated rows repeat their text; columns of these two
    names are replaced.
    """
    rows = pages.drop("text", "n_chars")
    schema = StructType(list(rows.schema.fields)).add("text", "string").add("n_chars", "long")
    names = rows.columns

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in batch.column(html).to_pylist()]
        made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*names, "text", "n_chars"])

    return map_arrow(rows, schema, over)
