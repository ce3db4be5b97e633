"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one for each block element. A line weighs as many characters as it
has outside links; lines of menus, headers, footers, sidebars, notices, adverts, forms and
reader comments weigh nothing. Weights are summed over sliding windows of ``WINDOW``
lines. The main text begins where the sums surge past ``SURGE`` and ends where they dive to
zero; of several such stretches those count that hold a fair share of the largest. A page that
marks its article has every line inside it kept that is not boilerplate, whatever stands
between them, so short paragraphs at its ends or around an advert are no matter of weight.

Words in a class or id mark boilerplate only where they do not speak of the page's frame: an element
that holds the article, or most of the text, is kept whatever it is called.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 3
SURGE = 80
# Stretches with less than this share of the largest are not main text.
SHARE = 0.25

# Fixed names of HTML: elements by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object canvas textarea title xmp noembed noframes".split())
SKIPPED = frozenset("nav aside form button select menu dialog fieldset head".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
# An open p, li and the like ends where one of these begins.
CLOSES_P = BLOCK - {"br", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
# Words in a class, id or role that mark what is not main text.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination "
    "pager popup promo promoted promotion related replies reply respond share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
# Those of them that mark the text of others or of the site, however long it is.
FOREIGN = frozenset(
    "ad ads advert adverts advertisement advertising comment comments consent cookie cookies disqus gdpr newsletter notice notices "
    "promo promoted promotion related replies reply respond sponsor sponsored".split()
)
# Elements of running text, and the words that mark even those.
INLINE = frozenset("b i em strong span a h1 h2 h3 p".split())
INLINE_WORDS = frozenset("ad ads advert cookie comment comments sponsored promo notice".split())
# Classes that say what stands beside an element.
BESIDE = re.compile(r"(?<![\w-])(?:has|with|without|no)(?:[-_]|(?=[A-Z]))\S*")
ROLES = frozenset("banner complementary contentinfo dialog form menu menubar navigation search alert alertdialog".split())
KEPT_ROOTS = frozenset("html body main article".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>|\Z)|[^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPACES = re.compile(r"\s+")
WORD = re.compile(r"[a-z]+")


@dataclass
class Line:
    """Text of one block: the characters outside links give its weight."""

    parts: list[str] = field(default_factory=list)
    plain: int = 0
    boilerplate: bool = False
    article: bool = False
    # An h1 outside the article.
    headline: bool = False

    def text(self) -> str:
        return SPACES.sub(" ", "".join(self.parts)).strip()


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(source)}


@dataclass
class Element:
    """An article, or an element that class words mark: how many plain characters it holds."""

    place: int
    name: str
    # Inside an element that marks the text of others, or such an element itself.
    foreign: bool
    # The marked element next around it.
    around: Element | None
    plain: int = 0
    # Of them, not the text of others; of these, dropped for a class word.
    own: int = 0
    dropped: int = 0
    # Characters that are kept, those of links too.
    kept: int = 0
    end: int = 0

    def count(self, sums: list[int], sign: int) -> None:
        plain, own, dropped, kept = sums
        self.plain += sign * plain
        self.own += sign * own
        self.dropped += sign * dropped
        self.kept += sign * kept

    def size(self) -> int:
        return self.plain if self.foreign else self.own


@dataclass
class Reading:
    """The blocks of a page in order, empty ones too; its articles and marked elements."""

    lines: list[Line]
    articles: list[Element]
    marks: list[Element]
    page: Element

    def body(self) -> Element:
        """The element that holds the text: the largest article, the narrowest of several that hold most of it.
        Articles among the text of others, such as comments, count only where the page holds no text but theirs."""
        found = [a for a in self.articles if a.plain]
        own = [a for a in found if not a.foreign]
        if not own and self.page.own > self.page.dropped and self.page.kept:
            return self.page
        found = own or found
        most = max((a.size() for a in found), default=0)
        return min((a for a in found if 2 * a.size() >= most), key=Element.size, default=self.page)

    def frames(self) -> frozenset[int]:
        """Places of the marked elements that frame the text: they hold an article of fair size or most of the text."""
        body = self.body()
        frames, element = set(), body.around
        while element:
            frames.add(element.place)
            element = element.around
        for a in self.articles:
            element = a.around
            if a.size() > 0 and not a.foreign and a.size() >= SHARE * body.size():
                while element and element.place not in frames:
                    frames.add(element.place)
                    element = element.around
        frames |= {m.place for m in self.marks if body.place <= m.place < body.end and not m.foreign and 2 * m.own > body.own}
        return frozenset(frames)


def judge(name: str, source: str, in_article: bool) -> tuple[bool, frozenset[str]]:
    """Whether an element holds something other than main text by its kind, and the class words that say so."""
    if name in SKIPPED or name == "footer" or (name == "header" and not in_article):
        return True, frozenset()
    if not source.strip() or name in KEPT_ROOTS:
        return False, frozenset()
    found = attributes(source)
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "")):
        return True, frozenset()
    if found.get("role", "").lower() in ROLES:
        return True, frozenset()
    classes = BESIDE.sub(" ", f"{found.get('class', '')} {found.get('id', '')}")
    words = BOILERPLATE.intersection(WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", classes).lower()))
    if in_article:
        words -= {"header"}
    return False, words & INLINE_WORDS if name in INLINE else words


def read(page: str, frames: frozenset[int] = frozenset(), words: frozenset[str] = BOILERPLATE) -> Reading:
    """One pass over a page; class words outside ``words`` and those of the elements in ``frames`` count for nothing."""
    lines = [Line()]
    articles: list[Element] = []
    marks: list[Element] = []
    whole = Element(0, "", False, None, end=len(page) + 1)
    # Open elements: (name, boilerplate inside, article inside, boilerplate by kind inside, text of others inside, counted elements).
    stack: list[tuple[str, bool, bool, bool, bool, list[Element]]] = []
    around: Element | None = None
    links = 0
    skip = article = fixed = foreign = False
    sums = [0, 0, 0, 0]
    place = 0

    def add(text: str) -> None:
        # Inline elements can be boilerplate inside a line that is not.
        if text and (lines[-1].boilerplate or not skip):
            lines[-1].parts.append(text)
            if not links:
                lines[-1].plain += len(text) - text.count(" ")
        if text and not fixed and not text.isspace():
            size = len(text) - text.count(" ")
            if not links:
                sums[0] += size
                sums[1] += 0 if foreign else size
                sums[2] += size if skip and not foreign else 0
            sums[3] += 0 if skip else size

    def new_line() -> None:
        lines.append(Line(boilerplate=skip, article=article, headline=not article and any(n == "h1" for n, *_ in stack[-3:])))

    def close(upto: int) -> None:
        nonlocal links, skip, article, fixed, foreign, around
        while len(stack) > upto:
            name, *_, counted = stack.pop()
            links -= name == "a"
            for element in counted:
                element.count(sums, 1)
                element.end = place
                if element is around:
                    around = element.around
        skip, article, fixed, foreign = stack[-1][1:5] if stack else (False, False, False, False)

    while place < len(page):
        m = TOKEN.search(page, place)
        add(html.unescape(page[place : m.start() if m else len(page)]))
        if not m:
            break
        place = m.end()
        if m["data"] is not None:
            add(m["data"])
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["close"]:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                block = any(n in BLOCK for n, *_ in stack[at:])
                close(at)
                if block:
                    new_line()
            elif name in BLOCK:
                new_line()
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(page, place)
            place = end.end() if end else len(page)
            continue
        if name == "a" and links:
            close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "a"))
        if name in CLOSES_P:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in CLOSES_P), None)
            if at is not None and (stack[at][0] == "p" or (name == stack[at][0] and name in {"li", "dt", "dd"})):
                close(at)
        if name in VOID or m["attrs"].rstrip().endswith("/"):
            if name in BLOCK:
                new_line()
            continue
        by_kind, named = (True, frozenset()) if fixed else judge(name, m["attrs"], article)
        named = frozenset() if m.start() in frames else named & words
        others = foreign or not FOREIGN.isdisjoint(named)
        counted = []
        if name in {"article", "main"} and not by_kind:
            counted.append(Element(m.start(), name, foreign, around))
            articles.append(counted[-1])
        if named:
            counted.append(Element(m.start(), name, others, around))
            marks.append(counted[-1])
            around = counted[-1]
        for element in counted:
            element.count(sums, -1)
        stack.append((name, skip or by_kind or bool(named), article or name in {"article", "main"}, by_kind, others, counted))
        links += name == "a"
        skip, article, fixed, foreign = stack[-1][1:5]
        if name in BLOCK:
            new_line()
    place = len(page)
    close(0)
    whole.count(sums, 1)
    return Reading(lines, articles, marks, whole)


def lines_of(page: str) -> list[Line]:
    """The page's blocks in order, empty ones too."""
    frames, reading = frozenset(), read(page)
    # A frame named for the text of others hides what is inside from the first count.
    for _ in range(2):
        more = reading.frames() - frames
        if not more:
            break
        frames |= more
        reading = read(page, frames)
    body = reading.body()
    if 2 * body.dropped > body.own:
        # The words name the parts that the text itself is built of.
        reading = read(page, frames, FOREIGN)
        body = reading.body()
    if body.plain and not body.kept:
        reading = read(page, words=frozenset())
    return reading.lines


def main_lines(weights: list[int]) -> list[bool]:
    """Which lines lie between a surge and a dive point."""
    n = len(weights)
    sums = [sum(weights[i : i + WINDOW]) for i in range(n)]
    stretches, i = [], 0
    while i < n:
        if sums[i] > SURGE:
            # The window surges before the text does.
            begin = next(k for k in range(i, n) if weights[k])
            while i < n and sums[i] > 0:
                i += 1
            stretches.append((begin, i, sum(weights[begin:i])))
        else:
            i += 1
    most = max((w for *_, w in stretches), default=0)
    kept = [False] * n
    for begin, end, weight in stretches:
        if weight >= SHARE * most:
            kept[begin:end] = [True] * (end - begin)
    return kept


def main_text(page: str | None) -> str:
    """The article of a page, one line for each block; empty if there is none."""
    if not page:
        return ""
    lines = [line for line in lines_of(page) if line.parts or not line.boilerplate]
    texts = [line.text() for line in lines]
    marked = any(line.article and not line.boilerplate and t for line, t in zip(lines, texts, strict=True))
    # Empty lines between blocks come from the markup; they are no gap in the text.
    rows = [(line, t) for line, t in zip(lines, texts, strict=True) if t]
    if marked:
        first = next(i for i, (line, _) in enumerate(rows) if line.article and not line.boilerplate)
        # The headline may stand before the article it belongs to.
        heads = [t for line, t in rows[:first] if line.headline and not line.boilerplate]
        return "\n".join([*heads[-1:], *(t for line, t in rows if line.article and not line.boilerplate)])
    weights = [0 if line.boilerplate else line.plain for line, _ in rows]
    if max((sum(weights[i : i + WINDOW]) for i in range(len(weights))), default=0) <= SURGE:
        # Nothing surges: a page of short lines is its own text.
        return "\n".join(t for (_, t), w in zip(rows, weights, strict=True) if w)
    kept = main_lines(weights)
    return "\n".join(t for (line, t), k in zip(rows, kept, strict=True) if k and not line.boilerplate)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        others = [n for n in batch.schema.names if n != "html"]
        added = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in others], *added], names=[*others, "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html; other columns are
    ignored).

    A null or empty page has the empty text. Rows are taken one by one, so a missing id or url
    and repeated rows change nothing. Broken markup is closed where the page ends. An empty
    table gives an empty result.
    """
    kept = pages.select("page_id", "url", "html")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "html")
    return kept.mapInArrow(_extracted, f"{types}, text string, n_chars bigint")
