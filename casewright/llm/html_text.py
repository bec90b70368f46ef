"""Main text of web pages by the distribution of text over lines of blocks (operator 8)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casewright.llm.common import slices

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*"|'[^']*')*)(?:>|\Z|(?=<))""", re.DOTALL)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

# ---- Fixed values: names in HTML and common names of page parts ----
#: Elements whose content is no text.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are no part of the running text.
_ASIDE = frozenset("head nav footer aside button select option svg noscript template dialog menu canvas object video audio map".split())
_MAIN = frozenset("article main".split())
#: Elements that end the block before them and start one.
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3
    h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul""".split())
#: Elements that a next one of the same kind ends.
_SIBLING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
#: Words in a class or an id that tell a part that is not the article.
_PARTS = frozenset("""ad ads adv advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored sponsors promo promos promotion banner
    nav navbar navigation menu menus submenu breadcrumb breadcrumbs pagination pager footer footnav masthead topbar toolbar header sidebar sidebars aside
    widget widgets related recommended recommendations share sharing social comment comments commentlist discussion disqus respond reply replies
    cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login search""".split())

#: Words that may stand beside them in such a name; any other word makes it the name of something else ("no-sidebar", "has-header").
_PLACES = frozenset("""site main left right top bottom primary secondary first second inner outer global mobile desktop sticky area list box block wrap
    wrapper container section bar slot unit item items links link button buttons col column row panel inline text""".split())
#: Words for the text itself: with them a header is that of the text.
_TEXTS = frozenset("post entry article".split())

#: Those that also tell an article element that is not the article.
_COMMENTS = frozenset("comment comments reply replies".split())

_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Lines summed together; so many lines without a weight in a row are a dive.
WINDOW = 3
#: Share of a line's text that must be in links for it to have no weight.
_LINKS = 0.7
#: The share of a page's text that an article must hold to be the page's, and that forms must hold to be no forms.
_WHOLE_ARTICLE, _WHOLE_FORM = 0.25, 0.5


@dataclass
class Line:
    """A block's text, what of it is in links, whether it is a part beside the text, in an article, in a form and a heading."""

    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    beside: bool = False
    main: bool = False
    form: bool = False
    heading: bool = False


def _names_part(name: str, parts: frozenset[str]) -> bool:
    """Whether a class or an id as a whole is the name of such a part, like "site-header" and "ad-box2"."""
    words = {w.rstrip("0123456789") for w in re.split(r"[^a-z0-9]+", name)} - {""}
    found = words & parts
    if not found or words - _PARTS - _PLACES - _TEXTS:
        return False
    return found != {"header"} or words.isdisjoint(_TEXTS)


def _is_beside(name: str, attributes: str, in_main: bool) -> bool:
    if name in _ASIDE or name == "header" and not in_main:
        return True
    if not attributes or attributes.isspace():
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key in ("class", "id") and name not in ("html", "body", "main"):
            if any(_names_part(x, _COMMENTS if name == "article" else _PARTS) for x in value.split()):
                return True
        elif key == "role" and value in _ROLES or key == "hidden" or key == "aria-hidden" and value == "true":
            return True
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def lines_of(html: str) -> list[Line]:
    """The page's blocks as lines, markup stripped; text beside the article is marked, scripts and styles are gone.

    Only an ``a`` with href is a link; its end tag, the next ``a`` and the end of the block it began in end it. The time is
    proportional to the page, however deep its tags are nested.
    """
    lines, line = [], Line()
    open_: list[tuple[str, bool, bool]] = []  # name, beside, main
    names: Counter[str] = Counter()  # how many of them have the name
    n_beside = n_main = n_heading = 0
    link, at, end = 0, 0, len(html)  # link: number of open elements where the open link began, plus 1; 0 if none is open

    def push(name: str, beside: bool, main: bool) -> None:
        nonlocal n_beside, n_main, n_heading
        open_.append((name, beside, main))
        names[name] += 1
        n_beside += beside
        n_main += main
        n_heading += name in _HEADINGS

    def pop() -> str:
        nonlocal n_beside, n_main, n_heading, link
        name, beside, main = open_.pop()
        names[name] -= 1
        n_beside -= beside
        n_main -= main
        n_heading -= name in _HEADINGS
        if link > len(open_) + 1:
            link = 0
        return name

    def close_line() -> None:
        nonlocal line
        if line.pieces:
            lines.append(line)
        line = Line(beside=n_beside > 0, main=n_main > 0, form=names["form"] > 0, heading=n_heading > 0)

    def take(text: str) -> None:
        if text:
            line.pieces.append(text)
            if link:
                line.linked.append(text)

    while at < end:
        start = html.find("<", at)
        found = _MARKUP.match(html, start) if start >= 0 else None
        if start < 0:
            take(html[at:])
            break
        if not found:
            take(html[at:start + 1])
            at = start + 1
            continue
        take(html[at:start])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            if name == "a":
                link = 0
            if names[name]:
                while pop() != name:
                    pass
                close_line()
            elif name in _BLOCK:
                close_line()
            continue
        if name in _RAW:
            gone = re.compile(rf"</{name}[\s/>]", re.IGNORECASE).search(html, at)
            at = gone.start() if gone else end
            continue
        if name == "br":
            take(" ")
        if name == "a":
            link = len(open_) + 1 if any(key.lower() == "href" for key, _ in _ATTRIBUTE.findall(found[3])) else 0
        beside = _is_beside(name, found[3], n_main > 0)
        if name in _BLOCK:
            if open_ and open_[-1][0] == "p":
                pop()
            same = _SIBLING.get(name)
            if same and open_ and open_[-1][0] in same:
                pop()
        if name not in _VOID and not found[3].endswith("/") and (name in _BLOCK or beside or name in _MAIN):
            push(name, beside, name in _MAIN and not beside)
        if name in _BLOCK or beside:
            close_line()
    if line.pieces:
        lines.append(line)
    return lines


def _clean(pieces: list[str]) -> str:
    return " ".join(unescape("".join(pieces)).split())


def _weights(lines: list[tuple[Line, str]]) -> list[int]:
    """A line's length, but 0 if it is mostly links. A linked heading has its length if it is that of text: if the next line
    that is no heading is not mostly links."""
    weights, text_follows = [], False
    for line, text in reversed(lines):
        mostly_links = bool(line.linked) and len(_clean(line.linked)) > _LINKS * len(text)
        if not line.heading:
            text_follows = not mostly_links
        weights.append(len(text) if not mostly_links or line.heading and text_follows else 0)
    return weights[::-1]


def stretches(weights: list[int]) -> list[range]:
    """The stretches of lines between a surge and the next dive: a stretch begins (surge) at a line whose weight lifts the sum of
    the window up to it from 0, and ends (dive) with the last line before the sum over a whole window is 0 again."""
    found, upto = [], 0
    for i, weight in enumerate(weights):
        before, upto = upto, upto + weight - (weights[i - WINDOW] if i >= WINDOW else 0)
        if not weight:
            continue
        if before:
            found[-1] = range(found[-1].start, i + 1)
        else:
            found.append(range(i, i + 1))
    return found


def main_text(html: str) -> str:
    """The lines of the stretches between surges and dives of the weights of lines, all of them.

    Lines beside the text (menus, headers, adverts and the like, by their element, role, class or id) are taken out first, and
    so are those of forms that hold less than half of the text, and, on a page whose article or main elements hold a quarter of it or
    more, those outside these. Of the others a line weighs its length, or nothing if it is mostly links (``_weights``).
    So every line of text stays, however short, and links between lines of text too; what goes is lists of links: ``WINDOW``
    lines or more in a row, and any before the first line of text or after the last.
    """
    lines = [(line, text) for line in lines_of(html) if not line.beside and (text := _clean(line.pieces))]
    weights = _weights(lines)

    def leave(keep: list[bool]) -> None:
        nonlocal lines, weights
        lines, weights = [x for x, k in zip(lines, keep) if k], [w for w, k in zip(weights, keep) if k]

    if sum(w for (line, _), w in zip(lines, weights) if line.form) < _WHOLE_FORM * sum(weights):
        leave([not line.form for line, _ in lines])
    in_main = sum(w for (line, _), w in zip(lines, weights) if line.main)
    if in_main and in_main >= _WHOLE_ARTICLE * sum(weights):
        leave([line.main for line, _ in lines])
    return "\n".join(lines[i][1] for stretch in stretches(weights) for i in stretch)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without ``html_col`` and with ``text`` and ``n_chars``; a column named like these is replaced.

    Every row gives a row, repeated rows too; a null or empty page, or one without text, gives an empty text, an empty table an
    empty one. Pages of any length are read whole, one at a time.
    """
    names = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    kinds = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__html"):
            texts = [main_text(h or "") for h in batch.column("__html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names))), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=[*names, "text", "n_chars"])

    return pages.select(*names, F.col(html_col).alias("__html")).mapInArrow(run, f"{kinds}text string, n_chars long")
