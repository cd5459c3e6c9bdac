"""Main text of web pages from text-to-tag ratios.

The standard library's parser streams events; each run of text between block
tags is a line with its characters and the tags seen since the line before.
The ratio of characters to tags is smoothed over neighbouring lines with a
Gaussian kernel and split by two-means clustering: lines of the upper cluster
are content, and all lines are where the clusters lie less than APART apart. The
region kept is what holds the content lines: all article and main elements if
those hold half of it, else the smallest element that holds all of it, else (if
only body does) the runs of text from the first content line's to the last's,
without the lines of mere links before it. All lines of the region are kept,
short ones too, but for those inside elements that are never article text
(NOT_TEXT, NOT_TEXT_NAMES). A page without article or main whose whole text lies
in elements that only their class names mark keeps it.

Character references are decoded, white space in a block becomes one space,
blocks are joined by one space. Null, empty and tag-only html gives empty text;
equal lines are each kept; rows repeated in full stay repeated; an empty table
gives an empty one; columns other than page_id, url and html are not read. Time
is linear in the page: what opens and never closes (a comment, a tag at the end
of the page) ends the text, as in browsers, and elements are ranges of lines.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
#: Logarithms of characters per tag: clusters nearer than this are one.
APART = 1.0
#: Elements whose text is not part of an article.
NOT_TEXT = frozenset("script style noscript template head title nav footer aside form button select textarea option "
                     "iframe object embed svg canvas audio video dialog menu label".split())
#: Words of class, id or role that mark such elements.
NOT_TEXT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar aside footer masthead topbar cookie cookies consent gdpr notice "
    "notices disclaimer popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "related recommended comment comments commentlist respond reply replies disqus discussion complementary "
    "contentinfo search widget toolbar pagination pager alert".split())
#: Names that only a container of reader comments has; an article inside one is a comment.
_COMMENTS = frozenset("comment comments commentlist respond reply replies disqus discussion".split())
_BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
                    "figcaption figure footer form frame h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav "
                    "ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul script style "
                    "noscript template iframe".split())
#: Elements whose nesting is followed; others are inline or closed by what follows.
_NESTED = frozenset("article aside blockquote body div dl dialog fieldset figure footer form header main menu nav ol "
                    "section table td ul head script style noscript template title button select textarea iframe "
                    "object svg canvas audio video label details center".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Words beside which a listed word still marks its element, wherever it stands in the name.
_NEUTRAL = frozenset("area bar block bottom box button buttons col column container content footer form global group header "
                     "holder inner item items left link links list main menu module outer panel post posts right section "
                     "site slot text top unit wrap wrapper zone".split())
#: Listed words that page builders put at the end of every name.
_ENDINGS = frozenset("widget label".split())
_COMMENT_END = re.compile("--!?>")
_OPENS = re.compile("<[A-Za-z/!?]")
#: Parts of class names after which stands what the element lacks or stands beside.
_BESIDE = frozenset("with without no not has hide non is".split())


def _marks(value: str) -> set[str]:
    """Listed words that mark an element by its class names.

    A name marks if its last word is listed (site-sidebar), or its first is and
    all others are listed or neutral (ad-container); notice-page and ad-free do
    not, nor does what follows with-, no-, has- and the like.
    """
    out: set[str] = set()
    for name in value.split():
        found: list[str] = []
        for word in _NAME.findall(name):
            if word.lower() in _BESIDE:
                found = []
                break
            if len(word) > 1:
                found.append(word.lower())
        listed = [w for w in found if w in NOT_TEXT_NAMES]
        if listed and (found[-1] in NOT_TEXT_NAMES and (len(found) == 1 or found[-1] not in _ENDINGS)
                       or found[0] in NOT_TEXT_NAMES and all(w in NOT_TEXT_NAMES or w in _NEUTRAL for w in found)):
            out.update(listed)
    return out


#: Why a line is not article text: class name, element, reader comments or scripts (whose text is not read at all).
NAMED, ELEMENT, UNREAD = 1, 2, 3


class _Lines(HTMLParser):
    """Collects lines, and elements as ranges of lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []  # text, tags before it, why not text (0: text), links only
        self.elements: list[list] = []  # tag, first line, line after the last
        self.open: list[tuple[str, int, int]] = []  # tag, element, reason outside it
        self.depth: Counter[str] = Counter()  # open elements by tag
        self.parts: list[str] = []
        self.tags = 0
        self.out = 0
        self.in_link, self.plain = False, False

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                self.lines.append((text, self.tags, self.out, not self.plain))
                self.tags = 0
        self.plain = False

    def handle_starttag(self, tag, attrs) -> None:
        self.tags += 1
        if tag in _BLOCKS:
            self.flush()
        if tag == "a":
            self.in_link = True
        if tag not in _NESTED:
            return
        self.flush()
        out = self.out
        names = {w for k, v in attrs if k in ("class", "id", "role") and v for w in _marks(v)}
        if tag in ("article", "main") and out in (NAMED, ELEMENT) and not any(
                self.depth[t] for t in ("nav", "aside", "footer", "form")):
            out = 0  # an unclosed advert or notice does not swallow the article
        elif tag in ("script", "style", "noscript", "template") or names & _COMMENTS and tag not in ("body", "main"):
            out = UNREAD
        elif (tag in NOT_TEXT or tag == "header" and not self.depth["article"] and not self.depth["main"]
              or any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)):
            out = max(out, ELEMENT)
        elif names and tag not in ("body", "main", "article"):
            out = max(out, NAMED)
        self.elements.append([tag, len(self.lines), None])
        self.open.append((tag, len(self.elements) - 1, self.out))
        self.depth[tag] += 1
        self.out = out

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)  # as browsers do; the base class fails on unknown sections

    def parse_comment(self, i, report=1):
        for empty in ("<!-->", "<!--->"):
            if self.rawdata.startswith(empty, i):
                return i + len(empty)
        end = _COMMENT_END.search(self.rawdata, i + 4)
        return end.end() if end else len(self.rawdata)

    def handle_startendtag(self, tag, attrs) -> None:
        self.tags += 1
        if tag in _BLOCKS:
            self.flush()

    def handle_endtag(self, tag) -> None:
        self.tags += 1
        if tag in _BLOCKS or tag in _NESTED:
            self.flush()
        if tag == "a":
            self.in_link = False
        if tag in _NESTED and self.depth[tag]:
            self._close(tag)

    def _close(self, tag: str | None) -> None:
        """Close elements up to the innermost of that tag (None: all)."""
        while self.open:
            own, k, self.out = self.open.pop()
            self.depth[own] -= 1
            self.elements[k][2] = len(self.lines)
            if own == tag:
                break

    def handle_data(self, data) -> None:
        if self.out < UNREAD:
            self.parts.append(data)
            self.plain = self.plain or not self.in_link and not data.isspace()

    def read(self, html: str) -> None:
        end = html.rfind(">") + 1
        unclosed = _OPENS.search(html, end)
        self.feed(html[:unclosed.start()] if unclosed else html)
        self.close()
        self.flush()
        self._close(None)


def _smooth(values: list[float]) -> list[float]:
    reach = max(1, math.ceil(2 * SIGMA))
    kernel = [math.exp(-k * k / (2 * SIGMA * SIGMA)) for k in range(-reach, reach + 1)]
    out = []
    for i in range(len(values)):
        low, high = max(0, i - reach), min(len(values), i + reach + 1)
        w = kernel[low - i + reach:high - i + reach]
        out.append(sum(a * b for a, b in zip(w, values[low:high], strict=True)) / sum(w))
    return out


def _threshold(values: list[float]) -> float:
    """Border between the two clusters of the values (their least value if these lie less than APART apart)."""
    least = low = min(values)
    high = max(values)
    for _ in range(50):
        cut = (low + high) / 2
        a, b = [v for v in values if v < cut], [v for v in values if v >= cut]
        if not a or not b:
            break
        new = sum(a) / len(a), sum(b) / len(b)
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2 if high - low >= APART else least


def main_text(html: str | None) -> tuple[str, int, int]:
    """Main text, number of lines of the page, number of lines kept."""
    if not html:
        return "", 0, 0
    parser = _Lines()
    parser.read(html)
    lines = parser.lines
    marked = any(tag in ("article", "main") for tag, _, _ in parser.elements)
    own = [why == 0 for _, _, why, _ in lines]
    if not marked and not any(own):
        own = [why == NAMED for _, _, why, _ in lines]
    if not any(own):
        return "", len(lines), 0
    smooth = _smooth([math.log1p(len(t) / max(1, n)) if k else 0.0 for (t, n, _, _), k in zip(lines, own, strict=True)])
    border = _threshold([v for v, k in zip(smooth, own, strict=True) if k])
    content = [i for i, k in enumerate(own) if k and smooth[i] >= border]
    first, last = content[0], content[-1]
    held = [False] * len(lines)  # lines of article and main elements
    done = 0
    for tag, low, high in parser.elements:  # in page order, so a range starts within or after those before it
        if tag in ("article", "main"):
            for i in range(max(low, done), high):
                held[i] = True
            done = max(done, high)
    total = sum(len(lines[i][0]) for i in content)
    if 2 * sum(len(lines[i][0]) for i in content if held[i]) >= total and any(held):
        chosen = [i for i, k in enumerate(own) if k and held[i]]
    else:
        around = [(low, high) for tag, low, high in parser.elements if tag != "body" and low <= first and last < high]
        if around:
            low, high = around[-1]
        else:
            low, high = first, last + 1
            while low and own[low - 1]:
                low -= 1
            while low < first and lines[low][3]:
                low += 1
            while high < len(lines) and own[high]:
                high += 1
        chosen = [i for i in range(low, high) if own[i]]
    return " ".join(lines[i][0] for i in chosen), len(lines), len(chosen)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_lines and n_kept of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                found = [main_text(h.as_py()) for h in part.column(2)]
                text = [t for t, _, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(text, pa.string()),
                     pa.array([len(t) for t in text], pa.int64()), pa.array([n for _, n, _ in found], pa.int64()),
                     pa.array([k for _, _, k in found], pa.int64())],
                    ["page_id", "url", "text", "n_chars", "n_lines", "n_kept"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_lines long, n_kept long")
